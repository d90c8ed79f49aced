"""Language identification by compression.

Each language has a dictionary: raw content, extracts of a bounded sample of labelled
texts. A text is encoded with every language's dictionary in turn, piece by piece, and
the language whose dictionary gives the fewest bytes in all is chosen. Pieces are small
beside the dictionary, so a long text does not become its own dictionary. Where the
runner-up needs hardly more bytes, the answer is marked as rejected.

Dictionaries are bounded by parameters; texts never leave their tasks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.common import staged, table
from tidepool.llm.toxicity import held_out

# The sample: texts of a language, characters taken of each, bytes of a language's dictionary.
SAMPLE_TEXTS = 256
EXTRACT_CHARS = 400
DICTIONARY_BYTES = 64 << 10
# Bytes encoded together; level and shortest match of the encoder.
PIECE_BYTES = 2048
LEVEL, SHORTEST_MATCH = 6, 3
# An answer is rejected if the runner-up needs less than this share more.
MARGIN = 0.02
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
COLUMNS = ("lang_pred", "score", "rejected", "sizes", "held_out")


class Encoders:
    """An encoder for each language, built where it is used first."""

    def __init__(self, dictionaries: dict[str, bytes], rows: dict[str, int]):
        """``rows`` says in how many learnt texts a language comes; ties go to the more frequent one."""
        self.dictionaries, self.rows, self.built = dictionaries, rows, None

    def __reduce__(self):
        return Encoders, (self.dictionaries, self.rows)

    def sizes(self, text: str) -> dict[str, int]:
        """Bytes of the whole text encoded with each language's dictionary."""
        if self.built is None:
            self.built = {}
            for lang, raw in self.dictionaries.items():
                how = zstandard.ZstdCompressionParameters.from_level(
                    LEVEL, min_match=SHORTEST_MATCH, write_content_size=0, write_checksum=0, write_dict_id=0)
                known = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                known.precompute_compress(compression_params=how)
                self.built[lang] = zstandard.ZstdCompressor(dict_data=known, compression_params=how)
        raw = text.lower().encode("utf-8", "surrogatepass")
        pieces = [raw[lo:lo + PIECE_BYTES] for lo in range(0, len(raw), PIECE_BYTES)]
        return {lang: sum(len(c.compress(p)) for p in pieces) for lang, c in self.built.items()}

    def choose(self, text: str | None) -> tuple[str, float, bool, dict[str, int]]:
        """Language, score, whether it is rejected, and the sizes."""
        if not text or not self.dictionaries or not _LETTER.search(text):
            return UNKNOWN, 0.0, True, {}
        sizes = self.sizes(text)
        order = sorted(sizes, key=lambda x: (sizes[x], -self.rows[x], x))
        if len(order) == 1:
            return order[0], 1.0, False, sizes
        best, second = sizes[order[0]], sizes[order[1]]
        # From one half at a tie towards 1, in steps of a small share of the size.
        score = 1 - 0.5 * math.exp((best - second) / (2 + MARGIN * second))
        return order[0], score, second - best < MARGIN * second, sizes


def learn(docs: DataFrame, sample_texts: int = SAMPLE_TEXTS) -> Encoders:
    """A dictionary for each language, of extracts of at most ``sample_texts`` texts of it.

    Learnt are rows that are not held out and have a lang and a letter; equal texts of a
    language count once. Texts are taken by their hash, so that the sample does not
    depend on the order of rows, and the extract of a text begins where its hash says.
    """
    spark = docs.sparkSession
    usable = docs.select(F.col("lang").cast("string").alias("lang"), "text", "doc_id") \
        .filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id"))) \
        .select("lang", "text", F.xxhash64(F.lit("langid"), "text").alias("mark"))
    # Pre-aggregated, so that copies and large languages cost a row each per task.
    once = staged(spark, usable.groupBy("lang", "mark").agg(F.count("*").alias("copies")), "lang-marks")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("mark"))
    wanted = staged(spark, once.withColumn("r", rank).filter(F.col("r") <= sample_texts).select("lang", "mark"), "lang-sample")
    start = F.pmod("mark", F.greatest(F.lit(1), F.length("text") - EXTRACT_CHARS + 1)).cast("int")
    # The sample holds sample_texts pairs a language.
    extracts = (usable.join(F.broadcast(wanted), ["lang", "mark"])
                .select("lang", "mark", F.substring(F.col("text"), start + 1, F.lit(EXTRACT_CHARS)).alias("extract"))
                .groupBy("lang", "mark").agg(F.min("extract").alias("extract"))
                .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("mark", "extract"))).alias("all"))
                .select("lang", F.col("all.extract").alias("extracts")).collect())
    rows = {r["lang"]: r["n"] for r in once.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    return Encoders({r["lang"]: "\n".join(r["extracts"]).lower().encode("utf-8", "surrogatepass")[:DICTIONARY_BYTES]
                     for r in sorted(extracts, key=lambda r: r["lang"])}, rows)


def identify(docs: DataFrame, sample_texts: int = SAMPLE_TEXTS) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, lang, ...) and the language of each whole text.

    Adds ``lang_pred`` (a learnt lang, ``und`` if the text is null or has no letter or
    nothing was learnt), ``score`` (0 to 1: 0.5 at a tie, 0 for ``und``), ``rejected``
    (the margin is narrow, or ``und``), ``sizes`` (encoded bytes by language) and
    ``held_out`` (the row was not learnt from); columns of these names are replaced.
    Predictions come from the text alone. Ties go to the language with more learnt
    texts, then by name. Repeated rows get equal results; an empty table gives none.
    """
    encoders = docs.sparkSession.sparkContext.broadcast(learn(docs, sample_texts))
    keep = [c for c in docs.columns if c not in COLUMNS]
    base = docs.select(*[f"`{c}`" for c in keep])
    added = "lang_pred string, score double, rejected boolean, sizes map<string,long>"
    schema = T.StructType([*base.schema.fields, *T.StructType.fromDDL(added).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        choose, memory = encoders.value.choose, {}
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                b = whole.slice(lo, 256)
                out = []
                for text in b.column("text").to_pylist():
                    key = hashlib.blake2b((text or "").encode("utf-8", "surrogatepass"), digest_size=16).digest()
                    if key not in memory:
                        if len(memory) > 20_000:
                            memory.clear()
                        memory[key] = choose(text)
                    out.append(memory[key])
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64()),
                     pa.array([x[2] for x in out], pa.bool_()),
                     pa.array([list(x[3].items()) for x in out], pa.map_(pa.string(), pa.int64()))],
                    names=[*keep, "lang_pred", "score", "rejected", "sizes"])

    return base.mapInArrow(run, schema).withColumn("held_out", held_out(F.col("doc_id")))


def op13_langid(spark, sf_dir):
    """Language of every document."""
    return identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")) \
        .select("doc_id", "held_out", "lang_pred", "score", "rejected")
