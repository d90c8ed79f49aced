"""Mixture-controlled packing into fixed-length token sequences.

Documents queue by source. A deficit round-robin visits the queues once per window
(``window_sequences`` sequences): each visit credits the queue with its share of
the window and takes the tokens of its whole credit; what is left of the credit, a
fraction of a token (tokens can be cut off anywhere), is carried to the next window. So every window, which
ends where its credit is served, holds its
target proportions to within a token a source, and no padding arises before the
very last sequence. When a queue runs dry, a new phase shares the windows among the
others.

Credits have a closed form: in a phase of ``A`` tokens to which a queue gives ``a``,
it has been served ``floor(x * a / A)`` tokens when ``x`` tokens of credit are dealt
out. A document's pieces therefore follow from its place in its queue alone, and
partitions pack independently. Texts are tokenised once; each
partition numbers its tokens per source as it writes them, and only those
per-partition totals (one row per partition and source) are summed up. Token ids
are not shuffled, unless that table of totals is too large to broadcast.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import held, staged, table

SEQUENCE = 2048
END_ID = 1
# A text of other characters, or with a special token's opening, is encoded whole.
_ODD = re.compile("[^\t\n\r\x20-\x7e\xa1-įı-ɏ]|<\\|")

# Marks that may end a word; the tokenizer always parts them from a letter or digit.
_MARKS = ".,;:!?*%&$#|)]}\"/-"


class WordEncoder:
    """Token ids of whole texts, remembering the ids of words.

    The tokenizer lower-cases, drops white space and never joins across it, so a
    text's ids are those of its blank-separated words, and those of a word are the
    ids of its letters and of the marks at its end. This holds for the
    characters that ``_ODD`` does not find, on which lower-casing and normalising
    act one by one; any other text goes to the tokenizer as it is. The memory
    keeps at most two generations of ``limit`` words.
    """

    def __init__(self, path: str, limit: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        self.batch = getattr(t, "encode_batch_fast", t.encode_batch)
        self.code = "H" if t.get_vocab_size() <= 1 << 16 else "I"
        self.limit, self.new, self.old = limit, {}, {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.batch(texts, add_special_tokens=False)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as packed unsigned integers of ``code``."""
        words = [None if t and _ODD.search(t) else (t or "").lower().split() for t in texts]
        if len(self.new) > self.limit:
            self.new, self.old = {}, self.new
        new, old = self.new, self.old
        ended, wanted = [], set()
        for w in set().union(*(w for w in words if w)):
            if w not in new:
                if w in old:
                    new[w] = old[w]
                    continue
                stem = w.rstrip(_MARKS)
                if len(stem) < len(w) and stem and stem[-1].isalnum():
                    ended.append((w, stem, w[len(stem):]))
                    wanted.update(ended[-1][1:])
                else:
                    wanted.add(w)
        wanted = [w for w in wanted if w not in new]
        new.update((w, old[w]) for w in wanted if w in old)
        fresh = [w for w in wanted if w not in old]
        new.update(zip(fresh, self._ids(fresh), strict=True))
        new.update((w, new[stem] + new[tail]) for w, stem, tail in ended)
        get = new.__getitem__
        return [self._ids([t])[0] if w is None else b"".join(map(get, w)) for t, w in zip(texts, words, strict=True)]


def encoder(path: str) -> WordEncoder:
    """This worker's encoder, kept from task to task."""
    return held(("words", path), lambda: WordEncoder(path))


def tokenised(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``part, doc_id, source, at, n, ids`` with the end id appended to each document.

    ``at`` counts the tokens of the same source before it in the same partition.
    """
    end = END_ID

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seen = encoder(vocabulary), TaskContext.get().partitionId(), {}
        tail = array(enc.code, [end]).tobytes()
        width = len(tail)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                b = batch.slice(lo, 256)
                ids = [x + tail for x in enc.encode(b.column("text").to_pylist())]
                n = [len(x) // width for x in ids]
                at = []
                for s, k in zip(b.column("source").to_pylist(), n, strict=True):
                    at.append(seen.get(s, 0))
                    seen[s] = at[-1] + k
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(n), pa.int64()), b.column("doc_id"), b.column("source"),
                     pa.array(at, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                    names=["part", "doc_id", "source", "at", "n", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string")) \
        .mapInArrow(encode, "part long, doc_id long, source string, at long, n long, ids binary")


class RoundRobin:
    """The deficit round-robin over queues of known lengths, in closed form.

    A phase lasts until the next queue runs dry. By its end a queue that gives ``w`` of
    every unit of credit has been served ``round(w * v)`` tokens, where ``v`` is the
    credit dealt out by then. So what a phase gives follows from one number a phase and
    two a queue, whatever the number of queues.
    """

    def __init__(self, totals: Sequence[int], weights: Sequence[float], window: int):
        """Queue i holds ``totals[i]`` tokens and is to give ``weights[i]`` of every window."""
        self.window = window
        self.totals, self.weights = np.array(totals, dtype=np.int64), np.array(weights, dtype=np.float64)
        self.dry = self.totals / self.weights
        self.ends = np.unique(self.dry[self.totals > 0])
        self.start = [0]                             # per phase: stream position of its begin
        for v in self.ends.tolist():
            self.start.append(int(self._by(v).sum()))
        self._phase: tuple[int, np.ndarray] | None = None
        self._seen: dict[tuple[int, int], np.ndarray] = {}

    def _by(self, v: float) -> np.ndarray:
        """Tokens that each queue has given when ``v`` of credit is dealt out."""
        return np.where(self.dry <= v, self.totals, np.minimum(self.totals, np.rint(self.weights * v).astype(np.int64)))

    def _served(self, queue: int) -> np.ndarray:
        """Tokens that a queue has given by the begin of the first phase and the end of each."""
        some = np.rint(self.weights[queue] * self.ends).astype(np.int64)
        total = self.totals[queue]
        return np.concatenate([[0], np.where(self.dry[queue] <= self.ends, total, np.minimum(total, some))])

    def _gives(self, phase: int) -> np.ndarray:
        """Tokens that each queue gives in a phase."""
        if self._phase is None or self._phase[0] != phase:
            before = self._by(self.ends[phase - 1]) if phase else np.zeros_like(self.totals)
            self._phase = phase, self._by(self.ends[phase]) - before
        return self._phase[1]

    def _before(self, phase: int, t: int) -> np.ndarray:
        """Running sums over the queues of the tokens given in windows before ``t`` of a phase."""
        if (phase, t) not in self._seen:
            if len(self._seen) > 256:
                self._seen.clear()
            total, gives = self.start[phase + 1] - self.start[phase], self._gives(phase)
            x = min(total, t * self.window)
            # Products beyond 64 bits are taken with Python's integers.
            given = x * gives // total if x * int(gives.max()) < 1 << 63 else \
                np.array([x * g // total for g in gives.tolist()], dtype=np.int64)
            self._seen[phase, t] = np.concatenate([[0], np.cumsum(given)])
        return self._seen[phase, t]

    def runs(self, queue: int, first: int, n: int) -> Iterator[tuple[int, int, int]]:
        """Where tokens ``first .. first+n`` of a queue go: ``(offset, stream position, length)``."""
        done, served = 0, self._served(queue)
        while done < n:
            k = int(np.searchsorted(served, first + done, side="right")) - 1
            at, give = first + done - int(served[k]), int(served[k + 1] - served[k])
            total = self.start[k + 1] - self.start[k]
            # The window in which the credit of this queue reaches its token number at + 1.
            t = (-(-(at + 1) * total // give) - 1) // self.window
            x, y = self._before(k, t), self._before(k, t + 1)
            began, ends = int(x[queue + 1] - x[queue]), int(y[queue + 1] - y[queue])
            m = min(n - done, ends - at)
            yield done, self.start[k] + int(y[queue] + x[-1] - x[queue]) + at - began, m
            done += m


def pack(docs: DataFrame, vocabulary: str | None = None, sequence: int = SEQUENCE, window_sequences: int = 64,
         proportions: Mapping[str | None, float] | None = None) -> DataFrame:
    """All ``docs`` (doc_id, text, source) as pieces of sequences of ``sequence`` tokens.

    Columns: ``doc_id, start, length, ids`` (little-endian 32-bit), ``doc_tokens,
    sequence_id, offset``. Every token, the end id of each document included, is in
    one piece; all sequences but the last are full. ``proportions`` gives target
    weights by source (others weigh 1); by default a source's share of all tokens,
    so that all queues end together. Every source has a queue of its own; two numbers
    a source are held by the driver and each task.

    Null and empty texts are the end id alone. Null sources are one queue; null
    doc_ids are kept. Repeated rows are packed each. An empty table gives no piece.
    Documents queue in the order of the partitions read.
    """
    spark = docs.sparkSession
    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    tokens = staged(spark, tokenised(docs, path), "pack-tokens")
    parts = staged(spark, tokens.groupBy("part", "source").agg(F.sum("n").alias("m")), "pack-parts")
    sources = parts.groupBy("source").agg(F.sum("m").alias("total"))
    names = sources.orderBy(F.col("source").asc_nulls_first()).collect()
    queue = F.dense_rank().over(Window.partitionBy().orderBy(F.col("source").asc_nulls_first())) - 1
    totals = [r["total"] for r in names]
    weights = [float(t) for t in totals] if proportions is None else [float(proportions.get(r["source"], 1.0)) for r in names]
    order = Window.partitionBy("queue").orderBy("part", "source").rowsBetween(Window.unboundedPreceding, -1)
    numbered = sources.select(F.col("source").alias("_source"), queue.alias("queue"))
    base = staged(spark, parts.join(numbered, F.col("source").eqNullSafe(F.col("_source")))
                  .select("part", "_source", "queue", F.coalesce(F.sum("m").over(order), F.lit(0)).alias("base"))
                  .withColumnRenamed("part", "_part"), "pack-base")
    plan = RoundRobin(totals, weights, window_sequences * sequence)
    placed = tokens.join(base, (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source"))) \
        .select("doc_id", "n", "ids", "queue", (F.col("base") + F.col("at")).alias("first"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, held = [], 0
            ids = b.column("ids")
            for i, r in enumerate(b.drop_columns(["ids"]).to_pylist()):
                n = r["n"]
                raw = ids[i].as_buffer()
                wide = np.frombuffer(raw, dtype=f"<u{raw.size // n}").astype("<u4").tobytes()
                for off, at, m in plan.runs(r["queue"], r["first"], n):
                    while m:
                        seq, place = divmod(at, sequence)
                        k = min(m, sequence - place)
                        rows.append((r["doc_id"], off, k, wide[off * 4:(off + k) * 4], n, seq, place))
                        off, at, m = off + k, at + k, m - k
                held += len(wide)
                if held > 16 << 20:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)

    return placed.mapInArrow(cut, "doc_id long, start long, length long, ids binary, doc_tokens long, "
                                  "sequence_id long, offset long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])


def op4_packing(spark, sf_dir):
    """Where every piece of every document is packed."""
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
