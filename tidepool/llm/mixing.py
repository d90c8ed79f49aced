"""Mixing sources to target weights by a low-discrepancy slot schedule.

Every source gets a target number of words. The schedule has one slot per
``block_words`` of the whole mix; slot ``i`` sits at the golden-ratio point
``i * A mod 2^31`` and belongs to the source whose cumulative share holds that
point, so any stretch of slots keeps the target proportions to within a few slots.
Slots are ranked per source, each source's documents are laid end to end in a
hash-shuffled order, and that line is cut into as many equal blocks as the source
has slots; the k-th block fills the k-th slot. A line shorter than its target is
read again from its start (the next epoch).

Only DataFrame operations are used. Running sums and ranks are two-level (inside
hash buckets or slot chunks, then over their totals), so a source with a third of
all rows is never in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import WORD, staged, table, word_count

LATTICE = 1 << 31
# Odd number next to 2^31 / golden ratio: its multiples visit every lattice point.
GOLDEN = 1327217885
BINS_SHIFT = 19          # 2^31 points in 4,096 bins
CHUNK_SHIFT = 12         # slots per ranking chunk
BUCKET_SHIFT = 52        # 4,096 hash buckets per source line


def source_targets(rows: DataFrame, weights: Sequence[float], epochs: float, cap: float) -> DataFrame:
    """One row per source: ``source, src, source_size, target``.

    Sources in code point order (null last) take ``weights`` in turn and share
    ``epochs`` times all words. No target exceeds ``cap`` times its source: the
    excess is shared again by weight, i.e. targets are ``min(cap * size, weight *
    level)`` for one level. With sources ordered by ``cap * size / weight``, the
    level is the largest of (words left) / (weights left) over all prefixes.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.col("src") % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    by_ratio = Window.partitionBy().orderBy(F.col("_most") / F.col("_w"), "src")
    return (rows.groupBy("source").agg(F.sum("size").alias("source_size"))
            .withColumn("src", F.row_number().over(
                Window.partitionBy().orderBy(F.col("source").asc_nulls_last())).cast("long") - 1)
            .withColumn("_w", w)
            .withColumn("_most", F.col("source_size") * F.lit(float(cap)))
            .withColumn("_want", F.sum("source_size").over(everything) * F.lit(float(epochs)))
            .withColumn("_full", F.coalesce(F.sum("_most").over(
                by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
            .withColumn("_left", F.sum("_w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
            .withColumn("_level", F.max((F.col("_want") - F.col("_full")) / F.col("_left")).over(everything))
            .select("source", "src", "source_size",
                    F.greatest(F.lit(0.0), F.least("_most", F.col("_w") * F.col("_level"))).alias("target")))


def schedule(targets: DataFrame, block_words: int) -> DataFrame:
    """Slots ranked per source: ``slot, src, k, n_slots, line, source_size``.

    ``line`` is the source's target in whole words. A source whose share is too
    narrow to hold any point gets one slot after the others.
    """
    spark = targets.sparkSession
    total = targets.agg(F.sum("target")).first()[0] or 0.0
    n = max(1, -(-int(total) // block_words))
    upto = F.sum("target").over(Window.partitionBy().orderBy("src"))
    shares = (targets.filter("target > 0")
              .withColumn("hi", F.floor(upto / F.lit(total or 1.0) * F.lit(float(LATTICE))).cast("long"))
              .withColumn("lo", F.lag("hi", 1, 0).over(Window.partitionBy().orderBy("src")))
              .withColumn("hi", F.when(F.lead("src").over(Window.partitionBy().orderBy("src")).isNull(),
                                       F.lit(LATTICE)).otherwise(F.col("hi")))
              .withColumn("line", F.floor(F.col("target") + 0.5).cast("long")))
    bins = shares.filter("hi > lo").select(
        "src", "lo", "hi",
        F.explode(F.sequence(F.shiftright("lo", BINS_SHIFT), F.shiftright(F.col("hi") - 1, BINS_SHIFT))).alias("bin"))
    points = (spark.range(0, n, 1, max(2, min(100_000, n >> 16)))
              .withColumn("p", F.col("id") % LATTICE * GOLDEN % LATTICE)
              .withColumn("bin", F.shiftright("p", BINS_SHIFT)))
    placed = (points.join(bins, "bin").filter("p >= lo and p < hi")
              .select(F.col("id").alias("slot"), "src", F.shiftright("id", CHUNK_SHIFT).alias("chunk")))
    sums = placed.groupBy("src", "chunk").agg(F.count("*").alias("m"))
    base = sums.select("src", "chunk", F.coalesce(F.sum("m").over(
        Window.partitionBy("src").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("base"))
    ranked = (placed.withColumn("r", F.row_number().over(Window.partitionBy("src", "chunk").orderBy("slot")))
              .join(base, ["src", "chunk"])
              .select("slot", "src", (F.col("base") + F.col("r") - 1).alias("k")))
    counts = shares.join(sums.groupBy("src").agg(F.sum("m").alias("m")), "src", "left")
    lone = counts.filter("m is null").select((F.col("src") + n).alias("slot"), "src", F.lit(0).cast("long").alias("k"))
    sizes = counts.select("src", "line", "source_size", F.coalesce("m", F.lit(1)).alias("n_slots"))
    return ranked.unionByName(lone).join(sizes, "src")


def _edge(k):
    """First word of block ``k`` of a source line."""
    return F.when(k >= F.col("n_slots"), F.col("line")).otherwise(
        F.floor(k * (F.col("line") / F.col("n_slots"))).cast("long"))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), epochs: float = 1.5, cap: float = 2.0,
        block_words: int = 1024, seed: int = 7, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """The mix of ``docs`` (doc_id, text, source): ``(lines, pieces)``.

    ``lines`` has one row per document: ``row, doc_id, source, size, src,
    source_size, target, off`` and the columns of ``keep``, named ``in_<name>``. ``pieces`` has one row
    per part of a document in the mix: ``slot, row, epoch, start, words`` (word
    offsets in the document); in slot order they are the mixed stream.

    Null text counts as empty; a document without words, or of a source without
    words, has no piece. Null sources form one source. Repeated rows are separate
    documents. No document is taken more than ``cap`` times. An empty table gives
    two empty results. The result depends on the rows and the seed only, up to the
    choice between rows that agree in doc_id, source and size.
    """
    spark = docs.sparkSession
    rows = staged(spark, docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id"), F.col("source"),
        word_count(F.col("text")).alias("size"), *[F.col(f"`{c}`").alias(f"in_{c}") for c in keep]), "mix-rows")
    sizes = rows.select("row", "doc_id", "source", "size")
    targets = staged(spark, source_targets(sizes, weights, epochs, cap), "mix-targets")
    slots = staged(spark, schedule(targets, block_words), "mix-slots")
    plan = slots.groupBy("src").agg(F.first("line").alias("line"), F.first("n_slots").alias("n_slots"))

    h = F.xxhash64(F.lit(seed), "doc_id", "size")
    t = targets.withColumnRenamed("source", "_source")
    hashed = (sizes.join(t, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
              .withColumn("h", h).withColumn("bucket", F.shiftright("h", BUCKET_SHIFT)))
    sums = hashed.groupBy("src", "bucket").agg(F.sum("size").alias("m"))
    base = sums.select("src", "bucket", F.coalesce(F.sum("m").over(
        Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("size").over(
        Window.partitionBy("src", "bucket").orderBy("h", "doc_id", "size", "row")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lines = staged(spark, hashed.withColumn("inside", inside).join(base, ["src", "bucket"])
                   .select("row", "doc_id", "source", "size", "src", "source_size", "target",
                           (F.col("base") + F.col("inside")).alias("off")), "mix-lines")

    passes = max(1, -(-int(cap * 1000) // 1000))
    spans = (lines.join(plan, "src").filter("size > 0")
             .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
             .withColumn("lo", F.col("off") + F.col("epoch") * F.col("source_size"))
             .withColumn("hi", F.least(F.col("lo") + F.col("size"), F.col("line")))
             .filter("hi > lo"))
    per = F.col("n_slots") / F.col("line")
    pieces = (spans.withColumn("k", F.explode(F.sequence(
                  F.greatest(F.lit(0), F.floor(F.col("lo") * per) - 1).cast("long"),
                  F.least(F.col("n_slots") - 1, F.floor(F.col("hi") * per) + 1).cast("long"))))
              .withColumn("a", F.greatest("lo", _edge(F.col("k"))))
              .withColumn("b", F.least("hi", _edge(F.col("k") + 1)))
              .filter("b > a")
              .select("row", "src", "epoch", "k", (F.col("a") - F.col("lo")).alias("start"),
                      (F.col("b") - F.col("a")).alias("words"))
              # Slots grow with the words and compress well on disk: their file size proves nothing.
              .join(slots.select("slot", "src", "k").hint("merge"), ["src", "k"])
              .select("slot", "row", "epoch", "start", "words"))
    if keep:
        lines = lines.join(rows.select("row", *[f"`in_{c}`" for c in keep]), "row")
    return lines, pieces


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a row per document and epoch.

    A document cut by the end of its source's share keeps the words taken, joined
    by single blanks; ``n_chars``, if there, then follows the text.
    """
    columns = docs.columns
    lines, pieces = mix(docs, keep=columns, **options)
    taken = pieces.groupBy("row", "epoch").agg(F.min("start").alias("start"), F.sum("words").alias("words"))
    part = F.array_join(F.slice(F.regexp_extract_all(F.col("in_text"), F.lit(WORD), F.lit(0)),
                                (F.col("start") + 1).cast("int"), F.col("words").cast("int")), " ")
    whole = F.col("words") == F.col("size")
    out = {"text": F.when(whole, F.col("in_text")).otherwise(part)}
    if "n_chars" in columns:
        out["n_chars"] = F.when(whole, F.col("in_n_chars")).otherwise(F.length(part)).cast(docs.schema["n_chars"].dataType)
    return lines.join(taken, "row").select(*[out.get(c, F.col(f"`in_{c}`")).alias(c) for c in columns])


def op1_mixing(spark, sf_dir):
    """Words that the mix takes of every document."""
    lines, pieces = mix(table(spark, sf_dir, "documents"))
    taken = pieces.groupBy("row").agg(F.sum("words").alias("taken"))
    return lines.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
