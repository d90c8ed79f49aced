"""Sharding by histogram sort: probe, count, refine, then exchange once.

Rows are ordered by a 64-bit hash of the text, so equal texts share a key. To cut
that order into shards of near-equal bytes, every round counts the exact bytes
below each probe key (one partial count per partition, summed) and keeps, for each
wanted splitter, the two neighbouring probes around it; the next round probes
inside. Only probes and their counts reach the driver, never keys. When every
splitter meets the tolerance, or no key lies between its two probes, the rows are
exchanged once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import staged, table

LOWEST, HIGHEST = -(1 << 63), 1 << 63


def _bytes_below(keys: DataFrame, probes: list[int]) -> list[int]:
    """Exact bytes of rows with a key below each of the sorted probes."""
    edges = np.array(probes, dtype=np.int64)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = np.zeros(len(edges) + 1, dtype=np.int64)
        for b in batches:
            np.add.at(acc, np.searchsorted(edges, b["_key"].to_numpy(), side="right"), b["size"].to_numpy())
        yield pd.DataFrame({"i": np.arange(len(acc)), "m": acc})

    rows = (keys.select("_key", "size").mapInPandas(count, "i long, m long")
            .groupBy("i").agg(F.sum("m").alias("m")).collect())
    acc = [0] * (len(probes) + 1)
    for r in rows:
        acc[r["i"]] = r["m"]
    return np.cumsum(acc[:-1]).tolist()


def _refined(keys: DataFrame, n_shards: int, tolerance: float, probes: int) -> tuple[list[int], list[int]]:
    """``n_shards - 1`` ascending keys, and the keys that alone hold more than a shard's share.

    Each splitter's bytes below are within ``tolerance`` of a shard's share from
    the ideal, or it is the nearest key boundary there is.
    """
    total = keys.agg(F.sum("size")).first()[0] or 0
    share = total / n_shards
    want = [share * j for j in range(1, n_shards)]
    low = [(LOWEST, 0)] * len(want)
    high = [(HIGHEST, total)] * len(want)

    def best(j):
        return min(low[j], high[j], key=lambda x: abs(x[1] - want[j]))

    while True:
        todo = [j for j in range(len(want)) if high[j][0] - low[j][0] > 1
                and abs(best(j)[1] - want[j]) > tolerance * share]
        if not todo:
            break
        points = set()
        for j in todo:
            a, b = low[j][0], high[j][0]
            points.update(p for i in range(1, probes + 1) if a < (p := a + (b - a) * i // (probes + 1)) < b)
        ordered = sorted(points)
        below = _bytes_below(keys, ordered)
        for j in todo:
            for p, n in zip(ordered, below, strict=True):
                if low[j][0] < p < high[j][0]:
                    if n <= want[j]:
                        low[j] = (p, n)
                    else:
                        high[j] = (p, n)
                        break
    heavy = {a[0] for a, b in zip(low, high, strict=True) if b[0] - a[0] == 1 and b[1] - a[1] > share}
    return sorted(min(max(best(j)[0], LOWEST), HIGHEST - 1) for j in range(len(want))), sorted(heavy)


def splitters(keys: DataFrame, n_shards: int, tolerance: float, probes: int) -> tuple[list[int], list[int]]:
    """Ascending splitters between the first shards, and the keys that have a shard of their own.

    A key that holds more than a shard's share gets one of the last shards to itself, and
    the other keys share the remaining ones: shard j holds their keys from splitter j to
    the next. What remains is cut anew until no key exceeds the share that is left.
    """
    alone: list[int] = []
    while True:
        rest = keys.filter(~F.col("_key").isin(alone)) if alone else keys
        cuts, heavy = _refined(rest, n_shards - len(alone), tolerance, probes)
        if not heavy or len(alone) + len(heavy) >= n_shards:
            return cuts, alone
        alone += heavy


def shard(docs: DataFrame, n_shards: int = 16, tolerance: float = 0.001, probes: int = 255) -> DataFrame:
    """All rows of ``docs`` (doc_id, text, ...) with their shard and place in it.

    Adds ``size`` (UTF-8 bytes plus 1), ``text_crc32``, ``law`` ('bytes'),
    ``shard``, ``slot`` (gapless from 0 in its shard, in key order by bucket) and
    ``grown_shard`` (null); columns of these names are replaced, all others pass.
    Null text counts as empty. Equal texts, repeated rows among them, stay in one
    shard; a group larger than a shard's share has a shard to itself, and the other rows
    share the others evenly. An empty table gives an empty result.

    The slot is a two-level rank: inside 1/4,096 of the key range and 1/16 of the
    doc_id hashes (a group of equal texts is spread over 16 tasks), on top of the
    counts of the earlier buckets.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col("text"), F.lit(""))
    own = {"size", "text_crc32", "law", "shard", "slot", "grown_shard"}
    kept = [c for c in docs.columns if c not in own]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"in_{c}") for c in kept], "doc_id",
                       (F.octet_length(body) + 1).cast("long").alias("size"),
                       F.crc32(body.cast("binary")).alias("text_crc32"),
                       F.xxhash64(body).alias("_key"), F.xxhash64("doc_id", F.lit(16)).alias("_tie"))
    keys = staged(spark, rows.select("_key", "_tie", "size"), "shard-keys")
    cuts, alone = splitters(keys, n_shards, tolerance, probes)

    def placed(df: DataFrame) -> DataFrame:
        at = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: c <= F.col("_key"))) \
            if cuts else F.lit(0)
        for i, key in enumerate(alone):
            at = F.when(F.col("_key") == key, len(cuts) + 1 + i).otherwise(at)
        return (df.withColumn("shard", at)
                .withColumn("_hi", F.shiftright("_key", 52)).withColumn("_lo", F.shiftrightunsigned("_tie", 60)))

    bucket = ["shard", "_hi", "_lo"]
    counts = placed(keys).groupBy(*bucket).agg(F.count("*").alias("_m"))
    before = Window.partitionBy("shard").orderBy("_hi", "_lo").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(*bucket, F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*bucket).orderBy("_key", "_tie", "doc_id")
    return (placed(rows).withColumn("_r", F.row_number().over(inside)).join(base, bucket)
            .withColumn("slot", (F.col("_base") + F.col("_r") - 1).cast("long"))
            .select(*[F.col(f"`in_{c}`").alias(c) for c in kept], "size", "text_crc32", F.lit("bytes").alias("law"),
                    "shard", "slot", F.lit(None).cast("int").alias("grown_shard")))


def write_shards(shards: DataFrame, path: str) -> None:
    """One folder of Parquet files per shard."""
    shards.write.partitionBy("shard").parquet(path)


def op6_sharding(spark, sf_dir):
    """Shard and slot of every document."""
    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
