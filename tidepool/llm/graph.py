"""Connected components of links, as joins and aggregations over the edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` of every node of ``edges`` (a, b: long); label is the smallest node reached.

    Alternates large-star steps (a node's larger neighbours point to its smallest)
    and small-star steps (a node and its smaller neighbours point to the smallest)
    until the edges are stars, about log n rounds. Each round is written to the
    shared folder; only an edge count and checksum reach the driver. Minima are
    combined before they are shuffled, and a node with many neighbours is split by
    the adaptive skew join. Nulls and self links are ignored; no edges give no rows.
    """
    spark = edges.sparkSession
    e = staged(spark, edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .distinct(), "edges")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = staged(spark, both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .distinct(), "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        e = staged(spark, small.select("a", F.col("m").alias("b"))
                   .unionByName(small.select(F.col("b").alias("a"), F.col("m").alias("b")))
                   .filter("a <> b").distinct(), "small-star")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("label")) \
        .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
