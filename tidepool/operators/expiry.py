"""W3 in batch: daily unique visits whose state expires.

The state of a mid is the day of the entry last kept, and it expires ``ttl`` arrival
units after it was written, that is after the arrival of that entry. So an entry is
kept if it has another day than the last kept one, or arrives ``ttl`` or more later.

What is kept depends on what was kept before, which no lag expresses. But what would be
kept *next* after a kept entry is fixed: the first later entry of another day or of an
arrival at least ``ttl`` later, whichever comes first. Every entry so has one successor,
and the kept ones are those on the path from a mid's first entry.

Successors are found per (mid, chunk) of the arrival axis, with the nearest later entry
carried in from later chunks (``ordering``), so that a hot mid is many tasks. Paths are
followed by pointer doubling: round k takes the first 2^k kept entries of every mid to
the next 2^k, over joins on the unique ``seq``, which no mid skews. Rounds are the
logarithm of the most entries kept of a mid; their tables hold two numbers an entry and
shrink with every round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions.time import day_of, day_text
from tidepool.operators.logs import session_entry
from tidepool.operators.ordering import DEFAULT_CHUNK, DEFAULT_FANOUT, ORDER, carry_in, chunk_of
from tidepool.session import checkpoint_root

# Mirrored ``seq`` of a point in time before all entries that arrive at it.
FIRST = (1 << 63) - 1


def _scan(df: DataFrame, value: Column, present: Column, chunk_width: int, fanout: int, name: str) -> DataFrame:
    """``df`` with the last ``value`` of the rows before each that are ``present``, in arrival order, per mid."""
    marked = df.withColumn("_chunk", chunk_of(F.col("arrival"), chunk_width)) \
        .withColumn("_value", F.when(present, value)).withColumn("_has", present)
    before = Window.partitionBy("mid", "_chunk").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    here = marked.withColumn("_here", F.last("_value", ignorenulls=True).over(before))
    carry = carry_in(marked, ["mid"], "_chunk", F.col("_value"), F.col("_has"), fanout)
    return here.join(carry, ["mid", "_chunk"], "left").withColumn(name, F.coalesce("_here", "carry")) \
        .drop("_chunk", "_value", "_has", "_here", "carry")


def successors(entries: DataFrame, ttl: int, chunk_width: int = DEFAULT_CHUNK, fanout: int = DEFAULT_FANOUT) -> DataFrame:
    """``seq, next``: of every entry (mid, arrival, seq, day) the one kept next if it is kept; null if there is none."""
    first = _scan(entries, F.col("day"), F.lit(True), chunk_width, fanout, "before")
    turns = F.col("before").isNull() | (F.col("before") != F.col("day"))
    node = F.struct(F.col("arrival").alias("at"), F.col("seq").alias("id"))
    # The nearest later row is the nearest earlier one on the mirrored axis.
    rows = first.select("mid", (-F.col("arrival")).alias("arrival"), (-F.col("seq")).alias("seq"), F.col("seq").alias("of"),
                        turns.alias("turns"), F.lit(True).alias("entry"), node.alias("node"))
    ends = first.select("mid", (-F.col("arrival") - F.lit(ttl)).alias("arrival"), F.lit(FIRST).alias("seq"),
                        F.col("seq").alias("of"), F.lit(False).alias("turns"), F.lit(False).alias("entry"),
                        F.lit(None).cast("struct<at:bigint,id:bigint>").alias("node"))
    other_day = _scan(rows, F.col("node"), F.col("turns"), chunk_width, fanout, "next").select("of", "next")
    expired = (_scan(rows.unionByName(ends), F.col("node"), F.col("entry"), chunk_width, fanout, "next")
               .where(~F.col("entry")).select("of", "next"))
    return (other_day.unionByName(expired).groupBy("of").agg(F.min("next").alias("next"))
            .select(F.col("of").alias("seq"), F.col("next.id").alias("next")))


def on_paths(first: DataFrame, hops: DataFrame) -> DataFrame:
    """``seq`` of all nodes on the paths from ``first`` (seq) along ``hops`` (seq, next): pointer doubling."""
    reached, hops = first.select("seq").checkpoint(eager=True), hops.where(F.col("next").isNotNull()).checkpoint(eager=True)
    while True:
        new = reached.join(hops, "seq").select(F.col("next").alias("seq")).checkpoint(eager=True)
        if new.isEmpty():
            return reached
        reached = reached.unionByName(new).checkpoint(eager=True)
        twice = hops.select(F.col("seq").alias("next"), F.col("next").alias("after"))
        hops = hops.join(twice, "next").select("seq", F.col("after").alias("next")).checkpoint(eager=True)


def unique_visit_expiring(pages: DataFrame, ttl: int, chunk_width: int = DEFAULT_CHUNK,
                          fanout: int = DEFAULT_FANOUT) -> DataFrame:
    """W2 with W3: the kept session entries of parsed ``pages``, with ``day`` (text).

    Returns the columns of ``logs.unique_visit``. ``ttl`` is in units of ``arrival``
    (milliseconds for Kafka sources), so a replay of old records expires as it would have
    at their time. Results do not depend on ``chunk_width`` or ``fanout``.
    """
    if ttl <= 0:
        raise ValueError("ttl must be positive")
    checkpoint_root(pages.sparkSession)
    entries = pages.where(F.col("reason").isNull() & session_entry(F.col("last_page_id"))).withColumn("day", day_text(F.col("ts")))
    slim = entries.select("mid", "arrival", "seq", day_of(F.col("ts")).alias("day")).checkpoint(eager=True)
    first = slim.groupBy("mid").agg(F.min(F.struct(*ORDER)).alias("_first")).select(F.col("_first.seq").alias("seq"))
    return entries.join(on_paths(first, successors(slim, ttl, chunk_width, fanout)), "seq", "left_semi")
