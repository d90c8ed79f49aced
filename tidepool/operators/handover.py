"""Hand-over from an initial snapshot to the change log while changes go on.

A table is cut into ranges of its numeric primary key. The log's position is recorded
before (``low``) and after (``high``) the rows of a range are read. So a row was read
somewhere between both positions: log records up to ``low`` are in it, those after
``high`` are not, and those of the window between may be or not. The last record of a
key within its window therefore takes the place of the row that was read; all earlier
records are left out, and later ones follow as they are. A row changed during the
snapshot counts once, whenever it was read.

Positions are arrivals of the log. All functions work on normalised changes (P9).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.sizing import checked_broadcast
from tidepool.operators.ordering import chunk_of

RANGE_SCHEMA = "range long, low long, high long"
# Keys of a range.
RANGE_WIDTH = 1 << 16
# Truncations of one table during its snapshot; each is compared with every range.
MAX_TRUNCATIONS = 1000

COLUMNS = ["arrival", "seq", "database", "table_name", "type", "before", "after", "reason", "raw"]


def key_of(changes: DataFrame, key: str) -> Column:
    """The numeric primary key of a change, from its new image or else the old one; null if there is none."""
    return F.coalesce(F.col("after")[key], F.col("before")[key]).try_cast("long")


def record_ranges(spark: SparkSession, read: Callable[[int, int], DataFrame], position: Callable[[], int],
                  lowest: int, highest: int, path: str, width: int = RANGE_WIDTH, together: int = 1) -> DataFrame:
    """Snapshot a table under ``path``, ``together`` ranges of keys at a time; returns its ranges.

    ``read(first, end)`` gives the rows with keys from ``first`` up to but not including
    ``end`` and ``position()`` the log's last position. Each lot is written to its own
    folder and its ranges after it, so a snapshot started again goes on behind the last
    complete lot and reads the others anew, with new windows.
    """
    done = {r["range"] for r in ranges_of(spark, path).select("range").collect()}
    for lot in range(lowest // width, highest // width + 1, together):
        if lot in done:
            continue
        low = position()
        read(lot * width, (lot + together) * width).write.mode("overwrite").parquet(f"{path}/rows/lot={lot}")
        high = position()
        spark.createDataFrame([(r, low, high) for r in range(lot, lot + together)], RANGE_SCHEMA).coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/ranges/lot={lot}")
    return ranges_of(spark, path)


def made(spark: SparkSession, path: str) -> str:
    """``path`` as a folder that exists, so that a reader before the first write finds it empty."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(p)
    return path


def ranges_of(spark: SparkSession, path: str) -> DataFrame:
    """The ranges recorded so far by ``record_ranges``."""
    return spark.read.schema(RANGE_SCHEMA + ", lot long").parquet(made(spark, f"{path}/ranges")).drop("lot")


def with_range(changes: DataFrame, ranges: DataFrame, key: str, width: int) -> DataFrame:
    """``changes`` with ``_key`` and the ``_range, _low, _high`` of its range (null if it was not read)."""
    small, _ = checked_broadcast(ranges.select(F.col("range").alias("_range"), F.col("low").alias("_low"),
                                               F.col("high").alias("_high")))
    return changes.withColumn("_key", key_of(changes, key)) \
        .withColumn("_range", chunk_of(F.col("_key"), width)).join(small, "_range", "left")


def in_window() -> Column:
    return (F.col("arrival") > F.col("_low")) & (F.col("arrival") <= F.col("_high"))


def truncations(changes: DataFrame, table: str) -> list[int]:
    """Positions at which ``table`` was emptied."""
    rows = (changes.where(F.col("reason").isNull() & (F.col("table_name") == table) & (F.col("type") == "truncate"))
            .select("arrival").distinct().limit(MAX_TRUNCATIONS + 1).collect())
    if len(rows) > MAX_TRUNCATIONS:
        raise ValueError(f"{table} was truncated more than {MAX_TRUNCATIONS} times during its snapshot")
    return sorted(r["arrival"] for r in rows)


def reconciled(rows: DataFrame, window: DataFrame, emptied: Iterable[int] = ()) -> DataFrame:
    """One ``read`` change per key that a range holds at its ``high`` position.

    ``rows`` (the snapshot) and ``window`` (log records of the windows) come from
    ``with_range``; each key keeps its last record, a row read counting before the records
    of its window. Keys whose last record deletes them are gone, as are those from before
    a truncation (``emptied``) within the window. A partial aggregate per key.
    """
    image = F.struct("database", "table_name", "type", "after", "arrival")

    def each_of(df: DataFrame, step: int, position: str) -> DataFrame:
        at = F.struct(F.lit(step).alias("step"), F.col(position).alias("position"), F.col("seq").alias("seq"))
        return df.select("_key", "_range", "_low", "_high", at.alias("_at"), image.alias("_image"), F.col(position).alias("_from"))

    each = each_of(rows, 0, "_low").unionByName(each_of(window, 1, "arrival"))
    last = each.groupBy("_key", "_range", "_low", "_high").agg(F.max_by(F.struct("_image", "_from"), "_at").alias("_last"))
    cleared = F.filter(F.array(*[F.lit(p).cast("long") for p in emptied]).cast("array<long>"),
                       lambda p: (p > F.col("_low")) & (p <= F.col("_high")) & (p >= F.col("_last._from")))
    last = last.where((F.col("_last._image.type") != "delete") & (F.size(cleared) == 0))
    return last.select(F.col("_high").alias("arrival"), F.col("_key").alias("seq"), F.col("_last._image.database").alias("database"),
                       F.col("_last._image.table_name").alias("table_name"), F.lit("read").alias("type"),
                       F.create_map().cast("map<string,string>").alias("before"), F.col("_last._image.after").alias("after"),
                       F.lit(None).cast("string").alias("reason"),
                       F.lit(None).cast("struct<topic:string,value:string>").alias("raw"))


def is_row_change(table: str) -> Column:
    """Whether a change (with its ``_key``) is one row of ``table``; all others pass the hand-over as they are."""
    return F.coalesce(F.col("reason").isNull() & (F.col("table_name") == table) & F.col("_key").isNotNull(), F.lit(False))


def hand_over(snapshot: DataFrame, log: DataFrame, ranges: DataFrame, table: str, key: str = "id",
              width: int = RANGE_WIDTH) -> DataFrame:
    """S2, startup ``initial``: the snapshot of ``table`` and the log as one stream of changes.

    Every key that its range holds at its high position comes once as ``read``, with that
    position as arrival and its key as seq; log records up to the high position of
    their range are left out, all later ones follow as they are. Records of other
    tables, rejects and records without a numeric key pass; so do records of keys whose
    range was not read. Rows of a range that is not in ``ranges`` (its lot is not
    complete) are left out.
    """
    placed = with_range(log, ranges, key, width)
    mine = is_row_change(table)
    behind = ~mine | F.col("_high").isNull() | (F.col("arrival") > F.col("_high"))
    rows = with_range(snapshot, ranges, key, width).where(F.col("_high").isNotNull())
    reads = reconciled(rows, placed.where(mine & in_window()), truncations(log, table))
    return reads.unionByName(placed.where(behind).select(*COLUMNS))
