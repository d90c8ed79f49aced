"""Positions and lag of running jobs, as a table.

A listener writes, for every micro-batch and source of the session's streaming jobs, where
the batch began and ended in the source, the newest position the source knew of, and how
many records came. One small file a batch and query, under the batch's id, so that a batch
reported twice is there once. Records are counted as Spark reports them: a source that a
job's plan reads in two branches counts twice.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = ("job string, run_id string, at string, source int, description string, start_offset string, end_offset string, "
          "latest_offset string, records long, behind double, query_id string, batch_id long")


class PositionTable(StreamingQueryListener):
    """Register with ``spark.streams.addListener``; ``positions`` reads what it wrote."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        rows = [(p.get("name"), p["runId"], p["timestamp"], i, s["description"], _text(s.get("startOffset")), _text(s.get("endOffset")),
                 _text(s.get("latestOffset")), s.get("numInputRows"), _behind(s)) for i, s in enumerate(p["sources"])]
        if not any(r[5] != r[6] for r in rows):
            return                                # an idle report of a batch that is written already
        schema = SCHEMA[:SCHEMA.index(", query_id")]
        (self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite")
         .parquet(f"{self.path}/query_id={p['id']}/batch_id={p['batchId']}"))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def _text(offset) -> str | None:
    return None if offset is None else offset if isinstance(offset, str) else json.dumps(offset, sort_keys=True)


def _behind(source: dict) -> float | None:
    """Records (offsets) that a Kafka reader is behind the newest one, on average over partitions."""
    value = (source.get("metrics") or {}).get("avgOffsetsBehindLatest")
    return None if value is None else float(value)


def positions(spark: SparkSession, path: str) -> DataFrame:
    """Every batch of every job: positions and lag by source."""
    return spark.read.schema(SCHEMA).parquet(path)


def breaks(table: DataFrame) -> DataFrame:
    """Batches that do not begin where the batch before ended: a gap or an overlap. Across
    restarts too, as a job's query keeps its id with its checkpoint."""
    w = Window.partitionBy("query_id", "source").orderBy("batch_id")
    return (table.withColumn("before", F.lag("end_offset").over(w)).withColumn("last", F.lag("batch_id").over(w))
            .where(F.col("last").isNotNull() & (~F.col("before").eqNullSafe(F.col("start_offset"))
                                                | (F.col("batch_id") != F.col("last") + 1))))
