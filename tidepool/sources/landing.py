"""Raw log landing. Each received log line is kept as a bare line in a
dataset partitioned by the day it was received, and forwarded unchanged to the
ods topic. The HTTP endpoint in front of it is not part of this engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.time import day_text

# Bytes of a file are numbered below its place among all files received.
FILE_BITS = 38


def land(received: DataFrame, received_ms_col: str) -> DataFrame:
    """Adds ``dt`` (``yyyy-MM-dd`` of receipt, session zone); the text is untouched."""
    return received.withColumn("dt", day_text(F.col(received_ms_col)))


def received_lines(spark: SparkSession, incoming: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the lines of files dropped in ``incoming``, with where they came from."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.text(incoming).select(
        "value", F.col("_metadata.file_path").alias("path"),
        F.unix_millis("_metadata.file_modification_time").alias("received_ms"),
        F.col("_metadata.file_block_start").alias("block"))


def in_order(lines: DataFrame, first_file: int = 0) -> DataFrame:
    """``arrival, seq, value, received_ms`` of one batch of received lines, numbered
    by ``line`` (increasing within a split).

    Lines are received when their file was: arrival is the file's modification
    time, which a retry finds again. ``seq`` numbers the lines by file (time, then
    path, from ``first_file`` on: the files of earlier batches come before) and place in it, so
    lines of two batches differ even if their files have one time. A line's place is its split's first byte plus its number
    in the split, which never reaches the next split's first byte. The tables of
    files and splits hold one row each, so they are small beside the lines.
    """
    splits = lines.groupBy("received_ms", "path", "block").agg(F.min("line").alias("first"))
    files = F.sort_array(F.collect_set(F.struct("received_ms", "path")))
    ranks = (lines.select("received_ms", "path").distinct().agg(files.alias("files"))
             .select(F.posexplode("files").alias("file", "f")).select("file", "f.received_ms", "f.path"))
    at = ["received_ms", "path"]
    return (lines.join(splits, [*at, "block"]).join(ranks, at)
            .select(F.col("received_ms").alias("arrival"),
                    (F.shiftleft(F.col("file").cast("long") + F.lit(first_file), FILE_BITS) + F.col("block")
                     + F.col("line") - F.col("first")).alias("seq"), "value", "received_ms"))


def write_landing(landed: DataFrame, path: str, batch_id: int) -> None:
    """The daily files: bare lines, one folder per ``dt`` and batch; a retried batch
    replaces its own folders. Needs ``dt`` and ``value``."""
    (landed.select("dt", F.lit(batch_id).cast("long").alias("batch_id"), "value")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt", "batch_id").text(path))


def files_before(spark: SparkSession, folder: str, batch_id: int) -> int:
    """Files received before this batch: the number that the batch before it left."""
    if batch_id == 0:
        return 0
    row = spark.read.schema("files long").json(f"{folder}/batch_id={batch_id - 1}").first()
    return row["files"]


def keep_files(spark: SparkSession, folder: str, batch_id: int, files: int) -> None:
    """Record the files received by the end of this batch; only the last two records are needed."""
    spark.createDataFrame([(files,)], "files long").coalesce(1).write.mode("overwrite").json(f"{folder}/batch_id={batch_id}")
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/batch_id={batch_id - 2}")
    old.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(old, True)
