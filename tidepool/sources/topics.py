"""Topics of text records.

On a cluster a topic is a Kafka topic: ``arrival`` is the record timestamp (ms)
and ``seq`` packs (partition, offset), so ``(arrival, seq)`` is the order the
reference consumes in. Jobs read from and write to either Kafka (``read_kafka``,
``KafkaTopics``) or files (``read_topic``, ``FileTopics``); the Kafka connector is
not installed in this image, so the tests run on files.

A file topic is a folder ``<root>/topic=<topic>/producer=<id>/batch_id=<n>/`` of
parquet ``(arrival, seq, value)`` files. A micro-batch writes all its topics in one
job, partitioned by topic, producer and batch, with dynamic partition overwrite:
a retried batch replaces exactly its own output (at-least-once delivery becomes
effectively-once), and no producer touches another's. The producer is the id of
the streaming query, which its checkpoint keeps: a query started anew with another
checkpoint counts its batches from 0 again, but as another producer.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TOPIC_SCHEMA = "arrival long, seq long, value string, producer string, batch_id long"

# Offsets are packed under the partition number: 2^40 offsets per partition.
OFFSET_BITS = 40


def read_kafka(spark: SparkSession, topic: str, servers: str, stream: bool = True,
               starting: str = "latest", options: dict | None = None,
               with_topic: bool = False, group: str | None = None, with_id: bool = False) -> DataFrame:
    """S1 on Kafka: UTF-8 values with their arrival order. ``starting`` maps the
    reference's startup modes (``latest`` / ``earliest``). ``with_topic`` keeps the
    record's topic, which names the source table for change envelopes (S2).
    ``with_id`` gives the id header of records written by ``KafkaTopics``, for ``once``.
    ``group`` is the consumer group; a stream's position is in its checkpoint, so the
    group only names the reader to the broker."""
    options = dict(options or {})
    if group:
        options["kafka.group.id"] = group
    r = spark.readStream if stream else spark.read
    if with_id:
        r = r.option("includeHeaders", "true")
    df = (r.format("kafka").option("kafka.bootstrap.servers", servers)
          .option("subscribe", topic).option("startingOffsets", starting)
          .options(**options).load())
    return df.select(
        F.unix_millis(F.col("timestamp")).alias("arrival"),
        (F.shiftleft(F.col("partition").cast("long"), OFFSET_BITS) + F.col("offset")).alias("seq"),
        *([F.col("topic")] if with_topic else []),
        F.col("value").cast("string").alias("value"),
        *([F.filter("headers", lambda h: h["key"] == "id")[0]["value"].cast("string").alias("id")] if with_id else []))


def topic_path(root: str, topic: str) -> str:
    return os.path.join(root, f"topic={topic}")


def read_topic(spark: SparkSession, root: str, topic: str, stream: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 file stand-in: ``(arrival, seq, value)`` of a topic folder."""
    path = topic_path(root, topic)
    if stream:
        r = spark.readStream.schema(TOPIC_SCHEMA)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        df = r.parquet(path)
    else:
        df = spark.read.schema(TOPIC_SCHEMA).parquet(path)
    return df.select("arrival", "seq", "value")


def producer_of(df: DataFrame) -> str:
    """The id of the streaming query that handles this micro-batch; ``batch`` outside one."""
    return df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def write_topics(df: DataFrame, root: str, batch_id: int, producer: str | None = None) -> None:
    """K1 / K2 file stand-in: records ``(topic, arrival, seq, value)``, each to its
    own topic, in one job; only the ``(topic, producer, batch_id)`` folders of this
    batch are replaced."""
    (df.select("topic", "arrival", "seq", "value")
       .withColumn("producer", F.lit(producer or producer_of(df)))
       .withColumn("batch_id", F.lit(batch_id).cast("long"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("topic", "producer", "batch_id").parquet(root))


class FileTopics:
    """Topics as folders under ``root``."""

    def __init__(self, root: str, producer: str | None = None):
        self.root, self.producer = root, producer

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Records ``(topic, arrival, seq, value)`` of one micro-batch."""
        write_topics(df, self.root, batch_id, self.producer)


def with_ids(df: DataFrame, batch_id: int, producer: str | None = None) -> DataFrame:
    """Records with an ``id`` that a retry of their batch gives again, and no other record has.

    Made of the producer, the batch and the record's place and text; records of a batch
    that are alike in all of these are numbered, so that none is taken for another.
    """
    alike = Window.partitionBy("topic", "arrival", "seq", "value").orderBy(F.lit(1))
    return df.select("topic", "arrival", "seq", "value").withColumn("id", F.concat_ws(
        "/", F.lit(producer or producer_of(df)), F.lit(str(batch_id)), F.coalesce(F.col("arrival").cast("string"), F.lit("")),
        F.coalesce(F.col("seq").cast("string"), F.lit("")), F.hex(F.xxhash64("topic", "value")),
        F.row_number().over(alike).cast("string")))


def once(records: DataFrame, within: str = "1 hour") -> DataFrame:
    """A stream of records (..., id) without those delivered again.

    A record is known again for at least ``within`` after it was first read, by the time
    of the reading batch: no record is late by that clock, so none is dropped for its
    age. Older ids are forgotten, so the state is as large as what is read in that time.
    Records without an id (of another producer) pass as often as they come.
    """
    known = (records.where(F.col("id").isNotNull()).withColumn("_at", F.current_timestamp())
             .withWatermark("_at", within).dropDuplicatesWithinWatermark(["id"]).drop("_at"))
    return known.unionByName(records.where(F.col("id").isNull()))


class KafkaTopics:
    """Topics on a Kafka cluster. A retried batch is delivered again (at least once), each
    record with the id it had as a header, by which ``once`` drops it (exactly once for
    readers through ``read_kafka(with_id=True)``)."""

    def __init__(self, servers: str, options: dict | None = None, producer: str | None = None):
        self.servers, self.options, self.producer = servers, options or {}, producer

    def write(self, df: DataFrame, batch_id: int) -> None:
        """K1 and K2: each record to the topic it names."""
        header = F.array(F.struct(F.lit("id").alias("key"), F.col("id").cast("binary").alias("value")))
        (with_ids(df, batch_id, self.producer).select("topic", "value", header.alias("headers")).write.format("kafka")
         .option("kafka.bootstrap.servers", self.servers).options(**self.options).save())


class AppendedTopics:
    """Topics as folders to which batches are only ever added: what a broker does, in files.
    A batch written twice is there twice, with the same ids."""

    def __init__(self, root: str, producer: str | None = None):
        self.root, self.producer = root, producer

    def write(self, df: DataFrame, batch_id: int) -> None:
        with_ids(df, batch_id, self.producer).write.mode("append").partitionBy("topic").parquet(self.root)


def read_appended(spark: SparkSession, root: str, topic: str, stream: bool = True,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """``arrival, seq, value, id`` of a topic of ``AppendedTopics``."""
    r = (spark.readStream if stream else spark.read).schema("arrival long, seq long, value string, id string")
    if stream and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(topic_path(root, topic))


def read_dynamic_topic(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """Read back one topic that records named themselves (K2)."""
    return read_topic(spark, root, topic)
