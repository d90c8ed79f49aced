"""Change-data records shaped like Debezium envelopes, and the startup modes.

A change record is ``(arrival, seq, topic, value)``: ``topic`` is
``<server>.<database>.<table>`` and ``value`` the JSON envelope
``{"before": {...}|null, "after": {...}|null, "op": "c|u|d|r|t", "source": {...}}``.
Reading the binlog itself is out of scope; on a cluster the envelopes come from a
topic (``tidepool.sources.topics``) or files. ``startup="initial"`` puts a snapshot
of the table (from parquet or JDBC) before the log, each row as op ``r``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Envelope op codes by change type (fixed Debezium values).
OP_CODES = {"insert": "c", "update": "u", "delete": "d", "read": "r", "truncate": "t"}

# Arrival given to snapshot rows: before every logged change.
SNAPSHOT_ARRIVAL = -1


def _op_code(type_: Column) -> Column:
    expr = F.lit(None).cast("string")
    for name, code in OP_CODES.items():
        expr = F.when(type_ == name, F.lit(code)).otherwise(expr)
    return expr


def envelopes(rows: DataFrame, server: str, database: str, table_col: str, type_col: str,
              columns: list[str], before: Column | None = None) -> DataFrame:
    """Typed change rows -> raw envelopes. ``columns`` form the ``after`` image, with
    explicit JSON nulls as a change source writes them; ``before`` defaults to null.
    """
    after = F.struct(*[F.col(c) for c in columns])
    env = F.struct(
        (before if before is not None else F.lit(None).cast("string")).alias("before"),
        after.alias("after"),
        _op_code(F.col(type_col)).alias("op"),
        F.struct(F.lit(database).alias("db"), F.col(table_col).alias("table")).alias("source"),
    )
    return rows.select(
        "arrival", "seq",
        F.concat_ws(".", F.lit(server), F.lit(database), F.col(table_col)).alias("topic"),
        F.to_json(env, {"ignoreNullFields": "false"}).alias("value"),
    )


def snapshot_envelopes(snapshot: DataFrame, server: str, database: str, table: str,
                       columns: list[str]) -> DataFrame:
    """A table's current rows as ``read`` changes; ``snapshot`` must carry a unique
    ``seq`` (its primary key)."""
    rows = (snapshot.withColumn("arrival", F.lit(SNAPSHOT_ARRIVAL).cast("long"))
                    .withColumn("_table", F.lit(table))
                    .withColumn("_type", F.lit("read")))
    return envelopes(rows, server, database, "_table", "_type", columns)


def only_tables(changes: DataFrame, database: str | None = None, tables: list[str] | None = None) -> DataFrame:
    """Changes of one database and, if given, of its named tables only. Records whose
    topic names no table are kept: normalisation rejects them with their text."""
    parts = F.split(F.col("topic"), r"\.")
    named = F.size(parts) >= 3
    keep = F.lit(True)
    if database:
        keep = keep & (F.try_element_at(parts, F.lit(2)) == database)
    if tables:
        keep = keep & F.try_element_at(parts, F.lit(3)).isin(tables)
    return changes.where(~named | keep)


def change_source(log: DataFrame, snapshot: DataFrame | None = None,
                  startup: str = "latest") -> DataFrame:
    """S2 startup modes: ``latest`` reads only the log; ``initial`` puts the snapshot
    first. Both inputs are raw envelopes; for a streaming log the snapshot is a stream
    over files of envelopes (``snapshot_stream``)."""
    if startup == "latest" or snapshot is None:
        return log
    if startup != "initial":
        raise ValueError(f"unknown startup mode {startup!r}")
    return snapshot.unionByName(log)


def snapshot_stream(spark: SparkSession, path: str, server: str, database: str, table: str,
                    key: str, columns: list[str]) -> DataFrame:
    """The initial snapshot of a table as a stream: its parquet files under ``path``,
    read once each, every row as op ``r`` with an arrival before the log. ``key`` is the
    table's numeric primary key, which orders the rows."""
    schema = spark.read.parquet(path).schema
    rows = (spark.readStream.schema(schema).parquet(path)
            .select(F.col(key).cast("long").alias("seq"), *[F.col(c).cast("string").alias(c) for c in columns]))
    return snapshot_envelopes(rows, server, database, table, columns)
