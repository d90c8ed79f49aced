"""Change-envelope normalisation (P9), the null-``after`` filter (P13) and the SQL
views over a change table (S3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions import json as J

ENVELOPE = ("struct<before: map<string,string>, after: map<string,string>, op: string, "
            "_corrupt_record: string>")

# Change types by envelope op, short codes and long names (create -> insert).
OP_TYPES = {"c": "insert", "create": "insert", "r": "read", "u": "update",
            "d": "delete", "t": "truncate", "m": "message"}

MALFORMED = "malformed"
BAD_TOPIC = "bad_topic"
NO_OP = "no_op"              # an object without an op is no change envelope


def normalize(raw: DataFrame, strict: bool = False) -> DataFrame:
    """``(arrival, seq, topic, value)`` -> ``(arrival, seq, database, table_name,
    type, before, after, reason, raw)``.

    The topic's second and third dot-separated parts are the database and table;
    ``before``/``after`` become MAP<STRING,STRING> without null entries (Q12), the
    last value of a repeated key, an empty map when absent; the op is lower-cased and ``create``/``c`` become
    ``insert``. Rows that cannot be read get a ``reason`` instead of failing the
    job and keep what was received as ``raw`` (topic, value); ``strict=True`` fails
    on malformed envelopes (P2).
    """
    # Permissive parsing gives a struct of nulls for malformed text;
    # the corrupt-record field is what tells a malformed envelope apart.
    opts = {"mode": "FAILFAST"} if strict else {"columnNameOfCorruptRecord": "_corrupt_record"}
    # Parse in its own projection so every field below reads one parsed struct.
    raw = J.evaluate_once(raw, F.from_json(F.col("value"), ENVELOPE, opts), "_env",
                          ["arrival", "seq", "topic", "value"])
    env = F.col("_env")
    parts = F.split(F.col("topic"), r"\.")
    op = F.lower(env["op"])
    type_ = F.coalesce(F.try_element_at(F.create_map(*[x for k, v in OP_TYPES.items()
                                                   for x in (F.lit(k), F.lit(v))]), op), op)
    empty = F.create_map().cast("map<string,string>")
    ok = (env.isNotNull() & env["_corrupt_record"].isNull()
          & J.opens_object(F.col("value")))
    reason = F.when(~ok, F.lit(MALFORMED)).when(F.size(parts) < 3, F.lit(BAD_TOPIC)).when(op.isNull(), F.lit(NO_OP))
    out = raw.select(
        "arrival", "seq",
        F.try_element_at(parts, F.lit(2)).alias("database"),
        F.try_element_at(parts, F.lit(3)).alias("table_name"),
        type_.alias("type"),
        F.coalesce(J.drop_null_values(J.last_wins(env["before"])), empty).alias("before"),
        F.coalesce(J.drop_null_values(J.last_wins(env["after"])), empty).alias("after"),
        reason.alias("reason"),
        F.when(reason.isNotNull(), F.struct("topic", "value")).alias("raw"),
    )
    return out


def rejects(changes: DataFrame) -> DataFrame:
    """Normalised rows that could not be read: ``arrival, seq, reason, topic, value``."""
    return changes.where(F.col("reason").isNotNull()).select(
        "arrival", "seq", "reason", F.col("raw.topic").alias("topic"), F.col("raw.value").alias("value"))


def reject_json() -> Column:
    """The text published for a reject: why, and what was received."""
    return F.to_json(F.struct("reason", F.col("raw.topic").alias("topic"), F.col("raw.value").alias("value")))


def record_json() -> Column:
    """P4 for the ods_base_db topic: a normalised record as JSON text."""
    return F.to_json(F.struct("database", F.col("table_name").alias("tableName"),
                              "before", "after", "type"))


def as_json(changes: DataFrame) -> DataFrame:
    """``(arrival, seq, value)`` with the normalised record as JSON text."""
    return changes.select("arrival", "seq", record_json().alias("value"))


def drop_empty_after(changes: DataFrame) -> DataFrame:
    """P13 (off by default in the jobs): drop changes whose ``after`` is empty."""
    return changes.where(F.cardinality("after") > 0)


def table_changelog(changes: DataFrame, table: str, columns: list[str],
                    not_null: list[str] = ("id",)) -> tuple[DataFrame, DataFrame]:
    """S3: the changes of one table projected to its declared columns, and the rows that
    violate a NOT NULL column, with the ``reason`` ``null_<column>``. Batch or stream.

    Every change has its ``op`` and order; the row image is ``after``, or ``before`` for a
    change with an empty ``after`` (a delete).
    """
    image = F.when(F.cardinality("after") > 0, F.col("after")).otherwise(F.col("before"))
    log = (changes.where(F.col("reason").isNull() & (F.col("table_name") == table))
                  .select("arrival", "seq", F.col("type").alias("op"),
                          *[image[c].alias(c) for c in columns]))
    broken = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"null_{c}")) for c in not_null], F.lit(None).cast("string"))
    rejects = log.withColumn("reason", broken).where(F.col("reason").isNotNull())
    for c in not_null:
        log = log.where(F.col(c).isNotNull())
    return log, rejects


def folded_retractions(rows: DataFrame) -> DataFrame:
    """The table that a stream of retractions stands for: ``rows`` holds ``kind`` (``+I``,
    ``-U``, ``+U``, ``-D``) and a row image. An image is in the table as often as it was
    added more than taken back; sums commute, so the order of rows plays no part."""
    image = [c for c in rows.columns if c != "kind"]
    sign = F.when(F.col("kind").startswith("+"), 1).otherwise(-1)
    return rows.groupBy(*image).agg(F.sum(sign).alias("_n")).where(F.col("_n") > 0).drop("_n")


def register_table_views(spark: SparkSession, changes: DataFrame, table: str,
                         columns: list[str], not_null: list[str] = ("id",)) -> tuple[str, str]:
    """S3: declare a SQL table over a change stream as temp views.

    ``<table>_changelog``: every change of ``table`` projected to the declared
    columns, with its ``op`` and order; the row image is ``after``, or ``before`` for
    a change with an empty ``after`` (a delete). Rows violating a NOT NULL column
    are in ``<table>_rejects`` instead, with the ``reason`` ``null_<column>``.
    ``<table>_current``: the table the change log converges to, latest change per
    key, deleted keys absent. One partial aggregate per key, no window.
    """
    log, rejects = table_changelog(changes, table, columns, not_null)
    rejects.createOrReplaceTempView(f"{table}_rejects")
    changelog_view = f"{table}_changelog"
    current_view = f"{table}_current"
    log.createOrReplaceTempView(changelog_view)
    key = not_null[0]
    rest = [c for c in columns if c != key]
    latest = ", ".join(f"r.{c} as {c}" for c in rest)
    spark.sql(f"""
        select {key}{', ' + latest if latest else ''}
        from (select {key}, max_by(named_struct('op', op{''.join(f", '{c}', {c}" for c in rest)}),
                                   named_struct('arrival', arrival, 'seq', seq)) as r
              from {changelog_view} group by {key})
        where r.op <> 'delete'
    """).createOrReplaceTempView(current_view)
    return changelog_view, current_view
