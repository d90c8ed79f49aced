"""J3 (change ingestion), J4 (rule-driven routing) and J5 (SQL over a change
table) in batch form, over raw change envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators import cdc as C
from tidepool.operators import dims as D
from tidepool.operators import rules as R
from tidepool.sources import changes as S
from tidepool.sources import fixtures as FX

ORDER_COLUMNS = ["id", "o_orderpriority", "o_orderstatus"]
RULE_TABLE = "table_process"


def ods_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture change log as raw envelopes (what the change source emits)."""
    rows = FX.cdc_rows(spark, sf_dir)
    return S.envelopes(rows, FX.CDC_SERVER, FX.CDC_DATABASE, "table_name", "type", ORDER_COLUMNS)


def rule_envelopes_fixed(spark: SparkSession) -> DataFrame:
    """The fixed rules as the initial snapshot of the rule table (op ``r``)."""
    return S.snapshot_envelopes(FX.rules(spark), FX.CDC_SERVER, FX.CDC_DATABASE, RULE_TABLE,
                                FX.RULE_COLUMNS)


def rule_envelopes_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders-derived rule history as rule-table changes."""
    rows = FX.rule_log(spark, sf_dir).withColumn("_t", F.lit(RULE_TABLE)) \
                                      .withColumn("_type", F.lit("insert"))
    return S.envelopes(rows, FX.CDC_SERVER, FX.CDC_DATABASE, "_t", "_type", FX.RULE_COLUMNS)


def rule_events(rule_env: DataFrame) -> DataFrame:
    """S2 -> P9 -> P12 for the rule table."""
    n = C.normalize(rule_env)
    return R.bind_rules(n.where(F.col("table_name") == RULE_TABLE))


def route_all(changes_env: DataFrame, rule_env: DataFrame) -> DataFrame:
    """Normalise changes (P9), fold rules (R1), look up (R2), trim (P10), add
    the sink table (P11), route (R3). One row per change, with ``route``."""
    changes = C.normalize(changes_env).where(F.col("reason").isNull())
    rules = R.latest_rules(rule_events(rule_env))
    return R.route_changes(changes, rules)


def fact_records(routed: DataFrame) -> DataFrame:
    """K2: records for the dynamic-topic sink: topic = sink table, payload = the
    trimmed ``after`` as JSON."""
    return (routed.where(F.col("route") == R.SINK_KAFKA)
            .select("arrival", "seq", F.col("sink_table").alias("topic"), "after",
                    F.to_json("after").alias("value")))


def dim_cells(routed: DataFrame, honour_sink_pk: bool = False) -> tuple[DataFrame, DataFrame]:
    """K4 input: cells of the records routed to dimension tables, and rejects."""
    return D.cells(routed.where(F.col("route") == R.SINK_HBASE), honour_sink_pk=honour_sink_pk)
