"""Registered queries of the change-data side (J3-J5, S2-S4, R*, K2, K4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators import cdc as C
from tidepool.operators import dims as D
from tidepool.operators import handover as H
from tidepool.operators import rules as R
from tidepool.operators.typed import normalize_typed
from tidepool.plans import db_jobs as DB
from tidepool.sources import changes as S
from tidepool.sources import fixtures as FX
from tidepool.sources.tables import table


def _changes(spark, sf_dir):
    return C.normalize(DB.ods_changes(spark, sf_dir))


def _fields(after="after"):
    return [F.col(after)[c].alias(c) for c in DB.ORDER_COLUMNS]


def _routed(spark, sf_dir):
    return DB.route_all(DB.ods_changes(spark, sf_dir), DB.rule_envelopes_fixed(spark))


def q_cdc_normalize(spark, sf_dir):
    return _changes(spark, sf_dir).select(
        "arrival", "seq", "database", "table_name", "type", *_fields(),
        F.cardinality("before").alias("n_before"), F.cardinality("after").alias("n_after"))


def q_cdc_initial_snapshot(spark, sf_dir):
    snap_rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"), F.col("o_custkey").cast("string").alias("id"),
        "o_orderpriority", "o_orderstatus")
    snap = S.snapshot_envelopes(snap_rows, FX.CDC_SERVER, FX.CDC_DATABASE, "orders",
                                DB.ORDER_COLUMNS)
    src = S.change_source(DB.ods_changes(spark, sf_dir), snap, startup="initial")
    return C.normalize(src).select("arrival", "seq", "type", "table_name", *_fields())


def handover_inputs(spark, sf_dir):
    """Snapshot rows, log and ranges of the hand-over, normalised."""
    snap = S.snapshot_envelopes(FX.handover_rows(spark, sf_dir), FX.CDC_SERVER, FX.CDC_DATABASE, "orders", DB.ORDER_COLUMNS)
    return C.normalize(snap), _changes(spark, sf_dir), FX.handover_ranges(spark, sf_dir)


def q_cdc_snapshot_handover(spark, sf_dir):
    """A snapshot taken while changes go on, each changed row once."""
    out = H.hand_over(*handover_inputs(spark, sf_dir), "orders", width=FX.HANDOVER_WIDTH)
    return out.select("arrival", "seq", "type", "table_name", *_fields())


def q_sql_changelog_select(spark, sf_dir):
    log_view, _ = C.register_table_views(spark, _changes(spark, sf_dir), "orders", DB.ORDER_COLUMNS)
    return spark.sql(f"select * from {log_view}")


def q_sql_current_state(spark, sf_dir):
    _, cur_view = C.register_table_views(spark, _changes(spark, sf_dir), "orders", DB.ORDER_COLUMNS)
    return spark.sql(f"select * from {cur_view}")


def q_rule_latest(spark, sf_dir):
    ev = DB.rule_events(DB.rule_envelopes_log(spark, sf_dir))
    return R.latest_rules(ev).select("source_table", "operate_type", "sink_type", "sink_table",
                                     "sink_columns", "rule_arrival")


def q_rule_lookup(spark, sf_dir):
    rules = R.latest_rules(DB.rule_events(DB.rule_envelopes_fixed(spark)))
    return (R.lookup(_changes(spark, sf_dir), rules).where("matched")
            .select("arrival", "seq", "type", "sink_type", "sink_table", "sink_columns"))


def q_rule_miss(spark, sf_dir):
    rules = R.latest_rules(DB.rule_events(DB.rule_envelopes_fixed(spark)))
    ch = _changes(spark, sf_dir)
    keys = rules.select(F.col("source_table").alias("table_name"), F.col("operate_type").alias("type"))
    # The optimizer broadcasts the keys if their measured size allows it.
    return ch.join(keys, ["table_name", "type"], "left_anti") \
             .select("arrival", "seq", "table_name", "type")


def q_rule_column_filter(spark, sf_dir):
    return (_routed(spark, sf_dir).where("matched")
            .select("arrival", "seq", "sink_table", *_fields(),
                    F.cardinality("after").alias("n_after")))


def q_rule_route(spark, sf_dir):
    return _routed(spark, sf_dir).select("arrival", "seq", "type", "route")


def q_rule_asof(spark, sf_dir):
    ev = DB.rule_events(DB.rule_envelopes_log(spark, sf_dir))
    out = R.lookup_asof(_changes(spark, sf_dir), ev)
    return out.select("arrival", "seq", "type", "rule_arrival", "sink_type", "sink_table",
                      R.route(F.col("matched"), F.col("sink_type")).alias("route"))


def q_dwd_fact_route(spark, sf_dir):
    return DB.fact_records(_routed(spark, sf_dir)).select(
        "arrival", "seq", "topic", *_fields(), F.cardinality("after").alias("n_fields"))


def q_dim_upsert(spark, sf_dir):
    cells, _ = DB.dim_cells(_routed(spark, sf_dir))
    return D.latest_cells(cells).select("sink_table", "row_key", "qualifier", "value", "arrival")


def q_dim_table(spark, sf_dir):
    cells, _ = DB.dim_cells(_routed(spark, sf_dir))
    return D.wide_dimension(cells, "dim_order", ["o_orderpriority", "o_orderstatus"])


def q_cdc_nonempty_after(spark, sf_dir):
    return C.drop_empty_after(_changes(spark, sf_dir)).select(
        "arrival", "seq", "type", F.cardinality("after").alias("n_after"))


def q_db_route(spark, sf_dir):
    return _routed(spark, sf_dir).select("route", "arrival", "seq", "type", "sink_table", *_fields())


def q_raw_log_landing(spark, sf_dir):
    from tidepool.sources.landing import land
    return land(FX.app_log_received(spark, sf_dir), "received_ms").select("dt", "seq", "value")


def q_cdc_kinds(spark, sf_dir):
    """P9 on every kind of envelope, deletes with a filled ``before`` among them."""
    n = C.normalize(FX.cdc_envelopes_kinds(spark, sf_dir)).where(F.col("reason").isNull())
    return n.select("arrival", "seq", "table_name", "type", F.cardinality("before").alias("n_before"),
                    F.cardinality("after").alias("n_after"), F.col("before")["id"].alias("id_before"),
                    F.col("after")["id"].alias("id_after"))


def q_cdc_typed_envelopes(spark, sf_dir):
    """P9 by the schema that every record carries."""
    n = normalize_typed(FX.typed_envelopes(spark, sf_dir))
    image = F.when(F.cardinality("after") > 0, F.col("after")).otherwise(F.col("before"))
    fine = [F.when(F.col("reason").isNull(), image[c]).alias(c) for c in
            ("l_orderkey", "l_linenumber", "price", "discount", "day", "at", "flags")]
    return n.select("seq", "table_name", "type", "reason", *fine)


def q_cdc_filled_after(spark, sf_dir):
    """P13 where it has something to drop."""
    n = C.normalize(FX.cdc_envelopes_kinds(spark, sf_dir)).where(F.col("reason").isNull())
    return C.drop_empty_after(n).select("arrival", "seq", "type")


def q_cdc_rejects(spark, sf_dir):
    return C.rejects(C.normalize(FX.cdc_envelopes_kinds(spark, sf_dir)))


def q_route_rejects(spark, sf_dir):
    """What the router can deliver nowhere, with the reason."""
    from tidepool.streaming.jobs import ROUTE_MISSES, fact_and_miss_records

    out = fact_and_miss_records(_routed(spark, sf_dir)).where(F.col("topic") == ROUTE_MISSES)
    return out.select("arrival", "seq", F.get_json_object("value", "$.reason").alias("reason"),
                      F.get_json_object("value", "$.type").alias("type"),
                      F.get_json_object("value", "$.after.id").alias("id"))


def _retiring(spark, sf_dir):
    return FX.rule_log_retiring(spark, sf_dir).withColumns(
        {"sink_pk": F.lit(None).cast("string"), "sink_extend": F.lit(None).cast("string")})


def q_rule_retired(spark, sf_dir):
    """R1 with rules that are retired and come back."""
    return R.latest_rules(_retiring(spark, sf_dir)).select("source_table", "operate_type", "sink_type", "rule_arrival")


def _asof_retired(spark, sf_dir, force):
    out = R.lookup_asof(_changes(spark, sf_dir), _retiring(spark, sf_dir), force=force)
    return out.select("arrival", "seq", "type", "sink_type", "sink_table",
                      R.route(F.col("matched"), F.col("sink_type")).alias("route"))


def q_rule_asof_retired(spark, sf_dir):
    return _asof_retired(spark, sf_dir, None)


def q_rule_asof_large(spark, sf_dir):
    """R2t's plan beyond the broadcast bound."""
    return _asof_retired(spark, sf_dir, "chunked")


QUERIES = {
    "cdc_kinds": q_cdc_kinds,
    "cdc_filled_after": q_cdc_filled_after,
    "cdc_typed_envelopes": q_cdc_typed_envelopes,
    "cdc_rejects": q_cdc_rejects,
    "route_rejects": q_route_rejects,
    "rule_retired": q_rule_retired,
    "rule_asof_retired": q_rule_asof_retired,
    "rule_asof_large": q_rule_asof_large,
    "cdc_normalize": q_cdc_normalize,
    "cdc_initial_snapshot": q_cdc_initial_snapshot,
    "cdc_snapshot_handover": q_cdc_snapshot_handover,
    "sql_changelog_select": q_sql_changelog_select,
    "sql_current_state": q_sql_current_state,
    "rule_latest": q_rule_latest,
    "rule_lookup": q_rule_lookup,
    "rule_miss": q_rule_miss,
    "rule_column_filter": q_rule_column_filter,
    "rule_route": q_rule_route,
    "rule_asof": q_rule_asof,
    "dwd_fact_route": q_dwd_fact_route,
    "dim_upsert": q_dim_upsert,
    "dim_table": q_dim_table,
    "cdc_nonempty_after": q_cdc_nonempty_after,
    "db_route": q_db_route,
    "raw_log_landing": q_raw_log_landing,
}
