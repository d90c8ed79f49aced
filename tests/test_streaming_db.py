"""Stream = batch for J3 and J4, and the S4 landing job."""

import os

from pyspark.sql import functions as F

from conftest import SF01
from tidepool.operators import dims as D
from tidepool.plans import db_jobs as DB
from tidepool.plans import db_queries as DQ
from tidepool.sources import fixtures as FX
from tidepool.sources import topics as T
from tidepool.streaming import jobs as SJ

ENV_SCHEMA = "arrival long, seq long, topic string, value string"


def _drop(spark, df, path, parts):
    pdf = df.toPandas().sort_values(["arrival", "seq"]).reset_index(drop=True)
    n = len(pdf)
    for i in range(parts):
        chunk = pdf.iloc[round(i * n / parts):round((i + 1) * n / parts)]
        spark.createDataFrame(chunk, ENV_SCHEMA).coalesce(1) \
            .write.parquet(os.path.join(path, f"part_{i}"))


def test_cdc_and_routing_stream_equal_batch(spark, workdir):
    root = os.path.join(workdir, "topics")
    incoming = os.path.join(workdir, "binlog")
    _drop(spark, DB.ods_changes(spark, SF01), incoming, 3)
    changes = spark.readStream.schema(ENV_SCHEMA).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(incoming)
    SJ.start_cdc_job(spark, root, changes,
                     checkpoint=os.path.join(workdir, "ck_cdc")).awaitTermination()
    assert T.read_topic(spark, root, SJ.ODS_DB).count() == 15000

    rules_in = os.path.join(workdir, "rules_in")
    DB.rule_envelopes_fixed(spark).coalesce(1).write.parquet(rules_in)
    rule_stream = spark.readStream.schema(ENV_SCHEMA).parquet(rules_in)
    store = D.DimStore(spark, os.path.join(workdir, "dims"), database="dims_stream")
    SJ.start_rule_job(spark, root, rule_stream, dims=store,
                      checkpoint=os.path.join(workdir, "ck_rules")).awaitTermination()
    assert SJ.current_rules(spark, root).count() == 3
    # K3: the dimension rule created its dimension view.
    assert spark.catalog.tableExists("dims_stream.dim_order")
    SJ.start_route_job(spark, root, store,
                       checkpoint=os.path.join(workdir, "ck_route")).awaitTermination()

    facts = T.read_dynamic_topic(spark, root, "dwd_order_info")
    assert facts.count() == 6000
    got = store.current().select("sink_table", "row_key", "qualifier", "value")
    want = DQ.q_dim_upsert(spark, SF01).select("sink_table", "row_key", "qualifier", "value")
    assert got.count() == 2895
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # The wide dimension (FIXTURES §5): 1,480 keys, 2,895 non-null cells.
    wide = spark.table("dims_stream.dim_order")
    assert wide.columns == ["row_key", "o_orderpriority", "o_orderstatus"]
    assert wide.count() == 1480
    assert wide.select(F.sum(F.col("o_orderpriority").isNotNull().cast("int")
                             + F.col("o_orderstatus").isNotNull().cast("int"))).first()[0] == 2895

    # Compaction folds the appended history to one row per cell, same content.
    store.compact(["dim_order"])
    assert spark.table(store.table).count() == 2895
    again = store.current().select("sink_table", "row_key", "qualifier", "value")
    assert again.exceptAll(want).count() == 0 and want.exceptAll(again).count() == 0

    # The same change stream printed to the console; every row goes through.
    changes2 = spark.readStream.schema(ENV_SCHEMA).option("recursiveFileLookup", "true") \
        .parquet(incoming)
    q = SJ.start_console_job(spark, changes2, checkpoint=os.path.join(workdir, "ck_console"),
                             num_rows=2)
    q.awaitTermination()
    assert sum(p["numInputRows"] for p in q.recentProgress) == 15000


def test_landing_job(spark, workdir):
    incoming = os.path.join(workdir, "incoming")
    root = os.path.join(workdir, "topics")
    landing = os.path.join(workdir, "landing")
    FX.app_log_received(spark, SF01).select("value").coalesce(2).write.text(incoming)
    SJ.start_landing_job(spark, incoming, root, landing,
                         checkpoint=os.path.join(workdir, "ck_land")).awaitTermination()
    landed = spark.read.text(landing)
    assert landed.count() == 10000
    assert "dt" in landed.columns
    ods = T.read_topic(spark, root, SJ.ODS_LOG)
    assert ods.count() == 10000
    assert ods.select("arrival", "seq").distinct().count() == 10000


def test_route_job_uses_rule_in_force_at_arrival(spark, workdir):
    """Rule changes interleaved with the changes, all in one micro-batch: each
    change is routed by the rule in force at its arrival (R2t), equal to batch."""
    from conftest import SF001

    root = os.path.join(workdir, "topics")
    incoming = os.path.join(workdir, "binlog")
    _drop(spark, DB.ods_changes(spark, SF001), incoming, 1)
    rules_in = os.path.join(workdir, "rules_in")
    DB.rule_envelopes_log(spark, SF001).coalesce(1).write.parquet(rules_in)
    SJ.start_rule_job(spark, root, spark.readStream.schema(ENV_SCHEMA).parquet(rules_in),
                      checkpoint=os.path.join(workdir, "ck_rules")).awaitTermination()
    changes = spark.readStream.schema(ENV_SCHEMA).option("recursiveFileLookup", "true") \
        .parquet(incoming)
    SJ.start_cdc_job(spark, root, changes,
                     checkpoint=os.path.join(workdir, "ck_cdc")).awaitTermination()
    store = D.DimStore(spark, os.path.join(workdir, "dims"), database="dims_asof")
    SJ.start_route_job(spark, root, store,
                       checkpoint=os.path.join(workdir, "ck_route")).awaitTermination()

    want = DQ.q_rule_asof(spark, SF001)
    got = spark.read.parquet(root).where(~F.col("topic").isin(SJ.SYSTEM_TOPICS))
    missed = T.read_topic(spark, root, SJ.ROUTE_MISSES)
    assert missed.count() == want.where(~F.col("route").isin("kafka", "hbase")).count() > 0
    want_kafka = want.where(F.col("route") == "kafka")
    assert got.count() == want_kafka.count() > 0
    assert (got.select("seq", "topic").exceptAll(
        want_kafka.select("seq", F.col("sink_table").alias("topic"))).count() == 0)
