"""Stream = batch for J1 and J2: the app log cut into files in arrival order,
processed one file per micro-batch with a stop and restart from the checkpoint
in between, gives the batch answers (SURVEY §5 item 3), for 1, 3 and 8 files."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from tidepool.operators import logs as L
from tidepool.plans import log_jobs
from tidepool.sources import fixtures as FX
from tidepool.sources import topics as T
from tidepool.streaming import jobs as SJ


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_log_and_uv_stream_equal_batch(spark, workdir, parts):
    root = os.path.join(workdir, "topics")
    raw = FX.app_log(spark, SF01)
    pdf = raw.toPandas().sort_values(["arrival", "seq"]).reset_index(drop=True)
    n = len(pdf)
    files = [pdf.iloc[round(i * n / parts):round((i + 1) * n / parts)] for i in range(parts)]
    ckpt = os.path.join(workdir, "ckpt_log")

    def drop(i):
        spark.createDataFrame(files[i], "arrival long, seq long, value string") \
            .coalesce(1).write.parquet(os.path.join(T.topic_path(root, SJ.ODS_LOG), f"batch_id={i}"))

    uv_ckpt = os.path.join(workdir, "ckpt_uv")
    first = max(1, (2 * parts) // 3)
    for i in range(first):
        drop(i)
    SJ.start_log_job(spark, root, checkpoint=ckpt, max_files_per_trigger=1).awaitTermination()
    # J2 consumes what J1 published so far, then stops; it resumes after J1's
    # restart. Files of one J1 batch are read in one J2 batch, so a mid's entries
    # are ordered inside the processor.
    SJ.start_uv_job(spark, root, checkpoint=uv_ckpt).awaitTermination()
    for i in range(first, parts):
        drop(i)
    SJ.start_log_job(spark, root, checkpoint=ckpt, max_files_per_trigger=1).awaitTermination()

    batch = log_jobs.detail_layer(raw)
    for route, topic in SJ.ROUTE_TOPICS.items():
        got = T.read_topic(spark, root, topic)
        want = batch.where(F.col("route") == route)
        assert got.count() == want.count(), route
    got_pages = T.read_topic(spark, root, SJ.DWD_PAGE)
    # The repaired flag survived the restart: same is_new per page record.
    got_new = L.parse_app_log(got_pages).select("seq", "is_new")
    want_new = batch.where(F.col("route") == "page").select("seq", "is_new")
    assert got_new.exceptAll(want_new).count() == 0
    assert want_new.exceptAll(got_new).count() == 0

    SJ.start_uv_job(spark, root, checkpoint=uv_ckpt).awaitTermination()
    uv = T.read_topic(spark, root, SJ.DWM_UV)
    if parts == 1:
        q = SJ.start_topic_console(spark, root, SJ.DWD_PAGE, num_rows=1,
                                   checkpoint=os.path.join(workdir, "ck_console"))
        q.awaitTermination()
        assert sum(p["numInputRows"] for p in q.recentProgress) == got_pages.count()
    want_uv = log_jobs.uv_from_pages(log_jobs.page_route(batch))
    assert uv.count() == want_uv.count() == 2404
    assert uv.agg(F.sum("seq")).first()[0] == 11835828


def test_first_visit_processor_across_arrow_batches(spark, workdir):
    """A mid whose claims span many Arrow batches, out of arrival order: only the
    earliest claim keeps "1"; after a restart every claim of that mid is repaired."""
    import random

    rnd = random.Random(7)
    rows = []
    for i in range(60):
        mid = "hot" if i % 5 else f"m{i}"
        rows.append((1000 - i // 2, i, '{"common":{"mid":"%s","is_new":"1"},"ts":1}' % mid))
    rnd.shuffle(rows)
    src = os.path.join(workdir, "claims")
    schema = "arrival long, seq long, value string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(os.path.join(src, "a"))
    prev = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        out = os.path.join(workdir, "claims_out")

        def run(name):
            stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
            q = (SJ.repaired_log(stream).select("arrival", "seq", "is_new", "repaired")
                 .writeStream.format("parquet").option("path", out)
                 .option("checkpointLocation", os.path.join(workdir, "ck_claims"))
                 .trigger(availableNow=True).start())
            q.awaitTermination()
            return {r.seq: (r.is_new, r.repaired) for r in spark.read.parquet(out).collect()}

        got = run("claims_a")
        hot = [(a, s) for a, s, v in rows if '"hot"' in v]
        first_hot = min(hot)[1]
        assert len(got) == 60
        assert spark.read.parquet(out).count() == 60
        for a, s, v in rows:
            keeps = s == first_hot or '"hot"' not in v
            assert got[s] == (("1", False) if keeps else ("0", True)), s
        spark.createDataFrame([(5000, 100, '{"common":{"mid":"fresh","is_new":"1"},"ts":1}'),
                               (4000, 101, '{"common":{"mid":"hot","is_new":"1"},"ts":1}')],
                              schema).write.parquet(os.path.join(src, "b"))
        got2 = run("claims_b")
        assert got2[101] == ("0", True)
        assert got2[100] == ("1", False)
        assert spark.read.parquet(out).count() == 62
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", prev)
