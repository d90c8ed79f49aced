"""W1 and W2 started from history: batch over the first half, stream over the second."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from tidepool.operators import logs as L
from tidepool.plans import log_jobs
from tidepool.sources import fixtures as FX
from tidepool.sources import topics as T
from tidepool.streaming import jobs as SJ


def halves(raw):
    """The records before and after the middle of the log, in arrival order."""
    middle = raw.agg(F.percentile_approx("arrival", 0.5)).first()[0]
    return raw.where(F.col("arrival") <= middle), raw.where(F.col("arrival") > middle)


def streamed(spark, df, folder, parts=3):
    """``df`` as a stream of files in arrival order, one a batch."""
    rows = sorted(map(tuple, df.select("arrival", "seq", "value").collect()))
    for i in range(parts):
        some = rows[len(rows) * i // parts:len(rows) * (i + 1) // parts]
        spark.createDataFrame(some, "arrival long, seq long, value string").coalesce(1).write.parquet(f"{folder}/part_{i}")
    return (spark.readStream.schema("arrival long, seq long, value string").option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(folder))


def records(spark, root, topics):
    return sorted((t, r["seq"], r["value"]) for t in topics for r in T.read_topic(spark, root, t).collect())


def test_first_visits_go_on_from_batch(spark, workdir):
    raw = FX.app_log(spark, SF01)
    before, after = halves(raw)
    batch = log_jobs.detail_layer(before)
    root = os.path.join(workdir, "topics")
    q = SJ.start_log_job(spark, root, checkpoint=os.path.join(workdir, "ck"), source=streamed(spark, after, f"{workdir}/in"),
                         history=before)
    q.awaitTermination()
    whole = log_jobs.detail_layer(raw)
    of = lambda df: sorted((SJ.ROUTE_TOPICS[r["route"]], r["seq"], r["value"]) for r in df.select("route", "seq", "value").collect())
    got = sorted(of(batch) + records(spark, root, SJ.ROUTE_TOPICS.values()))
    assert got == of(whole)
    # Without its history the job would let devices claim again.
    again = SJ.start_log_job(spark, os.path.join(workdir, "bare"), checkpoint=os.path.join(workdir, "ck2"),
                             source=spark.readStream.schema("arrival long, seq long, value string")
                             .option("recursiveFileLookup", "true").parquet(f"{workdir}/in"))
    again.awaitTermination()
    assert sorted(of(batch) + records(spark, os.path.join(workdir, "bare"), SJ.ROUTE_TOPICS.values())) != of(whole)


def test_the_state_goes_on_after_a_restart(spark, workdir):
    """A job with history, stopped and started again from its checkpoint, does not read the history anew."""
    raw = FX.app_log(spark, SF01)
    before, after = halves(raw)
    later, latest = halves(after)
    root, check = os.path.join(workdir, "topics"), os.path.join(workdir, "ck")
    source = streamed(spark, later, f"{workdir}/in", 2)
    start = lambda src: SJ.start_log_job(spark, root, checkpoint=check, source=src, history=before).awaitTermination()
    start(source)
    rows = sorted(map(tuple, latest.select("arrival", "seq", "value").collect()))
    spark.createDataFrame(rows, "arrival long, seq long, value string").coalesce(1).write.parquet(f"{workdir}/in/z")
    start(source)
    whole = {(r["seq"], r["value"]) for r in log_jobs.detail_layer(raw).where("route = 'page'").select("seq", "value").collect()}
    seqs = {r["seq"] for r in after.select("seq").collect()}
    got = T.read_topic(spark, root, SJ.DWD_PAGE).collect()
    assert {(r["seq"], r["value"]) for r in got} == {x for x in whole if x[0] in seqs}


@pytest.mark.parametrize("ttl", [False])
def test_unique_visits_go_on_from_batch(spark, workdir, ttl):
    pages = log_jobs.page_topic(FX.app_log(spark, SF01)).select("arrival", "seq", "value")
    before, after = halves(pages)
    kept = {r["seq"] for r in L.unique_visit(L.parse_page_log(before)).collect()}
    root = os.path.join(workdir, "topics")
    SJ.start_uv_job(spark, root, checkpoint=os.path.join(workdir, "ck"), source=streamed(spark, after, f"{workdir}/in"),
                    history=before, ttl=ttl).awaitTermination()
    kept |= {r["seq"] for r in T.read_topic(spark, root, SJ.DWM_UV).collect()}
    assert kept == {r["seq"] for r in L.unique_visit(L.parse_page_log(pages)).collect()}


def test_states_of_history(spark):
    rows = [(1, 1, '{"common":{"mid":"a","is_new":"1"},"page":{"page_id":"p"},"ts":5}'),
            (2, 2, '{"common":{"mid":"a","is_new":"0"},"page":{"page_id":"p"},"ts":86400005}'),
            (3, 3, '{"common":{"mid":"b","is_new":"0"},"page":{"page_id":"p","last_page_id":"q"},"ts":5}'), (4, 4, "{bad")]
    raw = spark.createDataFrame(rows, "arrival long, seq long, value string")
    assert [r["mid"] for r in L.first_claims(L.parse_app_log(raw)).collect()] == ["a"]
    assert [tuple(r) for r in L.last_days(L.parse_page_log(raw)).collect()] == [("a", "1970-01-02")]
