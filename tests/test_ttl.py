"""With a TTL on the unique-visit state, a same-day entry arriving after the
stored day expired is kept again (Q17); without a TTL it is not. A TTL query in
ProcessingTime mode keeps making batches, so it is stopped explicitly (H4)."""

import os
import time

from tidepool.streaming import jobs as SJ

SCHEMA = "arrival long, seq long, value string"
ENTRY = '{"common":{"mid":"a"},"page":{"page_id":"p"},"ts":1000}'


def _wait_rows(q, n, deadline_s=60):
    """Poll progress until ``n`` input rows were processed; a TTL query never goes
    idle, so ``processAllAvailable`` cannot be used (H4)."""
    end = time.time() + deadline_s
    while time.time() < end:
        if sum(p["numInputRows"] for p in q.recentProgress) >= n:
            return
        time.sleep(0.2)
    raise AssertionError(f"query did not process {n} rows in {deadline_s}s")


def _run(spark, workdir, name, ttl_ms):
    src = os.path.join(workdir, name)
    os.makedirs(src)
    stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(src)
    q = (SJ.unique_visits(stream, ttl_ms).writeStream.format("memory").queryName(name)
         .option("checkpointLocation", os.path.join(workdir, "ck_" + name))
         .outputMode("append").trigger(processingTime="300 milliseconds").start())
    try:
        spark.createDataFrame([(1, 1, ENTRY)], SCHEMA).write.parquet(os.path.join(src, "a"))
        _wait_rows(q, 1)
        time.sleep(3)
        spark.createDataFrame([(2, 2, ENTRY)], SCHEMA).write.parquet(os.path.join(src, "b"))
        _wait_rows(q, 2)
        time.sleep(1)
    finally:
        q.stop()
    return sorted(r.seq for r in spark.table(name).collect())


def test_ttl_expiry_keeps_same_day_again(spark, workdir):
    assert _run(spark, workdir, "uv_ttl", 1000) == [1, 2]


def test_without_ttl_same_day_is_dropped(spark, workdir):
    assert _run(spark, workdir, "uv_nottl", None) == [1]
