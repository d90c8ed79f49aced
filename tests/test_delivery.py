"""Records read once although sent twice (K1, K2), and positions of jobs over restarts."""

import os
import time

from pyspark.sql import functions as F

from tidepool.sources import topics as T
from tidepool.streaming import jobs as SJ
from tidepool.streaming import positions as P

RECORDS = "topic string, arrival long, seq long, value string"


def drain(df, path, check):
    df.writeStream.format("parquet").option("path", path).option("checkpointLocation", check) \
        .trigger(availableNow=True).start().awaitTermination()


def test_a_batch_sent_twice_is_read_once(spark, workdir):
    root = os.path.join(workdir, "topics")
    sink = T.AppendedTopics(root, producer="p1")
    batch = [("a", 1000 * i, i, f"v{i}") for i in range(20)] + [("a", 5000, 5, "v5"), ("b", 1000, 1, "v1")]   # one record twice
    df = spark.createDataFrame(batch, RECORDS)
    sink.write(df, 0)
    sink.write(df.repartition(5), 0)                    # the same batch again, in another order
    sink.write(df, 1)                                   # another batch with equal records
    T.AppendedTopics(root, producer="p2").write(df, 0)  # another producer
    out, check = f"{workdir}/out", f"{workdir}/ck"
    drain(T.once(T.read_appended(spark, root, "a", max_files_per_trigger=1)), out, check)
    read = spark.read.parquet(out)
    assert read.count() == 3 * 21 and read.select("id").distinct().count() == 63
    assert T.read_appended(spark, root, "a", stream=False).count() == 4 * 21
    # Once more after a restart of the reader.
    sink.write(df, 1)
    sink.write(spark.createDataFrame([("a", 30_000, 99, "new"), ("a", -5, 98, "late")], RECORDS), 2)
    drain(T.once(T.read_appended(spark, root, "a", max_files_per_trigger=1)), out, check)
    assert spark.read.parquet(out).count() == 65             # a record of an old arrival is not lost


def test_records_without_an_id_pass(spark, workdir):
    path = f"{workdir}/topics/topic=a"
    spark.createDataFrame([(1, 1, "x", None), (1, 1, "x", None), (2, 2, "y", "i"), (2, 2, "y", "i")],
                          "arrival long, seq long, value string, id string").write.parquet(path)
    drain(T.once(T.read_appended(spark, f"{workdir}/topics", "a")), f"{workdir}/out", f"{workdir}/ck")
    assert sorted(r["value"] for r in spark.read.parquet(f"{workdir}/out").collect()) == ["x", "x", "y"]


def test_positions_have_neither_gap_nor_overlap_over_restarts(spark, workdir):
    path, root = f"{workdir}/positions", f"{workdir}/topics"
    listener = P.PositionTable(spark, path)
    spark.streams.addListener(listener)

    def add(i):
        (spark.createDataFrame([(i, i, '{"common":{"mid":"a"},"page":{"page_id":"p"},"ts":1}')], "arrival long, seq long, value string")
         .coalesce(1).write.parquet(f"{root}/topic={SJ.ODS_LOG}/batch_id={i}"))

    def run():
        SJ.start_log_job(spark, root, checkpoint=f"{workdir}/ck", max_files_per_trigger=1).awaitTermination()

    try:
        for i in range(3):
            add(i)
        run()
        for i in range(3, 5):
            add(i)
        run()
        for _ in range(100):                            # reports come after their batches
            if os.path.isdir(path) and P.positions(spark, path).count() >= 5:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    t = P.positions(spark, path)
    rows = t.orderBy("batch_id").collect()
    assert [r["batch_id"] for r in rows] == list(range(5)) and all(r["records"] > 0 for r in rows)
    assert len({r["query_id"] for r in rows}) == 1 and len({r["run_id"] for r in rows}) == 2
    assert {r["job"] for r in rows} == {"log_job"} and P.breaks(t).count() == 0
    lost = t.where("batch_id <> 2")
    assert [r["batch_id"] for r in P.breaks(lost).collect()] == [3]
    twice = t.withColumn("start_offset", F.when(F.col("batch_id") == 4, F.lit("0")).otherwise(F.col("start_offset")))
    assert [r["batch_id"] for r in P.breaks(twice).collect()] == [4]
