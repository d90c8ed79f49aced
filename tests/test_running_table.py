"""S3 as a running table: the fold of its retractions is the current view after every batch."""

import json
import os
import random

from pyspark.sql import functions as F

from conftest import SF001
from tidepool.operators import cdc as C
from tidepool.plans import db_jobs as DB
from tidepool.sources import topics as T
from tidepool.streaming import jobs as SJ

ENV = "arrival long, seq long, topic string, value string"


def play(spark, workdir, parts, columns, table, chunk_width=1024):
    """Batch by batch through one checkpoint; yields what was read so far."""
    root, check, seen = os.path.join(workdir, "topics"), os.path.join(workdir, "ck"), []
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, ENV).coalesce(1).write.parquet(f"{workdir}/in/part_{i}")
        seen += rows
        src = spark.readStream.schema(ENV).option("recursiveFileLookup", "true").parquet(f"{workdir}/in")
        SJ.start_table_job(spark, root, src, table, columns, checkpoint=check, chunk_width=chunk_width).awaitTermination()
        yield root, seen


def view(spark, rows, columns, table):
    _, current = C.register_table_views(spark, C.normalize(spark.createDataFrame(rows, ENV)), table, columns)
    return sorted(map(tuple, spark.sql(f"select {', '.join(columns)} from {current}").collect()), key=str)


def test_fold_equals_the_current_view_after_every_batch(spark, workdir):
    """A hot key, deletes, updates to the same row, late changes, nulls and rejects."""
    rnd, parts, n = random.Random(5), [], 0
    for b in range(4):
        rows = []
        for _ in range(300):
            n += 1
            key = 1 if rnd.random() < 0.5 else rnd.randrange(2, 40)
            at = n if rnd.random() < 0.9 else max(1, n - rnd.randrange(400))       # some come late
            op = rnd.choice("cuuud")
            v = rnd.choice(["a", "b", None])
            image = json.dumps({"id": str(key), "v": v})
            rows.append((at, n, "s.d.t", f'{{"before":{image if op == "d" else "null"},"after":{"null" if op == "d" else image},"op":"{op}"}}'))
        rows += [(n, 10_000 + b, "s.d.t", '{"after":{"v":"x"},"op":"c"}'), (n, 20_000 + b, "s.d.t", "{oops"),
                 (n, 30_000 + b, "s.d.other", '{"after":{"id":"1","v":"z"},"op":"c"}')]
        rnd.shuffle(rows)
        parts.append(rows)
    for root, seen in play(spark, workdir, parts, ["id", "v"], "t", chunk_width=64):
        got = sorted(map(tuple, SJ.current_table(spark, root, "t", ["id", "v"]).collect()), key=str)
        assert got == view(spark, seen, ["id", "v"], "t")
    out = [json.loads(r["value"]) for r in T.read_topic(spark, root, SJ.table_topic("t")).collect()]
    kinds = {k: sum(r["kind"] == k for r in out) for k in ("+I", "-U", "+U", "-D")}
    assert kinds["-U"] == kinds["+U"] > 0 and kinds["-D"] > 0 and all("v" in r["row"] for r in out)
    dirty = [json.loads(r["value"])["reason"] for r in T.read_topic(spark, root, SJ.DIRTY_DB).collect()]
    assert sorted(dirty) == ["malformed"] * 4 + ["null_id"] * 4


def test_the_whole_orders_table(spark, workdir):
    rows = sorted(map(tuple, DB.ods_changes(spark, SF001).select("arrival", "seq", "topic", "value").collect()))
    parts = [rows[:500], rows[500:]]
    for root, seen in play(spark, workdir, parts, DB.ORDER_COLUMNS, "orders"):
        got = sorted(map(tuple, SJ.current_table(spark, root, "orders", DB.ORDER_COLUMNS).select(*DB.ORDER_COLUMNS).collect()), key=str)
        assert got == view(spark, seen, DB.ORDER_COLUMNS, "orders")


def test_fold_of_retractions(spark):
    rows = [("+I", "1", None), ("-U", "1", None), ("+U", "1", "a"), ("+I", "2", "b"), ("-D", "2", "b"), ("+I", "3", None)]
    out = C.folded_retractions(spark.createDataFrame(rows, "kind string, id string, v string"))
    assert sorted(map(tuple, out.collect())) == [("1", "a"), ("3", None)]
    assert C.folded_retractions(out.withColumn("kind", F.lit("+I")).limit(0)).collect() == []
