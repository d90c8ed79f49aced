"""Streams whose work is bounded: rules kept between batches, files a batch, places that stay unique."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tidepool.operators import cdc as C
from tidepool.operators import rules as R
from tidepool.sources import topics as T
from tidepool.streaming import jobs as SJ

EVENTS = "arrival long, seq long, " + ", ".join(f"{c} string" for c in R.RULE_FIELDS) + ", retired boolean"


def write_rules(spark, root, events, batch_id, producer="p"):
    (spark.createDataFrame(events, EVENTS).withColumn("producer", F.lit(producer)).withColumn("batch_id", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("producer", "batch_id")
     .parquet(SJ._rule_path(root)))


def rule(n, key, sink, retired=False):
    return (n, n, "orders", key, sink, f"t{n}", "id", None, None, retired)


def changes(spark, rows):
    return spark.createDataFrame(rows, "arrival long, seq long, table_name string, type string")


def looked(df, *args, **kw):
    return sorted(((r["arrival"], r["type"], r["rule_arrival"], r["sink_table"]) for r in R.lookup_asof(df, *args, **kw).collect()), key=str)


def test_rules_kept_between_batches_equal_the_whole_log(spark, workdir):
    """Random rule and change batches, late ones of both kinds among them."""
    rnd = random.Random(3)
    history, n, batch = SJ.RuleHistory(spark, workdir), 0, 0
    assert history.since(None)[0].count() == 0
    low = 0
    for step in range(8):
        if step not in (3, 5):
            events = [rule(n + i, rnd.choice("abc"), rnd.choice(["kafka", "hbase"]), rnd.random() < 0.2) for i in range(0, 40, 2)]
            if step == 6:
                events.append(rule(5, "a", "kafka"))              # comes long after its arrival
            write_rules(spark, workdir, events, batch, producer="pq"[step % 2])
            batch += 1
        first = low if step != 7 else 1                            # the last batch has late changes
        rows = [(rnd.randint(first, n + 45), i, "orders", rnd.choice("abcd")) for i in range(60)]
        reads = history.reads
        events, plan = history.since(min(r[0] for r in rows))
        df = changes(spark, rows)
        assert looked(df, events, **plan) == looked(df, SJ.rule_log(spark, workdir))
        assert history.reads - reads == (0 if step in (3, 5, 7) else 1) or step == 7
        n += 40
        low = max(r[0] for r in rows) - 30
    assert history.held.count() < SJ.rule_log(spark, workdir).count()


def test_latest_rules_kept_between_batches(spark, workdir):
    history = SJ.RuleHistory(spark, workdir)
    for b in range(3):
        write_rules(spark, workdir, [rule(10 * b + i, "ab"[i % 2], "kafka", b == 1 and i == 3) for i in range(4)], b)
        want = sorted(map(tuple, SJ.current_rules(spark, workdir).collect()))
        assert sorted(map(tuple, R.latest_rules(history.latest()).collect())) == want
    assert history.held.count() == 2 and history.reads == 3
    history.latest()
    assert history.reads == 3


def test_files_a_batch_and_unique_places(spark, workdir):
    """Files of two batches that share their time: every line has its own place, in order of batches."""
    incoming, root = os.path.join(workdir, "in"), os.path.join(workdir, "topics")
    os.makedirs(incoming)
    for i in range(5):
        path = os.path.join(incoming, f"f{i}.log")
        with open(path, "w") as f:
            f.write("".join(f"line {i} {j}\n" for j in range(20)))
        os.utime(path, (1_700_000_000, 1_700_000_000))
    start = lambda: SJ.start_landing_job(spark, incoming, root, os.path.join(workdir, "land"),
                                         checkpoint=os.path.join(workdir, "ck"), max_files_per_trigger=2)
    q = start()
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 3
    with open(os.path.join(incoming, "f5.log"), "w") as f:
        f.write("line 5 0\n")
    os.utime(os.path.join(incoming, "f5.log"), (1_700_000_000, 1_700_000_000))
    start().awaitTermination()
    rows = sorted((r["arrival"], r["seq"], r["value"]) for r in T.read_topic(spark, root, SJ.ODS_LOG).collect())
    assert len(rows) == len({r[:2] for r in rows}) == 101
    assert {r["files"] for r in spark.read.schema("files long").json(os.path.join(root, "_landing", "*")).collect()} <= {4, 5, 6}
    of = [r[2].split()[1] for r in rows]
    assert all(of[i] == of[i + 1] or of[i + 1] not in of[:i + 1] for i in range(len(of) - 1))     # files are not mixed
    assert of[-1] == "5"


@pytest.mark.parametrize("text,reason", [('{"x":1}', "no_op"), ('{"op":null,"after":{"id":"1"}}', "no_op"),
                                         ('{"op":"c","after":{"id":"1"}}', None), ("[1]", "malformed")])
def test_an_object_without_an_op_is_no_envelope(spark, text, reason):
    out = C.normalize(spark.createDataFrame([(1, 1, "s.d.t", text)], "arrival long, seq long, topic string, value string"))
    r = out.first()
    assert r["reason"] == reason and (reason is None or r["raw"]["value"] == text)
