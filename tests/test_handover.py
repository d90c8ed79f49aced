"""The initial snapshot handed over to the log while changes go on."""

import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF01, SF001
from tidepool.operators import cdc as C
from tidepool.operators import handover as H
from tidepool.plans import db_jobs as DB
from tidepool.plans import db_queries as DQ
from tidepool.sources import changes as S
from tidepool.sources import fixtures as FX
from tidepool.sources import topics as T
from tidepool.streaming import jobs as SJ

ENV = "arrival long, seq long, topic string, value string"
OPS = {"insert": "c", "update": "u", "delete": "d", "read": "r", "truncate": "t"}
TOPIC = "srv.shop.t"


def envelope(n, op, key, v=None):
    row = "null" if key is None else f'{{"id":"{key}","v":"{v}"}}'
    before, after = (row, "null") if op == "delete" else ("null", row)
    return (n, n, TOPIC, f'{{"before":{before},"after":{after},"op":"{OPS[op]}"}}')


def play(log, upto):
    """The table after the log's records up to a position."""
    table = {}
    for n, op, key, v in log:
        if n > upto:
            break
        if op == "truncate":
            table.clear()
        elif op == "delete":
            table.pop(key, None)
        else:
            table[key] = v
    return table


def expected(log, ranges, width):
    """Sequential model: each range's true state at its high position, then the records after it."""
    out = []
    for r, (_, _, high) in ranges.items():
        out += [(high, "read", k, v) for k, v in play(log, high).items() if k // width == r]
    for n, op, key, v in log:
        if key is None or key // width not in ranges or n > ranges[key // width][2]:
            out.append((n, op, key, v if op != "delete" else None))
    return sorted(out, key=str)


def made_up(seed, truncate=False):
    rnd = random.Random(seed)
    width, log = 4, []
    for n in range(1, 400):
        key = 3 if rnd.random() < 0.3 else rnd.randrange(24)          # a third of all records on one key
        log.append((n, rnd.choice(["insert", "update", "update", "delete"]), key, f"v{n}"))
        if truncate and n in (130, 210):
            log[-1] = (n, "truncate", None, None)
    ranges = {}
    for r in range(5):                                                # the last range is not read
        low = 60 + 40 * r + rnd.randint(-20, 20)
        ranges[r] = (low, low + rnd.randint(0, 60), low + 60)
    rows = [(k, v) for r, (_, at, _) in ranges.items() for k, v in play(log, at).items() if k // width == r]
    return log, ranges, rows, width


def frames(spark, log, ranges, rows):
    snap = spark.createDataFrame([(-1, k, TOPIC, f'{{"before":null,"after":{{"id":"{k}","v":"{v}"}},"op":"r"}}') for k, v in rows], ENV)
    raw = spark.createDataFrame([envelope(*x) for x in log], ENV)
    return snap, raw, spark.createDataFrame([(r, a, b) for r, (a, _, b) in ranges.items()], H.RANGE_SCHEMA)


def rows_of(df):
    image = lambda r: r["after"] or r["before"]
    return sorted(((r["arrival"], r["type"], int(image(r)["id"]) if image(r) else None,
                    r["after"].get("v") if r["after"] else None) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed,truncate", [(1, False), (2, False), (3, True), (4, True)])
def test_equals_the_sequential_model(spark, seed, truncate):
    log, ranges, rows, width = made_up(seed, truncate)
    snap, raw, r = frames(spark, log, ranges, rows)
    got = rows_of(H.hand_over(C.normalize(snap), C.normalize(raw), r, "t", width=width))
    assert got == expected(log, ranges, width)
    # Folding the stream gives the table at the end of the log.
    table = {}
    for _, op, key, v in sorted(got, key=lambda x: (x[0], x[1] != "truncate")):
        if op == "truncate":
            table.clear()
        elif op == "delete":
            table.pop(key, None)
        else:
            table[key] = v
    assert table == {k: v for k, v in play(log, 400).items()}


@pytest.mark.parametrize("parts", [1, 5])
def test_stream_equals_batch(spark, workdir, parts):
    log, ranges, rows, width = made_up(7, True)
    snap, raw, r = frames(spark, log, ranges, rows)
    for i in range(parts):
        a, b = (len(log) * j // parts for j in (i, i + 1))
        spark.createDataFrame([envelope(*x) for x in log[a:b]], ENV).coalesce(1).write.parquet(f"{workdir}/in/part_{i}")
    root, check = f"{workdir}/topics", f"{workdir}/ck"
    start = lambda: SJ.start_handover_job(
        spark, root, snap, r, spark.readStream.schema(ENV).option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true").parquet(f"{workdir}/in"), "t", width=width, checkpoint=check)
    q = start()
    q.awaitTermination()
    # Once more from the checkpoint, with records behind the last window.
    spark.createDataFrame([envelope(500 + i, "update", i, "late") for i in range(6)], ENV).coalesce(1).write.parquet(f"{workdir}/in/z")
    start().awaitTermination()
    log += [(500 + i, "update", i, "late") for i in range(6)]
    out = T.read_topic(spark, root, SJ.ODS_DB).select("arrival", F.from_json("value", SJ.ODS_SCHEMA).alias("r")).select("arrival", "r.*")
    assert rows_of(out) == expected(log, ranges, width)


def test_query_stream_equals_batch(spark, workdir):
    snap, log, ranges = DQ.handover_inputs(spark, SF001)
    want = H.hand_over(snap, log, ranges, "orders", width=FX.HANDOVER_WIDTH)
    DB.ods_changes(spark, SF001).coalesce(1).write.parquet(f"{workdir}/in")
    env = S.snapshot_envelopes(FX.handover_rows(spark, SF001), FX.CDC_SERVER, FX.CDC_DATABASE, "orders", DB.ORDER_COLUMNS)
    SJ.start_handover_job(spark, f"{workdir}/topics", env, ranges, spark.readStream.schema(ENV).parquet(f"{workdir}/in"), "orders",
                          width=FX.HANDOVER_WIDTH, checkpoint=f"{workdir}/ck").awaitTermination()
    got = T.read_topic(spark, f"{workdir}/topics", SJ.ODS_DB)
    fine = want.select("arrival", "seq", C.record_json().alias("value"))
    assert got.count() == fine.count() > 0 and got.exceptAll(fine).isEmpty()


def test_rejects_and_other_tables_pass(spark):
    log = [envelope(5, "insert", 1, "a"), (6, 6, TOPIC, "{oops"), (7, 7, "srv.shop.u", '{"after":{"id":"1"},"op":"c"}'),
           (8, 8, TOPIC, '{"after":{"id":"x"},"op":"c"}'), (9, 9, "nowhere", '{"after":{"id":"1"},"op":"c"}')]
    raw = C.normalize(spark.createDataFrame(log, ENV))
    ranges = spark.createDataFrame([(0, 1, 100)], H.RANGE_SCHEMA)
    out = H.hand_over(raw.limit(0), raw, ranges, "t").collect()
    assert sorted((r["arrival"], r["type"], r["reason"]) for r in out) == \
        [(6, None, "malformed"), (7, "insert", None), (8, "insert", None), (9, "insert", "bad_topic"), (100, "read", None)]


def test_ranges_are_recorded_and_taken_up_again(spark, workdir):
    positions = iter(range(10, 100))
    reads = []

    def read(first, end):
        reads.append((first, end))
        if len(reads) == 3:
            raise OSError("lost")
        return spark.range(first, min(end, 95))

    path = os.path.join(workdir, "snap")
    with pytest.raises(OSError):
        H.record_ranges(spark, read, lambda: next(positions), 0, 94, path, width=10, together=3)
    out = H.record_ranges(spark, read, lambda: next(positions), 0, 94, path, width=10, together=3)
    assert reads == [(0, 30), (30, 60), (60, 90), (60, 90), (90, 120)]
    got = {r["range"]: (r["low"], r["high"]) for r in out.collect()}
    assert sorted(got) == list(range(12)) and got[0] == got[2] == (10, 11) and got[6] == (15, 16) and got[9] == (17, 18)
    assert spark.read.parquet(f"{path}/rows").count() == 95
