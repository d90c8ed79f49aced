"""Every job accounts for every record it reads, producers keep apart, and the
dimension store and the landing survive what happens around them."""

import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tidepool.__main__ import build_parser
from tidepool import __main__ as cli
from tidepool.operators import cdc as C
from tidepool.operators import dims as D
from tidepool.operators import logs as L
from tidepool.operators import rules as R
from tidepool.plans import db_jobs as DB
from tidepool.sources import changes as S
from tidepool.sources import fixtures as FX
from tidepool.sources import topics as T
from tidepool.streaming import jobs as SJ

ENV = "arrival long, seq long, topic string, value string"
TOPIC = "arrival long, seq long, value string"


def _stream(spark, workdir, name, rows, schema):
    path = os.path.join(workdir, name)
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    return spark.readStream.schema(schema).parquet(path)


def _topics(spark, root):
    """topic -> list of (arrival, seq, value)."""
    out = {}
    df = spark.read.option("basePath", root).parquet(*[
        os.path.join(root, d) for d in os.listdir(root) if d.startswith("topic=")])
    for r in df.collect():
        out.setdefault(r["topic"], []).append((r["arrival"], r["seq"], r["value"]))
    return out


def test_change_job_keeps_what_it_cannot_read(spark, workdir):
    root = os.path.join(workdir, "topics")
    rows = [(1, 1, "s.shop.t", '\n{"after":{"id":"1"},"op":"c"}'), (2, 2, "s.shop.t", "{oops original text"),
            (3, 3, "lost", '{"after":{"id":"1"},"op":"c"}'), (4, 4, "s.shop.t", None)]
    SJ.start_cdc_job(spark, root, _stream(spark, workdir, "in", rows, ENV),
                     checkpoint=os.path.join(workdir, "ck")).awaitTermination()
    out = _topics(spark, root)
    assert {k: len(v) for k, v in out.items()} == {SJ.ODS_DB: 1, SJ.DIRTY_DB: 3}
    text = {s: v for _, s, v in out[SJ.DIRTY_DB]}
    assert "{oops original text" in text[2] and "malformed" in text[2] and "bad_topic" in text[3]


def test_route_job_accounts_for_every_record(spark, workdir):
    """Before any rule batch all records miss; then each is delivered, missed or rejected."""
    root = os.path.join(workdir, "topics")
    store = D.DimStore(spark, os.path.join(workdir, "dims"), database="dims_account")
    record = '{"database":"shop","tableName":"%s","before":{},"after":{"id":"%s","a":"x"},"type":"insert"}'

    def route(name, rows):
        src = _stream(spark, workdir, name, rows, TOPIC)
        SJ.start_route_job(spark, root, store, changes=src, checkpoint=os.path.join(workdir, f"ck_{name}")).awaitTermination()

    route("first", [(1, 1, record % ("fact", 1))])
    assert [s for _, s, _ in _topics(spark, root)[SJ.ROUTE_MISSES]] == [1]
    rule = '{"after":{"source_table":"%s","operate_type":"insert","sink_type":"%s","sink_table":"%s","sink_columns":"id,a"},"op":"r"}'
    rules = [(2, i, "s.shop.table_process", rule % r) for i, r in enumerate(
        [("fact", "kafka", "dwd_fact"), ("dim", "hbase", "dim_a"), ("odd", "clickhouse", "x"), ("own", "kafka", SJ.DIRTY_DB)])]
    rules.append((2, 9, "s.shop.other_table", rule % ("none", "kafka", "wrong")))
    SJ.start_rule_job(spark, root, _stream(spark, workdir, "rules", rules, ENV), dims=store,
                      checkpoint=os.path.join(workdir, "ck_rules")).awaitTermination()
    assert SJ.current_rules(spark, root).count() == 4
    rows = [(5, i, record % (t, i)) for i, t in enumerate(["fact", "dim", "odd", "own", "none"], 10)]
    rows += [(5, 20, "{cut off"), (5, 21, "[1]"), (5, 22, (record % ("dim", 1)).replace('"id":"1",', "")),
             (5, 23, '\t' + record % ("fact", 23)), (5, 24, '{"database":"shop","type":"insert","after":{}}')]
    route("second", rows)
    out = _topics(spark, root)
    seqs = {k: sorted(s for _, s, _ in v) for k, v in out.items() if k != SJ.RULE_REJECTS}
    assert seqs == {"dwd_fact": [10, 23], SJ.ROUTE_MISSES: [1, 12, 13, 14, 24], SJ.DIRTY_DB: [20, 21], SJ.DIM_REJECTS: [22]}
    reasons = {s: v for _, s, v in out[SJ.ROUTE_MISSES]}
    assert "unknown_sink" in reasons[12] and SJ.RESERVED in reasons[13] and "no_rule" in reasons[14]
    assert {r["row_key"] for r in store.current().collect()} == {"11"}


def test_unique_visit_job_accounts_for_every_page(spark, workdir):
    root = os.path.join(workdir, "topics")
    page = '{"common":{"mid":"m"},"page":{"page_id":"p"},"ts":%d}'
    rows = [(1, 1, page % 1000), (2, 2, page % 2000), (3, 3, "{cut"), (4, 4, '{"page":{}}'),
            (5, 5, '{"common":{"mid":"m"},"ts":1}'), (6, 6, '{"common":{"mid":"m"},"page":{"page_id":"p"}}')]
    SJ.start_uv_job(spark, root, source=_stream(spark, workdir, "pages", rows, TOPIC),
                    checkpoint=os.path.join(workdir, "ck")).awaitTermination()
    out = _topics(spark, root)
    assert [s for _, s, _ in out[SJ.DWM_UV]] == [1]
    reasons = {s: v for _, s, v in out[SJ.DIRTY_PAGE]}
    assert [next(x for x in ("malformed", "no_mid", "no_page", "no_ts") if x in reasons[s]) for s in (3, 4, 5, 6)] == \
        ["malformed", "no_mid", "no_page", "no_ts"]


def test_producers_of_a_topic_keep_apart(spark, workdir):
    """Two queries, and one started anew with another checkpoint, each write their batch 0."""
    root = os.path.join(workdir, "topics")
    for i in range(3):
        rows = [(i, i, "s.shop.t", '{"after":{"id":"%d"},"op":"c"}' % i)]
        SJ.start_cdc_job(spark, root, _stream(spark, workdir, f"in{i}", rows, ENV),
                         checkpoint=os.path.join(workdir, f"ck{i}")).awaitTermination()
    assert sorted(s for _, s, _ in _topics(spark, root)[SJ.ODS_DB]) == [0, 1, 2]
    assert len(os.listdir(os.path.join(root, f"topic={SJ.ODS_DB}"))) == 3


def test_rules_of_one_dimension_share_its_view(spark, workdir):
    root = os.path.join(workdir, "topics")
    store = D.DimStore(spark, os.path.join(workdir, "dims"), database="dims_share")
    rule = '{"after":{"source_table":"t","operate_type":"%s","sink_type":"hbase","sink_table":"%s","sink_columns":"%s"},"op":"c"}'
    rows = [(1, 1, "s.shop.table_process", rule % ("insert", "dim", "id,a,b"))]
    more = [(2, 2, "s.shop.table_process", rule % ("update", "dim", "id,a")),
            (3, 3, "s.shop.table_process", rule % ("delete", "dim", "id, c,d")),
            (4, 4, "s.shop.table_process", rule % ("read", "not a name", "id"))]
    for i, r in enumerate((rows, more)):
        SJ.start_rule_job(spark, root, _stream(spark, workdir, f"r{i}", r, ENV), dims=store,
                          checkpoint=os.path.join(workdir, f"ck{i}")).awaitTermination()
    assert spark.table("dims_share.dim").columns == ["row_key", "a", "b", "d"]
    rejected = _topics(spark, root)[SJ.RULE_REJECTS]
    assert sorted(s for _, s, _ in rejected) == [3, 4] and all("bad_name" in v for _, _, v in rejected)


def test_an_append_during_compaction_stays(spark, workdir, monkeypatch):
    store = D.DimStore(spark, os.path.join(workdir, "dims"), database="dims_race")
    cells = lambda *rows: spark.createDataFrame(rows, ", ".join(
        f"{c} {'long' if c in ('arrival', 'seq') else 'string'}" for c in D.CELL_COLUMNS))
    store.append(cells(("d", "1", "a", "old", 1, 1), ("d", "2", "a", "x", 1, 2)))
    store.append(cells(("d", "1", "a", "new", 2, 1)))
    write = store._write

    def write_with_another_append(rows, part):
        if part.startswith("fold-"):
            write(cells(("d", "3", "a", "meanwhile", 3, 1)), "late")
        write(rows, part)

    monkeypatch.setattr(store, "_write", write_with_another_append)
    store.compact()
    assert {(r["row_key"], r["value"]) for r in store.current().collect()} == {("1", "new"), ("2", "x"), ("3", "meanwhile")}
    assert spark.table(store.table).count() == 3 and len(store.parts()) == 2
    # A store opened anew finds the same cells under its folder.
    again = D.DimStore(spark, os.path.join(workdir, "dims"), database="dims_race_again")
    assert again.current().count() == 3


def test_a_retried_part_replaces_itself(spark, workdir):
    store = D.DimStore(spark, os.path.join(workdir, "dims"), database="dims_retry")
    rows = [("d", "1", "a", "x", 1, 1)]
    schema = "sink_table string, row_key string, qualifier string, value string, arrival long, seq long"
    for _ in range(2):
        store.append(spark.createDataFrame(rows, schema), "q-0")
    assert spark.table(store.table).count() == 1


def test_landing_day_order_and_retry(spark, workdir):
    """Days follow the session zone, not the machine's; older files come first; a retried
    batch lands in the same folders."""
    incoming, root, landing = (os.path.join(workdir, x) for x in ("in", "topics", "landing"))
    os.makedirs(incoming)
    for name, text, at in (("b.log", "second\nthird\n" + "x" * 5000 + "\n", 1_700_000_100), ("a.log", "fourth\n", 1_700_060_000),
                           ("c.log", "first\n", 1_700_000_000)):
        path = os.path.join(incoming, name)
        with open(path, "w") as f:
            f.write(text)
        os.utime(path, (at, at))
    zone = os.environ.get("TZ")
    os.environ["TZ"] = "Asia/Tokyo"
    time.tzset()
    try:
        for ck in ("ck", "ck2"):                     # the second run repeats the batch
            SJ.start_landing_job(spark, incoming, root, landing, checkpoint=os.path.join(workdir, ck)).awaitTermination()
            days = {r["value"][:6]: str(r["dt"]) for r in spark.read.text(landing).collect()}
            assert days == {"first": "2023-11-14", "second": "2023-11-14", "third": "2023-11-14",
                            "xxxxxx": "2023-11-14", "fourth": "2023-11-15"}
            assert spark.read.text(landing).count() == 5
    finally:
        os.environ.pop("TZ") if zone is None else os.environ.__setitem__("TZ", zone)
        time.tzset()
    lines = T.read_topic(spark, root, SJ.ODS_LOG).orderBy("arrival", "seq").dropDuplicates(["arrival", "seq"]).orderBy("arrival", "seq")
    assert [r["value"][:6] for r in lines.collect()] == ["first", "second", "third", "xxxxxx", "fourth"]


def test_console_prints_every_record(spark, workdir):
    out = os.path.join(workdir, "printed")
    rows = [(i, i, "s.shop.t", '{"after":{"id":"%d"},"op":"c"}' % i) for i in range(100)] + [(100, 100, "s.shop.t", "{cut")]
    SJ.start_console_job(spark, _stream(spark, workdir, "in", rows, ENV), checkpoint=os.path.join(workdir, "ck"),
                         num_rows=2, out=out).awaitTermination()
    printed = [r["value"] for r in spark.read.option("recursiveFileLookup", "true").text(out).collect()]
    assert len(printed) == 101 and all(p.startswith("change> ") for p in printed)
    assert any("{cut" in p and "malformed" in p for p in printed)


@pytest.mark.parametrize("force", ["broadcast", "chunked", None])
def test_null_keys_match_no_rule_in_any_plan(spark, force):
    schema = "arrival long, seq long, " + ", ".join(f"{c} string" for c in R.RULE_FIELDS) + ", retired boolean"
    rules = spark.createDataFrame([(0, 0, None, "insert", "kafka", "t", "a", None, None, False),
                                   (1, 1, "o", "insert", "kafka", "t", "a", None, None, False),
                                   (1, 2, "o", None, "kafka", "t", "a", None, None, False)], schema)
    changes = spark.createDataFrame([(5, 1, None, "insert"), (5000, 2, None, "insert"), (6, 3, "o", "insert"), (7, 4, "o", None)],
                                    "arrival long, seq long, table_name string, type string")
    got = {r["seq"]: r["matched"] for r in R.lookup_asof(changes, rules, force=force).collect()}
    assert got == {1: False, 2: False, 3: True, 4: False}


def test_texts_of_every_kind(spark):
    rows = [(1, 1, '\t\r\n {"common":{"mid":"a","is_new":"1","x":null},"page":{"page_id":"p","q":null,"z":{"k":null,"l":[null,{"m":null}]}}}'),
            (2, 2, "[1]"), (3, 3, "null"), (4, 4, '{"common":{"mid":"a","mid":"b"},"page":{}}'), (5, 5, ' "x"'), (6, 6, ""), (7, 7, None),
            (8, 8, '{"common":{"mid":"a","is_new":"1"},"v":null,"displays":[{"item":"1","y":null}],"page":{"page_id":"p"}}')]
    out = {(r["seq"], r["route"]): r for r in L.split_all(L.first_visit_fix(L.parse_app_log(
        spark.createDataFrame(rows, TOPIC)))).collect()}
    assert {s for s, route in out if route == "dirty"} == {2, 3, 5, 6, 7}
    assert out[1, "page"]["value"] == '{"common":{"is_new":"1","mid":"a"},"page":{"page_id":"p","z":{"l":[null,{}]}}}'   # null fields go at any depth, null elements stay
    assert out[4, "page"]["mid"] == "b"                      # the last value of a repeated key
    assert out[8, "page"]["value"] == \
        '{"common":{"is_new":"0","mid":"a"},"displays":[{"item":"1"}],"page":{"page_id":"p"}}'
    assert out[8, "display"]["value"] == '{"item":"1","page_id":"p"}'
    n = C.normalize(spark.createDataFrame([(1, 1, "s.d.t", '{"after":{"id":"1","id":"2"},"op":"u"}')], ENV)).first()
    assert n["after"] == {"id": "2"}


def test_sql_table_keeps_its_rejects(spark):
    rows = [(1, 1, "s.d.tm", '{"after":{"id":"1","n":"x"},"op":"c"}'), (2, 2, "s.d.tm", '{"after":{"n":"y"},"op":"c"}')]
    C.register_table_views(spark, C.normalize(spark.createDataFrame(rows, ENV)), "tm", ["id", "n"])
    assert [r["n"] for r in spark.table("tm_changelog").collect()] == ["x"]
    assert [(r["n"], r["reason"]) for r in spark.table("tm_rejects").collect()] == [("y", "null_id")]


def test_change_source_takes_tables_and_a_streaming_snapshot(spark, workdir):
    rows = [(1, 1, "s.shop.a", "x"), (2, 2, "s.shop.b", "x"), (3, 3, "s.other.a", "x"), (4, 4, "lost", "x")]
    df = spark.createDataFrame(rows, ENV)
    seqs = lambda d: sorted(r["seq"] for r in d.collect())
    assert seqs(S.only_tables(df, "shop", ["a"])) == [1, 4] and seqs(S.only_tables(df, "shop")) == [1, 2, 4]
    snap = os.path.join(workdir, "snap")
    FX.rules(spark).write.parquet(snap)
    first = S.snapshot_stream(spark, snap, "s", "shop", "table_process", "seq", FX.RULE_COLUMNS)
    log = _stream(spark, workdir, "log", [(9, 9, "s.shop.table_process", '{"after":{"source_table":"z","operate_type":"insert"},"op":"c"}')], ENV)
    root = os.path.join(workdir, "topics")
    SJ.start_rule_job(spark, root, S.change_source(log, first, "initial"), checkpoint=os.path.join(workdir, "ck")).awaitTermination()
    assert SJ.rule_log(spark, root).count() == len(FX.FIXED_RULES) + 1
    assert SJ.current_rules(spark, root).where("rule_arrival < 0").count() == len(FX.FIXED_RULES)


class _Recorder:
    """Stands in for a session whose Kafka connector is missing: takes the options up to ``load``."""

    def __init__(self, spark):
        self.spark, self.options_seen = spark, {}
        self.readStream = self.read = self

    def format(self, name):
        self.options_seen["format"] = name
        return self

    def option(self, k, v):
        self.options_seen[k] = v
        return self

    def options(self, **o):
        self.options_seen.update(o)
        return self

    def load(self):
        return self.spark.createDataFrame([(b"v", "t", 1, 2, None)], "value binary, topic string, partition int, offset long, timestamp timestamp")


def test_kafka_options_of_every_job(spark):
    want = {"log": ("ods_base_log", "latest"), "uv": ("dwd_page_log", "latest"), "route": ("ods_base_db", "latest"),
            "rules": ("binlog", "earliest"), "cdc": ("binlog", "latest")}
    for job, (topic, starting) in want.items():
        argv = [job, "--kafka", "h:1", "--group", "g"] + (["--kafka-topic", "binlog"] if topic == "binlog" else [])
        rec = _Recorder(spark)
        df = cli._kafka(rec, build_parser().parse_args(argv))
        assert rec.options_seen == {"format": "kafka", "kafka.bootstrap.servers": "h:1", "subscribe": topic,
                                    "startingOffsets": starting, "kafka.group.id": "g", "maxOffsetsPerTrigger": "5000000"}
        assert df.columns == ["arrival", "seq", "value"] and df.first()["seq"] == (1 << T.OFFSET_BITS) + 2
    with pytest.raises(SystemExit):
        cli._kafka(_Recorder(spark), build_parser().parse_args(["cdc", "--kafka", "h:1"]))
    assert isinstance(cli._sink(build_parser().parse_args(["uv", "--kafka-out", "h:1"])), T.KafkaTopics)


def test_a_snapshot_is_spread_over_chunks(spark):
    """All snapshot rows share one arrival; the chunked plan cuts them by their order."""
    from tidepool.operators.ordering import chunk_of

    rows = spark.range(5000).select(F.lit(S.SNAPSHOT_ARRIVAL).cast("long").alias("arrival"), F.col("id").alias("seq"))
    sizes = rows.groupBy(chunk_of(F.col("arrival"), 64, F.col("seq")).alias("c")).count()
    assert sizes.agg(F.max("count")).first()[0] == 64 and sizes.agg(F.max("c")).first()[0] < -1
    schema = "arrival long, seq long, " + ", ".join(f"{c} string" for c in R.RULE_FIELDS) + ", retired boolean"
    rules = spark.createDataFrame([(S.SNAPSHOT_ARRIVAL, 100, "o", "read", "kafka", "t", "a", None, None, False)], schema)
    changes = rows.select("arrival", "seq", F.lit("o").alias("table_name"), F.lit("read").alias("type"))
    later = spark.createDataFrame([(0, 1, "o", "read"), (9, 2, "o", "read")], "arrival long, seq long, table_name string, type string")
    both = changes.unionByName(later)
    got = {f: R.lookup_asof(both, rules, force=f, chunk_width=64).where("matched").count() for f in ("broadcast", "chunked")}
    assert got == {"broadcast": 5002, "chunked": 5002}
