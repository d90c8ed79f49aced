"""One small hand-written case per quirk in SURVEY §2.9, plus the dirty test (H3)."""

import json

from pyspark.sql import functions as F

from tidepool.operators import cdc as C
from tidepool.operators import dims as D
from tidepool.operators import logs as L
from tidepool.operators import rules as R
from tidepool.sources import changes as S


def _log(spark, *texts):
    rows = [(i, i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "arrival long, seq long, value string")


def _j1(spark, *texts):
    return {(r.route, r.seq, r.pos): r for r in
            L.split_all(L.first_visit_fix(L.parse_app_log(_log(spark, *texts)))).collect()}


def test_dirty_test_h3_q15_q4(spark):
    texts = ['{bad', 'null', '', '[1]', '"x"', '{"common":{"is_new":"1"}}',
             '{"common":{"mid":"m"},"ts":"x"}', '  {"common":{"mid":7}}']
    got = {r.seq: r.reason for r in L.dirty(L.parse_app_log(_log(spark, *texts))).collect()}
    assert got == {0: "malformed", 1: "malformed", 2: "malformed", 3: "malformed",
                   4: "malformed", 5: "no_mid"}


def test_q1_repaired_flag_is_string_zero(spark):
    out = _j1(spark, '{"common":{"mid":"a","is_new":"1"},"page":{"page_id":"p"},"ts":1}',
              '{"common":{"mid":"a","is_new":"1"},"page":{"page_id":"q"},"ts":2}')
    first, second = out[("page", 0, 0)], out[("page", 1, 0)]
    assert first.is_new == "1" and second.is_new == "0"
    assert json.loads(second.value)["common"]["is_new"] == "0"
    assert json.loads(first.value)["common"]["is_new"] == "1"


def test_q2_q3_displays(spark):
    out = _j1(spark,
              '{"common":{"mid":"a"},"page":{"page_id":"p"},"displays":[{"item":"1","page_id":"old"},{"item":"2"}],"ts":1}',
              '{"common":{"mid":"b"},"displays":[{"item":"9"}],"ts":2}')
    d1 = json.loads(out[("display", 0, 1)].value)
    assert d1 == {"item": "1", "page_id": "p"}          # own fields + page id only, overwritten
    assert json.loads(out[("display", 0, 2)].value) == {"item": "2", "page_id": "p"}
    # Q3: a page record without a page object still emits its display, page id absent.
    assert json.loads(out[("display", 1, 1)].value) == {"item": "9"}
    assert out[("display", 1, 1)].page_id is None
    assert ("page", 1, 0) in out                        # the page record itself is kept


def test_q13_empty_start_object_counts(spark):
    out = _j1(spark, '{"common":{"mid":"a"},"start":{},"ts":1}',
              '{"common":{"mid":"a"},"start":"","page":{"page_id":"p"},"ts":2}')
    assert ("start", 0, 0) in out and ("page", 1, 0) in out


def test_q5_unique_visit_rejects(spark):
    texts = ['{"common":{"mid":"a"},"ts":1}',                                   # no page
             '{"common":{"mid":"a"},"page":{"page_id":"p"}}',                    # entry, no ts
             '{"common":{"mid":"a"},"page":{"page_id":"p","last_page_id":"x"}}',  # not an entry: fine
             '{"common":{"mid":"a"},"page":{"page_id":"p"},"ts":86400000}']
    p = L.parse_page_log(_log(spark, *texts))
    reasons = {r.seq: r.reason for r in p.collect()}
    assert reasons == {0: "no_page", 1: "no_ts", 2: None, 3: None}
    assert [r.seq for r in L.unique_visit(p).collect()] == [3]


def test_unique_visit_out_of_order_day_counts_again(spark):
    day = 86400000
    texts = [f'{{"common":{{"mid":"a"}},"page":{{"page_id":"p"}},"ts":{t}}}'
             for t in (0, day, 5, 10, day + 1)]
    kept = sorted(r.seq for r in L.unique_visit(L.parse_page_log(_log(spark, *texts))).collect())
    assert kept == [0, 1, 2, 4]


def _changes(spark, rows):
    df = spark.createDataFrame(rows, "arrival long, seq long, topic string, value string")
    return C.normalize(df)


def test_p9_normalise_q6_q12_q14(spark):
    rows = [
        (1, 1, "srv.db1.t1", json.dumps({"before": None, "after": {"id": 1, "a": None, "b": "x"}, "op": "c"})),
        (2, 2, "srv.db1.t1", json.dumps({"before": {"id": "1"}, "after": None, "op": "d"})),
        (3, 3, "srv.db1.t1", json.dumps({"after": {"id": "2"}, "op": "r"})),
        (4, 4, "srv.db1.t1", json.dumps({"after": {"id": "3"}, "op": "CREATE"})),
        (5, 5, "nodots", json.dumps({"after": {"id": "3"}, "op": "u"})),
        (6, 6, "srv.db1.t1", "{oops"),
    ]
    got = {r.seq: r for r in _changes(spark, rows).collect()}
    assert (got[1].database, got[1].table_name, got[1].type) == ("db1", "t1", "insert")
    assert got[1].after == {"id": "1", "b": "x"}          # numbers as text, nulls dropped
    assert got[1].before == {}
    assert got[2].type == "delete" and got[2].after == {} and got[2].before == {"id": "1"}
    assert got[3].type == "read"
    assert got[4].type == "insert"
    assert got[5].reason == "bad_topic"
    assert got[6].reason == "malformed"


def _rule_events(spark, rows):
    cols = R.RULE_FIELDS
    env = []
    for arrival, op, after, before in rows:
        env.append((arrival, arrival, "srv.cfg.table_process",
                    json.dumps({"before": before, "after": after, "op": op})))
    df = spark.createDataFrame(env, "arrival long, seq long, topic string, value string")
    return R.bind_rules(C.normalize(df))


def _rule(st, ot, sink_type, sink_table, cols):
    return {"source_table": st, "operate_type": ot, "sink_type": sink_type,
            "sink_table": sink_table, "sink_columns": cols}


def test_r1_q7_q8_rule_fold(spark):
    ev = _rule_events(spark, [
        (1, "r", _rule("t", "insert", "kafka", "a", "id"), None),
        (2, "u", _rule("t", "insert", "hbase", "b", "id,x"), None),         # last wins
        (3, "c", _rule("t", "update", "kafka", "c", "id"), None),
        (4, "u", _rule("t", "delete", "kafka", "d", "id"), _rule("t", "update", "kafka", "c", "id")),  # Q8
        (5, "c", _rule("u", "insert", "kafka", "e", "id"), None),
        (6, "d", None, _rule("u", "insert", "kafka", "e", "id")),           # Q7: retire
    ])
    got = {(r.source_table, r.operate_type): (r.sink_type, r.sink_table)
           for r in R.latest_rules(ev).collect()}
    assert got == {("t", "insert"): ("hbase", "b"), ("t", "update"): ("kafka", "c"),
                   ("t", "delete"): ("kafka", "d")}


def test_p10_r3_trim_and_route(spark):
    rules = spark.createDataFrame(
        [("t", "insert", "kafka", "k", "id,a"), ("t", "update", "hbase", "h", "id, a"),
         ("t", "delete", "Kafka", "x", "id")],
        "source_table string, operate_type string, sink_type string, sink_table string, sink_columns string")
    for c in ["sink_pk", "sink_extend"]:
        rules = rules.withColumn(c, F.lit(None).cast("string"))
    rows = [(i, i, "srv.db.t", json.dumps({"after": {"id": str(i), "a": "1", "b": "2"}, "op": op}))
            for i, op in enumerate(["c", "u", "d", "r"])]
    routed = {r.seq: r for r in R.route_changes(_changes(spark, rows), rules).collect()}
    assert routed[0].route == "kafka" and routed[0].after == {"id": "0", "a": "1"}
    assert routed[1].route == "hbase" and routed[1].after == {"id": "1"}   # " a" is not "a"
    assert routed[2].route == "unknown_sink"                               # case-sensitive
    assert routed[3].route == "no_rule" and not routed[3].matched


def test_k4_q9_q10_q11_cells(spark):
    routed = spark.createDataFrame(
        [(1, 1, "dim", {"id": "k1", "a": "x", "b": "1"}, None),
         (2, 2, "dim", {"id": "k1", "a": "y"}, None),
         (3, 3, "dim", {"a": "z"}, None),                      # Q10: no row key -> reject
         (4, 4, "dim", {"id": "k2", "pk": "p9", "a": "w"}, "pk")],
        "arrival long, seq long, sink_table string, after map<string,string>, sink_pk string")
    cells, rejects = D.cells(routed)
    cur = {(r.row_key, r.qualifier): r.value for r in D.latest_cells(cells).collect()}
    assert cur == {("k1", "a"): "y", ("k1", "b"): "1", ("k2", "pk"): "p9", ("k2", "a"): "w"}
    assert [r.seq for r in rejects.collect()] == [3]
    cells2, _ = D.cells(routed, honour_sink_pk=True)
    keys = {r.row_key for r in cells2.collect()}
    assert "p9" in keys


def test_k4_store_append_is_idempotent(spark, workdir):
    store = D.DimStore(spark, f"{workdir}/dims", database="dims_test")
    cells = spark.createDataFrame(
        [("dim", "k", "a", "x", 1, 1), ("dim", "k", "a", "y", 2, 2), ("dim", "j", "b", "z", 3, 3)],
        "sink_table string, row_key string, qualifier string, value string, arrival long, seq long")
    store.append(cells)
    store.append(cells)                       # a retried batch
    cur = {(r.row_key, r.qualifier): r.value for r in store.current().collect()}
    assert cur == {("k", "a"): "y", ("j", "b"): "z"}
    view = store.ensure_dimension("dim", ["a", "b"])
    wide = {r.row_key: (r.a, r.b) for r in spark.table(view).collect()}
    assert wide == {"k": ("y", None), "j": (None, "z")}


def test_s2_startup_modes(spark):
    log = spark.createDataFrame([(5, 1, "s.d.t", json.dumps({"after": {"id": "1"}, "op": "u"}))],
                                "arrival long, seq long, topic string, value string")
    snap_rows = spark.createDataFrame([(1, "1", "x")], "seq long, id string, a string")
    snap = S.snapshot_envelopes(snap_rows, "s", "d", "t", ["id", "a"])
    latest = C.normalize(S.change_source(log, snap, "latest")).collect()
    initial = C.normalize(S.change_source(log, snap, "initial")).orderBy("arrival").collect()
    assert [r.type for r in latest] == ["update"]
    assert [r.type for r in initial] == ["read", "update"]
    assert initial[0].after == {"id": "1", "a": "x"}


def test_s3_views(spark):
    rows = [(1, 1, "s.d.t", json.dumps({"after": {"id": "1", "n": "a"}, "op": "c"})),
            (2, 2, "s.d.t", json.dumps({"after": {"id": "1", "n": "b"}, "op": "u"})),
            (3, 3, "s.d.t", json.dumps({"after": {"id": "2", "n": "c"}, "op": "c"})),
            (4, 4, "s.d.t", json.dumps({"before": {"id": "2", "n": "c"}, "after": None, "op": "d"})),
            (5, 5, "s.d.t", json.dumps({"after": {"n": "no id"}, "op": "c"}))]
    log_v, cur_v = C.register_table_views(spark, _changes(spark, rows), "t", ["id", "n"])
    assert spark.sql(f"select count(*) from {log_v}").first()[0] == 4   # NOT NULL id
    assert [tuple(r) for r in spark.sql(f"select * from {cur_v}").collect()] == [("1", "b")]


def test_p2_strict_parse_fails_on_malformed(spark):
    import pytest

    rows = [(1, 1, "srv.db1.t1", json.dumps({"after": {"id": "1"}, "op": "c"})),
            (2, 2, "srv.db1.t1", "{oops")]
    df = spark.createDataFrame(rows, "arrival long, seq long, topic string, value string")
    good = spark.createDataFrame(rows[:1], df.schema)
    assert [r.type for r in C.normalize(good, strict=True).collect()] == ["insert"]
    with pytest.raises(Exception):
        C.normalize(df, strict=True).collect()
    # Tolerant (default): the malformed envelope is tagged, the job goes on.
    assert {r.seq: r.reason for r in C.normalize(df).collect()} == {1: None, 2: "malformed"}


def test_p13_empty_after_filter(spark):
    rows = [(1, 1, "srv.db1.t1", json.dumps({"after": {"id": "1"}, "op": "c"})),
            (2, 2, "srv.db1.t1", json.dumps({"before": {"id": "1"}, "after": None, "op": "d"}))]
    ch = _changes(spark, rows)
    assert ch.count() == 2                                     # off by default
    assert [r.seq for r in C.drop_empty_after(ch).collect()] == [1]


def test_q19_store_name_is_configurable_and_checked(spark, workdir):
    import pytest

    store = D.DimStore(spark, f"{workdir}/dims_q19", database="shop_dims")
    assert store.table == "shop_dims.cells"
    with pytest.raises(ValueError):
        D.DimStore(spark, f"{workdir}/x", database="bad-name; drop")
    with pytest.raises(ValueError):
        store.ensure_dimension("dim x", ["a"])


def test_empty_inputs(spark):
    """No rule history: every change misses, under either plan. No session
    entries: no unique visits."""
    ev = _rule_events(spark, [(1, "c", _rule("t1", "insert", "kafka", "x", "id"), None)]).limit(0)
    rows = [(5, 5, "srv.db1.t1", json.dumps({"after": {"id": "1"}, "op": "c"}))]
    ch = _changes(spark, rows)
    for plan in (None, "broadcast", "chunked"):
        got = R.lookup_asof(ch, ev, force=plan).collect()
        assert [(r.seq, r.matched, r.rule_arrival) for r in got] == [(5, False, None)], plan
    pages = L.split_page(L.clean(L.parse_app_log(_log(
        spark, '{"common":{"mid":"m"},"page":{"page_id":"a","last_page_id":"b"},"ts":1}'))))
    assert L.unique_visit(pages).count() == 0


def test_nulls_vanish_at_every_depth(spark):
    """Q12: null fields at any depth, in array elements and in a repaired ``common``."""
    deep = {"l": {"m": {"n": {"o": {"p": None, "q": [None, {"r": None, "s": 1}]}}}}, "z": None}
    odd = {'k":null,"': 'v":null,', "back\\": None, ',":null': ",}", "e": None, "text": 'a "b":null, c\\', "u": {"w": None}}
    body = {"page": {"page_id": "home", "x": None}, "deep": deep, "odd": odd, "ts": 1,
            "displays": [{"item": "1", "ext": {"x": None, "y": {"z": None}}}, None]}
    common = {"mid": "m1", "is_new": "1", "a": {"b": None, "c": {"d": None, "e": 2}}, "f": None}
    rows = [(i, i, json.dumps({"common": common, **body})) for i in (1, 2)]

    def clean(x):
        if isinstance(x, dict):
            return {k: clean(v) for k, v in x.items() if v is not None}
        return [clean(v) for v in x] if isinstance(x, list) else x

    fixed = L.first_visit_fix(L.parse_app_log(spark.createDataFrame(rows, "arrival long, seq long, value string")))
    got = {(r.route, r.arrival): json.loads(r.value) for r in L.split_all(fixed).collect()}
    assert got["page", 1] == clean({"common": common, **body})
    assert got["page", 2] == clean({"common": {**common, "is_new": "0"}, **body})
    assert got["display", 1] == got["display", 2] == {"item": "1", "ext": {"y": {}}, "page_id": "home"}
