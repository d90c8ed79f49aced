"""Property tests of the chunked ordered scans against plain sequential loops.

Each example packs many independent keys into one DataFrame (so one Spark run
checks many random sequences): arrival ties, negative arrivals, one hot key, tiny
chunk widths and fan-outs so that both levels of the carry scan are exercised.
"""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidepool.operators import logs as L
from tidepool.operators import rules as R

DAY = 86_400_000
SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

# (key, arrival, day index) per row; seq is the row's position.
entry_rows = st.lists(
    st.tuples(st.sampled_from(["hot"] * 6 + [f"k{i}" for i in range(8)]),
              st.integers(-40, 120), st.integers(0, 3)),
    min_size=1, max_size=160)


@SETTINGS
@given(rows=entry_rows, width=st.sampled_from([1, 2, 3, 8]), fanout=st.sampled_from([2, 3, 1024]))
def test_unique_visit_matches_loop(spark, rows, width, fanout):
    data = [(k, a, i, d * DAY + 5) for i, (k, a, d) in enumerate(rows)]
    pages = (spark.createDataFrame(data, "mid string, arrival long, seq long, ts long")
             .withColumn("reason", F.lit(None).cast("string"))
             .withColumn("last_page_id", F.lit(None).cast("string")))
    got = {r.seq for r in L.unique_visit(pages, chunk_width=width, fanout=fanout).collect()}
    want, last = set(), {}
    for k, a, i, ts in sorted(data, key=lambda r: (r[1], r[2])):
        day = ts // DAY
        if last.get(k) != day:
            last[k] = day
            want.add(i)
    assert got == want


rule_rows = st.lists(
    st.tuples(st.sampled_from(["a", "a", "a", "b", "c"]), st.integers(-20, 80),
              st.sampled_from(["kafka", "hbase", "x"]), st.booleans()),
    max_size=40)
change_rows = st.lists(
    st.tuples(st.sampled_from(["a", "a", "b", "c", "d"]), st.integers(-20, 100)),
    min_size=1, max_size=120)


@SETTINGS
@given(rules=rule_rows, changes=change_rows, width=st.sampled_from([1, 3, 16]),
       fanout=st.sampled_from([2, 3]))
def test_asof_lookup_matches_loop(spark, rules, changes, width, fanout):
    ev = [(a, i, "t", k, s, None, None, None, None, ret) for i, (k, a, s, ret) in enumerate(rules)]
    ev_df = spark.createDataFrame(
        ev, "arrival long, seq long, source_table string, operate_type string, sink_type string, "
            "sink_table string, sink_columns string, sink_pk string, sink_extend string, "
            "retired boolean")
    ch = [(a, 1000 + i, "t", k) for i, (k, a) in enumerate(changes)]
    ch_df = spark.createDataFrame(ch, "arrival long, seq long, table_name string, type string")
    for plan in ("chunked", "broadcast"):
        out = R.lookup_asof(ch_df, ev_df, force=plan, chunk_width=width, fanout=fanout)
        got = {r.seq: (r.rule_arrival, r.sink_type, r.matched) for r in out.collect()}
        want = {}
        for a, s, _, k in ch:
            best = None
            for ra, rs, _, rk, st_, *_rest, ret in ev:
                if rk == k and ra <= a and (best is None or (ra, rs) > best[:2]):
                    best = (ra, rs, st_, ret)
            if best is None:
                want[s] = (None, None, False)
            else:
                want[s] = (best[0], None if best[3] else best[2], not best[3])
        assert got == want, plan
