"""W3 in batch: kept entries under an expiring state, against the sequential rule."""

import random

import pytest
from pyspark.sql import functions as F

from tidepool.operators import expiry as X
from tidepool.operators import logs as L

DAY = 24 * 3600 * 1000


def sequential(entries, ttl):
    kept, state = set(), {}
    for mid, arrival, seq, day in sorted(entries, key=lambda e: (e[0], e[1], e[2])):
        last = state.get(mid)
        if last is None or last[0] != day or arrival - last[1] >= ttl:
            kept.add(seq)
            state[mid] = (day, arrival)
    return kept


def made_up(seed, n=600):
    """A third of all entries on one device, ties of arrival, days out of order."""
    rnd, out = random.Random(seed), []
    for seq in range(n):
        mid = "hot" if rnd.random() < 0.33 else f"m{rnd.randrange(25)}"
        out.append((mid, rnd.randrange(0, 400), seq, rnd.choice([0, 0, 0, 1, 2])))
    return out


def pages(spark, entries):
    rows = [(mid, a, s, None, None if s % 2 else "", d * DAY + 5, f"text {s}") for mid, a, s, d in entries]
    return spark.createDataFrame(rows, "mid string, arrival long, seq long, reason string, last_page_id string, ts long, value string")


@pytest.mark.parametrize("seed,ttl,chunk,fanout", [(1, 1, 64, 2), (2, 7, 16, 4), (3, 50, 1, 1), (4, 1000, 1024, 1024), (5, 120, 32, 3)])
def test_equals_the_sequential_rule(spark, seed, ttl, chunk, fanout):
    entries = made_up(seed)
    out = X.unique_visit_expiring(pages(spark, entries), ttl, chunk, fanout)
    got = [r["seq"] for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == sequential(entries, ttl)
    assert out.where(F.col("day") != F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd")).count() == 0


def test_without_expiry_it_is_the_plain_rule(spark):
    df = pages(spark, made_up(9))
    plain = {r["seq"] for r in L.unique_visit(df).collect()}
    assert {r["seq"] for r in X.unique_visit_expiring(df, 1 << 40).collect()} == plain


def test_rejects_and_later_pages_are_no_entries(spark):
    rows = [("a", 1, 1, None, None, 5, "x"), ("a", 2, 2, "no_ts", None, None, "x"), ("a", 3, 3, None, "p1", DAY, "x"),
            ("a", 5, 4, None, "", 6, "x"), ("a", 12, 5, None, "", 7, "x")]
    df = spark.createDataFrame(rows, pages(spark, []).schema)
    assert sorted(r["seq"] for r in X.unique_visit_expiring(df, 11).collect()) == [1, 5]
    assert X.unique_visit_expiring(df.limit(0), 11).collect() == []
    with pytest.raises(ValueError):
        X.unique_visit_expiring(df, 0)


def test_paths_by_doubling(spark):
    """A chain of 1,000 nodes beside short ones and one that is not started from."""
    hops = [(i, i + 1) for i in range(1000)] + [(2000, 2001), (3000, 3001), (3001, None)]
    df = spark.createDataFrame(hops, "seq long, next long")
    first = spark.createDataFrame([(0,), (3000,), (9999,)], "seq long")
    assert sorted(r["seq"] for r in X.on_paths(first, df).collect()) == [*range(1001), 3000, 3001, 9999]
