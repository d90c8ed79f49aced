"""Exact top-k (3) and spherical-cap near-duplicates (8) against brute force."""

import numpy as np

from conftest import SF001
from tidepool.llm import caps, topk

NAN, INF = float("nan"), float("inf")


def brute_top(queries, rows, k=5):
    fine = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in queries}):
        mine = [v for i, v in fine if i == q]
        scored = sorted(((-sum(a * b for a, b in zip(v, c)), i) for v in mine for i, c in fine if i != q))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return out


def floor_of(x, scale=256):
    """floor(scale * x) without rounding."""
    n, d = float(x).as_integer_ratio()
    return scale * n // d


def rows_of(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def test_top_k_of_the_whole_table(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = brute_top([r for r in rows if r[0] % 50 == 0], rows)
    assert rows_of(topk.op3_topk(spark, SF001)) == want


def test_top_k_equals_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{SF001}/embeddings.parquet')")
    assert sorted(con.sql(topk.OP3_SQL).fetchall()) == rows_of(topk.op3_topk(spark, SF001))


def test_top_k_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 4)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "TOGETHER", 2)
    rows = [(0, [0.5, 0.25, 1.0]), (1, [0.5, 0.25, 1.0]), (2, [0.5, 0.25, 1.0]), (3, None), (4, [NAN, 1.0, 1.0]),
            (5, [INF, 0.0, 0.0]), (6, [None, 1.0, 1.0]), (7, []), (8, [2.0]), (9, [0.5, 0.25, 1.0, -3.0]), (None, [1.0, 1.0, 1.0]),
            (50, [0.001, -0.001, 0.0]), (50, [1.0, 0.0, 0.0]), (100, [-1.0, -1.0, -1.0]), (10, [0.5, 0.25, 1.0])]
    v = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    q = v.filter("vec_id % 50 = 0")
    assert rows_of(topk.top_k(v, q)) == brute_top([r for r in rows if r[0] is not None and r[0] % 50 == 0], rows)
    large = [(0, [1e9, 3.0]), (1, [1e3, 1.0]), (2, [1e3, 2.0]), (3, [-1e3, 7.0])]
    v = spark.createDataFrame(large, "vec_id long, embedding array<double>")
    assert rows_of(topk.top_k(v, v.filter("vec_id = 0"))) == brute_top(large[:1], large)
    assert not topk.top_k(v.limit(0), v.limit(0)).collect()
    assert not topk.top_k(v.limit(0), v).collect()


def test_top_k_of_components_of_any_size(spark, monkeypatch):
    """Scores beyond a long, and products beyond a double, keep their order; only the value is cut."""
    monkeypatch.setattr(topk, "BLOCK", 3)
    large = [(0, [1e200, 1.0]), (1, [1e200, 2.0]), (2, [1e200, -2.0]), (3, [2e200, 0.0]), (4, [-1e200, 5.0]), (5, [-3e200, 0.0]),
             (6, [1e307, 1.0]), (7, [1.7e308, -1.7e308]), (8, [5e-324, 0.3]), (9, [1e6, 1e6]), (10, [9e15, 0.1])]
    whole = [(i, [floor_of(x) for x in v]) for i, v in large]
    v = spark.createDataFrame(large, "vec_id long, embedding array<double>")
    for groups in (1, 5):
        got = rows_of(topk.top_k(v, v, k=10, groups=groups))
        want = []
        for q, a in whole:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in whole if i != q)
            want += [(q, r + 1, i, max(-topk.LONG, min(topk.LONG, -s))) for r, (s, i) in enumerate(scored)]
        assert got == sorted(want)


def brute_links(rows, cosine=0.95):
    """(vec_id, n_links, component_id) of every row, in order."""
    ok = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    n, label = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in range(len(ok)):
        for b in range(a):
            x, y = (np.array(rows[ok[c]][1], dtype=float) for c in (a, b))
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                n[ok[a]] += 1
                n[ok[b]] += 1
                label[root(ok[a])] = root(ok[b])
    low = {}
    for i, (v, _) in enumerate(rows):
        if v is not None:
            low[root(i)] = min(low.get(root(i), v), v)
    return [(v, n[i], low.get(root(i)), v == low.get(root(i))) for i, (v, _) in enumerate(rows)]


def links(df):
    return sorted(map(tuple, df.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def near_copies(rng, groups, most, dims=64):
    out = []
    for _ in range(groups):
        c = rng.standard_normal(dims)
        for _ in range(rng.integers(1, most + 1)):
            out.append(c / np.linalg.norm(c) + rng.standard_normal(dims) * rng.choice([0, 0.005, 0.015, 0.02]))
    return [(i, [float(x) for x in v]) for i, v in enumerate(out)]


def test_links_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(caps, "BLOCK", 16)          # large filters are cut
    rows = near_copies(np.random.default_rng(5), 150, 6) + \
        [(10_000 + i, v) for i, (_, v) in enumerate(near_copies(np.random.default_rng(6), 1, 1) * 3)]
    hub = np.random.default_rng(7).standard_normal(64)
    rows += [(20_000 + i, [float(x) for x in hub + np.random.default_rng(i).standard_normal(64) * 0.08]) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want, got = brute_links(rows), {r["vec_id"]: r for r in caps.linked(df).collect()}
    assert len(got) == len(rows)
    assert all(got[v]["n_links"] <= n for v, n, _, _ in want)
    assert sum(r["n_links"] for r in got.values()) >= 0.999 * sum(n for _, n, _, _ in want)
    assert np.mean([got[v]["component_id"] == c for v, _, c, _ in want]) >= 0.999


def test_links_of_the_whole_table(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert links(caps.op8_caps(spark, SF001)) == sorted(brute_links(rows), key=str)


def test_links_of_odd_rows(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [NAN, 1.0]),
            (7, [INF, 1.0]), (8, [None, 1.0]), (9, []), (None, [1.0, 0.01]), (10, [3.0]), (11, [5.0]), (12, [-1.0]),
            (13, [1e200, 0.0]), (14, [1e-200, 0.0]), (None, [0.0, -1.0]), (None, None)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, component_id int")
    got = {}
    for r in caps.linked(df).collect():
        got.setdefault(r["vec_id"], []).append((r["n_links"], r["component_id"], r["kept"]))
    for v in (1, 13, 14):
        assert got[v] == [(5, 1, v == 1)]
    assert got[2] == [(5, 1, False)] * 2
    assert got[10] == [(1, 10, True)] and got[11] == [(1, 10, False)] and got[12] == [(0, 12, True)]
    for v in (3, 4, 5, 6, 7, 8, 9):
        assert got[v] == [(0, v, True)]
    assert sorted(got[None], key=str) == sorted([(5, 1, False), (0, None, True), (0, None, True)], key=str)
    assert not caps.linked(df.limit(0)).collect()


def test_sketches_leave_out_no_link():
    """Pairs right at the threshold stay, whatever the rounding; far ones go."""
    import pandas as pd

    rng = np.random.default_rng(8)
    for dims in (2, 16, 64, 300):
        u = rng.normal(size=(200, dims))
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        w = rng.normal(size=(200, dims))
        w -= (w * u).sum(1, keepdims=True) * u
        w /= np.linalg.norm(w, axis=1, keepdims=True)
        v = 0.95 * u + np.sqrt(1 - 0.95 ** 2) * w                    # cosine 0.95 with u
        far = 0.6 * u + 0.8 * w
        for other, most in ((v, 200), (far, 60)):
            kept = 0
            for a, b in zip(u, other, strict=True):
                rows = pd.DataFrame({"sketch": caps.sketches(np.stack([a, b])), "sub": [0, 1]})
                kept += len(caps._may_link(rows, (0, 0), 0.95 - 1e-12)) == 2
            assert kept == 200 if other is v else kept <= most, dims
