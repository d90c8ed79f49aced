"""Centroid clustering (11): against brute force and the SQL, odd vectors, integers of any size."""

import hashlib
import math

import duckdb
import numpy as np
import pytest

from conftest import SF001, SF01
from tidepool.llm import lloyd

SCHEMA = "vec_id long, embedding array<double>"


def floor_of(x, scale=64):
    """floor(scale * x) without rounding."""
    n, d = float(x).as_integer_ratio()
    return scale * n // d


def brute(vectors, k=16, rounds=3, dims=64):
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) by Python integers."""
    kept = [(i, [floor_of(x) for x in v]) for i, v in vectors
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    mark = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest()
    c = [list(e) for _, e in sorted(((i, e) for i, e in kept if i is not None), key=lambda r: (mark(r[0]), r[1]))[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    assign = lambda: [min((dist(e, m), j) for j, m in enumerate(c)) for _, e in kept]
    for _ in range(rounds):
        near = assign()
        for j in range(len(c)):
            own = [e for (_, e), (_, at) in zip(kept, near, strict=True) if at == j]
            if own:
                c[j] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    near = assign()
    cut = lambda x: min(x, (1 << 63) - 1)
    sums = [cut(sum(cut(d) for d, at in near if at == j)) for j in range(len(c))]
    return sorted(((i, j, cut(d), sums[j], cut(sum(cut(d) for d, _ in near)),
                    hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest())
                   for (i, _), (d, j) in zip(kept, near, strict=True)), key=str)


def clustered(spark, rows, **options):
    return sorted(map(tuple, lloyd.cluster(spark.createDataFrame(rows, SCHEMA), **options).collect()), key=str)


def test_query_equals_brute_force_and_sql(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    got = sorted(map(tuple, lloyd.op11_lloyd(spark, SF001).collect()), key=str)
    assert got == brute(rows)
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{SF001}/embeddings.parquet')")
    assert sorted(con.sql(lloyd.OP11_SQL).fetchall(), key=str) == got


def test_sql_on_the_larger_table(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{SF01}/embeddings.parquet')")
    out = lloyd.op11_lloyd(spark, SF01)
    rel = con.sql(lloyd.OP11_SQL)
    assert out.columns == rel.columns
    assert sorted(map(tuple, out.collect())) == sorted(rel.fetchall())


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_many_blocks_and_shards(spark, monkeypatch, shards):
    """Blocks of a few rows, more shards than fit evenly, and a third of all rows in one place."""
    monkeypatch.setattr(lloyd, "ROW_BLOCK", 7)
    rng = np.random.default_rng(shards)
    rows = [(i, (np.full(8, 0.25) if i % 3 == 0 else rng.normal(size=8)).tolist()) for i in range(300)]
    assert clustered(spark, rows, k=5, rounds=4, dims=8, shards=shards) == brute(rows, 5, 4, 8)


def test_odd_vectors(spark):
    rng = np.random.default_rng(2)
    fine = [(i, rng.normal(size=4).tolist()) for i in range(40)]
    odd = [(100, None), (101, []), (102, [1.0, 2.0]), (103, [1.0, None, 2.0, 3.0]), (104, [float("nan")] * 4),
           (105, [float("inf"), 0.0, 0.0, 0.0]), (106, [0.0] * 5), (None, [0.5, 0.5, 0.5, 0.5]), (None, [9.0, 0.0, 0.0, 0.0])]
    repeated = [fine[3], fine[3], (7, fine[3][1])]
    rows = fine + odd + repeated
    got = clustered(spark, rows, k=6, rounds=2, dims=4, shards=2)
    assert got == brute(rows, 6, 2, 4) and len(got) == 45
    named = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], f"{SCHEMA}, cluster int, distance long, block string")
    assert sorted(map(tuple, lloyd.cluster(named, 6, 2, 4, 2).collect()), key=str) == got
    # Ties go to the smaller number; fewer vectors than centroids; none at all.
    same = [(i, [1.0, 1.0]) for i in range(5)]
    assert clustered(spark, same, k=3, rounds=2, dims=2) == brute(same, 3, 2, 2)
    assert clustered(spark, fine[:2], k=6, rounds=2, dims=4) == brute(fine[:2], 6, 2, 4)
    assert clustered(spark, [(None, [1.0, 1.0])], k=3, dims=2) == [] and clustered(spark, odd[:2], dims=4) == []
    assert lloyd.cluster(spark.createDataFrame([], SCHEMA)).columns == \
        ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_components_of_any_size(spark):
    """Finite components whose products pass 64 bits, and those that pass doubles, stay exact."""
    rows = [(i, [x, -x / 3, 0.1 * i]) for i, x in enumerate([0.5, 1e6, 3e9, 1e9, 7e15, 1e17, 1e40, 1e307, -1.7e308, 1.6e308, 0.0])]
    assert clustered(spark, rows, k=4, rounds=2, dims=3, shards=2) == brute(rows, 4, 2, 3)
    assert lloyd.integers(np.array([1.7e308])).tolist() == [floor_of(1.7e308)]


def test_packed_integers():
    for a in ([0, 5, -128], [300], [1 << 20, -5], [1 << 40], [1 << 70, -3], []):
        x = np.array(a, dtype=object)
        assert lloyd.unpacked(lloyd.packed(x), len(a)).tolist() == a
    assert len(lloyd.packed(np.arange(100))) == 101
