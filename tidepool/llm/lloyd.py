"""Centroid clustering by dimension-sharded Lloyd rounds, in exact integers.

Vectors are cut into blocks of rows and each block into column blocks ("shards"), kept
as integers of the narrowest width. In every round a task holds one column block
against the slices of the centroids over the same columns and gives exact partial
distances; these are added by row block, and the nearest centroid is taken where all
columns have met. The assignments go back to the column blocks, which add up their own
columns by cluster; the sums of a shard are combined as a tree and its slice of the
centroids is replaced, apart from all other shards. No task holds whole vectors or
whole centroids.

A task's memory is bounded by one row block times the number of centroids, whatever
the number of rows or the size of a cluster.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm.common import staged, table
from tidepool.session import checkpoint_root

SCALE = 64
DIMS, CLUSTERS, ROUNDS, SHARDS = 64, 16, 3, 4
ROW_BLOCK = 4096
# Sums of a shard are first added in this many groups of tasks.
FAN_IN = 256
# Beyond it, sums of products are taken with Python integers instead of doubles.
EXACT = 1 << 53
LONG = (1 << 63) - 1
_KINDS = {b"b": np.int8, b"h": np.int16, b"i": np.int32, b"q": np.int64}


def packed(a: np.ndarray) -> bytes:
    """Integers in the narrowest width that holds all; wider than 64 bits as decimals."""
    low, high = (int(a.min()), int(a.max())) if a.size else (0, 0)
    for tag, kind in _KINDS.items():
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return tag + a.astype(kind).tobytes()
    return b"d" + ",".join(map(str, a.ravel().tolist())).encode()


def unpacked(raw: bytes, *shape: int) -> np.ndarray:
    """The integers of ``packed``, as 64-bit ones if they fit and Python's otherwise."""
    if raw[:1] == b"d":
        return np.array([int(x) for x in raw[1:].split(b",")], dtype=object).reshape(shape)
    return np.frombuffer(raw, dtype=_KINDS[raw[:1]], offset=1).astype(np.int64).reshape(shape)


def integers(x: np.ndarray) -> np.ndarray:
    """floor(64 * x) of finite doubles, exactly."""
    with np.errstate(over="ignore"):
        scaled = np.floor(x * SCALE)
    if not x.size or np.abs(scaled).max() < 1 << 62:
        return scaled.astype(np.int64)
    # A double beyond 2 ** 53 is an integer, so its product is one too.
    return np.array([math.floor(v * SCALE) if abs(v) < EXACT else int(v) * SCALE for v in x.ravel().tolist()],
                    dtype=object).reshape(x.shape)


def _top(a: np.ndarray) -> int:
    return max(abs(int(a.min())), abs(int(a.max()))) if a.size else 0


def partial_distances(m: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``m`` from those of ``c`` over these columns."""
    if m.shape[1] * (_top(m) + _top(c)) ** 2 < EXACT:
        x, y = m.astype(np.float64), c.astype(np.float64)
        return ((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)).astype(np.int64)
    x, y = m.astype(object), c.astype(object)
    return np.stack([((x - row) ** 2).sum(1) for row in y], axis=1)


def cluster_sums(m: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    """Sums of the rows of each cluster, as Python integers."""
    if len(m) * _top(m) < EXACT:
        at = np.zeros((k, len(m)))
        at[cluster, np.arange(len(m))] = 1
        return (at @ m.astype(np.float64)).astype(np.int64).astype(object)
    out = np.zeros((k, m.shape[1]), dtype=object)
    np.add.at(out, cluster, m.astype(object))
    return out


def _edges(dims: int, shards: int) -> list[int]:
    return [dims * s // shards for s in range(shards + 1)]


def _kept(vectors: DataFrame, dims: int) -> DataFrame:
    """Vectors of exactly ``dims`` components, none null or non-finite."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")) \
        .filter(F.coalesce((F.size("embedding") == dims) & fine, F.lit(False)))


def _column_blocks(rows: DataFrame, dims: int, edges: list[int]) -> tuple[DataFrame, DataFrame]:
    """``block, shard, n, m`` with the columns of each shard, and ``block, ids``.

    Written once to the shared folder, a folder a shard, so that a task reads columns of
    one shard.
    """
    spark = rows.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, ROW_BLOCK):
                b = batch.slice(lo, ROW_BLOCK)
                m = integers(b.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dims))
                slices = [packed(m[:, x:y]) for x, y in zip(edges, edges[1:], strict=False)]
                size, s = len(slices), b.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(part << 32) + n] * (size + 1), pa.int64()), pa.array(range(-1, size), pa.int32()),
                     pa.array([s] * (size + 1), pa.int32()), pa.array([None, *slices], pa.binary()),
                     pa.array([b.column("vec_id").to_pylist()] + [None] * size, pa.list_(pa.int64()))],
                    names=["block", "shard", "n", "m", "ids"])
                n += 1

    out = rows.select("vec_id", "embedding").mapInArrow(cut, "block long, shard int, n int, m binary, ids array<long>")
    path = f"{checkpoint_root(spark)}/tidepool-llm/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}-lloyd-columns"
    out.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    read = spark.read.schema(out.schema).parquet(path)
    return (read.filter("shard >= 0").select("block", "shard", "n", "m"),
            read.filter("shard = -1").select("block", "ids"))


def _seeds(rows: DataFrame, k: int) -> list[list[int]]:
    """The ``k`` vectors with the smallest hashes of their id, as integers."""
    mark = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = rows.filter("vec_id is not null").select(mark.alias("mark"), "embedding").orderBy("mark", "embedding").limit(k).collect()
    return [integers(np.array(r["embedding"], dtype=np.float64)).tolist() for r in first]


def _centroid_slices(spark: SparkSession, centroids: list[list[int]], edges: list[int]) -> DataFrame:
    """``shard, c``: the centroids over the columns of each shard; k times dims numbers in all."""
    whole = np.array(centroids, dtype=object).reshape(len(centroids), edges[-1])
    return spark.createDataFrame([(s, packed(whole[:, x:y])) for s, (x, y) in enumerate(zip(edges, edges[1:], strict=False))],
                                 "shard int, c binary")


def nearest(columns: DataFrame, centroids: DataFrame, k: int, edges: list[int]) -> DataFrame:
    """``block, cluster, distance`` (packed): the nearest centroid of each vector of a block."""
    width = [y - x for x, y in zip(edges, edges[1:], strict=False)]

    def distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                d = partial_distances(unpacked(r["m"], r["n"], width[r["shard"]]), unpacked(r["c"], k, width[r["shard"]]))
                yield pa.RecordBatch.from_pydict({"block": [r["block"]], "n": [r["n"]], "d": [packed(d)]},
                                                 pa.schema([("block", pa.int64()), ("n", pa.int32()), ("d", pa.binary())]))

    def decide(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        n, total = int(rows["n"].iat[0]), 0
        for raw in rows["d"]:
            d = unpacked(raw, n, k)
            # Two sums that might pass 64 bits are added as Python integers.
            total = d + (total.astype(object) if isinstance(total, np.ndarray) and _top(total) + _top(d) > LONG else total)
        cluster = np.argmin(total, axis=1)                   # the first of equal ones
        return pd.DataFrame({"block": [key[0]], "cluster": [packed(cluster)],
                             "distance": [packed(total[np.arange(n), cluster])]})

    # Centroid slices are as large as the parameters k and dims say.
    return columns.join(F.broadcast(centroids), "shard").select("block", "shard", "n", "m", "c") \
        .mapInArrow(distances, "block long, n int, d binary") \
        .groupBy("block").applyInPandas(decide, "block long, cluster binary, distance binary")


def updated(columns: DataFrame, assigned: DataFrame, centroids: DataFrame, k: int, edges: list[int]) -> DataFrame:
    """``shard, c``: each shard's slice of the centroids after the vectors of every block are assigned."""
    width = [y - x for x, y in zip(edges, edges[1:], strict=False)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, sums, counts = TaskContext.get().partitionId(), {}, {}
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                s, cluster = r["shard"], unpacked(r["cluster"], r["n"])
                here = cluster_sums(unpacked(r["m"], r["n"], width[s]), cluster, k)
                sums[s] = sums[s] + here if s in sums else here
                counts[s] = counts.get(s, 0) + np.bincount(cluster, minlength=k)
        for s in sums:
            yield pa.RecordBatch.from_pydict(
                {"shard": [s], "lot": [task % FAN_IN], "n": [packed(counts[s])], "c": [packed(sums[s])]},
                pa.schema([("shard", pa.int32()), ("lot", pa.int32()), ("n", pa.binary()), ("c", pa.binary())]))

    def total(rows: pd.DataFrame, d: int) -> tuple[np.ndarray, np.ndarray]:
        n, c = np.zeros(k, dtype=np.int64), np.zeros((k, d), dtype=object)
        for a, b in zip(rows["n"], rows["c"], strict=True):
            n, c = n + unpacked(a, k), c + unpacked(b, k, d)
        return n, c

    def combine(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        n, c = total(rows, width[key[0]])
        return pd.DataFrame({"shard": [key[0]], "n": [packed(n)], "c": [packed(c)]})

    def replace(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        d, old = width[key[0]], rows["n"].isna()
        n, c = total(rows[~old], d)
        out = unpacked(rows["c"][old].iat[0], k, d).astype(object)
        out[n > 0] = c[n > 0] // n[n > 0].astype(object)[:, None]
        return pd.DataFrame({"shard": [key[0]], "c": [packed(out)]})

    sums = columns.join(assigned.select("block", "cluster"), "block").select("shard", "n", "m", "cluster") \
        .mapInArrow(add, "shard int, lot int, n binary, c binary")
    lots = sums.groupBy("shard", "lot").applyInPandas(combine, "shard int, n binary, c binary")
    before = centroids.select("shard", F.lit(None).cast("binary").alias("n"), "c")
    return lots.unionByName(before).groupBy("shard").applyInPandas(replace, "shard int, c binary")


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, shards: int = SHARDS) -> DataFrame:
    """Vectors (vec_id, embedding) with their cluster after ``rounds`` of Lloyd's algorithm.

    Components are the integers floor(64 * x). The centroids start as the ``k`` vectors
    with the smallest lowercase-hex sha256 of ``1:<vec_id>``; each round assigns all
    vectors to the nearest centroid (ties: the smaller number) and replaces centroids
    that have vectors by their componentwise floor(sum / count). Returns ``vec_id,
    cluster, distance`` (squared), ``cluster_inertia, inertia`` (sums of distances) and
    ``centroid_sha256`` (of the final centroid's components, as decimals joined by
    commas).

    Vectors that are null, hold a null or non-finite component or do not have exactly
    ``dims`` of them take no part. Rows with a null vec_id are assigned and counted but
    never seed; repeated rows count each, and as seeds too. With fewer vectors than
    ``k`` there are as many centroids as vectors with an id; without one, no row.
    Distances beyond a long are compared exactly and cut to its range in the result,
    also in sums. Extra columns are ignored.
    """
    spark = vectors.sparkSession
    edges = _edges(dims, min(shards, dims))
    rows = _kept(vectors, dims)
    seeds = _seeds(rows, k)
    if not seeds:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
                                         "centroid_sha256 string")
    k = len(seeds)
    columns, ids = _column_blocks(rows, dims, edges)
    centroids = _centroid_slices(spark, seeds, edges)
    for _ in range(rounds):
        assigned = staged(spark, nearest(columns, centroids, k, edges), "lloyd-assigned")
        centroids = staged(spark, updated(columns, assigned, centroids, k, edges).coalesce(1), "lloyd-centroids")
    assigned = staged(spark, nearest(columns, centroids, k, edges), "lloyd-assigned")

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                n = len(r["ids"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["ids"], pa.int64()), pa.array(unpacked(r["cluster"], n).astype(np.int32)),
                     pa.array([min(LONG, d) for d in unpacked(r["distance"], n).tolist()], pa.int64())],
                    names=["vec_id", "cluster", "distance"])

    out = staged(spark, ids.join(assigned, "block").select("ids", "cluster", "distance")
                 .mapInArrow(rows_of, "vec_id long, cluster int, distance long"), "lloyd-rows")
    # k rows of sums and hashes.
    slices = {r["shard"]: r["c"] for r in centroids.collect()}
    whole = np.concatenate([unpacked(slices[s], k, y - x) for s, (x, y) in enumerate(zip(edges, edges[1:], strict=False))], axis=1)
    marks = spark.createDataFrame(
        [(i, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for i, row in enumerate(whole.tolist())],
        "cluster int, centroid_sha256 string")

    def cut(x: Column) -> Column:
        return F.least(x, F.lit(LONG).cast("decimal(38,0)")).cast("long")

    sums = out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    known = sums.withColumn("all", F.sum("s").over(Window.partitionBy())).join(F.broadcast(marks), "cluster") \
        .select("cluster", cut(F.col("s")).alias("cluster_inertia"), cut(F.col("all")).alias("inertia"), "centroid_sha256")
    return out.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_lloyd(spark, sf_dir):
    """Cluster of every vector after three rounds from sixteen centroids."""
    return cluster(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    assign = """
a{r} as materialized (
  select vec_id, e, cluster, d from (
    select v.vec_id, v.e, c.cluster, c.c,
           list_sum(list_transform(list_zip(v.e, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as d,
           row_number() over (partition by v.vec_id order by
             list_sum(list_transform(list_zip(v.e, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c.cluster) as rn
    from v, c{r} c) where rn = 1)"""
    update = """,
m{r} as materialized (
  select cluster, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) as c from (
    select cluster, i, cast(sum(e[i]) as bigint) as s, count(*) as n
    from a{r}, (select unnest(range(1, {dims} + 1)) as i) group by cluster, i) group by cluster),
c{next} as materialized (
  select c.cluster, coalesce(m.c, c.c) as c from c{r} c left join m{r} m using (cluster)),"""
    steps = "".join((assign + update).format(r=r, next=r + 1, dims=DIMS) for r in range(ROUNDS)) + assign.format(r=ROUNDS)
    return f"""
with v as materialized (
  select vec_id, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as e
  from embeddings
  where embedding is not null and len(embedding) = {DIMS}
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c0 as materialized (
  select cast(row_number() over (order by sha256('1:' || vec_id)) - 1 as integer) as cluster, e as c
  from v qualify cluster < {CLUSTERS}),
{steps}
select a.vec_id, a.cluster, cast(a.d as bigint) as distance,
       cast(sum(a.d) over (partition by a.cluster) as bigint) as cluster_inertia,
       cast(sum(a.d) over () as bigint) as inertia,
       sha256(array_to_string(c.c, ',')) as centroid_sha256
from a{ROUNDS} a join c{ROUNDS} c using (cluster)
"""


OP11_SQL = _sql()
