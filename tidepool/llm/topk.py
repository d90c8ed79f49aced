"""Exact top-k inner products by columnar branch-and-bound.

Vectors are turned into integers and stored in blocks in vertical layout: one
contiguous row per dimension, with each vector's remaining mass (norm of the
dimensions still to come) at every step. A query block meets a candidate block in
one task; partial products grow by a few dimensions at a time, and after each step
a candidate is dropped once its partial product plus (query mass left x candidate
mass left, the Cauchy-Schwarz bound) is below the k-th best score known. The
survivors are compacted before the next step.

Blocks meet through an equi-join on a grid cell: query blocks are repeated for each
group of candidate blocks, candidate blocks for each query block. Each task hands
on at most k rows a query; the final rank sees k rows per query and group.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import staged, table

SCALE = 256
BLOCK = 8192
# Queries of a block, for each of which every candidate is sent once, and those searched together.
QUERY_BLOCK = 16_384
TOGETHER = 1024
STEP = 16
BLOCK_SCHEMA = "block long, ids binary, dims long, m binary, mass binary"
EXACT = 1 << 53
LONG = (1 << 63) - 1


def _integers(v: np.ndarray) -> np.ndarray:
    """floor(256 * x) of finite doubles: doubles, or Python's integers where the product has none."""
    with np.errstate(over="ignore"):
        m = np.floor(v * SCALE)
    # A double beyond 2 ** 53 is an integer, so its product is one too.
    return m if np.isfinite(m).all() else np.array([int(x) * SCALE if abs(x) >= EXACT else int(np.floor(x * SCALE))
                                                    for x in v.tolist()], dtype=object)


def _double(score: int) -> float:
    """An integer as a double; infinite beyond its range."""
    try:
        return float(score)
    except OverflowError:
        return np.inf if score > 0 else -np.inf


def _order(score: int) -> bytes:
    """Bytes that sort as the scores beyond a long do; none for the others."""
    if -LONG < score < LONG:
        return b""
    raw = abs(score).to_bytes(-(-abs(score).bit_length() // 8), "big")
    key = len(raw).to_bytes(4, "big") + raw
    return key if score > 0 else bytes(255 - x for x in key)


def _valid(vectors: DataFrame) -> DataFrame:
    """Rows with an id and a vector of finite components."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")) \
        .filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Vertical blocks of at most ``size`` vectors; shorter vectors are padded with zeros."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        ids, vectors = [], []

        def flush():
            dims = max((len(v) for v in vectors), default=0)
            whole = [_integers(v) for v in vectors]
            if any(v.dtype == object for v in whole):
                # Components beyond a double: in decimal, without a mass to prune by.
                m = np.zeros((dims, len(ids)), dtype=object)
                for j, v in enumerate(whole):
                    m[:len(v), j] = [int(x) for x in v]
                return pd.DataFrame({"block": [part * 1_000_000 + n], "ids": [np.array(ids, dtype=np.int64).tobytes()],
                                     "dims": [dims], "m": [",".join(map(str, m.ravel())).encode()], "mass": [b""]})
            m = np.zeros((dims, len(ids)))
            for j, v in enumerate(whole):
                m[:len(v), j] = v
            left = np.sqrt(np.flip(np.cumsum(np.flip(m ** 2, 0), 0), 0)) if dims else np.zeros((0, len(ids)))
            kept = np.ascontiguousarray(left[::STEP])
            m = m.astype(np.float32) if not m.size or np.abs(m).max() < 1 << 24 else m
            return pd.DataFrame({"block": [part * 1_000_000 + n], "ids": [np.array(ids, dtype=np.int64).tobytes()],
                                 "dims": [dims], "m": [m.tobytes()], "mass": [kept.tobytes()]})

        for b in batches:
            for i, v in zip(b["vec_id"].to_numpy(), b["embedding"], strict=True):
                ids.append(i)
                vectors.append(np.asarray(v, dtype=np.float64))
                if len(ids) == size:
                    yield flush()
                    ids, vectors, n = [], [], n + 1
        if ids:
            yield flush()

    return rows.mapInPandas(build, BLOCK_SCHEMA)


def _unpack(ids: bytes, dims: int, m: bytes, mass: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, components (dimension by vector) and remaining mass (step by vector)."""
    i = np.frombuffer(ids, dtype=np.int64)
    if dims and not mass:
        return i, np.array([int(x) for x in m.split(b",")], dtype=object).reshape(dims, len(i)), np.zeros((0, len(i)))
    kind = np.float32 if len(m) == 4 * dims * len(i) else np.float64
    a = np.frombuffer(m, dtype=kind).reshape(dims, len(i)).astype(np.float64)
    return i, a, np.frombuffer(mass, dtype=np.float64).reshape(-1, len(i))


class _Best:
    """The k best candidates so far of the queries of one block."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, mass: np.ndarray, k: int):
        self.ids, self.q, self.mass, self.k = ids, q, mass, k
        self.best: list[list[tuple[int, int]]] = [[] for _ in ids]
        self.floor = np.full(len(ids), -np.inf)

    def offer(self, j: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > 4 * self.k:
            limit = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            near = scores >= limit
            scores, ids = scores[near], ids[near]
        found = self.best[j] + [(int(s), -int(i)) for s, i in zip(scores, ids, strict=True)]
        self.best[j] = heapq.nlargest(self.k, found)
        if len(self.best[j]) == self.k:
            self.floor[j] = _double(self.best[j][-1][0])

    def meet(self, ids: np.ndarray, c: np.ndarray, mass: np.ndarray) -> None:
        """Search one candidate block for all queries of this block."""
        dims = min(len(self.q), len(c))
        if self.q.dtype == object or c.dtype == object or \
                np.abs(self.q).max(initial=0) * np.abs(c).max(initial=0) * max(1, dims) >= EXACT:
            return self._exact(ids, c, dims)
        step = min(STEP, dims)
        first = self.q[:step].T @ c[:step] if dims else np.zeros((len(self.ids), len(ids)))
        for j in range(len(self.ids)):
            alive = np.flatnonzero(ids != self.ids[j])
            part = first[j][alive]
            at = step
            while True:
                rest = at < dims
                room = self.mass[at // STEP, j] * mass[at // STEP, alive] if rest else 0.0
                # The k-th largest lower bound is a floor for the final k-th score.
                floor = self.floor[j]
                if rest and len(alive) > self.k:
                    low = part - room
                    floor = max(floor, np.partition(low, len(low) - self.k)[len(low) - self.k])
                # One unit of slack covers the rounding of the square roots.
                keep = part + room >= floor - (1.0 if rest else 0.0)
                if not keep.all():
                    alive, part = alive[keep], part[keep]
                if not rest or not len(alive):
                    break
                to = min(dims, at + STEP)
                part = part + self.q[at:to, j] @ c[at:to][:, alive]
                at = to
            if len(alive):
                self.offer(j, part, ids[alive])

    def _exact(self, ids: np.ndarray, c: np.ndarray, dims: int) -> None:
        """Python integers, for products beyond the exact range of a double."""
        cols = [[int(x) for x in c[:dims, i]] for i in range(len(ids))]
        for j in range(len(self.ids)):
            q = [int(x) for x in self.q[:dims, j]]
            scored = [(sum(a * b for a, b in zip(q, col, strict=True)), -int(i))
                      for i, col in zip(ids, cols, strict=True) if i != self.ids[j]]
            self.best[j] = heapq.nlargest(self.k, self.best[j] + scored)
            if len(self.best[j]) == self.k:
                self.floor[j] = _double(self.best[j][-1][0])

    def rows(self) -> pa.RecordBatch:
        found = [(int(q), -i, max(-LONG, min(LONG, s)), _order(s)) for q, b in zip(self.ids, self.best, strict=True) for s, i in b]
        return pa.RecordBatch.from_pydict({c: [r[j] for r in found] for j, c in enumerate(FOUND.names)}, FOUND)


FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("exact", pa.binary())])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, groups: int = 16) -> DataFrame:
    """The ``k`` best candidates of each query: ``query_id, rank, vec_id, score``.

    Both tables hold ``vec_id, embedding``. The score is the inner product of the
    vectors with components ``floor(256 * x)``; ties go to the smaller vec_id, and
    a candidate with the query's own vec_id is left out. Rows with a null vec_id,
    a null vector, or a null or non-finite component take no part; components
    missing at the end of a shorter vector count as 0. Repeated rows are separate
    candidates, and queries that repeat a vec_id share one result, the best over
    their rows. Scores beyond a long are ranked as they are and cut to its range in the
    result; components may be as large as a double. Fewer than ``k`` candidates give fewer rows; no query or no candidate gives none.

    ``groups`` candidate groups bound how often a query block is repeated.
    """
    spark = vectors.sparkSession
    q = staged(spark, _valid(queries), "topk-queries")
    n_blocks = max(1, -(-q.count() // QUERY_BLOCK))
    q_blocks = staged(spark, _blocks(q.repartition(n_blocks, "vec_id"), QUERY_BLOCK), "topk-query-blocks")
    c_blocks = staged(spark, _blocks(_valid(vectors), BLOCK), "topk-blocks")
    numbered = q_blocks.select(
        F.pmod(F.xxhash64("block"), F.lit(n_blocks).cast("long")).alias("h"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"),
        F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("dims").alias("q_dims"),
        F.col("m").alias("q_m"), F.col("mass").alias("q_mass"))
    repeated = c_blocks.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("h"),
        F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("g"), "block", "ids", "dims", "m", "mass")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, best = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if r["q_block"] != current:
                    yield from (b.rows() for b in best)
                    ids, q, mass = _unpack(r["q_ids"], r["q_dims"], r["q_m"], r["q_mass"])
                    current, best = r["q_block"], [
                        _Best(ids[lo:lo + TOGETHER], np.ascontiguousarray(q[:, lo:lo + TOGETHER]), mass[:, lo:lo + TOGETHER], k)
                        for lo in range(0, len(ids), TOGETHER)]
                block = _unpack(r["ids"], r["dims"], r["m"], r["mass"])
                for b in best:
                    b.meet(*block)
        yield from (b.rows() for b in best)

    pairs = repeated.join(numbered.hint("shuffle_hash"), ["h", "g"]).sortWithinPartitions("q_block")
    found = pairs.select("q_block", "q_ids", "q_dims", "q_m", "q_mass", "ids", "dims", "m", "mass") \
        .mapInArrow(search, "query_id long, vec_id long, score long, exact binary")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("exact"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op3_topk(spark, sf_dir):
    """Five best of all vectors for each vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"))


OP3_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id,
         cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0
), r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 5
"""
