"""Embedding near-duplicates by spherical-cap filters with structured product codes.

A filter is a direction made of one random unit code word for each half of the
dimensions, which are turned at random first; a book of B words a half gives B^2
filters, and there are eight such codes. A vector passes the filters
whose inner product with it exceeds a threshold (of each code one at least). These are listed without trying
all: with the second half's products sorted, each word of the first half takes a
prefix of them. Vectors that share a filter meet there as sketches of a byte a
component, whose error is known; those that may link meet again whole and are compared
exactly.

The number of filters follows the number of vectors, so that a filter holds about
``bucket`` unrelated vectors at any size; the threshold follows from how many
filters a vector must pass for a pair at the least similarity to share one with the
target recall. Equal vectors are one class with a weight. A filter with many
vectors is cut into blocks that meet pairwise, and a pair counts only in the first
filter that it shares, so tasks return link counts and local components, not pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.cells import keep_first_meeting, local_labels, whole_groups
from tidepool.llm.common import staged, table
from tidepool.llm.graph import components

BLOCK = 1024
ROTATIONS = 8
LEAST_DIMS = 16


class CapCode:
    """The filters of one dimension count: code words, threshold, list decoding.

    There are ``ROTATIONS`` independent codes. Each turns the vectors at random
    (short ones into ``LEAST_DIMS`` dimensions), which keeps all cosines, and pairs
    the words of two books, one for each half of the turned dimensions.
    """

    def __init__(self, dims: int, book: int, passes: float, seed: int = 11):
        rng = np.random.default_rng([seed, dims])
        self.book, wide = book, max(LEAST_DIMS, dims)
        self.codes = []
        for _ in range(ROTATIONS):
            turn = np.linalg.qr(rng.standard_normal((wide, wide)))[0][:, :dims]
            halves = [rng.standard_normal((book, h)) for h in (wide // 2, wide - wide // 2)]
            halves = [w / np.linalg.norm(w, axis=1, keepdims=True) for w in halves]
            # Products of a vector with the words, turning included.
            self.codes.append((halves[0] @ turn[:wide // 2], halves[1] @ turn[wide // 2:]))
        # The threshold that random directions exceed for `passes` filters on average.
        x = rng.standard_normal((128, dims))
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        sums = [(a, np.sort(b, axis=1)) for a, b in ((x @ u.T, x @ w.T) for u, w in self.codes)]
        lo, hi = -2.0, 2.0
        for _ in range(40):
            mid = (lo + hi) / 2
            n = sum((book - np.searchsorted(r, mid - s, side="left")).sum()
                    for a, b in sums for s, r in zip(a, b, strict=True))
            lo, hi = (mid, hi) if n > passes * len(x) else (lo, mid)
        self.limit = lo

    def decode(self, x: np.ndarray) -> list[np.ndarray]:
        """For each unit row, the sorted numbers of all filters it passes; of a code
        none of whose filters it passes, the nearest one."""
        rows, book = len(x), self.book
        apart = np.arange(rows)[:, None] * 8.0      # sums lie within -2 and 2
        owner, number = [], []
        for c, (u, w) in enumerate(self.codes):
            a, b = x @ u.T, x @ w.T
            order = np.argsort(-b, axis=1, kind="stable")
            falling = np.take_along_axis(b, order, axis=1)
            # How many words of the second half each word of the first goes with, for all rows at once.
            n = np.searchsorted((apart - falling).ravel(), (a - self.limit + apart).ravel(), side="right") \
                .reshape(rows, book) - np.arange(rows)[:, None] * book
            none = np.flatnonzero(n.sum(axis=1) == 0)
            n[none, a[none].argmax(axis=1)] = 1
            n = n.ravel()
            who = np.repeat(np.arange(rows * book), n)
            row, word = who // book, who % book
            place = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
            owner.append(row)
            number.append((c * book + word) * book + order[row, place])
        owner, number = np.concatenate(owner), np.concatenate(number)
        sort = np.lexsort((number, owner))
        return np.split(number[sort], np.searchsorted(owner[sort], np.arange(1, rows)))


def passes_for(recall: float, cosine: float, rate: float) -> float:
    """Filters a vector must pass on average for a pair at ``cosine`` to share one with ``recall``.

    ``rate`` is the share of filters that a vector passes; both ends of a pair pass
    a given one with the tail probability of two normal variables correlated by
    ``cosine``, and shared filters are counted as Poisson.
    """
    grid = np.linspace(0, 8, 4001)
    tail = np.array([0.5 * math.erfc(t / math.sqrt(2)) for t in grid])
    t = grid[np.searchsorted(-tail, -rate)]
    x = np.linspace(t, t + 6, 2000)
    density = np.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    other = np.array([0.5 * math.erfc((t - cosine * v) / math.sqrt(2 * (1 - cosine ** 2))) for v in x])
    both = np.trapezoid(density * other, x) / np.trapezoid(density, x)
    return -math.log(1 - recall) / both


def sketches(units: np.ndarray) -> list[bytes]:
    """Unit vectors in a byte a component: each with its scale and its distance from the vector."""
    scale = (np.abs(units).max(axis=1) / 127).astype(np.float32)
    small = np.rint(units / scale[:, None]).astype(np.int8)
    off = np.linalg.norm(units - small * scale[:, None].astype(np.float64), axis=1)
    # Rounded up, so that the distance is never told too small.
    head = np.stack([scale, np.nextafter(off.astype(np.float32), np.float32(np.inf))], axis=1)
    return [h.tobytes() + q.tobytes() for h, q in zip(head, small, strict=True)]


def _may_link(rows: pd.DataFrame, cell: tuple[int, int], cosine: float) -> np.ndarray:
    """Members of one cell that may link with another, by their sketches: no one that does is left out."""
    raw = np.stack([np.frombuffer(x, dtype=np.uint8) for x in rows["sketch"]])
    head = np.ascontiguousarray(raw[:, :8]).view(np.float32)
    q = np.ascontiguousarray(raw[:, 8:]).view(np.int8).astype(np.float32) * head[:, :1]
    off = head[:, 1]
    # The cosine differs by no more than both distances allow, and by the rounding of the product.
    close = q @ q.T >= cosine - (off[:, None] + off[None, :] + off[:, None] * off[None, :]) - 1e-4
    np.fill_diagonal(close, False)
    if cell[0] != cell[1]:
        sub = rows["sub"].to_numpy()
        close &= sub[:, None] != sub[None, :]
    return np.flatnonzero(close.any(axis=1))


def _meet(rows: pd.DataFrame, cell: tuple[int, int], number: int, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked members of one cell: class ids, weights of their links, smallest class reached here."""
    v = np.stack([np.frombuffer(x, dtype=np.float64) for x in rows["v"]])
    sub = rows["sub"].to_numpy()
    close = v @ v.T >= cosine
    np.fill_diagonal(close, False)
    if cell[0] != cell[1]:
        close &= sub[:, None] != sub[None, :]
    i, j = np.nonzero(close)
    if not len(i):
        none = np.zeros(0, np.int64)
        return none, none, none
    # A pair that shares an earlier filter was counted there.
    keep_first_meeting(close, np.unique(i), [np.frombuffer(x, dtype=np.int64) for x in rows["filters"]], number)
    ids, weight = rows["cid"].to_numpy(), rows["w"].to_numpy()
    links = close @ weight
    label = local_labels(ids, close)
    some = np.flatnonzero(close.any(axis=1))
    return ids[some], links[some], label[some]


def linked(vectors: DataFrame, cosine: float = 0.95, recall: float = 0.9999, bucket: int = 64) -> DataFrame:
    """Links of every row of ``vectors`` (vec_id, embedding): one row per row.

    ``vec_id, n_links`` (other rows linked directly), ``component_id`` (smallest
    vec_id reachable), ``kept`` (vec_id = component_id). Two rows link when their
    cosine in double precision is at least ``cosine``; none below is linked, and a
    pair at exactly ``cosine`` is found with the chance ``recall``, closer ones
    with a higher one. Vectors that are null, zero, empty or hold null or
    non-finite components link with nothing, and vectors of different lengths are
    not compared. Repeated rows link with each other; a null vec_id is never a
    component's smallest, and a component without any id has a null one and keeps
    its rows. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    fine = (F.size("e") > 0) & F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists("e", lambda x: x != 0)
    rows = rows.select("vec_id", F.when(F.coalesce(fine, F.lit(False)), F.col("e")).alias("e")).select(
        "vec_id", "e", F.when(F.col("e").isNotNull(), F.xxhash64("e")).alias("k1"),
        F.when(F.col("e").isNotNull(), F.xxhash64(F.lit(1), "e")).alias("k2"))
    classes = staged(spark, rows.filter("e is not null").groupBy("k1", "k2")
                     .agg(F.min("vec_id").alias("low"), F.count("*").alias("w"), F.first("e").alias("e"))
                     .select(F.monotonically_increasing_id().alias("cid"), "k1", "k2", "low", "w", "e"), "cap-classes")
    n = max(1, classes.count())

    passes = 16.0
    for _ in range(20):          # lists vary in length, so a third more than the mean is asked for
        book = max(8, math.ceil(math.sqrt(passes * n / bucket / ROTATIONS)))
        passes = 4 / 3 * passes_for(recall, cosine, min(0.4, passes / book ** 2 / ROTATIONS))
    codes: dict[int, CapCode] = {}

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                b = whole.slice(start, 512)
                vs = [np.asarray(x, dtype=np.float64) for x in b.column("e").to_pylist()]
                found: list = [None] * len(vs)
                unit: list = [None] * len(vs)
                sketch: list = [None] * len(vs)
                for d in {len(x) for x in vs}:
                    at = [i for i, x in enumerate(vs) if len(x) == d]
                    if d not in codes:
                        codes[d] = CapCode(d, book, passes)
                    m = np.stack([vs[i] for i in at])
                    m = m / np.abs(m).max(axis=1, keepdims=True)
                    m = m / np.linalg.norm(m, axis=1, keepdims=True)
                    for i, row, f, short in zip(at, m, codes[d].decode(m), sketches(m), strict=True):
                        found[i] = f + d * (1 << 40)
                        unit[i], sketch[i] = row.tobytes(), short
                yield pa.RecordBatch.from_arrays(
                    [b.column("cid"), b.column("w"), pa.array(unit, pa.binary()), pa.array(sketch, pa.binary()),
                     pa.array([f.astype(np.int64).tobytes() for f in found], pa.binary()),
                     pa.array(found, pa.list_(pa.int64()))], names=["cid", "w", "v", "sketch", "filters", "list"])

    passed = staged(spark, classes.select("cid", "w", "e").mapInArrow(
        decode, "cid long, w long, v binary, sketch binary, filters binary, list array<long>"), "cap-filters")
    sizes = passed.select(F.explode("list").alias("f")).groupBy("f").agg(F.count("*").alias("m"))
    crowded = staged(spark, sizes.filter(F.col("m") > BLOCK).select(
        "f", F.ceil(F.col("m") / BLOCK).cast("int").alias("parts")), "cap-crowded")
    # Filters get a class id and a sketch of each vector; whole vectors and lists only follow those that may link.
    members = (passed.select("cid", "sketch", F.explode("list").alias("f")).join(crowded, "f", "left")
               .withColumn("parts", F.coalesce("parts", F.lit(1)))
               .withColumn("sub", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
               .select("f", F.least("sub", "other").alias("x"), F.greatest("sub", "other").alias("y"),
                       "sub", "cid", "sketch"))
    cell = ["f", "x", "y"]

    def screen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b, bounds in whole_groups(batches, cell):
            some = [s + _may_link(b.iloc[s:e], (b["x"].iat[s], b["y"].iat[s]), cosine) for s, e in bounds if e - s > 1]
            if some and len(at := np.concatenate(some)):
                yield b.iloc[at][[*cell, "sub", "cid"]]

    suspects = staged(spark, members.repartition(*cell).sortWithinPartitions(*cell)
                      .mapInPandas(screen, "f long, x int, y int, sub int, cid long"), "cap-suspects")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b, bounds in whole_groups(batches, cell):
            out = [_meet(b.iloc[s:e], (b["x"].iat[s], b["y"].iat[s]), b["f"].iat[s], cosine)
                   for s, e in bounds if e - s > 1]
            if out:
                yield pd.DataFrame({k: np.concatenate(c) for k, c in
                                    zip(("cid", "links", "label"), zip(*out, strict=True), strict=True)})

    found = staged(spark, suspects.join(passed.select("cid", "w", "v", "filters"), "cid")
                   .repartition(*cell).sortWithinPartitions(*cell)
                   .mapInPandas(compare, "cid long, links long, label long")
                   .groupBy("cid", "label").agg(F.sum("links").alias("links")), "cap-links")
    labels = components(found.select(F.col("cid").alias("a"), F.col("label").alias("b")))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    known = (classes.select("cid", "k1", "k2", "low", "w").join(links, "cid", "left")
             .join(labels.withColumnRenamed("node", "cid"), "cid", "left")
             .withColumn("label", F.coalesce("label", "cid")))
    lowest = known.groupBy("label").agg(F.min("low").alias("component_id"))
    known = known.join(lowest, "label").select(
        "k1", "k2", (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = rows.select("vec_id", "k1", "k2").join(known, ["k1", "k2"], "left")
    component = F.when(F.col("k1").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def op8_caps(spark, sf_dir):
    """Links and components of all vectors."""
    return linked(table(spark, sf_dir, "embeddings"))
