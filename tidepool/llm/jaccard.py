"""N-gram Jaccard join by chosen paths.

Every text becomes the set of its five-word shingles, and the set a row of minimum
hashes: two sets agree in a coordinate with the chance of their Jaccard
similarity, and the agreed value stands for a shared token. A run walks down a
tree: a node chooses one coordinate, and with chance 1/threshold - 1 a second, and
sends each of its sets to the child of its value there. So a pair at the threshold
is expected to share one child of each node it shares. Nodes of few sets are
compared by brute force; larger ones are split again, down to ``depth``; what is
still larger then (groups of true near copies, which no token splits) is cut into
blocks that meet pairwise. Runs are repeated until a pair at the threshold is found
with the target recall even if it takes every split.

Comparing has two steps: the hash rows rule out pairs far below the threshold, then
the exact sets of the remaining members decide. A pair counts only in the first
leaf that it shares; tasks return link counts and local components, not pairs.
"""

from __future__ import annotations

import hashlib
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

SHINGLE = 5
SKETCH = 64
LEAF = 64
BLOCK = 512
SEGMENT = 1 << 20
# Texts to read again are first told by a remainder of their hash: so many at most are broadcast.
REMAINDERS = 1 << 20

_RNG = np.random.default_rng(20)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACE = _RNG.integers(1, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)
_TURN = _RNG.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_MULTIPLY = _RNG.integers(1, 1 << 63, SKETCH, dtype=np.uint64) | np.uint64(1)
_ADD = _RNG.integers(1, 1 << 63, SKETCH, dtype=np.uint64)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each word of the texts ``data[off[i]:off[i+1]]``."""
    hashes, starts_at = [], []
    breaks = np.unique(off[:-1])
    lo = 0
    while lo < len(data):
        hi = min(len(data), lo + SEGMENT)
        while hi < len(data):        # a segment ends where a word ends
            found = np.flatnonzero(_BLANK[data[hi:hi + SEGMENT]])
            if len(found):
                hi += int(found[0])
                break
            hi = min(len(data), hi + SEGMENT)
        d = data[lo:hi]
        word = ~_BLANK[d]
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        inside = breaks[(breaks >= lo) & (breaks < hi)] - lo
        begins[inside] = word[inside]
        at = np.flatnonzero(begins)
        if len(at):
            place = np.arange(len(d), dtype=np.int64)[word] - np.repeat(
                at, np.add.reduceat(word.astype(np.int64), at))
            value = np.zeros(len(d), dtype=np.uint64)
            far = (place >> 12).astype(np.uint64) + np.uint64(1)
            value[word] = _BYTE[d[word]] * _PLACE[place & 4095] * (far * np.uint64(2) - np.uint64(1))
            hashes.append(np.add.reduceat(value, at))
            starts_at.append(at + lo)
        lo = hi
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h, at = np.concatenate(hashes), np.concatenate(starts_at)
    return _mix(h), np.searchsorted(off, at, side="right") - 1


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and where each text's begin (one more at the end).

    Words are parted by ASCII white space. A text of one to four words has one
    shingle, all its words; a null text or one without words has none.
    """
    a = texts.fill_null("").cast(pa.large_binary())
    off = np.frombuffer(a.buffers()[1], dtype=np.int64)[a.offset:a.offset + len(a) + 1]
    raw = a.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[off[0]:off[-1]] if raw is not None else np.zeros(0, np.uint8)
    off = off - off[0]
    h, doc = _words(data, off)
    n = np.bincount(doc, minlength=len(a))
    first = np.concatenate([[0], np.cumsum(n)])
    m = len(h) - SHINGLE + 1
    if m > 0:
        s = np.zeros(m, dtype=np.uint64)
        for k in range(SHINGLE):
            s += h[k:k + m] * _TURN[k]
        whole = doc[:m] == doc[SHINGLE - 1:]
        s, d = _mix(s[whole]), doc[:m][whole]
    else:
        s, d = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        one = [int((h[first[i]:first[i] + n[i]] * _TURN[:n[i]]).sum(dtype=np.uint64)) for i in short]
        s = np.concatenate([s, _mix(np.array(one, dtype=np.uint64) + n[short].astype(np.uint64))])
        d = np.concatenate([d, short])
    order = np.lexsort((s, d))
    s, d = s[order], d[order]
    if len(s):
        new = np.concatenate([[True], (s[1:] != s[:-1]) | (d[1:] != d[:-1])])
        s, d = s[new], d[new]
    return s, np.searchsorted(d, np.arange(len(a) + 1))


def sketches(s: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Minimum hashes of each non-empty set (zeros for an empty one): texts by ``SKETCH``."""
    out = np.full((len(at) - 1, SKETCH), 0xFFFFFFFF, dtype=np.uint32)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    for lo in range(0, len(s), 8192):
        x, o = s[lo:lo + 8192], owner[lo:lo + 8192]
        begin = np.flatnonzero(np.concatenate([[True], o[1:] != o[:-1]]))
        who = o[begin]
        for j in range(SKETCH):
            v = ((x * _MULTIPLY[j] + _ADD[j]) >> np.uint64(32)).astype(np.uint32)
            out[who, j] = np.minimum(out[who, j], np.minimum.reduceat(v, begin))
    return out


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for lo in range(0, whole.num_rows, 256):
            b = whole.slice(lo, 256)
            s, at = shingle_sets(b.column("text"))
            raw = s.tobytes()
            keys = [hashlib.blake2b(raw[x * 8:y * 8], digest_size=16).digest() for x, y in zip(at, at[1:], strict=False)]
            sig = sketches(s, at)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("mark"), pa.array(keys, pa.binary()),
                 pa.array(np.diff(at), pa.int64()), pa.array([x.tobytes() for x in sig], pa.binary())],
                names=["doc_id", "mark", "k", "n", "sig"])


def _children(path: np.ndarray, sig: np.ndarray, threshold: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Chosen children of nodes: (row numbers, child paths), one entry per choice."""
    out = []
    rows = np.arange(len(path))
    for turn in (0, 1):
        pick = _mix(path + np.uint64(2 * turn + 1))
        if turn:
            rows = np.flatnonzero((_mix(path + np.uint64(7)) >> np.uint64(11)).astype(np.float64) / (1 << 53)
                                  < 1 / threshold - 1)
        c = (pick[rows] % np.uint64(SKETCH)).astype(np.int64)
        if turn:                     # the same choice again adds nothing
            other = c != out[0][2][rows]
            rows, c = rows[other], c[other]
        child = _mix(_mix(path[rows] + c.astype(np.uint64)) ^ sig[rows, c].astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
        out.append((rows, child, c))
    return [(rows, child) for rows, child, _ in out]


def _matrix(sig) -> np.ndarray:
    return np.frombuffer(b"".join(sig), dtype=np.uint32).reshape(-1, SKETCH)


def _pairs_near(sig: np.ndarray, sub: np.ndarray, split: bool, least: float) -> np.ndarray:
    """Member pairs whose sketches agree in at least the share ``least``."""
    n = len(sig)
    near = np.zeros((n, n), dtype=bool)
    for i in range(n):
        near[i] = np.count_nonzero(sig == sig[i], axis=1) >= least * SKETCH
    np.fill_diagonal(near, False)
    if split:
        near &= sub[:, None] != sub[None, :]
    return near


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the pairwise intersections."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    use = shared[code]
    code, owner = number[code[use]], owner[use]
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    total = int(shared.sum())
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    for lo in range(0, total, 4096):
        a, b = np.searchsorted(code, [lo, lo + 4096])
        m = np.zeros((len(sets), min(4096, total - lo)), dtype=np.float32)
        m[owner[a:b], code[a:b] - lo] = 1
        out += m @ m.T
    return out


def _agreements(threshold: float) -> list[float]:
    """Chances of 0 to ``SKETCH`` equal coordinates for a pair at the threshold."""
    return [math.comb(SKETCH, a) * threshold ** a * (1 - threshold) ** (SKETCH - a) for a in range(SKETCH + 1)]


def missed(threshold: float, depth: int, runs: int, least: float) -> float:
    """Chance that a pair at the threshold that needs every split is not compared: its sketches
    agree in less than ``least``, or no run of ``depth`` splits keeps it together."""
    out = 0.0
    for a, p in enumerate(_agreements(threshold)):
        s = a / SKETCH
        once = 1 - (1 - s) * (1 - s * (1 / threshold - 1))
        out += p * ((1 - once ** depth) ** runs if a >= least * SKETCH else 1.0)
    return out


def runs_and_least(threshold: float, recall: float, depth: int, margin: float) -> tuple[int, float]:
    """Number of runs and least agreement with which ``missed`` stays within ``1 - recall``.
    The screen may take half of it, and is never stricter than ``threshold - margin``."""
    lost, a = 0.0, 0
    for p in _agreements(threshold):
        if lost + p > (1 - recall) / 2:
            break
        lost, a = lost + p, a + 1
    least = min(threshold - margin, a / SKETCH)
    runs = 1
    while missed(threshold, depth, runs, least) > 1 - recall:
        runs += 1
    return runs, least


def join(docs: DataFrame, threshold: float = 0.8, recall: float = 0.9999, depth: int = 3, margin: float = 0.2) -> DataFrame:
    """Near-duplicate links of every row of ``docs`` (doc_id, text): one row per row.

    Columns: ``doc_id, mark`` (hash of the text), ``component`` (a number of the
    group), ``component_id`` (smallest doc_id of the group), ``n_links`` (other
    rows linked directly), ``kept`` (doc_id = component_id). Rows link when the
    Jaccard similarity of their five-word shingle sets is at least ``threshold``.
    Every link is exact; a pair at the threshold is found with the chance
    ``recall`` at least, equal sets always. ``margin`` is how far below the threshold a
    sketch may at least estimate a pair that is still compared (0.2 is four standard
    errors of ``SKETCH`` coordinates); it is more where ``recall`` needs it.

    Texts of one to four words have one shingle. Texts without words (null, empty,
    white space) have equal, empty sets: they are copies of each other and of
    nothing else. Repeated rows link. A null doc_id is never the smallest; a group
    without any doc_id has a null component_id and its rows are kept. An empty
    table gives an empty result; extra columns are ignored.
    """
    spark = docs.sparkSession
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .withColumn("mark", F.xxhash64(F.coalesce("text", F.lit(""))))
    rows = staged(spark, text.mapInArrow(_sketched, "doc_id long, mark long, k binary, n long, sig binary"), "jac-rows")
    classes = staged(spark, rows.groupBy("k").agg(
        F.min(F.struct("doc_id", "mark")).alias("rep"), F.min("doc_id").alias("low"), F.count("*").alias("w"),
        F.first("n").alias("n"), F.first("sig").alias("sig"))
        .select(F.monotonically_increasing_id().alias("cid"), "*"), "jac-classes")

    runs, least = runs_and_least(threshold, recall, depth, margin)
    roots = [int(x) for x in _mix(np.arange(1, runs + 1, dtype=np.uint64))]

    def first_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cid, sig = b.column("cid").to_numpy(), _matrix(b.column("sig").to_pylist())
            for root in roots:
                for at, child in _children(np.full(len(cid), root, dtype=np.uint64), sig, threshold):
                    yield pa.RecordBatch.from_arrays([pa.array(cid[at]), pa.array(child.view(np.int64))], names=["cid", "path"])

    def next_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cid, sig = b.column("cid").to_numpy(), _matrix(b.column("sig").to_pylist())
            for at, child in _children(b.column("path").to_numpy().view(np.uint64), sig, threshold):
                yield pa.RecordBatch.from_arrays([pa.array(cid[at]), pa.array(child.view(np.int64))], names=["cid", "path"])

    sets = classes.filter("n > 0").select("cid", "sig")
    now = staged(spark, sets.mapInArrow(first_level, "cid long, path long"), "jac-level")
    leaves = []
    for level in range(1, depth + 1):
        sizes = staged(spark, now.groupBy("path").agg(F.count("*").alias("m")).filter("m > 1"), "jac-sizes")
        last = level == depth
        small = sizes if last else sizes.filter(F.col("m") <= LEAF)
        leaves.append(now.join(small, "path").select("cid", "path", F.ceil(F.col("m") / BLOCK).cast("int").alias("parts")))
        if last or not (large := sizes.filter(F.col("m") > LEAF).select("path")).head(1):
            break
        now = staged(spark, now.join(large, "path").join(sets, "cid").select("cid", "path", "sig")
                     .mapInArrow(next_level, "cid long, path long"), "jac-level")
    leaf = leaves[0]
    for x in leaves[1:]:
        leaf = leaf.unionByName(x)
    leaf = staged(spark, leaf.distinct(), "jac-leaves")
    places = leaf.groupBy("cid").agg(F.sort_array(F.collect_list("path")).alias("places"))
    member = staged(spark, places.join(classes.select("cid", "sig", "w"), "cid"), "jac-members")
    cells = (leaf.withColumn("sub", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("cid", "path", "sub", F.least("sub", "other").alias("x"), F.greatest("sub", "other").alias("y")))
    key = ["path", "x", "y"]

    def near(b: pd.DataFrame, s: int, e: int) -> np.ndarray:
        sig = _matrix(b["sig"].iloc[s:e])
        close = _pairs_near(sig, b["sub"].to_numpy()[s:e], b["x"].iat[s] != b["y"].iat[s], least)
        some = np.flatnonzero(close.any(axis=1))
        if len(some):
            keep_first_meeting(close, some, [np.asarray(p) for p in b["places"].iloc[s:e]], b["path"].iat[s])
        return close

    def screen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b, bounds in whole_groups(batches, key):
            sig = _matrix(b["sig"])
            two = np.array([s for s, e in bounds if e - s == 2], dtype=np.int64)
            hit = set(two[np.count_nonzero(sig[two] == sig[two + 1], axis=1) >= least * SKETCH].tolist())
            keep = []
            for s, e in bounds:
                if e - s > 2 or s in hit:
                    keep.extend(s + np.flatnonzero(near(b, s, e).any(axis=1)))
            if keep:
                yield b.iloc[keep][["cid", "path", "sub", "x", "y"]]

    suspects = staged(spark, cells.join(member, "cid").repartition(*key).sortWithinPartitions(*key)
                      .mapInPandas(screen, "cid long, path long, sub int, x int, y int"), "jac-suspects")

    def exact_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                b = whole.slice(lo, 256)
                s, at = shingle_sets(b.column("text"))
                raw = s.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [b.column("cid"), pa.array([raw[x * 8:y * 8] for x, y in zip(at, at[1:], strict=False)], pa.binary())],
                    names=["cid", "tokens"])

    wanted = staged(spark, suspects.select("cid").distinct()
                    .join(classes.select("cid", F.col("rep.doc_id").alias("_id"), F.col("rep.mark").alias("_mark")), "cid"),
                    "jac-wanted")
    # At most REMAINDERS numbers, whatever the table: most other texts are not shuffled.
    hint = F.broadcast(wanted.select(F.pmod("_mark", F.lit(REMAINDERS)).alias("_rest")).distinct())
    again = text.join(hint, F.pmod("mark", F.lit(REMAINDERS)) == F.col("_rest"), "left_semi")
    tokens = staged(spark, again.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")))
                    .select("cid", "text").mapInArrow(exact_sets, "cid long, tokens binary")
                    .dropDuplicates(["cid"]), "jac-tokens")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b, bounds in whole_groups(batches, key):
            out = []
            for s, e in bounds:
                if e - s < 2:
                    continue
                close = near(b, s, e)
                some = np.flatnonzero(close.any(axis=1))
                if not len(some):
                    continue
                sets_ = [np.frombuffer(b["tokens"].iat[s + i], dtype=np.uint64) for i in some]
                size = np.array([len(x) for x in sets_])
                both = _common(sets_).astype(np.int64)
                linked = both >= threshold * (size[:, None] + size[None, :] - both) - 1e-9
                close = close[np.ix_(some, some)] & linked
                ids, w = b["cid"].to_numpy()[s + some], b["w"].to_numpy()[s + some]
                hit = close.any(axis=1)
                if hit.any():
                    out.append((ids[hit], (close @ w)[hit], local_labels(ids, close)[hit]))
            if out:
                yield pd.DataFrame({k: np.concatenate(c) for k, c in
                                    zip(("cid", "links", "label"), zip(*out, strict=True), strict=True)})

    found = staged(spark, suspects.join(member, "cid").join(tokens, "cid")
                   .repartition(*key).sortWithinPartitions(*key)
                   .mapInPandas(verify, "cid long, links long, label long")
                   .groupBy("cid", "label").agg(F.sum("links").alias("links")), "jac-links")
    labels = components(found.select(F.col("cid").alias("a"), F.col("label").alias("b")))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    known = (classes.select("cid", "k", "low", "w").join(links, "cid", "left")
             .join(labels.withColumnRenamed("node", "cid"), "cid", "left")
             .withColumn("component", F.coalesce("label", "cid")))
    lowest = known.groupBy("component").agg(F.min("low").alias("component_id"))
    known = known.join(lowest, "component").select(
        "k", "component", "component_id", (F.col("w") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"))
    return rows.select("doc_id", "mark", "k").join(known, "k").select(
        "doc_id", "mark", "component", "component_id", "n_links",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: one with the smallest doc_id.

    Columns stay as they are, whatever their names; of rows that repeat doc_id and text,
    one stays.
    """
    stay = join(docs.select("doc_id", "text"), **options).filter("kept").dropDuplicates(["component"]) \
        .select(F.col("doc_id").alias("stay_id"), F.col("mark").alias("stay_mark"))
    stay = staged(docs.sparkSession, stay, "jac-stay")
    sealed = docs.select(*[F.col(f"`{c}`").alias(f"in_{c}") for c in docs.columns], F.col("doc_id").alias("id"),
                         F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("mark"))
    left = sealed.join(stay, F.col("id").eqNullSafe(F.col("stay_id")) & (F.col("mark") == F.col("stay_mark")), "left_semi")
    return left.dropDuplicates(["id", "mark"]).select(*[F.col(f"`in_{c}`").alias(c) for c in docs.columns])


def op7_jaccard(spark, sf_dir):
    """Links and groups of all documents."""
    return join(table(spark, sf_dir, "documents")).select("doc_id", "component_id", "n_links", "kept")
