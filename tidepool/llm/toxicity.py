"""Toxicity from the nearest labelled examples, by exact TF-IDF cosine.

A bounded sample of labelled rows gives the examples. Their terms are words, all of
them. A term's idf is counted over the examples and multiplied by its lean, 1 + z²,
where z is how many standard deviations the toxic examples among those that hold it
lie above chance (0 below chance): so the few words that decide outweigh the many
that do not, and no term is left out.

The weights form an inverted index cut into blocks of neighbouring examples; each
(term, block) entry has its largest weight. A query adds up these maxima to an upper
bound for every block, reads blocks from the highest bound down, and stops when no
block left can hold a nearer example than the k-th found: the neighbours are exact.
Within a block, a term that many examples have keeps their weights as one row, zeros
among them, and the queries that want a block read its rows together, as one product;
other terms keep lists.

The nearest examples vote with the inverse of their distance. The vote is turned
into a probability by a monotone fit on the sample, each fold of which is scored by
the other folds alone. The score comes with its evidence: the neighbours and the leaning terms.

Terms are known by a 64-bit hash. Of the sample, which is bounded in rows and in
characters, packed term numbers and counts pass the driver; its texts do not.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.common import held, staged, table

# The bounds of the sample: rows, characters of all its texts and of one text.
SAMPLE_ROWS = 4_000
SAMPLE_CHARS = 32 << 20
LONGEST_EXAMPLE = 1 << 19
NEIGHBOURS = 15
BLOCK = 128
FIRST_BLOCKS = 4
# A term of at least one in so many examples has rows instead of lists.
ROWS_FROM = 16
# Standard deviations above chance by which blocks are arranged (weights know no such bound).
LEANING = 4.0
# Folds of the sample for the fit of the votes.
FOLDS = 4
# Texts searched together, and their terms.
TOGETHER = 32
TERMS_TOGETHER = 1 << 15
_WORD = re.compile(r"[^\W_]+")


def _words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _marks(words: list[str]) -> np.ndarray:
    """64-bit hashes of words."""
    return np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words], dtype=np.uint64)


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers ``first[i] .. first[i] + n[i]`` of all i, in order."""
    out = np.repeat(first - np.cumsum(n) + n, n)
    out += np.arange(len(out))
    return out


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


class Index:
    """The examples as a block-max inverted index over all their terms."""

    def __init__(self, ids: np.ndarray, toxic: np.ndarray, at: np.ndarray, marks: np.ndarray, term: np.ndarray,
                 count: np.ndarray):
        """Example ``e`` has the terms numbered ``term[at[e]:at[e + 1]]``, as often as ``count``
        says; ``marks`` are the sorted hashes of the terms."""
        n, v = len(ids), len(marks)
        self.marks, self.rate = marks, float(toxic.mean()) if n else 0.0
        owner = np.repeat(np.arange(n), np.diff(at))
        df = np.bincount(term, minlength=v)
        bad = np.bincount(term, toxic[owner], minlength=v)
        self.lean = np.maximum(0, (bad - df * self.rate) / np.sqrt(np.maximum(
            df * self.rate * (1 - self.rate), 1e-9))) if 0 < self.rate < 1 else np.zeros(v)
        self.idf = (np.log((1 + n) / (1 + df)) + 1) * (1 + self.lean ** 2)
        weight = (1 + np.log(count)) * self.idf[term]
        weight /= np.sqrt(np.bincount(owner, weight * weight, minlength=n))[owner]
        # Examples that share their heaviest leaning term, or else their most frequent common one
        # (which tells languages apart), share blocks.
        common = df[term] >= max(2, n // 32)
        speaks = np.where(self.lean[term] > LEANING, weight, 0)
        order = np.lexsort((ids, self._theme(at, owner, term, common * count), self._theme(at, owner, term, speaks)))
        place = np.empty(n, dtype=np.int64)
        place[order] = np.arange(n)
        self.ids, self.toxic, owner = ids[order], toxic[order], place[owner]
        by = np.lexsort((owner, term))
        term, self.example, self.weight = term[by], owner[by], weight[by]
        self.blocks = -(-n // BLOCK)
        slot = term.astype(np.int64) * max(1, self.blocks) + self.example // BLOCK
        first = np.flatnonzero(np.diff(slot, prepend=-1))
        self.posting_at = np.append(first, len(term))
        self.block = self.example[first] // BLOCK
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        self.entry_at = np.searchsorted(term[first], np.arange(v + 1))
        # Rows take at most ROWS_FROM times the room of the weights that they hold.
        often = np.flatnonzero(df * ROWS_FROM >= max(1, self.blocks * BLOCK))
        self.row = np.full(v, -1)
        self.row[often] = np.arange(len(often))
        row = self.row[term]
        here = np.flatnonzero(row >= 0)
        self.rows = np.zeros((self.blocks, len(often), BLOCK))
        self.rows[self.example[here] // BLOCK, row[here], self.example[here] % BLOCK] = self.weight[here]
        self.peak = self.rows.max(axis=2, initial=0.0)
        self.memory: dict[str, int] = {}

    @staticmethod
    def _theme(at: np.ndarray, owner: np.ndarray, term: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Of each example, the term of the largest value; -1 where none is above 0."""
        theme, some = np.full(len(at) - 1, -1), np.diff(at) > 0
        largest = np.lexsort((term, -value, owner))[at[:-1][some]]
        theme[some] = np.where(value[largest] > 0, term[largest], -1)
        return theme

    def counts(self, words: list[str], limit: int = 250_000) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """The known terms of a text: their numbers, counts and words."""
        often, memory = Counter(words), self.memory
        number = list(map(memory.get, often))
        if None in number:
            if len(memory) > limit:
                memory.clear()
            new = [w for w, x in zip(often, number, strict=True) if x is None]
            marks = _marks(new)
            at = np.minimum(np.searchsorted(self.marks, marks), max(0, len(self.marks) - 1))
            known = self.marks[at] == marks if len(self.marks) else np.zeros(len(new), dtype=bool)
            found = np.where(known, at, -1).tolist()
            memory.update(zip(new, found, strict=True))
            rest = iter(found)
            number = [next(rest) if x is None else x for x in number]
        terms, count = np.array(number, dtype=np.int64), np.array(list(often.values()), dtype=np.int64)
        known = terms >= 0
        return terms[known], count[known], list(compress(often, known.tolist()))

    def nearest(self, terms: np.ndarray, counts: np.ndarray, k: int = NEIGHBOURS) -> list[tuple[float, int]]:
        """The k nearest examples as (similarity, example); ties go to the earlier example.

        The cosine is over the terms that any example has.
        """
        return self.nearest_of([(terms, counts)], k)[0]

    def nearest_of(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS) -> list[list[tuple[float, int]]]:
        """The k nearest examples of each query (its terms and counts).

        Of each query, the blocks of the highest bounds are read first; then, at once,
        all others whose bound reaches the k-th similarity found.
        """
        m, size = len(queries), [len(terms) for terms, _ in queries]
        if not sum(size):
            return [[] for _ in queries]
        owner, terms = np.repeat(np.arange(m), size), np.concatenate([terms for terms, _ in queries])
        q = (1 + np.log(np.concatenate([counts for _, counts in queries]))) * self.idf[terms]
        q /= np.sqrt(np.bincount(owner, q * q, minlength=m))[owner]
        row = self.row[terms]
        rare = row < 0
        by_row = np.zeros((m, self.rows.shape[1]))
        by_row[owner[~rare], row[~rare]] = q[~rare]
        terms, owner = terms[rare], owner[rare]
        n = self.entry_at[terms + 1] - self.entry_at[terms]
        entry, share, owner = _ranges(self.entry_at[terms], n), np.repeat(q[rare], n), np.repeat(owner, n)
        # The place of each entry's query and block.
        place = owner * self.blocks + self.block[entry]
        bound = np.bincount(place, self.most[entry] * share, minlength=m * self.blocks).reshape(m, -1) + by_row @ self.peak.T
        chosen = np.zeros(bound.shape, dtype=bool)
        np.put_along_axis(chosen, np.argsort(-bound, axis=1, kind="stable")[:, :FIRST_BLOCKS], True, axis=1)
        score = self._read(chosen, place, entry, share, by_row)
        floor = self._least(score, k)
        # The slack covers rounding; a block that only ties may hold an earlier example.
        more = (bound >= np.maximum(floor - 1e-9, 1e-12)[:, None]) & ~chosen
        if more.any():
            score += self._read(more, place, entry, share, by_row)
            floor = self._least(score, k)
        who, near = np.nonzero((score > 0) & (score >= floor[:, None] - 1e-8))
        value = score[who, near]
        by = np.lexsort((near, -np.round(value, 9), who))
        near, value, first = near[by].tolist(), value[by].tolist(), np.searchsorted(who, np.arange(m + 1)).tolist()
        return [list(zip(value[lo:min(hi, lo + k)], near[lo:min(hi, lo + k)], strict=True))
                for lo, hi in zip(first, first[1:], strict=False)]

    @staticmethod
    def _least(score: np.ndarray, k: int) -> np.ndarray:
        """The k-th highest similarity of each query; 0 where there are fewer."""
        n = score.shape[1]
        return np.partition(score, n - k, axis=1)[:, n - k] if n >= k else np.zeros(len(score))

    def _read(self, wanted: np.ndarray, place: np.ndarray, entry: np.ndarray, share: np.ndarray,
              by_row: np.ndarray) -> np.ndarray:
        """Similarity of each query and example of the blocks it wants; 0 in others and in what the last block lacks."""
        here = np.flatnonzero(wanted.ravel()[place])
        place, entry, share = place[here], entry[here], share[here]
        first = self.posting_at[entry]
        n = self.posting_at[entry + 1] - first
        at = _ranges(first, n)
        # The examples of a query lie one after another, as its blocks do.
        example = self.example[at] + np.repeat(place // self.blocks * (self.blocks * BLOCK), n)
        score = np.bincount(example, self.weight[at] * np.repeat(share, n), minlength=wanted.size * BLOCK) \
            .astype(float, copy=False).reshape(len(wanted), self.blocks, BLOCK)
        if by_row.shape[1]:
            for b in np.flatnonzero(wanted.any(axis=0)).tolist():
                who = np.flatnonzero(wanted[:, b])
                score[who, b] += by_row[who] @ self.rows[b]
        return score.reshape(len(wanted), -1)

    def shared(self, example: int, terms: np.ndarray) -> np.ndarray:
        """Positions in ``terms`` of those this example has, the heaviest first."""
        n = self.entry_at[terms + 1] - self.entry_at[terms]
        entry, owner = _ranges(self.entry_at[terms], n), np.repeat(np.arange(len(terms)), n)
        here = self.block[entry] == example // BLOCK
        entry, owner = entry[here], owner[here]
        n = self.posting_at[entry + 1] - self.posting_at[entry]
        at, owner = _ranges(self.posting_at[entry], n), np.repeat(owner, n)
        has = self.example[at] == example
        return owner[has][np.lexsort((owner[has], -self.weight[at[has]]))]


def vote(near: list[tuple[float, int]], toxic: np.ndarray, otherwise: float) -> float:
    """Share of the neighbours that is toxic, each weighed by the inverse of its distance."""
    if not near:
        return otherwise
    w = np.array([1 / (0.02 + max(0.0, 1 - s)) for s, _ in near])
    return float(w @ toxic[[e for _, e in near]] / w.sum())


def monotone_fit(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing least-squares fit of labels to votes."""
    order = np.argsort(votes, kind="stable")
    groups: list[list[float]] = []           # sum of labels, rows, sum of votes
    for v, y in zip(votes[order], labels[order], strict=True):
        groups.append([float(y), 1.0, float(v)])
        while len(groups) > 1 and groups[-2][0] / groups[-2][1] >= groups[-1][0] / groups[-1][1]:
            last = groups.pop()
            groups[-1] = [a + b for a, b in zip(groups[-1], last, strict=True)]
    x = np.array([g[2] / g[1] for g in groups])
    return x, np.array([(g[0] + 0.5) / (g[1] + 1) for g in groups])


class Sent:
    """The packed examples; each Python worker builds its index where it uses it first."""

    def __init__(self, parts: tuple, name: str | None = None):
        self.parts, self.name = parts, name or uuid.uuid4().hex

    def __reduce__(self):
        return Sent, (self.parts, self.name)

    def index(self, without_fold: int | None = None) -> Index:
        """The index of all examples, or of those of the other folds; a worker holds one at a time."""
        return held(("examples", self.name, without_fold), lambda: self._built(without_fold))

    def _built(self, without_fold: int | None) -> Index:
        ids, toxic, at, *rest = self.parts
        marks, term, count = (np.frombuffer(zlib.decompress(x), dtype=k) for x, k in
                              zip(rest, (np.uint64, np.int32, np.int32), strict=True))
        if without_fold is not None:
            stay = fold_of(ids) != without_fold
            n = np.diff(at)
            inside = np.repeat(stay, n)
            ids, toxic, at = ids[stay], toxic[stay], np.concatenate([[0], np.cumsum(n[stay])])
            used, term = np.unique(term[inside], return_inverse=True)
            marks, count = marks[used], count[inside]
        return Index(ids, toxic, at, marks, term, count)


def fold_of(ids: np.ndarray) -> np.ndarray:
    """The fold of each example, by its number."""
    return (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % FOLDS


@dataclass
class Model:
    """What scoring needs: the examples, as one broadcast, and the fit."""

    examples: Broadcast
    knots: tuple[np.ndarray, np.ndarray] | None = None

    def votes(self, texts: list[str | None], without_fold: int | None = None
              ) -> Iterator[tuple[float, list[tuple[float, int]], list[str]]]:
        """Of each text the vote, the nearest examples, and the terms that speak for it."""
        index, some, size = self.examples.value.index(without_fold), [], 0
        for text in texts:
            some.append(index.counts(_words(text)))
            size += len(some[-1][0])
            if len(some) == TOGETHER or size >= TERMS_TOGETHER:
                yield from self._votes(index, some)
                some, size = [], 0
        yield from self._votes(index, some)

    @staticmethod
    def _votes(index: Index, some: list[tuple[np.ndarray, np.ndarray, list[str]]]) -> Iterator[tuple]:
        found = index.nearest_of([x[:2] for x in some])
        for (terms, counts, words), near in zip(some, found, strict=True):
            leans = np.flatnonzero(index.lean[terms] > 0)
            weight = (1 + np.log(counts[leans])) * index.idf[terms[leans]]
            speak = leans[np.lexsort((leans, -weight))[:10]]
            if not len(speak) and near:
                speak = index.shared(near[0][1], terms)[:10]
            yield vote(near, index.toxic, index.rate), near, [words[i] for i in speak.tolist()]


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """The examples learnt from at most ``sample_rows`` labelled rows; None without labels.

    The sample has the smallest hashes of doc_id, so that it does not depend on the
    order of rows; repeated labels of an id count as toxic if any is, rows of a
    repeated doc_id give their first text in byte order, and equal texts are learnt
    once. Texts of more than ``LONGEST_EXAMPLE`` characters are no examples, nor are
    those beyond ``SAMPLE_CHARS`` characters in all.
    """
    spark = docs.sparkSession
    sample = staged(spark, labels.filter("toxic is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
                    .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
                    .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows), "tox-sample")
    # Bounded by sample_rows pairs of numbers.
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
            .filter(F.coalesce(F.length("text"), F.lit(0)) <= LONGEST_EXAMPLE)
            .groupBy(F.xxhash64("text").alias("mark")).agg(F.min(F.struct("doc_id", "toxic", "text")).alias("r"))
            .select("r.*").withColumn("chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")))
    rows = staged(spark, rows, "tox-rows")
    so_far = Window.partitionBy().orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    within = rows.select("doc_id", F.sum("chars").over(so_far).alias("total")).filter(F.col("total") <= SAMPLE_CHARS)
    rows = staged(spark, rows.drop("chars").join(F.broadcast(within.select("doc_id")), "doc_id"), "tox-examples")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            terms, often = [], []
            for text in b.column("text").to_pylist():
                counted = Counter(_words(text))
                marks, at = np.unique(_marks(list(counted)), return_index=True)
                terms.append(marks.tobytes())
                often.append(np.array(list(counted.values()), dtype=np.int32)[at].tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), pa.array(terms, pa.binary()),
                                              pa.array(often, pa.binary())], names=["doc_id", "toxic", "t", "c"])

    got = rows.select("doc_id", "text", "toxic").mapInArrow(vectors, "doc_id long, toxic int, t binary, c binary") \
        .toArrow().sort_by("doc_id")
    if not got.num_rows:
        return None
    per = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in got.column("t")]
    marks, term = np.unique(np.concatenate(per), return_inverse=True)
    count = b"".join(x.as_py() for x in got.column("c"))
    model = Model(spark.sparkContext.broadcast(Sent((
        got.column("doc_id").to_numpy(), got.column("toxic").to_numpy(), np.concatenate([[0], np.cumsum([len(x) for x in per])]),
        *(zlib.compress(x, 1) for x in (marks.tobytes(), term.astype(np.int32).tobytes(), count))))))

    def own_votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            folds, texts = fold_of(b.column("doc_id").to_numpy()), b.column("text").to_pylist()
            votes = np.zeros(len(texts))
            for f in np.unique(folds).tolist():
                here = np.flatnonzero(folds == f)
                votes[here] = [v for v, _, _ in model.votes([texts[i] for i in here], f)]
            yield pa.RecordBatch.from_arrays([pa.array(votes, pa.float64()), b.column("toxic")], names=["vote", "toxic"])

    votes = rows.select("doc_id", "toxic", "text").mapInArrow(own_votes, "vote double, toxic int").collect()
    model.knots = monotone_fit(np.array([r["vote"] for r in votes]), np.array([r["toxic"] for r in votes]))
    return model


SCORED = "score double, neighbours array<struct<doc_id:long,similarity:double,toxic:int>>, terms array<string>"


def score(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, evidence: int = 3) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, ...) and the toxicity of each whole text.

    Adds ``score`` (0 to 1: probability of the label), ``predicted`` (1 from 0.5
    up), ``held_out`` (the row's label was not learnt from), ``neighbours`` (the
    ``evidence`` nearest examples) and ``terms`` (up to ten of the text's terms that
    lean toxic, in order of weight; those shared with the nearest example if there are
    none); columns of these names are replaced. A text without a term of any example,
    null and empty ones among them, has no evidence. Without any usable label all scores are 0. Repeated
    rows are scored alike; an empty table gives an empty result.
    """
    model = fit(docs, labels, sample_rows)
    keep = [c for c in docs.columns if c not in ("score", "predicted", "held_out", "neighbours", "terms")]
    base = docs.select(*[f"`{c}`" for c in keep])
    schema = T.StructType([*base.schema.fields, *T.StructType.fromDDL(SCORED).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[bytes, tuple] = {}
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                b = whole.slice(lo, 256)
                texts = b.column("text").to_pylist()
                keys = [hashlib.blake2b((x or "").encode("utf-8", "surrogatepass"), digest_size=16).digest() for x in texts]
                if len(memory) > 5_000:
                    memory.clear()
                new = {k: x for k, x in zip(keys, texts, strict=True) if k not in memory}
                memory.update(zip(new, _scored(model, list(new.values()), evidence), strict=True))
                out = [memory[k] for k in keys]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array([x[0] for x in out], pa.float64()),
                     pa.array([x[1] for x in out], pa.list_(pa.struct(
                         [("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))),
                     pa.array([x[2] for x in out], pa.list_(pa.string()))],
                    names=[*keep, "score", "neighbours", "terms"])

    return base.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int")) \
        .withColumn("held_out", held_out(F.col("doc_id")))


def _scored(model: Model | None, texts: list[str | None], evidence: int) -> Iterator[tuple[float, list[dict], list[str]]]:
    if model is None:
        yield from ((0.0, [], []) for _ in texts)
        return
    index = model.examples.value.index()
    for share, near, terms in model.votes(texts):
        yield (float(np.interp(share, *model.knots)),
               [{"doc_id": int(index.ids[e]), "similarity": s, "toxic": int(index.toxic[e])} for s, e in near[:evidence]], terms)


def accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their columns as they are."""
    marked = docs.select(*[F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(docs.columns)], F.col("text"), F.col("doc_id"))
    return score(marked, labels, **options).filter("predicted = 0") \
        .select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(docs.columns)])


def op2_toxicity(spark, sf_dir):
    """Toxicity of every document."""
    return score(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")) \
        .select("doc_id", "held_out", "score", "predicted", "neighbours", "terms")
