"""Toxicity (2): exact neighbours, held-out accuracy, odd rows, empty tables."""

import math
import random
import zlib

import numpy as np
import pytest

from conftest import SF01, SF001
from tidepool.llm import toxicity


def brute_model(rows):
    """idf of every term of the examples (doc_id, label, term counts), and the weighted unit vectors."""
    n, toxic = len(rows), sum(y for _, y, _ in rows)
    rate, df, bad = toxic / n, {}, {}
    for _, y, c in rows:
        for t in c:
            df[t] = df.get(t, 0) + 1
            bad[t] = bad.get(t, 0) + y
    idf = {}
    for t, m in df.items():
        z = max(0.0, (bad[t] - m * rate) / math.sqrt(m * rate * (1 - rate))) if 0 < rate < 1 else 0.0
        idf[t] = (math.log((1 + n) / (1 + m)) + 1) * (1 + z * z)
    return idf, [(i, y, unit(c, idf)) for i, y, c in rows]


def unit(counts, idf):
    w = {t: (1 + math.log(n)) * idf[t] for t, n in counts.items() if t in idf}
    norm = math.sqrt(sum(x * x for x in w.values()))
    return {t: x / norm for t, x in w.items()}


def brute_nearest(model, counts, k):
    """(similarity, doc_id, label) of the k nearest examples."""
    idf, vectors = model
    q = unit(counts, idf)
    scored = [(-sum(x * v.get(t, 0.0) for t, x in q.items()), i, y) for i, y, v in vectors]
    return [(-s, i, y) for s, i, y in sorted(scored)[:k] if s < 0]


def counted(text):
    out = {}
    for w in (text or "").lower().split():
        out[w] = out.get(w, 0) + 1
    return out


def index_of(rows):
    words = sorted({t for _, _, c in rows for t in c})
    marks = toxicity._marks(words)
    order = np.argsort(marks)
    number = {words[j]: i for i, j in enumerate(order)}
    term = np.array([number[t] for _, _, c in rows for t in c])
    return toxicity.Index(np.array([i for i, _, _ in rows]), np.array([y for _, y, _ in rows]),
                          np.concatenate([[0], np.cumsum([len(c) for _, _, c in rows])]), marks[order], term,
                          np.array([n for _, _, c in rows for n in c.values()]))


def test_nearest_examples_are_exact():
    rnd = random.Random(4)
    pick = lambda n: {f"t{t}": rnd.choice([1, 1, 2, 5]) for t in rnd.sample(range(40), rnd.randint(1, n))}
    rows = [(i, rnd.randint(0, 1), pick(6)) for i in range(1500)]
    index, model = index_of(rows), brute_model(rows)
    for _ in range(60):
        counts = pick(8)
        terms, often, words = index.counts([t for t, n in counts.items() for _ in range(n)] + ["unknown"])
        assert dict(zip(words, often.tolist(), strict=True)) == counts
        near = index.nearest(terms, often)
        assert [s for s, _ in near] == pytest.approx([s for s, _, _ in brute_nearest(model, counts, toxicity.NEIGHBOURS)])
        assert [e for _, e in near] == sorted((e for _, e in near), key=lambda e: (-round(dict((b, a) for a, b in near)[e], 9), e))
        held = index.shared(near[0][1], terms)
        example = next(c for i, _, c in rows if i == index.ids[near[0][1]])
        assert {words[i] for i in held} == set(counts) & set(example)


def test_empty_and_one_sided_indexes():
    one = index_of([(7, 1, {"a": 2, "b": 1})])
    assert one.nearest(*one.counts(["a", "zzz"])[:2])[0][1] == 0 and one.nearest(*one.counts(["zzz"])[:2]) == []
    bare = toxicity.Index(np.array([1, 2]), np.array([0, 1]), np.array([0, 0, 0]), np.zeros(0, dtype=np.uint64),
                          np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32))
    assert bare.nearest(*bare.counts(["a"])[:2]) == []


def test_monotone_fit_never_falls():
    rng = np.random.default_rng(3)
    x, y = toxicity.monotone_fit(rng.random(500), (rng.random(500) < 0.4).astype(int))
    assert (np.diff(x) >= 0).all() and (y >= 0).all() and (y <= 1).all()
    x, y = toxicity.monotone_fit(np.array([0.1, 0.2, 0.9, 0.95]), np.array([0, 0, 1, 1]))
    assert np.interp(0.1, x, y) < 0.5 < np.interp(0.95, x, y)


def test_held_out_accuracy(spark):
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", "toxic").collect()}
    rows = toxicity.op2_toxicity(spark, SF01).collect()
    assert len(rows) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    tested = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == y for p, y in tested) >= 0.93 * len(tested)
    learnt = {e["doc_id"] for r in rows for e in r["neighbours"]}
    assert learnt and all(zlib.crc32(str(d).encode()) % 5 for d in learnt)
    assert all(r["terms"] for r in rows if r["predicted"])


def test_labels_of_held_out_rows_are_never_learnt(spark):
    """Turning the labels of held-out rows leaves every score as it is."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    turned = labels.withColumn("toxic", toxicity.F.when(
        toxicity.held_out(toxicity.F.col("doc_id")), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    score = lambda y: sorted((r["doc_id"], r["score"]) for r in toxicity.score(docs, y).collect())
    assert score(labels) == score(turned)


def test_odd_rows(spark):
    learnt = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 5][:300]
    rnd = random.Random(9)
    bad = ["vile", "nasty", "wretch"]
    rows, labels = [], []
    for n, i in enumerate(learnt):
        words = ["".join(rnd.choices("abcdefgh", k=7)) for _ in range(30)]
        if n % 3 == 0:
            words[5:8] = rnd.sample(bad, 3)
        rows.append((i, " ".join(words), 1.5))
        labels += [(i, int(n % 3 == 0), 0)] * (1 + n % 2)
    odd = [(9001, None, 1.5), (9002, "", 1.5), (9003, "ok " * 20000 + "vile nasty", 1.5), (9004, "VILE, nasty! wretch?", 1.5),
           (9004, "VILE, nasty! wretch?", 1.5), (None, "such a nasty vile wretch", 1.5), (9005, "nothing", 1.5)]
    labels += [(None, 1, 0), (9005, None, 0), (70_000, 1, 0)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, score double")
    truth = spark.createDataFrame(labels, "doc_id long, toxic int, text int")
    out = toxicity.score(docs, truth)
    assert set(out.columns) == {"doc_id", "text", "score", "predicted", "held_out", "neighbours", "terms"}
    got = {}
    for r in out.collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert [r["predicted"] for r in got[9004]] == [1, 1] and got[None][0]["predicted"] == 1
    assert all(got[i][0]["predicted"] == 0 and not got[i][0]["neighbours"] for i in (9001, 9002, 9005))
    assert got[9004][0]["terms"] and set(got[9004][0]["terms"]) & set(bad)
    assert {"vile", "nasty"} <= set(got[9003][0]["terms"])       # the whole text counts
    kept = toxicity.accepted(docs, truth)
    assert kept.columns == docs.columns and kept.filter("doc_id = 9004").count() == 0
    assert kept.filter("doc_id in (9001, 9002, 9005) and score = 1.5").count() == 3
    assert not toxicity.score(docs.limit(0), truth).collect()
    assert {r["score"] for r in toxicity.score(docs, truth.limit(0)).collect()} == {0.0}


def test_scores_equal_brute_force(spark):
    """Texts without a leaning term have their exact neighbours too; vote, folds and fit are followed to the score."""
    rnd = random.Random(5)
    words = ["".join(rnd.choices("klmnopqr", k=rnd.randint(2, 9))) for _ in range(400)]
    texts = {i: " ".join(rnd.choices(words, k=rnd.randint(3, 60)) + (["vile"] if i % 9 == 0 else [])) for i in range(500)}
    learnt = {i: int(i % 9 == 0) for i in texts if zlib.crc32(str(i).encode()) % 5}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.score(
        docs, spark.createDataFrame(list(learnt.items()), "doc_id long, toxic int")).collect()}

    def vote(model, counts, rate):
        near = brute_nearest(model, counts, toxicity.NEIGHBOURS)
        w = [1 / (0.02 + max(0.0, 1 - s)) for s, _, _ in near]
        return sum(x * y for x, (_, _, y) in zip(w, near, strict=True)) / sum(w) if near else rate

    counts = {i: counted(t) for i, t in texts.items()}
    rows = [(i, y, counts[i]) for i, y in learnt.items()]
    folds = dict(zip(learnt, toxicity.fold_of(np.array(list(learnt))).tolist(), strict=True))
    assert len(set(folds.values())) == toxicity.FOLDS
    votes = {}
    for f in range(toxicity.FOLDS):
        others = [r for r in rows if folds[r[0]] != f]
        model, rate = brute_model(others), sum(y for _, y, _ in others) / len(others)
        votes |= {i: vote(model, counts[i], rate) for i in learnt if folds[i] == f}
    knots = toxicity.monotone_fit(np.array([votes[i] for i in sorted(learnt)]), np.array([learnt[i] for i in sorted(learnt)]))
    model, rate = brute_model(rows), sum(learnt.values()) / len(learnt)
    for i in range(0, 500, 7):
        near = brute_nearest(model, counts[i], 3)
        assert [e["similarity"] for e in got[i]["neighbours"]] == pytest.approx([s for s, _, _ in near]), i
        assert got[i]["score"] == pytest.approx(float(np.interp(vote(model, counts[i], rate), *knots))), i
    assert all(got[i]["neighbours"][0]["doc_id"] == i for i in learnt)


def test_the_sample_is_bounded(spark, monkeypatch):
    """No more examples than rows and characters allow, and none from a text beyond the longest."""
    ids = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 5][:200]
    rows = [(i, f"w{i} " * (5 if n else 400)) for n, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id long, toxic int")
    size = lambda **o: len(toxicity.fit(docs, labels, **o).examples.value.index().ids)
    assert size(sample_rows=50) == 50
    monkeypatch.setattr(toxicity, "LONGEST_EXAMPLE", 1000)
    assert size() == 199
    monkeypatch.setattr(toxicity, "SAMPLE_CHARS", 1000)
    assert 0 < size() < 60


def test_queries_together_are_exact():
    """Terms kept as rows and as lists, queries without terms among others: each as if alone, and as brute force."""
    rnd = random.Random(9)
    pick = lambda n: {f"t{int(400 * rnd.random() ** 3)}": rnd.choice([1, 1, 2, 5]) for _ in range(rnd.randint(1, n))}
    rows = [(i, rnd.randint(0, 1), pick(9)) for i in range(1000)]
    index, model = index_of(rows), brute_model(rows)
    assert 0 < index.rows.shape[1] < len(index.marks)
    texts = [pick(12) if i % 7 else {} for i in range(80)]
    queries = [index.counts([t for t, n in c.items() for _ in range(n)])[:2] for c in texts]
    together = index.nearest_of(queries)
    for counts, query, near in zip(texts, queries, together, strict=True):
        alone = index.nearest(*query)
        assert [e for _, e in near] == [e for _, e in alone]
        known = {t: n for t, n in counts.items() if any(t in c for _, _, c in rows)}
        if not known:
            assert near == []
        else:
            assert [s for s, _ in near] == pytest.approx([s for s, _, _ in brute_nearest(model, known, toxicity.NEIGHBOURS)])
