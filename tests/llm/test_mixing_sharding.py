"""Mixing (1) and sharding (6): whole queries against sequential models, odd rows, empty tables."""

import re
import zlib
from collections import Counter, defaultdict

import pytest

from conftest import SF001
from tidepool.llm import mixing, sharding

ODD = [(1, None, None, 10), (2, "", "b", 11), (3, "one", "a", 12), (3, "one", "a", 12), (None, "two words", "a", 13),
       (4, "x " * 3000, "a", 14), (5, " \t\n", None, 15), (6, "one", "é", 16), (7, "a b c d", None, 17)]
SCHEMA = "doc_id long, text string, source string, row long"


def targets(sizes: dict, weights=(5, 2, 1)) -> dict:
    """The targets by the rule as stated: share, stop at twice the size, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    out, free = {s: 0.0 for s in names}, set(names)
    left = 1.5 * sum(sizes.values())
    while left > 1e-9 and free:
        total = sum(w[s] for s in free)
        add = {s: left * w[s] / total for s in free}
        over = {s for s in free if out[s] + add[s] >= 2 * sizes[s]}
        if not over:
            for s in free:
                out[s] += add[s]
            break
        for s in over:
            left -= 2 * sizes[s] - out[s]
            out[s] = 2 * sizes[s]
        free -= over
    return out


def check_mix(rows, docs):
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, (_, t, *_) in enumerate(docs)}
    sizes = defaultdict(int)
    for i, d in enumerate(docs):
        sizes[d[2]] += words[i]
    want = targets(dict(sizes))
    taken = Counter()
    assert len(rows) == len(docs)
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in rows) == \
        Counter((d[0], d[2], words[i]) for i, d in enumerate(docs))
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 1


def mixed_rows(docs_df):
    from pyspark.sql import functions as F

    lines, pieces = mixing.mix(docs_df)
    taken = pieces.groupBy("row").agg(F.sum("words").alias("taken"))
    return lines.join(taken, "row", "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")).collect()


def test_mix_of_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "source", "n_chars")
    check_mix(mixed_rows(docs), [tuple(r) for r in docs.collect()])
    query = lambda: sorted(map(tuple, mixing.op1_mixing(spark, SF001).collect()))
    first = query()
    assert len(first) == docs.count() and first == query()


def test_mix_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    check_mix(mixed_rows(docs), ODD)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    # Every word taken is in the text of its row.
    n = sum(len((r["text"] or "").split()) for r in mixed.collect())
    assert n == sum(r["taken"] for r in mixed_rows(docs))
    assert not mixing.mixed_documents(docs.limit(0)).collect()
    assert not mixed_rows(docs.limit(0))


def test_slots_keep_the_proportions_all_along(spark):
    """Any stretch of the schedule holds each source's share to within a few slots."""
    docs = spark.createDataFrame([(i, "w " * 500, "abc"[i % 3], 0) for i in range(90)], SCHEMA)
    lines, pieces = mixing.mix(docs, weights=(5, 2, 1), epochs=0.5, block_words=50)
    src = {r["row"]: r["source"] for r in lines.collect()}
    slots = defaultdict(set)
    for p in pieces.collect():
        slots[p["slot"]].add(src[p["row"]])
    assert all(len(s) == 1 for s in slots.values())
    order = [next(iter(slots[k])) for k in sorted(slots)]
    for end in range(50, len(order), 50):
        for s, share in zip("abc", (5 / 8, 2 / 8, 1 / 8), strict=True):
            assert abs(order[:end].count(s) - share * end) <= 4


def check_shards(rows, docs, tolerance):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == \
        Counter((d[0], len((d[1] or "").encode()) + 1, zlib.crc32((d[1] or "").encode())) for d in docs)
    slots, load = defaultdict(list), Counter()
    for r in rows:
        assert r["law"] == "bytes" and 0 <= r["shard"] < 16 and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    share = sum(load.values()) / 16
    assert all(abs(load[s] - share) <= tolerance for s in range(16))


def test_shards_of_the_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    group = Counter()
    for _, t in docs:
        group[t] += len((t or "").encode()) + 1
    rows = sharding.op6_sharding(spark, SF001).collect()
    # A boundary lies between two groups of equal texts, so it is off by half a group at most.
    check_shards(rows, docs, max(group.values()))
    of = defaultdict(set)
    text = dict(docs)
    for r in rows:
        of[text[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in of.values())


def test_a_group_beyond_its_share_leaves_the_others_even(spark):
    """Half of all rows are one text and a tenth another: each has a shard, the rest fill the others evenly."""
    rows = [(i, "the same text again" if i % 2 else "the second text" if i % 10 == 0 else f"text number {i}") for i in range(4000)]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check_shards(out, rows, 1 << 30)
    load, of = Counter(), defaultdict(set)
    for r in out:
        load[r["shard"]] += r["size"]
        of[dict(rows)[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in of.values()) and len(load) == 16
    others = sorted(load.values())[:14]
    assert max(others) - min(others) < 0.1 * max(others)
    one = sharding.shard(spark.createDataFrame([(i, "x") for i in range(20)], "doc_id long, text string")).collect()
    assert len({r["shard"] for r in one}) == 1 and sorted(r["slot"] for r in one) == list(range(20))


def test_shards_of_odd_rows(spark, workdir):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, slot string, _key long")
    out = sharding.shard(docs)
    assert set(out.columns) == {"doc_id", "text", "_key", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}
    check_shards(out.collect(), ODD, 1 << 20)
    assert not sharding.shard(docs.limit(0)).collect()
    sharding.write_shards(out, f"{workdir}/shards")
    assert spark.read.parquet(f"{workdir}/shards").count() == len(ODD)
