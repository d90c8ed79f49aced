"""Language identification (13): held-out accuracy, what may be learnt, odd rows, brute force."""

import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from conftest import SF001, SF01
from tidepool.llm import langid


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = langid.op13_langid(spark, SF01).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    tested = [(r["lang_pred"], truth[r["doc_id"]], r["rejected"]) for r in rows if r["held_out"]]
    assert sum(p == y for p, y, _ in tested) >= 0.97 * len(tested)
    sure = [(p, y) for p, y, rejected in tested if not rejected]
    assert sum(p == y for p, y in sure) >= 0.98 * len(sure) and len(sure) >= 0.9 * len(tested)


def test_held_out_rows_and_other_columns_are_never_used(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "lang")
    turned = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    pred = lambda d: sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify(d).collect())
    assert pred(docs) == pred(turned) and pred(docs) == pred(docs.repartition(7))


def test_sizes_equal_brute_force(spark):
    """Sample, extracts, dictionaries and sizes followed by hand."""
    words = {"aa": ["lorem", "ipsum", "dolor"], "bb": ["wiski", "mutka", "pelko"]}
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, " ".join(words[lang][(i + j * j) % 3] for j in range(1 + i % 40)), lang)
            for i, lang in ((i, "aa" if i % 3 else "bb") for i in ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = {r["text"]: r["m"] for r in docs.select("text", F.xxhash64(F.lit("langid"), "text").alias("m")).collect()}
    dictionaries, n = {}, {}
    for lang in words:
        texts = sorted({t for _, t, y in rows if y == lang}, key=marks.get)
        n[lang] = len(texts)
        cut = [t[(s := marks[t] % max(1, len(t) - langid.EXTRACT_CHARS + 1)):s + langid.EXTRACT_CHARS] for t in texts[:20]]
        dictionaries[lang] = "\n".join(cut).encode()
    how = zstandard.ZstdCompressionParameters.from_level(6, min_match=3, write_content_size=0, write_checksum=0, write_dict_id=0)
    size = {}
    for lang, raw in dictionaries.items():
        known = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(compression_params=how)
        size[lang] = zstandard.ZstdCompressor(dict_data=known, compression_params=how)
    for r in langid.identify(docs, sample_texts=20).collect():
        want = {lang: sum(len(c.compress(r["text"].encode()[k:k + 2048])) for k in range(0, len(r["text"]), 2048))
                for lang, c in size.items()}
        assert r["sizes"] == want
        assert r["lang_pred"] == min(want, key=lambda x: (want[x], -n[x], x))


def test_odd_rows(spark):
    ids = [i for i in range(1, 300) if zlib.crc32(str(i).encode()) % 5][:60]
    rows = [(i, f"der hund und die katze laufen {i}" if i % 2 else f"the dog and the cat are running {i}", "de" if i % 2 else "en", 1.5)
            for i in ids]
    odd = [(9001, None, "en", 1.0), (9002, "", "en", 1.0), (9003, "123 -- !? ½ ²", "de", 1.0), (9004, "the dog " * 50_000, None, 1.0),
           (9004, "the dog " * 50_000, None, 1.0), (None, "die katze und der hund laufen", "zz", 1.0), (9005, "日本語", None, 1.0)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score double")
    got = {}
    for r in langid.identify(docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert all((got[i][0]["lang_pred"], got[i][0]["score"], got[i][0]["rejected"]) == ("und", 0.0, True) for i in (9001, 9002, 9003))
    assert [r["lang_pred"] for r in got[9004]] == ["en", "en"] and got[None][0]["lang_pred"] == "de"
    assert got[9005][0]["lang_pred"] in ("de", "en") and got[9005][0]["rejected"] and got[9005][0]["score"] == pytest.approx(0.5)
    assert not any(r["lang_pred"] == "zz" for rs in got.values() for r in rs)      # a null id is held out
    assert langid.identify(docs.limit(0)).collect() == []
    none = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in none} == {"und"}
    one = langid.identify(docs.filter("lang = 'en'")).filter("text like '%dog%'").collect()
    assert {(r["lang_pred"], r["score"]) for r in one} == {("en", 1.0)}


def test_the_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, f"text number {i} " * 100, "en") for i in range(500)], "doc_id long, text string, lang string")
    e = langid.learn(docs, sample_texts=10)
    assert len(e.dictionaries["en"].split(b"\n")) == 10 and e.rows["en"] > 300
    assert len(langid.learn(docs).dictionaries["en"]) <= langid.DICTIONARY_BYTES
