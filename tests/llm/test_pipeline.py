"""The corpus pipeline: each stage on its predecessor's rows, the packed result, odd rows."""

import os
import subprocess
import sys
import tempfile

import corpus_pipeline as P
from conftest import ROOT, SF01, SF001
from test_packing_warc import check_pieces
from test_texts import base_spans, brute_groups
from tidepool.llm import toxicity


def run_stages(spark, sf_dir, docs):
    steps = [docs]
    for name, stage in P.STAGES:
        out = stage(spark, docs, sf_dir)
        path = f"{tempfile.mkdtemp(prefix='tidepool-run-')}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        steps.append(docs)
    return steps


def test_stages_of_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    raw, clean, single, masked, mixed, packed = run_stages(spark, SF01, docs)
    assert all(x.columns == raw.columns for x in (clean, single, masked, mixed))
    rows = lambda df: sorted(map(tuple, df.select("doc_id", "text").collect()))
    said = toxicity.score(raw, spark.read.parquet(f"{SF01}/labels.parquet")).filter("predicted = 0")
    assert rows(clean) == rows(said) and len(rows(clean)) < len(rows(raw))
    keep = {d for d, _, _, kept in brute_groups(rows(clean)) if kept}
    assert rows(single) == [r for r in rows(clean) if r[0] in keep]
    before = dict(rows(single))
    found = 0
    for r in masked.collect():
        spans = base_spans(before[r["doc_id"]])
        found += bool(spans)
        assert not base_spans(r["text"]) and (spans or r["text"] == before[r["doc_id"]])
        assert r["n_chars"] == len(r["text"])
    assert found and masked.count() == single.count()
    text = dict(rows(masked))
    parts = [r for r in rows(mixed) if r[1] != text[r[0]]]
    assert len(parts) <= 20 and all(set(t.split()) <= set(text[d].split()) for d, t in parts)
    check_pieces([r for r in packed.collect()], rows(mixed))
    out = P.run(spark, SF001)
    assert out.schema == packed.schema and out.count() > 0


def test_odd_rows(spark):
    rows = [(1, None, "en", "a", None), (2, "", None, "a", 0), (3, "a b c d e f", "en", None, 11), (3, "a b c d e f", "en", None, 11),
            (None, "token=abcdefghijklmnop x", "en", "b", 24), (4, "word " * 9000, "en", "b", 45000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    _, clean, single, masked, mixed, packed = run_stages(spark, SF001, docs)
    assert clean.count() == 6 and single.count() == 4
    assert masked.filter("doc_id is null").first()["text"] == "[assign] x"
    assert masked.filter("doc_id is null").first()["n_chars"] == 10
    assert packed.count() > 0
    assert [s.count() for s in run_stages(spark, SF001, docs.limit(0))] == [0] * 6


def test_extra_columns_are_carried_whatever_their_names(spark):
    """Columns that stages use themselves come through with their values."""
    names = ["_m", "mark", "score", "predicted", "secrets", "slot", "size", "terms", "queue", "in_text", "kept", "a.b", "part"]
    rows = [(i, f"word{i} " * (3 + i) + ("secret=abcdefghijklmnop" if i % 3 == 0 else ""), "en", f"s{i % 2}", None,
             *[1000 * i + j for j in range(len(names))]) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"`{n}` long" for n in names))
    raw, clean, single, masked, mixed, packed = run_stages(spark, SF001, docs)
    assert all(x.columns == raw.columns for x in (clean, single, masked, mixed))
    want = {r[0]: r[5:] for r in rows}
    for step in (clean, single, masked, mixed):
        got = step.collect()
        assert got and all(tuple(r)[5:] == want[r["doc_id"]] for r in got)
    assert masked.count() == 12 and packed.count() > 0


def test_the_rest_works_without_the_subpackage(workdir):
    """A copy without llm/ and corpus_pipeline.py still registers the other queries."""
    for folder in ("tidepool/functions", "tidepool/operators", "tidepool/plans", "tidepool/sources", "tidepool/streaming"):
        os.makedirs(os.path.join(workdir, folder))
    for base, _, names in os.walk(os.path.join(ROOT, "tidepool")):
        if "llm" not in base.split(os.sep):
            for n in names:
                if n.endswith(".py"):
                    at = os.path.relpath(os.path.join(base, n), ROOT)
                    os.symlink(os.path.join(ROOT, at), os.path.join(workdir, at))
    os.symlink(os.path.join(ROOT, "__spark_entry__.py"), os.path.join(workdir, "__spark_entry__.py"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'db_route' in q and not any(x.startswith('op') for x in q), q; " \
           "assert 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=workdir, check=True, env=os.environ | {"PYTHONPATH": workdir})
