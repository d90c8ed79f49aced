"""K4: folds of the dimension store by bucket of row keys."""

import os
import random

from tidepool.operators import dims as D

CELLS = "sink_table string, row_key string, qualifier string, value string, arrival long, seq long"


def _cells(spark, *rows):
    return spark.createDataFrame(list(rows), CELLS)


def _content(store):
    return {(r["sink_table"], r["row_key"], r["qualifier"]): r["value"] for r in store.current().collect()}


def _files(path):
    """Data files by the folder of their dimension, bucket and part."""
    return {os.path.relpath(folder, path) for folder, _, names in os.walk(path) if any(n.endswith(".parquet") for n in names)}


def test_a_fold_touches_only_buckets_with_new_cells(spark, workdir):
    path = os.path.join(workdir, "dims")
    store = D.DimStore(spark, path, database="dims_buckets")
    store.append(_cells(spark, *[(d, f"k{i}", "a", "old", 1, i) for i in range(200) for d in ("d", "e")]))
    store.compact()
    first = _files(path)
    assert len(first) == 32 and all("part=fold-" in f for f in first)
    store.append(_cells(spark, ("d", "k7", "a", "new", 2, 1), ("d", "k7", "b", "x", 2, 2)))
    (new,) = _files(path) - first
    changed = os.path.dirname(new)
    read = store._cells_of({("d", int(changed.rsplit("=", 1)[1]))}, {p for _, p in store.parts()})
    files = {os.path.dirname(os.path.relpath(r["f"].replace("file://", ""), path))
             for r in read.selectExpr("input_file_name() f").distinct().collect()}
    assert {os.path.dirname(f) for f in files} == {changed} and len(files) == 2
    scan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "PartitionFilters: []" not in scan
    store.compact()
    after = _files(path)
    assert {f for f in first if os.path.dirname(f) != changed} == {f for f in after if os.path.dirname(f) != changed}
    assert len(after) == 32 and not {f for f in first if os.path.dirname(f) == changed} & after
    got = _content(store)
    assert len(got) == 401 and got["d", "k7", "a"] == "new" and got["d", "k7", "b"] == "x" and got["e", "k7", "a"] == "old"
    # Nothing new: nothing is written.
    store.compact()
    assert _files(path) == after


def test_folds_at_any_time_equal_a_loop(spark, workdir):
    rng = random.Random(3)
    store = D.DimStore(spark, os.path.join(workdir, "dims"), database="dims_folds", buckets=3)
    want, seq = {}, 0
    for batch in range(5):
        rows = []
        for _ in range(30):
            seq += 1
            row = (rng.choice("de"), rng.choice(["a", "b", "", "c/d", "é"]), rng.choice("xy"), str(seq), batch, seq)
            rows.append(row)
            want[row[:3]] = row[3]
        store.append(_cells(spark, *rows), f"q-{batch}")
        if batch % 2:
            store.compact([["d"], None][batch // 2 % 2])
    assert _content(store) == want
    # Another number of buckets reads and folds the same store.
    again = D.DimStore(spark, store.path, database="dims_folds_again", buckets=5)
    again.append(_cells(spark, ("d", "a", "x", "last", 9, 999)))
    again.compact()
    want["d", "a", "x"] = "last"
    assert _content(again) == want


def test_dimensions_of_any_name_survive_folds(spark, workdir):
    """Rules may name a dimension by any text or none."""
    path = os.path.join(workdir, "dims")
    store = D.DimStore(spark, path, database="dims_names", buckets=2)
    names = ["plain", "a/b=c", "it's", "back\\slash", "sp ace", "50%", "null", "ünï", None]
    for value in ("old", "new"):
        store.append(_cells(spark, *[(n, k, "a", value, 1 if value == "old" else 2, 1) for n in names for k in "kl"]))
        store.compact()
    assert _content(store) == {(n, k, "a"): "new" for n in names for k in "kl"}
    assert spark.table(store.table).count() == 18 and all("part=fold-" in f for f in _files(path))


def test_an_empty_store_folds_to_nothing(spark, workdir):
    store = D.DimStore(spark, os.path.join(workdir, "dims"), database="dims_empty")
    store.append(_cells(spark))
    store.compact()
    assert store.current().count() == 0 and store.parts() == []
