"""W2 in a stream with a device that holds half of a batch: two stages, small memory, the sequential answer."""

import os
import random

import pandas as pd
import pytest

from tidepool.streaming import jobs as SJ
from tidepool.streaming import processors as PR

SCHEMA = "arrival long, seq long, value string"
DAY = 24 * 3600 * 1000


def record(n, mid, day, entry=True):
    last = "" if entry else ',"last_page_id":"p"'
    return f'{{"common":{{"mid":"{mid}"}},"page":{{"page_id":"p{n}"{last}}},"ts":{day * DAY + n}}}'


def sequential(rows):
    kept, last = [], {}
    for arrival, seq, mid, day in sorted(rows):
        if last.get(mid) != day:
            kept.append(seq)
            last[mid] = day
    return sorted(kept)


@pytest.mark.parametrize("chunk", [16, 1024])
def test_half_of_every_batch_on_one_device(spark, workdir, chunk):
    rnd, rows = random.Random(chunk), []
    for seq in range(3000):
        mid = "hot" if rnd.random() < 0.5 else f"m{rnd.randrange(200)}"
        rows.append((seq // 2, seq, mid, seq // 900 + (rnd.random() < 0.02)))
    for i in range(3):
        some = rows[i * 1000:(i + 1) * 1000]
        rnd.shuffle(some)
        spark.createDataFrame([(a, s, record(s, m, d)) for a, s, m, d in some], SCHEMA).repartition(3) \
            .write.parquet(f"{workdir}/in/part_{i}")
    # Batches of Arrow rows far smaller than the device's share.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        src = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 3).option("recursiveFileLookup", "true")
               .parquet(f"{workdir}/in"))
        SJ.start_uv_job(spark, f"{workdir}/topics", checkpoint=f"{workdir}/ck", source=src, chunk_width=chunk).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    from tidepool.sources import topics as T
    got = sorted(r["seq"] for r in T.read_topic(spark, f"{workdir}/topics", SJ.DWM_UV).collect())
    assert got == sequential(rows)


def test_a_chunk_is_reduced_to_what_the_state_must_see():
    pdf = pd.DataFrame({"mid": "a", "arrival": [5, 1, 3, 2, 4, 4], "seq": [9, 1, 3, 2, 5, 4], "value": list("fabcde"),
                        "day": ["d2", "d1", "d2", "d1", "d2", "d2"]})
    out = PR.reduced_chunk(pdf)
    assert out[["seq", "day", "tail", "turned"]].values.tolist() == [[1, "d1", "d2", True], [3, "d2", None, False]]
    same = PR.reduced_chunk(pdf.assign(day="d1"))
    assert same[["seq", "tail", "turned"]].values.tolist() == [[1, "d1", False]]
    # However many entries, the state sees one row of a chunk without a change of day.
    many = pd.DataFrame({"mid": "a", "arrival": range(100_000), "seq": range(100_000), "value": "x", "day": "d1"})
    assert len(PR.reduced_chunk(many)) == 1


class Kept:
    def __init__(self, day=None):
        self.day, self.writes = day, 0

    def get(self):
        return None if self.day is None else (self.day,)

    def update(self, row):
        self.day, self.writes = row[0], self.writes + 1


def test_the_processor_holds_a_row_a_chunk():
    """Decided rows leave batch by batch; the state is written on a keep alone."""
    chunks = [PR.reduced_chunk(pd.DataFrame({"mid": "a", "arrival": range(b, b + 10), "seq": range(b, b + 10), "value": "x",
                                             "day": ["d1"] * 5 + ["d2"] * 5})) for b in (30, 0, 20, 10)]
    p = PR.UniqueVisitProcessor()
    p.last_day = Kept("d1")
    out = list(p.handleInputRows(("a",), iter(chunks), None))
    assert sorted(s for o in out for s in o["seq"]) == [5, 10, 15, 20, 25, 30, 35]
    assert (p.last_day.day, p.last_day.writes) == ("d2", 1)
    p.last_day = Kept("d1")
    none = PR.reduced_chunk(pd.DataFrame({"mid": "a", "arrival": [1, 2], "seq": [1, 2], "value": "x", "day": "d1"}))
    assert sum(len(o) for o in p.handleInputRows(("a",), iter([none]), None)) == 0 and p.last_day.writes == 0
