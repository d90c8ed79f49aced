"""Keyed state for the two stateful reference operators, keyed by ``mid``:
W1 as an ``applyInPandasWithState`` function (its one flag travels with the
rows, no state call per key), or as a ``transformWithStateInPandas`` processor where
it starts from history, W2 as such a processor (it needs a value state with a
time-to-live, W3). A processor's initial state is what the batch forms find in the
records before the stream; it is read once, in the first batch of a new checkpoint.

Rows of one key in one micro-batch arrive unordered (H2). W2 takes two stages: the
entries of one mid and chunk of arrivals are sorted and reduced without any state, to
the first one and those that are kept whatever came before; the state then decides the
first ones in order. So a mid with any share of a batch is many small tasks and one
that holds a row a chunk. W1 needs only the earliest claim, so it streams the rows
with one row held back.
Only rows that can touch state are sent to a processor: claims of ``is_new = "1"``
for W1 and session entries for W2; the filters run before the shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

W1_INPUT = ["mid", "arrival", "seq", "value", "is_new"]
W1_OUTPUT = "mid string, arrival long, seq long, value string, is_new string, repaired boolean"

W2_INPUT = ["mid", "arrival", "seq", "value", "day"]
W2_OUTPUT = "mid string, arrival long, seq long, value string, day string"

DAY_MS = 24 * 3600 * 1000


def _sorted(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    pdf = pd.concat(list(rows), ignore_index=True)
    return pdf.sort_values(["arrival", "seq"], kind="stable").reset_index(drop=True)


_W1_COLS = ["mid", "arrival", "seq", "value", "is_new", "repaired"]
W1_STATE = "claimed boolean"


def first_visit_groups(key, rows: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """The first claim of ``is_new = "1"`` per mid keeps it; later claims
    become ``"0"``. State: a flag per mid, no expiry.

    Only claims reach this function, and of a mid's claims only the earliest by
    ``(arrival, seq)`` can keep the flag. So the rows are streamed batch by batch
    (no concatenation, no sort): every row but the earliest seen so far is
    emitted as repaired at once, and one candidate row is held back to the end.
    A mid with a huge share of a micro-batch costs one Arrow batch of memory.
    """
    held = yield from _all_but_earliest(rows)
    if held is not None:
        keep = not state.exists
        if keep:
            state.update((True,))
        yield _decided(held, keep)


def _all_but_earliest(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every claim but the earliest, as repaired; returns the earliest, if there is one."""
    held = None
    for pdf in rows:
        if not len(pdf):
            continue
        if held is not None:
            pdf = pd.concat([held, pdf[held.columns]], ignore_index=True)
        else:
            pdf = pdf.reset_index(drop=True)
        pos = _earliest(pdf)
        held = pdf.iloc[[pos]].reset_index(drop=True)
        rest = pdf.drop(index=pos)
        if len(rest):
            yield _decided(rest, False)
    return held


def _decided(pdf: pd.DataFrame, keep: bool) -> pd.DataFrame:
    return pdf.assign(is_new="1" if keep else "0", repaired=not keep)[_W1_COLS]


def _earliest(pdf: pd.DataFrame) -> int:
    """Position of the row with the smallest ``(arrival, seq)``, without a sort."""
    arrival = pdf["arrival"].to_numpy()
    cand = np.flatnonzero(arrival == arrival.min())
    return int(cand[pdf["seq"].to_numpy()[cand].argmin()])


class FirstVisitProcessor(StatefulProcessor):
    """W1 as ``first_visit_groups``, for mids of which some have claimed before the
    stream: they come as initial state (``logs.first_claims``)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.claimed = handle.getValueState("claimed", W1_STATE)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.claimed.update((True,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = yield from _all_but_earliest(rows)
        if held is not None:
            keep = not self.claimed.exists()
            if keep:
                self.claimed.update((True,))
            yield _decided(held, keep)

    def close(self) -> None:
        pass


_W2_COLS = ["mid", "arrival", "seq", "value", "day"]
W2_CHUNKED = f"{W2_OUTPUT}, tail string, turned boolean"


def reduced_chunk(pdf: pd.DataFrame) -> pd.DataFrame:
    """W2 within the entries of one mid and chunk of arrivals, which need no state.

    The first entry is left to the state: it comes with ``tail``, the day of the chunk's
    last entry, and ``turned``, whether any later one is kept. Of the others those are
    returned, without a ``tail``, whose day differs from the entry's before: they are
    kept whatever the state.
    """
    pdf = pdf.sort_values(["arrival", "seq"], kind="stable").reset_index(drop=True)
    keep = pdf["day"] != pdf["day"].shift(1)
    out = pdf.loc[keep, _W2_COLS].reset_index(drop=True)
    first = out.index == 0
    return out.assign(tail=np.where(first, pdf["day"].iloc[-1], None), turned=first & (len(out) > 1))


class UniqueVisitProcessor(StatefulProcessor):
    """Keep a session entry iff its day differs from the day last kept for
    the mid. With ``ttl_ms`` (W3) the stored day expires that long after it was
    written, so a same-day entry arriving later than that is kept again (Q17)."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last_day = handle.getValueState("last_day", "day string", self.ttl_ms)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """The day last kept before the stream (``logs.last_days``); with a time-to-live it
        expires that long after the stream began."""
        self.last_day.update((str(initialState["day"].iloc[0]),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        """Rows are those of ``reduced_chunk``. What a chunk has decided goes on as it comes;
        only the first entries of the chunks are held, sorted and decided here."""
        heads = []
        for pdf in rows:
            decided = pdf["tail"].isna()
            if decided.any():
                yield pdf.loc[decided, _W2_COLS]
            heads.append(pdf[~decided])
        pdf = _sorted(iter(heads))
        if not len(pdf):
            return
        st = self.last_day.get()
        prev = pdf["tail"].shift(1)
        prev.iloc[0] = st[0] if st is not None else None
        keep = pdf["day"] != prev
        if keep.any() or pdf["turned"].any():
            # Written only on a keep, as the reference does, so the TTL is
            # refreshed by keeps alone. The last kept day equals the last row's day.
            self.last_day.update((str(pdf["tail"].iloc[-1]),))
        yield pdf.loc[keep, _W2_COLS]

    def close(self) -> None:
        pass


def last_change(pdf: pd.DataFrame) -> pd.DataFrame:
    """The last change of one key and chunk of arrivals."""
    order = np.lexsort((pdf["seq"].to_numpy(), pdf["arrival"].to_numpy()))
    return pdf.iloc[[order[-1]]]


class CurrentRowProcessor(StatefulProcessor):
    """S3 as a running table: the current row of a key, and what a change takes back and adds.

    State: the last change's place in the log, kept after a delete too, and the row, if
    there is one. Of a micro-batch only the last change counts; one from before the place
    kept changes nothing, as in the batch view.
    """

    def __init__(self, columns: list[str]):
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.row = handle.getValueState("row", "arrival long, seq long, image string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for pdf in rows:
            if len(pdf):
                last = last_change(pdf).iloc[0]
                if best is None or (last["arrival"], last["seq"]) > (best["arrival"], best["seq"]):
                    best = last
        st = self.row.get()
        if best is None or (st is not None and (st[0], st[1]) >= (best["arrival"], best["seq"])):
            return
        at = int(best["arrival"]), int(best["seq"])
        image = None if best["op"] == "delete" else json.dumps([None if best[c] is None else str(best[c]) for c in self.columns])
        old = st[2] if st is not None else None
        self.row.update((*at, image))
        if old == image:
            return
        out = [("-D" if image is None else "-U", old)] if old is not None else []
        out += [("+I" if old is None else "+U", image)] if image is not None else []
        yield pd.DataFrame([(kind, *at, *json.loads(x)) for kind, x in out], columns=["kind", "arrival", "seq", *self.columns])

    def close(self) -> None:
        pass
