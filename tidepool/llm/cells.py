"""Helpers for tasks that compare the members of small cells of sorted rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[pd.DataFrame, list[tuple[int, int]]]]:
    """Rows sorted by ``keys`` with the bounds of each group; no group is cut by a batch."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        k = [b[c].to_numpy() for c in keys]
        cut = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in k])) + 1
        if held and any(held[-1][c].iat[-1] != x[0] for c, x in zip(keys, k, strict=True)):
            h = pd.concat(held, ignore_index=True)
            yield h, [(0, len(h))]
            held = []
        if not len(cut):
            held.append(b)
            continue
        edges = [0, *cut.tolist()]
        if held:
            h = pd.concat([*held, b.iloc[:cut[0]]], ignore_index=True)
            yield h, [(0, len(h))]
            edges = edges[1:]
        yield b, list(zip(edges[:-1], edges[1:], strict=True))
        held = [b.iloc[cut[-1]:]]
    if held:
        h = pd.concat(held, ignore_index=True)
        yield h, [(0, len(h))]


def keep_first_meeting(close: np.ndarray, some: np.ndarray, places: list[np.ndarray], here: int) -> None:
    """Clear pairs of ``close`` that also meet in a place before ``here``.

    ``places`` has the sorted places of each member; ``some`` are the members with
    a pair. So a pair counts once, in the first place that both have.
    """
    earlier: dict[int, list[int]] = {}
    for c, m in enumerate(some):
        p = places[m]
        for x in p[:np.searchsorted(p, here)]:
            earlier.setdefault(x, []).append(c)
    if shared := [x for x in earlier.values() if len(x) > 1]:
        mark = np.zeros((len(some), len(shared)), dtype=np.float32)
        for c, members in enumerate(shared):
            mark[members, c] = 1
        close[np.ix_(some, some)] &= (mark @ mark.T) == 0


def local_labels(ids: np.ndarray, close: np.ndarray) -> np.ndarray:
    """Smallest id that each member reaches over the pairs of ``close``."""
    label = ids.copy()
    while True:
        best = np.minimum(label, np.where(close, label[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (best == label).all():
            return label
        label = best
