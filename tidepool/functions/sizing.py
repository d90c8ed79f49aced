"""Broadcast only behind a checked size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side beyond either bound is not broadcast. Text columns have no bound of their
# own, so bytes are measured, not assumed from rows.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20
# Bytes of a row besides the text in its columns.
ROW_BYTES = 64


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes of ``df``: one pass, summed per partition first."""
    text = [F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0)) for f in df.schema.fields]
    size = sum(text, F.lit(ROW_BYTES)).cast("long")
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return n, size


def fits(df: DataFrame, rows: int = MAX_BROADCAST_ROWS, size: int = MAX_BROADCAST_BYTES) -> bool:
    """True iff ``df`` is within both bounds."""
    n, b = measure(df)
    return n <= rows and b <= size


def checked_broadcast(df: DataFrame, bound: int = MAX_BROADCAST_ROWS,
                      max_bytes: int = MAX_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``(broadcast(df), True)`` when ``df`` is proven small, else ``(df, False)``.

    ``df`` is read for the check and again for the join, so pass a checkpointed or
    otherwise cheap DataFrame. The caller chooses a shuffle-based plan when the flag
    is False.
    """
    if fits(df, bound, max_bytes):
        return F.broadcast(df), True
    return df, False
