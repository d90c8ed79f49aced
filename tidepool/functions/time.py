"""Day bucket of epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of(ts_ms: Column) -> Column:
    """DATE of an epoch-ms instant in the session time zone."""
    return F.to_date(F.timestamp_millis(ts_ms))


def day_text(ts_ms: Column) -> Column:
    """``yyyy-MM-dd`` text of an epoch-ms instant, as the reference formats it."""
    return F.date_format(F.timestamp_millis(ts_ms), "yyyy-MM-dd")
