"""J1 (log to detail layer) and J2 (unique visits) in batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.operators import logs as L
from tidepool.operators.ordering import DEFAULT_CHUNK


def detail_layer(raw: DataFrame) -> DataFrame:
    """S1 -> P1 -> W1 -> P5 -> P6 as one DataFrame with a ``route`` column
    (dirty, start, page, display) and the JSON ``value`` to publish per route."""
    return L.split_all(L.first_visit_fix(L.parse_app_log(raw)))


def uv_from_pages(page_log: DataFrame, chunk_width: int = DEFAULT_CHUNK) -> DataFrame:
    """The page dataset ``(arrival, seq, value)`` -> P2 -> P7 -> W2.

    Returns kept entries with their fields and ``value``, the record text as read
    from the page topic (P4: all fields pass through).
    """
    parsed = L.parse_page_log(page_log)
    return L.unique_visit(parsed, chunk_width)


def page_route(j1: DataFrame) -> DataFrame:
    """The dwd_page_log topic of J1's output."""
    return j1.where(F.col("route") == L.ROUTE_PAGE).select("arrival", "seq", "value")


def page_topic(raw: DataFrame) -> DataFrame:
    """J1's dwd_page_log topic alone: the same records as ``page_route`` of
    ``detail_layer``, without building the start, dirty and display rows."""
    fixed = L.first_visit_fix(L.parse_app_log(raw))
    return L.split_page(fixed).select("arrival", "seq", L.record_json(fixed).alias("value"))
