"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each reads whole provided tables through the adapters and returns typed columns
(no JSON text where engines format differently), named exactly as in the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators import logs as L
from tidepool.operators.expiry import unique_visit_expiring
from tidepool.plans import log_jobs
from tidepool.session import checkpoint_root
from tidepool.sources import fixtures as FX

Query = Callable[[SparkSession, str], DataFrame]


def _parsed(spark, sf_dir):
    return L.parse_app_log(FX.app_log(spark, sf_dir))


def _fixed(spark, sf_dir):
    return L.first_visit_fix(_parsed(spark, sf_dir))


def q_dirty_split(spark, sf_dir):
    return L.dirty(_parsed(spark, sf_dir))


def q_json_fields(spark, sf_dir):
    return L.clean(_parsed(spark, sf_dir)).select(
        "seq", "arrival", "mid", "is_new", "start", "page_id", "last_page_id", "ts")


def q_first_visit_fix(spark, sf_dir):
    return L.clean(_fixed(spark, sf_dir)).select(
        "seq", "mid", "is_new_in", "is_new", F.col("repaired").cast("int").alias("repaired"))


def q_log_split_start(spark, sf_dir):
    return L.split_start(_fixed(spark, sf_dir)).select("seq", "arrival", "mid", "is_new", "ts")


def q_log_split_page(spark, sf_dir):
    return L.split_page(_fixed(spark, sf_dir)).select(
        "seq", "arrival", "mid", "is_new", "page_id", "last_page_id", "ts")


def q_log_split_display(spark, sf_dir):
    pages = L.split_page(L.clean(_parsed(spark, sf_dir)))
    return L.explode_displays(pages).select("seq", "pos", "page_id", "item")


def q_session_entries(spark, sf_dir):
    pages = L.split_page(L.clean(_parsed(spark, sf_dir)))
    return pages.where(L.session_entry(F.col("last_page_id"))).select(
        "seq", "arrival", "mid", "page_id", "ts")


def q_day_bucket(spark, sf_dir):
    return L.day_bucket(_parsed(spark, sf_dir))


def q_unique_visit(spark, sf_dir):
    pages = L.split_page(L.clean(_parsed(spark, sf_dir)))
    return L.unique_visit(pages).select("seq", "arrival", "mid", "page_id", "ts", "day")


def q_unique_visit_expiring(spark, sf_dir):
    """W2 + W3 in batch: the state of a mid expires ``EXPIRY`` arrival units after it was written."""
    pages = L.split_page(L.clean(_parsed(spark, sf_dir)))
    return unique_visit_expiring(pages, FX.EXPIRY).select("seq", "arrival", "mid", "page_id", "ts", "day")


def q_log_detail(spark, sf_dir):
    return log_jobs.detail_layer(FX.app_log(spark, sf_dir)).select(
        "route", "seq", "pos", "mid", "is_new", "page_id", "last_page_id", "ts", "item")


def q_uv_daily(spark, sf_dir):
    # J2 reads the durable page dataset J1 publishes; a reliable checkpoint in the
    # shared checkpoint folder stands in for that topic and cuts the lineage.
    checkpoint_root(spark)
    pages = log_jobs.page_topic(FX.app_log(spark, sf_dir)).checkpoint(eager=True)
    return log_jobs.uv_from_pages(pages).select(
        "seq", "arrival", "mid", "is_new", "page_id", "ts", "day")


def q_dirty_kinds(spark, sf_dir):
    return L.dirty(L.parse_app_log(FX.app_log_kinds(spark, sf_dir)))


def q_published_json(spark, sf_dir):
    """Keys of the published text of start and page records: null fields are gone."""
    out = log_jobs.detail_layer(FX.app_log_kinds(spark, sf_dir)).where(F.col("route").isin("start", "page"))

    def keys(text):
        return F.array_join(F.array_sort(F.json_object_keys(text)), ",")

    return out.select("route", "seq", keys(F.col("value")).alias("fields"),
                      keys(F.get_json_object("value", "$.page")).alias("page_fields"),
                      F.get_json_object("value", "$.common.is_new").alias("is_new"))


def q_published_texts(spark, sf_dir):
    """Whole published texts of start and page records, nested nulls among them."""
    out = log_jobs.detail_layer(FX.app_log_nested(spark, sf_dir)).where(F.col("route").isin("start", "page"))
    return out.select("route", "seq", "value")


def q_uv_rejects(spark, sf_dir):
    return L.page_rejects(L.parse_page_log(FX.app_log(spark, sf_dir)))


def q_first_visit_fix_large(spark, sf_dir):
    """W1's plan beyond the broadcast bound."""
    return L.clean(L.first_visit_fix(_parsed(spark, sf_dir), bound=0)).select(
        "seq", "mid", "is_new_in", "is_new", F.col("repaired").cast("int").alias("repaired"))


QUERIES: dict[str, Query] = {
    "dirty_split": q_dirty_split,
    "json_fields": q_json_fields,
    "first_visit_fix": q_first_visit_fix,
    "log_split_start": q_log_split_start,
    "log_split_page": q_log_split_page,
    "log_split_display": q_log_split_display,
    "session_entries": q_session_entries,
    "day_bucket": q_day_bucket,
    "unique_visit": q_unique_visit,
    "unique_visit_expiring": q_unique_visit_expiring,
    "log_detail": q_log_detail,
    "uv_daily": q_uv_daily,
    "dirty_kinds": q_dirty_kinds,
    "published_json": q_published_json,
    "published_texts": q_published_texts,
    "uv_rejects": q_uv_rejects,
    "first_visit_fix_large": q_first_visit_fix_large,
}

from tidepool.plans import db_queries as _db  # noqa: E402

QUERIES.update(_db.QUERIES)
