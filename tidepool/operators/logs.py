"""App-log operators: dirty split (P1), field access (P3), first-visit repair (W1),
log split (P5), display explode (P6), session entry (P7), day bucket (P8) and the
daily unique visit (W2), in batch form.

Input rows are ``(arrival, seq, value)``: arrival order is ``(arrival, seq)`` and
``seq`` is unique per record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions import json as J
from tidepool.functions.sizing import MAX_BROADCAST_ROWS, checked_broadcast
from tidepool.functions.time import day_of, day_text
from tidepool.operators.ordering import DEFAULT_CHUNK, DEFAULT_FANOUT, ORDER, carry_in, chunk_of
from tidepool.session import checkpoint_root

# Dirty reasons.
MALFORMED = "malformed"      # not a JSON object (P1, Q15)
NO_MID = "no_mid"            # no common.mid to key by (Q4)
NO_PAGE = "no_page"          # unique visits: page record without a page object (Q5)
NO_TS = "no_ts"              # unique visits: session entry without ts (Q5)

ROUTE_START, ROUTE_PAGE, ROUTE_DISPLAY, ROUTE_DIRTY = "start", "page", "display", "dirty"


def parse_app_log(raw: DataFrame) -> DataFrame:
    """P1 + P3: parse once, expose the fields the jobs read, tag dirty records.

    Adds ``v`` (VARIANT of the object), ``reason`` (NULL for clean records) and the
    typed fields ``mid, is_new, start, page_id, last_page_id, ts``; other input
    columns are carried through. The parse is its
    own step (``evaluate_once``) and the fields read the parsed column, so each
    text is parsed once even when later filters are pushed down.
    """
    carried = [c for c in raw.columns if c not in ("arrival", "seq", "value")]
    parsed = J.evaluate_once(raw, J.parse_object(F.col("value")), "v",
                             ["arrival", "seq", "value", *carried])
    v = F.col("v")
    mid = J.get(v, "$.common.mid")
    return parsed.select(
        "arrival", "seq", "value", *carried, "v",
        F.when(v.isNull(), F.lit(MALFORMED)).when(mid.isNull(), F.lit(NO_MID)).alias("reason"),
        mid.alias("mid"),
        J.get(v, "$.common.is_new").alias("is_new"),
        J.get(v, "$.start").alias("start"),
        J.get(v, "$.page.page_id").alias("page_id"),
        J.get(v, "$.page.last_page_id").alias("last_page_id"),
        J.get(v, "$.ts", "bigint").alias("ts"),
    )


def clean(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull())


def dirty(parsed: DataFrame) -> DataFrame:
    """The dirty side output: the raw text, with why it was set aside."""
    return parsed.where(F.col("reason").isNotNull()).select("arrival", "seq", "reason", "value")


def first_visit_fix(parsed: DataFrame, bound: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Per mid, only the first arriving record claiming ``is_new = "1"`` keeps
    it; later claims become ``"0"``. Other records pass unchanged.

    Adds ``is_new_in`` (as received), ``is_new`` (repaired) and ``repaired``.

    The first claim per mid is a partial aggregate (map-side combined, so a hot mid
    costs one row per partition), written once as a reliable checkpoint in the
    shared checkpoint folder and then counted with a bound:

    * proven small: broadcast to a left join with every record; the log is not
      shuffled and is read twice in all (aggregate, join);
    * otherwise only the claims are joined back, on ``(mid, arrival, seq)``, which
      hashes on the unique ``seq`` too, so no mid becomes one task; all other
      records go through without an exchange. The whole log is never shuffled.
    """
    if parsed.isStreaming:
        raise ValueError("first_visit_fix is the batch form of W1; streams use "
                         "tidepool.streaming.jobs.repaired_log")
    checkpoint_root(parsed.sparkSession)
    is_claim = F.col("reason").isNull() & (F.col("is_new") == "1")
    first = (parsed.where(is_claim).groupBy("mid")
             .agg(F.min(F.struct(*ORDER)).alias("_first"))
             .select(F.col("mid").alias("_fm"), F.col("_first.arrival").alias("_fa"),
                     F.col("_first.seq").alias("_fs"))
             .checkpoint(eager=True))
    first, small = checked_broadcast(first, bound)
    cond = ((F.col("mid") == F.col("_fm")) & (F.col("arrival") == F.col("_fa"))
            & (F.col("seq") == F.col("_fs")))
    if small:
        j = parsed.join(first, cond, "left")
        repaired = F.coalesce(is_claim & F.col("_fm").isNull(), F.lit(False))
        out = j.withColumn("repaired", repaired).drop("_fm", "_fa", "_fs")
    else:
        checked = (parsed.where(is_claim).join(first, cond, "left")
                   .withColumn("repaired", F.col("_fm").isNull())
                   .drop("_fm", "_fa", "_fs"))
        rest = parsed.where(~F.coalesce(is_claim, F.lit(False))).withColumn("repaired", F.lit(False))
        out = checked.unionByName(rest)
    return (out.withColumn("is_new_in", F.col("is_new"))
               .withColumn("is_new", F.when(F.col("repaired"), F.lit("0")).otherwise(F.col("is_new"))))


def first_claims(parsed: DataFrame) -> DataFrame:
    """W1's state after these records: the mids (``mid``) that have claimed ``is_new = "1"``."""
    return parsed.where(F.col("reason").isNull() & (F.col("is_new") == "1")).select("mid").distinct()


def is_start(start: Column) -> Column:
    """P5: a non-null, non-empty ``start`` makes a start record (Q13: ``{}`` counts)."""
    return start.isNotNull() & (F.length(start) > 0)


def route_of(df: DataFrame) -> Column:
    return (F.when(F.col("reason").isNotNull(), F.lit(ROUTE_DIRTY))
             .when(is_start(F.col("start")), F.lit(ROUTE_START))
             .otherwise(F.lit(ROUTE_PAGE)))


def may_hold_null() -> Column:
    """Whether a record's text can hold a null field at all; most cannot."""
    return F.contains(F.col("value"), F.lit("null"))


def record_json(df: DataFrame) -> Column:
    """The record to publish, without the null fields of its objects (Q12). A
    repaired record has the flag written back as the string ``"0"`` (Q1). Only those
    records, and records whose text holds a ``null``, are serialised anew; all others
    are published as received."""
    common = J.as_object_map(J.get(F.col("v"), "$.common", "variant"))
    fixed_common = F.to_variant_object(J.put(common, "is_new", J.variant_text(F.lit("0"))))
    anew = J.object_to_json(F.transform_values(
        J.as_object_map(F.col("v")),
        lambda k, x: F.when(F.col("repaired") & (k == "common"), fixed_common).otherwise(x)))
    return F.when(may_hold_null(), J.without_nulls(anew)).when(F.col("repaired"), anew).otherwise(F.col("value"))


def displays(v: Column) -> Column:
    """The ``displays`` array as ARRAY<VARIANT>; NULL when absent or not an array."""
    return J.get(v, "$.displays", "array<variant>")


def display_json(d: Column, page_id: Column, nulls: Column) -> Column:
    """A display's own fields with ``page_id`` set (overwritten); a NULL page id
    is left out, as the reference's serialiser drops nulls; ``nulls`` tells whether
    the record may hold others."""
    m = J.put(J.as_object_map(d), "page_id", J.variant_text(page_id))
    text = J.object_to_json(J.drop_null_values(m))
    return F.when(nulls, J.without_nulls(text)).otherwise(text)


def split_start(fixed: DataFrame) -> DataFrame:
    return fixed.where(F.col("reason").isNull() & is_start(F.col("start")))


def split_page(fixed: DataFrame) -> DataFrame:
    return fixed.where(F.col("reason").isNull() & ~is_start(F.col("start")))


def explode_displays(pages: DataFrame) -> DataFrame:
    """One row per element of a page record's ``displays``, 1-based ``pos``.

    Empty or missing arrays give no rows; non-object elements are skipped. A page
    record without a page object still emits its displays with a NULL page id (Q3).
    """
    rows = pages.select("arrival", "seq", "page_id", may_hold_null().alias("_nulls"),
                        F.posexplode(displays(F.col("v"))).alias("_pos", "_d"))
    rows = rows.where(J.as_object_map(F.col("_d")).isNotNull())
    return rows.select(
        "arrival", "seq", (F.col("_pos") + 1).alias("pos"), "page_id",
        J.get(F.col("_d"), "$.item").alias("item"),
        display_json(F.col("_d"), F.col("page_id"), F.col("_nulls")).alias("value"),
    )


def split_all(fixed: DataFrame) -> DataFrame:
    """J1 outputs in one pass: every record becomes its own row (dirty, start or
    page) plus, for page records, one row per display. One generator over the
    repaired records, so the input is read once and no union re-reads it.

    Columns: ``route, arrival, seq, pos, mid, is_new, page_id, last_page_id, ts,
    item, value`` (``value`` is the JSON text to publish).
    """
    route = route_of(fixed)
    own = F.struct(
        route.alias("route"), F.lit(0).alias("pos"),
        F.when(route == ROUTE_DIRTY, F.col("value")).otherwise(record_json(fixed)).alias("value"),
        F.lit(None).cast("string").alias("item"))
    page_id, nulls = F.col("page_id"), may_hold_null()
    shown = F.transform(
        F.filter(F.coalesce(displays(F.col("v")), F.array().cast("array<variant>")),
                 lambda d: J.as_object_map(d).isNotNull()),
        lambda d, i: F.struct(F.lit(ROUTE_DISPLAY).alias("route"), (i + 1).alias("pos"),
                              display_json(d, page_id, nulls).alias("value"),
                              J.get(d, "$.item").alias("item")))
    rows = F.when(route == ROUTE_PAGE, F.concat(F.array(own), shown)).otherwise(F.array(own))
    out = fixed.select("arrival", "seq", "mid", "is_new", "page_id", "last_page_id", "ts",
                       F.explode(rows).alias("_r"))
    disp = F.col("_r.route") == ROUTE_DISPLAY
    dirty_row = F.col("_r.route") == ROUTE_DIRTY
    return out.select(
        F.col("_r.route").alias("route"), "arrival", "seq", F.col("_r.pos").alias("pos"),
        F.when(~disp & ~dirty_row, F.col("mid")).alias("mid"),
        F.when(~disp & ~dirty_row, F.col("is_new")).alias("is_new"),
        F.when(~dirty_row, F.col("page_id")).alias("page_id"),
        F.when(~disp & ~dirty_row, F.col("last_page_id")).alias("last_page_id"),
        F.when(~disp & ~dirty_row, F.col("ts")).alias("ts"),
        F.col("_r.item").alias("item"),
        F.col("_r.value").alias("value"),
    )


def session_entry(last_page_id: Column) -> Column:
    """A page view with no previous page starts a session."""
    return F.coalesce(last_page_id, F.lit("")) == ""


def parse_page_log(raw: DataFrame) -> DataFrame:
    """P2 on the page dataset for unique visits: parse and tag rejects (Q4, Q5)."""
    p = parse_app_log(raw)
    has_page = J.as_object_map(J.get(F.col("v"), "$.page", "variant")).isNotNull()
    entry = session_entry(F.col("last_page_id"))
    reason = (F.when(F.col("reason").isNotNull(), F.col("reason"))
               .when(~has_page, F.lit(NO_PAGE))
               .when(entry & F.col("ts").isNull(), F.lit(NO_TS)))
    return p.withColumn("reason", reason)


def unique_visit(pages: DataFrame, chunk_width: int = DEFAULT_CHUNK,
                 fanout: int = DEFAULT_FANOUT) -> DataFrame:
    """Among session entries, per mid in arrival order, keep a record iff its
    day differs from the day of the last kept record.

    The kept day is always the previous entry's day (an entry on the same day
    leaves the state unchanged), so this is a lag over arrival order; it is run per
    (mid, chunk) with the previous chunk's last day carried in, see
    ``tidepool.operators.ordering``. Returns the kept entries with ``day`` (text).
    Not ``distinct(mid, day)``: out-of-order days make a day count again.
    """
    e = (pages.where(F.col("reason").isNull() & session_entry(F.col("last_page_id")))
              .withColumn("_day", day_of(F.col("ts")))
              .withColumn("_chunk", chunk_of(F.col("arrival"), chunk_width)))
    # The window's shuffle on (mid, chunk) also serves the per-chunk tails of the
    # carry (no new exchange) and the join back, so the input is read once.
    w = Window.partitionBy("mid", "_chunk").orderBy(*ORDER)
    scanned = e.withColumn("_lag", F.lag("_day").over(w))
    carry = carry_in(scanned, ["mid"], "_chunk", F.col("_day"), fanout=fanout)
    kept = (scanned.join(carry, ["mid", "_chunk"], "left")
            .withColumn("_prev", F.coalesce(F.col("_lag"), F.col("carry")))
            .where(F.col("_prev").isNull() | (F.col("_prev") != F.col("_day"))))
    return kept.withColumn("day", day_text(F.col("ts"))).drop("_day", "_chunk", "carry", "_prev", "_lag")


def last_days(pages: DataFrame) -> DataFrame:
    """W2's state after these records: ``mid, day`` (text) of the entry last kept, which is
    the day of the last entry. One partial aggregate per mid."""
    entries = pages.where(F.col("reason").isNull() & session_entry(F.col("last_page_id")))
    return entries.groupBy("mid").agg(F.max_by(day_text(F.col("ts")), F.struct(*ORDER)).alias("day"))


def page_rejects(pages: DataFrame) -> DataFrame:
    """Page records that unique visits cannot use (Q4, Q5): ``arrival, seq, reason, value``."""
    return pages.where(F.col("reason").isNotNull()).select("arrival", "seq", "reason", "value")


def day_bucket(parsed: DataFrame) -> DataFrame:
    """P8 over clean records that carry a ts."""
    return (clean(parsed).where(F.col("ts").isNotNull())
            .select("seq", "ts", day_text(F.col("ts")).alias("day")))
