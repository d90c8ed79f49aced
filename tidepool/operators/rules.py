"""Rule-driven routing: rule binding (P12), rule-table maintenance (R1), rule
lookup (R2), lookup under changing rules (R2t), column trim (P10), sink table
(P11) and routing by sink type (R3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions.sizing import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, checked_broadcast, fits
from tidepool.operators.ordering import DEFAULT_CHUNK, DEFAULT_FANOUT, ORDER, SNAPSHOT, SNAPSHOT_CHUNK, carry_in, chunk_of
from tidepool.session import checkpoint_root

RULE_FIELDS = ["source_table", "operate_type", "sink_type", "sink_table", "sink_columns",
               "sink_pk", "sink_extend"]
KEY = ["source_table", "operate_type"]
PAYLOAD = ["sink_type", "sink_table", "sink_columns", "sink_pk", "sink_extend"]

# Sink-type constants (fixed values of the rule table).
SINK_HBASE, SINK_KAFKA, SINK_CLICKHOUSE = "hbase", "kafka", "clickhouse"
ROUTE_NO_RULE, ROUTE_UNKNOWN = "no_rule", "unknown_sink"


def bind_rules(rule_changes: DataFrame) -> DataFrame:
    """Normalised changes of the rule table -> typed rule events.

    Columns ``arrival, seq, <RULE_FIELDS>, retired``. A change with an empty
    ``after`` (a rule delete) retires the rule named by its ``before`` (Q7).
    """
    gone = F.cardinality("after") == 0
    image = F.when(gone, F.col("before")).otherwise(F.col("after"))
    return rule_changes.where(F.col("reason").isNull()).select(
        "arrival", "seq", *[image[c].alias(c) for c in RULE_FIELDS], gone.alias("retired"))


def latest_rules(rule_events: DataFrame) -> DataFrame:
    """The rule table after folding its change log: last arrival per
    ``source_table-operate_type`` wins, the change's own op is ignored, a key
    changed to another key leaves the old one in place (Q8), retired keys drop.

    A partial aggregate per key: a key with most of the log costs one row per
    input partition before the shuffle.
    """
    body = F.struct(*[F.col(c) for c in PAYLOAD + ["retired", "arrival"]])
    folded = (rule_events.where(F.col("source_table").isNotNull() & F.col("operate_type").isNotNull())
              .groupBy(*KEY).agg(F.max_by(body, F.struct(*ORDER)).alias("_r")))
    return (folded.where(~F.col("_r.retired"))
            .select(*KEY, *[F.col(f"_r.{c}").alias(c) for c in PAYLOAD],
                    F.col("_r.arrival").alias("rule_arrival")))


def lookup(changes: DataFrame, rules: DataFrame, bound: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """R2: attach the rule for ``tableName-type``; equi-join on the two columns.

    Misses are kept with NULL rule fields and ``matched = false``. The rule table is
    folded once into a reliable checkpoint and broadcast only after its rows and
    bytes are checked; otherwise a shuffled join is planned and AQE splits skewed
    keys.
    """
    checkpoint_root(rules.sparkSession)
    rules = rules.checkpoint(eager=True)
    r = rules.select(F.col("source_table").alias("_st"), F.col("operate_type").alias("_ot"),
                     *PAYLOAD, F.lit(True).alias("matched"))
    r, _ = checked_broadcast(r, bound)
    j = changes.join(r, (F.col("table_name") == F.col("_st")) & (F.col("type") == F.col("_ot")), "left")
    return j.drop("_st", "_ot").withColumn("matched", F.coalesce("matched", F.lit(False)))


def trim_columns(after: Column, sink_columns: Column) -> Column:
    """P10: keep the ``after`` fields listed in comma-separated ``sink_columns``;
    exact names, blanks not trimmed."""
    cols = F.split(sink_columns, ",")
    return F.map_filter(after, lambda k, _: F.array_contains(cols, k))


def route(matched: Column, sink_type: Column) -> Column:
    """Kafka -> main, hbase -> side, anything else dropped (kept here as
    ``unknown_sink`` for counting); a miss is ``no_rule``. Case-sensitive."""
    return (F.when(~matched, F.lit(ROUTE_NO_RULE))
             .when(sink_type == SINK_KAFKA, F.lit(SINK_KAFKA))
             .when(sink_type == SINK_HBASE, F.lit(SINK_HBASE))
             .otherwise(F.lit(ROUTE_UNKNOWN)))


def apply_rules(looked_up: DataFrame) -> DataFrame:
    """P10 + P11 + R3 on looked-up changes: trimmed ``after``, ``sink_table``, ``route``."""
    trimmed = F.when(F.col("matched"), trim_columns(F.col("after"), F.col("sink_columns"))) \
               .otherwise(F.col("after"))
    return (looked_up.withColumn("after", trimmed)
            .withColumn("route", route(F.col("matched"), F.col("sink_type"))))


def route_changes(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """R2 -> P10 -> P11 -> R3."""
    return apply_rules(lookup(changes, rules))


# --- R2t: lookup under changing rules -------------------------------------------------

# Rule events above which the as-of lookup is not broadcast. Binned intervals are
# at most twice the events, ~150 bytes each: at most ~75 MB shipped per executor.
MAX_ASOF_BROADCAST_EVENTS = 250_000


def keyed_events(rule_events: DataFrame) -> DataFrame:
    """Events whose key can match a change."""
    return rule_events.where(F.col("source_table").isNotNull() & F.col("operate_type").isNotNull())


def last_events(rule_events: DataFrame) -> DataFrame:
    """The last event of every rule key, as it is; a partial aggregate per key."""
    columns = rule_events.columns
    return (rule_events.groupBy(*KEY).agg(F.max_by(F.struct(*columns), F.struct(*ORDER)).alias("_e"))
            .select(*[F.col(f"_e.{c}").alias(c) for c in columns]))


def events_from(rule_events: DataFrame, low: int) -> DataFrame:
    """The events that decide for changes arriving from ``low`` on: of those up to ``low`` the
    last of every key, and all later ones."""
    return last_events(rule_events.where(F.col("arrival") <= low)).unionByName(rule_events.where(F.col("arrival") > low))


def lookup_asof(changes: DataFrame, rule_events: DataFrame, bound: int = MAX_ASOF_BROADCAST_EVENTS,
                chunk_width: int = DEFAULT_CHUNK, force: str | None = None,
                fanout: int = DEFAULT_FANOUT, binned: DataFrame | None = None) -> DataFrame:
    """R2t: each change sees the rule in force when it arrives: the latest rule
    event of its key with ``rule.arrival <= change.arrival`` (a rule and a change
    arriving together: the rule first). Before the first rule, or after a retire,
    it misses.

    A NULL table or type matches no rule, on either side and in either plan.

    Two plans:

    * ``broadcast``: a rule history proven small (at most ``bound`` events, and bytes
      within the broadcast bound) is cut into intervals ``[arrival, next arrival)``,
      binned per key into about as many buckets as the key has versions, written
      once as a checkpoint and broadcast; each change probes the one ``(key,
      bucket)`` its arrival falls in. The change side is not shuffled. Chosen while
      no bucket holds more than ``MAX_INTERVALS_PER_BUCKET`` intervals, which bounds
      the work per change.
    * ``chunked``: otherwise, the chunked as-of scan: one shuffle on (key, chunk),
      linear in both sides, never one rule key in one task.

    ``force`` ("broadcast" / "chunked") pins the plan for tests. ``binned`` is the outcome of
    ``prepare_asof`` over these events, where a caller has it from before.
    """
    rule_events = keyed_events(rule_events)
    if binned is None and force != "chunked":
        binned = prepare_asof(rule_events, bound, force == "broadcast")
    if binned is not None:
        out = _asof_broadcast(changes, binned)
    else:
        out = _asof_chunked(changes, rule_events, chunk_width, fanout)
    hit = F.col("rule_arrival").isNotNull() & ~F.coalesce(F.col("_retired"), F.lit(True))
    for c in PAYLOAD:
        out = out.withColumn(c, F.when(hit, F.col(c)))
    return out.withColumn("matched", hit).drop("_retired")


MAX_INTERVALS_PER_BUCKET = 64


def prepare_asof(rule_events: DataFrame, bound: int = MAX_ASOF_BROADCAST_EVENTS,
                 always: bool = False) -> DataFrame | None:
    """The binned history for the broadcast plan, or None when the chunked one is due.

    The history is measured in one distributed pass. If it is within the bounds, its
    binned intervals are computed once and written as a reliable checkpoint in the
    shared checkpoint folder; the bucket check, the key map and the interval table
    all read that. ``always`` skips the checks (tests).
    """
    if not always and not fits(rule_events, bound, MAX_BROADCAST_BYTES):
        return None
    checkpoint_root(rule_events.sparkSession)
    binned = _bucket_layout(rule_events).checkpoint(eager=True)
    busiest = (binned.where(F.col("_b").isNotNull()).groupBy(*KEY, "_b").count()
               .agg(F.max("count").alias("m")).first()["m"]) or 0
    return binned if always or busiest <= MAX_INTERVALS_PER_BUCKET else None


def choose_asof_plan(rule_events: DataFrame, bound: int = MAX_ASOF_BROADCAST_EVENTS) -> str:
    """The plan ``lookup_asof`` takes for this history."""
    return "chunked" if prepare_asof(rule_events, bound) is None else "broadcast"


def _bucket_layout(rule_events: DataFrame) -> DataFrame:
    """Each non-empty interval once per bucket ``_b`` it overlaps, with its key's layout.

    An event is in force from its arrival until the next event of its key. Per key,
    ``_kmin`` is the first arrival of a non-empty interval, ``_kw`` the bucket width
    (the key's arrival span over its number of intervals, at least 1) and ``_klast``
    the last bucket; the last interval runs to the last bucket. An interval left
    empty by a later event at the same arrival is one row with a NULL bucket.
    Intervals are disjoint per key, so the rows total at most events + buckets,
    about twice the history. All windows share one exchange on the rule key, and the
    history is bounded by then.
    """
    whole = Window.partitionBy(*KEY)
    until = F.lead("arrival").over(whole.orderBy(*ORDER))
    nonempty = F.col("_until").isNull() | (F.col("_until") > F.col("arrival"))
    at = F.when(nonempty, F.col("arrival"))
    iv = (rule_events.withColumn("_until", until)
          .withColumn("_kmin", F.min(at).over(whole)).withColumn("_kmax", F.max(at).over(whole))
          .withColumn("_kn", F.count(at).over(whole))
          .withColumn("_kw", F.greatest(F.lit(1), F.ceil((F.col("_kmax") - F.col("_kmin") + 1)
                                                         / F.col("_kn"))).cast("long"))
          .withColumn("_klast", F.expr("(_kmax - _kmin) div _kw")).drop("_kmax", "_kn"))
    first = F.expr("(arrival - _kmin) div _kw")
    last = F.when(F.col("_until").isNull(), F.col("_klast")) \
            .otherwise(F.expr("(_until - 1 - _kmin) div _kw"))
    return iv.withColumn("_b", F.explode_outer(F.when(nonempty, F.sequence(first, last))))


def _asof_broadcast(changes: DataFrame, binned: DataFrame) -> DataFrame:
    km = (binned.groupBy(F.col("source_table").alias("_st"), F.col("operate_type").alias("_ot"))
          .agg(*[F.first(c).alias(c) for c in ("_kmin", "_kw", "_klast")]))
    bt = binned.where(F.col("_b").isNotNull()).select(
        F.col("source_table").alias("_bst"), F.col("operate_type").alias("_bot"), "_b",
        F.col("arrival").alias("rule_arrival"), "_until", *PAYLOAD,
        F.col("retired").alias("_retired"))
    probe = (changes.join(F.broadcast(km), (F.col("table_name") == F.col("_st"))
                          & (F.col("type") == F.col("_ot")), "left")
             .withColumn("_qb", F.least(F.greatest(F.expr("(arrival - _kmin) div _kw"), F.lit(0)),
                                        F.col("_klast")))
             .drop("_st", "_ot", "_kmin", "_kw", "_klast"))
    cond = ((F.col("table_name") == F.col("_bst")) & (F.col("type") == F.col("_bot"))
            & (F.col("_qb") == F.col("_b"))
            & (F.col("arrival") >= F.col("rule_arrival"))
            & (F.col("_until").isNull() | (F.col("arrival") < F.col("_until"))))
    return (probe.join(F.broadcast(bt), cond, "left")
            .drop("_bst", "_bot", "_b", "_qb", "_until"))


def _asof_chunked(changes: DataFrame, rule_events: DataFrame, chunk_width: int,
                  fanout: int = DEFAULT_FANOUT) -> DataFrame:
    rule = F.struct(F.col("arrival").alias("rule_arrival"), *PAYLOAD,
                    F.col("retired").alias("_retired"))
    r = rule_events.select(F.col("source_table").alias("_st"), F.col("operate_type").alias("_ot"),
                           "arrival", "seq", F.lit(0).alias("_tag"), rule.alias("_rule"))
    c = changes.select(F.col("table_name").alias("_st"), F.col("type").alias("_ot"),
                       "arrival", "seq", F.lit(1).alias("_tag"),
                       F.lit(None).cast(r.schema["_rule"].dataType).alias("_rule"),
                       F.struct(*[F.col(x) for x in changes.columns]).alias("_row"))
    u = (r.withColumn("_row", F.lit(None).cast(c.schema["_row"].dataType))
          .unionByName(c)
          # Snapshot rules come before all snapshot changes, whatever their own order.
          .withColumn("_chunk", F.when((F.col("_tag") == 0) & (F.col("arrival") == SNAPSHOT), F.lit(SNAPSHOT_CHUNK - 1))
                      .otherwise(chunk_of(F.col("arrival"), chunk_width, F.col("seq")))))
    keys = ["_st", "_ot"]
    # NULL-keyed changes match nothing; their own seq keeps them out of one group.
    u = u.withColumn("_st", F.when(F.col("_st").isNull() | F.col("_ot").isNull(),
                                   F.concat(F.lit("\0"), F.col("seq").cast("string"))).otherwise(F.col("_st"))) \
         .withColumn("_ot", F.coalesce("_ot", F.lit("")))
    w = (Window.partitionBy(*keys, "_chunk").orderBy("arrival", "_tag", "seq")
         .rowsBetween(Window.unboundedPreceding, 0))
    scanned = u.withColumn("_seen", F.last("_rule", ignorenulls=True).over(w))
    carry = carry_in(scanned, keys, "_chunk", F.col("_rule"), present=F.col("_tag") == 0, fanout=fanout)
    out = (scanned.where(F.col("_tag") == 1)
           .join(carry, keys + ["_chunk"], "left")
           .withColumn("_in_force", F.coalesce(F.col("_seen"), F.col("carry"))))
    return out.select("_row.*", F.col("_in_force.rule_arrival").alias("rule_arrival"),
                      *[F.col(f"_in_force.{p}").alias(p) for p in PAYLOAD],
                      F.col("_in_force._retired").alias("_retired"))
