"""Streaming jobs: J1 (log split), J2 (unique visits), J3 (change ingestion),
J4 (rule routing), J6 (change stream to console), S4 (raw landing).

Every query has a checkpoint location under the shared checkpoint folder
(``spark.checkpoint.dir``), so state and source progress survive a restart or a
lost executor (Q16). Multi-output and dynamic sinks run in ``foreachBatch`` and
write under the query's and the batch's id with overwrite, so a retried batch
replaces its output. Every record read is written somewhere: what a job cannot use
goes to a topic of its own with the reason and the text received.

Jobs write to file topics under ``root`` unless given another ``sink`` (an object
with ``write(records, batch_id)``, e.g. ``KafkaTopics``), and read file topics unless
given a ``source``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from tidepool.functions import json as J
from tidepool.functions.time import day_text
from tidepool.operators import cdc as C
from tidepool.operators import dims as D
from tidepool.operators import handover as H
from tidepool.operators import logs as L
from tidepool.operators import rules as R
from tidepool.operators.ordering import DEFAULT_CHUNK, chunk_of
from tidepool.session import checkpoint_root
from tidepool.sources import landing as S4
from tidepool.sources import topics as T
from tidepool.streaming.processors import (
    DAY_MS, W1_INPUT, W1_OUTPUT, W1_STATE, W2_CHUNKED, W2_INPUT, W2_OUTPUT, CurrentRowProcessor,
    FirstVisitProcessor, UniqueVisitProcessor, first_visit_groups, last_change, reduced_chunk)

ODS_LOG, ODS_DB = "ods_base_log", "ods_base_db"
DWD_START, DWD_PAGE, DWD_DISPLAY, DIRTY = "dwd_start_log", "dwd_page_log", "dwd_display_log", "dirty_log"
DWM_UV = "dwm_unique_visit"
DIRTY_DB = "dirty_db"
DIM_REJECTS = "dim_rejects"
DIRTY_PAGE = "dirty_page_log"
ROUTE_MISSES, RULE_REJECTS = "route_misses", "rule_rejects"
RULE_TABLE = "table_process"
# Topics of the engine itself, which no rule may name as its sink.
SYSTEM_TOPICS = [ODS_LOG, ODS_DB, DWD_START, DWD_PAGE, DWD_DISPLAY, DIRTY, DWM_UV, DIRTY_DB, DIRTY_PAGE,
                 DIM_REJECTS, ROUTE_MISSES, RULE_REJECTS]
RESERVED = "reserved_topic"
ROUTE_TOPICS = {L.ROUTE_START: DWD_START, L.ROUTE_PAGE: DWD_PAGE,
                L.ROUTE_DISPLAY: DWD_DISPLAY, L.ROUTE_DIRTY: DIRTY}


def _checkpoint(spark: SparkSession, name: str, location: str | None) -> str:
    return location or os.path.join(checkpoint_root(spark), "streams", name)


def _start(df: DataFrame, name: str, checkpoint: str, handler, trigger: dict) -> StreamingQuery:
    return (df.writeStream.queryName(name).option("checkpointLocation", checkpoint)
            .foreachBatch(handler).trigger(**trigger).start())


def repaired_log(raw: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """P1 + W1 on a stream: claims go through the keyed processor, every other
    record bypasses it (no state to touch, no shuffle). With ``history`` (raw records
    from before the stream) the mids that have claimed there are its initial state.

    Returns the parsed columns of ``logs.parse_app_log`` plus ``is_new_in`` and
    ``repaired``, ready for ``logs.split_all``. Records are parsed once; only the
    claims, which cross the Python processor as text, are parsed again after it.
    """
    parsed = L.parse_app_log(raw)
    is_claim = F.col("reason").isNull() & (F.col("is_new") == "1")
    keyed = parsed.where(is_claim).select(*W1_INPUT).groupBy("mid")
    if history is None:
        decided = keyed.applyInPandasWithState(first_visit_groups, W1_OUTPUT, W1_STATE, "append", GroupStateTimeout.NoTimeout)
    else:
        decided = keyed.transformWithStateInPandas(FirstVisitProcessor(), W1_OUTPUT, "Append", "None",
                                                   L.first_claims(L.parse_app_log(history)).groupBy("mid"))
    claims = (decided.select("arrival", "seq", "value", F.col("is_new").alias("_fixed"), "repaired"))
    claims = (L.parse_app_log(claims)
              .withColumn("is_new_in", F.col("is_new"))
              .withColumn("is_new", F.col("_fixed")).drop("_fixed"))
    rest = (parsed.where(~F.coalesce(is_claim, F.lit(False)))
            .withColumn("repaired", F.lit(False)).withColumn("is_new_in", F.col("is_new")))
    return claims.unionByName(rest)


def start_log_job(spark: SparkSession, root: str, trigger: dict | None = None,
                  checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                  source: DataFrame | None = None, sink=None,
                  history: DataFrame | None = None) -> StreamingQuery:
    """ods_base_log -> dirty / start / page / display topics.

    A job on a new checkpoint has no state; ``history``, the raw records handled before
    its stream begins (in batch, or by a job on another checkpoint), gives it that state.
    """
    raw = source if source is not None else T.read_topic(
        spark, root, ODS_LOG, stream=True, max_files_per_trigger=max_files_per_trigger)
    stream = repaired_log(raw, history)
    sink = sink or T.FileTopics(root)
    topic_of = F.create_map(*[x for kv in ROUTE_TOPICS.items() for x in map(F.lit, kv)])

    def write(batch: DataFrame, batch_id: int) -> None:
        # All four topics in one job: the batch is computed once, nothing cached.
        out = L.split_all(batch)
        sink.write(out.withColumn("topic", topic_of[F.col("route")]), batch_id)

    return _start(stream, "log_job", _checkpoint(spark, "log_job", checkpoint), write,
                  trigger or {"availableNow": True})


def unique_visits(raw_pages: DataFrame, ttl_ms: int | None = None, history: DataFrame | None = None,
                  chunk_width: int = DEFAULT_CHUNK) -> DataFrame:
    """P2 + P7 + W2 (+ W3 when ``ttl_ms``) on a stream of page records; only
    session entries are shuffled, to be reduced by mid and chunk of ``chunk_width``
    arrival units, and of these a row or few a chunk to the keyed processor. ``history``
    holds page records from before the stream, whose last kept days are the initial
    state."""
    return _visits_of(L.parse_page_log(raw_pages), ttl_ms, history, chunk_width)


def _visits_of(parsed_pages: DataFrame, ttl_ms: int | None, history: DataFrame | None = None,
               chunk_width: int = DEFAULT_CHUNK) -> DataFrame:
    entries = (parsed_pages.where(F.col("reason").isNull() & L.session_entry(F.col("last_page_id")))
               .withColumn("day", day_text(F.col("ts"))).select(*W2_INPUT))
    time_mode = "ProcessingTime" if ttl_ms else "None"
    reduced = (entries.groupBy("mid", chunk_of(F.col("arrival"), chunk_width).alias("chunk"))
               .applyInPandas(reduced_chunk, W2_CHUNKED))
    return (reduced.groupBy("mid")
            .transformWithStateInPandas(UniqueVisitProcessor(ttl_ms), W2_OUTPUT, "Append", time_mode, None if history is None
                                        else L.last_days(L.parse_page_log(history)).groupBy("mid")))


def start_uv_job(spark: SparkSession, root: str, trigger: dict | None = None,
                 checkpoint: str | None = None, ttl: bool = False,
                 max_files_per_trigger: int | None = None, source: DataFrame | None = None,
                 sink=None, history: DataFrame | None = None, chunk_width: int = DEFAULT_CHUNK) -> StreamingQuery:
    """dwd_page_log -> dwm_unique_visit; records it cannot use (Q4, Q5) to
    ``dirty_page_log``. ``ttl=True`` adds the 24 h state expiry (W3); such a query
    keeps making batches, so stop it explicitly (H4). ``history`` is as for
    ``start_log_job``: the page records before the stream."""
    pages = source if source is not None else T.read_topic(
        spark, root, DWD_PAGE, stream=True, max_files_per_trigger=max_files_per_trigger)
    parsed = L.parse_page_log(pages)
    uv = _visits_of(parsed, DAY_MS if ttl else None, history, chunk_width).select(
        F.lit(DWM_UV).alias("topic"), "arrival", "seq", "value")
    rejects = L.page_rejects(parsed).select(
        F.lit(DIRTY_PAGE).alias("topic"), "arrival", "seq", F.to_json(F.struct("reason", "value")).alias("value"))
    sink = sink or T.FileTopics(root)

    def write(batch: DataFrame, batch_id: int) -> None:
        sink.write(batch, batch_id)

    return _start(uv.unionByName(rejects), "uv_job", _checkpoint(spark, "uv_job", checkpoint), write,
                  trigger or {"availableNow": True})


def start_cdc_job(spark: SparkSession, root: str, changes: DataFrame, trigger: dict | None = None,
                  checkpoint: str | None = None, sink=None) -> StreamingQuery:
    """Raw change envelopes -> normalised ods_base_db (P9, P4); what cannot be
    read goes to ``dirty_db`` with the reason, topic and text received."""
    norm = C.normalize(changes)
    sink = sink or T.FileTopics(root)

    def write(batch: DataFrame, batch_id: int) -> None:
        # Normalised records and rejects in one job, each to its topic.
        good = F.col("reason").isNull()
        sink.write(batch.select(
            F.when(good, F.lit(ODS_DB)).otherwise(F.lit(DIRTY_DB)).alias("topic"), "arrival", "seq",
            F.when(good, C.record_json()).otherwise(C.reject_json()).alias("value")), batch_id)

    return _start(norm, "cdc_job", _checkpoint(spark, "cdc_job", checkpoint), write,
                  trigger or {"availableNow": True})


def retractions(changes: DataFrame, table: str, columns: list[str], not_null: list[str] = ("id",),
                chunk_width: int = DEFAULT_CHUNK) -> DataFrame:
    """S3 on a stream of normalised changes: what every micro-batch takes back from the
    current table and adds to it, as ``kind`` (``+I``, ``-U``, ``+U``, ``-D``), the place of the change
    in the log and the row. A batch's changes are first reduced to the last of every key
    and chunk of arrivals, so a hot key is many small tasks and the state sees a row a chunk.
    """
    log, _ = C.table_changelog(changes, table, columns, not_null)
    key, schema = not_null[0], ", ".join(f"`{c}` string" for c in columns)
    last = log.groupBy(key, chunk_of(F.col("arrival"), chunk_width).alias("chunk")).applyInPandas(
        last_change, f"arrival long, seq long, op string, {schema}")
    return last.groupBy(key).transformWithStateInPandas(
        CurrentRowProcessor(columns), f"kind string, arrival long, seq long, {schema}", "Append", "None")


def table_topic(table: str) -> str:
    """The topic of a running table's retractions."""
    return f"{table}_retractions"


def start_table_job(spark: SparkSession, root: str, changes: DataFrame, table: str, columns: list[str],
                    not_null: list[str] = ("id",), trigger: dict | None = None, checkpoint: str | None = None,
                    sink=None, chunk_width: int = DEFAULT_CHUNK) -> StreamingQuery:
    """J5 as a running job: raw change envelopes -> the retractions of the declared table;
    its rows at any time are ``current_table``. Rows that violate a NOT NULL column go to
    ``dirty_db`` with their reason, as do envelopes that cannot be read."""
    norm = C.normalize(changes)
    out = retractions(norm, table, columns, not_null, chunk_width).select(
        F.lit(table_topic(table)).alias("topic"), "arrival", "seq",
        F.to_json(F.struct("kind", F.struct(*columns).alias("row")), {"ignoreNullFields": "false"}).alias("value"))
    _, broken = C.table_changelog(norm, table, columns, not_null)
    dirty = norm.where(F.col("reason").isNotNull()).select(
        F.lit(DIRTY_DB).alias("topic"), "arrival", "seq", C.reject_json().alias("value"))
    dirty = dirty.unionByName(broken.select(F.lit(DIRTY_DB).alias("topic"), "arrival", "seq",
                                            F.to_json(F.struct("reason", "op", *columns)).alias("value")))
    sink = sink or T.FileTopics(root)

    def write(batch: DataFrame, batch_id: int) -> None:
        sink.write(batch, batch_id)

    return _start(out.unionByName(dirty), f"table_{table}", _checkpoint(spark, f"table_{table}", checkpoint), write,
                  trigger or {"availableNow": True})


def current_table(spark: SparkSession, root: str, table: str, columns: list[str]) -> DataFrame:
    """The rows of a running table now: the fold of its retractions."""
    schema = f"struct<kind: string, row: struct<{', '.join(f'{c}: string' for c in columns)}>>"
    rows = T.read_topic(spark, root, table_topic(table)).select(F.from_json("value", schema).alias("r"))
    return C.folded_retractions(rows.select("r.kind", "r.row.*"))


_PLACED = ["_key", "_range", "_low", "_high"]


def start_handover_job(spark: SparkSession, root: str, snapshot: DataFrame, ranges: DataFrame, changes: DataFrame,
                       table: str, key: str = "id", width: int = H.RANGE_WIDTH, trigger: dict | None = None,
                       checkpoint: str | None = None, sink=None) -> StreamingQuery:
    """S2 + J3 with an initial snapshot taken while changes go on (``operators.handover``).

    ``snapshot`` holds the rows read, as raw envelopes, and ``ranges`` their windows, both
    complete; ``changes`` is the log as a stream, from before the first window on. Records
    of a window are kept beside the topics until the log has passed its end; then the rows
    of its range go to ods_base_db as ``read`` changes, with the first records after it.
    Once all windows have closed, batches read nothing but their records and the ranges. A
    record that comes after records of a later position is kept with its window, or
    follows as a change if that has closed.
    """
    norm = C.normalize(changes)
    rows = C.normalize(snapshot).where(F.col("reason").isNull())
    sink = sink or T.FileTopics(root)
    folder = os.path.join(root, "_handover", table)
    end = ranges.agg(F.max("high")).first()[0]
    closed = [end is None]
    schemas = {"positions": "position long", "window": ", ".join(
        [*(f"`{c}` long" for c in _PLACED), *(f"{c} {norm.schema[c].dataType.simpleString()}" for c in H.COLUMNS)])}

    def read(name: str, producer: str, upto: int) -> DataFrame:
        """What this query's batches up to ``upto`` have kept."""
        return (spark.read.schema(f"{schemas[name]}, producer string, batch_id long").parquet(H.made(spark, os.path.join(folder, name)))
                .where((F.col("producer") == producer) & (F.col("batch_id") <= upto)))

    def keep(df: DataFrame, name: str, producer: str, batch_id: int) -> None:
        (df.withColumn("producer", F.lit(producer)).withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("producer", "batch_id").parquet(os.path.join(folder, name)))

    def closing_reads(before: int | None, now: int | None, producer: str, batch_id: int) -> DataFrame | None:
        """The reads of the ranges whose windows this batch has passed."""
        passed = ranges.where(F.col("high") < F.lit(now))
        passed = passed if before is None else passed.where(F.col("high") >= before)
        if now is None or passed.isEmpty():
            return None
        kept = read("window", producer, batch_id)
        window = kept.where(F.col("_key").isNotNull()).join(passed.select(F.col("range").alias("_range")), "_range", "left_semi")
        found = H.with_range(rows, passed, key, width).where(F.col("_high").isNotNull())
        return H.reconciled(found, window, H.truncations(kept, table))

    def write(batch: DataFrame, batch_id: int) -> None:
        producer, mine = T.producer_of(batch), H.is_row_change(table)
        placed = H.with_range(batch, ranges, key, width).persist()
        try:
            reads, gone = None, F.lit(True)
            if not closed[0]:
                before = read("positions", producer, batch_id - 1).agg(F.max("position")).first()[0]
                here = placed.agg(F.max("arrival")).first()[0]
                now = max((p for p in (before, here) if p is not None), default=None)
                keep(spark.createDataFrame([(now,)], "position long"), "positions", producer, batch_id)
                gone = F.lit(False) if before is None else F.col("_high") < before
                emptied = F.col("reason").isNull() & (F.col("table_name") == table) & (F.col("type") == "truncate")
                keep(placed.where(F.coalesce((mine & H.in_window() & ~gone) | emptied, F.lit(False))).select(*_PLACED, *H.COLUMNS),
                     "window", producer, batch_id)
                reads = closing_reads(before, now, producer, batch_id)
                closed[0] = before is not None and before > end
            behind = ~mine | F.col("_high").isNull() | (F.col("arrival") > F.col("_high")) | (H.in_window() & gone)
            out = placed.where(F.coalesce(behind, F.lit(False))).select(*H.COLUMNS)
            out = out if reads is None else reads.unionByName(out)
            good = F.col("reason").isNull()
            sink.write(out.select(
                F.when(good, F.lit(ODS_DB)).otherwise(F.lit(DIRTY_DB)).alias("topic"), "arrival", "seq",
                F.when(good, C.record_json()).otherwise(C.reject_json()).alias("value")), batch_id)
        finally:
            placed.unpersist()

    return _start(norm, "handover_job", _checkpoint(spark, "handover_job", checkpoint), write,
                  trigger or {"availableNow": True})


def _start_print(records: DataFrame, name: str, label: str, out: str | None, num_rows: int,
                 trigger: dict | None, checkpoint: str | None) -> StreamingQuery:
    """K5: every record as a labelled line in ``out``, one folder per batch, and the
    first ``num_rows`` of each batch on the console as a view of them."""
    spark = records.sparkSession
    out = out or os.path.join(checkpoint_root(spark), "printed", name)
    lines = records.select(F.concat(F.lit(f"{label}> "), F.coalesce("value", F.lit("null"))).alias("value"))

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = os.path.join(out, f"producer={T.producer_of(batch)}", f"batch_id={batch_id}")
        batch.write.mode("overwrite").text(folder)
        batch.sparkSession.read.text(folder).show(num_rows, truncate=False)

    return _start(lines, name, _checkpoint(spark, name, checkpoint), write, trigger or {"availableNow": True})


def start_console_job(spark: SparkSession, changes: DataFrame, trigger: dict | None = None,
                      checkpoint: str | None = None, num_rows: int = 20, out: str | None = None) -> StreamingQuery:
    """Raw change envelopes -> every normalised record, and every reject with its
    reason, printed (K5)."""
    norm = C.normalize(changes)
    text = norm.select(F.when(F.col("reason").isNull(), C.record_json()).otherwise(C.reject_json()).alias("value"))
    return _start_print(text, "console_job", "change", out, num_rows, trigger, checkpoint)


def start_topic_console(spark: SparkSession, root: str, topic: str, trigger: dict | None = None,
                        checkpoint: str | None = None, num_rows: int = 20, out: str | None = None,
                        source: DataFrame | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """S1 + K5 debug reader: print a topic's records as they arrive (the
    reference's manual check of the page topic)."""
    records = source if source is not None else T.read_topic(
        spark, root, topic, stream=True, max_files_per_trigger=max_files_per_trigger)
    return _start_print(records, f"console_{topic}", topic, out, num_rows, trigger, checkpoint)


def start_rule_job(spark: SparkSession, root: str, rule_changes: DataFrame,
                   trigger: dict | None = None, checkpoint: str | None = None,
                   dims: D.DimStore | None = None, rule_table: str = RULE_TABLE,
                   honour_sink_pk: bool = False, sink=None) -> StreamingQuery:
    """J4 query A (R1): changes of the rule table -> the rule event log. The rule
    table in force is the fold of that log (``current_rules``). Changes of other
    tables are no rules and are left out; unreadable ones, and rules whose names
    cannot be used, go to ``rule_rejects``.

    With ``dims``, each batch's dimension rules create their dimension (K3), as the
    reference creates its table when such a rule arrives, over the columns of all
    live rules of that dimension. The rows read back are those rules: DDL runs on
    the driver, once per dimension, and the rule table is configuration-sized.
    """
    norm = C.normalize(rule_changes)
    sink = sink or T.FileTopics(root)
    _ensure_rule_log(spark, root)

    def write(batch: DataFrame, batch_id: int) -> None:
        events = R.bind_rules(batch.where(F.col("reason").isNull() & (F.col("table_name") == rule_table)))
        (events.withColumn("producer", F.lit(T.producer_of(batch))).withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("producer", "batch_id").parquet(_rule_path(root)))
        rejected = batch.where(F.col("reason").isNotNull()).select("arrival", "seq", C.reject_json().alias("value"))
        bad = _unusable(events)
        sink.write(rejected.unionByName(bad).withColumn("topic", F.lit(RULE_REJECTS)), batch_id)
        if dims is not None:
            _ensure_dimensions(spark, root, events, dims, honour_sink_pk)

    return _start(norm, "rule_job", _checkpoint(spark, "rule_job", checkpoint), write,
                  trigger or {"availableNow": True})


_RULE_SCHEMA = ("arrival long, seq long, " + ", ".join(f"{c} string" for c in R.RULE_FIELDS)
                + ", retired boolean, producer string, batch_id long")


def _rule_path(root: str) -> str:
    return os.path.join(root, "_rules")


def _ensure_rule_log(spark: SparkSession, root: str) -> None:
    """An empty rule log, so that a reader before the first rule finds none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_rule_path(root))
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(path)


def _dimension_columns(sink_columns: str | None, key: str) -> list[str]:
    return [c for c in (sink_columns or "").split(",") if c and c != key]


def _unusable(events: DataFrame) -> DataFrame:
    """Live dimension rules with a name that cannot be a table or column: ``arrival, seq, value``."""
    word = r"^[A-Za-z_][A-Za-z0-9_]*$"
    bad = F.exists(F.filter(F.split(F.coalesce("sink_columns", F.lit("")), ","), lambda c: c != ""),
                   lambda c: ~c.rlike(word))
    return (events.where((F.col("sink_type") == R.SINK_HBASE) & ~F.col("retired")
                         & (bad | ~F.coalesce("sink_table", F.lit("")).rlike(word)))
            .select("arrival", "seq", F.to_json(F.struct(
                F.lit("bad_name").alias("reason"), "source_table", "operate_type", "sink_table", "sink_columns")).alias("value")))


def _ensure_dimensions(spark: SparkSession, root: str, events: DataFrame, dims: D.DimStore,
                       honour_sink_pk: bool) -> None:
    """Views of the dimensions that this batch's rules name, over all their live rules.
    Columns whose name cannot be used hold no cell and are left out."""
    named = events.where((F.col("sink_type") == R.SINK_HBASE) & ~F.col("retired")).select("sink_table").distinct()
    live = current_rules(spark, root).where(F.col("sink_type") == R.SINK_HBASE).join(named, "sink_table", "left_semi")
    columns: dict[str, set[str]] = {}
    for r in live.select("sink_table", "sink_columns", "sink_pk").distinct().collect():
        if D.is_name(r["sink_table"]):
            key = r["sink_pk"] if honour_sink_pk and r["sink_pk"] else "id"
            columns.setdefault(r["sink_table"], set()).update(
                c for c in _dimension_columns(r["sink_columns"], key) if D.is_name(c))
    for name, cols in sorted(columns.items()):
        dims.ensure_dimension(name, sorted(cols))


def rule_log(spark: SparkSession, root: str) -> DataFrame:
    """The rule event log written by ``start_rule_job``; empty before its first batch."""
    _ensure_rule_log(spark, root)
    return spark.read.schema(_RULE_SCHEMA).parquet(_rule_path(root)).drop("producer", "batch_id")


def current_rules(spark: SparkSession, root: str) -> DataFrame:
    """The rule table in force now: the fold of the rule event log."""
    return R.latest_rules(rule_log(spark, root))


class RuleHistory:
    """The rule events a routing job needs, kept from batch to batch.

    For changes that arrive from some position on, of all events up to it only the last
    of every rule key counts. So the events held are one per key and those after that
    position; a batch reads the rule batches written since the one before, and bins
    the events anew only if there are any. Its cost does not grow with the history. Changes
    from before that position (late ones) are looked up in the whole log. A job
    started anew reads the whole log once.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.seen: dict[str, int] = {}           # last rule batch read of each producer
        self.held: DataFrame | None = None
        self.at: int | None = None               # the position up to which events are folded
        self.plan: dict = {}                     # how ``lookup_asof`` is to look the events held up
        self.reads = 0                           # times that rule batches were read

    def _written(self) -> dict[str, int]:
        """The last batch of each producer in the rule log, from its folders' names."""
        _ensure_rule_log(self.spark, self.root)
        path = self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(_rule_path(self.root), "producer=*", "batch_id=*"))
        found = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).globStatus(path)
        out: dict[str, int] = {}
        for status in found or []:
            producer, batch = (x.split("=", 1)[1] for x in status.getPath().toString().split("/")[-2:])
            out[producer] = max(out.get(producer, -1), int(batch))
        return out

    def _extended(self) -> DataFrame | None:
        """The events held and those written since, or None if there are no new ones."""
        written = self._written()
        new = {p: b for p, b in written.items() if b > self.seen.get(p, -1)}
        if self.held is not None and not new:
            return None
        self.reads += 1
        wanted = F.lit(False)
        for p in new:
            wanted = wanted | ((F.col("producer") == p) & (F.col("batch_id") > self.seen.get(p, -1)) & (F.col("batch_id") <= new[p]))
        fresh = (self.spark.read.schema(_RULE_SCHEMA).parquet(_rule_path(self.root)).where(wanted).drop("producer", "batch_id"))
        self.seen = written
        return fresh if self.held is None else self.held.unionByName(fresh)

    def since(self, low: int | None) -> tuple[DataFrame, dict]:
        """Events for changes that arrive from ``low`` on, and the options to look them up with."""
        if self.at is not None and low is not None and low < self.at:
            return rule_log(self.spark, self.root), {}
        known = self._extended()
        if known is not None:
            if low is not None:
                known, self.at = R.events_from(known, low), low
            checkpoint_root(self.spark)
            self.held = known.checkpoint(eager=True)
            binned = R.prepare_asof(R.keyed_events(self.held))
            self.plan = {"force": "chunked"} if binned is None else {"binned": binned}
        return self.held, self.plan

    def latest(self) -> DataFrame:
        """The last event of every rule key."""
        known = self._extended()
        if known is not None:
            checkpoint_root(self.spark)
            self.held = R.last_events(known).checkpoint(eager=True)
        return self.held


ODS_SCHEMA = ("struct<database: string, tableName: string, before: map<string,string>, "
              "after: map<string,string>, type: string, _corrupt_record: string>")


def start_route_job(spark: SparkSession, root: str, dims: D.DimStore, changes: DataFrame | None = None,
                    trigger: dict | None = None, checkpoint: str | None = None,
                    asof: bool = True, honour_sink_pk: bool = False, sink=None,
                    compact_every: int = 100, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """J4 query B: ods_base_db -> rule lookup (R2), trim (P10), route (R3) ->
    dynamic fact topics (K2) and dimension upsert (K4).

    Rules are kept between micro-batches and extended by what the rule log has got
    since (``RuleHistory``). With ``asof`` (default) each change
    takes the rule in force at its own arrival (R2t), as the reference does when
    it handles records in arrival order, even when a rule change and the changes
    around it fall into one batch. ``asof=False`` uses the latest rules, so a rule
    change takes effect from the next batch. ``honour_sink_pk`` keys dimension rows
    by the rule's ``sink_pk`` instead of ``id`` (Q9, off as in the reference).

    Text that is no record goes to ``dirty_db`` (P2), records without a rule, with a
    sink of unknown type or with a system topic as their sink to ``route_misses``,
    records without a row key to ``dim_rejects``. Every ``compact_every`` batches the
    dimension store is folded, by this job as its only writer.
    """
    src = changes if changes is not None else T.read_topic(
        spark, root, ODS_DB, stream=True, max_files_per_trigger=max_files_per_trigger)
    rec = F.from_json(F.col("value"), ODS_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt_record"})
    norm = _ods_columns(src, rec)
    sink = sink or T.FileTopics(root)

    history = RuleHistory(spark, root)

    def lookup(batch: DataFrame) -> DataFrame:
        if not asof:
            return R.route_changes(batch, R.latest_rules(history.latest()))
        events, plan = history.since(batch.agg(F.min("arrival")).first()[0])
        return R.apply_rules(R.lookup_asof(batch, events, **plan))

    def write(batch: DataFrame, batch_id: int) -> None:
        # Parsed once: its first arrival, its rejects and its look-up all read it.
        batch = batch.persist()
        dirty = batch.where(F.col("reason").isNotNull()).select(
            F.lit(DIRTY_DB).alias("topic"), "arrival", "seq",
            F.to_json(F.struct("reason", F.lit(ODS_DB).alias("topic"), "value")).alias("value"))
        routed = lookup(batch.where(F.col("reason").isNull()).drop("reason", "value")).persist()
        try:
            out = fact_and_miss_records(routed)
            cells, rejects = D.cells(routed.where(F.col("route") == R.SINK_HBASE),
                                     honour_sink_pk=honour_sink_pk)
            rejected = rejects.select(F.lit(DIM_REJECTS).alias("topic"), "arrival", "seq",
                                      F.to_json(F.struct("sink_table", "reason")).alias("value"))
            # Facts, misses and rejects in one job; the cells go to the dimension store.
            sink.write(out.unionByName(rejected).unionByName(dirty), batch_id)
            dims.append(cells, f"{T.producer_of(batch)}-{batch_id}")
        finally:
            routed.unpersist()
            batch.unpersist()
        if compact_every and batch_id % compact_every == compact_every - 1:
            dims.compact()

    return _start(norm, "route_job", _checkpoint(spark, "route_job", checkpoint), write,
                  trigger or {"availableNow": True})


def fact_and_miss_records(routed: DataFrame) -> DataFrame:
    """Routed changes that are no dimension rows, as topic records: facts to the topic
    their rule names (K2), all others to ``route_misses`` with the reason."""
    route = F.when((F.col("route") == R.SINK_KAFKA) & (F.col("sink_table").isNull() | F.col("sink_table").isin(SYSTEM_TOPICS)),
                   F.lit(RESERVED)).otherwise(F.col("route"))
    fact = F.col("_route") == R.SINK_KAFKA
    miss = F.to_json(F.struct(F.col("_route").alias("reason"), "database", F.col("table_name").alias("tableName"),
                              "type", "before", "after", F.col("sink_table").alias("sinkTable")))
    return (routed.where(F.col("route") != R.SINK_HBASE).withColumn("_route", route)
            .select(F.when(fact, F.col("sink_table")).otherwise(F.lit(ROUTE_MISSES)).alias("topic"), "arrival", "seq",
                    F.when(fact, F.to_json("after")).otherwise(miss).alias("value")))


def _ods_columns(src: DataFrame, rec) -> DataFrame:
    """ods_base_db text -> the normalised columns the router reads; text that is no
    record has a ``reason`` (P2)."""
    empty = F.create_map().cast("map<string,string>")
    ok = (F.col("_r").isNotNull() & F.col("_r._corrupt_record").isNull() & J.opens_object(F.col("value")))
    return (J.evaluate_once(src, rec, "_r", ["arrival", "seq", "value"])
            .select("arrival", "seq", "value", F.when(~F.coalesce(ok, F.lit(False)), F.lit(C.MALFORMED)).alias("reason"),
                    F.col("_r.database").alias("database"),
                    F.col("_r.tableName").alias("table_name"), F.col("_r.type").alias("type"),
                    F.coalesce("_r.before", empty).alias("before"), F.coalesce("_r.after", empty).alias("after")))


def start_landing_job(spark: SparkSession, incoming: str, root: str, landing: str,
                      trigger: dict | None = None, checkpoint: str | None = None, sink=None,
                      max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Text lines of files dropped in ``incoming`` -> bare lines under
    ``landing/dt=<day of receipt>/batch_id=<n>/`` and the ods_base_log topic, in the
    order received (file time, path, place in the file)."""
    sink = sink or T.FileTopics(root)

    def write(batch: DataFrame, batch_id: int) -> None:
        lines = batch.withColumn("line", F.monotonically_increasing_id()).persist()
        counts = os.path.join(root, "_landing", T.producer_of(batch))
        try:
            before = S4.files_before(spark, counts, batch_id)
            b = S4.in_order(lines, before)
            S4.keep_files(spark, counts, batch_id, before + lines.select("received_ms", "path").distinct().count())
            S4.write_landing(S4.land(b, "received_ms"), landing, batch_id)
            sink.write(b.select(F.lit(ODS_LOG).alias("topic"), "arrival", "seq", "value"), batch_id)
        finally:
            lines.unpersist()

    return _start(S4.received_lines(spark, incoming, max_files_per_trigger), "landing_job", _checkpoint(spark, "landing_job", checkpoint),
                  write, trigger or {"availableNow": True})
