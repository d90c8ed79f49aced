"""Adapter views: reshape the provided ``events`` and ``orders`` tables into the
record shapes the reference consumes (app-log JSON text, change records, rules).

The app-log and change-log texts follow the adapter definitions in FIXTURES.md
so that Spark and the DuckDB oracle see the same input rows. Every adapter is a
narrow projection of a whole table: it grows with the table and adds no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.sources.tables import table

# Fixed values of the adapters (FIXTURES.md §3-§4): the delay of every seventh
# event in arrival positions, the malformed-record period, and the rule rows.
DELAY_EVERY = 7
DELAY_BY = 2500
MALFORMED_EVERY = 50
FIXED_RULES = [
    ("orders", "insert", "kafka", "dwd_order_info", "id,o_orderpriority"),
    ("orders", "update", "hbase", "dim_order", "id,o_orderpriority,o_orderstatus"),
    ("orders", "delete", "clickhouse", "unused", "id"),
]
# Arrival positions after which a device's state expires (FIXTURES.md §7).
EXPIRY = 600
RULE_COLUMNS = ["source_table", "operate_type", "sink_type", "sink_table", "sink_columns"]
CDC_DATABASE = "shop"
CDC_SERVER = "dbserver"

_K = "cast(get_json_object(props, '$.k') as int)"
_MS = "unix_millis(cast(ts as timestamp))"

APP_LOG_VALUE = f"""
case when event_id % {MALFORMED_EVERY} = 0 then '{{bad' else concat(
  '{{"common":{{"mid":"', cast(user_id as string), '","is_new":"',
  case when event_id % 2 = 0 then '1' else '0' end, '"}},',
  case when event_type = 'signup' then '"start":{{"entry":"icon"}},' else concat(
    '"page":{{"page_id":"', event_type, '"',
    case when {_K} < 30 then ''
         when {_K} < 40 then ',"last_page_id":""'
         else concat(',"last_page_id":"p', cast({_K} as string), '"') end, '}},',
    case when {_K} % 4 = 0 then '"displays":[],'
         when {_K} % 4 = 1 then '"displays":[{{"item":"1"}}],'
         when {_K} % 4 = 2 then '"displays":[{{"item":"1"}},{{"item":"2"}}],'
         else '"displays":[{{"item":"1"}},{{"item":"2"}},{{"item":"3"}}],' end) end,
  '"ts":', cast({_MS} as string), '}}') end
"""


def app_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ods_base_log stream as ``(arrival, seq, value)``; ``seq`` is the event id.

    Arrival order is ``(arrival, seq)``: every seventh event arrives late.
    """
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.expr(f"case when event_id % {DELAY_EVERY} = 0 then event_id + {DELAY_BY} "
               f"else event_id end").alias("arrival"),
        F.col("event_id").alias("seq"),
        F.expr(APP_LOG_VALUE).alias("value"),
    )


def cdc_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records of the ``orders`` table in typed form (FIXTURES.md §4).

    A NULL column stands for a field absent from the change.
    """
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("arrival"),
        F.col("o_orderkey").alias("seq"),
        F.lit("orders").alias("table_name"),
        F.expr("case when o_orderkey % 10 < 4 then 'insert' when o_orderkey % 10 < 8 then 'update' "
               "when o_orderkey % 10 = 8 then 'delete' else 'read' end").alias("type"),
        F.col("o_custkey").cast("string").alias("id"),
        F.col("o_orderpriority"),
        F.expr("case when o_orderkey % 3 = 0 then null else o_orderstatus end").alias("o_orderstatus"),
    )


def rules(spark: SparkSession) -> DataFrame:
    """The fixed rule rows, as the initial snapshot of the rule table; ``seq`` is
    the row's position."""
    rows = [(i, *r) for i, r in enumerate(FIXED_RULES)]
    return spark.createDataFrame(rows, "seq long, " + ", ".join(f"{c} string" for c in RULE_COLUMNS))


def app_log_received(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The app log as the logger receives it: text plus receive time (epoch ms),
    taken as the event time."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("seq"), F.expr(_MS).alias("received_ms"),
                     F.expr(APP_LOG_VALUE).alias("value"))


def rule_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule-change history derived from ``orders``: one rule edit per order row.

    Used where the rule table itself must be large (R1 folding, R2t as-of lookup):
    the key is ``('orders', op)``, the op chosen by customer, the sink by order
    status and priority.
    """
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("arrival"),
        F.col("o_orderkey").alias("seq"),
        F.lit("orders").alias("source_table"),
        F.expr("case o_custkey % 4 when 0 then 'insert' when 1 then 'update' "
               "when 2 then 'delete' else 'read' end").alias("operate_type"),
        F.expr("case o_orderstatus when 'O' then 'kafka' when 'F' then 'hbase' "
               "else 'clickhouse' end").alias("sink_type"),
        F.concat(F.lit("sink_"), F.substring("o_orderpriority", 1, 1)).alias("sink_table"),
        F.expr("case when o_orderkey % 2 = 0 then 'id,o_orderpriority' "
               "else 'id,o_orderpriority,o_orderstatus' end").alias("sink_columns"),
    )


# Kinds of app-log text by event id modulo 10, besides plain records: what surrounds,
# replaces or fills the object.
LOG_KINDS = """
case event_id % 10
  when 0 then concat(chr(9), chr(10), {plain})
  when 1 then concat('[', {plain}, ']')
  when 2 then 'null'
  when 3 then concat('"', event_type, '"')
  when 4 then ''
  when 5 then concat('{{"x":null,', substring({plain}, 2))
  when 6 then replace({plain}, '"page":{{', '"page":{{"ref":null,')
  else {plain} end
"""


def app_log_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The app log with all kinds of text a tolerant parse meets (FIXTURES.md §6)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("arrival"), F.col("event_id").alias("seq"),
                     F.expr(LOG_KINDS.format(plain=f"({APP_LOG_VALUE})")).alias("value"))


# Nested nulls put into the page of every tenth record, and into the object of another tenth (FIXTURES.md §7).
NESTED_NULLS = '"page":{"ref":{"a":null,"b":[null,{"c":null,"d":{"e":null}}]},'


def app_log_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The app log with null fields at several depths, in objects within arrays too."""
    ev = table(spark, sf_dir, "events")
    plain = f"({APP_LOG_VALUE})"
    return ev.select(F.col("event_id").alias("arrival"), F.col("event_id").alias("seq"), F.expr(f"""
        case event_id % 10 when 5 then concat('{{"x":null,', substring({plain}, 2))
          when 6 then replace({plain}, '"page":{{', '{NESTED_NULLS}') else {plain} end""").alias("value"))


def cdc_envelopes_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw change envelopes of ``orders`` with what a change source also sends: deletes
    with a filled ``before`` and no ``after``, cut-off text, topics without a table, and
    white space before the object (FIXTURES.md §6)."""
    o = table(spark, sf_dir, "orders")
    row = "concat('{\"id\":\"', o_custkey, '\",\"o_orderpriority\":\"', o_orderpriority, '\"}')"
    env = f"""
    case when o_orderkey % 10 = 8 then concat('{{"before":', {row}, ',"after":null,"op":"d"}}')
         when o_orderkey % 10 = 7 then concat('{{"before":', {row}, ',"after":', {row}, ',"op":"u"}}')
         else concat('{{"before":null,"after":', {row}, ',"op":"c"}}') end"""
    return o.select(
        F.col("o_orderkey").alias("arrival"), F.col("o_orderkey").alias("seq"),
        F.expr(f"case when o_orderkey % 13 = 0 then '{CDC_SERVER}' else '{CDC_SERVER}.{CDC_DATABASE}.orders' end").alias("topic"),
        F.expr(f"case when o_orderkey % 11 = 0 then concat('{{oops ', o_orderkey) "
               f"when o_orderkey % 11 = 1 then concat(chr(10), {env}) else {env} end").alias("value"))


def rule_log_retiring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rule_log`` where every ninth edit retires the rule of its key."""
    return rule_log(spark, sf_dir).withColumn("retired", F.col("seq") % 9 == 0)


# Fixed values of the snapshot fixture (FIXTURES.md §7): keys of a range, and the log
# positions at which a range's window opens, its rows are read and the window closes.
HANDOVER_WIDTH = 64
HANDOVER_LOW = "200 + 70 * {range}"
HANDOVER_READ = "350 + 70 * {range}"
HANDOVER_HIGH = "500 + 70 * {range}"


def handover_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key ranges of the snapshot of ``orders`` changes, with their windows."""
    r = table(spark, sf_dir, "orders").select(F.expr(f"o_custkey div {HANDOVER_WIDTH}").cast("long").alias("range")).distinct()
    return r.select("range", F.expr(HANDOVER_LOW.format(range="range")).alias("low"),
                    F.expr(HANDOVER_HIGH.format(range="range")).alias("high"))


def handover_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows a snapshot finds: of each id the state after the changes up to the position
    at which its range is read."""
    c = cdc_rows(spark, sf_dir)
    read_at = HANDOVER_READ.format(range=f"(cast(id as long) div {HANDOVER_WIDTH})")
    last = (c.where(F.expr(f"arrival <= {read_at}")).groupBy("id")
            .agg(F.max_by(F.struct("type", "o_orderpriority", "o_orderstatus"), "arrival").alias("r")))
    return last.where("r.type <> 'delete'").select(
        F.col("id").cast("long").alias("seq"), "id", "r.o_orderpriority", "r.o_orderstatus")


_DECIMAL = "org.apache.kafka.connect.data.Decimal"
_ROW_SCHEMA = (
    '"type":"struct","optional":true,"fields":['
    '{"field":"l_orderkey","type":"int64"},{"field":"l_linenumber","type":"int32"},'
    f'{{"field":"price","type":"bytes","name":"{_DECIMAL}","parameters":{{"scale":"2"}}}},'
    f'{{"field":"discount","type":"bytes","name":"{_DECIMAL}","parameters":{{"scale":"4"}}}},'
    '{"field":"day","type":"int32","name":"io.debezium.time.Date"},'
    '{"field":"at","type":"int64","name":"io.debezium.time.MicroTimestamp"},'
    '{"field":"flags","type":"struct","fields":[{"field":"returnflag","type":"string"},'
    f'{{"field":"tax","type":"bytes","name":"{_DECIMAL}","parameters":{{"scale":"2"}}}}]}}]')
_TYPED_SCHEMA = ('{"type":"struct","fields":[{"field":"before",' + _ROW_SCHEMA + '},{"field":"after",' + _ROW_SCHEMA
                 + '},{"field":"op","type":"string"}]}')


def typed_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` rows as change envelopes that carry their schema (FIXTURES.md §7)."""
    def wire(number: str) -> str:
        return f"base64(unhex(lpad(hex(cast({number} as bigint)), 16, '0')))"

    li = table(spark, sf_dir, "lineitem")
    row = f"""concat('{{"l_orderkey":', l_orderkey, ',"l_linenumber":', l_linenumber,
      ',"price":"', {wire("round(l_extendedprice * 100)")}, '","discount":"',
      case when l_suppkey % 10 = 0 then '*' else {wire("round(l_discount * 10000) * if(l_returnflag = 'R', -1, 1)")} end,
      '","day":', unix_date(cast(l_shipdate as date)), ',"at":', unix_micros(cast(l_shipdate as timestamp)) + l_linenumber * 3600000000,
      ',"flags":{{"returnflag":"', l_returnflag, '","tax":',
      case when l_partkey % 10 = 0 then 'null' else concat('"', {wire("round(l_tax * 100)")}, '"') end, '}}}}')"""
    return li.select(
        F.expr("l_orderkey * 10 + l_linenumber").alias("arrival"), F.expr("l_orderkey * 10 + l_linenumber").alias("seq"),
        F.lit(f"{CDC_SERVER}.{CDC_DATABASE}.lineitem").alias("topic"),
        F.concat(F.lit('{"schema":' + _TYPED_SCHEMA + ',"payload":{"before":'),
                 F.expr(f"case when l_linenumber = 7 then {row} else 'null' end"), F.lit(',"after":'),
                 F.expr(f"case when l_linenumber = 7 then 'null' else {row} end"),
                 F.expr("""concat(',"op":"', if(l_linenumber = 7, 'd', 'c'), '"}}')""")).alias("value"))
