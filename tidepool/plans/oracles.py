"""DuckDB twins of the registered queries, over the same provided tables.

The adapter CTEs restate the fixtures in DuckDB SQL (FIXTURES.md §3-§4); the
stateful steps use the window forms the sequential rules reduce to.
"""

from __future__ import annotations

_K = "cast(json_extract_string(props, '$.k') as int)"

APP_LOG = f"""
app_log as (
  select event_id as seq,
    case when event_id % 7 = 0 then event_id + 2500 else event_id end as arrival,
    case when event_id % 50 = 0 then '{{bad' else concat(
      '{{"common":{{"mid":"', cast(user_id as varchar), '","is_new":"',
      case when event_id % 2 = 0 then '1' else '0' end, '"}},',
      case when event_type = 'signup' then '"start":{{"entry":"icon"}},' else concat(
        '"page":{{"page_id":"', event_type, '"',
        case when {_K} < 30 then ''
             when {_K} < 40 then ',"last_page_id":""'
             else concat(',"last_page_id":"p', cast({_K} as varchar), '"') end, '}},',
        case when {_K} % 4 = 0 then '"displays":[],'
             when {_K} % 4 = 1 then '"displays":[{{"item":"1"}}],'
             when {_K} % 4 = 2 then '"displays":[{{"item":"1"}},{{"item":"2"}}],'
             else '"displays":[{{"item":"1"}},{{"item":"2"}},{{"item":"3"}}],' end) end,
      '"ts":', cast(epoch_us(ts) // 1000 as varchar), '}}') end as value,
    epoch_us(ts) // 1000 as received_ms
  from events
),
valid_log as (
  select *, case when json_valid(value) then value end as vj from app_log
),
obj_log as (
  select seq, arrival, value, case when json_type(vj) = 'OBJECT' then vj end as j from valid_log
),
parsed as (
  select seq, arrival, value, j,
    case when j is null then 'malformed'
         when json_extract_string(j, '$.common.mid') is null then 'no_mid' end as reason,
    json_extract_string(j, '$.common.mid') as mid,
    json_extract_string(j, '$.common.is_new') as is_new,
    json_extract_string(j, '$.start') as start,
    json_extract_string(j, '$.page.page_id') as page_id,
    json_extract_string(j, '$.page.last_page_id') as last_page_id,
    cast(json_extract_string(j, '$.ts') as bigint) as ts
  from obj_log
),
clean as (select * from parsed where reason is null),
fixed as (
  select *, is_new as is_new_in,
    case when is_new = '1' and row_number() over (partition by mid, is_new order by arrival, seq) > 1
         then 1 else 0 end as repaired
  from clean
),
fixed2 as (
  select * exclude (is_new), case when repaired = 1 then '0' else is_new end as is_new from fixed
),
starts as (select * from fixed2 where start is not null and length(start) > 0),
pages as (select * from fixed2 where not (start is not null and length(start) > 0)),
displays as (
  select p.seq, d.i + 1 as pos, p.page_id,
    json_extract_string(p.j, '$.displays[' || d.i || '].item') as item
  from pages p,
    lateral (select unnest(range(cast(coalesce(json_array_length(p.j, '$.displays'), 0) as bigint))) as i) d
),
entries as (select * from pages where coalesce(last_page_id, '') = ''),
uv as (
  select * from (
    select *, strftime(epoch_ms(ts), '%Y-%m-%d') as day,
      lag(strftime(epoch_ms(ts), '%Y-%m-%d')) over (partition by mid order by arrival, seq) as prev_day
    from entries) t
  where prev_day is distinct from day
)
"""


def _with(body: str, recursive: bool = False) -> str:
    return ("with recursive " if recursive else "with ") + APP_LOG.strip() + "\n" + body


CDC = """
cdc as (
  select o_orderkey as arrival, o_orderkey as seq, 'orders' as table_name,
    case when o_orderkey % 10 < 4 then 'insert' when o_orderkey % 10 < 8 then 'update'
         when o_orderkey % 10 = 8 then 'delete' else 'read' end as type,
    cast(o_custkey as varchar) as id, o_orderpriority,
    case when o_orderkey % 3 = 0 then null else o_orderstatus end as o_orderstatus
  from orders
),
rules as (
  select * from (values
    ('orders','insert','kafka','dwd_order_info','id,o_orderpriority'),
    ('orders','update','hbase','dim_order','id,o_orderpriority,o_orderstatus'),
    ('orders','delete','clickhouse','unused','id'))
    as r(source_table, operate_type, sink_type, sink_table, sink_columns)
),
looked as (
  select c.*, r.sink_type, r.sink_table, r.sink_columns, r.source_table is not null as matched
  from cdc c left join rules r on c.table_name = r.source_table and c.type = r.operate_type
),
trimmed as (
  select arrival, seq, type, matched, sink_type, sink_table, sink_columns,
    case when not matched or list_contains(string_split(sink_columns, ','), 'id') then id end as id,
    case when not matched or list_contains(string_split(sink_columns, ','), 'o_orderpriority')
         then o_orderpriority end as o_orderpriority,
    case when not matched or list_contains(string_split(sink_columns, ','), 'o_orderstatus')
         then o_orderstatus end as o_orderstatus,
    case when not matched then 'no_rule' when sink_type = 'kafka' then 'kafka'
         when sink_type = 'hbase' then 'hbase' else 'unknown_sink' end as route
  from looked
),
rule_log as (
  select o_orderkey as arrival, o_orderkey as seq, 'orders' as source_table,
    case o_custkey % 4 when 0 then 'insert' when 1 then 'update' when 2 then 'delete'
         else 'read' end as operate_type,
    case o_orderstatus when 'O' then 'kafka' when 'F' then 'hbase' else 'clickhouse' end as sink_type,
    concat('sink_', substr(o_orderpriority, 1, 1)) as sink_table,
    case when o_orderkey % 2 = 0 then 'id,o_orderpriority'
         else 'id,o_orderpriority,o_orderstatus' end as sink_columns
  from orders
)
"""


def _cdc(body: str) -> str:
    return "with " + CDC.strip() + "\n" + body


# The texts of FIXTURES.md §6.
LOG_KINDS = """
, kinds as (
  select e.event_id as seq, e.event_id % 10 as kind, e.event_type, a.value as plain,
    case e.event_id % 10
      when 0 then concat(chr(9), chr(10), a.value) when 1 then concat('[', a.value, ']') when 2 then 'null'
      when 3 then concat('"', e.event_type, '"') when 4 then ''
      when 5 then concat('{"x":null,', substr(a.value, 2))
      when 6 then replace(a.value, '"page":{', '"page":{"ref":null,') else a.value end as value,
    a.value = '{bad' as bad, e.user_id
  from events e join app_log a on a.seq = e.event_id
),
objects as (
  select *, bad or kind in (1, 2, 3, 4) as dirty from kinds
)
"""

CDC_KINDS = """
with sent as (
  select o_orderkey as arrival, o_orderkey as seq, cast(o_custkey as varchar) as id, o_orderpriority,
    case when o_orderkey % 13 = 0 then 'dbserver' else 'dbserver.shop.orders' end as topic,
    concat('{"id":"', o_custkey, '","o_orderpriority":"', o_orderpriority, '"}') as r,
    case when o_orderkey % 10 = 8 then 'delete' when o_orderkey % 10 = 7 then 'update' else 'insert' end as type,
    o_orderkey % 11 = 0 as cut, o_orderkey % 11 = 1 as blank, o_orderkey % 13 = 0 as lost
  from orders
),
texts as (
  select *, case type when 'delete' then concat('{"before":', r, ',"after":null,"op":"d"}')
                      when 'update' then concat('{"before":', r, ',"after":', r, ',"op":"u"}')
                      else concat('{"before":null,"after":', r, ',"op":"c"}') end as env
  from sent
),
kinds as (
  select *, case when cut then concat('{oops ', seq) when blank then concat(chr(10), env) else env end as value,
    case when cut then 'malformed' when lost then 'bad_topic' end as reason
  from texts
)
"""

_N_AFTER = ("cast((id is not null) as integer) + cast((o_orderpriority is not null) as integer) "
            "+ cast((o_orderstatus is not null) as integer)")


ORACLES: dict[str, str] = {
    "dirty_split": _with("select arrival, seq, reason, value from parsed where reason is not null"),
    "json_fields": _with(
        "select seq, arrival, mid, is_new, start, page_id, last_page_id, ts from clean"),
    "first_visit_fix": _with(
        "select seq, mid, is_new_in, is_new, cast(repaired as integer) as repaired from fixed2"),
    "log_split_start": _with("select seq, arrival, mid, is_new, ts from starts"),
    "log_split_page": _with(
        "select seq, arrival, mid, is_new, page_id, last_page_id, ts from pages"),
    "log_split_display": _with("select seq, pos, page_id, item from displays"),
    "session_entries": _with("select seq, arrival, mid, page_id, ts from entries"),
    "day_bucket": _with(
        "select seq, ts, strftime(epoch_ms(ts), '%Y-%m-%d') as day from clean where ts is not null"),
    "unique_visit": _with("select seq, arrival, mid, page_id, ts, day from uv"),
    # The sequential rule itself, one entry of every mid a step.
    "unique_visit_expiring": _with("""
, numbered as (select *, row_number() over (partition by mid order by arrival, seq) as n,
    strftime(epoch_ms(ts), '%Y-%m-%d') as day from entries),
walk as (
  select mid, n, seq, true as kept, day as state_day, arrival as written from numbered where n = 1
  union all
  select e.mid, e.n, e.seq, e.day <> w.state_day or e.arrival - w.written >= 600,
    case when e.day <> w.state_day or e.arrival - w.written >= 600 then e.day else w.state_day end,
    case when e.day <> w.state_day or e.arrival - w.written >= 600 then e.arrival else w.written end
  from walk w join numbered e on e.mid = w.mid and e.n = w.n + 1
)
select e.seq, e.arrival, e.mid, e.page_id, e.ts, e.day from numbered e join walk w using (seq) where w.kept""", recursive=True),
    "log_detail": _with("""
select 'dirty' as route, seq, 0 as pos, null as mid, null as is_new, null as page_id,
       null as last_page_id, cast(null as bigint) as ts, null as item from parsed where reason is not null
union all
select 'start', seq, 0, mid, is_new, page_id, last_page_id, ts, null from starts
union all
select 'page', seq, 0, mid, is_new, page_id, last_page_id, ts, null from pages
union all
select 'display', seq, pos, null, null, page_id, null, null, item from displays"""),
    "uv_daily": _with("select seq, arrival, mid, is_new, page_id, ts, day from uv"),
    "raw_log_landing": _with(
        "select strftime(epoch_ms(received_ms), '%Y-%m-%d') as dt, seq, value from app_log"),
    "cdc_normalize": _cdc(f"""
select arrival, seq, 'shop' as database, table_name, type, id, o_orderpriority, o_orderstatus,
  0 as n_before, {_N_AFTER} as n_after from cdc"""),
    "cdc_initial_snapshot": _cdc("""
select -1 as arrival, o_orderkey as seq, 'read' as type, 'orders' as table_name,
  cast(o_custkey as varchar) as id, o_orderpriority, o_orderstatus from orders
union all
select arrival, seq, type, table_name, id, o_orderpriority, o_orderstatus from cdc"""),
    # The table's true state at the end of each window, then what follows; when rows were read plays no part.
    "cdc_snapshot_handover": _cdc("""
, placed as (select *, 500 + 70 * (cast(id as bigint) // 64) as high from cdc)
select high as arrival, cast(id as bigint) as seq, 'read' as type, 'orders' as table_name, id, r.p as o_orderpriority, r.s as o_orderstatus
from (select id, high, arg_max(struct_pack(t := type, p := o_orderpriority, s := o_orderstatus), arrival) as r
      from placed where arrival <= high group by id, high)
where r.t <> 'delete'
union all
select arrival, seq, type, table_name, id, o_orderpriority, o_orderstatus from placed where arrival > high"""),
    "sql_changelog_select": _cdc("""
select arrival, seq, type as op, id, o_orderpriority, o_orderstatus from cdc where id is not null"""),
    "sql_current_state": _cdc("""
select id, r.o_orderpriority as o_orderpriority, r.o_orderstatus as o_orderstatus from (
  select id, arg_max(struct_pack(op := type, o_orderpriority := o_orderpriority,
                                 o_orderstatus := o_orderstatus), arrival) as r
  from cdc where id is not null group by id) t
where r.op <> 'delete'"""),
    "rule_latest": _cdc("""
select source_table, operate_type, arg_max(sink_type, arrival) as sink_type,
  arg_max(sink_table, arrival) as sink_table, arg_max(sink_columns, arrival) as sink_columns,
  max(arrival) as rule_arrival
from rule_log group by source_table, operate_type"""),
    "rule_lookup": _cdc("""
select arrival, seq, type, sink_type, sink_table, sink_columns from looked where matched"""),
    "rule_miss": _cdc("select arrival, seq, table_name, type from looked where not matched"),
    "rule_column_filter": _cdc(f"""
select arrival, seq, sink_table, id, o_orderpriority, o_orderstatus, {_N_AFTER} as n_after
from trimmed where matched"""),
    "rule_route": _cdc("select arrival, seq, type, route from trimmed"),
    "rule_asof": _cdc("""
select c.arrival, c.seq, c.type, r.arrival as rule_arrival, r.sink_type, r.sink_table,
  case when r.arrival is null then 'no_rule' when r.sink_type = 'kafka' then 'kafka'
       when r.sink_type = 'hbase' then 'hbase' else 'unknown_sink' end as route
from cdc c asof left join rule_log r
  on c.table_name = r.source_table and c.type = r.operate_type and c.arrival >= r.arrival"""),
    "dwd_fact_route": _cdc(f"""
select arrival, seq, sink_table as topic, id, o_orderpriority, o_orderstatus, {_N_AFTER} as n_fields
from trimmed where route = 'kafka'"""),
    "dim_upsert": _cdc("""
, hb as (select * from trimmed where route = 'hbase' and id is not null),
cells as (
  select sink_table, id as row_key, 'o_orderpriority' as qualifier, o_orderpriority as value, arrival
  from hb where o_orderpriority is not null
  union all
  select sink_table, id, 'o_orderstatus', o_orderstatus, arrival from hb where o_orderstatus is not null
)
select sink_table, row_key, qualifier, arg_max(value, arrival) as value, max(arrival) as arrival
from cells group by sink_table, row_key, qualifier"""),
    "dim_table": _cdc("""
, hb as (select * from trimmed where route = 'hbase' and id is not null),
cells as (
  select id as row_key, 'o_orderpriority' as qualifier, o_orderpriority as value, arrival, seq
  from hb where o_orderpriority is not null
  union all
  select id, 'o_orderstatus', o_orderstatus, arrival, seq from hb where o_orderstatus is not null
)
select row_key,
  arg_max(value, arrival) filter (where qualifier = 'o_orderpriority') as o_orderpriority,
  arg_max(value, arrival) filter (where qualifier = 'o_orderstatus') as o_orderstatus
from cells group by row_key"""),
    "cdc_nonempty_after": _cdc(f"""
select arrival, seq, type, {_N_AFTER} as n_after from cdc where {_N_AFTER} > 0"""),
    "db_route": _cdc("""
select route, arrival, seq, type, sink_table, id, o_orderpriority, o_orderstatus from trimmed"""),
    "dirty_kinds": _with(LOG_KINDS + """
select seq as arrival, seq, 'malformed' as reason, value from objects where dirty"""),
    "published_json": _with(LOG_KINDS + """
, firsts as (
  select user_id, min(seq) as first from objects where not dirty and seq % 2 = 0 group by user_id
)
select case when event_type = 'signup' then 'start' else 'page' end as route, seq,
  case when event_type = 'signup' then 'common,start,ts' else 'common,displays,page,ts' end as fields,
  case when event_type <> 'signup' then
    case when contains(plain, '"last_page_id"') then 'last_page_id,page_id' else 'page_id' end end as page_fields,
  case when seq % 2 = 0 and seq = first then '1' else '0' end as is_new
from objects left join firsts using (user_id) where not dirty"""),
    # Records with nulls or a repaired flag are written anew with sorted keys, all others as received.
    "published_texts": _with(f"""
, sent as (
  select a.seq, a.value as plain, e.event_type, e.user_id, e.event_id % 10 as kind, {_K} as k, epoch_us(e.ts) // 1000 as ms,
    e.event_id % 2 = 0 and row_number() over (partition by e.user_id, e.event_id % 2 order by e.event_id) > 1 as repaired
  from events e join app_log a on a.seq = e.event_id where a.value <> '{{bad'
),
texts as (
  select seq, plain, repaired, event_type, kind in (5, 6) and (kind = 5 or event_type <> 'signup') as nulls, concat(
    '{{"common":{{"is_new":"', case when seq % 2 = 0 and not repaired then '1' else '0' end, '","mid":"', user_id, '"}},',
    case when event_type = 'signup' then '"start":{{"entry":"icon"}},' else concat(
      '"displays":[', array_to_string(list_transform(range(1, k % 4 + 1), lambda i: concat('{{"item":"', i, '"}}')), ','), '],',
      '"page":{{', case when k < 30 then '' when k < 40 then '"last_page_id":"",' else concat('"last_page_id":"p', k, '",') end,
      '"page_id":"', event_type, '"', case when kind = 6 then ',"ref":{{"b":[null,{{"d":{{}}}}]}}' else '' end, '}},') end,
    '"ts":', ms, '}}') as anew
  from sent
)
select case when event_type = 'signup' then 'start' else 'page' end as route, seq,
  case when nulls or repaired then anew else plain end as value from texts"""),
    "uv_rejects": _with("""
select arrival, seq, coalesce(reason, 'no_page') as reason, value from parsed
where reason is not null or json_extract(j, '$.page') is null"""),
    "first_visit_fix_large": _with(
        "select seq, mid, is_new_in, is_new, cast(repaired as integer) as repaired from fixed2"),
    "cdc_kinds": CDC_KINDS + """
select arrival, seq, 'orders' as table_name, type,
  case when type = 'insert' then 0 else 2 end as n_before, case when type = 'delete' then 0 else 2 end as n_after,
  case when type <> 'insert' then id end as id_before, case when type <> 'delete' then id end as id_after
from kinds where reason is null""",
    "cdc_typed_envelopes": """
select l_orderkey * 10 + l_linenumber as seq, 'lineitem' as table_name, case when l_linenumber = 7 then 'delete' else 'insert' end as type,
  case when l_suppkey % 10 = 0 then 'bad_value' end as reason,
  case when fine then cast(l_orderkey as varchar) end as l_orderkey, case when fine then cast(l_linenumber as varchar) end as l_linenumber,
  case when fine then cast(cast(l_extendedprice as decimal(18, 2)) as varchar) end as price,
  case when fine then cast(cast(case when l_returnflag = 'R' then -abs(l_discount) else abs(l_discount) end as decimal(18, 4)) as varchar) end as discount,
  case when fine then strftime(l_shipdate, '%Y-%m-%d') end as day,
  case when fine then strftime(l_shipdate + l_linenumber * interval 1 hour, '%Y-%m-%d %H:%M:%S') end as at,
  case when fine then concat('{"returnflag":"', l_returnflag, '"',
    case when l_partkey % 10 = 0 then '' else concat(',"tax":"', cast(cast(l_tax as decimal(18, 2)) as varchar), '"') end, '}') end as flags
from (select *, l_suppkey % 10 <> 0 as fine from lineitem)""",
    "cdc_filled_after": CDC_KINDS + "select arrival, seq, type from kinds where reason is null and type <> 'delete'",
    "cdc_rejects": CDC_KINDS + "select arrival, seq, reason, topic, value from kinds where reason is not null",
    "route_rejects": _cdc("""
select arrival, seq, route as reason, type, id from trimmed where route in ('no_rule', 'unknown_sink')"""),
    "rule_retired": _cdc("""
select source_table, operate_type, arg_max(sink_type, arrival) as sink_type, max(arrival) as rule_arrival
from rule_log group by source_table, operate_type having arg_max(arrival % 9, arrival) <> 0"""),
    **{name: _cdc("""
, found as (
  select c.arrival, c.seq, c.type, r.arrival % 9 <> 0 as live, r.sink_type, r.sink_table
  from cdc c asof left join rule_log r
    on c.table_name = r.source_table and c.type = r.operate_type and c.arrival >= r.arrival
)
select arrival, seq, type, case when live then sink_type end as sink_type, case when live then sink_table end as sink_table,
  case when live is null or not live then 'no_rule' when sink_type = 'kafka' then 'kafka'
       when sink_type = 'hbase' then 'hbase' else 'unknown_sink' end as route
from found""") for name in ("rule_asof_retired", "rule_asof_large")},
}
