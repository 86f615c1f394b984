"""SQL over the relational tables that gives the same rows as the registered queries.

The bus is written down as plain relations (messages, references, identifiers), without any JSON parsing.
"""

from __future__ import annotations

_LINE_OFFSET = """(date_diff('day', date '1970-01-01', l_shipdate::date)::bigint * 140737488355328
  + (('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 12))::bigint >> 1))"""


def _place(topic: str, id_: str, offset: str | None = None) -> str:
    offset = offset or f"({id_} // 4)::bigint"
    return f"""'{topic}' as topic, ({id_} % 4)::int as "partition", {offset} as "offset" """


# One row per message: place, key, time, value as sorted compact JSON, payload length, headers, evidence.
_MESSAGES = f"""
m_orders as (
  select {_place('orders', 'o_orderkey')}, 'ORD-' || o_orderkey as "key", epoch_us(o_orderdate) as ts_us,
    '{{"customer_id":"CUST-' || o_custkey || '","open":' || (o_orderstatus = 'O')::varchar
      || ',"order_id":"ORD-' || o_orderkey || '","status":"' || o_orderstatus || '"}}' as value_json,
    length(value_json) as raw_bytes,
    '{{"trace_id":"TR-' || o_orderkey || '","source":"' || (case when o_orderkey % 2 = 0 then 'web' else 'mobile' end)
      || '"}}' as headers_json,
    'ORD-' || o_orderkey as order_id, null::varchar as msisdn, 'CUST-' || o_custkey as customer_id,
    null::varchar as product_id, 'ok' as decode_status, null::varchar as decode_error, false as timestamp_fallback,
    null::bigint as value_id, null::bigint as key_id
  from orders),
m_shipments as (
  select {_place('shipments', 'l_orderkey', _LINE_OFFSET)}, 'SHP-' || l_orderkey || '-' || l_linenumber as "key",
    epoch_us(l_shipdate) as ts_us,
    '{{"orderId":"ORD-' || l_orderkey || '","productId":"PROD-' || l_partkey || '","shipment":{{"line":' || l_linenumber
      || ',"supplier":"SUP-' || l_suppkey || '"}}}}' as value_json,
    length(value_json), '{{"trace-id":"TR-' || l_orderkey || '"}}', 'ORD-' || l_orderkey, null, null,
    'PROD-' || l_partkey, 'ok', null, false, null, null
  from lineitem where l_returnflag <> 'R'),
m_returns as (
  select {_place('returns', 'l_orderkey', _LINE_OFFSET)}, 'RET-' || l_orderkey || '-' || l_linenumber,
    epoch_us(l_shipdate) as ts_us,
    '{{"items":[{{"id":"PROD-' || l_partkey || '"}}],"source_id":"ORD-' || l_orderkey || '"}}' as value_json,
    length(value_json), '{{}}', null, null, null, null, 'ok', null, false, null, null
  from lineitem where l_returnflag = 'R'),
m_activity as (
  select {_place('activity', 'event_id')}, 'USR-' || user_id, epoch_us(ts),
    '{{"customerId":"CUST-' || (user_id * 10 + event_id % 10) || '","props":' || replace(props, ' ', '') || ',"type":"'
      || event_type || '"}}' as value_json,
    length(value_json) + length(props) - length(replace(props, ' ', '')), '{{"sessionId":"SES-' || user_id % 50 || '"}}',
    null, null, 'CUST-' || (user_id * 10 + event_id % 10), null, 'ok', null, false, null, null
  from events),
m_dirty as (
  select {_place('dirty', 'n_nationkey')}, case when n_nationkey % 3 <> 0 then n_name end,
    epoch_us(timestamp '2024-01-01' + to_minutes(n_nationkey)),
    case when n_nationkey % 5 = 4 then '{{"msisdn":' || n_nationkey || ',"order-id":null}}' end as value_json,
    case n_nationkey % 5 when 0 then 0 when 1 then 5 when 2 then 7 when 3 then 6 else length(value_json) end,
    '{{"phone":"' || n_nationkey || '"}}', null, n_nationkey::varchar, null, null,
    case n_nationkey % 5 when 0 then 'empty' when 1 then 'non_object' when 4 then 'ok' else 'error' end,
    case n_nationkey % 5 when 2 then 'json decode failed' when 3 then 'schema 42 not found' end,
    n_nationkey % 2 = 1, case when n_nationkey % 5 = 3 then 42 end, null
  from nation),
m_audit as (
  select {_place('__audit', 'r_regionkey')}, r_name, epoch_us(timestamp '2024-01-01'),
    '{{"region":"' || r_name || '"}}' as value_json, length(value_json), '{{}}', null, null, null, null, 'ok', null, false,
    null, null
  from region),
m_accounts as (
  select {_place('accounts', 'c_custkey')}, null, epoch_us(timestamp '2024-02-01'),
    '{{"customer_id":"CUST-' || c_custkey || '","name":"' || c_name || '","nation":' || c_nationkey || ',"segment":"'
      || c_mktsegment || '"}}',
    null, '{{}}', null, null, 'CUST-' || c_custkey as customer_id, null, 'ok', null, false, 1, 2
  from customer),
m_catalog as (
  select {_place('catalog', 'p_partkey')}, 'PROD-' || p_partkey, epoch_us(timestamp '2024-02-01'),
    '{{"brand":"' || p_brand || '","product_id":"PROD-' || p_partkey || '","size":' || p_size || '}}',
    null, '{{}}', null, null, null, 'PROD-' || p_partkey, 'ok', null, false, 3, null
  from part),
plain as (
  select * from m_orders union all select * from m_shipments union all select * from m_returns
  union all select * from m_activity union all select * from m_dirty union all select * from m_audit),
bus as (select * from plain union all select * from m_accounts union all select * from m_catalog),
marks as (
  select topic, "partition", min("offset") as earliest, max("offset") + 1 as latest from plain group by all),
lag as (
  with committed as (
    select 'billing' as "group", topic, "partition",
      case when "partition" = 3 or (topic = 'returns' and "partition" = 2) then 0
        else latest // 8 * ("partition" + 1) end as current_offset
    from marks where topic <> '__audit'
    union all
    select 'audit', topic, "partition", latest + 10 from marks where topic = 'orders')
  select "group", topic, "partition", current_offset, latest as end_offset, latest - current_offset as lag
  from committed join marks using (topic, "partition"))"""

# Ways to find a message. Rank 0 key, 1-27 header fields, 28-54 value fields, 55 source fields.
_REFERENCES = f"""
refs as (
  select topic, "partition", "offset", 0 as kind_rank, 0 as field_rank, 'key' as field, "key" as ref_id
  from plain where "key" is not null
  union all select {_place('orders', 'o_orderkey')}, 1, 0, 'header:trace_id', 'TR-' || o_orderkey from orders
  union all select {_place('orders', 'o_orderkey')}, 46, 0, 'value:order_id', 'ORD-' || o_orderkey from orders
  union all select {_place('orders', 'o_orderkey')}, 49, 0, 'value:customer_id', 'CUST-' || o_custkey from orders
  union all select {_place('shipments', 'l_orderkey', _LINE_OFFSET)}, 3, 0, 'header:trace-id', 'TR-' || l_orderkey
    from lineitem where l_returnflag <> 'R'
  union all select {_place('shipments', 'l_orderkey', _LINE_OFFSET)}, 47, 0, 'value:orderId', 'ORD-' || l_orderkey
    from lineitem where l_returnflag <> 'R'
  union all select {_place('returns', 'l_orderkey', _LINE_OFFSET)}, 55, 4, 'value:source_id', 'ORD-' || l_orderkey
    from lineitem where l_returnflag = 'R'
  union all select {_place('activity', 'event_id')}, 26, 0, 'header:sessionId', 'SES-' || user_id % 50 from events
  union all select {_place('activity', 'event_id')}, 50, 0, 'value:customerId',
    'CUST-' || (user_id * 10 + event_id % 10) from events
  union all select {_place('dirty', 'n_nationkey')}, 48, 0, 'value:order-id', 'None' from nation where n_nationkey % 5 = 4)"""

_IDS = f"""
ids as (
  select topic, "partition", "offset", unnest([order_id, msisdn, customer_id, product_id]) as id, 'standard' as method
  from bus
  union all select {_place('orders', 'o_orderkey')}, 'TR-' || o_orderkey, 'standard' from orders
  union all select {_place('shipments', 'l_orderkey', _LINE_OFFSET)}, 'TR-' || l_orderkey, 'standard'
    from lineitem where l_returnflag <> 'R'
  union all select {_place('activity', 'event_id')}, 'SES-' || user_id % 50, 'standard' from events)"""

_FLAT = 'topic, "partition", "offset", "key", ts_us, value_json, order_id, msisdn, customer_id, product_id'
_FLAT_NO_KEY = _FLAT.replace(' "key",', "")
_COORDS = 'topic, "partition", "offset"'


def _with(body: str, *more: str) -> str:
    return "with " + ",".join([_MESSAGES, *more]) + "\n" + body


def _flat(source: str, where: str = "true", columns: str = _FLAT) -> str:
    return _with(f"select {columns} from {source} where {where}")


def _iso(micros: str) -> str:
    at = f"make_timestamp({micros})"
    return (
        f"(strftime({at}, '%Y-%m-%dT%H:%M:%S') || case when {micros} % 1000000 = 0 then '+00:00'"
        f" else strftime({at}, '.%f') || '+00:00' end)"
    )


def _correlate(
    seeds: str,
    follow: list[str],
    select: str = "",
    *,
    depth: int = 1,
    breadth: int | None = None,
    backward: bool = False,
    limit: int | None = None,
    more_ids: str = "select topic, \"partition\", \"offset\", id, method, 1 as method_rank from ids where false",
    refs: str = "refs",
) -> str:
    """Seeds (a condition on messages) and what their identifiers lead to, one set of relations per hop."""
    topics = ", ".join(f"'{t}'" for t in follow)
    position = "case topic " + " ".join(f"when '{t}' then {i}" for i, t in enumerate(follow)) + " end"
    order = 'ref_id, kind_rank, topic_pos, field_rank, "partition", "offset"'
    parts = [
        _REFERENCES,
        _IDS,
        f"\nall_ids as (select {_COORDS}, id, method, 0 as method_rank from ids where id is not null union all ({more_ids}))",
        f"\nhits0 as (select {_COORDS}, '' as chain, null::varchar as ref_id, 0 as kind_rank, 0 as topic_pos, 0 as field_rank,"
        f" null::varchar as field, null::varchar as method from bus where {seeds})",
    ]
    cut = f"order by ref_id limit {breadth}" if breadth else ""
    for level in range(1, depth + 1):
        earlier_ids = " union all ".join(f"select ref_id from f{i}" for i in range(1, level)) or "select null where false"
        earlier_hits = " union all ".join(f"select {_COORDS} from hits{i}" for i in range(level))
        parts.append(
            f"""
f{level} as (
  select id as ref_id, m as method, chain from (
    select id, a.method as m, chain, row_number() over (partition by id order by {order}, method_rank, a.method) as first
    from hits{level - 1} join all_ids a using ({_COORDS}))
  where first = 1 and id not in (select ref_id from ({earlier_ids}) where ref_id is not null) {cut}),
hits{level} as (
  select {_COORDS}, chain || case when chain = '' then '' else '->' end || ref_id as chain, ref_id, kind_rank, topic_pos,
    field_rank, field, method
  from (
    select {_COORDS}, {position} as topic_pos, ref_id, kind_rank, field_rank, field, method, chain,
      row_number() over (partition by {_COORDS} order by ref_id, kind_rank, field_rank) as first
    from {refs} join f{level} using (ref_id)
    where topic in ({topics}) and kind_rank <= {55 if backward else 54}) h
  where first = 1 and not exists (select 1 from ({earlier_hits}) e
    where e.topic = h.topic and e."partition" = h."partition" and e."offset" = h."offset"))"""
        )
    every = " union all ".join(f"select *, {i} as correlation_level from hits{i}" for i in range(depth + 1))
    kept = f"order by correlation_level, {order} limit {limit}" if limit else ""
    parts.append(
        f"""
found as (
  select k.*, case when correlation_level = 0 then null when kind_rank = 55 then 'backward' else 'forward' end as direction,
    case when kind_rank = 55 and correlation_level > 0 then 'backward_reference' else k.method end as extraction
  from (select * from ({every}) {kept}) k)"""
    )
    select = select or (
        f"select {_COORDS}, chain, correlation_level, direction, field, extraction as method, ts_us"
        f" from found join bus using ({_COORDS})"
    )
    return _with(select, *parts)


_SUP3 = "topic = 'shipments' and value_json like '%\"SUP-3\"%'"
_FOLLOW = ["shipments", "returns", "activity"]
_ORDERS = "topic = 'orders'"
_ORDER7 = "topic = 'orders' and \"key\" = 'ORD-7'"


def _report(chain: str = "") -> str:
    return (
        f"""{_iso('ts_us')} as "Timestamp", topic as "Topic", "partition" as "Partition", "offset" as "Offset","""
        f""" coalesce("key", '') as "Key", {chain} coalesce(value_json, '') as "Value" """
    )


def _returns_ids(method: str) -> str:
    place = _place("returns", "l_orderkey", _LINE_OFFSET)
    return f"select {place}, 'ORD-' || l_orderkey, '{method}', 1 from lineitem where l_returnflag = 'R'"


def _traced_row(chain: str, level: int, direction: str, field: str, method: str, at: str) -> str:
    def text(x: str) -> str:
        return f"'{x}'" if x else "null::varchar"

    return (
        f"{chain} as chain, {level} as correlation_level, {text(direction)} as direction, {text(field)} as field,"
        f" {text(method)} as method, epoch_us({at}) as ts_us"
    )


def _linked_sql() -> dict[str, str]:
    """Correlations as plain joins of the base tables."""
    order, event = _place("orders", "o_orderkey"), _place("activity", "event_id")
    shipment, back = _place("shipments", "l_orderkey", _LINE_OFFSET), _place("returns", "l_orderkey", _LINE_OFFSET)
    seeds = f"select {order}, {_traced_row(chr(39) * 2, 0, '', '', '', 'o_orderdate')} from orders"
    customer = "user_id * 10 + event_id % 10"
    by_order = "'ORD-' || l_orderkey"
    forward = ("forward", "value:orderId", "standard", "l_shipdate")
    backward = ("backward", "value:source_id", "backward_reference", "l_shipdate")
    did = ("forward", "value:customerId", "standard", "ts")
    shipped = f"select {shipment}, {_traced_row(by_order, 1, *forward)} from lineitem join orders on o_orderkey = l_orderkey where l_returnflag <> 'R'"
    returned = f"select {back}, {_traced_row(by_order, 1, *backward)} from lineitem join orders on o_orderkey = l_orderkey where l_returnflag = 'R'"
    by_customer = f"'CUST-' || ({customer})"
    activity = f"select {event}, {_traced_row(by_customer, 1, *did)} from events where {customer} in (select o_custkey from orders)"
    of_7 = f"select {event}, {_traced_row(by_customer, 1, *did)} from events where {customer} = (select o_custkey from orders where o_orderkey = 7)"
    return {
        "indexed_shipments": f"{seeds} union all {shipped}",
        "indexed_returns": f"{seeds} union all {returned}",
        "indexed_customers": f"{seeds} union all {activity}",
        "indexed_products": f"""
{seeds} union all {shipped}
union all select {_place('catalog', 'p_partkey')},
  {_traced_row("least_order || '->PROD-' || p_partkey", 2, "forward", "key", "standard", "timestamp '2024-02-01'")}
from part join (
  select l_partkey, min('ORD-' || l_orderkey) as least_order from lineitem join orders on o_orderkey = l_orderkey
  where l_returnflag <> 'R' group by l_partkey) on l_partkey = p_partkey""",
        "indexed_limit": f"""
{seeds} where o_orderkey = 7
union all (
  select * from ({of_7} union all {shipped} and l_orderkey = 7) order by chain, "partition", "offset" limit 19)""",
        "indexed_breadth": f"""
with i as (
  select 'CUST-' || o_custkey as id from orders union select 'ORD-' || o_orderkey from orders
  union select 'TR-' || o_orderkey from orders),
kept as (select id from i order by id limit 100)
select {order}, '' as chain, 0 as correlation_level, (select count(*) from i) - (select count(*) from kept) as ids_left_out from orders
union all select {event}, id, 1, 0 from events join kept on id = 'CUST-' || ({customer})""",
        "indexed_sources": f"""
select {back}, {_traced_row("''", 0, '', '', '', 'l_shipdate')} from lineitem where l_returnflag = 'R'
union all select {order}, {_traced_row("'ORD-' || o_orderkey", 1, 'forward', 'key', 'jsonpath:$.source_id', 'o_orderdate')}
from orders where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R')""",
        "indexed_investigation": f"""
{seeds} where o_orderkey = 7 union all {of_7}
union all {shipped} and l_orderkey = 7 union all {returned} and l_orderkey = 7""",
        "indexed_details": f"""
select {order}, '[]' as chain, '[]' as details from orders
union all select {shipment}, '["ORD-' || l_orderkey || '"]', '[{{"id":"ORD-' || l_orderkey || '","direction":"forward",'
  || '"field":"value:orderId","extraction_method":"standard","timestamp":"' || {_iso('epoch_us(l_shipdate)')} || '"}}]'
from lineitem join orders on o_orderkey = l_orderkey where l_returnflag <> 'R'""",
        "indexed_exclude_seen": f"""
{seeds} where o_orderstatus = 'O'
union all select {order}, {_traced_row("'CUST-' || o_custkey", 1, 'forward', 'value:customer_id', 'standard', 'o_orderdate')}
from orders where o_orderstatus <> 'O' and o_custkey in (select o_custkey from orders where o_orderstatus = 'O')""",
        "indexed_summary": """
select 'ORD-' || l_orderkey as id, count(*) as messages,
  case when max(l_returnflag = 'R') and not min(l_returnflag = 'R') then 'returns,shipments'
    when max(l_returnflag = 'R') then 'returns' else 'shipments' end as topics,
  min(epoch_us(l_shipdate)) as first_us, max(epoch_us(l_shipdate)) as last_us
from lineitem join orders on o_orderkey = l_orderkey group by l_orderkey""",
    }


def oracle_sql() -> dict[str, str]:
    line_place = _place("shipments", "l_orderkey", _LINE_OFFSET)
    return_place = _place("returns", "l_orderkey", _LINE_OFFSET)
    event_place = _place("activity", "event_id")
    shipped, returned = "from lineitem where l_returnflag <> 'R'", "from lineitem where l_returnflag = 'R'"
    return {
        "list_topics": _with("select distinct topic from bus where topic not like '\\_\\_%' escape '\\'"),
        "list_topics_internal": _with("select distinct topic from bus"),
        "partition_ids": _with("select distinct \"partition\" from plain where topic = 'shipments'"),
        "watermark_offsets": _with(
            'select topic, "partition", 0 as leader, min("offset") as earliest, max("offset") + 1 as latest'
            ' from bus group by topic, "partition"'
        ),
        "describe_topic": _with(
            'select topic as "Topic", "partition" as "Partition", 0 as "Leader", earliest as "Earliest", latest as "Latest"'
            " from marks where topic = 'shipments'"
        ),
        "describe_topics": _with(
            "select topic as name, count(*)::int as partition_count,"
            """ string_agg("partition" || ':' || low || ':' || high, ',' order by "partition") as partitions"""
            ' from (select topic, "partition", min("offset") as low, max("offset") + 1 as high from bus group by all)'
            " group by topic"
        ),
        "offsets_for_times": _with(
            'select topic, "partition", min("offset") filter (ts_us >= epoch_us(timestamp \'1997-01-01\')) as found,'
            ' coalesce(found, min("offset")) as start_offset from bus group by topic, "partition"'
        ),
        "consumer_lag": _with("select *, 'kafka' as source, 'consumer_lag' as event_type from lag"),
        "consumer_lag_topics": _with(
            'select "group" as "Group", topic as "Topic", "partition" as "Partition", current_offset as "Current",'
            ' end_offset as "End", lag as "Lag" from lag'
            " where \"group\" = 'billing' and topic in ('orders', 'activity')"
        ),
        "lag_summary": _with(
            'select "group", topic, count(*) as partitions, sum(lag)::bigint as total_lag, max(lag) as max_lag'
            ' from lag group by "group", topic'
        ),
        "normalized": _with(
            f'select {_COORDS}, "key", headers_json, ts_us, timestamp_fallback, raw_bytes::int as raw_bytes from plain'
        ),
        "decode_status": _with(f"select {_COORDS}, decode_status, decode_error from bus"),
        "decode_without_registry": _with(
            f"select {_COORDS}, case when value_id is null then decode_status else 'error' end as decode_status,"
            " case when value_id is null then decode_error else 'Schema Registry not configured' end as decode_error from bus"
        ),
        "schema_ids": _with(f"select {_COORDS}, value_id, key_id from bus"),
        "decode_avro": _with(
            f"select {_FLAT_NO_KEY}, '{{\"customer_id\":\"' || customer_id || '\",\"nation\":' || c_nationkey || '}}' as key_json"
            " from bus join customer on customer_id = 'CUST-' || c_custkey where topic = 'accounts'"
        ),
        "decode_protobuf": _flat("bus", "topic = 'catalog'"),
        "evidence": _flat("plain"),
        "evidence_framed": _with(
            f"select {_COORDS}, order_id, msisdn, customer_id, product_id, 'kafka' as source,"
            " 'kafka_message' as event_type from bus"
        ),
        "search_key": _flat("plain", "\"key\" = 'USR-7'"),
        "search_header": _flat("plain", "topic = 'shipments' and order_id = 'ORD-7'"),
        "search_value_path": _flat("plain", "topic = 'shipments' and order_id = 'ORD-7'"),
        "search_nested_path": _flat("plain", _SUP3),
        "search_boolean": _flat("plain", "topic = 'orders' and value_json like '%\"open\":true%'"),
        "search_number": _flat("plain", "topic = 'activity' and value_json like '%{\"k\":26}%'"),
        "search_framed": _flat("bus", "topic = 'accounts' and value_json like '%\"segment\":\"BUILDING\"%'", _FLAT_NO_KEY),
        "search_window": _flat(
            "plain",
            _SUP3 + " and ts_us >= epoch_us(timestamp '1996-01-01') and ts_us < epoch_us(timestamp '1997-01-01')",
        ),
        "search_seek": _with(
            f"select {_FLAT} from m_orders join (select \"partition\", coalesce(min(\"offset\") filter"
            " (ts_us >= epoch_us(timestamp '2001-06-01')), min(\"offset\")) as start from m_orders group by all)"
            ' using ("partition") where "offset" >= start and headers_json like \'%"web"%\''
        ),
        "stream_search": _flat("plain", "headers_json like '%\"source\":\"web\"%'"),
        "search_headers_and": _flat(
            "plain", "topic = 'orders' and value_json like '%\"status\":\"O\"%' and headers_json like '%\"web\"%'"
        ),
        "search_limit": _with(
            f'select {_FLAT} from plain where {_SUP3} order by "partition", "offset" limit 50'
        ),
        "search_offsets": _flat("plain", "\"offset\" >= 100 and \"offset\" < 2000 and headers_json like '%\"source\":\"web\"%'"),
        "search_order": _with(
            f"select {_FLAT}, (row_number() over (order by ts_us, \"partition\", \"offset\"))::bigint as place from"
            f' (select * from plain where topic = \'shipments\' and {_SUP3} order by "partition", "offset" limit 40)'
        ),
        "search_no_topics": _flat("plain", "false"),
        "search_unknown_field": _flat("plain", "false"),
        "archive_search_key": _flat("plain", "\"key\" = 'USR-7'"),
        "archive_search_offsets": _flat("plain", "topic = 'orders' and \"offset\" >= 100 and \"offset\" < 200 and headers_json like '%\"web\"%'"),
        "archive_watermarks": _with('select topic, "partition", 0 as leader, earliest, latest from marks'),
        "archive_describe_topics": _with(
            "select topic as name, count(*)::int as partition_count,"
            """ string_agg("partition" || ':' || earliest || ':' || latest, ',' order by "partition") as partitions"""
            " from marks group by topic"
        ),
        "archive_offsets_for_times": _with(
            'select topic, "partition", min("offset") filter (ts_us >= epoch_us(timestamp \'1997-01-01\')) as found,'
            ' coalesce(found, min("offset")) as start_offset from plain group by topic, "partition"'
        ),
        "archive_search_seek": _with(
            f"select {_FLAT} from m_orders join (select \"partition\", coalesce(min(\"offset\") filter"
            " (ts_us >= epoch_us(timestamp '2001-06-01')), min(\"offset\")) as start from m_orders group by all)"
            ' using ("partition") where "offset" >= start and headers_json like \'%"web"%\''
        ),
        "archive_get_messages": _with(
            f"""select o.topic, o."partition", o."offset", "key", customer_id, 'found' as lookup_status
from plain o where topic = 'orders' and "offset" % 10 = 0"""
        ),
        "archive_get_messages_all": _with(
            f"""select c.topic, c."partition", c."offset", m."key", m.customer_id,
  case when m.topic is not null then 'found' when k.topic is null then 'unknown_partition'
    when c."offset" < earliest or c."offset" >= latest then 'out_of_range' else 'missing' end as lookup_status
from (select {_COORDS} from plain union select topic, "partition", "offset" + 1 from plain
  union select topic, "partition" + 4, earliest from marks) c
left join plain m using ({_COORDS}) left join marks k on k.topic = c.topic and k."partition" = c."partition" """
        ),
        "coordinates_held_twice": _with(
            f"select topic, count(*) as twice from (select {_COORDS} from bus group by all having count(*) > 1) group by topic"
        ),
        "export_lag": _with(
            """select '{"group":"' || "group" || '","topic":"' || topic || '","partition":' || "partition" as head
from lag"""
        ),
        "watermarks_with_metadata": _with(
            """select topic, "partition", ("partition" + 1)::int as leader,
  case when "partition" = 0 then earliest + 1 else earliest end as earliest,
  case when "partition" = 1 then latest + 5 else latest end as latest
from marks union all select 'empty', 0, 7, 0, 0"""
        ),
        "search_many": _with(f"select {_FLAT}, order_id as search_key from plain where topic = 'shipments'"),
        "search_many_keys": _with(
            f"select {_FLAT}, \"key\" as search_key from plain join customer on \"key\" = 'USR-' || c_custkey"
        ),
        "search_many_top": _with(
            f"select {_FLAT}, search_key from (select m.*, 'SUP-' || s_suppkey as search_key, row_number() over"
            ' (partition by s_suppkey order by "partition", "offset") as n from plain m'
            " join supplier on regexp_extract(value_json, 'SUP-([0-9]+)', 1) = s_suppkey::varchar"
            " where m.topic = 'shipments') where n <= 3"
        ),
        "scan_partition": _flat("plain", "topic = 'activity' and \"key\" = 'USR-7'"),
        "search_report": _with(f"select {_report()} from plain where topic = 'activity' and \"key\" = 'USR-7'"),
        "get_message": _flat("plain", "\"key\" = 'ORD-7'"),
        "get_messages": _with(
            f"""select c.topic, c."partition", c."offset", m."key", m.customer_id,
  case when m.topic is not null then 'found' when k.topic is null then 'unknown_partition'
    when c."offset" < earliest or c."offset" >= latest then 'out_of_range' else 'missing' end as lookup_status
from (select 'orders' as topic, (c_custkey % 5)::int as "partition", c_custkey * 5 as "offset" from customer
  union all select 'shipments', (c_custkey % 4)::int, 10000 * 140737488355328 + c_custkey from customer) c
left join plain m using ({_COORDS}) left join marks k on k.topic = c.topic and k."partition" = c."partition" """
        ),
        "export_json": _with(
            f"""select '{{"topic":"orders","partition":' || "partition" || ',"offset":' || "offset" || ',"key":"' || "key"
  || '","headers":' || headers_json || ',"value":' || value_json || ',"timestamp_utc":"' || {_iso('ts_us')}
  || '","raw":"' || base64(encode('{{"order_id":"' || order_id || '","customer_id":"' || customer_id || '","status":"'
  || o_orderstatus || '","open":' || (o_orderstatus = 'O')::varchar || '}}')) || '","raw_key":"' || base64(encode("key"))
  || '","key_decoded":null,"schema_id":null,"source":"kafka","event_type":"kafka_message","keys":{{"order_id":"' || order_id
  || '","msisdn":null,"customer_id":"' || customer_id
  || '","product_id":null}},"correlation_chain":[],"correlation_details":[]}}' as json
from m_orders join orders on "key" = 'ORD-' || o_orderkey"""
        ),
        "export_json_all": _with(f"select {_FLAT_NO_KEY.replace(' ts_us,', '')} from bus"),
        "export_lag_all": _with(
            """select '{"group":"' || "group" || '","topic":"' || topic || '","partition":' || "partition" || ',"current_offset":'
  || current_offset || ',"end_offset":' || end_offset || ',"lag":' || lag
  || ',"timestamp_utc":"","source":"kafka","event_type":"consumer_lag"}' as line from lag"""
        ),
        "import_json": _flat("plain", columns=_FLAT + ", raw_bytes::int as raw_bytes"),
        "ids_standard": _with(
            f"select distinct {_COORDS}, id, method from ids join plain using ({_COORDS}) where id is not null", _IDS
        ),
        "ids_regex": f"""
select {line_place}, l_suppkey::varchar as id, 'regex:SUP-(\\d+)' as method {shipped}
union all select {line_place}, '"PROD-' || l_partkey || '"', 'regex:"PROD-[0-9]+"' {shipped}
union all select {return_place}, '"PROD-' || l_partkey || '"', 'regex:"PROD-[0-9]+"' {returned}
union all select {event_place}, 'CUST', 'regex:(CUST)-(\\d+)' from events
union all select {event_place}, (user_id * 10 + event_id % 10)::varchar, 'regex:(CUST)-(\\d+)' from events""",
        "ids_regex_all": f"""
select {line_place}, l_suppkey::varchar as id, 'regex:SUP-(\\d+)' as method {shipped}
union all select {line_place}, '"PROD-' || l_partkey || '"', 'regex:"PROD-[0-9]+"' {shipped}
union all select {return_place}, '"PROD-' || l_partkey || '"', 'regex:"PROD-[0-9]+"' {returned}
union all select {_place('catalog', 'p_partkey')}, '"PROD-' || p_partkey || '"', 'regex:"PROD-[0-9]+"' from part
union all select topic, "partition", "offset", unnest(['CUST', n::varchar]), 'regex:(CUST)-(\\d+)' from (
  select {event_place}, user_id * 10 + event_id % 10 as n from events
  union all select {_place('orders', 'o_orderkey')}, o_custkey from orders
  union all select {_place('accounts', 'c_custkey')}, c_custkey from customer)""",
        "ids_jsonpath_all": f"""
select {return_place}, 'PROD-' || l_partkey as id, unnest(['jsonpath:$.items[*].id', 'jsonpath:$..id', 'jsonpath:$..items..id']) as method
{returned}
union all select {line_place}, l_linenumber::varchar, 'jsonpath:$[''shipment''].*' {shipped}
union all select {line_place}, 'SUP-' || l_suppkey, unnest(['jsonpath:$[''shipment''].*', 'jsonpath:$..supplier']) {shipped}
union all select {event_place}, regexp_extract(props, '[0-9]+'), 'jsonpath:$.props..k' from events
union all select {_place('orders', 'o_orderkey')}, 'CUST-' || o_custkey, 'jsonpath:$..customer_id' from orders
union all select {_place('accounts', 'c_custkey')}, 'CUST-' || c_custkey, 'jsonpath:$..customer_id' from customer""",
        "ids_jsonpath": f"""
select {return_place}, 'PROD-' || l_partkey as id, 'jsonpath:$.items[*].id' as method {returned}
union all select {return_place}, 'PROD-' || l_partkey, 'jsonpath:items[0].id' {returned}
union all select {event_place}, regexp_extract(props, '[0-9]+'), 'jsonpath:$.props.k' from events
union all select {line_place}, l_linenumber::varchar, 'jsonpath:$[''shipment''].*' {shipped}
union all select {line_place}, 'SUP-' || l_suppkey, 'jsonpath:$[''shipment''].*' {shipped}
union all select {line_place}, 'SUP-' || l_suppkey, 'jsonpath:$..supplier' {shipped}
union all select {line_place}, 'TR-' || l_orderkey, 'jsonpath:$.headers[''trace-id'']' {shipped}""",
        "reference_rows": _with(f"select {_COORDS}, kind_rank, field_rank, field, ref_id from refs", _REFERENCES),
        "indexed_references": _with(f"select {_COORDS}, kind_rank, field_rank, field, ref_id from refs", _REFERENCES),
        **_linked_sql(),
        "correlate_forward": _correlate(_ORDERS, _FOLLOW),
        "correlate_backward": _correlate(_ORDERS, _FOLLOW, backward=True),
        "correlate_breadth": _correlate(_ORDERS, _FOLLOW, breadth=100),
        "correlate_jsonpath": _correlate(
            "topic = 'returns'", ["orders", "shipments"], more_ids=_returns_ids("jsonpath:$.source_id")
        ),
        "correlate_regex": _correlate(
            "topic = 'returns'", ["orders"], more_ids=_returns_ids('regex:"source_id":"([^"]+)"')
        ),
        "correlate_depth2": _correlate("topic = 'shipments'", ["orders", "activity"], depth=2),
        "correlate_depth3": _correlate(_ORDER7, ["orders", "shipments", "activity"], depth=3),
        "correlate_limit": _correlate(_ORDER7, ["activity", "shipments"], limit=5),
        "correlate_framed": _correlate(
            _ORDERS,
            ["accounts"],
            refs=f"(select {_COORDS}, 49 as kind_rank, 0 as field_rank, 'value:customer_id' as field, customer_id as ref_id"
            " from m_accounts)",
        ),
        "correlate_summary": _correlate(
            _ORDERS,
            _FOLLOW,
            "select ref_id as id, count(*) as messages, string_agg(distinct topic, ',' order by topic) as topics,"
            f" min(ts_us) as first_us, max(ts_us) as last_us from found join bus using ({_COORDS})"
            " where correlation_level > 0 group by ref_id",
            backward=True,
        ),
        "investigate": _correlate(
            _ORDER7,
            _FOLLOW,
            f"""select {_report('chain as "Chain",')} from found join bus using ({_COORDS})""",
            backward=True,
        ),
    }
