"""A message bus derived, row by row, from the relational test tables.

Every column is an expression over one table row: no shuffle, no window; the derivation costs one scan at any size.
Offsets of ``orders``, ``activity``, ``accounts`` and ``catalog`` are the dense id within its partition; line items have
no unique id, so their offset is the ship day followed by 47 bits of a hash of the line, which keeps the log in time order
and leaves room to sum the lag of its partitions. The query ``coordinates_held_twice`` counts the lines that share one.
"""

from __future__ import annotations

from functools import cache, reduce

from google.protobuf import descriptor_pb2
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from bustrace.model import COMMITTED_SCHEMA, HEADERS_TYPE, SCHEMAS_SCHEMA
from bustrace.operators.offsets import watermarks
from bustrace.session import configure

PARTITIONS = 4

ACCOUNT_AVRO = (
    '{"type":"record","name":"Account","fields":[{"name":"customer_id","type":"string"},{"name":"name","type":"string"},'
    '{"name":"segment","type":"string"},{"name":"nation","type":"int"}]}'
)
ACCOUNT_KEY_AVRO = (
    '{"type":"record","name":"AccountKey","fields":[{"name":"customer_id","type":"string"},{"name":"nation","type":"int"}]}'
)


def product_descriptors() -> bytes:
    """Compiled form of: message Product { string product_id = 1; string brand = 2; int32 size = 3; }"""
    file = descriptor_pb2.FileDescriptorProto(name="product.proto", syntax="proto3")
    message = file.message_type.add(name="Product")
    field = descriptor_pb2.FieldDescriptorProto
    for number, (name, kind) in enumerate(
        [("product_id", field.TYPE_STRING), ("brand", field.TYPE_STRING), ("size", field.TYPE_INT32)], 1
    ):
        message.field.add(name=name, number=number, type=kind, label=field.LABEL_OPTIONAL)
    return descriptor_pb2.FileDescriptorSet(file=[file]).SerializeToString()


def schemas(spark: SparkSession) -> DataFrame:
    rows = [
        (1, "AVRO", ACCOUNT_AVRO, None),
        (2, "AVRO", ACCOUNT_KEY_AVRO, None),
        (3, "PROTOBUF", None, product_descriptors()),
        (4, "JSON", "{}", None),
    ]
    return spark.createDataFrame(rows, SCHEMAS_SCHEMA)


@cache
def _schema(path: str) -> StructType:
    """Schema from one file footer, so that the same table is not inspected again for every query."""
    return SparkSession.active().read.parquet(path).schema


def _scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_schema(path)).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _scan(spark, f"{sf_dir}/{name}.parquet")


# topic -> (table, id, message columns). Unnamed offsets are the dense id in its partition.
_LINE_OFFSET = """shiftleft(cast(unix_date(to_date(l_shipdate)) as bigint), 47) + shiftright(cast(conv(substring(
  md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 12), 16, 10) as bigint), 1)"""


def _header(name: str, text: str) -> str:
    return f"struct('{name}' as key, cast({text} as binary) as value)"


def _short(text: str, factor: int) -> str:
    """Length byte and bytes of a text shorter than 64 bytes; Avro writes the length doubled (zig-zag)."""
    return f"{_byte(f'length({text}) * {factor}')}, cast({text} as binary)"


def _byte(n: str) -> str:
    return f"unhex(lpad(hex({n}), 2, '0'))"


_CUSTOMER, _PRODUCT = "concat('CUST-', c_custkey)", "concat('PROD-', p_partkey)"

_TOPICS = {
    "orders": dict(
        table="orders",
        id="o_orderkey",
        key="concat('ORD-', o_orderkey)",
        headers=f"""array({_header("trace_id", "concat('TR-', o_orderkey)")},
          {_header("source", "if(o_orderkey % 2 = 0, 'web', 'mobile')")})""",
        value="""concat('{"order_id":"ORD-', o_orderkey, '","customer_id":"CUST-', o_custkey, '","status":"', o_orderstatus,
          '","open":', o_orderstatus = 'O', '}')""",
        timestamp="o_orderdate",
    ),
    "shipments": dict(
        table="lineitem",
        where="l_returnflag <> 'R'",
        id="l_orderkey",
        key="concat('SHP-', l_orderkey, '-', l_linenumber)",
        headers=f"""array({_header("trace-id", "concat('TR-', l_orderkey)")})""",
        value="""concat('{"shipment":{"line":', l_linenumber, ',"supplier":"SUP-', l_suppkey, '"},"orderId":"ORD-', l_orderkey,
          '","productId":"PROD-', l_partkey, '"}')""",
        timestamp="l_shipdate",
        offset=_LINE_OFFSET,
    ),
    "returns": dict(
        table="lineitem",
        where="l_returnflag = 'R'",
        id="l_orderkey",
        key="concat('RET-', l_orderkey, '-', l_linenumber)",
        value="""concat('{"source_id":"ORD-', l_orderkey, '","items":[{"id":"PROD-', l_partkey, '"}]}')""",
        timestamp="l_shipdate",
        offset=_LINE_OFFSET,
    ),
    "activity": dict(
        table="events",
        id="event_id",
        key="concat('USR-', user_id)",
        headers=f"""array({_header("sessionId", "concat('SES-', user_id % 50)")})""",
        value="""concat('{"customerId":"CUST-', user_id * 10 + event_id % 10, '","type":"', event_type, '","props":', props,
          '}')""",
        timestamp="ts",
    ),
    "dirty": dict(
        table="nation",
        id="n_nationkey",
        key="if(n_nationkey % 3 = 0, null, n_name)",
        headers=f"""array({_header("phone", "cast(n_nationkey as string)")})""",
        value="""case n_nationkey % 5 when 0 then null when 1 then cast('[1,2]' as binary) when 2 then cast('{broken' as binary)
          when 3 then X'000000002AFF' else cast(concat('{"msisdn":', n_nationkey, ',"order-id":null}') as binary) end""",
        timestamp="timestamp_seconds(unix_seconds(timestamp '2024-01-01') + n_nationkey * 60)",
        timestampType="n_nationkey % 2",
    ),
    "__audit": dict(
        table="region",
        id="r_regionkey",
        key="r_name",
        value="""concat('{"region":"', r_name, '"}')""",
        timestamp="timestamp '2024-01-01'",
    ),
    # Framed Avro: key with schema 2, value with schema 1.
    "accounts": dict(
        table="customer",
        id="c_custkey",
        key=f"concat(X'0000000002', {_short(_CUSTOMER, 2)}, {_byte('c_nationkey * 2')})",
        value=f"""concat(X'0000000001', {_short(_CUSTOMER, 2)}, {_short('c_name', 2)}, {_short('c_mktsegment', 2)},
          {_byte('c_nationkey * 2')})""",
        timestamp="timestamp '2024-02-01'",
    ),
    # Framed Protobuf: schema 3, first message, three tagged fields.
    "catalog": dict(
        table="part",
        id="p_partkey",
        key=_PRODUCT,
        value=f"""concat(X'0000000003', X'00', X'0A', {_short(_PRODUCT, 1)}, X'12', {_short('p_brand', 1)}, X'18',
          {_byte('p_size')})""",
        timestamp="timestamp '2024-02-01'",
    ),
}


def _topic(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    spec = _TOPICS[topic]
    rows = table(spark, sf_dir, spec["table"]).filter(spec.get("where", "true"))
    return rows.selectExpr(
        f"cast({spec['key']} as binary) as key",
        f"cast({spec['value']} as binary) as value",
        f"'{topic}' as topic",
        f"cast({spec['id']} % {PARTITIONS} as int) as partition",
        f"cast({spec.get('offset', spec['id'] + f' div {PARTITIONS}')} as bigint) as offset",
        f"cast({spec['timestamp']} as timestamp) as timestamp",
        f"cast({spec.get('timestampType', 0)} as int) as timestampType",
        f"cast({spec.get('headers', 'null')} as {HEADERS_TYPE}) as headers",
    )


# Topics whose payloads need no schema snapshot.
PLAIN = ["orders", "shipments", "returns", "activity", "dirty", "__audit"]


def raw_messages(spark: SparkSession, sf_dir: str, topics: list[str] | None = None) -> DataFrame:
    """The bus, or the given topics of it, in the raw layout."""
    configure(spark)
    parts = [_topic(spark, sf_dir, t) for t in (topics or _TOPICS)]
    return reduce(DataFrame.unionAll, parts)


def committed_offsets(raw: DataFrame) -> DataFrame:
    """Group ``billing`` everywhere, with partitions that never committed and one that failed; ``audit`` ahead of the
    end of ``orders``; one commit on a topic that is gone."""
    marks = watermarks(raw).filter("not startswith(topic, '__')")
    billing = marks.selectExpr(
        "'billing' as `group`",
        "topic",
        "partition",
        "if(partition = 3, -1001L, latest div 8 * (partition + 1)) as offset",
        "if(topic = 'returns' and partition = 2, 'no coordinator', null) as error",
    )
    audit = marks.filter("topic = 'orders'").selectExpr(
        "'audit' as `group`", "topic", "partition", "latest + 10 as offset", "cast(null as string) as error"
    )
    gone = raw.sparkSession.createDataFrame([("billing", "gone", 0, 5, None)], COMMITTED_SCHEMA)
    return billing.unionByName(audit).unionByName(gone)
