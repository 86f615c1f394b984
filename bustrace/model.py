"""Table layouts and the fixed field lists of the message model."""

from __future__ import annotations

from pyspark.sql import types as T

COORDS = ["topic", "partition", "offset"]

HEADERS_TYPE = "array<struct<key:string,value:binary>>"

# The layout of Spark's Kafka source with includeHeaders=true, so live topics and archives are interchangeable.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
        T.StructField(
            "headers",
            T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])),
        ),
    ]
)

SCHEMAS_SCHEMA = "schema_id bigint, schema_type string, schema_str string, descriptor_set binary"
COMMITTED_SCHEMA = "group string, topic string, partition int, offset bigint, error string"
PARTITION_META_SCHEMA = "topic string, partition int, leader int, earliest bigint, latest bigint"

DETAIL_TYPE = "struct<id:string,direction:string,field:string,extraction_method:string,timestamp:string>"

# Spark's timestampType codes.
CREATE_TIME = 0
LOG_APPEND_TIME = 1

# --- Fixed values: names that must be equal to the message contract -------------------------------------------------

INTERNAL_PREFIX = "__"

SOURCE = "kafka"
MESSAGE_EVENT = "kafka_message"
LAG_EVENT = "consumer_lag"

# Fields whose value is an identifier to follow, in the order in which they are searched.
ID_FIELDS = [
    "trace_id", "traceId", "trace-id",
    "correlation_id", "correlationId", "correlation-id",
    "request_id", "requestId", "request-id",
    "transaction_id", "transactionId", "transaction-id",
    "span_id", "spanId", "span-id",
    "parent_id", "parentId", "parent-id",
    "order_id", "orderId", "order-id",
    "customer_id", "customerId", "customer-id",
    "session_id", "sessionId", "session-id",
]

# Fields that point back to the message that caused this one.
SOURCE_FIELDS = [
    "parent_id", "parentId", "parent-id",
    "source_id", "sourceId", "source-id",
    "origin_id", "originId", "origin-id",
    "caused_by", "causedBy", "caused-by",
    "trigger_id", "triggerId", "trigger-id",
]

# Evidence identifier -> accepted spellings, best first.
EVIDENCE_ALIASES = {
    "order_id": ["order_id", "orderId", "order-id"],
    "msisdn": ["msisdn", "phone", "phoneNumber"],
    "customer_id": ["customer_id", "customerId"],
    "product_id": ["product_id", "productId"],
}
