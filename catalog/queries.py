"""The registered queries: every operator over the whole derived bus, with scalar result columns."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import bustrace as b
from bustrace.functions.identifiers import correlation_ids, references
from bustrace.model import COORDS
from bustrace.operators import report
from bustrace.operators.offsets import watermarks
from bustrace.session import scratch_path
from bustrace.streaming.matches import follow, followed, stream_archive, stream_matches
from catalog.bus import PLAIN, committed_offsets, raw_messages, schemas, table

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}

FOLLOW = ["shipments", "returns", "activity"]


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _plain(spark: SparkSession, sf_dir: str, topics: list[str] | None = None) -> DataFrame:
    return raw_messages(spark, sf_dir, topics or PLAIN)


def _micros(column: str) -> F.Column:
    return F.unix_micros(column).alias("ts_us")


def flat(messages: DataFrame, *more) -> DataFrame:
    """Coordinates, key, time, value text and evidence as scalars."""
    return messages.select(
        *COORDS, "key", _micros("timestamp_utc"), F.to_json("value").alias("value_json"), "keys.*", *more
    )


def traced(correlated: DataFrame) -> DataFrame:
    last = F.try_element_at("correlation_details", F.lit(-1))
    return correlated.select(
        *COORDS,
        F.array_join("correlation_chain", "->").alias("chain"),
        "correlation_level",
        last["direction"].alias("direction"),
        last["field"].alias("field"),
        last["extraction_method"].alias("method"),
        _micros("timestamp_utc"),
    )


# --- Topics and offsets ---------------------------------------------------------------------------------------------


@query
def list_topics(spark, sf_dir):
    return b.list_topics(raw_messages(spark, sf_dir))


@query
def list_topics_internal(spark, sf_dir):
    return b.list_topics(raw_messages(spark, sf_dir), include_internal=True)


@query
def partition_ids(spark, sf_dir):
    return b.partition_ids(_plain(spark, sf_dir), "shipments")


@query
def watermark_offsets(spark, sf_dir):
    return b.watermarks(raw_messages(spark, sf_dir))


@query
def describe_topic(spark, sf_dir):
    return report.topic_report(b.describe_topic(_plain(spark, sf_dir), "shipments"))


@query
def describe_topics(spark, sf_dir):
    ends = F.array_join(F.transform("partitions", lambda p: F.concat_ws(":", p["id"], p["earliest"], p["latest"])), ",")
    return b.describe_topics(raw_messages(spark, sf_dir)).select("name", "partition_count", ends.alias("partitions"))


@query
def offsets_for_times(spark, sf_dir):
    return b.offsets_for_times(raw_messages(spark, sf_dir), datetime(1997, 1, 1))


def _lag(spark, sf_dir, **options):
    raw = _plain(spark, sf_dir)
    return b.consumer_group_lag(committed_offsets(raw), watermarks(raw), **options)


@query
def consumer_lag(spark, sf_dir):
    return _lag(spark, sf_dir).drop("timestamp_utc")


@query
def consumer_lag_topics(spark, sf_dir):
    return report.lag_report(_lag(spark, sf_dir, group="billing", topics=["orders", "activity"]))


@query
def lag_summary(spark, sf_dir):
    return b.lag_summary(_lag(spark, sf_dir))


# --- Rows: normalise, decode, evidence ------------------------------------------------------------------------------


@query
def normalized(spark, sf_dir):
    return b.normalize(_plain(spark, sf_dir)).select(
        *COORDS,
        "key",
        F.to_json("headers").alias("headers_json"),
        _micros("timestamp_utc"),
        "timestamp_fallback",
        F.octet_length("raw").alias("raw_bytes"),
    )


@query
def decode_status(spark, sf_dir):
    decoded = b.decode(b.normalize(raw_messages(spark, sf_dir)), schemas(spark))
    return decoded.select(*COORDS, "decode_status", "decode_error")


@query
def decode_without_registry(spark, sf_dir):
    decoded = b.decode(b.normalize(raw_messages(spark, sf_dir)))
    return decoded.select(*COORDS, "decode_status", "decode_error")


@query
def schema_ids(spark, sf_dir):
    decoded = b.decode(b.normalize(raw_messages(spark, sf_dir)))
    return decoded.select(*COORDS, F.col("schema_id.value").alias("value_id"), F.col("schema_id.key").alias("key_id"))


@query
def decode_avro(spark, sf_dir):
    messages = b.enrich(raw_messages(spark, sf_dir, ["accounts"]), schemas=schemas(spark))
    return flat(messages, F.to_json("key_decoded").alias("key_json")).drop("key")


@query
def decode_protobuf(spark, sf_dir):
    return flat(b.enrich(raw_messages(spark, sf_dir, ["catalog"]), schemas=schemas(spark)))


@query
def evidence(spark, sf_dir):
    return flat(b.enrich(_plain(spark, sf_dir)))


@query
def evidence_framed(spark, sf_dir):
    messages = b.enrich(raw_messages(spark, sf_dir), schemas=schemas(spark))
    return messages.select(*COORDS, "keys.*", "source", "event_type")


# --- Search ---------------------------------------------------------------------------------------------------------


@query
def search_key(spark, sf_dir):
    return flat(b.search_messages(_plain(spark, sf_dir), "USR-7", limit=None))


@query
def search_header(spark, sf_dir):
    return flat(b.search_messages(_plain(spark, sf_dir), "TR-7", key_field="header:trace-id"))


@query
def search_value_path(spark, sf_dir):
    return flat(b.search_messages(_plain(spark, sf_dir), "ORD-7", key_field="value:orderId"))


@query
def search_nested_path(spark, sf_dir):
    return flat(b.search_messages(_plain(spark, sf_dir), "SUP-3", key_field="value:shipment.supplier", limit=None))


@query
def search_boolean(spark, sf_dir):
    return flat(b.search_messages(_plain(spark, sf_dir), "True", key_field="value:open", limit=None))


@query
def search_number(spark, sf_dir):
    return flat(b.search_messages(_plain(spark, sf_dir), "26", key_field="value:props.k", limit=None))


@query
def search_framed(spark, sf_dir):
    raw = raw_messages(spark, sf_dir)
    return flat(b.search_messages(raw, "BUILDING", key_field="value:segment", limit=None, schemas=schemas(spark))).drop("key")


@query
def search_window(spark, sf_dir):
    window = {"time_from": datetime(1996, 1, 1), "time_to": datetime(1997, 1, 1)}
    return flat(b.search_messages(_plain(spark, sf_dir), "SUP-3", key_field="value:shipment.supplier", limit=None, **window))


@query
def search_seek(spark, sf_dir):
    found = b.search_messages(
        _plain(spark, sf_dir),
        "web",
        key_field="header:source",
        time_from=datetime(2001, 6, 1),
        limit=None,
        mode="seek",
    )
    return flat(found)


@query
def search_headers_and(spark, sf_dir):
    raw = _plain(spark, sf_dir)
    return flat(b.search_messages(raw, "O", key_field="value:status", headers={"source": "web"}, limit=None))


@query
def search_limit(spark, sf_dir):
    raw = _plain(spark, sf_dir)
    topics = ["shipments", "orders"]
    return flat(b.search_messages(raw, "SUP-3", key_field="value:shipment.supplier", topics=topics, limit=50))


@query
def search_offsets(spark, sf_dir):
    raw = _plain(spark, sf_dir)
    return flat(b.search_messages(raw, "web", key_field="header:source", start_offset=100, stop_offset=2000))


@query
def search_order(spark, sf_dir):
    """The order of a limited result, as a column."""
    raw = _plain(spark, sf_dir)
    found = b.search_messages(raw, "SUP-3", key_field="value:shipment.supplier", topics=["shipments"], limit=40)
    # The limited result is one partition, in its order.
    return flat(found, (F.monotonically_increasing_id() + 1).alias("place"))


@query
def search_no_topics(spark, sf_dir):
    return flat(b.search_messages(_plain(spark, sf_dir), "USR-7", topics=[]))


@query
def search_unknown_field(spark, sf_dir):
    return flat(b.search_messages(_plain(spark, sf_dir), "USR-7", key_field="topic"))


def _order_keys(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.format_string("ORD-%d", "o_orderkey").alias("key"))


@query
def search_many(spark, sf_dir):
    raw = _plain(spark, sf_dir)
    return flat(b.search_many(raw, _order_keys(spark, sf_dir), key_field="value:orderId"), "search_key")


@query
def search_many_keys(spark, sf_dir):
    users = table(spark, sf_dir, "customer").select(F.format_string("USR-%d", "c_custkey").alias("key"))
    return flat(b.search_many(_plain(spark, sf_dir), users), "search_key")


@query
def search_many_top(spark, sf_dir):
    raw = _plain(spark, sf_dir)
    keys = table(spark, sf_dir, "supplier").select(F.format_string("SUP-%d", "s_suppkey").alias("key"))
    return flat(b.search_many(raw, keys, key_field="value:shipment.supplier", limit_per_key=3), "search_key")


@query
def scan_partition(spark, sf_dir):
    messages = b.decode(b.normalize(_plain(spark, sf_dir)))
    return flat(b.scan_partition(messages, "USR-7"))


@query
def search_report(spark, sf_dir):
    return report.search_report(b.search_messages(_plain(spark, sf_dir), "USR-7"))


# --- Lookup ---------------------------------------------------------------------------------------------------------


@query
def get_message(spark, sf_dir):
    return flat(b.get_message(_plain(spark, sf_dir), "orders", 3, 1))


@query
def get_messages(spark, sf_dir):
    """Coordinates made from customers: found, beyond the end, in a gap, and in a partition that does not exist."""
    c = F.col("c_custkey")
    customers = table(spark, sf_dir, "customer")
    coords = customers.select(F.lit("orders").alias("topic"), (c % 5).cast("int").alias("partition"), (c * 5).alias("offset"))
    gaps = customers.select(
        F.lit("shipments").alias("topic"),
        (c % 4).cast("int").alias("partition"),
        (F.shiftleft(F.lit(10000).cast("bigint"), 47) + c).alias("offset"),
    )
    found = b.get_messages(_plain(spark, sf_dir), coords.union(gaps))
    return found.select(*COORDS, "lookup_status", "key", "keys.customer_id")


# --- Over a written archive -------------------------------------------------------------------------------------------


@cache
def _archive_path(application: str, sf_dir: str) -> str:
    spark = SparkSession.active()
    path = scratch_path(spark, "archive")
    b.write_archive(_plain(spark, sf_dir), path)
    return path


def _archive(spark, sf_dir):
    """The bus as an archive in the shared folder, written once for each session and table folder."""
    return b.read_archive(spark, _archive_path(spark.sparkContext.applicationId, sf_dir))


def _blocks(spark, sf_dir):
    _archive(spark, sf_dir)
    return b.read_blocks(spark, _archive_path(spark.sparkContext.applicationId, sf_dir))


@query
def archive_search_key(spark, sf_dir):
    return flat(b.search_messages(_archive(spark, sf_dir), "USR-7"))


@query
def archive_search_offsets(spark, sf_dir):
    bounds = {"topics": ["orders"], "start_offset": 100, "stop_offset": 200}
    return flat(b.search_messages(_archive(spark, sf_dir), "web", key_field="header:source", **bounds))


@query
def archive_watermarks(spark, sf_dir):
    """From the archive's block index; no message is read."""
    return b.watermarks(_archive(spark, sf_dir), blocks=_blocks(spark, sf_dir))


@query
def archive_describe_topics(spark, sf_dir):
    ends = F.array_join(F.transform("partitions", lambda p: F.concat_ws(":", p["id"], p["earliest"], p["latest"])), ",")
    found = b.describe_topics(_archive(spark, sf_dir), blocks=_blocks(spark, sf_dir))
    return found.select("name", "partition_count", ends.alias("partitions"))


@query
def archive_offsets_for_times(spark, sf_dir):
    """A seek by the block index: one block of each partition is read."""
    return b.offsets_for_times(_archive(spark, sf_dir), datetime(1997, 1, 1), blocks=_blocks(spark, sf_dir))


@query
def archive_search_seek(spark, sf_dir):
    raw, window = _archive(spark, sf_dir), {"time_from": datetime(2001, 6, 1), "mode": "seek"}
    return flat(b.search_messages(raw, "web", key_field="header:source", blocks=_blocks(spark, sf_dir), **window))


@query
def archive_get_messages(spark, sf_dir):
    raw = _archive(spark, sf_dir)
    coords = raw.filter("topic = 'orders' and offset % 10 = 0").select(*COORDS)
    return b.get_messages(raw, coords).select(*COORDS, "lookup_status", "key", "keys.customer_id")


@query
def archive_get_messages_all(spark, sf_dir):
    """Every coordinate of the archive, the offset behind each, and partitions that do not exist."""
    raw = _archive(spark, sf_dir)
    held = raw.select(*COORDS)
    behind = held.withColumn("offset", F.col("offset") + 1)
    absent = watermarks(raw).select("topic", (F.col("partition") + 4).alias("partition"), F.col("earliest").alias("offset"))
    coords = held.union(behind).union(absent)
    return b.get_messages(raw, coords).select(*COORDS, "lookup_status", "key", "keys.customer_id")


@query
def coordinates_held_twice(spark, sf_dir):
    """Coordinates that more than one message has, by topic."""
    held = raw_messages(spark, sf_dir).groupBy(*COORDS).count().filter("count > 1")
    return held.groupBy("topic").agg(F.count(F.lit(1)).alias("twice"))


# --- Streams ------------------------------------------------------------------------------------------------------------


@query
def stream_search(spark, sf_dir):
    """A search that follows a growing archive: stopped after a batch, resumed, resumed again when the archive has grown."""
    raw = _plain(spark, sf_dir)
    path, out, state = (scratch_path(spark, f"stream-{name}") for name in ("archive", "found", "state"))
    b.write_archive(raw.filter("partition < 2"), path)
    found = flat(stream_matches(stream_archive(spark, path, files_per_batch=4), "web", key_field="header:source"))
    follow(found, out, state, batches=1)
    follow(found, out, state)
    b.write_archive(raw.filter("partition >= 2"), path, mode="append")
    follow(found, out, state)
    return followed(spark, out, found)


# --- Broker metadata ----------------------------------------------------------------------------------------------------


@query
def watermarks_with_metadata(spark, sf_dir):
    """Leaders, an earlier end of retention, a later end, and a partition without messages."""
    raw = _plain(spark, sf_dir)
    meta = watermarks(raw).selectExpr(
        "topic",
        "partition",
        "partition + 1 as leader",
        "if(partition = 0, earliest + 1, null) as earliest",
        "if(partition = 1, latest + 5, null) as latest",
    )
    empty = spark.createDataFrame([("empty", 0, 7, 0, 0)], "topic string, partition int, leader int, earliest long, latest long")
    return b.watermarks(raw, meta.unionByName(empty))


# --- Export ---------------------------------------------------------------------------------------------------------


@query
def export_json(spark, sf_dir):
    return b.export_json(b.enrich(_plain(spark, sf_dir, ["orders"]))).withColumnRenamed("value", "json")


@query
def export_lag(spark, sf_dir):
    lines = b.export_json(_lag(spark, sf_dir))
    return lines.select(F.regexp_extract("value", r'^(.*"partition":\d+)', 1).alias("head"))


@query
def export_json_all(spark, sf_dir):
    """Every message of all eight topics as a JSON line, with the payload's own text, read back field by field."""
    lines = b.export_json(b.enrich(raw_messages(spark, sf_dir), schemas=schemas(spark)), payload_text=True)
    line = F.col("value")

    def at(path: str) -> F.Column:
        return F.get_json_object(line, f"$.{path}")

    # Members are in the payload's order; a VARIANT has them in the order of their names.
    value = F.to_json(F.try_parse_json(at("value")))
    return lines.select(
        at("topic").alias("topic"),
        at("partition").cast("int").alias("partition"),
        at("offset").cast("bigint").alias("offset"),
        value.alias("value_json"),
        *(at(f"keys.{k}").alias(k) for k in ("order_id", "msisdn", "customer_id", "product_id")),
    )


@query
def export_lag_all(spark, sf_dir):
    """Whole lines of the lag export, but for the time of the call."""
    lines = b.export_json(_lag(spark, sf_dir))
    return lines.select(F.regexp_replace("value", r'"timestamp_utc":"[^"]*"', '"timestamp_utc":""').alias("line"))


@query
def import_json(spark, sf_dir):
    return flat(b.import_json(b.export_json(b.enrich(_plain(spark, sf_dir)))), F.octet_length("raw").alias("raw_bytes"))


# --- Correlation ----------------------------------------------------------------------------------------------------


@query
def ids_standard(spark, sf_dir):
    return correlation_ids(b.enrich(_plain(spark, sf_dir)))


@query
def ids_regex(spark, sf_dir):
    messages = b.enrich(_plain(spark, sf_dir, FOLLOW))
    patterns = [r"SUP-(\d+)", r"(CUST)-(\d+)", "(broken", '"PROD-[0-9]+"']
    return correlation_ids(messages, regex_patterns=patterns, standard=False)


@query
def ids_jsonpath(spark, sf_dir):
    messages = b.enrich(_plain(spark, sf_dir, FOLLOW))
    paths = ["$.items[*].id", "$.props.k", "$['shipment'].*", "$.headers['trace-id']", "items[0].id", "$..supplier", "$[?"]
    return correlation_ids(messages, jsonpath_expressions=paths, standard=False)


def _all_topics(spark, sf_dir):
    return b.enrich(raw_messages(spark, sf_dir), schemas=schemas(spark))


@query
def ids_regex_all(spark, sf_dir):
    """``ids_regex`` over all eight topics."""
    patterns = [r"SUP-(\d+)", r"(CUST)-(\d+)", "(broken", '"PROD-[0-9]+"']
    return correlation_ids(_all_topics(spark, sf_dir), regex_patterns=patterns, standard=False)


@query
def ids_jsonpath_all(spark, sf_dir):
    """``ids_jsonpath`` over all eight topics, with more paths that go down to any depth."""
    paths = ["$.items[*].id", "$['shipment'].*", "$..supplier", "$..id", "$..customer_id", "$.props..k", "$..items..id"]
    return correlation_ids(_all_topics(spark, sf_dir), jsonpath_expressions=paths, standard=False)


@query
def reference_rows(spark, sf_dir):
    decoded = b.decode(b.normalize(_plain(spark, sf_dir)))
    return references(decoded, [], bidirectional=True)


def _seeds(spark, sf_dir, topic):
    return b.enrich(_plain(spark, sf_dir, [topic]))


@query
def correlate_forward(spark, sf_dir):
    raw = _plain(spark, sf_dir)
    return traced(b.correlate(raw, _seeds(spark, sf_dir, "orders"), FOLLOW, limit=None))


@query
def correlate_backward(spark, sf_dir):
    raw = _plain(spark, sf_dir)
    return traced(b.correlate(raw, _seeds(spark, sf_dir, "orders"), FOLLOW, limit=None, bidirectional=True))


@query
def correlate_breadth(spark, sf_dir):
    raw = _plain(spark, sf_dir)
    return traced(b.correlate(raw, _seeds(spark, sf_dir, "orders"), FOLLOW, limit=None, max_breadth=100))


@query
def correlate_jsonpath(spark, sf_dir):
    raw = _plain(spark, sf_dir)
    seeds = _seeds(spark, sf_dir, "returns")
    return traced(
        b.correlate(raw, seeds, ["orders", "shipments"], limit=None, jsonpath_expressions=["$.source_id"])
    )


@query
def correlate_regex(spark, sf_dir):
    raw = _plain(spark, sf_dir)
    seeds = _seeds(spark, sf_dir, "returns")
    return traced(b.correlate(raw, seeds, ["orders"], limit=None, regex_patterns=['"source_id":"([^"]+)"']))


@query
def correlate_depth2(spark, sf_dir):
    raw = _plain(spark, sf_dir)
    seeds = _seeds(spark, sf_dir, "shipments")
    return traced(b.correlate(raw, seeds, ["orders", "activity"], limit=None, max_depth=2))


@query
def correlate_depth3(spark, sf_dir):
    """Three hops from one order, every hit kept: its parts and sessions reach much of the bus."""
    raw = _plain(spark, sf_dir)
    seeds = b.search_messages(raw, "ORD-7", topics=["orders"])
    return traced(b.correlate(raw, seeds, ["orders", "shipments", "activity"], limit=None, max_depth=3))


@query
def correlate_limit(spark, sf_dir):
    raw = _plain(spark, sf_dir)
    seeds = b.search_messages(raw, "ORD-7", topics=["orders"])
    return traced(b.correlate(raw, seeds, ["activity", "shipments"], limit=5))


@query
def correlate_framed(spark, sf_dir):
    """Orders to the Avro account messages of their customers."""
    raw = raw_messages(spark, sf_dir)
    return traced(b.correlate(raw, _seeds(spark, sf_dir, "orders"), ["accounts"], limit=None, schemas=schemas(spark)))


@query
def correlate_summary(spark, sf_dir):
    raw = _plain(spark, sf_dir)
    found = b.correlate(raw, _seeds(spark, sf_dir, "orders"), FOLLOW, limit=None, bidirectional=True)
    return b.correlation_summary(found).select(
        "id",
        "messages",
        F.array_join("topics", ",").alias("topics"),
        F.unix_micros("first_seen").alias("first_us"),
        F.unix_micros("last_seen").alias("last_us"),
    )


# --- Correlation over the inverted reference table: it is written once, and every query here reads it -------------------


@cache
def _index_path(application: str, sf_dir: str) -> str:
    spark = SparkSession.active()
    path = scratch_path(spark, "index")
    b.write_index(_linked(spark, sf_dir), path)
    return path


def _linked(spark, sf_dir):
    """The archive and the topic of products, whose keys are ids that shipments give away."""
    return _archive(spark, sf_dir).unionByName(raw_messages(spark, sf_dir, ["catalog"]))


def _indexed(spark, sf_dir):
    return _linked(spark, sf_dir), b.read_index(spark, _index_path(spark.sparkContext.applicationId, sf_dir))


def _correlate_orders(spark, sf_dir, follow, **options):
    raw, index = _indexed(spark, sf_dir)
    seeds = b.enrich(raw.filter("topic = 'orders'"))
    return b.correlate(raw, seeds, follow, index=index, **options)


@query
def indexed_references(spark, sf_dir):
    """Two partitions first, then everything offered: each message is taken in once."""
    raw, path = _plain(spark, sf_dir), scratch_path(spark, "appended")
    b.write_index(raw.filter("partition < 2"), path)
    b.append_index(raw, path)
    return b.read_index(spark, path).references.select(*COORDS, "kind_rank", "field_rank", "field", "ref_id")


@query
def indexed_shipments(spark, sf_dir):
    """One hop: the shipments of all orders."""
    return traced(_correlate_orders(spark, sf_dir, ["shipments"]))


@query
def indexed_returns(spark, sf_dir):
    """One hop backwards: messages that name an order as their source."""
    return traced(_correlate_orders(spark, sf_dir, ["returns"], bidirectional=True))


@query
def indexed_customers(spark, sf_dir):
    """What the customers of all orders did."""
    return traced(_correlate_orders(spark, sf_dir, ["activity"]))


@query
def indexed_products(spark, sf_dir):
    """Two hops: orders to shipments, and to the products in them."""
    return traced(_correlate_orders(spark, sf_dir, ["shipments", "catalog"], max_depth=2))


@query
def indexed_limit(spark, sf_dir):
    """The first 20 messages around one order, in the order in which they are found."""
    raw, index = _indexed(spark, sf_dir)
    seeds = b.search_messages(raw, "ORD-7", topics=["orders"])
    return traced(b.correlate(raw, seeds, ["activity", "shipments"], limit=20, index=index))


@query
def indexed_breadth(spark, sf_dir):
    """A hop along 100 ids, with the number of ids that were not followed."""
    found = _correlate_orders(spark, sf_dir, ["activity"], max_breadth=100)
    return found.select(*COORDS, F.array_join("correlation_chain", "->").alias("chain"), "correlation_level", "ids_left_out")


@query
def indexed_sources(spark, sf_dir):
    """Ids by a JSON path: from returns to the orders they name."""
    raw, index = _indexed(spark, sf_dir)
    seeds = b.enrich(raw.filter("topic = 'returns'"))
    return traced(b.correlate(raw, seeds, ["orders"], jsonpath_expressions=["$.source_id"], index=index))


@query
def indexed_investigation(spark, sf_dir):
    raw, index = _indexed(spark, sf_dir)
    return traced(b.investigate(raw, "ORD-7", FOLLOW, initial_topics=["orders"], bidirectional=True, index=index))


@query
def indexed_details(spark, sf_dir):
    """Chain and details as text."""
    found = _correlate_orders(spark, sf_dir, ["shipments"])
    return found.select(*COORDS, F.to_json("correlation_chain").alias("chain"), F.to_json("correlation_details").alias("details"))


@query
def indexed_exclude_seen(spark, sf_dir):
    """From open orders to the other orders of their customers: seeds are not found again."""
    raw, index = _indexed(spark, sf_dir)
    seeds = b.search_messages(raw, "O", key_field="value:status", topics=["orders"])
    return traced(b.correlate(raw, seeds, ["orders"], index=index))


@query
def indexed_summary(spark, sf_dir):
    found = _correlate_orders(spark, sf_dir, ["shipments", "returns"], bidirectional=True)
    return b.correlation_summary(found).select(
        "id",
        "messages",
        F.array_join("topics", ",").alias("topics"),
        F.unix_micros("first_seen").alias("first_us"),
        F.unix_micros("last_seen").alias("last_us"),
    )


@query
def investigate(spark, sf_dir):
    raw = _plain(spark, sf_dir)
    found = b.investigate(raw, "ORD-7", FOLLOW, initial_topics=["orders"], bidirectional=True)
    return report.correlation_report(found)
