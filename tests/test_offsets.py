"""Topics, watermarks, seeks, descriptions, lag, lookups."""

from datetime import timedelta

import pytest
from conftest import T0, message

import bustrace as b
from bustrace.model import COMMITTED_SCHEMA, PARTITION_META_SCHEMA
from bustrace.operators.report import lag_report, message_report, topic_report


@pytest.fixture(scope="module")
def raw(bus):
    rows = [message("payments", o, {}, partition=p, key="k", ts=T0 + timedelta(minutes=o)) for p, n in ((0, 5), (1, 3)) for o in range(n)]
    return bus(*rows, message("orders", 7, "{bad"), message("orders", 9, {"order_id": "x"}), message("__consumer_offsets", 0, {}))


@pytest.fixture(scope="module")
def meta(spark):
    rows = [("payments", 0, 2, 1, 500), ("payments", 2, 3, 0, 0), ("empty", 0, None, 0, 0)]
    return spark.createDataFrame(rows, PARTITION_META_SCHEMA)


def test_topics(raw, meta):
    assert [r[0] for r in b.list_topics(raw).collect()] == ["orders", "payments"]
    assert [r[0] for r in b.list_topics(raw, True).collect()] == ["__consumer_offsets", "orders", "payments"]
    assert [r[0] for r in b.list_topics(raw, partition_meta=meta).collect()] == ["empty", "orders", "payments"]
    assert [r[0] for r in b.partition_ids(raw, "payments").collect()] == [0, 1]
    assert [r[0] for r in b.partition_ids(raw, "payments", meta).collect()] == [0, 1, 2]
    with pytest.raises(b.TopicNotFound):
        b.partition_ids(raw, "nope")


def test_describe(raw, meta):
    row = b.describe_topic(raw, "payments").first()
    assert (row["name"], row["partition_count"]) == ("payments", 2)
    assert [tuple(p) for p in row["partitions"]] == [(0, 0, 0, 5), (1, 0, 0, 3)]
    row = b.describe_topic(raw, "payments", meta).first()
    assert [tuple(p) for p in row["partitions"]] == [(0, 2, 1, 500), (1, 0, 0, 3), (2, 3, 0, 0)]
    assert [tuple(r) for r in topic_report(b.describe_topic(raw, "orders")).collect()] == [("orders", 0, 0, 7, 10)]
    with pytest.raises(b.TopicNotFound):
        b.describe_topic(raw, "nope")


def test_offsets_for_times(raw):
    rows = b.offsets_for_times(raw.filter("topic = 'payments'"), T0 + timedelta(minutes=3)).orderBy("partition").collect()
    assert [(r["found"], r["start_offset"]) for r in rows] == [(3, 3), (None, 0)]


def test_lag(spark, meta):
    marks = spark.createDataFrame([("orders", 0, 0, 0, 100), ("orders", 1, 0, 0, 100), ("pay", 0, 0, 0, 200)],
                                  "topic string, partition int, leader int, earliest bigint, latest bigint")
    committed = spark.createDataFrame(
        [
            ("g", "orders", 0, 50, None), ("g", "orders", 1, 30, None), ("g", "pay", 0, -1001, None),
            ("g", "gone", 0, 5, None), ("h", "orders", 0, 110, None), ("h", "orders", 1, 40, "failed"),
        ],
        COMMITTED_SCHEMA,
    )

    def lags(*args):
        return sorted((r["topic"], r["partition"], r["current_offset"], r["lag"]) for r in b.consumer_group_lag(committed, marks, *args).collect())

    assert lags("g") == [("orders", 0, 50, 50), ("orders", 1, 30, 70), ("pay", 0, 0, 200)]
    assert lags("g", ["pay"]) == [("pay", 0, 0, 200)] and lags("g", []) == [] == lags("nobody")
    assert lags("h") == [("orders", 0, 110, -10), ("orders", 1, 0, 100)]
    every = b.consumer_group_lag(committed, marks)
    assert len({r["timestamp_utc"] for r in every.collect()}) == 1 and every.first()["event_type"] == "consumer_lag"
    totals = {(r["group"], r["topic"]): r["total_lag"] for r in b.lag_summary(every).collect()}
    assert totals == {("g", "orders"): 120, ("g", "pay"): 200, ("h", "orders"): 90}
    assert lag_report(every).columns == ["Group", "Topic", "Partition", "Current", "End", "Lag"]
    line = b.export_json(every.filter("topic = 'pay'")).first()[0]
    assert '"lag":200' in line and "+00:00" in line


def test_get_message(raw, meta):
    row = b.get_message(raw, "orders", 0, 9).first()
    assert row["keys"]["order_id"] == "x"
    assert message_report(b.get_message(raw, "orders", 0, 9)).first()["Message"] == "orders[0]@9"
    with pytest.raises(b.DecodeError, match=r"orders\[0\]@7"):
        b.get_message(raw, "orders", 0, 7)
    with pytest.raises(b.MessageMissing):
        b.get_message(raw, "orders", 0, 8)
    for offset in (6, 10):
        with pytest.raises(b.MessageNotFound):
            b.get_message(raw, "orders", 0, offset)
    with pytest.raises(b.MessageMissing):
        b.get_message(raw, "payments", 0, 400, meta)
    with pytest.raises(b.TopicNotFound):
        b.get_message(raw, "nope", 0, 0)


def test_get_messages(spark, raw):
    wanted = [("orders", 0, 9), ("orders", 0, 8), ("orders", 0, 3), ("orders", 5, 0), ("orders", 0, 9)]
    found = b.get_messages(raw, spark.createDataFrame(wanted, "topic string, partition int, offset bigint")).collect()
    status = {(r["partition"], r["offset"]): r["lookup_status"] for r in found}
    assert status == {(0, 9): "found", (0, 8): "missing", (0, 3): "out_of_range", (5, 0): "unknown_partition"}
    assert len(found) == 4


def test_client(spark, raw):
    bus = b.Bus(raw)
    assert bus.list_topics().count() == 2 and bus.search_messages("k", topics=["payments"]).count() == 8
    assert bus.describe_topic("orders").count() == 1 and bus.get_message("orders", 0, 9).count() == 1
    with pytest.raises(b.TopicNotFound):
        bus.search_messages("k", topics=["payments", "nope"])
    with pytest.raises(ValueError):
        bus.consumer_group_lag("g")
    committed = spark.createDataFrame([("g", "payments", 0, 2, None)], COMMITTED_SCHEMA)
    assert b.Bus(raw, committed=committed).consumer_group_lag("g").first()["lag"] == 3


def test_kafka_options():
    options = b.kafka_options(
        "host:9092", ["a", "b"], starting={"a": {1: 5, 0: 3}}, ending={"a": {0: 9, 1: 9}}, security_protocol="SSL"
    )
    assert options == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "a,b", "includeHeaders": "true",
        "startingOffsets": '{"a": {"0": 3, "1": 5}}', "endingOffsets": '{"a": {"0": 9, "1": 9}}',
        "kafka.security.protocol": "SSL",
    }
    seek = b.kafka_options("h", ["a"], time_from=T0)
    assert seek["startingTimestamp"] == str(int(T0.timestamp() * 1000)) and "startingOffsets" not in seek
    with pytest.raises(ValueError):
        b.kafka_options("", ["a"])
