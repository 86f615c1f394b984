"""Search: key fields, filters, windows, limits, bounds, many keys."""

from datetime import datetime, timedelta, timezone

import pytest
from conftest import T0, coords, message
from pyspark.sql import functions as F

import bustrace as b
from bustrace.operators import search


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def offsets(df):
    return [r["offset"] for r in df.collect()]


@pytest.fixture(scope="module")
def raw(bus):
    return bus(
        message("orders", 0, {"order_id": "O1", "n": {"x": 5}}, key="k1", headers={"h": "a", "g": "1"}, ts=at(3)),
        message("orders", 1, {"order_id": "O2"}, key="k1", headers={"h": "b"}, ts=at(1)),
        message("orders", 2, "{broken", key=None, headers={"h": "a"}, ts=at(2)),
        message("payments", 0, {"order_id": "O1", "ok": True}, key="k2", ts=at(0), partition=1),
        message("payments", 1, ["O1"], key="k1", ts=at(5), ts_type=1),
        message("payments", 2, {"order_id": "O1"}, key="late", ts=datetime(2999, 1, 1, tzinfo=timezone.utc)),
        message("payments", 3, {}, key="undated", ts_type=-1),
        message("__internal", 0, {"order_id": "O1"}, key="k1"),
    )


def test_key_field(raw):
    assert coords(b.search_messages(raw, "k1", limit=500)) == [("orders", 0, 1), ("orders", 0, 0), ("payments", 0, 1)]
    assert coords(b.search_messages(raw, "k1", key_field="key", topics=["__internal"])) == [("__internal", 0, 0)]
    assert offsets(b.search_messages(raw, "a", key_field="header:h", limit=500)) == [2, 0]
    assert coords(b.search_messages(raw, "O1", key_field="value:order_id", limit=500)) == [("payments", 1, 0), ("orders", 0, 0)]
    assert offsets(b.search_messages(raw, "5", key_field="value:n.x", limit=500)) == [0]
    assert offsets(b.search_messages(raw, "True", key_field="value:ok", limit=500)) == [0]
    for nothing in ("body:order_id", "header", "value", "", "header:none", "value:order_id.x"):
        assert offsets(b.search_messages(raw, "O1", key_field=nothing, limit=500)) == []


def test_result_is_a_full_message(raw):
    row = b.search_messages(raw, "O2", key_field="value:order_id").select("*", F.to_json("value").alias("j")).first()
    assert row["j"] == '{"order_id":"O2"}' and row["keys"]["order_id"] == "O2" and row["headers"] == {"h": "b"}
    assert row["raw"] == b'{"order_id": "O2"}' and row["raw_key"] == b"k1" and row["schema_id"] is None


def test_headers_topics_and_limits(raw):
    assert offsets(b.search_messages(raw, "k1", headers={"h": "a", "g": "1"}, limit=500)) == [0]
    assert offsets(b.search_messages(raw, "k1", headers={"h": "a", "g": "2"}, limit=500)) == []
    assert len(offsets(b.search_messages(raw, "k1", headers={}, limit=500))) == 3
    assert offsets(b.search_messages(raw, "k1", topics=[], limit=500)) == [] == offsets(b.search_messages(raw, "k1", limit=0))
    # scan order decides which match survives, time decides the order of the result
    assert coords(b.search_messages(raw, "k1", limit=1)) == [("orders", 0, 0)]
    assert coords(b.search_messages(raw, "k1", topics=["payments", "orders"], limit=2)) == [("orders", 0, 0), ("payments", 0, 1)]
    assert len(coords(b.search_messages(raw, "k1", limit=None))) == 3


def test_window(raw):
    assert offsets(b.search_messages(raw, "k1", time_from=at(1), time_to=at(3), limit=500)) == [1]  # start in, end out
    assert offsets(b.search_messages(raw, "k1", time_from=at(5), limit=500)) == [1]
    assert offsets(b.search_messages(raw, "late", limit=500)) == []  # the default end is now
    assert offsets(b.search_messages(raw, "late", time_to=datetime(3000, 1, 1), limit=500)) == [2]
    assert offsets(b.search_messages(raw, "undated", limit=500)) == [3] and offsets(b.search_messages(raw, "undated", time_from=at(0), limit=500)) == []


def test_seek(bus):
    raw = bus(
        *[message("t", o, {}, key="k", ts=at(m)) for o, m in enumerate([0, 5, 1, 6])],
        *[message("t", o, {}, key="k", ts=at(0), partition=1) for o in range(2)],
    )
    found = b.search_messages(raw, "k", time_from=at(5), mode="seek", limit=None)
    # from the first late enough offset on; a partition without one is read from its beginning
    assert sorted(coords(found)) == [("t", 0, 1), ("t", 0, 2), ("t", 0, 3), ("t", 1, 0), ("t", 1, 1)]
    assert sorted(coords(b.search_messages(raw, "k", time_from=at(5), limit=None))) == [("t", 0, 1), ("t", 0, 3)]
    with pytest.raises(ValueError):
        b.search_messages(raw, "k", mode="other")


def test_offset_range(bus):
    """Start inclusive, stop exclusive, in every partition."""
    offsets = [0, 1, 7, 8, 1000, 2**50]
    raw = bus(
        *[message("t", o, {}, key="k") for o in offsets],
        *[message("t", o, {}, key="k", partition=1) for o in range(3)],
    )
    found = b.search_messages(raw, "k", start_offset=1, stop_offset=1000)
    assert sorted(coords(found)) == [("t", 0, o) for o in (1, 7, 8)] + [("t", 1, 1), ("t", 1, 2)]
    assert sorted(coords(b.search_messages(raw, "k", start_offset=1000))) == [("t", 0, 1000), ("t", 0, 2**50)]
    assert sorted(coords(b.search_messages(raw, "k", stop_offset=1))) == [("t", 0, 0), ("t", 1, 0)]


def test_bounds_reach_the_scan(spark, bus, tmp_path):
    path = str(tmp_path / "bus")
    b.write_archive(bus(*[message(t, o, {}, key="k", ts=at(o % 50)) for t in "ab" for o in range(200)]), path)
    raw = b.read_archive(spark, path)

    def pushed(df):
        return df._jdf.queryExecution().executedPlan().toString()

    plan = pushed(b.search_messages(raw, "k", start_offset=50, stop_offset=60))
    assert "GreaterThanOrEqual(offset,50)" in plan and "LessThan(offset,60)" in plan
    wanted = spark.createDataFrame([("a", 0, 70), ("a", 0, 75)], "topic string, partition int, offset long")
    plan = pushed(b.get_messages(raw, wanted))
    assert "GreaterThanOrEqual(offset,70)" in plan and "LessThan(offset,76)" in plan and "topic#" in plan
    plan = pushed(b.search_messages(raw, "k", topics=["b"], time_from=at(30), mode="seek"))
    assert "GreaterThanOrEqual(offset,30)" in plan


def test_nothing_is_left_out_unasked(bus):
    raw = bus(*[message("t", o, {}, key="k") for o in range(700)])
    assert b.search_messages(raw, "k").count() == 700


@pytest.mark.parametrize("n", [1, 99, 100, 101, 450, 999, 1000, 5000])
def test_a_large_limit_is_found_by_counts(spark, monkeypatch, n):
    monkeypatch.setattr(search, "MERGED_ROWS", 0)
    rows = spark.range(1000, numPartitions=7).selectExpr("id", "id % 10 as k")
    found = search.first_rows(rows, ["k", F.desc("id")], n)
    assert sorted((r["k"], -r["id"]) for r in found.collect()) == sorted((i % 10, -i) for i in range(1000))[:n]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert n >= 1000 or "Sort" in plan or plan.count("GlobalLimit") <= 1


def test_search_many_is_the_union_of_searches(spark, raw):
    keys = spark.createDataFrame([("k1",), ("k2",), ("k1",), ("none",), (None,)], "key string")
    many = b.search_many(raw, keys)
    single = [c for k in ("k1", "k2", "none") for c in coords(b.search_messages(raw, k, limit=None))]
    assert sorted(coords(many)) == sorted(single) and {r["search_key"] for r in many.collect()} == {"k1", "k2"}
    keys = spark.createDataFrame([("O1",), ("O2",), ("a",)], "key string")
    values = b.search_many(raw, keys, key_field="value:order_id", topics=["orders", "payments"])
    assert sorted((r["search_key"], r["offset"]) for r in values.collect()) == [("O1", 0), ("O1", 0), ("O2", 1)]
    assert sorted(coords(b.search_many(raw, keys, key_field="header:h"))) == [("orders", 0, 0), ("orders", 0, 2)]
    assert b.search_many(raw, keys, key_field="other").count() == 0


def test_limit_per_key_with_a_hot_key(spark, bus):
    raw = bus(*[message("t", o, {}, key="hot" if o % 3 else f"k{o}", partition=o % 2) for o in range(300)])
    keys = spark.createDataFrame([("hot",), ("k0",)], "key string")
    found = b.search_many(raw, keys, limit_per_key=5)
    hot = sorted((o % 2, o) for o in range(300) if o % 3)[:5]
    assert sorted((r["partition"], r["offset"]) for r in found.collect()) == sorted([*hot, (0, 0)])


def test_scan_partition_benchmark_shape(bus):
    rows = [
        message(
            "t", i,
            {"order_id": f"ORD-{i}", "msisdn": f"7900{i:07d}", "customerId": f"CUST-{i}", "productId": f"PROD-{i % 50}"},
            key="target-key" if i % 100 == 0 else f"key-{i}", headers={"trace_id": f"trace-{i}"},
        )
        for i in range(1000)
    ]
    found = b.scan_partition(b.decode(b.normalize(bus(*rows))), "target-key").orderBy("offset").collect()
    assert [r["offset"] for r in found] == list(range(0, 1000, 100))
    assert found[1]["keys"].asDict() == {"order_id": "ORD-100", "msisdn": "79000000100", "customer_id": "CUST-100", "product_id": "PROD-0"}


def test_stream_gives_what_batch_gives(spark, raw, tmp_path):
    from bustrace.streaming.matches import stream_archive, stream_matches

    raw.write.parquet(str(tmp_path / "in"))
    found = stream_matches(stream_archive(spark, str(tmp_path / "in")), "O1", key_field="value:order_id")
    query = (
        found.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    batch = b.match_messages(raw, "O1", key_field="value:order_id")
    assert sorted(coords(spark.read.parquet(str(tmp_path / "out")))) == sorted(coords(batch)) != []


def test_filters_reach_the_scan(spark, raw, tmp_path):
    b.write_archive(raw, str(tmp_path / "archive"))
    archive = b.read_archive(spark, str(tmp_path / "archive"))
    assert sorted(coords(archive)) == sorted(coords(raw))
    found = b.search_messages(archive, "k1", topics=["orders"], time_from=at(0))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan and "topic#" in plan.split("PartitionFilters")[1]
    pushed = plan.split("PushedFilters: ")[1].split("ReadSchema")[0]
    assert "IsNotNull(key)" in pushed and "GreaterThanOrEqual(timestamp" in pushed
    value = b.match_messages(archive, "O1", key_field="value:order_id")
    lines = value._jdf.queryExecution().optimizedPlan().toString().splitlines()
    parses = [i for i, line in enumerate(lines) if "parseJson" in line]
    candidates = [i for i, line in enumerate(lines) if "Filter" in line and "Contains(" in line]
    assert len(parses) == 1 and candidates and candidates[0] > parses[0], lines  # raw bytes are tested below the parse


def test_limited_results_are_not_sorted_as_a_whole(raw):
    for field in (None, "header:h", "value:order_id"):
        plan = b.search_messages(raw, "O1", key_field=field, limit=500)._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
