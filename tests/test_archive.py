"""What an archive is written with: Bloom filters on keys and an index of blocks."""

from datetime import timedelta

import pytest
from conftest import T0, message
from pyspark.sql import functions as F

import bustrace as b
from bustrace.operators.offsets import seek_bounds
from bustrace.sources import blocks as index


def rows_of(df):
    return sorted(map(repr, df.collect()))


def scanned(df):
    """Rows that each file scan of the plan gave."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return [leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()) if "Scan" in leaves.apply(i).nodeName()]


@pytest.fixture(scope="module")
def raw(bus):
    rows = []
    for o in range(400):
        # Times go back now and then, some have no event time.
        at = T0 + timedelta(minutes=o - (40 if o % 50 == 0 else 0))
        rows.append(message("orders", o * 3, {"id": o}, key=f"k{o * 7}", partition=o % 3, ts=at, ts_type=-1 if o % 11 == 0 else 0))
    rows += [message("other", o, {}, key="x", ts=T0 - timedelta(days=1)) for o in range(20)]
    return bus(*rows)


@pytest.fixture(scope="module")
def archive(spark, raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bus") / "archive")
    b.write_archive(raw, path)
    return b.read_archive(spark, path), b.read_blocks(spark, path), path


def small_blocks(spark, raw, path, n):
    raw.repartitionByRange(2, "topic", "partition", "offset").sortWithinPartitions("topic", "partition", "offset").write.partitionBy("topic").parquet(path)
    index.write_blocks(spark, path, n)
    return b.read_archive(spark, path), b.read_blocks(spark, path)


def test_readers_of_the_archive_do_not_see_the_index(raw, archive):
    assert rows_of(archive[0]) == rows_of(raw.select(*archive[0].columns))


def test_key_search_skips_row_groups_without_the_key(archive):
    held, absent = (archive[0].filter(F.col("key") == F.lit(bytearray(k))) for k in (b"k70", b"k71"))
    assert held.count() == 1
    assert scanned(absent) == [0]  # inside the least and greatest key, so only the Bloom filter can tell


def test_watermarks_from_blocks(raw, archive):
    assert rows_of(b.watermarks(archive[0], blocks=archive[1])) == rows_of(b.watermarks(raw))
    assert rows_of(b.describe_topics(archive[0], blocks=archive[1])) == rows_of(b.describe_topics(raw))
    text = b.watermarks(archive[0], blocks=archive[1])._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "_blocks" in text


@pytest.mark.parametrize("minutes", [-9999, 0, 37, 100, 250, 398.5, 9999])
def test_seek_by_blocks(spark, raw, tmp_path, minutes):
    held, blocks = small_blocks(spark, raw, str(tmp_path / "a"), 16)
    moment = T0 + timedelta(minutes=minutes)
    assert rows_of(b.offsets_for_times(held, moment, blocks=blocks)) == rows_of(b.offsets_for_times(raw, moment))
    assert rows_of(seek_bounds(held, moment, blocks)) == rows_of(seek_bounds(raw, moment))
    options = {"key_field": "value:id", "time_from": moment, "mode": "seek", "topics": ["orders"]}
    assert rows_of(b.search_messages(held, "77", blocks=blocks, **options).select("offset")) == rows_of(
        b.search_messages(raw, "77", **options).select("offset")
    )


def test_a_seek_reads_few_messages(spark, bus, tmp_path):
    raw = bus(*[message("t", o, {}, partition=o % 2, ts=T0 + timedelta(minutes=o)) for o in range(4000)])
    path = str(tmp_path / "a")
    for k in range(8):  # files of 500 rows
        part = raw.filter((F.col("partition") == k % 2) & (F.floor(F.col("offset") / 1000) == k // 2))
        part.coalesce(1).sortWithinPartitions("offset").write.mode("append").partitionBy("topic").parquet(path)
    index.write_blocks(spark, path, 100)
    held, blocks = b.read_archive(spark, path), b.read_blocks(spark, path)
    first = index.first_late_blocks(blocks, T0 + timedelta(minutes=1234))
    assert sorted(r["stop"] - r["start"] for r in first.collect())[-1] <= 200
    near = held.filter(index_test(first))
    assert scanned(near.select("offset"))[0] <= 1000  # of 4,000: the files that hold the blocks


def index_test(first):
    from bustrace.operators.predicates import in_partition_ranges

    return in_partition_ranges(first)


def test_appended_files_are_indexed_once(spark, raw, tmp_path):
    path = str(tmp_path / "a")
    b.write_archive(raw.filter("offset < 300"), path)
    b.write_archive(raw.filter("offset >= 300"), path, mode="append")
    blocks = b.read_blocks(spark, path)
    assert blocks.agg(F.sum("n")).first()[0] == raw.count()
    assert rows_of(b.watermarks(raw, blocks=blocks)) == rows_of(b.watermarks(raw))


def test_an_archive_without_an_index(spark, raw, tmp_path):
    raw.write.partitionBy("topic").parquet(str(tmp_path / "plain"))
    assert b.read_blocks(spark, str(tmp_path / "plain")) is None


def test_the_bus_uses_its_indexes(spark, raw, archive):
    bus = b.Bus(archive[0], blocks=archive[1], index=b.build_index(raw))
    assert bus.search_messages("k70", topics=["orders"], time_from=T0, mode="seek").count() == 1
    assert bus.correlate_messages(b.enrich(raw.filter("offset = 30")), ["orders"]).count() >= 1


@pytest.mark.parametrize("field", ["value:a.b", "value:x", "value:é", 'value:q"q', "value:"])
def test_many_keys_are_found_below_any_name(spark, bus, field):
    docs = ['{"a":{"b":"1"},"x":"2"}', '{"\\u0061":{"b":"1"}}', '{"é":"1","q\\"q":"2"}', '{"\\u00e9":"2","":"1"}', '{"b":"1"}', "broken", None]
    raw = bus(*[message("t", o, d) for o, d in enumerate(docs)])
    keys = spark.createDataFrame([("1",), ("2",)], "key string")
    found = sorted(r["offset"] for r in b.search_many(raw, keys, key_field=field).collect())
    single = [r["offset"] for k in ("1", "2") for r in b.search_messages(raw, k, key_field=field).collect()]
    assert found == sorted(single)


def test_an_empty_archive(spark, raw, tmp_path):
    b.write_archive(raw.limit(0), str(tmp_path / "a"))
    assert b.watermarks(raw.limit(0), blocks=b.read_blocks(spark, str(tmp_path / "a"))).count() == 0
