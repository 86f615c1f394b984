"""The inverted reference table: the same correlations with and without it, appended ranges, and what a scan reads."""

import json
import re
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import message
from pyspark.sql import functions as F
from test_correlate import chains, random_bus

import bustrace as b
from bustrace import session
from bustrace.functions.identifiers import correlation_ids, references, required_text
from bustrace.model import COORDS
from bustrace.plans import correlate as plan
from bustrace.sources import references as table


def trace_rows(df):
    return sorted(
        (r["topic"], r["offset"], tuple(r["correlation_chain"]), str(r["correlation_details"]), r["correlation_level"], bytes(r["raw"]))
        for r in df.collect()
    )


def some_bus(bus, seed):
    return bus(*[message(t, o, json.dumps(v), key=k, headers=h) for t, o, k, h, v in random_bus(seed)])


@pytest.mark.parametrize("seed, options", [(1, {}), (2, {"max_depth": 2, "bidirectional": True}), (3, {"max_depth": 3, "max_breadth": 2})])
def test_same_rows_with_a_written_index(spark, bus, tmp_path, seed, options):
    raw = some_bus(bus, seed)
    b.write_index(raw, str(tmp_path / "index"), buckets=5)
    seeds = b.enrich(raw.filter("topic = 'a' and offset < 3"))
    without = b.correlate(raw, seeds, ["b", "c", "a"], **options)
    found = b.correlate(raw, seeds, ["b", "c", "a"], index=b.read_index(spark, str(tmp_path / "index")), **options)
    assert trace_rows(found) == trace_rows(without)
    limited = {"limit": 7, **options}
    assert trace_rows(b.correlate(raw, seeds, ["b", "c"], index=b.build_index(raw), **limited)) == trace_rows(
        b.correlate(raw, seeds, ["b", "c"], **limited)
    )


def test_payload_identifiers_with_an_index(bus):
    raw = bus(
        message("a", 0, {"note": "ref=X1"}, key="s"),
        message("b", 1, {"order_id": "X1", "note": "ref=X2"}),
        message("c", 2, {"order_id": "X2"}),
    )
    seeds = b.enrich(raw.filter("topic = 'a'"))
    options = {"regex_patterns": [r"ref=(\w+)"], "max_depth": 2}
    found = b.correlate(raw, seeds, ["b", "c"], index=b.build_index(raw), **options)
    assert chains(found)["c", 0, 2] == ["X1", "X2"]
    assert trace_rows(found) == trace_rows(b.correlate(raw, seeds, ["b", "c"], **options))


def test_no_message_is_decoded_twice(bus, monkeypatch):
    """Three hops: one decode of the follow topics for the references, and one of the hits."""
    raw = bus(
        message("a", 0, {"order_id": "o1"}, key="s"),
        message("b", 1, {"order_id": "o1", "trace_id": "t1"}),
        message("b", 2, {"trace_id": "t1", "session_id": "s1"}),
        message("b", 3, {"session_id": "s1"}),
    )
    seeds, calls = b.enrich(raw.filter("topic = 'a'")), []
    monkeypatch.setattr(plan, "decode", lambda df, *a, **k: (calls.append("hits"), b.decode(df, *a, **k))[1])
    monkeypatch.setattr(table, "decode", lambda df, *a, **k: (calls.append("references"), b.decode(df, *a, **k))[1])
    found = b.correlate(raw, seeds, ["b"], max_depth=3)
    assert {r["offset"]: r["correlation_level"] for r in found.filter("topic = 'b'").collect()} == {1: 1, 2: 2, 3: 3}
    assert calls == ["references", "hits"]


def test_rows_are_those_of_the_messages(bus):
    raw = some_bus(bus, 5)
    index = b.build_index(raw)
    names = [*COORDS, "kind_rank", "field_rank", "field", "ref_id"]
    wanted = references(b.decode(b.normalize(raw)), [], True).select(*names)
    assert sorted(index.references.select(*names).collect()) == sorted(wanted.collect())
    own = index.identifiers.select(*COORDS, F.explode("ids").alias("i")).select(*COORDS, "i.id", "i.method")
    assert sorted(own.collect()) == sorted(correlation_ids(b.enrich(raw)).collect())


def test_ranges_are_appended_once(spark, bus, tmp_path):
    path = str(tmp_path / "index")
    rows = [message("a", o, {"order_id": f"o{o % 7}"}, key=f"k{o}", partition=o % 2) for o in range(60)]
    rows += [message("b", o, {"order_id": f"o{o}"}) for o in range(5)]
    raw = bus(*rows)
    b.write_index(raw.filter("topic = 'a' and offset < 20"), path, buckets=4)
    b.append_index(raw.filter("offset < 40"), path)
    b.append_index(raw.filter("offset < 40"), path)  # offered twice
    b.append_index(raw, path)
    index, whole = b.read_index(spark, path), b.build_index(raw)
    names = [c for c in whole.references.columns]
    assert sorted(index.references.select(*names).collect()) == sorted(whole.references.collect())
    assert sorted(index.identifiers.collect()) == sorted(whole.identifiers.select(*index.identifiers.columns).collect())
    assert {tuple(r) for r in table.covered(spark, path).collect()} == {("a", 0, 0, 59), ("a", 1, 1, 60), ("b", 0, 0, 5)}
    assert index.unique


def test_an_index_knows_whether_places_are_unique(spark, bus, tmp_path):
    raw = bus(message("a", 0, {"order_id": "x"}), message("b", 1, {"order_id": "x"}), message("b", 1, {"order_id": "x", "n": 1}))
    b.write_index(raw, str(tmp_path / "index"))
    index = b.read_index(spark, str(tmp_path / "index"))
    assert not index.unique
    found = b.correlate(raw, b.enrich(raw.filter("topic = 'a'")), ["b"], index=index)
    assert found.count() == 2


def test_few_ids_read_their_buckets_only(spark, bus, tmp_path):
    raw = bus(*[message("a", o, {"order_id": f"o{o}"}) for o in range(200)])
    path = tmp_path / "index"
    b.write_index(raw, str(path), buckets=8)
    index = b.read_index(spark, str(path))
    frontier = spark.createDataFrame([("o7",)], "ref_id string")
    rows = index.found_by(frontier, ["o7"], ["a"], False)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = rows._jdf.queryExecution().explainString(mode)
    assert "PartitionFilters: [isnotnull(bucket" in text and "EqualTo(ref_id,o7)" in text.split("PushedFilters: ")[1]
    assert [r["ref_id"] for r in rows.collect()] == ["o7"]
    files = list(path.glob("references/bucket=*/*.parquet"))
    assert len({f.parent for f in files}) == 8
    column = pq.ParquetFile(files[0]).metadata.row_group(0)
    names = [column.column(i).path_in_schema for i in range(column.num_columns)]
    assert "ref_id" in names


def test_other_fields_need_another_index(bus):
    raw = bus(message("a", 0, {"x": 1}))
    with pytest.raises(ValueError, match="other identifier"):
        b.correlate(raw, b.enrich(raw), ["a"], id_fields=["x"], index=b.build_index(raw))


def test_ids_left_out_are_counted(bus):
    raw = bus(
        message("a", 0, {"order_id": "o1", "trace_id": "t1", "session_id": "s1"}),
        message("b", 1, {"order_id": "o1", "request_id": "r1", "span_id": "p1"}),
        message("b", 2, {"span_id": "p1"}),
    )
    seeds = b.enrich(raw.filter("topic = 'a'"))
    found = b.correlate(raw, seeds, ["b"], max_depth=2, max_breadth=1)
    assert {r["offset"]: r["ids_left_out"] for r in found.collect()} == {0: 2, 1: 1, 2: 0}
    assert "ids_left_out" not in b.correlate(raw, seeds, ["b"]).columns


def test_hot_id_in_an_index(spark, bus, tmp_path):
    """90 % of the references are one id: its bucket is written by many tasks, in files of like size."""
    rows = [message("a", o, {"order_id": "hot" if o % 10 else f"o{o}"}) for o in range(4000)]
    path = tmp_path / "index"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows are few
    try:
        b.write_index(bus(*rows), str(path), buckets=4)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = sorted(pq.ParquetFile(f).metadata.num_rows for f in path.glob("references/bucket=*/*.parquet"))
    assert sum(sizes) == 4000 and sizes[-1] <= 2 * 4000 / 4
    seed = b.enrich(bus(message("s", 0, {"order_id": "hot"})))
    assert b.correlate(bus(*rows), seed, ["a"], index=b.read_index(spark, str(path))).count() == 3601


@pytest.mark.parametrize("topics", [["b"], ["nowhere"]])
def test_nothing_is_found(spark, bus, monkeypatch, topics):
    monkeypatch.setattr(session, "BROADCAST_BYTES", -1)
    raw = bus(message("a", 0, {"order_id": "o1"}, key="s"), message("b", 1, {"order_id": "o2"}))
    seeds = b.enrich(raw.filter("topic = 'a'"))
    for index in (None, b.build_index(raw)):
        for depth in (1, 3):
            assert chains(b.correlate(raw, seeds, topics, max_depth=depth, index=index)) == {("a", 0, 0): []}
    assert b.correlate(raw, seeds.limit(0), topics, max_depth=2).count() == 0


@pytest.mark.parametrize(
    "pattern, text",
    [
        (r"SUP-(\d+)", "SUP-"),
        (r"(CUST)-(\d+)", "CUST"),
        ('"PROD-[0-9]+"', '"PROD-'),
        ("ab*c", "a"),
        ("a?b", None),
        ("(ab)?c", None),
        ("(?i)ab", None),
        ("ab|c", None),
        (r"\d+ab", None),
        ("ab{0}c", "a"),
        ("(ab)+c", "ab"),
    ],
)
def test_text_that_a_match_begins_with(pattern, text):
    assert required_text(pattern) == text


def test_ids_without_the_standard_ones_need_no_evidence(bus):
    rows = [message("t", i, {"order_id": f"ORD-{i}", "note": n}, headers={"h": "REF-9"}) for i, n in enumerate(["REF-1 REF-1", "none"])]
    messages, patterns = b.enrich(bus(*rows)), [r"REF-\d+", "(?i)rd-[0-9]"]
    found = correlation_ids(messages, regex_patterns=patterns, standard=False)
    assert sorted(found.collect()) == sorted(
        correlation_ids(messages, regex_patterns=patterns).filter("method <> 'standard'").collect()
    )
    assert [(r["offset"], r["id"]) for r in found.filter("method like '%REF%'").orderBy("offset", "id").collect()] == [
        (0, "REF-1"), (0, "REF-9"), (1, "REF-9"),
    ]
    assert "msisdn" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_standard_ids_take_only_named_members_out_of_a_value(bus):
    found = correlation_ids(b.enrich(bus(message("t", 0, {"traceId": 1.5, "order_id": "A", "x": {"y": 1}, "span_id": None}))))
    assert [r["id"] for r in found.collect()] == ["A", "1.5"]
    assert "map<string,variant>" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_rank_of_header_names(bus):
    """Ranks are places in the list of names, also of names that hold a comma."""
    raw = bus(message("t", 0, {"c": 1}, key=None, headers={"b": "x", "a,b": "y"}))
    for fields in (["a", "b", "c"], ["a,b", "b", "c"]):
        rows = references(b.decode(b.normalize(raw)), [], id_fields=fields).collect()
        ranks = {r["field"]: r["kind_rank"] for r in rows}
        expected = {f"header:{n}": i + 1 for i, n in enumerate(fields) if n in ("b", "a,b")}
        assert ranks == {**expected, "value:c": 3 + 2 + 1}


def test_a_text_is_made_once(bus):
    """The test for null keys holds no text of a member; names are not looked up one by one."""
    raw = bus(message("t", 0, {"order_id": "O-1"}, key=None))
    rows = references(b.decode(b.normalize(raw)), [], bidirectional=True)
    assert [(r["field"], r["ref_id"]) for r in rows.collect()] == [("value:order_id", "O-1")]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    tests = [line for line in plan.splitlines() if re.match(r"\W*(\(\d+\) )?Filter ", line)]
    assert tests and not any("schemaOfVariant" in line for line in tests)
    assert "array_position" not in plan


def stored_folders(spark):
    root = Path(session.scratch_path(spark, "none").removeprefix("file:")).parent
    return {f.name for f in root.iterdir()} if root.exists() else set()


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


@pytest.mark.parametrize("sliced_rows", [0, 2_000_000])
def test_an_index_leaves_nothing_beside_it(spark, bus, tmp_path, monkeypatch, sliced_rows):
    """Decoded rows and shuffle files go; slices hold the same rows, those of messages without any id too."""
    monkeypatch.setattr(table, "SLICED_ROWS", sliced_rows)
    path, before = str(tmp_path / "index"), (stored_folders(spark), shuffle_files(spark))
    raw = some_bus(bus, 6).unionByName(bus(message("z", 0, {"phone": 5}), message("z", 1, None, key="k"), message("z", 2)))
    b.write_index(raw.filter("offset < 20"), path, buckets=11)
    b.append_index(raw, path)
    assert stored_folders(spark) == before[0]
    whole, index = b.build_index(raw), b.read_index(spark, path)
    names = whole.references.columns
    held = index.references.withColumn("same", F.col("bucket") == table.bucket_of("ref_id", 11))
    assert held.filter("not same").count() == 0
    expected = whole.references.join(table.covered(spark, path), ["topic", "partition"], "left_semi").select(*names)
    assert sorted(index.references.select(*names).collect()) == sorted(expected.collect())
    codecs = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in Path(path).glob("*/*/*.parquet")}
    assert codecs == {"ZSTD"}


def test_stored_tables_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    with session.compact():
        rows = session.store(spark.range(1000).repartition(3, "id"), "shuffled")
    left = {f for f in shuffle_files(spark) - before if f.endswith(".data")}
    assert not left and rows.count() == 1000


@pytest.mark.parametrize(
    "seed, options, buckets",
    [(7, {}, None), (8, {"max_depth": 3, "bidirectional": True}, 64), (8, {"max_depth": 2, "limit": 40}, 3), (8, {"max_depth": 2}, None)],
)
def test_many_ids_are_followed_in_slices(spark, bus, tmp_path, monkeypatch, seed, options, buckets):
    raw = some_bus(bus, seed)
    index = None
    if buckets:
        b.write_index(raw, str(tmp_path / "index"), buckets=buckets)
        index = b.read_index(spark, str(tmp_path / "index"))
    seeds, topics = b.enrich(raw.filter("topic = 'a' and offset < 3")), ["b", "c", "a"]
    expected = trace_rows(b.correlate(raw, seeds, topics, index=index, **options))
    calls, sliced = [], plan._discover_in_slices
    monkeypatch.setattr(plan, "_discover_in_slices", lambda *a: (calls.append(a), sliced(*a))[1])
    monkeypatch.setattr(plan, "SLICED_BYTES", -1)
    monkeypatch.setattr(session, "BROADCAST_BYTES", -1)
    assert trace_rows(b.correlate(raw, seeds, topics, index=index, **options)) == expected and calls
    none = b.correlate(raw, seeds, ["nowhere"], index=index, **options)
    assert none.count() == min(seeds.count(), options.get("limit", 99))
