import hashlib

import pytest

from bustrace.llm import sharding
from llm.conftest import ODD


def check(rows, found, limit):
    assert len(found) == len(rows)
    sums, number = {}, {}
    for r in found:
        sums[r["shard"]] = sums.get(r["shard"], 0) + r["n_bytes"]
        number[r["shard"]] = number.get(r["shard"], 0) + 1
    for r in found:
        assert r["shard_bytes"] == sums[r["shard"]] and r["shard_rows"] == number[r["shard"]]
        assert r["oversize"] == (r["shard_bytes"] > limit)
        assert r["shard_bytes"] <= limit or r["shard_rows"] == 1
        if r["depth"] <= sharding.ID_BITS:
            key = "" if r["doc_id"] is None else str(r["doc_id"])
            bits = bin(int(hashlib.md5(key.encode()).hexdigest()[:15], 16) + (1 << 60))[3:]
            assert r["shard"] == bits[: r["depth"]]
    leaves = sorted({r["shard"].split("-")[0] for r in found})
    assert not any(b.startswith(a) for a, b in zip(leaves, leaves[1:], strict=False))


@pytest.mark.parametrize("limit", [60, 1000, 10**9])
def test_odd_rows(odd, limit):
    check(ODD, sharding.extendible_shards(odd, max_bytes=limit).collect(), limit)


def test_only_oversized_buckets_split(docs):
    rows = [(i, "x" * (i % 50 + 1)) for i in range(600)]
    found = sharding.extendible_shards(docs(*rows), max_bytes=700).collect()
    check(rows, found, 700)
    size = {}
    for r in found:
        for d in range(r["depth"]):
            size[r["shard"][:d]] = size.get(r["shard"][:d], 0) + r["n_bytes"]
    assert all(n > 700 for n in size.values())  # every inner node had to split


def test_one_id_in_very_many_rows(docs):
    rows = [(7, "y" * 40)] * 300 + [(i, "z" * 30) for i in range(100, 130)]
    found = sharding.extendible_shards(docs(*rows), max_bytes=400).collect()
    check(rows, found, 400)


def test_equal_bits_to_the_end(docs, monkeypatch):
    monkeypatch.setattr(sharding, "ROW_BITS", 2)
    rows = [(7, "y" * 40)] * 30
    found = sharding.extendible_shards(docs(*rows), max_bytes=100).collect()
    assert len(found) == 30 and all(r["shard_bytes"] <= 100 for r in found)


def test_directory_and_files(docs, spark, tmp_path):
    table = docs(*[(i, "x" * 20) for i in range(64)])
    shards = sharding.extendible_shards(table, max_bytes=200)
    entries = {r["entry"]: r for r in sharding.directory(shards).collect()}
    deepest = max(r["depth"] for r in entries.values())
    assert sorted(entries) == list(range(2**deepest))
    assert all(bin(e + (1 << deepest))[3:].startswith(r["shard"]) for e, r in entries.items())
    sharding.write_shards(table, shards, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 64


def test_empty_table_and_bad_limit(docs):
    assert sharding.extendible_shards(docs()).collect() == []
    with pytest.raises(ValueError):
        sharding.extendible_shards(docs(), max_bytes=0)


def test_distinct_ids_beyond_24_bits(docs):
    """Two ids that share 24 bits of their hash are split by further bits of it, and alike in every run."""
    seen = {}
    for i in range(60_000):
        front = hashlib.md5(str(i).encode()).hexdigest()[:6]
        if front in seen:
            break
        seen[front] = i
    pair = (seen[front], i)
    rows = [(k, "x" * 60) for k in pair] + [(k, "y" * 10) for k in range(70_000, 70_020)]
    found = sharding.extendible_shards(docs(*rows), max_bytes=100).collect()
    check(rows, found, 100)
    assert all(24 < r["depth"] <= sharding.ID_BITS for r in found if r["doc_id"] in pair)
    again = sharding.extendible_shards(docs(*rows[::-1]).repartition(5), max_bytes=100).collect()
    assert {r["doc_id"]: r["shard"] for r in again} == {r["doc_id"]: r["shard"] for r in found}


def test_directory_of_any_depth(docs):
    rows = [(7, "y" * 40)] * 20 + [(i, "z" * 30) for i in range(100, 130)]
    shards = sharding.extendible_shards(docs(*rows), max_bytes=100)
    with pytest.raises(ValueError, match="directory_ranges"):
        sharding.directory(shards)
    ranges = {r["shard"]: r for r in sharding.directory_ranges(shards).collect()}
    for r in shards.collect():
        h = int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:15], 16)
        assert ranges[r["shard"]]["first"] <= h <= ranges[r["shard"]]["last"]
    own = sorted((r["first"], r["last"]) for r in ranges.values() if r["depth"] <= sharding.ID_BITS)
    assert all(a[1] < b[0] for a, b in zip(own, own[1:], strict=False))
