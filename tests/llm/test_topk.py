import math
import random

import pytest
from pyspark.sql import functions as F

from bustrace.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, k):
    ok = {}
    whole = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = [math.floor(1024 * x) for x in v]
        whole.append((i, ints))
        if i % 100 == 0:
            ok[i] = min(ok.get(i, ints), ints)
    out = []
    for q, a in ok.items():
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in whole if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.fixture
def search(spark):
    def run(rows, k=10):
        table = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA).repartition(3)
        return sorted(tuple(r) for r in topk.top_k(table, F.col("vec_id") % 100 == 0, k=k).collect())

    return run


def vectors(n, dim=6, seed=1):
    rng = random.Random(seed)
    return [(i, [rng.randint(-64, 64) / 64 for _ in range(dim)]) for i in range(n)]


def test_against_brute_force(search):
    rows = vectors(450)
    assert search(rows) == brute(rows, 10)


def test_many_ties_go_to_the_smallest_ids(search, monkeypatch):
    monkeypatch.setattr(topk, "ROWS_PER_BLOCK", 32)
    rows = vectors(300) + [(1000 - i, [1.0] * 6) for i in range(400)]
    assert search(rows) == brute(rows, 10)


def test_blocks_of_queries_and_shuffled_meeting(search, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES_PER_BLOCK", 2)
    monkeypatch.setattr(topk, "BROADCAST_BYTES", 0)
    rows = vectors(900)
    assert search(rows, 3) == brute(rows, 3)


def test_odd_rows(search):
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.25]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0])]
    rows += [(None, [1.0, 1.0]), (5, [0.5]), (6, []), (7, [-0.3, 0.1]), (7, [-0.3, 0.1]), (100, [3.0, 2.0, 1.0])]
    assert search(rows) == brute(rows, 10)
    assert search([]) == []
    assert search([(100, [1.0])]) == []
