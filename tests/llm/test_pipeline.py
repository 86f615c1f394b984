"""The pipeline, stage by stage, against plain Python."""

from collections import Counter, defaultdict

import corpus_pipeline as pipeline
from bustrace.llm import mixing
from llm.conftest import ODD, lowered
from llm.test_minhash import brute

DIR = "/root/testdata/sf0.001"


def stage(number, spark, docs):
    return pipeline.STAGES[number][1](spark, docs, DIR)


def test_run(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]
    named = stage(0, spark, docs)
    assert Counter(r["doc_id"] for r in named.collect()) == Counter(i for i, t, *_ in rows if any(map(str.isalpha, t or "")))
    rows = [r for r in rows if any(map(str.isalpha, r[1] or ""))]
    last = {}
    for i, t, *_ in rows:
        last[lowered(t)] = max(i, last.get(lowered(t), i))
    exact = stage(1, spark, named)
    assert Counter(r["doc_id"] for r in exact.collect()) == Counter(last.values())
    rows = [r for r in rows if last[lowered(r[1])] == r[0]]
    near = stage(2, spark, exact)
    kept = {r[0] for r in brute(rows, 5) if r[3]}
    assert Counter(r["doc_id"] for r in near.collect()) == Counter(kept)
    rows = [r for r in rows if r[0] in kept]
    mixed = stage(3, spark, near)
    texts = defaultdict(list)
    for r in mixed.collect():
        texts[r["doc_id"]].append(r["text"])
    plan = {r["doc_id"]: r for r in mixing.mix(near).collect()}
    for i, text, *_ in rows:
        whole, part, size = (plan[i][c] for c in ("whole", "part", "size"))
        assert texts[i] == [text] * (whole + (part > 0 and 2 * part >= size))
    for x in (named, exact, near, mixed):
        assert x.columns == docs.columns and x.dtypes == docs.dtypes
    ends = defaultdict(list)
    total = Counter()
    for r in pipeline.run(spark, DIR).collect():
        ends[r["sequence_id"]].append((r["offset"], r["length"]))
        total[r["doc_id"]] += r["length"]
    direct = Counter()
    for r in stage(4, spark, mixed).collect():
        direct[r["doc_id"]] += r["length"]
    assert total == direct
    for pieces in ends.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 1024


def test_odd_rows_go_through_every_stage(spark, odd, docs):
    for table, n in ((odd, len(ODD)), (docs(), 0)):
        for k in range(len(pipeline.STAGES) - 1):
            after = stage(k, spark, table)
            assert after.columns == table.columns
            after.collect()
        assert (stage(4, spark, table).count() >= n) and (n or stage(4, spark, table).count() == 0)


def test_names_and_order():
    assert [name for name, _ in pipeline.STAGES] == [
        "language ID", "exact dedup", "MinHash near-dedup", "mixing sources to target weights", "best-fit packing",
    ]


def test_a_long_blank_run_goes_through(spark, docs):
    rows = [(1, "a" + " " * 1_000_000 + "b", "en", "s"), (2, "plain text", "en", "s"), (3, "schlichter Text", "de", "s")]
    table = docs(*rows)
    for k in range(len(pipeline.STAGES) - 1):
        table = stage(k, spark, table)
    assert {r["text"] for r in table.collect()} <= {r[1] for r in rows}
    pieces = stage(4, spark, docs(*rows)).collect()
    assert sum(r["length"] for r in pieces if r["doc_id"] == 1) > 60_000
