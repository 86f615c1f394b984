import numpy as np
import pytest
from pyspark.sql import functions as F

from bustrace.llm import queries, toxicity
from llm.conftest import ODD

DIR = "/root/testdata/sf0.1"


def test_features_are_words_pairs_and_skips():
    both = toxicity.features("One two")
    assert set(toxicity.features("one TWO")) == set(both)
    assert len(both) == 4  # bias, two words, one pair
    assert len(toxicity.features("a b c d")) == 1 + 4 + 3 + 2 + 1
    assert toxicity.features("").tolist() == [0]
    assert set(toxicity.features("a b")) != set(toxicity.features("b a"))


def test_l1_leaves_few_weights():
    rng = np.random.default_rng(1)
    rows = [np.unique(np.concatenate([[0], rng.integers(10, 5000, 40)])) for _ in range(600)]
    labels = (np.arange(600) % 3 == 0).astype(float)
    rows = [np.append(r, 7) if y else r for r, y in zip(rows, labels, strict=True)]
    bucket, weight = toxicity.train(rows, labels, np.ones(600))
    by_bucket = dict(zip(bucket.tolist(), weight.tolist(), strict=True))
    assert len(by_bucket) < 600 and by_bucket[7] > 3 and by_bucket[0] < 0


def test_held_out_ranking(spark):
    found = queries.op9_toxicity(spark, DIR).join(spark.read.parquet(f"{DIR}/labels.parquet"), "doc_id").toPandas()
    found = found[found["held_out"]]
    rank, toxic = found["score"].rank(), found["toxic"] == 1
    auc = (rank[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert auc >= 0.95
    assert found.loc[~toxic, "predicted"].mean() <= 0.02
    assert found.loc[toxic, "predicted"].mean() >= 0.7


def test_odd_rows(odd, spark):
    labels = spark.createDataFrame(
        [(1, 0), (2, 1), (2, 0), (3, 1), (None, 1), (6, None), (99, 1), (7, 0)], "doc_id long, toxic int"
    )
    model = toxicity.learn(odd, labels)
    found = toxicity.score(odd, model, names=("s", "p")).collect()
    assert len(found) == len(ODD)
    assert all(0 <= r["s"] <= 1 and r["p"] == int(r["s"] >= 0.5) for r in found)


@pytest.mark.parametrize("rows, share", [([], 0.0), ([(1, 0)], 0.0), ([(1, 1)], 1.0)])
def test_one_kind_of_label(docs, spark, rows, share):
    model = toxicity.learn(docs((1, "a b")), spark.createDataFrame(rows, "doc_id long, toxic int"))
    (row,) = toxicity.score(docs((2, "c")), model).collect()
    assert row["score"] == pytest.approx(share, abs=1e-9)


def test_empty_tables(docs, spark):
    model = toxicity.learn(docs(), spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int"))
    assert toxicity.score(docs(), model).collect() == []
    assert toxicity.score(docs((1, None)), model).agg(F.count("score")).first()[0] == 1
