"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the words, neighbouring pairs and pairs with one or two words between them that occur in a text, hashed to
``BUCKET_BITS`` bits. The features are made where the texts are; FTRL with per-coordinate rates and L1 then runs over
the rows of a bounded sample in the order of a hash. L1 leaves few weights, so the model travels with the tasks that
score.

Defined results: a null or empty text has the score of the bias alone; rows whose label or id is null don't train, a
row with several labels counts as toxic if one says so; without labelled rows of both kinds the score is the share of
toxic ones (0 without any); null ids are not held out; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bustrace.llm.batches import bounded_batches

BUCKET_BITS = 20
SAMPLE_ROWS = 8000  # expected number of training rows of each label at most
RARE_WEIGHT = 0.4  # the toxic rows of the sample weigh at least so much of what the others do
EPOCHS = 6
ALPHA, BETA, L1, L2 = 2.0, 1.0, 10.0, 0.1
WORD = re.compile(r"[^\W_]+")
HELD = 1 << 18

_GAPS = (1, 2, 3)
_MIX = tuple(np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_SHIFT = np.uint64(64 - BUCKET_BITS)
_BIAS = 0  # this bucket is the bias

_words: dict[str, int] = {}


def features(text: str) -> np.ndarray:
    """Distinct buckets of a text, the bias included."""
    found = WORD.findall(text.lower())
    if len(_words) > HELD:
        _words.clear()
    hashes = np.empty(len(found), np.uint64)
    for i, word in enumerate(found):
        h = _words.get(word)
        if h is None:
            h = _words[word] = xxhash.xxh64_intdigest(word)
        hashes[i] = h
    parts = [hashes * _MIX[0] >> _SHIFT]
    for gap, mix in zip(_GAPS, _MIX, strict=True):
        left, right = hashes[:-gap] if len(hashes) > gap else hashes[:0], hashes[gap:]
        parts.append(((left ^ (left >> np.uint64(29))) * mix + right) * _MIX[1] >> _SHIFT)
    return np.unique(np.concatenate([np.array([_BIAS], np.uint64), *parts]))


def train(rows: list[np.ndarray], labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over the rows in their order: (buckets, weights) that are not zero."""
    z, n = np.zeros(1 << BUCKET_BITS), np.zeros(1 << BUCKET_BITS)

    def solved(at) -> np.ndarray:
        strength = np.where(at == _BIAS, 0.0, L1)
        shrunk = np.sign(z[at]) * strength - z[at]
        return np.where(np.abs(z[at]) <= strength, 0.0, shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for at, label, weight in zip(rows, labels, weights, strict=True):
            w = solved(at)
            g = (1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label) * weight
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    every = np.arange(1 << BUCKET_BITS)
    w = solved(every)
    (kept,) = w.nonzero()
    return kept, w[kept]


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> tuple[np.ndarray, np.ndarray]:
    """The model (buckets, weights) of the labelled documents."""
    bounded_batches(docs.sparkSession)
    labels = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    labels = labels.groupBy(F.col(id_col).alias("__id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("__toxic"))
    number = {r["__toxic"]: r["n"] for r in labels.groupBy("__toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(number) < 2:
        only = np.array([30.0 if 1 in number else -800.0])
        return np.array([_BIAS]), only
    share = {label: min(1.0, SAMPLE_ROWS / n) for label, n in number.items()}
    chosen = F.when(F.col("__toxic") == 1, F.lit(share[1])).otherwise(F.lit(share[0]))
    toxic_weight = max(1.0, RARE_WEIGHT * number[0] * share[0] / (number[1] * share[1]))
    weight = F.when(F.col("__toxic") == 1, F.lit(toxic_weight)).otherwise(F.lit(1.0)).alias("__weight")
    order = F.xxhash64(F.lit("toxicity"), "__id")
    sample = labels.withColumn("__order", order).filter(F.pmod("__order", F.lit(1 << 30)) < chosen * (1 << 30))
    sample = F.broadcast(sample.select("__id", "__toxic", weight, "__order"))  # 2 * SAMPLE_ROWS small rows
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(sample, "__id")
    rows = rows.dropDuplicates(["__id"]).select("__order", "__toxic", "__weight", "__text")

    def featured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            found = [features(x or "").astype(np.uint32).tobytes() for x in f["__text"]]
            yield pd.DataFrame({"o": f["__order"], "y": f["__toxic"], "w": f["__weight"], "x": found})

    def trained(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [f for f in frames if len(f)]
        if not parts:
            return
        frame = pd.concat(parts).sort_values("o")
        found = [np.frombuffer(x, np.uint32) for x in frame["x"]]
        bucket, weight = train(found, frame["y"].to_numpy(float), frame["w"].to_numpy(float))
        yield pd.DataFrame({"bucket": bucket, "weight": weight})

    ready = rows.mapInPandas(featured, "o long, y int, w double, x binary")
    # One task: FTRL goes through the sample row by row, and the sample is bounded.
    weights = ready.repartition(1).mapInPandas(trained, "bucket long, weight double").toPandas()  # few, by L1
    if weights.empty:  # no text has a label
        return np.array([_BIAS]), np.array([-800.0])
    return weights["bucket"].to_numpy(np.int64), weights["weight"].to_numpy(np.float64)


def score(
    docs: DataFrame,
    model: tuple[np.ndarray, np.ndarray],
    text_col: str = "text",
    names: tuple[str, str] = ("score", "predicted"),
) -> DataFrame:
    """``docs`` with the score and whether it is at least a half (1 or 0), in columns of these names."""
    buckets, weights = model
    schema = T.StructType(list(docs.schema)).add(names[0], "double").add(names[1], "integer")
    place = docs.columns.index(text_col)
    bounded_batches(docs.sparkSession)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << BUCKET_BITS)
        table[buckets] = weights
        for batch in batches:
            logit = np.array([table[features(x.as_py() or "")].sum() for x in batch.column(place)], float)
            found = 1 / (1 + np.exp(-np.clip(logit, -700, 700)))
            more = [pa.array(found, pa.float64()), pa.array((found >= 0.5).astype(np.int32), pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=schema.names)

    return docs.mapInArrow(scored, schema)
