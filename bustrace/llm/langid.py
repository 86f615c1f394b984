"""Language identification with error-correcting output codes.

Every learned language has a codeword; one binary classifier per bit is the log odds of hashed letter n-grams between
the languages whose codewords have the bit and those that don't, estimated on all training rows by summed counts. A
text's margins are decoded to the codeword with the smallest loss, in which each bit weighs as much as it was right for
that language on a bounded sample of the training rows. A small lead over the second codeword marks the text ambiguous.

Texts are lower-cased and everything but letters separates words, so marks, digits and case make no difference.

Defined results: a text that is null or has no letter is ``und`` with score 0; without training rows every text is
``und``; with one language that is the answer for every other text; null ids take no part in training and are not held
out; repeated rows count as often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bustrace.llm.batches import bounded_batches

UNDETERMINED = "und"
BUCKET_BITS = 15
CALIBRATION_ROWS = 4000  # expected number of training rows on which the bits' accuracy is measured
SHARPNESS = 24.0  # margin per n-gram to logit
AMBIGUOUS = 0.05  # lead in mean loss below which a text is ambiguous
TEXTS_AT_ONCE = 64

_BUCKETS = 1 << BUCKET_BITS
_MULTIPLIERS = tuple(np.uint32(m) for m in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str) -> np.ndarray | None:
    """Hashed counts of the 1- to 3-grams of letters and word ends; None without any letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return None
    before = np.concatenate([[True], letter[:-1]])
    kept = np.where(letter, points, np.uint32(32))[letter | before]
    kept = np.concatenate([[32], kept, [32]]).astype(np.uint32)
    first = kept * _MULTIPLIERS[0]
    pair = (first[:-1] ^ (first[:-1] >> np.uint32(15))) * _MULTIPLIERS[1] + first[1:]
    triple = (pair[:-1] ^ (pair[:-1] >> np.uint32(13))) * _MULTIPLIERS[2] + first[2:]
    shift = np.uint32(32 - BUCKET_BITS)
    hashed = np.concatenate([x * _MULTIPLIERS[1] >> shift for x in (first, pair, triple)])
    return np.bincount(hashed, minlength=_BUCKETS)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """One row of -1 and 1 per class: all splits of up to seven classes, else the best separated of random codes."""
    if n <= 1:
        return np.ones((n, 0))
    if n <= 7:
        splits = [(1, *rest) for rest in product((1, -1), repeat=n - 1)][1:]
        return np.array(splits, float).T
    rng = np.random.default_rng(seed)
    best, apart = None, -1.0
    for _ in range(100):
        code = rng.choice((-1.0, 1.0), (n, math.ceil(15 * math.log2(n))))
        near = (code @ code.T - 2.0 * code.shape[1] * np.eye(n)).max()
        if best is None or code.shape[1] - near > apart:
            best, apart = code, code.shape[1] - near
    return best


class Model:
    """Languages, codewords, the bits' n-gram weights and what each bit weighs for each language."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.languages = sorted(counts)
        self.code = codewords(len(self.languages))
        if not self.languages:
            return
        share = np.array([(counts[x] + 0.5) / (counts[x].sum() + 0.5 * _BUCKETS) for x in self.languages])
        has, not_has = self.code > 0, self.code < 0
        odds = [np.log(share[h].mean(axis=0)) - np.log(share[n].mean(axis=0)) for h, n in zip(has.T, not_has.T, strict=True)]
        self.weights = np.array(odds, np.float32).reshape(self.code.shape[1], _BUCKETS).T
        self.trust = np.ones(self.code.shape)

    def calibrate(self, right: dict[str, np.ndarray]) -> None:
        """``right``: per language, the share of its sample rows that each bit had right."""
        for i, language in enumerate(self.languages):
            if language in right:
                self.trust[i] = np.maximum(right[language] - 0.5, 0.01)

    def margins(self, counts: np.ndarray) -> np.ndarray:
        return counts.astype(np.float32) @ self.weights / counts.sum(axis=1, keepdims=True)

    def decode(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the language, score, lead over the second in mean loss) of each row of counts."""
        n = len(counts)
        if len(self.languages) == 1:
            return np.zeros(n, int), np.ones(n), np.full(n, np.inf)
        agree = self.margins(counts)[:, None, :] * self.code[None] * SHARPNESS
        loss = np.logaddexp(0, -agree)
        loss = (loss * self.trust[None]).sum(axis=2) / self.trust.sum(axis=1)
        order = np.argsort(loss, axis=1, kind="stable")
        lead = np.take_along_axis(loss, order[:, 1:2], 1)[:, 0] - np.take_along_axis(loss, order[:, :1], 1)[:, 0]
        likely = np.exp(-(loss - loss.min(axis=1, keepdims=True)) * self.code.shape[1])
        return order[:, 0], (likely.max(axis=1) / likely.sum(axis=1)).clip(0, 1), lead


def _counted(texts: pa.Array) -> Iterator[tuple[list[int], np.ndarray]]:
    """Places and n-gram counts of the texts that have letters, some at a time."""
    at: list[int] = []
    rows: list[np.ndarray] = []
    for i, text in enumerate(texts):
        counts = ngram_counts(text.as_py() or "")
        if counts is not None:
            at.append(i)
            rows.append(counts)
        if len(rows) == TEXTS_AT_ONCE:
            yield at, np.array(rows)
            at, rows = [], []
    if rows:
        yield at, np.array(rows)


def learn(training: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model of the rows with a language. What reaches the driver is bounded by languages times buckets."""
    bounded_batches(training.sparkSession)
    labelled = training.filter(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col).alias("h")
    )

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(_BUCKETS, np.int64))
        rows: dict[str, int] = defaultdict(int)
        for batch in batches:
            languages = batch.column(0).to_pylist()
            for at, counts in _counted(batch.column(1)):
                for i, row in zip(at, counts, strict=True):
                    total[languages[i]] += row
                    rows[languages[i]] += 1
        for language, counts in total.items():
            (bucket,) = counts.nonzero()
            frame = {"lang": language, "bucket": bucket.astype(np.int32), "n": counts[bucket]}
            frame = pd.concat([pd.DataFrame(frame), pd.DataFrame({"lang": [language], "bucket": [-1], "n": [rows[language]]})])
            yield pa.RecordBatch.from_pandas(frame.astype({"bucket": np.int32}), preserve_index=False)

    counted = labelled.select("lang", "text").mapInArrow(sums, "lang string, bucket int, n long")
    found = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts, n_rows = {}, 0
    for language, part in found.groupby("lang"):
        grams = part[part["bucket"] >= 0]
        counts[language] = np.zeros(_BUCKETS)
        counts[language][grams["bucket"].to_numpy()] = grams["n"].to_numpy()
        n_rows += int(part.loc[part["bucket"] < 0, "n"].sum())
    model = Model(counts)
    if len(model.languages) < 2:
        return model

    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {x: i for i, x in enumerate(model.languages)}
        for batch in batches:
            languages = batch.column(0).to_pylist()
            for at, counted in _counted(batch.column(1)):
                truth = np.array([place[languages[i]] for i in at])
                hit = (model.margins(counted) * model.code[truth]) > 0
                for language in np.unique(truth):
                    of = hit[truth == language]
                    bits = np.arange(of.shape[1], dtype=np.int32)
                    frame = {"lang": model.languages[language], "bit": bits, "hits": of.sum(axis=0), "n": len(of)}
                    yield pa.RecordBatch.from_pandas(pd.DataFrame(frame), preserve_index=False)

    sample = labelled.filter(F.pmod("h", F.lit(1 << 30)) < int(min(1.0, CALIBRATION_ROWS / max(1, n_rows)) * (1 << 30)))
    hits = sample.select("lang", "text").mapInArrow(right, "lang string, bit int, hits long, n long")
    hits = hits.groupBy("lang", "bit").agg((F.sum("hits") / F.sum("n")).alias("share")).toPandas()
    model.calibrate({x: p.sort_values("bit")["share"].to_numpy() for x, p in hits.groupby("lang")})
    return model


def predict(
    docs: DataFrame, model: Model, text_col: str = "text", names: tuple[str, str, str] = ("lang_pred", "score", "ambiguous")
) -> DataFrame:
    """``docs`` with the predicted language, its score and whether it is ambiguous, in columns of these names."""
    schema = T.StructType(list(docs.schema)).add(names[0], "string").add(names[1], "double").add(names[2], "boolean")
    place = docs.columns.index(text_col)
    bounded_batches(docs.sparkSession)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            language = np.full(batch.num_rows, UNDETERMINED, object)
            score, unsure = np.zeros(batch.num_rows), np.ones(batch.num_rows, bool)
            if model.languages:
                known = np.array(model.languages, object)
                for at, counts in _counted(batch.column(place)):
                    best, score[at], lead = model.decode(counts)
                    language[at], unsure[at] = known[best], lead < AMBIGUOUS
            more = [pa.array(language, pa.string()), pa.array(score), pa.array(unsure)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=schema.names)

    return docs.mapInArrow(predicted, schema)


def drop_undetermined(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language can be told, with their columns; all rows where no language was learned.

    Texts without letters go, and those that the decoder flags: their two nearest codewords are less than ``AMBIGUOUS``
    apart in mean loss.
    """
    if not model.languages:
        return docs
    names = ("__lang", "__score", "__ambiguous")
    # Only a text without letters has score 0; the label alone may be a learned one.
    found = predict(docs, model, text_col, names)
    return found.filter((F.col("__score") > 0) & ~F.col("__ambiguous")).drop(*names)
