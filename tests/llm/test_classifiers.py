"""Both text classifiers against plain loops over dicts, on whole small tables."""

import math
import re
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from bustrace.llm import langid, queries, toxicity

DIR = "/root/testdata/sf0.001"
M32, M64 = (1 << 32) - 1, (1 << 64) - 1


@pytest.fixture(scope="module")
def rows():
    return pq.read_table(f"{DIR}/documents.parquet").to_pylist()


def crc(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode())


def grams(text):
    """Buckets of the 1- to 3-grams of letters; a blank stands for what is behind a word, or in front of the first one."""
    points, after_letter = [32], True
    for c in text.lower():
        if c.isalpha():
            points.append(ord(c))
        elif after_letter:
            points.append(32)
        after_letter = c.isalpha()
    points.append(32)
    if set(points) == {32}:
        return None
    a, b, c = (int(m) for m in langid._MULTIPLIERS)
    first = [p * a & M32 for p in points]
    pair = [((x ^ x >> 15) * b + y) & M32 for x, y in zip(first, first[1:], strict=False)]
    triple = [((x ^ x >> 13) * c + y) & M32 for x, y in zip(pair, first[2:], strict=False)]
    return Counter((x * b & M32) >> (32 - langid.BUCKET_BITS) for x in (*first, *pair, *triple))


def test_language_by_plain_counts(spark, rows):
    buckets = 1 << langid.BUCKET_BITS
    counts, training = defaultdict(Counter), []
    for r in rows:
        found = grams(r["text"] or "")
        if r["lang"] is not None and crc(r["doc_id"]) % 3 != 1 and found:
            counts[r["lang"]].update(found)
            training.append((r["lang"], found))
    names = sorted(counts)
    code = [[int(x) for x in row] for row in langid.codewords(len(names))]
    share = {x: (lambda total, c=counts[x]: lambda g: (c[g] + 0.5) / (total + 0.5 * buckets))(sum(counts[x].values())) for x in names}

    def margin(found, bit):
        has = [x for x, w in zip(names, code, strict=True) if w[bit] > 0]
        other = [x for x in names if x not in has]
        odds = sum(
            n * (math.log(sum(share[x](g) for x in has) / len(has)) - math.log(sum(share[x](g) for x in other) / len(other)))
            for g, n in found.items()
        )
        return odds / sum(found.values())

    bits = range(len(code[0]))
    right, seen = defaultdict(lambda: [0] * len(bits)), Counter()
    for lang, found in training:
        seen[lang] += 1
        for k in bits:
            right[lang][k] += margin(found, k) * code[names.index(lang)][k] > 0
    trust = {x: [max(right[x][k] / seen[x] - 0.5, 0.01) for k in bits] for x in names}

    def nearest(found):
        margins = [margin(found, k) for k in bits]
        loss = [
            sum(trust[x][k] * math.log1p(math.exp(-margins[k] * w[k] * langid.SHARPNESS)) for k in bits) / sum(trust[x])
            for x, w in zip(names, code, strict=True)
        ]
        return names[loss.index(min(loss))], sorted(loss)[1] - min(loss)

    predicted = {r["doc_id"]: r for r in queries.op3_language_id(spark, DIR).collect()}
    for r in rows:
        found = grams(r["text"] or "")
        if found is None:
            assert predicted[r["doc_id"]]["lang_pred"] == langid.UNDETERMINED
            continue
        best, lead = nearest(found)
        if lead > 1e-3:  # the operator's margins are 32-bit floats
            assert predicted[r["doc_id"]]["lang_pred"] == best
            assert predicted[r["doc_id"]]["ambiguous"] == (lead < langid.AMBIGUOUS) or abs(lead - langid.AMBIGUOUS) < 1e-3


def word_features(text):
    """Words, and pairs of words up to three apart, as buckets; 0 is the bias."""
    hashes = [xxhash.xxh64_intdigest(w) for w in re.findall(r"[^\W_]+", text.lower())]
    mix, shift = [int(m) for m in toxicity._MIX], 64 - toxicity.BUCKET_BITS
    found = {0} | {(h * mix[0] & M64) >> shift for h in hashes}
    for gap in (1, 2, 3):
        for x, y in zip(hashes, hashes[gap:], strict=False):
            found.add((((x ^ x >> 29) * mix[gap - 1] + y) * mix[1] & M64) >> shift)
    return found


def test_toxicity_by_a_plain_loop(spark, rows):
    marks = defaultdict(list)
    for r in pq.read_table(f"{DIR}/labels.parquet").to_pylist():
        if r["doc_id"] is not None and r["toxic"] is not None and crc(r["doc_id"]) % 5 != 0:
            marks[r["doc_id"]].append(int(r["toxic"] > 0))
    label = {i: max(m) for i, m in marks.items()}
    toxic = sum(label.values())
    weight = max(1.0, toxicity.RARE_WEIGHT * (len(label) - toxic) / toxic)
    ids = spark.createDataFrame([(i,) for i in label], "doc_id long")
    order = {r[0]: r[1] for r in ids.select("doc_id", F.xxhash64(F.lit("toxicity"), "doc_id")).collect()}
    text = {r["doc_id"]: r["text"] or "" for r in rows}
    training = [(word_features(text[i]), label[i]) for i in sorted(label, key=order.get) if i in text]
    z, n = defaultdict(float), defaultdict(float)

    def solved(k):
        strength = toxicity.L1 if k else 0.0
        if abs(z[k]) <= strength:
            return 0.0
        return (math.copysign(strength, z[k]) - z[k]) / ((toxicity.BETA + math.sqrt(n[k])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for found, y in training:
            w = {k: solved(k) for k in found}
            p = 1 / (1 + math.exp(-min(30.0, max(-30.0, sum(w.values())))))
            g = (p - y) * (weight if y else 1.0)
            for k in found:
                z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / toxicity.ALPHA * w[k]
                n[k] += g * g
    weights = {k: w for k in z if (w := solved(k))}
    documents = spark.read.parquet(f"{DIR}/documents.parquet")
    labels = spark.read.parquet(f"{DIR}/labels.parquet").filter(queries.remainder("doc_id", 5) != 0)
    model = dict(zip(*(x.tolist() for x in toxicity.learn(documents, labels)), strict=True))
    assert set(model) == set(weights) and all(model[k] == pytest.approx(weights[k], rel=1e-6) for k in weights)
    for r in queries.op9_toxicity(spark, DIR).collect():
        logit = sum(weights.get(k, 0.0) for k in word_features(text[r["doc_id"]]))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-logit)), rel=1e-6)
