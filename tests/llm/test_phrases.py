import random
import re
from collections import Counter

import numpy as np
import pytest

from bustrace.llm import phrases
from llm.conftest import ODD, lowered


def brute(rows, least=10, most=3, top=2000):
    f, n = {}, Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, most + 1):
                for i in range(len(words) - size + 1):
                    f.setdefault(lang, Counter())[tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        found = []
        for p, a in counts.items():
            if len(p) < 2 or a < least:
                continue
            score, _, l, r = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            covered = any(
                len(q) > len(p) and b >= least and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in counts.items()
            )
            if not covered:
                found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def texts(n, seed=1):
    rng = random.Random(seed)
    words = ["The", "of", "new", "york", "city", "hall", "Ärger", "漢字", "x", "a-b", "\x0bodd", "\x1cz"]
    ends = [" ", " ", " ", " ", "  ", "\t", ", ", ".", "\n", "; "]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice(ends) + ("New York city " if rng.random() < 0.1 else "") for _ in range(40))
        rows.append((i, text, rng.choice(["en", "de", None, "und"])))
    return rows


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_against_brute_force(docs):
    rows = texts(150)
    assert found(phrases.collocations(docs(*rows, clash=True))) == brute(rows)
    assert found(phrases.collocations(docs(*rows), top=5, least=3)) == brute(rows, least=3, top=5)


def test_longer_phrases(docs):
    rows = texts(40, seed=2) + [(99, "one two three four five. " * 12, "en")]
    assert found(phrases.collocations(docs(*rows), most_words=4)) == brute(rows, most=4)


def test_many_blocks_tasks_and_heavy_words(docs, monkeypatch):
    for name, value in {"WORDS_PER_BLOCK": 300, "TEXT_PART": 64, "HELD_WORDS": 5, "SMALL": 8, "ROWS_PER_TASK": 500, "HEAVY": 150, "NUMBERED": 4}.items():
        monkeypatch.setattr(phrases, name, value)
    rows = texts(120, seed=3)
    assert found(phrases.collocations(docs(*rows))) == brute(rows)


def test_full_bitmaps_change_nothing(docs, monkeypatch):
    monkeypatch.setattr(phrases, "MOST_BITS", 1)
    rows = texts(60, seed=4)
    assert found(phrases.collocations(docs(*rows))) == brute(rows)


def test_odd_rows(odd, docs):
    assert found(phrases.collocations(odd, least=2)) == brute(ODD, least=2)
    assert found(phrases.collocations(docs())) == []
    assert found(phrases.collocations(docs((1, None, None), (2, " .,\n", "en")))) == []


def test_quicksort_counts_equal_prefixes(monkeypatch):
    rng = np.random.default_rng(1)
    keys, weights = rng.integers(0, 6, (5000, 3)).astype(np.int32), rng.integers(1, 5, 5000)
    wanted = [Counter(), Counter(), Counter()]
    for k, w in zip(keys.tolist(), weights.tolist(), strict=True):
        for d in range(3):
            wanted[d][tuple(k[: d + 1])] += w
    least = (1, 60, 60)
    for small in (1, 100, 10**6):
        monkeypatch.setattr(phrases, "SMALL", small)
        for d, (at, total) in enumerate(phrases.equal_parts(keys, weights, least)):
            got = dict(zip(map(tuple, keys[at, : d + 1].tolist()), total.tolist(), strict=True))
            assert got == {k: n for k, n in wanted[d].items() if n >= least[d]}


@pytest.mark.parametrize("text", [b"", b"A b.C", b" \t ", b"one,two  three\x0b\x0cfour\x1cfive"])
def test_words(text):
    flat = [w for part in phrases.words_of(text) for w in part]
    pieces = [p.split(phrases.STOP) for p in [b" ".join(flat)]][0]
    wanted = [re.findall(rb"[^\x20\x09]+", p) for p in re.split(rb"[.,;:!?\x0A-\x0D]", text.lower())]
    assert [p.split() for p in pieces] == wanted
