import random

import pytest

from bustrace.llm import components, minhash
from llm.conftest import ODD, lowered, rows_of, words_of


def shingles(text, size=4):
    w = words_of(lowered(text))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, size=4):
    sets = [shingles(r[1], size) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for k in range(i):
            if sets[i] and sets[k] and 100 * len(sets[i] & sets[k]) >= 80 * len(sets[i] | sets[k]):
                parent[root(i)] = root(k)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    out = []
    for i, r in enumerate(rows):
        component = least.get(root(i)) if sets[i] else r[0]
        out.append((r[0], len(sets[i]), component, r[0] == component))
    return sorted(out, key=repr)


def found(df):
    return rows_of(minhash.near_groups(df).drop("set_id", "group"))


def near_copies(n, seed=1, size=60, edits=3):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(size)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(size)] = f"e{rng.randint(0, 10**6)}"
        out.append(" ".join(text))
    return out


def corpus():
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(30))
    texts = near_copies(60) + near_copies(40, seed=2, edits=5) + near_copies(12, seed=3, size=200, edits=12)
    texts += [passage + " " + " ".join(f"u{rng.randint(0, 10**6)}" for _ in range(25)) for _ in range(60)]
    texts += [" ".join(f"s{rng.randint(0, 400)}" for _ in range(50)) for _ in range(60)]
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)]


def test_against_brute_force(docs):
    rows = corpus()
    assert found(docs(*rows)) == brute(rows)


def test_small_blocks_and_hot_pairs(docs, monkeypatch):
    monkeypatch.setattr(minhash, "GROUP_ROWS", 8)
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 16)
    monkeypatch.setattr(minhash, "WITNESSES", 2)
    monkeypatch.setattr(minhash, "BROADCAST_BYTES", 0)
    rows = corpus()
    assert found(docs(*rows)) == brute(rows)


def test_odd_rows(odd):
    assert found(odd) == brute(ODD)
    kept = minhash.drop_near_copies(odd)
    assert kept.columns == odd.columns
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    sets = [shingles(t) for _, t in left]
    assert {frozenset(s) for s in sets} == {frozenset(shingles(r[1])) for r in ODD}
    assert sum(not s for s in sets) == sum(not shingles(r[1]) for r in ODD)
    assert sum(bool(s) for s in sets) == len({frozenset(shingles(r[1])) for r in ODD} - {frozenset()})


def test_one_of_each_group_stays(docs):
    rows = corpus()
    kept = {r["doc_id"] for r in minhash.drop_near_copies(docs(*rows)).collect()}
    assert kept == {r[0] for r in brute(rows) if r[3]}


def test_short_texts_and_empty_table(docs):
    rows = [(1, "a b"), (2, "A  b"), (3, "a b c"), (4, "a"), (5, "a b c d"), (6, "a b c d")]
    assert found(docs(*rows)) == brute(rows)
    assert found(docs()) == []
    assert minhash.drop_near_copies(docs()).collect() == []


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(40)]
    links += [(5000, 5001 + i) for i in range(50)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    least = {x: x for link in links for x in link}
    for _ in range(400):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    alone = {x for x in least if all(a == b for a, b in links if x in (a, b))}
    assert got == {x: c for x, c in least.items() if x not in alone}
