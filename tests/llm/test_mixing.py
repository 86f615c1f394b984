import pytest

from bustrace.llm import mixing
from llm.conftest import ODD, words_of


def water_levels(sizes, weights, most):
    """Targets by the plain rule: clamp what is above, share the rest by weight, again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, clamped = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in clamped)
        open_weight = sum(weight[s] for s in names if s not in clamped)
        target = {s: most * sizes[s] if s in clamped else rest * weight[s] / open_weight for s in names}
        above = {s for s in names if target[s] > most * sizes[s]} - clamped
        if not above or not total:
            return target
        clamped |= above


def check(rows, found):
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words_of(text))
    target = water_levels(sizes, mixing.WEIGHTS, mixing.MAX_EPOCHS)
    taken = dict.fromkeys(sizes, 0)
    assert len(found) == len(rows)
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert r["taken"] == r["whole"] * r["size"] + r["part"]
        taken[r["source"]] += r["taken"]
    for source in sizes:
        assert abs(taken[source] - target[source]) < 2  # repeated rows share a remainder


def test_targets_and_words(odd):
    found = mixing.mix(odd).collect()
    check(ODD, found)
    assert sorted(map(repr, found)) == sorted(map(repr, mixing.mix(odd.repartition(5)).collect()))


def test_hot_source_and_small_ones(docs):
    rows = [(i, "w " * (i % 7 + 1), "en", "big") for i in range(900)] + [(2000 + i, "w " * 9, "en", f"s{i % 5}") for i in range(60)]
    check(rows, mixing.mix(docs(*rows)).collect())


def test_documents_are_repeated_as_planned(docs):
    rows = [(i, f"a{i} b c d", "en", "x") for i in range(10)] + [(20, "lone words here", "en", "y"), (21, "", "en", "y")]
    table = docs(*rows, clash=True)
    plan = {r["doc_id"]: r for r in mixing.mix(table).collect()}
    mixed = mixing.mixed_documents(table)
    assert mixed.columns == table.columns
    for i, text, *_ in rows:
        got = [r["text"] for r in mixed.filter(f"doc_id = {i}").collect()]
        part = plan[i]["part"]
        assert got == [text] * (plan[i]["whole"] + (part > 0 and 2 * part >= plan[i]["size"]))


def test_texts_are_never_cut(docs):
    rows = [(i, f"one  two\n{'x ' * (i % 9 + 1)}", "en", f"s{i % 2}") for i in range(50)] + [(99, "word " * 3000, "en", "s2")]
    mixed = mixing.mixed_documents(docs(*rows)).collect()
    assert {r["text"] for r in mixed} <= {r[1] for r in rows}
    target = {r["source"]: r["target"] for r in mixing.mix(docs(*rows)).collect()}
    for source, words in target.items():
        taken = sum(len(words_of(r["text"])) for r in mixed if r["source"] == source)
        assert abs(taken - words) <= max(len(words_of(r[1])) for r in rows if r[3] == source) / 2 + 1


def test_repeated_and_null_ids_are_mixed(odd):
    times = {}
    for r in mixing.mix(odd).collect():
        n = r["whole"] + (r["part"] > 0 and 2 * r["part"] >= r["size"])
        times[r["doc_id"], r["source"], r["size"]] = times.get((r["doc_id"], r["source"], r["size"]), 0) + n
    mixed = {}
    for r in mixing.mixed_documents(odd).collect():
        key = r["doc_id"], r["source"], len(words_of(r["text"]))
        mixed[key] = mixed.get(key, 0) + 1
    assert mixed == {k: n for k, n in times.items() if n}


def test_nothing_to_mix(docs):
    assert mixing.mix(docs()).collect() == []
    assert mixing.mixed_documents(docs()).collect() == []
    assert [r["taken"] for r in mixing.mix(docs((1, None), (2, " "))).collect()] == [0, 0]
