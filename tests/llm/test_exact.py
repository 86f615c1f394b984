import hashlib
from collections import Counter

import pytest

from bustrace.llm import exact
from llm.conftest import ODD, lowered, rows_of


def expected(rows, keep):
    out = []
    groups = {}
    for r in rows:
        groups.setdefault(lowered(r[1]), []).append(r[0])
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (max if keep == "max" else min)(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        seen = 0
        for i in ids:
            kept = i == best and not seen
            seen += kept
            out.append((i, best, len(ids), kept, sha))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep", ["min", "max"])
def test_groups(odd, keep):
    assert rows_of(exact.exact_groups(odd, keep=keep)) == expected(ODD, keep)


def test_collisions_are_told_apart_by_their_bytes(odd):
    weak = lambda data: bytes([len(data) % 2])
    assert rows_of(exact.exact_groups(odd, keep="max", digest=weak)) == expected(ODD, "max")
    kept = exact.drop_exact_copies(odd, keep="max", digest=weak)
    assert Counter(lowered(r["text"]) for r in kept.collect()) == Counter({lowered(r[1]) for r in ODD})


def test_kept_rows_have_all_columns(odd):
    kept = exact.drop_exact_copies(odd, keep="max")
    assert kept.columns == odd.columns
    assert Counter(lowered(r["text"]) for r in kept.collect()) == Counter({lowered(r[1]) for r in ODD})


def test_empty_table_and_bad_argument(docs):
    assert exact.exact_groups(docs()).collect() == []
    assert exact.drop_exact_copies(docs()).collect() == []
    with pytest.raises(ValueError):
        exact.exact_groups(docs(), keep="first")
