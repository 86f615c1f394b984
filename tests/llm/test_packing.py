import random
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from bustrace.llm import packing
from bustrace.llm.vocabulary import ranks_encoder
from llm.conftest import ODD


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def encoder():
    return ranks_encoder(public_tokenizers.path(packing.VOCABULARY), public_tokenizers.PATTERN, packing.SPECIALS)


def test_ids_are_those_of_the_tokenizers_file(tokenizer):
    rng = random.Random(5)
    printable = [chr(c) for c in range(0x3000) if unicodedata.category(chr(c)) != "Cs"]
    odd = ["<|endoftext|>", "'s", "'ll", "  ", "\n\n", "\t", "　", "\x85", "​", "é", "é", "漢", "🙂", "٣", "Ⅷ", "a", "1"]
    texts = ["".join(rng.choices(printable, k=40) + rng.choices(odd, k=10)) for _ in range(400)]
    texts += ["".join(rng.choices(odd, k=30)) for _ in range(400)] + ["", "x" * 5000]
    encode = encoder()
    for text in texts:
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(6))
def test_plan_fills_sequences_without_gaps(seed):
    rng = random.Random(seed)
    limit = rng.choice([8, 64, 512])
    counts = {n: rng.randint(1, 300) for n in range(1, limit) if rng.random() < 0.8}
    got, placed = defaultdict(int), defaultdict(list)
    for length, rank, n, first, offset in packing.plan(counts, limit):
        assert rank == got[length]
        got[length] += n
        for i in range(n):
            placed[first + i].append((offset, length))
    assert got == counts
    for pieces in placed.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= limit
    least = max(-(-sum(k * n for k, n in counts.items()) // limit), sum(n for k, n in counts.items() if 2 * k > limit))
    assert len(placed) <= 11 / 9 * least + 1


def test_best_fit_is_the_one_over_single_pieces():
    rng = random.Random(3)
    lengths = sorted((rng.randint(1, 63) for _ in range(800)), reverse=True)
    rooms: list[int] = []
    for length in lengths:
        fitting = [r for r in rooms if r >= length]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - length)
        else:
            rooms.append(64 - length)
    counts = {n: lengths.count(n) for n in set(lengths)}
    planned = {row[3] + i for row in packing.plan(counts, 64) for i in range(row[2])}
    assert len(planned) == len(rooms)


def check(found, rows, limit, tokenizer):
    placed, per_doc = defaultdict(list), defaultdict(list)
    for r in found:
        placed[r["sequence_id"]].append((r["offset"], r["length"]))
        per_doc[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for pieces in placed.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= limit
    wanted = defaultdict(list)
    for i, text, *_ in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        cuts = [0, *range(len(ids) % limit or limit, len(ids) + 1, limit)]
        for k, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)):
            wanted[i].append((k, a, z - a, zlib.crc32(ids[a:z].tobytes())))
    assert {k: sorted(v) for k, v in per_doc.items()} == {k: sorted(v) for k, v in wanted.items()}
    return len(placed)


@pytest.mark.parametrize("limit", [16, 1024])
def test_pack(odd, tokenizer, limit):
    check(packing.pack(odd, limit=limit).collect(), ODD, limit, tokenizer)


def test_one_length_in_many_slices(docs, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_SLICE", 50)
    rows = [(i, "one two three") for i in range(700)] + [(1000 + i, "one") for i in range(100)]
    sequences = check(packing.pack(docs(*rows), limit=16).collect(), rows, 16, tokenizer)
    assert sequences <= -(-(700 * 4 + 100 * 2) // 16) + 1


def test_ids_on_request_and_empty_table(docs, tokenizer):
    (row,) = packing.pack(docs((1, "a b c")), with_ids=True).collect()
    assert row["ids"] == [*tokenizer.encode("a b c", add_special_tokens=False).ids, 2]
    assert packing.pack(docs()).collect() == []


@pytest.mark.parametrize("blank", [" ", "\t", "\u00a0", "\u3000"])
def test_long_blank_runs(docs, tokenizer, blank):
    texts = ["a" + blank * 100_000 + "b", blank * 999_999 + "b", "a" + blank * 1_000_000, "a" + blank * 2_000_000 + "b"]
    found = defaultdict(list)
    for r in packing.pack(docs(*enumerate(texts)), with_ids=True).collect():
        found[r["doc_id"]].append((r["piece"], r["ids"]))
    for i, text in enumerate(texts):
        ids = [x for _, part in sorted(found[i]) for x in part]
        assert ids == [*tokenizer.encode(text, add_special_tokens=False).ids, packing.END_ID]
