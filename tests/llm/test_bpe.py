import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from bustrace.llm import bpe, queries
from llm.conftest import ODD

PATH = public_tokenizers.path(bpe.VOCABULARY)
BITS = ["ab", "aa", "the", " ", "  ", "\n", " \n ", "\t", "'s", "'S", "'ll", "<|endoftext|>", "é", "漢", "🙂", "\x1c", "՘", "Ẕb"]
BITS += ["x" * 9, " " * 70, "12", "...", "　", "\u0085", "퟿", "͸"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.Vocabulary(PATH)


def ids_of(own, text):
    return np.frombuffer(own.encode(text), "<u4").tolist()


def test_same_ids_as_the_library(own, library):
    rng = random.Random(3)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    texts += ["".join(chr(rng.choice((32, 39, rng.randint(9, 126), rng.randint(0, 0x2FFF)))) for _ in range(40)) for _ in range(1500)]
    texts += ["".join(rng.choice("abct'h e") for _ in range(300)) for _ in range(300)]
    for text, wanted in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids_of(own, text) == wanted.ids, repr(text)
        assert own.decode(own.encode(text)) == text


def test_every_character_is_cut_as_in_the_library(own, library):
    code = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000][::7]
    texts = [f"a{chr(c)}1!{chr(c)} {chr(c)}b" for c in code]
    for text, wanted in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids_of(own, text) == wanted.ids, repr(text)


@pytest.mark.parametrize("text", ["x" * 300_000, "a" + " " * 300_000 + "b", "ab" * 150_000, "　" * 100_000, "\n" * 200_001, "word " * 60_000, "漢" * 90_000])
def test_long_runs(own, library, text):
    assert ids_of(own, text) == library.encode(text, add_special_tokens=False).ids


def test_any_ids_are_decoded_like_the_library(own, library):
    rng = random.Random(4)
    for _ in range(500):
        ids = [rng.randint(0, 50_300) for _ in range(rng.randint(0, 20))]
        assert own.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_full_tables_of_words_and_pairs_start_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "HELD_TEXTS", 3)
    monkeypatch.setattr(bpe, "HELD_PAIRS", 3)
    own = bpe.Vocabulary.__wrapped__(PATH)
    text = "one two three, four! five's the other seventythree thththou " * 3
    assert ids_of(own, text) == library.encode(text, add_special_tokens=False).ids
    assert len(own.after_blank) <= 3 and len(own.apart) <= 3


def test_a_vocabulary_out_of_order_is_refused(tmp_path):
    import json

    data = json.load(open(PATH, encoding="utf-8"))
    data["model"]["merges"].reverse()
    (tmp_path / "v.json").write_text(json.dumps(data))
    with pytest.raises(ValueError, match="before it is made"):
        bpe.Vocabulary(str(tmp_path / "v.json"))


def test_tables(odd, docs, own):
    encoded = bpe.encode(odd)
    assert encoded.columns == ["doc_id", "n_tokens", "ids"]
    found = sorted((repr(r["doc_id"]), r["n_tokens"], bytes(r["ids"]), r["text"]) for r in bpe.decode(encoded).collect())
    wanted = [(repr(i), len(own.encode(t or "")) // 4, own.encode(t or ""), t or "") for i, t, *_ in ODD]
    assert found == sorted(wanted)
    assert bpe.decode(bpe.encode(docs())).count() == 0


def test_query(spark, library):
    found = {r["doc_id"]: tuple(r)[1:] for r in queries.queries()["op11_bpe_round_trip"](spark, "/root/testdata/sf0.001").collect()}
    rows = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist()
    for row in rows:
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        wanted = len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()
        assert found[row["doc_id"]] == wanted
    assert len(found) == len(rows)
