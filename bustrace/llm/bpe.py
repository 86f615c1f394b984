"""Byte-pair encoding by backtracking, and decoding by an offset table.

A text is cut into words by the vocabulary's pattern, special strings apart; words are encoded independently. The merges
of a word are never replayed. An Aho-Corasick automaton finds the longest token at every position; the encoder goes from
left to right, takes the longest token that gets along with the one before it, tries its next shorter prefix that is a
token, and steps back where none is left. Positions from which the end can't be reached are marked, so each is left once
and the time is linear. Two tokens get along when merging their bytes would not join anything across their border; that
is read off the right edge of one merge tree and the left edge of the other, and kept in a table of pairs. A row of
tokens of which all neighbours get along is what the merges give, and there is only one.

Decoding gathers bytes from one buffer of all tokens by a table of their offsets. Bytes that are no UTF-8 become U+FFFD,
and ids without a token give nothing, both as in the ``tokenizers`` library.

The pattern's classes follow that library's version of Unicode: a character is compared when it is first met, and texts
with one that falls into another class here are cut by the library's own pre-tokenizer.

Defined results: a null text is empty and has no ids; null ids, repeated rows and texts of any length (runs of millions
of blanks or letters too) are encoded like others; an empty table gives an empty result; further columns don't matter.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers.pre_tokenizers import ByteLevel

from bustrace.llm.batches import bounded_batches

VOCABULARY = "byte_bpe_50k.json"
HELD_TEXTS = 1 << 20  # texts between blanks whose ids a worker holds; beyond that it starts anew
HELD_LENGTH = 64  # longer ones are not held
HELD_PAIRS = 1 << 20
DECODE_PART = 1 << 16  # ids gathered at once

#: White space to ``re`` and ``str``, but not to the pattern.
SEPARATORS = range(0x1C, 0x20)
#: Tells letters, numbers, white space and other characters apart by where the pattern cuts.
PROBE = "a{0}1!{0}"


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Held(dict):
    """Ids of short texts as bytes, computed when they are asked for."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, text: str) -> bytes:
        ids = self.encode(text)
        if len(text) <= HELD_LENGTH:
            if len(self) >= HELD_TEXTS:
                self.clear()
            self[text] = ids
        return ids


class Tokens:
    """The bytes of a byte-level vocabulary's tokens, one after the other, and where each begins."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        byte_of = byte_letters()
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        bytes_of = {i: bytes(byte_of[c] for c in t) for t, i in data["model"]["vocab"].items()}
        bytes_of |= {i: t.encode() for t, i in special.items()}
        at = np.zeros(max(bytes_of) + 2, np.int64)
        for i, b in bytes_of.items():
            at[i + 1] = len(b)
        self.at = at.cumsum()
        self.buffer = np.frombuffer(b"".join(bytes_of.get(i, b"") for i in range(len(at) - 1)), np.uint8)
        self._read(data, bytes_of, special)

    def _read(self, data: dict, bytes_of: dict[int, bytes], special: dict[str, int]) -> None:
        """What an encoder needs besides; nothing here."""

    def decode(self, ids: bytes) -> str:
        every = np.frombuffer(ids, "<u4")
        out = []
        for a in range(0, len(every), DECODE_PART):
            part = every[a : a + DECODE_PART].astype(np.int64)
            part = part[part < len(self.at) - 1]
            start = self.at[part]
            size = self.at[part + 1] - start
            skipped = np.repeat(start - (size.cumsum() - size), size)
            out.append(self.buffer[skipped + np.arange(len(skipped))].tobytes())
        return b"".join(out).decode("utf-8", "replace")


@cache
def token_table(path: str) -> Tokens:
    return Tokens(path)


@cache
class Vocabulary(Tokens):
    """A byte-level vocabulary with ranked merges. A worker loads each file once."""

    def _read(self, data: dict, bytes_of: dict[int, bytes], special: dict[str, int]) -> None:
        if any(t[k] for t in data["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens with conditions are not supported")
        model, ids = data["model"], data["model"]["vocab"]
        self.bytes_of = bytes_of
        self.id_of = {bytes_of[i]: i for i in ids.values()}
        if any(bytes([b]) not in self.id_of for b in range(256)):
            raise ValueError("every byte must be a token")
        self.order: dict[int, int] = {}  # when a token is made; single bytes are there from the start
        self.parts: dict[int, tuple[int, int]] = {}
        self.merge: dict[tuple[int, int], int] = {}  # the order of a pair's merge
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            made = ids[left + right]
            if made in self.order or any(len(x) > 1 and ids[x] not in self.order for x in (left, right)):
                raise ValueError(f"merge {rank} uses a token before it is made, or makes one twice")
            self.order[made], self.parts[made], self.merge[ids[left], ids[right]] = rank, (ids[left], ids[right]), rank
        self._edges()
        self._tokens()
        self.words = Held(lambda text: array("I", self._word(text.encode())).tobytes())
        self.chunks = Held(self._chunk)
        self.after_blank = Held(lambda text: self._chunk(" " + text))
        self.cut = regex.compile(public_tokenizers.PATTERN)
        self.library = ByteLevel(add_prefix_space=False, use_regex=True)
        self.special = {t: np.array([i], "<u4").tobytes() for t, i in special.items()}
        marks = sorted(map(regex.escape, special), key=len, reverse=True)
        self.marks = regex.compile(f"({'|'.join(marks)})") if marks else None
        #: Longer white space and the word behind it.
        self.separators = re.compile(f"[{''.join(map(chr, SEPARATORS))}]")
        self.spaces = re.compile(r"(\s{2,}\S*)")
        self.same: set[str] = {chr(c) for c in range(128) if c not in SEPARATORS}
        self.other: set[str] = set(map(chr, SEPARATORS))

    def _edges(self) -> None:
        self.apart: dict[tuple[int, int], bool] = {}
        proper = {i for i in self.bytes_of if i not in self.parts and len(self.bytes_of[i]) == 1}
        for i in sorted(self.parts, key=self.order.__getitem__):
            left, right = self.parts[i]
            if left in proper and right in proper and self._walk(left, right, skip=True):
                proper.add(i)
        self.proper = proper  # the tokens that merging their own bytes gives

    def _tokens(self) -> None:
        """The automaton, and each token's longest proper prefix that is a token."""
        self.automaton = ahocorasick.Automaton()
        self.shorter, self.size = {}, {}
        for i in self.proper:
            text = self.bytes_of[i]
            self.size[i] = len(text)
            self.automaton.add_word(text.decode("latin-1"), i)
            self.shorter[i] = next(
                (k for n in range(len(text) - 1, 0, -1) if (k := self.id_of.get(text[:n])) in self.proper), -1
            )
        self.longest = max(self.size.values(), default=0)
        self.automaton.make_automaton()

    def _walk(self, x: int, y: int, skip: bool = False) -> bool:
        """Whether no merge joins the end of ``x`` with the start of ``y``, going back from the last merge to the first.

        ``x`` is there until its parent on the edge is made, at ``x_ends``, and so is ``y``. Of equal merges the left one
        goes first: that of ``x``'s parent before one across the border, and that before one of ``y``'s parent.
        """
        x_ends = y_ends = len(self.merge)
        while True:
            across = self.merge.get((x, y))
            if across is not None and not skip and across < x_ends and across <= y_ends:
                return False
            skip = False
            made_x, made_y = self.order.get(x, -1), self.order.get(y, -1)
            if made_x > made_y:
                x, x_ends = self.parts[x][1], made_x
            elif made_y >= 0:
                y, y_ends = self.parts[y][0], made_y
            else:
                return True

    def get_along(self, x: int, y: int) -> bool:
        if len(self.apart) >= HELD_PAIRS:
            self.apart.clear()
        found = self.apart[x, y] = self._walk(x, y)
        return found

    def _word(self, word: bytes) -> list[int]:
        """Ids of one word. A short one is first tried with the longest tokens throughout, found in one go."""
        text, longest, apart = word.decode("latin-1"), self.automaton.iter_long, self.apart
        size, shorter, reach, n = self.size, self.shorter, self.longest, len(text)
        taken, last = [], -1
        for _, token in longest(text[:reach]):
            pair = (last, token)
            if taken and not (apart[pair] if pair in apart else self.get_along(last, token)):
                break
            taken.append(token)
            last = token
        else:
            if n <= reach:
                return taken
            taken.pop()  # the window may have cut it
        at = sum(map(size.__getitem__, taken))
        last = taken[-1] if taken else -1
        token = next(longest(text[at : at + reach]))[1]
        dead = bytearray(n + 1)
        while True:
            end = at + size[token]
            pair = (last, token)
            if not dead[end] and (last < 0 or (apart[pair] if pair in apart else self.get_along(last, token))):
                taken.append(token)
                if end == n:
                    return taken
                at, last, token = end, token, next(longest(text[end : end + reach]))[1]
                continue
            token = shorter[token]
            while token < 0:
                dead[at] = 1
                token = taken.pop()
                at -= size[token]
                last = taken[-1] if taken else -1
                token = shorter[token]

    def _chunk(self, text: str) -> bytes:
        """Ids of a text that the pattern cuts alone as it does inside the whole."""
        words = self.cut.findall(text)
        if len(words) == 1:
            return array("I", self._word(text.encode())).tobytes()
        return b"".join(self.after_blank[w[1:]] if w[0] == " " and len(w) > 1 else self.words[w] for w in words)

    def _cut_alike(self, text: str) -> bool:
        """Whether the pattern cuts this text here as in the library."""
        if text.isascii():
            return not self.separators.search(text)
        for c in set(text) - self.same - self.other:
            probe = PROBE.format(c)
            here = [m.span() for m in self.cut.finditer(probe)]
            there = [span for _, span in self.library.pre_tokenize_str(probe)]
            (self.same if here == there else self.other).add(c)
        return self.other.isdisjoint(text) if self.other else True

    def _plain(self, text: str) -> Iterator[bytes]:
        """Ids of a text without special strings.

        No word holds white space behind another character. So the text is first cut where a blank stands between two
        other characters and in front of longer white space, which is faster and leaves short texts that come again.
        """
        if not self._cut_alike(text):
            yield from (self.words[text[a:z]] for _, (a, z) in self.library.pre_tokenize_str(text))
            return
        for k, part in enumerate(self.spaces.split(text)):
            if k % 2:
                yield self.chunks[part]
                continue
            first, *others = part.split(" ")
            if first:
                yield self.chunks[first]
            yield from map(self.after_blank.__getitem__, others)

    def encode(self, text: str) -> bytes:
        """The ids of a text, as little-endian unsigned 32-bit numbers. Special strings inside it become their ids."""
        if self.marks is None or not self.marks.search(text):
            return b"".join(self._plain(text))
        parts = self.marks.split(text)
        return b"".join(self.special[p] if k % 2 else b"".join(self._plain(p)) for k, p in enumerate(parts))


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, path: str | None = None
) -> DataFrame:
    """One row per document: id, n_tokens, and ids as little-endian unsigned 32-bit numbers in one binary."""
    bounded_batches(docs.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)
    schema = T.StructType([docs.schema[id_col]]).add("n_tokens", "long").add("ids", "binary")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(path)
        for batch in batches:
            ids = [vocabulary.encode(text.as_py() or "") for text in batch.column(1)]
            columns = [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(encoded, schema)


def decode(encoded: DataFrame, ids_col: str = "ids", *, path: str | None = None) -> DataFrame:
    """The rows with one column more, ``text``: what their ids stand for. Null ids give a null text."""
    bounded_batches(encoded.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)
    schema = T.StructType([*encoded.schema.fields]).add("text", "string")
    at = encoded.columns.index(ids_col)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_table(path)  # the merges are not needed here
        for batch in batches:
            ids = (x.as_py() for x in batch.column(at))
            texts = pa.array([None if x is None else tokens.decode(x) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=schema.names)

    return encoded.mapInArrow(decoded, schema)
