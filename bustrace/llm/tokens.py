"""Token counts by dynamic programming over prefixes.

The vocabulary joins pieces by score, and none of its pieces holds a space mark behind another character. So a text
falls into segments (spaces and the word behind them) that are encoded independently, and the count of a prefix is the
sum of the segments before it plus a count inside one segment. Both levels are prefix tables:

* over segments: the running sum of segment counts; every distinct segment of a batch is encoded once;
* inside a segment: the last piece of each prefix's encoding, found from the last pieces of shorter prefixes. A piece
  that ends a prefix fits exactly when it and the last piece before it stay apart when both are encoded together. The
  count is one more than that of the prefix without the piece.

``PrefixCounts`` answers how many tokens any prefix has and which prefix fits a budget without encoding the text again.
``count_tokens`` uses it for whole columns and also gives the longest prefix within the limit. The running sums are made for
every text; the table inside a segment only where a question falls into it, which for ``count_tokens`` is the segment in
which the limit runs out.

Defined results: a null text is empty and has no bytes and no tokens; null ids and repeated rows stay as they are; an
empty table gives an empty result. The model must treat spaces as described, which is checked when it is loaded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from bustrace.llm.batches import bounded_batches
from bustrace.llm.vocabulary import pieces_encoder

VOCABULARY = "piece_bpe_32k.model"
LIMIT = 4096
MARK = "▁"
SEGMENT = re.compile(r" *[^ ]+| +")
HELD = 1 << 19  # distinct segments whose counts a worker holds; beyond that it starts anew


@cache
class Pieces:
    """A vocabulary of pieces: segment counts, and counts at every prefix of a segment."""

    def __init__(self, path: str):
        self.model = pieces_encoder(path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(MARK in name.lstrip(MARK) for name in names) or self.model.encode("a  b", out_type=str)[-1][0] != MARK:
            raise ValueError("the vocabulary joins pieces across words")
        plain = [i for i in range(len(names)) if not (self.model.is_control(i) or self.model.is_unknown(i))]
        self.scores = {names[i]: self.model.get_score(i) for i in plain if not self.model.is_byte(i)}
        self.longest = max(map(len, self.scores), default=1)
        self.counts: dict[str, int] = {}
        self.apart: dict[tuple[str, str], bool] = {}

    def segment_counts(self, segments: list[str]) -> np.ndarray:
        """Tokens of each segment. A segment starts with its spaces; the encoder adds one, so it is given one less."""
        known = self.counts
        new = [s for s in set(segments) if s not in known]
        if len(known) + len(new) > HELD:
            known.clear()
            new = list(set(segments))
        for s, ids in zip(new, self.model.encode([s[1:] for s in new], num_threads=1), strict=True):
            known[s] = len(ids) if len(s) > 1 else self._width(s.replace(" ", MARK))
        return np.fromiter((known[s] for s in segments), np.int64, len(segments))

    def _merged(self, symbols: list[str]) -> list[str]:
        """Join the best-scored neighbours until none is left; the first of equals goes first."""
        while True:
            pairs = [(-self.scores[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)) if a + b in self.scores]
            if not pairs:
                return symbols
            i = min(pairs)[1]
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]

    def stay_apart(self, left: str, right: str) -> bool:
        found = self.apart.get((left, right))
        if found is None:
            found = self.apart[left, right] = self._merged(list(left + right)) == [left, right]
        return found

    def _width(self, piece: str) -> int:
        """Tokens of one piece: a character the vocabulary lacks becomes its bytes."""
        return 1 if piece in self.scores else len(piece.encode())

    def inside(self, segment: str) -> np.ndarray:
        """Tokens of every prefix of a segment, from the empty one on."""
        text = segment.replace(" ", MARK)
        last, counts = [""], [0]
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - self.longest), end):
                piece = text[start:end]
                if len(piece) > 1 and piece not in self.scores:
                    continue
                if not start or self.stay_apart(last[start], piece):
                    if start or len(piece) == 1 or self._merged(list(piece)) == [piece]:
                        last.append(piece)
                        counts.append(counts[start] + self._width(piece))
                        break
            else:
                raise AssertionError("some piece ends every prefix")
        return np.array(counts, np.int64)


class PrefixCounts:
    """Exact token counts at every prefix of one text (in characters)."""

    def __init__(self, text: str, pieces: Pieces):
        self.pieces = pieces
        self.marked = " " + text.replace(MARK, " ") if text else ""
        self.segments = SEGMENT.findall(self.marked)
        self.counts = np.concatenate([[0], pieces.segment_counts(self.segments).cumsum()])
        self._ends: np.ndarray | None = None

    @property
    def total(self) -> int:
        return int(self.counts[-1])

    @property
    def ends(self) -> np.ndarray:
        """Number of characters up to each segment's start, and of all."""
        if self._ends is None:
            sizes = np.fromiter(map(len, self.segments), np.int64, len(self.segments))
            self._ends = np.concatenate([[0], sizes.cumsum()])
        return self._ends

    def tokens_at(self, n_chars: int) -> int:
        """Tokens of the first ``n_chars`` characters."""
        if n_chars <= 0 or not self.segments:
            return 0
        at = min(n_chars + 1, int(self.ends[-1]))  # the mark in front
        k = int(np.searchsorted(self.ends, at, side="right")) - 1
        rest = at - int(self.ends[k])
        return int(self.counts[k]) + (int(self.pieces.inside(self.segments[k])[rest]) if rest else 0)

    def longest_within(self, budget: int) -> int:
        """Characters of the longest prefix with at most ``budget`` tokens.

        A longer prefix may have fewer tokens, but only inside the segment where the budget runs out.
        """
        if self.total <= budget:
            return max(0, int(self.ends[-1]) - 1)
        k = int(np.searchsorted(self.counts, budget, side="right")) - 1
        inside = self.counts[k] + self.pieces.inside(self.segments[k])
        best = int(self.ends[k]) + int(np.nonzero(inside <= budget)[0][-1])
        return max(0, best - 1)

    def every_prefix(self) -> np.ndarray:
        """Tokens of each prefix, from the empty one to the whole text."""
        parts = [[0]]
        for k, segment in enumerate(self.segments):
            inside = self.counts[k] + self.pieces.inside(segment)
            parts.append(inside[1:] if k else inside[2:])
        return np.concatenate(parts)


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    limit: int = LIMIT,
    path: str | None = None,
) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit, and chars_within, the longest prefix within the limit."""
    bounded_batches(docs.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)
    schema = T.StructType([docs.schema[id_col]]).add("n_bytes", "long").add("n_tokens", "long")
    schema = schema.add("over_limit", "boolean").add("chars_within", "long")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(path)
        for batch in batches:
            n_bytes, n_tokens, within = [], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                table = PrefixCounts(text, pieces)
                n_bytes.append(len(text.encode()))
                n_tokens.append(table.total)
                within.append(table.longest_within(limit) if table.total > limit else len(text))
            columns = [pa.array(x, pa.int64()) for x in (n_bytes, n_tokens)]
            columns += [pa.array([n > limit for n in n_tokens], pa.bool_()), pa.array(within, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(counted, schema)
