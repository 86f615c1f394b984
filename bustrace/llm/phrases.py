"""Phrase collocations by multikey three-way quicksort of suffix pointers.

Every word of a text is a pointer to the suffix that starts there, read up to the end of its piece and to the greatest
number of words. Sorting pointers by their first word, then those with equal first words by their second, and so on,
leaves equal partitions whose sizes are the phrases' counts. This is done twice: in blocks of texts, which turns repeated
phrases into one row with a count, and after the rows were routed by their leading word, where the partitions of a task
are whole, and one that is too infrequent is abandoned before its next word is looked at.

Three tables of bounded size, made from exact word counts, go to all tasks. A bitmap over hashes tells words that may be
frequent; a phrase ends in front of any other. Levels, over hashes too, tell words that may be heavy: phrases behind a
heavy word are routed by two words, and those behind two heavy words are dealt out further by the words that follow, and
their prefixes are summed over tasks afterwards. A false positive costs time and changes no result. The commonest words
have numbers, so that the packed rows that go from the first sort to the second only spell the rarer ones.

Counts, candidates, scores and ranks are exact for any number of words up to 10^16 of a language: products are decimals.

Defined results: a null text is empty and a null language is ``und``, together with rows that say ``und``; ids are not
used, so null ids and repeated rows count like others; an empty table gives an empty result; texts of any length are
read in parts; further columns don't matter.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bustrace.llm.batches import bounded_batches
from bustrace.session import broadcast_if_small, store

LEAST = 10
MOST_WORDS = 3
TOP = 2000
COVERED_PERCENT = 50

WORDS_PER_BLOCK = 1 << 22
HELD_WORDS = 1 << 20  # distinct words that a task counts before it sends them on
TEXT_PART = 1 << 22  # bytes split into words at once
SMALL = 1 << 16  # partitions of so many pointers are sorted in one go
ROWS_PER_TASK = 1 << 21
HEAVY = 1 << 18
HEAVY_BITS = 20
NUMBERED = 1 << 17
MOST_BITS = 27

#: Ends a piece; no word holds one.
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
STOP = b"."
_TABLE = bytes(STOP[0] if b in SEPARATORS else b + 32 if 65 <= b <= 90 else b for b in range(256))

_PACKED = "lang string, task int, dealt boolean, words binary, keys binary, n binary"


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in parts; ``STOP`` stands between pieces."""
    spaced = text.translate(_TABLE).replace(STOP, b" . ")
    at = 0
    while len(spaced) - at > TEXT_PART:
        cut = spaced.find(b" ", at + TEXT_PART)
        if cut < 0:
            break
        yield spaced[at:cut].split()
        at = cut
    yield spaced[at:].split()


def _hash(lang: str) -> int:
    """The state of a hash behind a language and a line end, to go on with a word."""
    return zlib.crc32(lang.encode() + b"\n")


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of rows (lang, text as bytes)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                counts.pop(STOP, None)
                words = pa.array(list(counts), pa.binary()).cast(pa.string())
                columns = [pa.array([lang] * len(words), pa.string()), words, pa.array(list(counts.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "n"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts = held.setdefault(lang, Counter())
                for words in words_of(text.as_py() or b""):
                    counts.update(words)
            if sum(map(len, held.values())) > HELD_WORDS:
                yield from flush()
        yield from flush()

    counted = docs.mapInArrow(count, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def word_bitmap(words: DataFrame, bits: int) -> np.ndarray:
    """A bit per hash of (lang, word), as booleans; at most 2^MOST_BITS bits reach the driver."""
    at = F.crc32(F.concat(F.col("lang"), F.lit("\n"), F.col("word"))).bitwiseAND((1 << bits) - 1)
    page = 1 << 15  # what one bitmap of the aggregate holds
    pages = words.select(at.alias("at")).groupBy((F.col("at") / page).cast("int").alias("page"))
    out = np.zeros(max(1 << bits, page), bool)
    for row in pages.agg(F.bitmap_construct_agg(F.col("at") % page).alias("bitmap")).collect():
        bitmap = np.unpackbits(np.frombuffer(row["bitmap"], np.uint8), bitorder="little")
        out[row["page"] * page : (row["page"] + 1) * page] = bitmap
    return out[: 1 << bits]


def word_levels(words: DataFrame, heavy: int) -> np.ndarray:
    """By hash of (lang, word), how often the count of a heavy word can be halved before it is light; 0 for light words."""
    at = F.crc32(F.concat(F.col("lang"), F.lit("\n"), F.col("word"))).bitwiseAND((1 << HEAVY_BITS) - 1)
    level = (F.floor(F.log2(F.col("n") / heavy)) + 1).cast("int")
    out = np.zeros(1 << HEAVY_BITS, np.uint8)
    for row in words.filter(F.col("n") >= heavy).groupBy(at.alias("at")).agg(F.max(level).alias("level")).collect():
        out[row["at"]] = row["level"]
    return out


def word_numbers(words: DataFrame) -> tuple[dict[str, dict[bytes, int]], dict[int, bytes]]:
    """Numbers from 1 for the ``NUMBERED`` commonest words, by language and back."""
    first = words.orderBy(F.desc("n"), "lang", "word").limit(NUMBERED).select("lang", "word").collect()
    numbers: dict[str, dict[bytes, int]] = {}
    for i, row in enumerate(first, 1):
        numbers.setdefault(row["lang"], {})[row["word"].encode()] = i
    return numbers, {i: row["word"].encode() for i, row in enumerate(first, 1)}


def equal_parts(keys: np.ndarray, weights: np.ndarray, least: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Multikey three-way quicksort of the rows of ``keys``: for each depth, (a pointer, weight) of its equal partitions.

    Partitions that weigh less than ``least`` of their depth are abandoned: not returned and not sorted further. ``least`` must not fall with the depth.
    """
    depths = keys.shape[1]
    pointers: list[list[np.ndarray]] = [[] for _ in range(depths)]
    totals: list[list[np.ndarray]] = [[] for _ in range(depths)]
    todo = [(np.arange(len(keys)), 0)] if len(keys) else []
    while todo:
        at, depth = todo.pop()
        if len(at) <= SMALL:
            at = at[np.lexsort([keys[at, d] for d in range(depths - 1, depth - 1, -1)])]
            new = np.zeros(len(at), bool)
            new[0] = True
            for d in range(depth, depths):
                new[1:] |= keys[at[1:], d] != keys[at[:-1], d]
                starts = np.flatnonzero(new)
                total = np.add.reduceat(weights[at], starts)
                frequent = total >= least[d]
                pointers[d].append(at[starts[frequent]])
                totals[d].append(total[frequent])
            continue
        key = keys[at, depth]
        sample = key[:: max(1, len(key) // 9)]
        pivot = np.partition(sample, len(sample) // 2)[len(sample) // 2]
        todo += [(part, depth) for part in (at[key < pivot], at[key > pivot]) if len(part)]
        same = at[key == pivot]
        total = weights[same].sum()
        if total >= least[depth]:
            pointers[depth].append(same[:1])
            totals[depth].append(np.array([total]))
            if depth + 1 < depths:
                todo.append((same, depth + 1))
    none = np.zeros(0, np.int64)
    return [(np.concatenate([none, *p]), np.concatenate([none, *t])) for p, t in zip(pointers, totals, strict=True)]


class _Numbers(dict):
    """Words numbered from 1 in the order of their coming; ``STOP`` is 0."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _planes(numbers: np.ndarray) -> bytes:
    """Rows of numbers column by column and byte by byte, so that equal bytes lie together."""
    return np.ascontiguousarray(numbers.T, "<u4").reshape(-1, 1).view(np.uint8).reshape(-1, numbers.shape[0], 4).transpose(0, 2, 1).tobytes()


def _unplaned(data: bytes, columns: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(columns, 4, -1)
    return np.ascontiguousarray(planes.transpose(2, 0, 1)).view("<u4")[:, :, 0].astype(np.int32)


def _block(lang: str, numbers: np.ndarray, words: list[bytes], tables, common_words: int, tasks: int, depths: int) -> Iterator[dict]:
    """Packed rows of the suffixes of one block and language, by the task they go to."""
    frequent, levels, numbered = tables
    used = np.unique(numbers)
    start, crc = _hash(lang), np.zeros(len(words), np.uint64)
    for i in used[used > 0].tolist():
        crc[i] = zlib.crc32(words[i], start)
    may = frequent[(crc & np.uint64(len(frequent) - 1)).astype(np.int64)]
    level = levels[(crc & np.uint64(len(levels) - 1)).astype(np.int64)]
    may[0], level[0] = False, 0
    ahead = np.append(np.where(may[numbers], numbers, 0), np.zeros(depths, numbers.dtype))
    keys = np.empty((len(numbers), depths), np.int32)
    for d in range(depths):
        keys[:, d] = ahead[d : d + len(numbers)]
        if d:
            keys[keys[:, d - 1] == 0, d] = 0
    keys = keys[keys[:, 1] > 0]
    at, n = equal_parts(keys, np.ones(len(keys), np.int64), (1,) * depths)[-1]
    keys = keys[at]
    factor = np.uint64(0x9E3779B97F4A7C15)

    def mixed(h: np.ndarray) -> np.ndarray:
        """The lower bits depend on all bits that went in."""
        return ((h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(33)

    target, later = crc[keys[:, 0]], np.zeros(len(keys), np.uint64)
    target = np.where(level[keys[:, 0]] > 0, target * factor + crc[keys[:, 1]], target)
    for d in range(2, depths):
        later = later * factor + crc[keys[:, d]] + np.uint64(1)
    both = np.minimum(level[keys[:, 0]], level[keys[:, 1]]).astype(np.uint64)
    target = target * factor + (mixed(later) & ((np.uint64(1) << both) - np.uint64(1)))
    group = (mixed(target) % np.uint64(tasks)).astype(np.int64) * 2 + (both > 0)
    order = np.argsort(group, kind="stable")
    cuts = np.append(np.flatnonzero(np.diff(group[order], prepend=-1)), len(order))
    known = numbered.get(lang, {})
    common = np.zeros(len(words), np.int64)
    for i in used.tolist():
        common[i] = known.get(words[i], 0) if i else 0
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        part = order[a:z]
        mine = np.unique(keys[part])
        rare = mine[(common[mine] == 0) & (mine > 0)]
        named = common.copy()
        named[rare] = common_words + 1 + np.arange(len(rare))
        yield {
            "lang": lang,
            "task": int(group[part[0]] // 2),
            "dealt": bool(group[part[0]] % 2),
            "words": b"\n".join(words[i] for i in rare.tolist()),
            "keys": _planes(named[keys[part]]),
            "n": _planes(n[part, None]),
        }


def _suffixes(tables, tasks: int, depths: int):
    """Rows (lang, text as bytes) to packed rows of sorted and counted suffixes."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, held, size = _Numbers({STOP: 0}), {}, 0

        def flush() -> Iterator[pa.RecordBatch]:
            words = list(numbers)
            for lang, parts in held.items():
                for row in _block(lang, np.concatenate(parts), words, tables.value, NUMBERED, tasks, depths):
                    yield pa.RecordBatch.from_pylist([row], schema=schema)
            held.clear()
            numbers.clear()
            numbers[STOP] = 0

        schema = pa.schema([("lang", pa.string()), ("task", pa.int32()), ("dealt", pa.bool_()), ("words", pa.binary()), ("keys", pa.binary()), ("n", pa.binary())])
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                parts = held.setdefault(lang, [])
                for words in words_of(text.as_py() or b""):
                    parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                    size += len(words)
                parts.append(np.zeros(1, np.int32))
            if size >= WORDS_PER_BLOCK:
                yield from flush()
                size = 0
        yield from flush()

    return sort


def _grams(common, least: int, depths: int):
    """Packed rows of a task to phrases of two words and more, with their counts; those that were dealt may be in parts."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, bool], tuple[_Numbers, list, list]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                rare, keys, n = held.setdefault((row["lang"], row["dealt"]), (_Numbers({STOP: 0}), [], []))
                spelt = row["words"].split(b"\n") if row["words"] else []
                local = np.array([0, *map(rare.__getitem__, spelt)], np.int32)
                named = _unplaned(row["keys"], depths)
                spelled = named > NUMBERED
                named[spelled] = NUMBERED + local[named[spelled] - NUMBERED]
                keys.append(named)
                n.append(_unplaned(row["n"], 1)[:, 0].astype(np.int64))
        for (lang, dealt), (rare, keys, n) in held.items():
            words = {**common.value, **{NUMBERED + i: w for i, w in enumerate(rare) if i}}
            all_keys = np.concatenate(keys)
            # A heavy word's partition is in several tasks.
            bounds = (1,) * (depths - 1) + (least,) if dealt else (1,) + (least,) * (depths - 1)
            for depth, (at, total) in enumerate(equal_parts(all_keys, np.concatenate(n), bounds)):
                whole = all_keys[at, depth] > 0
                at, total = at[whole], total[whole]
                if depth and len(at):
                    phrases = [b" ".join(map(words.__getitem__, k)) for k in all_keys[at, : depth + 1].tolist()]
                    columns = [pa.array([lang] * len(at), pa.string()), pa.array(phrases, pa.binary()).cast(pa.string())]
                    columns += [pa.array([depth + 1] * len(at), pa.int32()), pa.array(total)]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "words", "n"])

    return sort


def phrase_counts(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, least: int = LEAST, most_words: int = MOST_WORDS
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, n) of all phrases up to ``most_words`` that occur ``least`` times, and (lang, n) of all words."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text"))
    words = store(word_counts(texts), "phrase-words")
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = words.filter(F.col("n") >= least)
    kinds, rows = frequent.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    bits = min(MOST_BITS, max(10, (16 * kinds).bit_length()))
    tasks = max(1, -(-rows // ROWS_PER_TASK))
    numbers, common = word_numbers(frequent)
    share = spark.sparkContext.broadcast
    tables, common = share((word_bitmap(frequent, bits), word_levels(words, HEAVY), numbers)), share(common)
    packed = texts.mapInArrow(_suffixes(tables, tasks, most_words), _PACKED)
    packed = packed.repartitionById(tasks, F.col("task"))
    grams = packed.mapInArrow(_grams(common, least, most_words), "lang string, phrase string, words int, n long")
    # Only prefixes of phrases that were dealt out come in parts; the sum of a single row is that row.
    grams = grams.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    single = frequent.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("words"), "n")
    return store(single.unionByName(grams), "phrase-counts"), sizes


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    *,
    least: int = LEAST,
    most_words: int = MOST_WORDS,
    covered_percent: int = COVERED_PERCENT,
    top: int = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` best phrases of each language.

    A phrase's score is that of its worst cut; phrases that a longer candidate covers in enough of their places go.
    """
    counts, sizes = phrase_counts(docs, text_col, lang_col, least=least, most_words=most_words)
    candidates = counts.filter("words > 1").withColumn("w", F.split("phrase", " ")).withColumnRenamed("n", "a")

    def joined(start: F.Column, length: F.Column) -> F.Column:
        return F.array_join(F.slice("w", start, length), " ")

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("first"), joined(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"))
    table = broadcast_if_small(counts.select("lang", "phrase", "n"))
    for part, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(table.withColumnsRenamed({"phrase": part, "n": name}), ["lang", part])
    a, product = F.col("a").cast("decimal(16,0)"), F.col("l").cast("decimal(16,0)") * F.col("r").cast("decimal(16,0)")
    cuts = cuts.withColumns({"square": F.lit(1000000).cast("decimal(7,0)") * (a * a).cast("decimal(31,0)"), "product": product})
    scored = cuts.withColumn("score", F.expr("square div product").cast("long"))
    worst = F.min_by(F.struct("a", "l", "r", "score"), F.struct("score", "k")).alias("worst")
    scored = scored.groupBy("lang", "phrase").agg(worst).select("lang", "phrase", "worst.*")

    length = F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("length")
    inner = candidates.filter("words > 2").select("lang", "w", "words", "a", length)
    inner = inner.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("length") + 1)).alias("start"))
    inner = inner.groupBy("lang", joined(F.col("start"), F.col("length")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = scored.join(inner, ["lang", "phrase"], "left")
    kept = kept.filter(F.col("longer").isNull() | (100 * F.col("longer") < covered_percent * F.col("a")))

    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = kept.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= top)
    best = best.join(broadcast_if_small(sizes), "lang")
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
