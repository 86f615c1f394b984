"""Best-fit packing planned on a histogram of lengths.

Documents become token ids with an end mark and are cut into pieces; only their lengths are counted. Best-fit decreasing
runs over these counts on the driver: a step places one length into all open sequences with one amount of room, so the
plan has rows for lengths and amounts of room, never for documents, and its size is bounded by ``limit`` alone. Each
piece then takes a planned slot by joining on its rank within its length. Ranks come from slices of bounded size, so a
length that most pieces have is no single group. Full pieces are sequences by themselves and take no part in this.

Ids follow the byte-level vocabulary's ranks file, which gives the ids of its ``tokenizers`` file (tested) in a fifth of
the time; an end-of-text string inside a text becomes its special id, as that library does by default. That encoder gives
up on runs of about a million blanks; such a text is encoded by ``bpe``, which gives the same ids for any text.

Defined results: a null text is empty, that is one piece with the end mark only; null ids and repeated rows are packed
like other rows; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bustrace.llm import bpe
from bustrace.llm.batches import bounded_batches
from bustrace.llm.vocabulary import END_OF_TEXT, ranks_encoder
from bustrace.session import broadcast_if_small, store

LIMIT = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k.tiktoken"
SPECIALS = ((END_OF_TEXT, 50256),)
ROWS_PER_SLICE = 8192

PLAN_SCHEMA = "length long, rank_from long, n long, first_sequence long, offset long"


def plan(counts: dict[int, int], limit: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows (length, rank_from, n, first_sequence, offset).

    The ``n`` pieces of a length from rank ``rank_from`` on go to as many sequences from ``first_sequence`` on, one in
    each, at ``offset``.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # ranges (first sequence, number) by the room they have left
    rows: list[tuple[int, int, int, int, int]] = []
    opened = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            free = min((r for r in room if r >= length), default=limit)
            per_sequence = free // length
            if free in room:
                first, n = room[free].pop()
                if not room[free]:
                    del room[free]
            else:
                first, n = opened, -(-left // per_sequence)
                opened += n
            full = min(n, left // per_sequence)
            # All sequences of the range take as many as fit; the last one what remains.
            for at, number, each in ((first, full, per_sequence), (first + full, int(full < n), left % per_sequence)):
                if not number or not each or not left:
                    continue
                for slot in range(each):
                    rows.append((length, rank, number, at, limit - free + slot * length))
                    rank += number
                left -= number * each
                if free > each * length:
                    room.setdefault(free - each * length, []).append((at, number))
            used = full + int(full < n and rows[-1][3] == first + full)
            if used < n:
                room.setdefault(free, []).append((first + used, n - used))
    return rows


def guarded(encode, same: str):
    """``encode``, with the backtracking encoder for texts on which it gives up."""

    def ids(text: str) -> np.ndarray:
        try:
            return encode(text)
        except ValueError:
            return np.frombuffer(bpe.Vocabulary(same).encode(text), "<u4")

    return ids


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    limit: int = LIMIT,
    end_id: int = END_ID,
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    specials=SPECIALS,
    same: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 and, on request, ids. The first piece is the short one.

    ``path`` is a file of ranks, ``same`` the vocabulary's ``tokenizers`` file.
    """
    bounded_batches(docs.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)
    same = same or public_tokenizers.path(bpe.VOCABULARY)
    schema = T.StructType([docs.schema[id_col], T.StructField("piece", T.IntegerType())])
    schema = schema.add("start", "long").add("length", "long").add("ids_crc32", "long")
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = guarded(ranks_encoder(path, pattern, specials), same)
        for batch in batches:
            row, piece, start, length, crc, values = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), end_id).astype("<u4")
                bounds = [0, *range(len(ids) % limit or limit, len(ids) + 1, limit)]
                for k, (a, z) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(z - a)
                    crc.append(zlib.crc32(ids[a:z].tobytes()))
                    if with_ids:
                        values.append(ids[a:z])
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
            if with_ids:
                columns.append(pa.array(values, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(cut, schema)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, limit: int = LIMIT, **options) -> DataFrame:
    """One row per piece: the columns of ``token_pieces``, sequence_id and offset. Options are those of ``token_pieces``."""
    pieces = token_pieces(docs, id_col, text_col, limit=limit, **options)
    # Written once with a number per row, so that a lost executor can't deal ranks anew.
    pieces = store(pieces.withColumn("__row", F.monotonically_increasing_id()), "pack-pieces")
    own = pieces.filter(F.col("length") == limit)
    own = own.withColumns({"sequence_id": -1 - F.col("__row"), "offset": F.lit(0).cast("long")})
    short = pieces.filter(F.col("length") < limit)
    slices = max(1, -(-short.count() // ROWS_PER_SLICE))
    short = short.withColumn("__slice", F.pmod(F.xxhash64("__row"), F.lit(slices)))
    counts = store(short.groupBy("length", "__slice").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    planned = pieces.sparkSession.createDataFrame(plan(histogram, limit), PLAN_SCHEMA)
    before = Window.partitionBy("length").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "__slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__base"))
    within = F.row_number().over(Window.partitionBy("length", "__slice").orderBy("__row"))
    ranked = short.withColumn("__within", within).join(bases, ["length", "__slice"])
    ranked = ranked.withColumn("__rank", F.col("__base") + F.col("__within") - 1)
    slots = broadcast_if_small(planned.withColumnRenamed("length", "__length"))
    on = (F.col("length") == F.col("__length")) & F.col("__rank").between(F.col("rank_from"), F.expr("rank_from + n - 1"))
    placed = ranked.join(slots, on).withColumn("sequence_id", F.expr("first_sequence + __rank - rank_from"))
    columns = [c for c in pieces.columns if c != "__row"] + ["sequence_id", "offset"]
    return own.select(*columns).unionByName(placed.select(*columns))
