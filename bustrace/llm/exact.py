"""Exact dedup: group by a 128-bit content hash, keep one stable id, compare bytes inside groups.

Texts are equal when they are identical after lower-casing A-Z. Hashes are grouped first, on narrow rows. Only texts
whose hash occurs more than once are compared: the smallest and the largest text of a hash are equal exactly when all
are, and both are aggregated on the map side, so a group of any size sends one row per task. Should a hash turn out to
hold two texts, its rows are grouped by the text itself.

Defined results: a null text is an empty one and equals it; a null id is never kept while the group has another id;
repeated rows (same id, same text) are one group, and one of them is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bustrace.llm.batches import bounded_batches
from bustrace.session import BROADCAST_BYTES, store

HASH, SHA, KEY, TEXT, COPIES = "__hash", "__sha", "__key", "__text", "__copies"


def md5(data: bytes) -> bytes:
    return hashlib.md5(data, usedforsecurity=False).digest()


def _normalised(column: pa.Array) -> list[bytes]:
    """Text in UTF-8 with A-Z lower-cased; null is empty."""
    return pc.fill_null(pc.ascii_lower(column), "").cast(pa.large_string()).cast(pa.large_binary()).to_pylist()


def with_hash(docs: DataFrame, text_col: str, digest: Callable[[bytes], bytes] = md5, *, text=False) -> DataFrame:
    """``docs`` with the content hash and SHA-256 of the normalised text, and on request that text in UTF-8."""
    schema = T.StructType([*docs.schema, T.StructField(HASH, T.BinaryType()), T.StructField(SHA, T.StringType())])
    if text:
        schema = schema.add(TEXT, T.BinaryType())
    at = docs.columns.index(text_col)
    bounded_batches(docs.sparkSession)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = _normalised(batch.column(at))
            more = [
                pa.array([digest(x) for x in data], pa.binary()),
                pa.array([hashlib.sha256(x).hexdigest() for x in data], pa.string()),
            ]
            if text:
                more.append(pa.array(data, pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=schema.names)

    return docs.mapInArrow(hashed, schema)


def _collided(docs: DataFrame, rows: DataFrame, text_col: str, digest) -> DataFrame:
    """Hashes that more than one text has, by comparing the bytes of all texts whose hash occurs more than once."""
    several = store(rows.groupBy(HASH).agg(F.sum(COPIES).alias("n")).filter("n > 1").select(HASH), "exact-several")
    if several.count() * 64 <= BROADCAST_BYTES:
        several = F.broadcast(several)
    texts = with_hash(docs.select(text_col), text_col, digest, text=True).select(HASH, TEXT)
    bounds = texts.join(several, HASH, "left_semi").groupBy(HASH).agg(F.min(TEXT).alias("a"), F.max(TEXT).alias("z"))
    return store(bounds.filter("a != z").select(HASH), "exact-collided")


def _keyed(docs: DataFrame, collided: DataFrame, text_col: str, digest) -> DataFrame:
    """``docs`` with its class key: the hash, followed by the text where the hash has collided."""
    if collided.isEmpty():
        return with_hash(docs, text_col, digest).withColumnRenamed(HASH, KEY)
    found = with_hash(docs, text_col, digest, text=True)
    marked = found.join(collided.withColumn("__hit", F.lit(True)), HASH, "left")
    key = F.when(F.col("__hit"), F.concat(HASH, TEXT)).otherwise(F.col(HASH))
    return marked.withColumn(KEY, key).drop(HASH, TEXT, "__hit")


def _classes(docs: DataFrame, id_col: str, text_col: str, keep: str, digest) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(collided hashes, rows by key, id and number of copies, classes)."""
    if keep not in ("min", "max"):
        raise ValueError("keep is 'min' or 'max'")
    narrow = docs.select(id_col, text_col)
    by_id = with_hash(narrow, text_col, digest).groupBy(id_col, HASH, SHA).agg(F.count(F.lit(1)).alias(COPIES))
    rows = store(by_id, "exact-rows")
    collided = _collided(docs, rows, text_col, digest)
    if collided.isEmpty():
        rows = rows.withColumnRenamed(HASH, KEY)
    else:
        keyed = _keyed(narrow, collided, text_col, digest)
        rows = store(keyed.groupBy(id_col, KEY, SHA).agg(F.count(F.lit(1)).alias(COPIES)), "exact-rows")
    # A null id sorts behind every other one.
    order = F.struct(F.col(id_col).isNull() if keep == "min" else F.col(id_col).isNotNull(), id_col, COPIES)
    best = (F.min if keep == "min" else F.max)(order)
    groups = rows.groupBy(KEY).agg(F.sum(COPIES).alias("__size"), best.alias("__best"))
    groups = groups.select(
        KEY, "__size", F.col("__best")[id_col].alias("__keep"), F.col("__best")[COPIES].alias("__kept_copies")
    )
    return collided, rows, groups


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, keep: str = "min", digest=md5
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    _, rows, groups = _classes(docs, id_col, text_col, keep, digest)
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col(COPIES)))
    return (
        rows.join(groups, KEY)
        .select("*", copy.alias("__copy"))
        .select(
            id_col,
            F.col("__keep").alias("keep_id"),
            F.col("__size").alias("group_size"),
            (F.col(id_col).eqNullSafe(F.col("__keep")) & (F.col("__copy") == 1)).alias("kept"),
            F.col(SHA).alias("text_sha256"),
        )
    )


def drop_exact_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, keep: str = "min", digest=md5
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    collided, _, groups = _classes(docs, id_col, text_col, keep, digest)
    keyed = _keyed(docs, collided, text_col, digest).drop(SHA)
    groups = groups.withColumnRenamed(KEY, "__group_key").drop("__size")
    on = (keyed[KEY] == groups["__group_key"]) & keyed[id_col].eqNullSafe(groups["__keep"])
    kept = keyed.join(groups, on)
    once = kept.filter("__kept_copies = 1").select(*docs.columns)
    again = kept.filter("__kept_copies > 1").dropDuplicates([KEY]).select(*docs.columns)
    return once.unionByName(again)
