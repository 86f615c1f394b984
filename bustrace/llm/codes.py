"""Vectors as short codes: product quantisation by a dual-tree Lloyd iteration in whole numbers.

Components become floor(``SCALE`` * x), vectors are cut into equal consecutive parts, and each part position has a
codebook. Rows are packed into blocks once; a block holds a tree over its rows for each part position, with the bounds,
counts and sums of every node, and is written to the shared folder. A round grows a tree over the entries and goes down
both trees together: a pair of nodes whose least distance exceeds the greatest distance to some other node of entries is
dropped, a node of rows with one entry left is assigned whole by its cached sums, and the rows of leaves with several
entries left are compared one by one. All bounds and distances are integers, so the result is that of comparing every
row with every entry. Only sums per entry and position leave a task; the driver holds the codebooks, whose size is set
by the parameters.

Defined results: null vectors, empty ones and those with a null or non-finite component take no part, nor do vectors
that are not as long as that of the smallest id. The first codebooks are the smallest ids' parts, null ids last; rows
that repeat an id are ordered by their vectors. Fewer rows than entries give as many entries as rows. Ties go to the
lower index. An empty table gives an empty result. A length that can't be cut into equal parts, and components whose
squared distances could pass 62 bits, raise ``ValueError``. Further columns don't matter; null labels are one label.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bustrace.llm.batches import bounded_batches
from bustrace.session import broadcast_if_small, store

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
ROWS_PER_BLOCK = 4096
LEAF = 16  # fewest rows of a leaf

#: parts x entries x components of a part
Codebooks = np.ndarray


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, keep: list[str], scale: int = SCALE) -> DataFrame:
    """(id, kept columns as k0, k1, …, x): the rows that take part, in whole numbers."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    ints = F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    columns = [F.col(id_col).alias("id"), *(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)), ints.alias("x")]
    return vectors.filter(x.isNotNull() & (F.size(x) > 0) & finite).select(*columns)


class Tree:
    """A balanced tree: node ``j`` of level ``l`` holds the points from ``j * n >> l`` up to ``(j + 1) * n >> l``."""

    def __init__(self, points: np.ndarray, leaf: int):
        n = len(points)
        depth = max(0, (n // leaf).bit_length() - 1)
        order = np.arange(n)
        for level in range(depth):
            at = self.bounds(n, level + 1)
            for a, middle, z in zip(at[:-1:2], at[1::2], at[2::2], strict=True):
                part = points[order[a:z]]
                widest = np.argmax(part.max(axis=0) - part.min(axis=0))
                order[a:z] = order[a:z][np.argpartition(part[:, widest], middle - a)]
        self.order, self.points = order.astype(np.int32), points[order]
        at = self.bounds(n, depth)[:-1]
        self.low, self.high = [np.minimum.reduceat(self.points, at)], [np.maximum.reduceat(self.points, at)]
        self.sums = [np.add.reduceat(self.points, at)]
        for _ in range(depth):
            self.low.insert(0, self.low[0].reshape(-1, 2, points.shape[1]).min(axis=1))
            self.high.insert(0, self.high[0].reshape(-1, 2, points.shape[1]).max(axis=1))
            self.sums.insert(0, self.sums[0].reshape(-1, 2, points.shape[1]).sum(axis=1))

    @staticmethod
    def bounds(n: int, level: int) -> np.ndarray:
        return np.arange((1 << level) + 1) * n >> level

    @property
    def depth(self) -> int:
        return len(self.low) - 1

    _FIELDS = ("order", "points", "low", "high", "sums")

    @classmethod
    def write(cls, trees: list[Tree]) -> dict[str, bytes]:
        """The trees of all parts of a block, field by field; the levels of a field follow each other."""

        def flat(tree: Tree, name: str) -> bytes:
            value = getattr(tree, name)
            return (np.concatenate(value) if isinstance(value, list) else value).astype(np.int64 if name == "sums" else np.int32).tobytes()

        return {name: b"".join(flat(t, name) for t in trees) for name in cls._FIELDS}

    @classmethod
    def read(cls, block: dict, parts: int) -> list[Tree]:
        n = block["n"]
        raw = {f: np.frombuffer(block[f], np.int64 if f == "sums" else np.int32).reshape(parts, -1) for f in cls._FIELDS}
        width = raw["points"].shape[1] // n
        levels = (raw["low"].shape[1] // width + 1).bit_length() - 1
        cuts = np.cumsum([1 << k for k in range(levels)])[:-1]
        trees = []
        for p in range(parts):
            tree = cls.__new__(cls)
            tree.order, tree.points = raw["order"][p], raw["points"][p].reshape(n, width).astype(np.int64)
            for f in ("low", "high", "sums"):
                setattr(tree, f, np.split(raw[f][p].reshape(-1, width).astype(np.int64), cuts))
            trees.append(tree)
        return trees


def assign(rows: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry of each row in tree order, sums per entry, counts per entry)."""
    n, k = len(rows.points), len(entries)
    found = np.full(n, -1, np.int32)
    sums, counts = np.zeros(entries.shape, np.int64), np.zeros(k, np.int64)
    codes = Tree(entries, 1)
    leaf_of = np.repeat(np.arange(1 << codes.depth), np.diff(Tree.bounds(k, codes.depth)))
    alive = np.ones((1, 1), bool)
    q, r = 0, 0  # levels; the one below the last level of entries are the entries themselves
    while True:
        low, high = (codes.points, codes.points) if r > codes.depth else (codes.low[r], codes.high[r])
        a, b = np.nonzero(alive)
        gap = np.maximum(0, np.maximum(low[b] - rows.high[q][a], rows.low[q][a] - high[b]))
        reach = np.maximum(high[b] - rows.low[q][a], rows.high[q][a] - low[b])
        most = np.full(len(alive), np.iinfo(np.int64).max)
        np.minimum.at(most, a, (reach * reach).sum(axis=1))
        alive[a, b] = (gap * gap).sum(axis=1) <= most[a]
        if r > codes.depth:
            # One entry left: the whole node goes to it.
            sure = np.nonzero(alive.sum(axis=1) == 1)[0]
            entry = codes.order[alive[sure].argmax(axis=1)]
            at = Tree.bounds(n, q)
            np.add.at(sums, entry, rows.sums[q][sure])
            np.add.at(counts, entry, at[sure + 1] - at[sure])
            for node, e in zip(sure, entry, strict=True):
                found[at[node] : at[node + 1]] = e
            alive[sure] = False
            if q == rows.depth:
                break
        if r <= codes.depth:
            r += 1
            alive = alive[:, leaf_of] if r > codes.depth else alive.repeat(2, axis=1)
        if q < rows.depth:
            q += 1
            alive = alive.repeat(2, axis=0)
    open_rows = np.nonzero(found < 0)[0]
    leaf = np.repeat(np.arange(len(alive)), np.diff(Tree.bounds(n, q)))[open_rows]
    may = np.zeros_like(alive)
    may[:, codes.order] = alive
    points = rows.points[open_rows]
    apart = np.full((len(points), k), np.iinfo(np.int64).max)
    for e in range(k):
        near = np.nonzero(may[leaf, e])[0]
        apart[near, e] = ((points[near] - entries[e]) ** 2).sum(axis=1)
    entry = apart.argmin(axis=1) if k else np.zeros(0, int)
    found[open_rows] = entry
    np.add.at(sums, entry, points)
    counts += np.bincount(entry, minlength=k)
    return found, sums, counts


def _kept_names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c == "id" or (c[0] == "k" and c[1:].isdigit())]


def blocks(whole: DataFrame, dim: int, parts: int = PARTS) -> DataFrame:
    """Rows of ``whole_vectors`` in blocks, each with a tree for every part; stored, as every round reads them."""
    bounded_batches(whole.sparkSession)
    most = min(isqrt((1 << 60) // dim), 1 << 30)
    names = _kept_names(whole)
    fields = [T.StructField(c, T.ArrayType(whole.schema[c].dataType)) for c in names]
    schema = T.StructType([*fields, T.StructField("n", T.IntegerType())])
    for f in Tree._FIELDS:
        schema = schema.add(f, "binary")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, ROWS_PER_BLOCK):
                batch = whole_batch.slice(at, ROWS_PER_BLOCK)
                n = batch.num_rows
                mat = batch.column(len(names)).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, dim)
                if max(-int(mat.min()), int(mat.max())) > most:
                    raise ValueError(f"a component is too large: its whole number is beyond {most}")
                trees = Tree.write([Tree(np.ascontiguousarray(m), LEAF) for m in np.split(mat, parts, axis=1)])
                kept = [pa.ListArray.from_arrays([0, n], batch.column(i)) for i in range(len(names))]
                rest = [pa.array([n], pa.int32()), *(pa.array([trees[f]], pa.binary()) for f in Tree._FIELDS)]
                yield pa.RecordBatch.from_arrays([*kept, *rest], names=schema.names)

    same = whole.filter(F.size("x") == dim).select(*names, "x")
    return store(same.mapInArrow(pack, schema), "code-blocks")


def _sums(codebooks: Codebooks):
    """Sums and counts per part, entry and position, of all blocks of a task."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = codebooks.shape
        sums, counts = np.zeros(codebooks.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for block in batch.to_pylist():
                for p, tree in enumerate(Tree.read(block, parts)):
                    _, s, c = assign(tree, codebooks[p])
                    sums[p] += s
                    counts[p] += c
        part, entry = np.nonzero(counts)
        if len(part):
            lists = pa.FixedSizeListArray.from_arrays(pa.array(sums[part, entry].ravel()), width).cast(pa.list_(pa.int64()))
            columns = [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), lists, pa.array(counts[part, entry])]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "sums", "n"])

    return add


def first_codebooks(whole: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks | None:
    """The parts of the smallest ids' vectors; None where there are no rows."""
    first = [r["x"] for r in whole.orderBy(F.col("id").asc_nulls_last(), "x").limit(1).collect()]
    if not first:
        return None
    dim = len(first[0])
    if dim % parts:
        raise ValueError(f"vectors of {dim} components can't be cut into {parts} equal parts")
    rows = whole.filter(F.size("x") == dim).orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()
    return np.stack(np.split(np.array([r["x"] for r in rows], np.int64), parts, axis=1))


def learn(packed: DataFrame, codebooks: Codebooks, rounds: int = ROUNDS) -> Codebooks:
    """The codebooks after so many rounds: each entry becomes the floor of the mean of its parts."""
    fields = packed.select("n", *Tree._FIELDS)
    for _ in range(rounds):
        found = fields.mapInArrow(_sums(codebooks), "part int, entry int, sums array<long>, n long")
        found = found.select("part", "entry", "n", F.posexplode("sums").alias("at", "x"))
        found = found.groupBy("part", "entry", "at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("n").alias("n"))
        codebooks = codebooks.copy()
        for row in found.collect():  # at most parts x entries x components
            codebooks[row["part"], row["entry"], row["at"]] = int(row["x"]) // row["n"]
    return codebooks


def coded(packed: DataFrame, codebooks: Codebooks) -> DataFrame:
    """One row per vector: id, kept columns, codes (an index per part) and error, the squared distance to what they stand for."""
    names = _kept_names(packed)
    schema = T.StructType([T.StructField(c, packed.schema[c].dataType.elementType) for c in names])
    schema = schema.add("codes", T.ArrayType(T.IntegerType())).add("error", "long")
    parts = len(codebooks)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = {f: batch.column(batch.schema.get_field_index(f))[i].as_py() for f in ("n", *Tree._FIELDS)}
                codes, error = np.empty((block["n"], parts), np.int32), np.zeros(block["n"], np.int64)
                for p, tree in enumerate(Tree.read(block, parts)):
                    entry, _, _ = assign(tree, codebooks[p])
                    codes[tree.order, p] = entry
                    error[tree.order] += ((tree.points - codebooks[p][entry]) ** 2).sum(axis=1)
                kept = [batch.column(k)[i].values for k in range(len(names))]
                lists = pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel()), parts).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*kept, lists, pa.array(error)], names=schema.names)

    return packed.select(*names, "n", *Tree._FIELDS).mapInArrow(code, schema)


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    keep: list[str] | None = None,
    *,
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks | None]:
    """The codes of all vectors that take part, with the columns to keep, and the codebooks they refer to."""
    keep = keep or []
    whole = whole_vectors(vectors, id_col, vector_col, keep, scale)
    codebooks = first_codebooks(whole, parts, entries)
    names = {"id": id_col} | {f"k{i}": c for i, c in enumerate(keep)}
    if codebooks is None:
        none = whole.select(*_kept_names(whole), F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("long").alias("error"))
        return none.withColumnsRenamed(names), None
    packed = blocks(whole, codebooks.shape[0] * codebooks.shape[2], parts)
    codebooks = learn(packed, codebooks, rounds)
    return store(coded(packed, codebooks), "codes").withColumnsRenamed(names), codebooks


def hex_code(codes: F.Column) -> F.Column:
    """The indexes as two lowercase hex digits each."""
    return F.array_join(F.transform(codes, lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")


def restored(codes: F.Column, codebooks: Codebooks, scale: int = SCALE) -> F.Column:
    """The vector that a row's codes stand for."""
    table = F.array(*(F.array(*(F.array(*map(F.lit, (e / scale).tolist())) for e in book)) for book in codebooks))
    return F.flatten(F.zip_with(table, codes, lambda book, c: F.element_at(book, c + 1)))


def codebooks_sha256(codebooks: Codebooks) -> str:
    """Of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def with_label_error(coded_rows: DataFrame, label_col: str) -> DataFrame:
    """The rows with ``label_error``, the sum of ``error`` over equal labels; null labels are one."""
    sums = coded_rows.groupBy(F.col(label_col).alias("__label")).agg(F.sum("error").alias("label_error"))
    return coded_rows.join(broadcast_if_small(sums), F.col(label_col).eqNullSafe(F.col("__label"))).drop("__label")
