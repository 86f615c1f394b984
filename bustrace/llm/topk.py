"""Exact top-k search by distributed histogram selection.

Every query is scored against every row, in blocks. Each pass counts scores in ``BINS`` bins of a query's interval,
sums the counts of all tasks, finds the bin that holds the k-th best score and goes on inside it until the bin is one
integer wide: that is the k-th score itself. A last pass keeps all scores above it and the smallest ids at it. A task
sends no bin below its own k-th score, so it sends at most k rows per query, however many vectors are alike.

Components become floor(1024 * x). Vectors that are null or hold a null or non-finite component take no part. Missing
components of shorter vectors count as 0. A row is not compared with rows of its own id; repeated rows of another id
each take a rank; of query rows that repeat an id, the smallest vector asks. Null ids take no part. Fewer than k rows:
all are returned; an empty table gives an empty result. Scores are exact below 2^53 and wrap like a long beyond 2^63.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bustrace.session import BROADCAST_BYTES, store

K = 10
SCALE = 1024
BINS = 4096
ROWS_PER_BLOCK = 2048
QUERIES_PER_BLOCK = 512
BLOCKS_PER_TASK = 8  # histograms of so many query blocks are held at once: 16 MB each

_PACKED = "ids binary, mat binary, n int, dim int, norm double"


def _integers(column: pd.Series) -> np.ndarray:
    """Rows of whole numbers, padded with 0 to the longest."""
    size = max(map(len, column), default=0)
    out = np.zeros((len(column), size), np.int64)
    for i, x in enumerate(column):
        out[i, : len(x)] = x
    return out


def _packed(ids: np.ndarray, mat: np.ndarray) -> dict:
    norm = float(np.sqrt((mat.astype(np.float64) ** 2).sum(axis=1)).max(initial=0))
    return {"ids": ids.tobytes(), "mat": mat.tobytes(), "n": len(ids), "dim": mat.shape[1], "norm": norm}


def _unpack(ids: bytes, mat: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(mat, np.int64).reshape(len(ids), dim)


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, ints): the rows that take part, in whole numbers."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    ints = F.transform(x, lambda c: F.floor(c * SCALE).cast("long"))
    return vectors.filter(F.col(id_col).isNotNull() & x.isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("id"), ints.alias("ints")
    )


def _pack_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for at in range(0, len(frame), ROWS_PER_BLOCK):
            part = frame.iloc[at : at + ROWS_PER_BLOCK]
            yield pd.DataFrame([_packed(part["id"].to_numpy(np.int64), _integers(part["ints"]))])


def _pack_queries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A partition is a block; its number is the partition's."""
    parts = list(frames)
    frame = pd.concat(parts) if parts else pd.DataFrame()
    if len(frame):
        block = _packed(frame["id"].to_numpy(np.int64), _integers(frame["ints"]))
        block["lo"] = frame["lo"].to_numpy(np.int64).tobytes()
        block["need"] = frame["need"].to_numpy(np.int64).tobytes()
        yield pd.DataFrame([{"block": TaskContext.get().partitionId(), **block}])


def _scores(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query ids, candidate ids, scores by query and candidate, which of them count)."""
    qids, q = _unpack(row.qids, row.qmat, row.qdim)
    ids, c = _unpack(row.ids, row.mat, row.dim)
    dim = min(q.shape[1], c.shape[1])
    q, c = q[:, :dim], c[:, :dim]
    if row.norm * row.qnorm < 2.0**52:
        scores = (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    else:
        scores = q @ c.T
    return qids, ids, scores, qids[:, None] != ids[None, :]


def _histogram(width: int, span: int):
    """Counts of the scores from a query's ``lo`` to ``lo + span``."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple] = {}

        def flush() -> Iterator[pd.DataFrame]:
            for qids, need, counts in held.values():
                above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts  # in higher bins
                slot, at = np.nonzero((counts > 0) & (above < need[:, None]))
                yield pd.DataFrame({"id": qids[slot], "bin": at.astype(np.int32), "n": counts[slot, at]})
            held.clear()

        for frame in frames:
            for row in frame.itertuples(index=False):
                qids, _, scores, other = _scores(row)
                if row.block not in held and len(held) == BLOCKS_PER_TASK:
                    yield from flush()
                if row.block not in held:
                    need = np.frombuffer(row.need, np.int64)
                    held[row.block] = qids, need, np.zeros((len(qids), BINS), np.int64)
                at = scores - np.frombuffer(row.lo, np.int64)[:, None]
                inside = other & (at >= 0) & (at < span)
                at //= width
                slot = np.broadcast_to(np.arange(len(qids))[:, None], at.shape)[inside]
                counts = held[row.block][2]
                counts += np.bincount(slot * BINS + at[inside], minlength=counts.size).reshape(counts.shape)
        yield from flush()

    return count


def _winners(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Scores above the k-th one, and a task's smallest ids at it."""
    ties: dict[int, pd.DataFrame] = {}

    def fewest(block: int) -> pd.DataFrame:
        t = ties[block].sort_values(["query_id", "vec_id"])
        return t[t.groupby("query_id").cumcount() < t["need"]]

    for frame in frames:
        for row in frame.itertuples(index=False):
            qids, ids, scores, other = _scores(row)
            kth, need = np.frombuffer(row.lo, np.int64)[:, None], np.frombuffer(row.need, np.int64)
            q, c = np.nonzero(other & (scores > kth))
            yield pd.DataFrame({"query_id": qids[q], "vec_id": ids[c], "score": scores[q, c]})
            q, c = np.nonzero(other & (scores == kth))
            found = pd.DataFrame({"query_id": qids[q], "vec_id": ids[c], "score": scores[q, c], "need": need[q]})
            if row.block not in ties and len(ties) == BLOCKS_PER_TASK:
                first = next(iter(ties))
                yield fewest(first).drop(columns="need")
                del ties[first]
            ties[row.block] = pd.concat([ties[row.block], found]) if row.block in ties else found
            ties[row.block] = fewest(row.block)
    for block in ties:
        yield fewest(block).drop(columns="need")


def _meet(blocks: DataFrame, queries: DataFrame, n: int, size: int) -> DataFrame:
    """Every block of rows with each of the ``n`` blocks of queries, by the latter's number."""
    pairs = blocks.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    if size <= BROADCAST_BYTES:
        return pairs.join(F.broadcast(queries), "block")
    salt = F.pmod(F.xxhash64("ids"), F.lit(64))
    copies = queries.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(63).cast("long"))))
    return pairs.withColumn("__salt", salt).join(copies, ["block", "__salt"])


def top_k(
    vectors: DataFrame,
    is_query: F.Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    *,
    k: int = K,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for each row for which ``is_query`` holds."""
    blocks = whole_vectors(vectors, id_col, vector_col).mapInPandas(_pack_rows, _PACKED)
    blocks = store(blocks, "topk-rows")
    asked = whole_vectors(vectors.filter(is_query), id_col, vector_col)
    asked = store(asked.groupBy("id").agg(F.min("ints").alias("ints")), "topk-queries")
    n_queries = asked.count()
    longest = asked.agg(F.max(F.size("ints"))).first()[0] or 0
    n_blocks = max(1, -(-n_queries // QUERIES_PER_BLOCK))
    query_norm = asked.select(F.max(F.sqrt(F.aggregate("ints", F.lit(0.0), lambda a, c: a + c * c)))).first()[0]
    most = int((blocks.agg(F.max("norm")).first()[0] or 0) * (query_norm or 0)) + 2
    most = min(most, 2**62)

    def meet(state: DataFrame) -> DataFrame:
        rows = asked.join(state, "id").repartition(n_blocks, "id")
        packed = rows.mapInPandas(_pack_queries, f"block int, {_PACKED}, lo binary, need binary")
        names = {"ids": "qids", "mat": "qmat", "dim": "qdim", "norm": "qnorm"}
        packed = packed.withColumnsRenamed(names).drop("n")
        return _meet(blocks.drop("n"), packed, n_blocks, n_queries * 8 * (longest + 4))

    state = asked.select("id", F.lit(-most).cast("long").alias("lo"), F.lit(k).cast("long").alias("need"))
    width = 2 * most + 1
    while width > 1:
        span, width = width, -(-width // BINS)
        bins = meet(state).mapInPandas(_histogram(width, span), "id long, bin int, n long")
        bins = bins.groupBy("id", "bin").agg(F.sum("n").alias("n"))
        above = F.sum("n").over(Window.partitionBy("id").orderBy(F.desc("bin"))) - F.col("n")
        reached = bins.withColumn("above", above).alias("b").join(state.alias("s"), "id")
        reached = reached.filter("above < need and need <= above + n")
        found = reached.select("id", (F.col("lo") + F.col("bin") * width).alias("lo"), (F.col("need") - F.col("above")).alias("need"))
        # Fewer rows than asked for: the lowest bin stays, so that everything is above it.
        missing = state.join(found, "id", "left_anti")
        state = store(found.unionByName(missing), "topk-state")
    best = meet(state).mapInPandas(_winners, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
