"""MinHash near-dedup by an inverted join on signature coordinates.

1. Every text becomes the set of its word shingles and a signature of ``COORDINATES`` minima. Equal sets are one class.
2. A class is posted under the pairs (coordinate, value) of its signature. Two signatures that agree in at least
   ``MATCHES`` coordinates share one of the ``COORDINATES - MATCHES + 1`` rarest pairs of each, whatever order ranks the
   pairs, so only that prefix is posted and the rest skipped. Rarity is known for a fixed number of the most frequent pairs.
3. Postings that meet anyone are grouped by pair. Inside a group agreeing coordinates are counted, and classes whose
   count reaches ``MATCHES`` are chained to one cluster. Groups beyond ``GROUP_ROWS`` are one cluster as they are.
4. Inside a cluster all links are confirmed on the full sets, in blocks of bounded size; a block returns one star per
   group it found, never its pairs. Clusters of many blocks are first joined within blocks, then by a few members of
   each part; what is still apart from a cluster's largest part is compared with all of the cluster.
5. Components of the confirmed links name the groups.

At a similarity of 0.8 a link's signatures agree in 51 of 64 coordinates on average and in fewer than 36 with a
probability of about one in a million; everything behind the signatures is exact.

Defined results: a null or blank text has no shingles and is linked with nothing (its component is its own id); texts
of fewer words than a shingle are one shingle; a null id is named after its group's smallest id, null if there is none;
repeated rows are in one group; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bustrace.llm.batches import bounded_batches
from bustrace.llm.components import components
from bustrace.session import BROADCAST_BYTES, broadcast_if_small, store

SHINGLE_WORDS = 4
SIMILARITY = 80  # per cent of the union
COORDINATES = 64
MATCHES = 36
FREQUENT = 1 << 15  # pairs whose frequency ranks them; all others rank before them, by name
RARE = 4  # a pair seen less often among so many is left out:
COUNTED_AT_ONCE = 1 << 20
GROUP_ROWS = 1024
BLOCK_ROWS = 512
BLOCK_SHINGLES = 1 << 20
WITNESSES = 32  # members of a part that stand for it when the parts of a large cluster are joined
HELD = 1 << 18

_MIX = tuple(np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
_FACTORS = (np.random.default_rng(11).integers(0, 1 << 31, COORDINATES) * 2 + 1).astype(np.uint32)[:, None]

_words: dict[bytes, int] = {}


def shingle_set(text: bytes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles of a lower-cased text."""
    found = text.split()
    if len(_words) > HELD:
        _words.clear()
    hashes = np.empty(len(found), np.uint64)
    for i, word in enumerate(found):
        h = _words.get(word)
        if h is None:
            h = _words[word] = xxhash.xxh64_intdigest(word)
        hashes[i] = h
    if len(hashes) < size:
        return np.array([xxhash.xxh64_intdigest(hashes.tobytes(), seed=1)] if found else [], np.uint64)
    last = len(hashes) - size
    out = hashes[: last + 1] * _MIX[0]
    for i in range(1, size):
        out ^= out >> np.uint64(29 + i)
        out = out * _MIX[i % 4] + hashes[i : last + i + 1]
    out = (out ^ (out >> np.uint64(31))) * _MIX[1]
    return np.unique(out ^ (out >> np.uint64(30)))


def signature(shingles: np.ndarray) -> np.ndarray:
    folded = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    least = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(folded), 8192):
        np.minimum(least, (_FACTORS * folded[None, at : at + 8192]).min(axis=1), out=least)
    return least


def _lowered(column: pa.Array) -> pa.Array:
    return pc.fill_null(pc.ascii_lower(column), "").cast(pa.large_string()).cast(pa.large_binary())


def _set_id(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def signatures(docs: DataFrame, id_col: str, text_col: str, size: int = SHINGLE_WORDS) -> DataFrame:
    """(id, n_shingles, set_id, sig) of every document."""
    bounded_batches(docs.sparkSession)
    schema = T.StructType([docs.schema[id_col]]).add("n_shingles", "long").add("set_id", "binary").add("sig", "binary")

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ids, sigs = [], [], []
            for text in _lowered(batch.column(1)):
                shingles = shingle_set(text.as_py(), size)
                n.append(len(shingles))
                ids.append(_set_id(shingles))
                sigs.append(signature(shingles).tobytes())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(sigs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(signed, schema)


def _pairs_of(sigs: list[bytes]) -> np.ndarray:
    """64-bit names of the (coordinate, value) pairs of each signature."""
    values = np.frombuffer(b"".join(sigs), np.uint32).reshape(-1, COORDINATES).astype(np.uint64)
    names = (values | (np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32))) * _MIX[0]
    return (names ^ (names >> np.uint64(32))) * _MIX[1]


def _frequent(classes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Names (sorted) and counts of the ``FREQUENT`` pairs that most classes have; tasks leave out what they see rarely."""

    def counts(found: list[np.ndarray]) -> pa.RecordBatch:
        names, n = np.unique(np.concatenate(found), return_counts=True)
        several = n >= RARE
        columns = [pa.array(names[several].view(np.int64)), pa.array(n[several].astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["pair", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        for batch in batches:
            if batch.num_rows:
                found.append(_pairs_of(batch.column(0).to_pylist()).ravel())
            if sum(map(len, found)) >= COUNTED_AT_ONCE:
                yield counts(found)
                found = []
        if found:
            yield counts(found)

    counted = classes.select("sig").mapInArrow(count, "pair long, n long")
    counted = counted.groupBy("pair").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pair").limit(FREQUENT).toPandas()
    names = counted["pair"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(names)
    return names[order], counted["n"].to_numpy(np.int64)[order]


def _counts_of(names: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The counts of frequent pairs, 0 for others."""
    known, n = frequent
    if not len(known):
        return np.zeros(names.shape, np.int64)
    at = np.minimum(np.searchsorted(known, names), len(known) - 1)
    return np.where(known[at] == names, n[at], 0)


def _postings(classes: DataFrame, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(pair, node) for the rarest pairs of each class, enough for two that agree to meet."""
    prefix = COORDINATES - MATCHES + 1

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            names = _pairs_of(batch.column(1).to_pylist())
            rarest = np.lexsort((names, _counts_of(names, frequent)), axis=1)[:, :prefix]
            pairs = np.take_along_axis(names, rarest, 1).ravel().view(np.int64)
            nodes = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), prefix)
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(nodes)], names=["pair", "node"])

    return classes.select("node", "sig").mapInArrow(post, "pair long, node long")


def _stars(n: int, left: np.ndarray, right: np.ndarray, nodes: np.ndarray) -> list[tuple[int, int]]:
    """For links between places, (smallest node, other node) of each connected group."""
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i, k in zip(left.tolist(), right.tolist(), strict=True):
        a, b = root(i), root(k)
        if a != b:
            if nodes[b] < nodes[a]:
                a, b = b, a
            parent[b] = a
    return [(int(nodes[root(i)]), int(nodes[i])) for i in range(n) if root(i) != i]


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (pair, node, n, sig), sorted by pair: stars over the classes of a pair whose signatures agree enough."""
    pending: list[pd.DataFrame] = []

    def linked(groups: pd.DataFrame) -> pa.RecordBatch:
        pairs = groups["pair"].to_numpy()
        nodes, sizes = groups["node"].to_numpy(), groups["n"].to_numpy()
        sigs = np.frombuffer(b"".join(groups["sig"]), np.uint32).reshape(-1, COORDINATES)
        edges: set[tuple[int, int]] = set()
        bounds = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1], [True]]))
        for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            own, n = sigs[a:z], sizes[a:z]
            left, right = [], []
            for i in range(z - a - 1):
                alike = (own[i + 1 :] == own[i]).sum(axis=1) >= MATCHES
                alike &= np.minimum(n[i], n[i + 1 :]) * 100 >= np.maximum(n[i], n[i + 1 :]) * SIMILARITY
                (k,) = alike.nonzero()
                left.append(np.full(len(k), i))
                right.append(k + i + 1)
            if left:
                edges.update(_stars(z - a, np.concatenate(left), np.concatenate(right), nodes[a:z]))
        found = np.array(sorted(edges), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        frame = batch.to_pandas()
        last = frame["pair"].iloc[-1]
        whole = frame[frame["pair"] != last]
        if len(whole) or (pending and pending[0]["pair"].iloc[-1] != last):
            yield linked(pd.concat([*pending, whole]))
            pending = []
        pending.append(frame[frame["pair"] == last])
    if pending:
        yield linked(pd.concat(pending))


def _candidates(classes: DataFrame) -> DataFrame:
    """Links (a, b) that chain all classes whose signatures agree enough."""
    postings = _postings(classes, _frequent(classes))
    groups = postings.groupBy("pair").agg(F.count(F.lit(1)).alias("m"), F.min("node").alias("first")).filter("m > 1")
    met = store(postings.join(groups, "pair"), "minhash-postings")
    small = met.filter(F.col("m") <= GROUP_ROWS).select("pair", "node")
    small = small.join(classes.select("node", F.col("n_shingles").alias("n"), "sig"), "node")
    small = small.select("pair", "node", "n", "sig").repartition("pair").sortWithinPartitions("pair", "node")
    chained = small.mapInArrow(_agreeing, "a long, b long")
    large = met.filter(F.col("m") > GROUP_ROWS).select(F.col("first").alias("a"), F.col("node").alias("b"))
    return chained.unionByName(large)


def _linked_block(frame: pd.DataFrame) -> pd.DataFrame:
    """Stars (a, b) over the confirmed links of a block's rows, cluster by cluster.

    Pairs of one part (already joined) aren't compared, nor pairs without a row of side 1.
    """
    edges: list[tuple[int, int]] = []
    for _, rows in frame.groupby("cluster", sort=False):
        rows = rows.drop_duplicates(["node", "side"])
        nodes, parts, side = rows["node"].to_numpy(), rows["part"].to_numpy(), rows["side"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in rows["shingles"]]
        sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = times[column] > 1
        owner, column = owner[shared], column[shared]
        used, column = np.unique(column, return_inverse=True)
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        both = np.zeros((len(sets), len(sets)), np.int64)
        for at in range(0, len(used), 4096):
            a, z = np.searchsorted(column, (at, at + 4096))
            has = np.zeros((len(sets), min(4096, len(used) - at)), np.float32)
            has[owner[a:z], column[a:z] - at] = 1
            both += (has @ has.T).astype(np.int64)
        union = sizes[:, None] + sizes[None, :] - both
        link = (100 * both >= SIMILARITY * union) & (parts[:, None] != parts[None, :])
        link &= (side[:, None] == 1) | (side[None, :] == 1)
        left, right = np.nonzero(np.triu(link, 1))
        # A node that is there on both sides has two places and one name.
        edges += [(a, b) for a, b in _stars(len(sets), left, right, nodes) if a != b]
    return pd.DataFrame(sorted(set(edges)), columns=["a", "b"], dtype=np.int64)


_ROW = ["cluster", "node", "part", "side", "shingles"]


def _confirm(rows: DataFrame) -> DataFrame:
    return rows.groupBy("block").applyInPandas(lambda _, f: _linked_block(f), "a long, b long")


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, size: int, repeated: bool) -> DataFrame:
    """(cluster, node, n, shingles) of the classes in ``wanted`` (id, set_id, cluster, node)."""
    if wanted.count() * 128 <= BROADCAST_BYTES:
        wanted = F.broadcast(wanted)
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    rows = rows.join(wanted, rows["__id"].eqNullSafe(F.col("first_id"))).select("__text", "set_id", "cluster", "node")
    schema = "cluster long, node long, n long, shingles binary"

    def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, found = [], []
            for i, (text, set_id) in enumerate(zip(_lowered(batch.column(0)), batch.column(1), strict=True)):
                shingles = shingle_set(text.as_py(), size)
                if _set_id(shingles) == set_id.as_py():
                    kept.append(i)
                    found.append(shingles)
            at = pa.array(kept, pa.int64())
            columns = [batch.column(2).take(at), batch.column(3).take(at), pa.array([len(x) for x in found], pa.int64())]
            columns.append(pa.array([x.tobytes() for x in found], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["cluster", "node", "n", "shingles"])

    sets = rows.mapInArrow(rebuilt, schema)
    return sets.dropDuplicates(["node"]) if repeated else sets


def _confirmed(sets: DataFrame) -> DataFrame:
    """Links (a, b) whose components are those of all pairs in a cluster that are similar enough."""
    sizes = sets.groupBy("cluster").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("s"))
    parts = F.greatest(F.ceil(F.col("m") / BLOCK_ROWS), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("long")
    sizes = store(sizes.withColumn("blocks", parts), "minhash-clusters")
    blocks = broadcast_if_small(sizes.select("cluster", "blocks"))
    total = sizes.filter("blocks = 1").agg(F.sum("s")).first()[0] or 0
    buckets = 2 * (total // BLOCK_SHINGLES) + 8
    one = F.lit(1)
    rows = sets.join(blocks, "cluster").withColumn("part", F.col("node")).withColumn("side", one)
    small = rows.filter("blocks = 1").withColumn("block", F.pmod(F.xxhash64("cluster"), F.lit(buckets)))
    links = _confirm(small.select("block", *_ROW))
    if sizes.filter("blocks > 1").isEmpty():
        return links
    links = store(links, "minhash-links")
    large = rows.filter("blocks > 1")

    def block(seed: int) -> F.Column:
        return F.xxhash64("cluster", F.pmod(F.xxhash64(F.lit(seed), "node"), F.col("blocks")))

    found = store(_confirm(large.withColumn("block", block(1)).select("block", *_ROW)), "minhash-links")
    # Witnesses of each part, dealt to other blocks: they join what the blocks have kept apart.
    large = _in_parts(large, found)
    rank = F.row_number().over(Window.partitionBy("part").orderBy(F.xxhash64(F.lit(2), "node")))
    narrow = large.select("cluster", "node", "part").withColumn("rank", rank).filter(F.col("rank") <= WITNESSES)
    count = narrow.groupBy("cluster").agg(F.ceil(F.count(one) / BLOCK_ROWS).cast("long").alias("blocks"))
    chosen = narrow.select("cluster", "node").join(count, "cluster")
    chosen = large.drop("blocks").join(chosen, ["cluster", "node"]).withColumn("block", block(2))
    found = store(found.unionByName(_confirm(chosen.select("block", *_ROW))), "minhash-links")
    large = store(_in_parts(rows.filter("blocks > 1"), found).drop("shingles"), "minhash-parts")
    largest = large.groupBy("cluster", "part").agg(F.count(one).alias("k"))
    largest = largest.groupBy("cluster").agg(F.max(F.struct("k", "part"))["part"].alias("largest"))
    apart = large.join(largest, "cluster").filter("part != largest").drop("largest")
    extent = apart.groupBy("cluster").agg(
        F.ceil(F.greatest(F.count(one) / (BLOCK_ROWS // 2), F.sum("n") / (BLOCK_SHINGLES // 2))).cast("long").alias("u")
    )
    extent = store(extent, "minhash-extent")
    if not extent.isEmpty():
        two = F.col("blocks") * 2
        row, column = F.pmod(F.xxhash64(F.lit(4), "node"), F.col("u")), F.pmod(F.xxhash64(F.lit(5), "node"), two)
        last = F.lit(1).cast("long")
        ones = apart.join(extent, "cluster").withColumn("i", row)
        ones = ones.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), two - last))).withColumn("side", one)
        others = large.join(extent, "cluster").withColumn("k", column)
        others = others.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("u") - last)))
        placed = ones.unionByName(others.withColumn("side", F.lit(2)), allowMissingColumns=True)
        placed = placed.select("cluster", "node", "part", "side", F.xxhash64("cluster", "i", "k").alias("block"))
        placed = placed.join(sets.select("node", "shingles"), "node")
        found = found.unionByName(_confirm(placed.select("block", *_ROW)))
    return links.unionByName(found)


def _in_parts(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with the part each node is in by the links found so far."""
    named = components(links).withColumnRenamed("component", "__part")
    rows = rows.join(named, "node", "left")
    return rows.withColumn("part", F.coalesce("__part", "node")).drop("__part")


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """One row per document: id, n_shingles, set_id (its class), component_id, kept, and the group's number."""
    rows = store(signatures(docs, id_col, text_col, shingle_words), "minhash-rows")
    classes = rows.filter("n_shingles > 0").groupBy("set_id")
    classes = classes.agg(F.min(id_col).alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"))
    classes = store(classes.withColumn("node", F.monotonically_increasing_id()), "minhash-classes")
    clusters = components(_candidates(classes)).withColumnRenamed("component", "cluster")
    wanted = store(classes.select("first_id", "set_id", "node").join(clusters, "node"), "minhash-wanted")
    repeated = not rows.groupBy(id_col).count().filter("count > 1").isEmpty()
    sets = store(_sets(docs, wanted, id_col, text_col, shingle_words, repeated), "minhash-sets")
    named = components(_confirmed(sets))
    joined = classes.select("set_id", "first_id", "node").join(named, "node", "left")
    groups = joined.filter("component is not null").groupBy("component").agg(F.min("first_id").alias("least"))
    joined = joined.join(groups, "component", "left")
    least = F.when(F.col("component").isNull(), F.col("first_id")).otherwise(F.col("least"))
    joined = joined.select("set_id", least.alias("__component"), F.coalesce("component", "node").alias("group"))
    out = rows.drop("sig").join(joined, "set_id", "left")
    component = F.when(F.col("n_shingles") == 0, F.col(id_col)).otherwise(F.col("__component"))
    out = out.withColumn("component_id", component)
    kept = F.col(id_col).eqNullSafe(F.col("component_id"))
    return out.select(id_col, "n_shingles", "set_id", "component_id", kept.alias("kept"), "group")


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """One row of ``docs`` of each group, and all rows without shingles, with their columns."""
    found = near_groups(docs, id_col, text_col, shingle_words=shingle_words)
    found = found.select(F.col(id_col).alias("__id"), F.col("set_id").alias("__set"), F.col("group").alias("__group"), "kept")
    found = store(found, "minhash-found")
    repeated = store(found.groupBy("__id").count().filter("count > 1").select("__id"), "minhash-repeated")
    same = docs[id_col].eqNullSafe(F.col("__id"))
    # What goes is much less than what stays; as long as it is small, no text is shuffled.
    gone = broadcast_if_small(store(found.filter("not kept").select("__id"), "minhash-gone"))
    if repeated.isEmpty():
        return docs.join(gone, same, "left_anti")
    # Rows that share an id are told apart by their sets.
    repeated = broadcast_if_small(repeated)
    single = docs.join(repeated, same, "left_anti").join(gone, same, "left_anti")
    groups = found.filter("kept").drop("kept").join(repeated, found["__id"].eqNullSafe(repeated["__id"]), "left_semi").distinct()
    several = _with_set_id(docs.join(repeated, same, "left_semi"), text_col, shingle_words)
    on = several[id_col].eqNullSafe(F.col("__id")) & (F.col("__set_id") == F.col("__set"))
    several = several.join(groups, on)
    blank = several.filter("__group is null").select(*docs.columns)
    return single.unionByName(blank).unionByName(
        several.filter("__group is not null").dropDuplicates(["__group"]).select(*docs.columns)
    )


def _with_set_id(docs: DataFrame, text_col: str, size: int) -> DataFrame:
    schema = T.StructType(list(docs.schema)).add("__set_id", "binary")
    at = docs.columns.index(text_col)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [_set_id(shingle_set(x.as_py(), size)) for x in _lowered(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], names=schema.names)

    return docs.mapInArrow(named, schema)
