"""Sharding by extendible hashing: a directory of hash prefixes in which only oversized buckets split on another bit.

A row's bits are 60 bits of the MD5 of its id, so that a shard is a function of the id; only rows with equal bits, that is
with equal ids, are told apart by 60 further bits that are drawn for each row. A bucket is a prefix of these bits. It splits
while its texts exceed the byte limit and it holds more than one row, so a shard is over the limit only if it is a single
row. Bytes are summed for fine cells first and rolled up to every shorter prefix on those sums; only rows of cells that are
still too large are looked at again, with more bits.

Defined results: a null text has no bytes; null ids hash alike and are told apart like repeated ids; texts beyond the
limit are shards of their own, marked ``oversize``; an empty table gives an empty result. All on the JVM.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bustrace.session import store

MAX_BYTES = 1 << 20
ID_BITS, ROW_BITS = 60, 60
FIRST_BITS = 24  # cells of the first pass have at most so many bits
DIRECTORY_BITS = 30  # a deeper directory is given as ranges only


def _prefix(column: str, bits: int, depth) -> F.Column:
    return F.expr(f"shiftright({column}, {bits} - {depth})")


def _leaves(rows: DataFrame, keys: list[str], column: str, bits: int, low: int, high: int, max_bytes: int) -> DataFrame:
    """Per cell of ``high`` bits: the shortest prefix from ``low`` bits on that fits. Cells that don't fit are left out."""
    cells = rows.groupBy(*keys, _prefix(column, bits, high).alias("__cell"))
    cells = store(cells.agg(F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("n")), "shard-cells")
    levels = F.explode(F.sequence(F.lit(low), F.lit(high))).alias("__depth")
    levels = cells.select("*", levels).withColumn("__bucket", F.expr(f"shiftright(__cell, {high} - __depth)"))
    sums = levels.groupBy(*keys, "__depth", "__bucket").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
    fits = sums.filter((F.col("shard_bytes") <= max_bytes) | (F.col("shard_rows") == 1))
    chosen = F.min(F.struct("__depth", "__bucket", "shard_bytes", "shard_rows")).alias("s")
    return levels.join(fits, [*keys, "__depth", "__bucket"]).groupBy(*keys, "__cell").agg(chosen).select(*keys, "__cell", "s.*")


def _digits(column: str, width) -> F.Column:
    return F.when(F.lit(width) == 0 if isinstance(width, int) else F.col(width) == 0, F.lit("")).otherwise(
        F.expr(f"lpad(bin({column}), {width}, '0')")
    )


def _split(rows: DataFrame, keys: list[str], column: str, bits: int, first: int, max_bytes: int) -> tuple[list[DataFrame], DataFrame | None]:
    """Placed rows (with __depth and __bucket), and those that are too large together in every bit."""
    placed, low, high = [], 0, first
    while True:
        leaves = store(_leaves(rows, keys, column, bits, low, high, max_bytes), "shard-leaves")
        celled = rows.withColumn("__cell", _prefix(column, bits, high))
        placed.append(celled.join(leaves, [*keys, "__cell"]).drop("__cell"))
        rest = celled.join(leaves, [*keys, "__cell"], "left_anti").drop("__cell")
        if rest.isEmpty():
            return placed, None
        rows = store(rest, "shard-rest")
        if high == bits:
            return placed, rows
        low, high = high, min(bits, high + 19)


def extendible_shards(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, max_bytes: int = MAX_BYTES
) -> DataFrame:
    """One row per document: id, n_bytes, shard (its prefix in binary digits), depth, shard_bytes, shard_rows, oversize."""
    if max_bytes < 1:
        raise ValueError("max_bytes must be positive")
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    of_id = F.conv(F.substring(F.md5(key.cast("binary")), 1, ID_BITS // 4), 16, 10).cast("long")
    # Written once, so that a lost executor can't draw the rows' bits anew.
    of_row = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - ROW_BITS)
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes")
    rows = store(docs.select(F.col(id_col).alias("__id"), size, of_id.alias("__h"), of_row.alias("__t")), "shard-rows")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    first = min(FIRST_BITS, 3 + math.ceil(math.log2(max(2, total / max_bytes))))

    def named(part: DataFrame, shard: F.Column, depth: F.Column) -> DataFrame:
        over = (F.col("shard_bytes") > max_bytes).alias("oversize")
        columns = [F.col("__id").alias(id_col), "n_bytes", shard.alias("shard"), depth.cast("int").alias("depth")]
        return part.select(*columns, "shard_bytes", "shard_rows", over)

    placed, equal = _split(rows, [], "__h", ID_BITS, first, max_bytes)
    out = [named(part, _digits("__bucket", "__depth"), F.col("__depth")) for part in placed]
    if equal is not None:
        front = _digits("__h", ID_BITS)
        placed, same = _split(equal, ["__h"], "__t", ROW_BITS, min(FIRST_BITS, ROW_BITS), max_bytes)
        out += [named(p, F.concat(front, _digits("__bucket", "__depth")), F.col("__depth") + ID_BITS) for p in placed]
        if same is not None:  # equal in every bit: a shard for each row
            number = F.monotonically_increasing_id().cast("string")
            alone = same.withColumns({"shard_bytes": F.col("n_bytes"), "shard_rows": F.lit(1).cast("long"), "__number": number})
            shard = F.concat_ws("-", F.concat(front, _digits("__t", ROW_BITS)), F.col("__number"))
            out.append(named(alone, shard, F.lit(ID_BITS + ROW_BITS)))
    return reduce(DataFrame.unionByName, out)


def directory_ranges(shards: DataFrame) -> DataFrame:
    """(first, last, shard, depth): the directory as ranges of the id's ``ID_BITS`` hash bits, whatever its depth.

    Shards that tell rows of one id apart have one and the same entry.
    """
    leaves = shards.select("shard", "depth").distinct()
    prefix = F.substring("shard", 1, ID_BITS)

    def bound(digit: str) -> F.Column:
        return F.conv(F.rpad(prefix, ID_BITS, digit), 2, 10).cast("long")

    return leaves.select(bound("0").alias("first"), bound("1").alias("last"), "shard", "depth")


def directory(shards: DataFrame) -> DataFrame:
    """The directory: every prefix of as many bits as the deepest shard has, and the shard it points to.

    A shard of fewer bits is pointed to by several entries. Its size is two to the power of the deepest shard's bits; one of
    more than ``DIRECTORY_BITS`` is refused, and ``directory_ranges`` gives it.
    """
    leaves = store(shards.select("shard", "depth").distinct(), "shard-directory")
    deepest = leaves.agg(F.max("depth")).first()[0] or 0
    if deepest > DIRECTORY_BITS:
        raise ValueError(f"a directory of 2^{deepest} entries: use directory_ranges")
    low = F.coalesce(F.conv("shard", 2, 10).cast("long"), F.lit(0).cast("long"))
    span = F.expr(f"shiftleft(1L, {deepest} - depth)")
    entry = F.explode(F.sequence(low * span, low * span + span - 1))
    return leaves.select(entry.alias("entry"), "shard", "depth")


def write_shards(docs: DataFrame, shards: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write the documents, one folder and one file per shard; ids must be unique."""
    joined = docs.join(shards.select(id_col, "shard"), id_col)
    joined.repartition("shard").write.partitionBy("shard").parquet(path)
