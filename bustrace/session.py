"""Session settings the semantics need, and intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from functools import cache
from urllib.parse import urlparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when its measured size stays below this.
BROADCAST_BYTES = 64 * 1024 * 1024

# Folders written, by scope: the innermost open ``scratch`` block, or the whole program.
_scopes: list[list[tuple[SparkSession, str]]] = [[]]


def configure(spark: SparkSession) -> SparkSession:
    """UTC timestamps, and the last of duplicate JSON keys wins."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, else one in the warehouse.

    A name without a scheme means the same folder to all on one machine (a local cluster's executors run on the driver's)
    or where the default file system is not a local one. Other clusters then take the warehouse, which Spark names with
    its scheme, once what tasks wrote there was read back.
    """
    master = spark.sparkContext.master
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder and (master.startswith("local") or urlparse(folder).scheme or not _default_is_local(spark)):
        return folder
    scratch_folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    if master.startswith("local") and not master.startswith("local-cluster"):
        return scratch_folder
    if urlparse(scratch_folder).scheme and _is_shared(spark.sparkContext.applicationId, scratch_folder):
        return scratch_folder
    raise ValueError("set spark.checkpoint.dir, with its scheme, to a folder all executors share")


@cache
def _is_shared(application: str, folder: str) -> bool:
    """Whether the driver finds every row that tasks on the executors write to the folder; tried once per program."""
    spark = SparkSession.active()
    tasks = 2 * spark.sparkContext.defaultParallelism
    path = f"{folder}/bustrace/{application}/probe-{uuid.uuid4().hex}"
    _scopes[0].append((spark, path))
    spark.range(tasks, numPartitions=tasks).write.parquet(path)
    return spark.read.schema("id bigint").parquet(path).count() == tasks


def _default_is_local(spark: SparkSession) -> bool:
    return spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is there goes when the ``scratch`` block or the program ends."""
    path = f"{shared_folder(spark)}/bustrace/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    _scopes[-1].append((spark, path))
    return path


#: Options of a Parquet table: about half the disk of the default.
COMPACT = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}

_compact = False

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside the block go with the end of each write, not with the driver's garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def write_compact(df: DataFrame, path: str, by: list[str] | None = None, mode: str = "errorifexists", **options: str) -> None:
    """Write a Parquet table with little disk, in folders ``by`` columns if so asked."""
    with shuffles_dropped(df.sparkSession):
        df.write.mode(mode).partitionBy(*(by or [])).options(**COMPACT, **options).parquet(path)


@contextmanager
def compact() -> Iterator[None]:
    """Inside the block ``store`` writes as ``write_compact`` does."""
    global _compact
    before, _compact = _compact, True
    try:
        yield
    finally:
        _compact = before


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage between hops, computes the plan a single time, survives the loss of executors, and leaves a
    table whose size Catalyst knows from its files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _compact:
        write_compact(df, path)
    else:
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _opened(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def delete(spark: SparkSession, path: str) -> None:
    files, target = _opened(spark, path)
    files.delete(target, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Folders right below a path; one call of the driver."""
    files, target = _opened(spark, path)
    return sorted(f.getPath().toString() for f in files.listStatus(target) if f.isDirectory())


def _delete(made: list[tuple[SparkSession, str]]) -> None:
    while made:
        with suppress(Exception):  # the session may have ended before, and its folder with it
            delete(*made.pop())


@contextmanager
def scratch() -> Iterator[None]:
    """Tables stored inside the block are deleted at its end; take results out of them before."""
    _scopes.append([])
    try:
        yield
    finally:
        _delete(_scopes.pop())


atexit.register(lambda: _delete(_scopes[0]))


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes as JSON text) of a table; one aggregate, nothing is collected."""
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("size"),
    ).first()
    return row["n"], row["size"] or 0


def store_measured(df: DataFrame, name: str) -> tuple[DataFrame, int, int]:
    """``store``, with the rows and their bytes as JSON text, observed while they are written."""
    seen = Observation()
    size = F.octet_length(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))))
    with compact():
        stored = store(df.observe(seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("size")), name)
    return stored, seen.get["n"], seen.get["size"]


def broadcast_if_small(df: DataFrame, size: int | None = None) -> DataFrame:
    """Hint a broadcast when the measured size allows it; otherwise leave the join to Catalyst and its skew handling."""
    if size is None:
        size = measure(df)[1]
    return F.broadcast(df) if size <= BROADCAST_BYTES else df
