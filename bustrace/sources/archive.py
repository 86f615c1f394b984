"""Message archives: Parquet tables in the layout of Spark's Kafka source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bustrace.model import RAW_SCHEMA
from bustrace.session import write_compact
from bustrace.sources.blocks import write_blocks


def as_raw(df: DataFrame) -> DataFrame:
    """Columns and types of the raw layout; a zone-less timestamp is read as UTC."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in RAW_SCHEMA])


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    return as_raw(spark.read.parquet(path))


def write_archive(raw: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Partitioned by topic, so that a topic list prunes directories; rows of a partition lie together by offset.

    The range partitioning is by offset too: a hot topic or partition is spread over many files. Row groups have a Bloom
    filter on the key, by which a key search skips those without it, and the archive has an index of its blocks.
    """
    spread = raw.repartitionByRange("topic", "partition", "offset").sortWithinPartitions("topic", "partition", "offset")
    write_compact(spread, path, ["topic"], mode, **bloom_filter("key"))
    write_blocks(raw.sparkSession, path)


def bloom_filter(column: str) -> dict[str, str]:
    """Options of a Parquet writer: a Bloom filter on this column, as large as its distinct values need."""
    return {f"parquet.bloom.filter.enabled#{column}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
