"""The sparse index of an archive: per block of a partition's messages, its offsets and event times.

Written with the archive (in a folder that readers of the archive skip). Watermarks are its least and greatest offsets. A
seek finds the first block with a late enough message and reads that block only, not the topic.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bustrace.functions.params import as_utc
from bustrace.model import RAW_SCHEMA
from bustrace.operators.normalize import HAS_EVENT_TIME

FOLDER = "_blocks"
ROWS_PER_BLOCK = 8192
PARTITION = ["topic", "partition"]

SCHEMA = """topic string, partition int, file string, block bigint, start bigint, stop bigint, n bigint,
  first_time timestamp, last_time timestamp"""


def write_blocks(spark: SparkSession, path: str, rows_per_block: int = ROWS_PER_BLOCK) -> None:
    """Index the archive's files that are not in its index yet; a scan of offsets and times, without their payloads."""
    rows = spark.read.schema(RAW_SCHEMA).parquet(path)
    file, number = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    rows = rows.select(
        *PARTITION,
        file.alias("file"),
        (number / rows_per_block).cast("bigint").alias("block"),
        "offset",
        F.when(F.expr(HAS_EVENT_TIME), F.col("timestamp")).alias("_time"),
    )
    known = read_blocks(spark, path)
    if known is not None:
        rows = rows.join(known.select("topic", "file").distinct(), ["topic", "file"], "left_anti")
    found = rows.groupBy(*PARTITION, "file", "block").agg(
        F.min("offset").alias("start"),
        (F.max("offset") + 1).alias("stop"),
        F.count(F.lit(1)).alias("n"),
        F.min("_time").alias("first_time"),
        F.max("_time").alias("last_time"),
    )
    found.write.mode("append").parquet(f"{path.rstrip('/')}/{FOLDER}")


def read_blocks(spark: SparkSession, path: str) -> DataFrame | None:
    """The index of an archive; None for one that was written without."""
    try:
        return spark.read.schema(SCHEMA).parquet(f"{path.rstrip('/')}/{FOLDER}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def first_late_blocks(blocks: DataFrame, moment: datetime) -> DataFrame:
    """(topic, partition, start, stop): per partition the offsets in which its first message at or after ``moment`` lies.

    Of the blocks with a late message, the one that begins first; no late message lies in front of it. It is a range of
    offsets, not of a file's rows, so blocks may overlap (files that were appended out of order).
    """
    late = blocks.filter(F.col("last_time") >= F.lit(as_utc(moment)))
    first = late.groupBy(*PARTITION).agg(F.min_by(F.struct("start", "stop"), F.struct("start", "stop")).alias("_b"))
    return first.select(*PARTITION, "_b.start", "_b.stop")
