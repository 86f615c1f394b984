"""Bounded batches between the JVM and Python."""

from __future__ import annotations

from pyspark.sql import SparkSession

BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Cut Arrow batches by bytes: rows are texts of any length, and a worker holds a batch several times over.

    A session setting that changes no result. A text longer than the bound is a batch of its own.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
