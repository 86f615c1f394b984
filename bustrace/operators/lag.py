"""Consumer-group lag: committed offsets against end offsets."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bustrace.functions.params import as_utc
from bustrace.model import LAG_EVENT, SOURCE


def consumer_group_lag(
    committed: DataFrame,
    watermarks: DataFrame,
    group: str | None = None,
    topics: list[str] | None = None,
    now: datetime | None = None,
) -> DataFrame:
    """Lag per (group, topic, partition); ``group=None`` reports every group at once.

    No commit counts as offset 0, lag is not clamped, and partitions that no longer exist are left out. Both inputs
    have one row per partition (and group), so the join is small next to any message table.
    """
    if group is not None:
        committed = committed.filter(F.col("group") == group)
    if topics is not None:
        committed = committed.filter(F.col("topic").isin(*topics) if topics else F.lit(False))
    no_commit = F.col("error").isNotNull() | (F.col("offset") < 0)
    current = F.when(no_commit, F.lit(0)).otherwise(F.col("offset")).cast("bigint")
    return committed.join(watermarks.select("topic", "partition", "latest"), ["topic", "partition"]).select(
        "group",
        "topic",
        "partition",
        current.alias("current_offset"),
        F.col("latest").alias("end_offset"),
        (F.col("latest") - current).alias("lag"),
        F.lit(as_utc(now or datetime.now(timezone.utc))).alias("timestamp_utc"),
        F.lit(SOURCE).alias("source"),
        F.lit(LAG_EVENT).alias("event_type"),
    )


def lag_summary(lag: DataFrame) -> DataFrame:
    """Totals per group and topic."""
    return lag.groupBy("group", "topic").agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("lag").alias("total_lag"), F.max("lag").alias("max_lag")
    )
