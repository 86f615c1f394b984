"""Topics, partitions, watermarks and time-to-offset seeks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bustrace.errors import TopicNotFound
from bustrace.functions.params import as_utc
from bustrace.operators.normalize import HAS_EVENT_TIME
from bustrace.operators.predicates import in_partition_ranges, in_topic_ranges, is_internal
from bustrace.session import store
from bustrace.sources.blocks import first_late_blocks

PARTITION = ["topic", "partition"]

# A table of so many partitions is broadcast without measuring it.
FEW_PARTITIONS = 100_000


def list_topics(raw: DataFrame, include_internal: bool = False, partition_meta: DataFrame | None = None) -> DataFrame:
    topics = raw.select("topic")
    if partition_meta is not None:
        topics = topics.union(partition_meta.select("topic"))
    if not include_internal:
        topics = topics.filter(~is_internal())
    return topics.distinct().orderBy("topic")


def require_topics(raw: DataFrame, topics: list[str], partition_meta: DataFrame | None = None) -> None:
    """Raise for the first listed topic that has neither rows nor metadata; reads the topic column only."""
    if not topics:
        return
    known = list_topics(raw.filter(F.col("topic").isin(*topics)), True, partition_meta)
    found = {r["topic"] for r in known.filter(F.col("topic").isin(*topics)).collect()}  # at most len(topics) rows
    for topic in topics:
        if topic not in found:
            raise TopicNotFound(topic)


def partition_ids(raw: DataFrame, topic: str, partition_meta: DataFrame | None = None) -> DataFrame:
    require_topics(raw, [topic], partition_meta)
    ids = raw.filter(F.col("topic") == topic).select("partition")
    if partition_meta is not None:
        ids = ids.union(partition_meta.filter(F.col("topic") == topic).select("partition"))
    return ids.distinct().orderBy("partition")


def watermarks(raw: DataFrame, partition_meta: DataFrame | None = None, blocks: DataFrame | None = None) -> DataFrame:
    """(topic, partition, leader, earliest, latest) with latest = last offset + 1.

    Broker metadata, when given, overrides what the rows show (retention, empty partitions) and brings the leader;
    without it the leader is 0. With ``blocks``, the index of the archive that ``raw`` is, no message is read.
    """
    if blocks is not None:
        seen = blocks.groupBy(*PARTITION).agg(F.min("start").alias("first"), F.max("stop").alias("end"))
    else:
        seen = raw.groupBy(*PARTITION).agg(F.min("offset").alias("first"), (F.max("offset") + 1).alias("end"))
    if partition_meta is None:
        return seen.select(*PARTITION, F.lit(0).alias("leader"), F.col("first").alias("earliest"), F.col("end").alias("latest"))
    return seen.join(partition_meta, PARTITION, "full_outer").select(
        *PARTITION,
        F.coalesce("leader", F.lit(0)).alias("leader"),
        F.coalesce("earliest", "first").alias("earliest"),
        F.coalesce("latest", "end").alias("latest"),
    )


def _late_enough(moment: datetime):
    return F.expr(HAS_EVENT_TIME) & (F.col("timestamp") >= F.lit(as_utc(moment)))


def _first_late(raw: DataFrame, moment: datetime, blocks: DataFrame | None) -> DataFrame:
    """(topic, partition, found, low, end): the first late offset (null if there is none), the first and behind the last.

    With ``blocks`` only those messages are read that may lie between the start of a partition's first block with a late
    message and its end.
    """
    found = F.min(F.when(_late_enough(moment), F.col("offset"))).alias("found")
    if blocks is None:
        return raw.groupBy(*PARTITION).agg(found, F.min("offset").alias("low"), (F.max("offset") + 1).alias("end"))
    first = store(first_late_blocks(blocks, moment), "late-blocks")
    near = raw.filter(in_partition_ranges(first)).join(F.broadcast(first) if _few(first) else first, PARTITION)
    near = near.filter((F.col("offset") >= F.col("start")) & (F.col("offset") < F.col("stop")))
    marks = watermarks(raw, blocks=blocks).select(*PARTITION, F.col("earliest").alias("low"), F.col("latest").alias("end"))
    return marks.join(near.groupBy(*PARTITION).agg(found), PARTITION, "left").select(*PARTITION, "found", "low", "end")


def _few(partitions: DataFrame) -> bool:
    return partitions.limit(FEW_PARTITIONS + 1).count() <= FEW_PARTITIONS


def offsets_for_times(
    raw: DataFrame, moment: datetime, partition_meta: DataFrame | None = None, blocks: DataFrame | None = None
) -> DataFrame:
    """Per partition the first offset stamped at or after ``moment`` (``found``, null if none) and the scan start.

    With ``blocks``, the index of the archive that ``raw`` is, one block of a partition is read.
    """
    found = _first_late(raw, moment, blocks)
    if partition_meta is not None:
        meta = partition_meta.select(*PARTITION, "earliest")
        found = found.join(meta, PARTITION, "full_outer").withColumn("low", F.coalesce("earliest", "low"))
    return found.select(*PARTITION, "found", F.coalesce("found", "low").alias("start_offset"))


def describe_topics(raw: DataFrame, partition_meta: DataFrame | None = None, blocks: DataFrame | None = None) -> DataFrame:
    """One row per topic: name, partition_count, partitions sorted by id; ``blocks`` as in ``watermarks``."""
    info = F.struct(F.col("partition").alias("id"), "leader", "earliest", "latest")
    return (
        watermarks(raw, partition_meta, blocks)
        .groupBy(F.col("topic").alias("name"))
        .agg(F.count(F.lit(1)).cast("int").alias("partition_count"), F.sort_array(F.collect_list(info)).alias("partitions"))
    )


def describe_topic(raw: DataFrame, topic: str, partition_meta: DataFrame | None = None) -> DataFrame:
    require_topics(raw, [topic], partition_meta)
    if partition_meta is not None:
        partition_meta = partition_meta.filter(F.col("topic") == topic)
    return describe_topics(raw.filter(F.col("topic") == topic), partition_meta)


def seek_bounds(raw: DataFrame, time_from: datetime, blocks: DataFrame | None = None) -> DataFrame:
    """(topic, partition, start, stop): from the first offset stamped at or after ``time_from``, or else from the first.

    One row per partition, stored.
    """
    found = _first_late(raw, time_from, blocks)
    return store(found.select(*PARTITION, F.coalesce("found", "low").alias("start"), F.col("end").alias("stop")), "bounds")


def within_bounds(raw: DataFrame, bounds: DataFrame) -> DataFrame:
    """Rows inside their partition's bounds; ``bounds`` is a stored table of one row per partition."""
    inside = raw.filter(in_topic_ranges(bounds)).join(bounds, PARTITION)
    return inside.filter((F.col("offset") >= F.col("start")) & (F.col("offset") < F.col("stop"))).select(*raw.columns)
