"""Messages by exact coordinates, one or many."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bustrace.errors import DecodeError, MessageMissing, MessageNotFound, TopicNotFound
from bustrace.model import COORDS
from bustrace.operators.offsets import watermarks
from bustrace.operators.predicates import in_topic_ranges
from bustrace.operators.search import enrich
from bustrace.session import broadcast_if_small


def get_messages(
    raw: DataFrame, coords: DataFrame, partition_meta: DataFrame | None = None, **decoding
) -> DataFrame:
    """Full messages for a table of coordinates, with a ``lookup_status`` per distinct coordinate.

    ``found``; ``out_of_range`` (outside the watermarks); ``missing`` (inside, but no row, e.g. compacted away);
    ``unknown_partition``. Coordinates are unique, so a shuffle join on them has no hot key.
    """
    wanted = coords.select(*COORDS).distinct()
    small = broadcast_if_small(wanted)
    bounds = wanted.select("topic", F.col("offset").alias("start"), (F.col("offset") + 1).alias("stop"))
    found = enrich(raw.filter(in_topic_ranges(bounds)).join(small, COORDS, "left_semi"), **decoding)
    asked = broadcast_if_small(wanted.select("topic", "partition").distinct())
    marks = watermarks(raw.join(asked, ["topic", "partition"], "left_semi"), partition_meta)
    marks = marks.select("topic", "partition", "earliest", "latest")
    outside = (F.col("offset") < F.col("earliest")) | (F.col("offset") >= F.col("latest"))
    status = (
        F.when(F.col("decode_status").isNotNull(), F.lit("found"))
        .when(F.col("latest").isNull(), F.lit("unknown_partition"))
        .when(outside, F.lit("out_of_range"))
        .otherwise(F.lit("missing"))
    )
    return (
        wanted.join(found, COORDS, "left")
        .join(marks, ["topic", "partition"], "left")
        .withColumn("lookup_status", status)
        .drop("earliest", "latest")
    )


def get_message(
    raw: DataFrame, topic: str, partition: int, offset: int, partition_meta: DataFrame | None = None, **decoding
) -> DataFrame:
    """The one message at these coordinates as a one-row table; strict.

    Raises TopicNotFound, MessageNotFound (outside the watermarks), MessageMissing (inside, but absent) or
    DecodeError. Only the fields the checks need come to the driver.
    """
    here = raw.filter((F.col("topic") == topic) & (F.col("partition") == partition))
    message = enrich(here.filter(F.col("offset") == offset).limit(1), **decoding)
    outcome = message.select("decode_status", "decode_error").first()
    if outcome is None:
        if partition_meta is not None:
            partition_meta = partition_meta.filter((F.col("topic") == topic) & (F.col("partition") == partition))
        marks = watermarks(here, partition_meta).first()
        if marks is None:
            raise TopicNotFound(topic)
        if marks["earliest"] <= offset < marks["latest"]:
            raise MessageMissing(topic, partition, offset)
        raise MessageNotFound(topic, partition, offset)
    if outcome["decode_status"] == "error":
        raise DecodeError(topic, partition, offset, outcome["decode_error"])
    return message
