"""Display projections of results; printing is ``df.show``.

Texts are whole; ``width`` shortens the value for display.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bustrace.functions.text import iso_text


def _value_text(width: int | None) -> Column:
    text = F.coalesce(F.to_json("value"), F.lit(""))
    return text if width is None else F.substring(text, 1, width)


def _place() -> list[Column]:
    return [
        iso_text("timestamp_utc").alias("Timestamp"),
        F.col("topic").alias("Topic"),
        F.col("partition").alias("Partition"),
        F.col("offset").alias("Offset"),
        F.coalesce("key", F.lit("")).alias("Key"),
    ]


def search_report(messages: DataFrame, width: int | None = None) -> DataFrame:
    return messages.select(*_place(), _value_text(width).alias("Value"))


def correlation_report(messages: DataFrame, width: int | None = None) -> DataFrame:
    chain = F.array_join("correlation_chain", "->").alias("Chain")
    return messages.select(*_place(), chain, _value_text(width).alias("Value"))


def lag_report(lag: DataFrame) -> DataFrame:
    return lag.select(
        F.col("group").alias("Group"),
        F.col("topic").alias("Topic"),
        F.col("partition").alias("Partition"),
        F.col("current_offset").alias("Current"),
        F.col("end_offset").alias("End"),
        F.col("lag").alias("Lag"),
    )


def topic_report(described: DataFrame) -> DataFrame:
    rows = described.select(F.col("name").alias("Topic"), F.explode("partitions").alias("p"))
    return rows.select(
        "Topic",
        F.col("p.id").alias("Partition"),
        F.col("p.leader").alias("Leader"),
        F.col("p.earliest").alias("Earliest"),
        F.col("p.latest").alias("Latest"),
    )


def message_report(messages: DataFrame, width: int | None = None) -> DataFrame:
    return messages.select(
        F.format_string("%s[%d]@%d", "topic", "partition", "offset").alias("Message"),
        F.col("key").alias("Key"),
        iso_text("timestamp_utc").alias("Timestamp UTC"),
        F.col("source").alias("Source"),
        F.col("event_type").alias("Event type"),
        F.col("headers").alias("Headers"),
        F.col("keys").alias("Evidence keys"),
        F.when(F.col("value").isNull(), F.lit("(none)")).otherwise(_value_text(width)).alias("Value"),
    )
