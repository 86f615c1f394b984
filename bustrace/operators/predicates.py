"""Row predicates on the raw layout, so that they reach the scan before anything is decoded."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bustrace.functions.params import as_utc
from bustrace.functions.framing import framed_sql
from bustrace.functions.text import payload_may_hold, quote, utf8_text
from bustrace.model import INTERNAL_PREFIX
from bustrace.operators.normalize import HAS_EVENT_TIME, header_text_sql


def nothing() -> Column:
    return F.lit(False)


def is_internal() -> Column:
    return F.startswith(F.col("topic"), F.lit(INTERNAL_PREFIX))


def in_topics(topics: list[str] | None) -> Column:
    """None: all but internal topics; a list: exactly these; an empty list: none."""
    if topics is None:
        return ~is_internal()
    return F.col("topic").isin(*topics) if topics else nothing()


def in_offsets(start: int | None = None, stop: int | None = None) -> Column:
    """Start inclusive, stop exclusive."""
    bounds = []
    if start is not None:
        bounds.append(F.col("offset") >= start)
    if stop is not None:
        bounds.append(F.col("offset") < stop)
    return reduce(Column.__and__, bounds, F.lit(True))


# So many topics are named in a filter at most; a plan with more would be larger than what it saves.
FILTERED_TOPICS = 500


def in_topic_ranges(bounds: DataFrame) -> Column:
    """Necessary test for rows inside ``bounds`` (topic, start, stop): literals per topic, which the scan can prune on.

    Of the bounds, one row per topic comes to the driver, and none beyond ``FILTERED_TOPICS``.
    """
    per_topic = bounds.groupBy("topic").agg(F.min("start").alias("a"), F.max("stop").alias("z"))
    rows = per_topic.limit(FILTERED_TOPICS + 1).collect()
    if len(rows) > FILTERED_TOPICS:
        return F.lit(True)
    inside = [(F.col("topic") == r["topic"]) & (F.col("offset") >= r["a"]) & (F.col("offset") < r["z"]) for r in rows]
    return reduce(Column.__or__, inside, nothing())


def in_partition_ranges(bounds: DataFrame) -> Column:
    """As ``in_topic_ranges``, by partition; ``bounds`` has a row per topic and partition."""
    rows = bounds.select("topic", "partition", "start", "stop").limit(FILTERED_TOPICS + 1).collect()
    if len(rows) > FILTERED_TOPICS:
        return in_topic_ranges(bounds)
    inside = [
        (F.col("topic") == r["topic"])
        & (F.col("partition") == r["partition"])
        & (F.col("offset") >= r["start"])
        & (F.col("offset") < r["stop"])
        for r in rows
    ]
    return reduce(Column.__or__, inside, nothing())


def key_equals(key: str) -> Column:
    """Message key equals the text; a null key never does.

    Compared as bytes, which a Parquet scan can prune on. Only a key with U+FFFD may stem from repaired bytes.
    """
    if "�" in key:
        return F.coalesce(utf8_text("key") == key, F.lit(False))
    return F.col("key") == F.lit(bytearray(key.encode("utf-8")))


def header_value(name: str) -> Column:
    """Text of the last header of that name, null when there is none."""
    last = f"try_element_at(filter(headers, h -> h.key = {quote(name)}), -1)"
    return F.expr(f"if({last} is null, null, {header_text_sql(last + '.value')})")


def headers_equal(headers: dict[str, str] | None) -> Column:
    """All pairs must be equal; no pairs is true."""
    return reduce(Column.__and__, [header_value(n) == v for n, v in (headers or {}).items()], F.lit(True))


def _moment(t: datetime) -> Column:
    return F.lit(as_utc(t))


def in_window(time_from: datetime | None, time_to: datetime | None) -> Column:
    """``time_from`` inclusive, ``time_to`` exclusive; an explicit bound leaves out rows without an event time."""
    bounds = []
    if time_from is not None:
        bounds.append(F.col("timestamp") >= _moment(time_from))
    if time_to is not None:
        bounds.append(F.col("timestamp") < _moment(time_to))
    if bounds:
        bounds.append(F.expr(HAS_EVENT_TIME))
    return reduce(Column.__and__, bounds, F.lit(True))


def not_after(now: datetime) -> Column:
    """The default upper bound: before now, or without an event time."""
    return (F.col("timestamp") < _moment(now)) | ~F.expr(HAS_EVENT_TIME)


def may_refer_to(ids: list[str], framed: bool) -> Column:
    """Necessary test on a raw row for a reference to one of a few ids, by key, header or JSON payload.

    ``framed``: binary bodies are decoded too, and cannot be told from their bytes.
    """
    if any(i == "None" or "\ufffd" in i for i in ids):  # may stem from a null header or from repaired bytes
        return F.lit(True)
    exact = [F.lit(bytearray(i.encode("utf-8"))) for i in ids]
    by_header = F.coalesce(F.exists("headers", lambda h: h["value"].isin(*exact)), F.lit(False))
    by_value = payload_may_hold("value", *ids) | (F.expr(framed_sql("value")) if framed else F.lit(False))
    return F.coalesce(F.col("key").isin(*exact), F.lit(False)) | by_header | F.coalesce(by_value, F.lit(False))
