"""Raw Kafka-layout rows to messages with text keys, a header map and an event time."""

from __future__ import annotations

from pyspark.sql import DataFrame

from bustrace.functions.text import utf8_sql
from bustrace.model import CREATE_TIME, HEADERS_TYPE, LOG_APPEND_TIME

# The row carries a usable broker timestamp (create or log-append time after the epoch).
HAS_EVENT_TIME = (
    f"coalesce(timestampType in ({CREATE_TIME}, {LOG_APPEND_TIME}) and timestamp > timestamp_seconds(0), false)"
)


def header_text_sql(value: str) -> str:
    """Header bytes as text; a null header value reads ``None``."""
    return f"coalesce({utf8_sql(value)}, 'None')"


def header_map_sql(headers: str) -> str:
    """Headers as a map; of a repeated name the last one counts, a null array is an empty map."""
    given = f"coalesce({headers}, cast(array() as {HEADERS_TYPE}))"
    names = f"{given}.key"
    last_ones = f"filter({given}, (h, i) -> not array_contains(slice({names}, i + 2, size({names})), h.key))"
    distinct = f"(size({headers}) <= 1 or size(array_distinct({names})) = size({names}))"
    once = f"if({distinct}, {given}, {last_ones})"
    general = f"map_from_entries(transform({once}, h -> struct(h.key as key, {header_text_sql('h.value')} as value)))"
    # Without nulls and bad bytes the texts are the bytes as they are, which takes no lambda. X'FF' is in no valid text, and
    # a comma between texts keeps a character that is cut off from being completed by the next one.
    values, texts = f"{given}.value", f"cast({given}.value as array<string>)"
    as_they_are = f"{distinct} and not coalesce(array_contains({values}, X'FF'), true) and is_valid_utf8(array_join({texts}, ','))"
    return f"if({as_they_are}, map_from_arrays({names}, {texts}), {general})"


def opened(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Raw rows with the payload under its message name, ``raw`` (never null), and the key bytes as ``raw_key``."""
    return raw.selectExpr(
        "topic",
        "partition",
        "offset",
        "headers",
        "timestamp",
        "timestampType",
        "coalesce(value, X'') as raw",
        "key as raw_key",
        *(keep or []),
    )


def with_texts(rows: DataFrame) -> DataFrame:
    """Opened rows, decoded or not, with key text, header map and event time in place of their raw forms."""
    raw_columns = ("headers", "timestamp", "timestampType")
    return rows.selectExpr(
        f"{utf8_sql('raw_key')} as key",
        f"{header_map_sql('headers')} as headers",
        f"if({HAS_EVENT_TIME}, timestamp, null) as timestamp_utc",
        f"not ({HAS_EVENT_TIME} and timestampType = {CREATE_TIME}) as timestamp_fallback",
        *[c for c in rows.columns if c not in raw_columns],
    )


def normalize(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Column expressions only, so it also runs on a stream; ``keep`` names further columns to carry along."""
    return with_texts(opened(raw, keep))
