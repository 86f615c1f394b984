"""Search, then correlate."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from bustrace.operators.search import search_messages
from bustrace.plans.correlate import correlate


def investigate(
    raw: DataFrame,
    key: str,
    follow_topics: list[str],
    *,
    key_field: str | None = None,
    initial_topics: list[str] | None = None,
    time_from: datetime | None = None,
    time_to: datetime | None = None,
    limit: int | None = None,
    decoding: dict | None = None,
    **correlation,
) -> DataFrame:
    """What happened to ``key``: its messages in ``initial_topics`` and window, and what they lead to."""
    decoding = decoding or {}
    seeds = search_messages(
        raw,
        key,
        key_field=key_field,
        topics=initial_topics,
        time_from=time_from,
        time_to=time_to,
        limit=limit,
        **decoding,
    )
    return correlate(raw, seeds, follow_topics, limit=limit, **correlation, **decoding)
