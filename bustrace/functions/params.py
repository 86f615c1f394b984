"""Textual parameters: timestamps, topic lists, header filters."""

from __future__ import annotations

from datetime import datetime, timezone


def parse_iso_utc(value: str | None, param: str) -> datetime | None:
    """ISO-8601 text to an aware UTC time; a time without zone is UTC; bad text names the parameter."""
    if value is None:
        return None
    try:
        parsed = datetime.fromisoformat(value)
    except (TypeError, ValueError):
        raise ValueError(f"{param} is not an ISO-8601 timestamp: {value!r}") from None
    return as_utc(parsed)


def as_utc(moment: datetime) -> datetime:
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def parse_list(text: str | None) -> list[str] | None:
    """``a, b`` to its trimmed, non-blank parts; None stays None."""
    if text is None:
        return None
    return [part.strip() for part in text.split(",") if part.strip()]



def parse_headers(text: str | None) -> dict[str, str] | None:
    """``k=v,k2=v2``: the first ``=`` splits, parts without one are ignored."""
    if text is None:
        return None
    pairs = (part.partition("=") for part in text.split(",") if "=" in part)
    return {name.strip(): value.strip() for name, _, value in pairs}
