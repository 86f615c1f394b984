"""Schema-registry framing: a zero byte and a 4-byte big-endian schema id before the body."""

from __future__ import annotations

HEADER_LENGTH = 5


def framed_sql(payload: str) -> str:
    return f"coalesce(length({payload}) >= {HEADER_LENGTH} and substring({payload}, 1, 1) = X'00', false)"


def schema_id_sql(payload: str) -> str:
    """Unsigned 32-bit schema id, null when the payload is not framed."""
    return f"if({framed_sql(payload)}, cast(conv(hex(substring({payload}, 2, 4)), 16, 10) as bigint), null)"


def schema_ids_sql(value: str, key: str) -> str:
    """Ids of both sides, null when neither is framed."""
    ids = f"named_struct('value', {schema_id_sql(value)}, 'key', {schema_id_sql(key)})"
    return f"if({framed_sql(value)} or {framed_sql(key)}, {ids}, null)"
