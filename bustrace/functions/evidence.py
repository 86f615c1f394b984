"""Evidence identifiers of a message."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bustrace.functions.text import leaf_sql, quote
from bustrace.model import EVIDENCE_ALIASES, MESSAGE_EVENT, SOURCE


def members_sql(value: str, names: list[str]) -> str:
    """Top-level members of an object that are in ``names``, as a struct in the order in which a VARIANT has them."""
    ordered = sorted(dict.fromkeys(names), key=lambda name: name.encode("utf-16-be", "surrogatepass"))
    fields = ", ".join(f"`{name.replace('`', '``')}`: variant" for name in ordered)
    return f"try_variant_get({value}, '$', 'struct<{fields}>')"


def texts_sql(members: str) -> str:
    """Text of the members that are there and not null."""
    present = f"filter(array({members}.*), leaf -> leaf is not null and not is_variant_null(leaf))"
    return f"transform({present}, leaf -> {leaf_sql('leaf')})"


def with_evidence(df: DataFrame, aliases: dict[str, list[str]] = EVIDENCE_ALIASES) -> DataFrame:
    """Add ``keys`` and the constant contract columns to decoded messages.

    Each identifier is the first non-null alias in the value, else the first alias in the headers.
    """
    spellings = list(dict.fromkeys(a for names in aliases.values() for a in names))
    # All spellings come out of the value in one step.
    members = members_sql("value", spellings)
    first, texts = {}, []
    for name, names in aliases.items():
        in_value = ", ".join(f"if(is_variant_null(_members.`{a}`), null, _members.`{a}`)" for a in names)
        in_headers = ", ".join(f"try_element_at(headers, {quote(a)})" for a in names)
        first[f"_{name}"] = F.expr(f"coalesce({in_value})")
        texts.append(f"coalesce(if(_{name} is null, null, {leaf_sql(f'_{name}')}), {in_headers}) as {name}")
    # One projection per step: the members, the first of each identifier, its text.
    return (
        df.withColumn("_members", F.expr(members))
        .withColumns(first)
        .drop("_members")
        .withColumns(
            {
                "keys": F.expr(f"struct({', '.join(texts)})"),
                "source": F.lit(SOURCE),
                "event_type": F.lit(MESSAGE_EVENT),
            }
        )
        .drop(*first)
    )
