"""Identifiers a message gives away (to follow) and references by which it is found (when followed)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bustrace.functions.evidence import members_sql, texts_sql
from bustrace.functions.jsonpath import compile_path, matches
from bustrace.functions.text import leaf_sql, quote, quoted_list
from bustrace.model import COORDS, ID_FIELDS, SOURCE_FIELDS

IDS_TYPE = "array<struct<id:string,method_rank:int,method:string>>"


def java_pattern(pattern: str) -> str | None:
    """The pattern in the JVM's dialect with Unicode classes, None when it is not a valid pattern at all."""
    try:
        groups = re.compile(pattern).groupindex
    except re.error:
        return None
    pattern = re.sub(r"\(\?P<\w+>", "(", pattern)
    pattern = re.sub(r"\(\?P=(\w+)\)", lambda m: f"\\\\{groups[m.group(1)]}".replace("\\\\", "\\"), pattern)
    return "(?U)" + pattern.replace(r"\Z", r"\z")


def usable_patterns(spark: SparkSession, patterns: list[str] | None) -> list[tuple[str, str, list[int]]]:
    """(pattern, JVM form, groups to extract); invalid patterns are left out, others must suit the JVM too."""
    usable = []
    for pattern in patterns or []:
        form = java_pattern(pattern)
        if form is None:
            continue
        try:
            spark.sparkContext._jvm.java.util.regex.Pattern.compile(form)
        except Exception as cause:
            raise ValueError(f"pattern {pattern!r} is not supported by the JVM") from cause
        count = re.compile(pattern).groups
        usable.append((pattern, form, list(range(1, count + 1)) or [0]))
    return usable


def required_text(pattern: str) -> str | None:
    """Characters with which every match of a valid pattern begins, None if there are none or it is not plain to see."""
    plain = r"[A-Za-z0-9_\"':;,=/@ -]+"
    start = re.match(rf"\(({plain})\)(?![?*{{])|({plain})([?*{{]?)", pattern)
    if start is None or "|" in pattern:
        return None
    group, text, optional = start.groups()
    return group or (text[:-1] if optional else text) or None


def _labelled(ids: Column, rank: int, method: str) -> Column:
    return F.transform(
        ids, lambda i: F.struct(i.alias("id"), F.lit(rank).alias("method_rank"), F.lit(method).alias("method"))
    )


def with_identifiers(
    messages: DataFrame,
    regex_patterns: list[str] | None = None,
    jsonpath_expressions: list[str] | None = None,
    id_fields: list[str] = ID_FIELDS,
    standard: bool = True,
) -> DataFrame:
    """Add ``ids``: the distinct (id, method) pairs of each full message; without the standard ones if so asked.

    Standard: non-null well-known fields of the value and the headers, and the evidence identifiers; the message key
    is no source. Regular expressions run on the JSON text of the value and of the headers; JSON paths on both.
    """
    none = F.expr("cast(array() as array<string>)")
    found = messages.withColumns(
        {
            "_found": F.expr(members_sql("value", id_fields)),
            "_value_text": F.expr("to_json(value)"),
            "_headers_text": F.expr("to_json(headers)"),
            "_headers_doc": F.expr("try_parse_json(to_json(headers))"),
        }
    )
    empty = "cast(array() as array<string>)"
    own = F.expr(
        f"concat(if(_found is null, {empty}, {texts_sql('_found')}),"
        f" map_values(map_filter(headers, (name, text) -> name in ({quoted_list(id_fields)}))),"
        " filter(array(keys.*), k -> k is not null))"
    )
    parts = [_labelled(F.array_distinct(own) if standard else none, 0, "standard")]
    for pattern, form, groups in usable_patterns(messages.sparkSession, regex_patterns):
        held = required_text(pattern)
        texts = []
        for c in ("_value_text", "_headers_text"):
            text = F.col(c) if held is None else F.when(F.contains(F.col(c), F.lit(held)), F.col(c))
            texts += [F.regexp_extract_all(text, F.lit(form), F.lit(g)) for g in groups]
        ids = F.array_distinct(F.concat(*[F.coalesce(t, none) for t in texts]))
        parts.append(_labelled(ids, len(parts), f"regex:{pattern}"))
    for path in jsonpath_expressions or []:
        steps = compile_path(path)
        if steps is None:
            continue
        places = [matches("value", steps, "_value_text"), matches("_headers_doc", steps, "_headers_text")]
        if steps[0] == ("child", "headers") and len(steps) > 1:
            places.append(matches("_headers_doc", steps[1:], "_headers_text"))
        parts.append(_labelled(F.array_distinct(F.concat(*places)), len(parts), f"jsonpath:{path}"))
    added = [c for c in found.columns if c not in messages.columns]
    return found.withColumn("ids", F.concat(*parts).cast(IDS_TYPE)).drop(*added)


def correlation_ids(messages: DataFrame, *args, **kwargs) -> DataFrame:
    """(topic, partition, offset, id, method), one row per identifier and method of each message."""
    found = with_identifiers(messages, *args, **kwargs)
    rows = found.select(*COORDS, F.explode_outer("ids").alias("i")).filter("i is not null")
    return rows.select(*COORDS, "i.id", "i.method")


def backward_rank(id_fields: list[str]) -> int:
    return 2 * len(id_fields) + 1


def references(
    messages: DataFrame,
    carry: list[str],
    bidirectional: bool = False,
    id_fields: list[str] = ID_FIELDS,
    source_fields: list[str] = SOURCE_FIELDS,
) -> DataFrame:
    """One row per way in which a decoded message can be found: its coordinates, ``carry`` columns, ``kind_rank``
    (0 key, then headers, then value fields, last backward fields), ``field_rank`` among backward fields, ``field``
    and ``ref_id``.

    One pass over the messages; a field that is both an identifier and a source counts as the former.
    """
    rows = reference_entries(messages, carry, bidirectional, id_fields, source_fields)
    # A null key refers to nothing; a member that is there has a text, which would be made twice for a test on it. Saying
    # that the rest is not null spares a test on the join key, as there.
    return rows.filter("_given is not null or startswith(field, 'value:')").select(
        *COORDS, *carry, "kind_rank", "field_rank", "field", F.expr("coalesce(_text, '')").alias("ref_id")
    )


def reference_entries(
    messages: DataFrame, carry: list[str], bidirectional: bool, id_fields: list[str], source_fields: list[str]
) -> DataFrame:
    """The rows of ``references`` with ``_text`` for ``ref_id``, and ``_given``, the same where it is no member's text.

    Each message has one for its key, even if that is null.
    """
    n = len(id_fields)
    wanted = dict.fromkeys([*id_fields, *(source_fields if bidirectional else [])])

    def entry(kind_rank: str, field_rank: str, field: str, text: str, leaf: str = "cast(null as variant)") -> str:
        return (
            f"struct(cast({kind_rank} as int) as kind_rank, cast({field_rank} as int) as field_rank, {field} as field,"
            f" {text} as text, {leaf} as leaf)"
        )

    def member(name: str) -> str:
        if name in id_fields:
            rank, field_rank = id_fields.index(name) + 1 + n, 0
        else:
            rank, field_rank = backward_rank(id_fields), source_fields.index(name) + 1
        leaf = f"_members.`{name}`"
        # Few of the wanted members are there: nothing is made of the others.
        found = entry(str(rank), str(field_rank), quote(f"value:{name}"), "cast(null as string)", leaf)
        return f"if({leaf} is null, null, {found})"

    # The same number, found much faster where the names can stand in one text.
    listed = all(name and "," not in name for name in id_fields)
    position = f"array_position(array({quoted_list(id_fields)}), e.key)"
    if listed:
        position = f"find_in_set(e.key, {quote(','.join(id_fields))})"
    headers = f"map_entries(map_filter(_headers, (name, text) -> name in ({quoted_list(id_fields)})))"
    entries = f"""concat(array({entry("0", "0", "'key'", "_key")}),
      coalesce(transform({headers}, e -> {entry(position, "0", "concat('header:', e.key)", "e.value")}), array()),
      array_compact(array({', '.join(map(member, wanted))})))"""
    # The wanted members come out of the value by name, in one step; only those that are there become rows.
    members = f"try_variant_get(value, '$', 'struct<{', '.join(f'`{name}`: variant' for name in wanted)}>')"
    rows = messages.select(
        *COORDS, *carry, F.col("key").alias("_key"), F.col("headers").alias("_headers"), F.expr(members).alias("_members")
    )
    # The outer form, as for every computed array here: the inner one adds a size test that repeats the expression.
    rows = rows.select(*COORDS, *carry, F.expr(f"explode_outer({entries})").alias("_e"))
    leaf = leaf_sql("_e.leaf")
    text = F.expr(f"if(_e.leaf is null, _e.text, {leaf})")
    return rows.select(
        *COORDS, *carry, "_e.kind_rank", "_e.field_rank", "_e.field", F.col("_e.text").alias("_given"), text.alias("_text")
    )
