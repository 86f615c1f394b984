"""Key search over topics and a time window, for one key or a table of keys."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bustrace.functions.evidence import with_evidence
from bustrace.functions.framing import framed_sql
from bustrace.functions.text import child_sql, leaf_text, path_equals, payload_may_hold, payload_may_name, utf8_text
from bustrace.operators.decode import decode
from bustrace.operators.normalize import normalize, opened, with_texts
from bustrace.operators.offsets import seek_bounds, within_bounds
from bustrace.operators.predicates import (
    header_value,
    headers_equal,
    in_offsets,
    in_topics,
    in_window,
    key_equals,
    not_after,
    nothing,
)
from bustrace.session import broadcast_if_small, store

# A limit beyond this is not merged in one task.
MERGED_ROWS = 10_000


def enrich(raw: DataFrame, **decoding) -> DataFrame:
    """Raw rows to full messages: normalise, decode, evidence. Row-wise, so it also runs on a stream."""
    return with_evidence(decode(normalize(raw), **decoding))


def topic_position(topics: list[str] | None) -> Column:
    """Scan order of topics: as listed, by name when none are listed."""
    if not topics:
        return F.col("topic")
    return F.array_position(F.array(*[F.lit(t) for t in topics]), F.col("topic"))


def first_rows(rows: DataFrame, order: list, n: int) -> DataFrame:
    """The first ``n`` rows in an order.

    A small number is kept per task and merged; the result is one partition anyway, and naming it keeps later
    projections from being moved between sort and limit, which would turn the top-n into a global sort. A large number
    is found by counts: rows are ranged by the order and written, whole ranges are taken while they fit, and only the
    range in which ``n`` is reached is cut.
    """
    if n <= MERGED_ROWS:
        return rows.orderBy(*order).limit(n).coalesce(1)
    ranged = store(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranged")
    left, cut = n, None
    for r in ranged.groupBy("_range").count().orderBy("_range").collect():  # one row per partition
        if r["count"] > left:
            cut = r["_range"]
            break
        left -= r["count"]
    if cut is None:
        return ranged.drop("_range")
    rest = ranged.filter(F.col("_range") == cut).orderBy(*order).limit(left)
    return ranged.filter(F.col("_range") < cut).unionByName(rest).drop("_range")


def match_messages(
    raw: DataFrame,
    key: str,
    *,
    key_field: str | None = None,
    topics: list[str] | None = None,
    headers: dict[str, str] | None = None,
    time_from: datetime | None = None,
    time_to: datetime | None = None,
    pick=None,
    **decoding,
) -> DataFrame:
    """All full messages that match, without order or limit; row-wise.

    Everything that can be told from the raw row is tested before the decode. ``pick`` narrows the matching raw rows
    further (a limit); a value-path search applies it after the decode.
    """
    pick = pick or (lambda rows: rows)
    rows = raw.filter(in_topics(topics) & in_window(time_from, time_to) & headers_equal(headers))
    if key_field is None or key_field == "key":
        return enrich(pick(rows.filter(key_equals(key))), **decoding)
    kind, _, name = key_field.partition(":")
    if kind == "header" and ":" in key_field:
        return enrich(pick(rows.filter(F.coalesce(header_value(name) == key, F.lit(False)))), **decoding)
    if kind == "value" and ":" in key_field and decoding.get("registry", True):
        framed = F.expr(framed_sql("value")) if decoding.get("schemas") is not None else F.lit(False)
        decoded = decode(opened(rows.filter(payload_may_hold("value", key) | framed)), **decoding)
        return with_evidence(with_texts(pick(decoded.filter(path_equals("value", name, key)))))
    return enrich(rows.filter(nothing()), **decoding)


def search_messages(
    raw: DataFrame,
    key: str,
    *,
    key_field: str | None = None,
    topics: list[str] | None = None,
    headers: dict[str, str] | None = None,
    time_from: datetime | None = None,
    time_to: datetime | None = None,
    start_offset: int | None = None,
    stop_offset: int | None = None,
    limit: int | None = None,
    mode: str = "strict",
    blocks: DataFrame | None = None,
    **decoding,
) -> DataFrame:
    """Messages that carry ``key`` in the window.

    ``key_field``: None or ``key``, ``header:<name>``, ``value:<dotted.path>``; anything else matches nothing.
    All matches are returned as an unordered table, unless ``limit`` is given: it counts matches in scan order (topic,
    partition, offset), and the result is sorted by time. ``mode="seek"`` starts each partition at the first offset stamped at or
    after ``time_from`` instead of testing every row. ``start_offset`` (inclusive) and ``stop_offset`` (exclusive) bound
    the offsets of every partition and reach the scan. With ``blocks``, the index of the archive that ``raw`` is, a seek
    reads one block of a partition to find its start.
    """
    if mode not in ("strict", "seek"):
        raise ValueError(f"mode must be strict or seek, not {mode!r}")
    if limit is not None and limit <= 0:
        return enrich(raw.limit(0), **decoding)
    scope = raw.filter(in_topics(topics) & in_offsets(start_offset, stop_offset))
    seek = time_from if mode == "seek" else None
    if seek is not None:
        whole = start_offset is None and stop_offset is None
        known = blocks.filter(in_topics(topics)) if blocks is not None and whole else None
        scope = within_bounds(scope, seek_bounds(scope, seek, known))
    if time_to is None:
        scope = scope.filter(not_after(datetime.now(timezone.utc)))
    order = [topic_position(topics), F.col("partition"), F.col("offset")]

    def pick(rows: DataFrame) -> DataFrame:
        return rows if limit is None else first_rows(rows, order, limit)

    found = match_messages(
        scope,
        key,
        key_field=key_field,
        topics=topics,
        headers=headers,
        time_from=None if seek is not None else time_from,
        time_to=time_to,
        pick=pick,
        **decoding,
    )
    return found if limit is None else found.orderBy("timestamp_utc", *order)


def _with_key_text(rows: DataFrame, key_field: str | None, decoding: dict) -> tuple[DataFrame, bool]:
    """Add ``search_key``, the text a key is compared with; tells whether the rows had to be decoded for it."""
    if key_field is None or key_field == "key":
        return rows.withColumn("search_key", utf8_text("key")), False
    kind, _, name = key_field.partition(":")
    if kind == "header" and ":" in key_field:
        return rows.withColumn("search_key", header_value(name)), False
    if kind == "value" and ":" in key_field:
        framed = F.expr(framed_sql("value")) if decoding.get("schemas") is not None else F.lit(False)
        rows = rows.filter(payload_may_name("value", name) | framed)
        # The generator keeps the null test of the join from repeating the leaf expression below.
        found = F.expr(f"explode(array({child_sql('value', name.split('.'))}))")
        leaf = decode(opened(rows), **decoding).select("*", found.alias("_leaf"))
        return leaf.withColumn("search_key", leaf_text("_leaf")).drop("_leaf"), True
    return rows.withColumn("search_key", F.lit(None).cast("string")), False


def first_per_key(rows: DataFrame, key: str, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of each key. Spark ranks within each task before the shuffle, so of a key that owns a large part
    of all rows at most ``n`` per task are moved."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def search_many(
    raw: DataFrame,
    keys: DataFrame,
    *,
    key_field: str | None = None,
    topics: list[str] | None = None,
    headers: dict[str, str] | None = None,
    time_from: datetime | None = None,
    time_to: datetime | None = None,
    limit_per_key: int | None = None,
    **decoding,
) -> DataFrame:
    """``search_messages`` for every row of ``keys`` (a column ``key``) in one job; adds ``search_key``.

    The keys are made distinct, so each message joins at most one of them. They are broadcast when measured small;
    otherwise the join shuffles on the key and the adaptive skew join splits hot keys.
    """
    rows = raw.filter(in_topics(topics) & in_window(time_from, time_to) & headers_equal(headers))
    if time_to is None:
        rows = rows.filter(not_after(datetime.now(timezone.utc)))
    rows, decoded = _with_key_text(rows, key_field, decoding)
    wanted = keys.select(F.col("key").cast("string").alias("search_key")).filter("search_key is not null").distinct()
    hits = rows.join(broadcast_if_small(wanted), "search_key")
    if limit_per_key is not None:
        hits = first_per_key(hits, "search_key", [topic_position(topics), F.col("partition"), F.col("offset")], limit_per_key)
    if decoded:
        return with_evidence(with_texts(hits))
    return with_evidence(decode(normalize(hits, keep=["search_key"]), **decoding))


def scan_partition(messages: DataFrame, key: str) -> DataFrame:
    """Messages (key text, value, headers) whose key equals ``key``, with their evidence identifiers."""
    return with_evidence(messages.filter(F.col("key") == key))
