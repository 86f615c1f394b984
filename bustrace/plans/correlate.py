"""Correlation: follow the identifiers of seed messages into other topics, over one or several hops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bustrace import session
from bustrace.functions.evidence import with_evidence
from bustrace.functions.identifiers import backward_rank, references, with_identifiers
from bustrace.functions.text import iso_text
from bustrace.model import COORDS, DETAIL_TYPE, ID_FIELDS, SOURCE_FIELDS
from bustrace.operators.decode import decode
from bustrace.operators.normalize import normalize
from bustrace.operators.predicates import in_topic_ranges, may_refer_to
from bustrace.operators.search import MERGED_ROWS, first_rows, topic_position
from bustrace.sources.references import COPY, ReferenceIndex, bucket_of, build_index

# Ids of up to so many bytes also serve to drop rows that cannot refer to any of them before they are decoded.
PREFILTER_BYTES = 4096

# Ids of more bytes meet the references slice by slice of their hash.
SLICED_BYTES = session.BROADCAST_BYTES
SLICES = 8

_COPY = COPY


def _no_trace(messages: DataFrame) -> DataFrame:
    return messages.withColumns(
        {
            "correlation_chain": F.array().cast("array<string>"),
            "correlation_details": F.array().cast(f"array<{DETAIL_TYPE}>"),
            "correlation_level": F.lit(0),
        }
    )


def _first_ids(carriers: DataFrame, order: list[str]) -> DataFrame:
    """Distinct ids of messages with ``ids``, chain and details; each id keeps the first message that carries it.

    ``min_by`` aggregates partially, so an id held by very many messages is reduced before the shuffle.
    """
    rows = carriers.select(*order, "correlation_chain", "correlation_details", F.explode_outer("ids").alias("_i"))
    rows = rows.filter("_i is not null")
    rank = F.struct(*order, "_i.method_rank", "_i.method")
    kept = F.struct("_i.method", F.col("correlation_chain").alias("chain"), F.col("correlation_details").alias("details"))
    return rows.groupBy(F.col("_i.id").alias("ref_id")).agg(F.min_by(kept, rank).alias("_k")).select("ref_id", "_k.*")


def _frontier(ids: DataFrame, max_breadth: int | None) -> tuple[DataFrame, int, int, int]:
    """Stored ids to follow next, at most ``max_breadth`` in id order: the table, its rows and bytes, and the ids left out.

    Rows and bytes are observed while the ids are written.
    """
    if max_breadth is None:
        return *session.store_measured(ids, "frontier"), 0
    every, n, _ = session.store_measured(ids, "frontier")
    if n <= max_breadth:
        return every, n, _, 0
    return *session.store_measured(first_rows(every, ["ref_id"], max_breadth), "frontier"), n - max_breadth


def _first_found(found: DataFrame) -> DataFrame:
    first = F.min(F.struct("ref_id", "kind_rank", "field_rank", "_copy", "field", "timestamp_utc")).alias("_first")
    return found.groupBy(*COORDS).agg(first).select(*COORDS, "_first.*")


def _discover(refs: DataFrame, frontier: DataFrame) -> DataFrame:
    """Coordinates found by the frontier, each once, by the first (id, kind of field) that finds it.

    Narrow rows only: of messages with equal coordinates one is chosen by its hash, and its payload is joined later.
    """
    return _first_found(refs.join(frontier, "ref_id", "left_semi"))


def _discover_in_slices(refs: DataFrame, frontier: DataFrame, buckets: int | None) -> DataFrame:
    """``_discover``, one slice of the ids after the other, so that shuffle files are those of one slice.

    References in ``buckets`` are read slice by slice; others are written in slices, each of which goes when it is joined.
    """
    spark = refs.sparkSession
    number = bucket_of("ref_id", buckets or SLICES) % SLICES
    parts = session.scratch_path(spark, "found")
    if buckets is None:
        kept = session.scratch_path(spark, "references")
        session.write_compact(refs.withColumn("slice", number), kept, ["slice"])
        slices = {int(f.rpartition("=")[2]): f for f in session.folders(spark, kept)}
    else:
        slices = dict.fromkeys(range(min(SLICES, buckets)))
    for i, folder in slices.items():
        rows = spark.read.schema(refs.schema).parquet(folder) if folder else refs.filter(F.col("bucket") % SLICES == i)
        part = _discover(rows, frontier.filter(number == i))
        session.write_compact(part, parts, mode="append")
        if folder:
            session.delete(spark, folder)
    if not slices:
        return _discover(refs.limit(0), frontier)
    return _first_found(spark.read.schema(part.schema).parquet(parts))


def _traced(found: DataFrame, frontier: DataFrame, backward: int) -> DataFrame:
    """``found`` with chain and details, which go on from those of the id that found it."""
    is_backward = F.col("kind_rank") == backward
    detail = F.struct(
        F.col("ref_id").alias("id"),
        F.when(is_backward, F.lit("backward")).otherwise(F.lit("forward")).alias("direction"),
        "field",
        F.when(is_backward, F.lit("backward_reference")).otherwise(F.col("method")).alias("extraction_method"),
        iso_text("timestamp_utc").alias("timestamp"),
    ).cast(DETAIL_TYPE)
    return found.join(frontier, "ref_id").withColumns(
        {
            "correlation_chain": F.concat("chain", F.array("ref_id")),
            "correlation_details": F.concat("details", F.array(detail)),
        }
    ).drop("chain", "details", "method", "field", "timestamp_utc")


def correlate(
    raw: DataFrame,
    seeds: DataFrame,
    follow_topics: list[str],
    *,
    limit: int | None = None,
    regex_patterns: list[str] | None = None,
    jsonpath_expressions: list[str] | None = None,
    max_depth: int | None = None,
    max_breadth: int | None = None,
    bidirectional: bool = False,
    id_fields: list[str] = ID_FIELDS,
    source_fields: list[str] = SOURCE_FIELDS,
    index: ReferenceIndex | None = None,
    **decoding,
) -> DataFrame:
    """Seeds (full messages) and the messages of ``follow_topics`` that carry their identifiers.

    One job finds the hits of all ids of a hop together. ``max_depth`` hops (None: one); per hop at most
    ``max_breadth`` ids in id order; ``bidirectional`` adds source fields. ``limit`` keeps the earliest seeds, then
    hits by hop, id, kind of field and scan order, and sorts the result by time; without it the whole result comes as
    an unordered table. Adds ``correlation_chain``, ``correlation_details`` and ``correlation_level``, and with
    ``max_breadth`` also ``ids_left_out``: how many ids that messages of its level gave away were not followed for it.

    References come from ``index`` (of the same messages or more). Without one, a single hop makes them as it goes, and
    several hops make an index first, so that no message is decoded for it twice. Hops join narrow tables only; payloads
    are joined and decoded once, for the hits of all hops. Only regular expressions and JSON paths need the payloads of a
    hop that is followed further. Seeds, frontiers and hits are stored in the shared folder.
    """
    for name, bound in (("max_depth", max_depth), ("max_breadth", max_breadth)):
        if bound is not None and bound < 1:
            raise ValueError(f"{name} must be at least 1, not {bound}")
    if index is not None:
        index.require(id_fields, source_fields)
    if "seed_pos" not in seeds.columns:
        seeds = seeds.withColumn("seed_pos", F.lit(0).cast("bigint"))
    position = ["seed_pos", "timestamp_utc", *COORDS]
    left_out: list[int] = []

    def counted(result: DataFrame) -> DataFrame:
        if max_breadth is None:
            return result
        of_level = F.try_element_at(F.array(*map(F.lit, left_out)).cast("array<long>"), F.col("correlation_level") + 1)
        return result.withColumn("ids_left_out", F.coalesce(of_level, F.lit(0)).cast("long"))

    if limit is not None and limit <= 0:
        return counted(_no_trace(seeds.limit(0)).drop("seed_pos"))
    if not follow_topics:
        kept = seeds if limit is None else first_rows(seeds, position, limit)
        return counted(_no_trace(kept).drop("seed_pos"))

    with session.compact():
        seeds = _no_trace(session.store(seeds, "seeds"))
    room = None if limit is None else limit - seeds.count()
    if room is not None:
        seeds_kept = first_rows(seeds, ["timestamp_utc", *position], limit).drop("seed_pos")
        if room <= 0:
            return counted(seeds_kept.orderBy("timestamp_utc", *COORDS))
    else:
        seeds_kept = seeds.drop("seed_pos")

    depth, backward = max_depth or 1, backward_rank(id_fields)
    follow = raw.filter(F.col("topic").isin(*follow_topics))
    if index is None and depth > 1:
        index = build_index(follow, id_fields, source_fields, **decoding)
    by_payload = bool(regex_patterns or jsonpath_expressions)
    order = ["ref_id", "kind_rank", "topic_pos", "field_rank", "partition", "offset"]

    def few_of(frontier: DataFrame, size: int) -> list[str] | None:
        """The ids when they are few: at most PREFILTER_BYTES come to the driver."""
        return [r["ref_id"] for r in frontier.select("ref_id").collect()] if size <= PREFILTER_BYTES else None

    def found_by(frontier: DataFrame, size: int) -> DataFrame:
        few = few_of(frontier, size)
        if index is not None:
            return index.found_by(frontier, few, follow_topics, bidirectional)
        rows = follow if few is None else follow.filter(may_refer_to(few, decoding.get("schemas") is not None))
        decoded = decode(normalize(rows.selectExpr("*", _COPY), keep=["_copy"]), **decoding)
        return references(decoded, ["timestamp_utc", "_copy"], bidirectional, id_fields, source_fields)

    def narrow_hits(frontier: DataFrame, size: int, last: bool) -> tuple[DataFrame, int, int]:
        """What the frontier finds and is not seen yet: coordinates, trace and the copy's hash, stored."""
        small, refs = session.broadcast_if_small(frontier, size), found_by(frontier, size)
        if size > SLICED_BYTES:
            found = _discover_in_slices(refs, frontier.select("ref_id"), index.buckets if index is not None else None)
        else:
            found = _discover(refs, small.select("ref_id"))
        new = found.join(seen, COORDS, "left_anti")
        new = new.withColumn("topic_pos", topic_position(follow_topics))
        if last and room is not None:
            new = first_rows(new, order, room)
        return session.store_measured(_traced(new, small, backward), "hits")

    def with_payload(hits: DataFrame, n: int, size: int) -> DataFrame:
        """Full messages of stored narrow hits. Of equal messages at one place, one is kept."""
        bounds = hits.select("topic", F.col("offset").alias("start"), (F.col("offset") + 1).alias("stop"))
        # Few hits lie in ranges that the scan can prune on; for many, that is not worth a job.
        rows = follow.filter(in_topic_ranges(bounds)) if n <= MERGED_ROWS else follow
        whole = rows.selectExpr("*", _COPY).join(session.broadcast_if_small(hits, size), [*COORDS, "_copy"])
        if index is None or not index.unique:
            whole = whole.dropDuplicates([*COORDS, "_copy"])
        trace = [c for c in hits.columns if c not in (*COORDS, "_copy")]
        return with_evidence(decode(normalize(whole, keep=[*trace, "_copy"]), **decoding))

    def ids_of(hits: DataFrame, n: int, size: int) -> DataFrame:
        if by_payload:
            return with_identifiers(with_payload(hits, n, size), regex_patterns, jsonpath_expressions, id_fields)
        return index.identifiers.join(session.broadcast_if_small(hits, size), [*COORDS, "_copy"]).dropDuplicates([*COORDS, "_copy"])

    own = with_identifiers(seeds, regex_patterns, jsonpath_expressions, id_fields)
    frontier, n, size, out = _frontier(_first_ids(own, []), max_breadth)
    followed, seen = frontier.select("ref_id"), seeds.select(*COORDS)
    hits, sizes, total = None, [0, 0], 0
    for level in range(1, depth + 1):
        if n == 0:
            break
        left_out.append(out)
        last = level == depth
        new, n_new, size_new = narrow_hits(frontier, size, last)
        leveled = new.withColumn("correlation_level", F.lit(level))
        hits = leveled if hits is None else hits.unionByName(leveled)
        sizes, total = [sizes[0] + n_new, sizes[1] + size_new], total + n_new
        if last or n_new == 0 or (room is not None and total >= room):
            break
        seen = seen.unionByName(new.select(*COORDS))
        ids = _first_ids(ids_of(new, n_new, size_new), order).join(followed, "ref_id", "left_anti")
        frontier, n, size, out = _frontier(ids, max_breadth)
        followed = followed.unionByName(frontier.select("ref_id"))
    if hits is None:
        result = seeds_kept
    else:
        if room is not None and total > room:
            hits, *sizes = session.store_measured(first_rows(hits, ["correlation_level", *order], room), "hits")
        found = with_payload(hits, *sizes).drop("_copy", *order[:4])
        result = seeds_kept.unionByName(found, allowMissingColumns=True)
    result = counted(result)
    if limit is None:
        return result
    order = ["timestamp_utc", "correlation_level", topic_position(follow_topics), "partition", "offset"]
    # A small number of rows is sorted in one place, without an exchange by range.
    return (result.coalesce(1) if limit <= MERGED_ROWS else result).orderBy(*order)


def correlation_summary(correlated: DataFrame) -> DataFrame:
    """Per discovering id: messages, topics and time span."""
    hits = correlated.filter(F.size("correlation_chain") > 0)
    return hits.groupBy(F.try_element_at("correlation_chain", F.lit(-1)).alias("id")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.sort_array(F.collect_set("topic")).alias("topics"),
        F.min("timestamp_utc").alias("first_seen"),
        F.max("timestamp_utc").alias("last_seen"),
    )


