"""The inverted reference table of a bus: by which ids a message is found, and which ids it gives away.

Made in one decode of the messages, so that no hop of a correlation decodes them again. As an archive it is written once,
clustered by a hash of the id, and appended per new offset range:

* ``references``: one row per way to find a message, in folders by bucket of the id and sorted by it inside, with Parquet
  Bloom filters on the id. A few ids are read by their buckets, row groups and filters; many ids meet it in a join.
* ``identifiers``: one row per message with the ids it gives away, in folders by topic and sorted by place.
* ``covered``: from which to which offset each partition was taken in.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bustrace.functions.evidence import with_evidence
from bustrace.functions.identifiers import backward_rank, reference_entries, with_identifiers
from bustrace.model import COORDS, ID_FIELDS, SOURCE_FIELDS
from bustrace.operators.decode import decode
from bustrace.operators.normalize import normalize
from bustrace.operators.predicates import in_topics
from bustrace.session import compact, delete, folders, scratch, scratch_path, store, write_compact
from bustrace.sources.archive import bloom_filter

BUCKETS = 64
PARTITION = ["topic", "partition"]

#: More rows than this are sorted in so many slices of their buckets.
SLICES, SLICED_ROWS = 8, 2_000_000

#: Tells apart messages that hold the same coordinates.
COPY = "xxhash64(key, value, timestamp, timestampType, headers) as _copy"

_REFERENCE = ["ref_id", *COORDS, "_copy", "kind_rank", "field_rank", "field", "timestamp_utc"]
_IDENTIFIER = [*COORDS, "_copy", "ids"]


@dataclass(frozen=True)
class ReferenceIndex:
    """``references`` and ``identifiers`` of a bus, and the fields they were made of.

    ``buckets``: number of folders of the references, None for a table that has none. ``unique``: no two messages hold
    the same coordinates.
    """

    references: DataFrame
    identifiers: DataFrame
    id_fields: tuple[str, ...] = tuple(ID_FIELDS)
    source_fields: tuple[str, ...] = tuple(SOURCE_FIELDS)
    buckets: int | None = None
    unique: bool = False

    def require(self, id_fields: list[str], source_fields: list[str]) -> None:
        if (tuple(id_fields), tuple(source_fields)) != (self.id_fields, self.source_fields):
            raise ValueError("the index was made of other identifier or source fields")

    def found_by(self, frontier: DataFrame, few: list[str] | None, topics: list[str], bidirectional: bool) -> DataFrame:
        """References of ``topics``; only those of the ``few`` ids when these are given, which reaches the scan.

        With their bucket where the index has buckets.
        """
        rows = self.references.filter(in_topics(topics))
        if not bidirectional:
            rows = rows.filter(F.col("kind_rank") != backward_rank(list(self.id_fields)))
        if few is not None:
            rows = rows.filter(F.col("ref_id").isin(*few) if few else F.lit(False))
        if self.buckets is None:
            return rows
        if few is not None:
            # At most ``buckets`` numbers.
            held = [r[0] for r in frontier.select(bucket_of("ref_id", self.buckets).alias("b")).distinct().collect()]
            rows = rows.filter(F.col("bucket").isin(*held) if held else F.lit(False))
        return rows


def bucket_of(column: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def entries(raw: DataFrame, id_fields: list[str] = ID_FIELDS, source_fields: list[str] = SOURCE_FIELDS, **decoding) -> DataFrame:
    """References of raw messages, with the messages' own ids in the row of their key; one decode, no shuffle."""
    rows = decode(normalize(raw.selectExpr("*", COPY), keep=["_copy"]), **decoding)
    rows = with_identifiers(with_evidence(rows), id_fields=id_fields)
    found = reference_entries(rows, ["timestamp_utc", "_copy", "ids"], True, id_fields, source_fields)
    own = F.expr("if(kind_rank = 0 and size(ids) > 0, ids, null)").alias("ids")
    return found.select(
        F.col("_text").alias("ref_id"), *(c for c in _REFERENCE if c != "ref_id"), own
    )


def _split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    bucket = ["bucket"] if "bucket" in rows.columns else []
    return rows.filter("ref_id is not null").select(*_REFERENCE, *bucket), rows.filter("ids is not null").select(*_IDENTIFIER)


def build_index(
    raw: DataFrame, id_fields: list[str] = ID_FIELDS, source_fields: list[str] = SOURCE_FIELDS, **decoding
) -> ReferenceIndex:
    """The index of some messages for one correlation: decoded once, stored as it comes."""
    with compact():
        references, identifiers = _split(store(entries(raw, id_fields, source_fields, **decoding), "references"))
    return ReferenceIndex(references, identifiers, tuple(id_fields), tuple(source_fields))


def _covered(raw: DataFrame) -> DataFrame:
    return raw.groupBy(*PARTITION).agg(F.min("offset").alias("start"), (F.max("offset") + 1).alias("stop"))


def _write(raw: DataFrame, path: str, buckets: int, id_fields: list[str], source_fields: list[str], decoding: dict) -> None:
    """Write references, identifiers and the covered ranges of ``raw``.

    The decoded rows lie in slices of buckets; many rows are dealt out and sorted slice by slice, and each slice goes when
    it is written, so that shuffle files and rows on their way never take the disk of the whole table.
    """
    spark, slices = raw.sparkSession, min(SLICES, buckets)
    with scratch():
        rows = entries(raw, id_fields, source_fields, **decoding)
        bucketed = rows.withColumn("bucket", F.when(F.col("ref_id").isNotNull(), bucket_of("ref_id", buckets)))
        kept = scratch_path(spark, "references")
        seen = Observation()
        # Rows without a reference, which hold ids alone, lie in the first slice.
        sliced = bucketed.withColumn("slice", F.coalesce(F.col("bucket") % slices, F.lit(0)))
        write_compact(sliced.observe(seen, F.count(F.lit(1)).alias("n")), kept, ["slice"])
        one = seen.get["n"] <= SLICED_ROWS

        def stored(folder: str) -> tuple[DataFrame, DataFrame]:
            return _split(spark.read.schema(bucketed.schema).parquet(folder))

        # Placed by topic and offset, which the ids of a slice alone could not be.
        placed = stored(kept)[1].repartitionByRange(*COORDS).sortWithinPartitions(*COORDS)
        write_compact(placed, f"{path}/identifiers", ["topic"], "append")
        for folder in [kept] if one else folders(spark, kept):
            # Hashed by id and place: a bucket with a hot id is spread over many tasks, and no task writes many buckets.
            references = stored(folder)[0]
            spread = references.repartitionByRange("bucket", "ref_id", *COORDS).sortWithinPartitions("bucket", "ref_id", *COORDS)
            write_compact(spread, f"{path}/references", ["bucket"], "append", **bloom_filter("ref_id"))
            delete(spark, folder)
        twice = raw.groupBy(*COORDS).count().filter("count > 1").limit(1).count()
        _covered(raw).withColumn("unique", F.lit(not twice)).write.mode("append").parquet(f"{path}/covered")


def write_index(
    raw: DataFrame,
    path: str,
    *,
    buckets: int = BUCKETS,
    id_fields: list[str] = ID_FIELDS,
    source_fields: list[str] = SOURCE_FIELDS,
    **decoding,
) -> None:
    """Write the index of ``raw`` to a new folder."""
    settings = {"buckets": buckets, "id_fields": list(id_fields), "source_fields": list(source_fields)}
    spark = raw.sparkSession
    spark.createDataFrame([(json.dumps(settings),)], "settings string").coalesce(1).write.parquet(f"{path}/settings")
    _write(raw, path, buckets, id_fields, source_fields, decoding)


def _settings(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.parquet(f"{path}/settings").first()["settings"])


def append_index(raw: DataFrame, path: str, **decoding) -> None:
    """Take in the messages of ``raw`` that lie behind what the index covers of their partition.

    So a range can be offered twice, and messages of new partitions are taken whole. A partition's log only grows at its
    end; rows in front of or inside the covered range are left out.
    """
    spark = raw.sparkSession
    settings = _settings(spark, path)
    covered = spark.read.parquet(f"{path}/covered").groupBy(*PARTITION).agg(F.max("stop").alias("_stop"))
    new = raw.join(F.broadcast(covered), PARTITION, "left").filter("_stop is null or offset >= _stop").drop("_stop")
    with scratch():
        with compact():
            new = store(new.select(*raw.columns), "new-messages")
        if not new.isEmpty():
            _write(new, path, settings["buckets"], settings["id_fields"], settings["source_fields"], decoding)


def covered(spark: SparkSession, path: str) -> DataFrame:
    """(topic, partition, start, stop): the offsets an index has taken in."""
    rows = spark.read.parquet(f"{path}/covered")
    return rows.groupBy(*PARTITION).agg(F.min("start").alias("start"), F.max("stop").alias("stop"))


def read_index(spark: SparkSession, path: str) -> ReferenceIndex:
    settings = _settings(spark, path)
    references = spark.read.parquet(f"{path}/references").select(*_REFERENCE, "bucket")
    identifiers = spark.read.parquet(f"{path}/identifiers").select(*_IDENTIFIER)
    unique = spark.read.parquet(f"{path}/covered").agg(F.min(F.col("unique").cast("int"))).first()[0]
    return ReferenceIndex(
        references, identifiers, tuple(settings["id_fields"]), tuple(settings["source_fields"]), settings["buckets"], unique == 1
    )
