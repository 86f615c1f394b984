"""Options for Spark's Kafka source: read-only, by assignment of offsets, no group and no commit."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from bustrace.functions.params import as_utc
from bustrace.sources.archive import as_raw

# Positions the Kafka source understands in its offset JSON.
EARLIEST, LATEST = -2, -1

Offsets = dict[str, dict[int, int]]


def _offsets_json(offsets: Offsets) -> str:
    return json.dumps({t: {str(p): o for p, o in sorted(parts.items())} for t, parts in sorted(offsets.items())})


def kafka_options(
    bootstrap_servers: str,
    topics: list[str],
    *,
    starting: Offsets | None = None,
    ending: Offsets | None = None,
    time_from: datetime | None = None,
    **connection: str,
) -> dict[str, str]:
    """Options of a bounded read: ``starting`` inclusive, ``ending`` exclusive, or a seek to ``time_from``.

    ``connection`` passes client settings (security and the like); ``a_b`` becomes ``kafka.a.b``.
    """
    if not bootstrap_servers:
        raise ValueError("bootstrap_servers is missing")
    if not topics:
        raise ValueError("topics is empty")
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": ",".join(topics),
        "includeHeaders": "true",
        "startingOffsets": _offsets_json(starting) if starting else "earliest",
        "endingOffsets": _offsets_json(ending) if ending else "latest",
    }
    if time_from is not None:
        del options["startingOffsets"]
        options["startingTimestamp"] = str(int(as_utc(time_from).timestamp() * 1000))
        options["startingOffsetsByTimestampStrategy"] = "latest"
    options.update({f"kafka.{name.replace('_', '.')}": value for name, value in connection.items()})
    return options


def read_kafka(spark: SparkSession, bootstrap_servers: str, topics: list[str], **options) -> DataFrame:
    """Needs the Kafka connector on the class path."""
    settings = kafka_options(bootstrap_servers, topics, **options)
    return as_raw(spark.read.format("kafka").options(**settings).load())
