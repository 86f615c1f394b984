import json
import os
import sys
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

import bustrace as b  # noqa: E402
from bustrace.model import RAW_SCHEMA  # noqa: E402

T0 = datetime(2026, 6, 8, 12, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield b.configure(session)
    session.stop()


def message(topic, offset, value=None, *, key=None, headers=(), ts=T0, partition=0, ts_type=0):
    """One raw row; a dict value becomes JSON, header values may be text, bytes or None."""

    def data(x):
        return x.encode() if isinstance(x, str) else x

    if isinstance(value, (dict, list)):
        value = json.dumps(value)
    pairs = None if headers is None else [(n, data(v)) for n, v in (headers.items() if isinstance(headers, dict) else headers)]
    return (data(key), data(value), topic, partition, offset, ts, ts_type, pairs)


@pytest.fixture(scope="session")
def bus(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), RAW_SCHEMA)

    return make


def coords(df):
    return [(r["topic"], r["partition"], r["offset"]) for r in df.collect()]
