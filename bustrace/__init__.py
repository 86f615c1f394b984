"""What happened on the bus to a business key: search, lookup, lag and correlation over message tables."""

from bustrace.client import Bus
from bustrace.errors import BusError, DecodeError, MessageMissing, MessageNotFound, TopicNotFound
from bustrace.operators.decode import decode
from bustrace.operators.lag import consumer_group_lag, lag_summary
from bustrace.operators.lookup import get_message, get_messages
from bustrace.operators.normalize import normalize
from bustrace.operators.offsets import (
    describe_topic,
    describe_topics,
    list_topics,
    offsets_for_times,
    partition_ids,
    watermarks,
)
from bustrace.operators.search import enrich, match_messages, scan_partition, search_many, search_messages
from bustrace.plans.correlate import correlate, correlation_summary
from bustrace.plans.investigate import investigate
from bustrace.session import configure
from bustrace.sources.archive import read_archive, write_archive
from bustrace.sources.blocks import read_blocks
from bustrace.sources.export import export_json, import_json, read_json, write_json
from bustrace.sources.kafka import kafka_options, read_kafka
from bustrace.sources.references import ReferenceIndex, append_index, build_index, read_index, write_index

__all__ = [
    "Bus", "BusError", "DecodeError", "MessageMissing", "MessageNotFound", "ReferenceIndex",
    "TopicNotFound", "append_index", "build_index", "configure", "consumer_group_lag", "correlate", "correlation_summary", "decode", "describe_topic",
    "describe_topics", "enrich", "export_json", "get_message", "get_messages", "import_json", "investigate",
    "kafka_options", "lag_summary", "list_topics", "match_messages", "normalize", "offsets_for_times",
    "partition_ids", "read_archive", "read_blocks", "read_index", "read_json", "read_kafka", "scan_partition", "search_many", "search_messages",
    "watermarks", "write_archive", "write_index", "write_json",
]
