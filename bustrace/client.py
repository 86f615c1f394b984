"""The six operations over one bus."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from bustrace import session
from bustrace.operators import lag, lookup, offsets, search
from bustrace.plans.correlate import correlate
from bustrace.plans.investigate import investigate
from bustrace.sources.references import ReferenceIndex


@dataclass
class Bus:
    """A message table in the raw layout with its optional companions.

    ``schemas``: registry snapshot; ``committed``: committed offsets; ``partition_meta``: broker metadata; ``blocks`` and
    ``index``: the block index and the inverted reference table of the archive that ``raw`` is; ``decoding``: further
    arguments of ``decode``.
    """

    raw: DataFrame
    schemas: DataFrame | None = None
    committed: DataFrame | None = None
    partition_meta: DataFrame | None = None
    decoding: dict = field(default_factory=dict)
    blocks: DataFrame | None = None
    index: ReferenceIndex | None = None

    def __post_init__(self):
        session.configure(self.raw.sparkSession)
        self._decoding = {"schemas": self.schemas, **self.decoding}

    def list_topics(self, include_internal: bool = False) -> DataFrame:
        return offsets.list_topics(self.raw, include_internal, self.partition_meta)

    def describe_topic(self, topic: str) -> DataFrame:
        return offsets.describe_topic(self.raw, topic, self.partition_meta)

    def get_message(self, topic: str, partition: int, offset: int) -> DataFrame:
        return lookup.get_message(self.raw, topic, partition, offset, self.partition_meta, **self._decoding)

    def get_messages(self, coords: DataFrame) -> DataFrame:
        return lookup.get_messages(self.raw, coords, self.partition_meta, **self._decoding)

    def search_messages(self, key: str, *, topics: list[str] | None = None, **options) -> DataFrame:
        """Raises TopicNotFound for a listed topic that does not exist."""
        offsets.require_topics(self.raw, topics or [], self.partition_meta)
        return search.search_messages(self.raw, key, topics=topics, blocks=self.blocks, **options, **self._decoding)

    def search_many(self, keys: DataFrame, **options) -> DataFrame:
        return search.search_many(self.raw, keys, **options, **self._decoding)

    def consumer_group_lag(self, group: str | None = None, topics: list[str] | None = None) -> DataFrame:
        if self.committed is None:
            raise ValueError("no committed offsets given")
        marks = offsets.watermarks(self.raw, self.partition_meta, self.blocks)
        return lag.consumer_group_lag(self.committed, marks, group, topics)

    def correlate_messages(self, initial_results: DataFrame, follow_topics: list[str], **options) -> DataFrame:
        return correlate(self.raw, initial_results, follow_topics, **self._indexed(options), **self._decoding)

    def investigate(self, key: str, follow_topics: list[str], **options) -> DataFrame:
        return investigate(self.raw, key, follow_topics, **self._indexed(options), decoding=self._decoding)

    def _indexed(self, options: dict) -> dict:
        return options if self.index is None else {"index": self.index, **options}
