"""Errors raised by the single-result operations; the table forms report the same causes in columns."""


class BusError(Exception):
    """Base class."""


class TopicNotFound(BusError):
    def __init__(self, topic: str):
        super().__init__(f"topic not found: {topic}")
        self.topic = topic


class _AtCoordinates(BusError):
    what = ""

    def __init__(self, topic: str, partition: int, offset: int, reason: str = ""):
        place = f"{topic}[{partition}]@{offset}"
        super().__init__(f"{self.what} at {place}" + (f": {reason}" if reason else ""))
        self.topic, self.partition, self.offset, self.reason = topic, partition, offset, reason


class MessageNotFound(_AtCoordinates):
    what = "no message"


class MessageMissing(_AtCoordinates):
    """The offset lies inside the watermarks but the table holds no such row."""

    what = "in-range message not delivered"


class DecodeError(_AtCoordinates):
    what = "payload cannot be decoded"
