"""Readers: logs, feeds, the raw table and the current state."""

from strata.sources.current import read_current
from strata.sources.feed import read_feed
from strata.sources.log import read_file_log, read_kafka, read_kafka_tail
from strata.sources.raw import read_raw

__all__ = [
    "read_current", "read_feed", "read_file_log", "read_kafka", "read_kafka_tail", "read_raw",
]
