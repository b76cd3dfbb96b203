"""Readers. Each one is a Spark format plus options, with files as the default."""

from tidelog.sources.lake import open_table, register_lake
from tidelog.sources.records import read_change_events, read_records

__all__ = ["open_table", "read_change_events", "read_records", "register_lake"]
