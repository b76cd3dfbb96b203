"""The five continuous jobs. Each start function returns one query per output."""

from tidelog.streaming.append_lake import start_append_lake
from tidelog.streaming.capture import capture_snapshot, start_capture
from tidelog.streaming.queries import Trigger
from tidelog.streaming.search import start_search
from tidelog.streaming.upsert_lake import start_upsert_lake

__all__ = [
    "Trigger", "capture_snapshot", "start_append_lake", "start_capture", "start_search", "start_upsert_lake",
]
