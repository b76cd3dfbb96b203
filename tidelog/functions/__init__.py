"""Column expressions. All are built-in Spark functions: no Python runs per row."""

from tidelog.functions.classify import severity
from tidelog.functions.documents import document_id
from tidelog.functions.timeparts import (
    cdc_ts,
    event_time,
    now_or,
    parse_time,
    partition_date,
    payload_time,
    zoneless,
)

__all__ = [
    "cdc_ts", "document_id", "event_time", "now_or", "parse_time",
    "partition_date", "payload_time", "severity", "zoneless",
]
