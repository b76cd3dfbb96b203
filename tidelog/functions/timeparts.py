"""Event time, payload time and the columns derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The day used when no time is known, and the accepted text form
# of a timestamp (three fraction digits, or none).
DEFAULT_PARTITION_DATE = "2025-01-01"
TIME_TEXT = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d(\.\d{3})?$"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def now_or(now: Column | None) -> Column:
    """The given instant, else the current one in milliseconds (TIMESTAMP)."""
    return F.date_trunc("millisecond", F.current_timestamp()) if now is None else now


def zoneless(instant: Column) -> Column:
    return instant.cast("timestamp_ntz")


def event_time(ts_ms: Column, now: Column | None = None) -> Column:
    """Capture time of a change; a change without one happens now."""
    return F.coalesce(F.timestamp_millis(ts_ms), now_or(now))


def parse_time(text: Column) -> Column:
    """Zone-less timestamp from text, NULL when the text has another form.

    A pattern check and a cast take a third of the time of a pattern parser.
    """
    return F.when(text.rlike(TIME_TEXT), text.try_cast("timestamp_ntz"))


def payload_time(text: Column, now: Column | None = None) -> Column:
    """Parsed time; a *missing* value means now, an unparsable one stays NULL."""
    return F.when(text.isNotNull(), parse_time(text)).otherwise(zoneless(now_or(now)))


def cdc_ts(ts: Column) -> Column:
    """Milliseconds since the epoch at whole seconds: the fraction is dropped."""
    return (F.unix_timestamp(ts) * 1000).cast("bigint")


def partition_date(*times: Column) -> Column:
    """Day of the first known time, as text."""
    return F.coalesce(F.to_date(F.coalesce(*times)).cast("string"), F.lit(DEFAULT_PARTITION_DATE))
