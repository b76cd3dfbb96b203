"""Watermarks that move on while an input is silent.

Spark's watermark is the least over all inputs of a query. An input without rows therefore holds back what waits for it and
keeps join state for ever. Here each side also sees the *times* of the other side's records, ``lag`` seconds late, as rows that
move its watermark and go no further. So a silent side follows the other at that distance; a side that speaks leads by itself.

The distance is in event time, so that a replay frees state just as a live run does. Rows of one side that arrive more than ``lag``
behind the other count as late. Only a record's own capture time is used: a record without one counts as captured
now, and would carry the watermark of a replay into the present.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Seconds after which a silent input no longer counts, as the jobs set it.
IDLE_SECONDS = 30


def beats(records: DataFrame, lag_seconds: int = IDLE_SECONDS) -> DataFrame:
    """The capture times of envelope records, ``lag_seconds`` earlier; one field of the text is parsed."""
    captured = F.timestamp_millis(F.from_json("value", "ts_ms bigint")["ts_ms"])
    # The generator keeps the filter from being pushed below it, where the text would be parsed again.
    times = records.select(F.explode(F.array(captured - F.make_dt_interval(secs=F.lit(lag_seconds)))).alias("event_timestamp"))
    return times.where(F.col("event_timestamp").isNotNull())


def with_beats(rows: DataFrame, other: DataFrame | None, delay: str) -> DataFrame:
    """``rows`` under a watermark that the times in ``other`` move as well."""
    if other is None:
        return rows.withWatermark("event_timestamp", delay)
    marked = rows.withColumn("beat", F.lit(False)).unionByName(
        other.withColumn("beat", F.lit(True)), allowMissingColumns=True).withWatermark("event_timestamp", delay)
    # A generator lets beats go: what is asked of the rows later stays above it, else the optimizer would drop beats before
    # the watermark sees them. For the same reason its own condition names the event time.
    rest = [c for c in rows.columns if c != "event_timestamp"]
    row = F.array(F.struct(*rest))
    kept = F.when(F.col("beat") & F.col("event_timestamp").isNotNull(), F.slice(row, 1, 0)).otherwise(row)
    return marked.select("event_timestamp", F.explode(kept).alias("row")).select("event_timestamp", "row.*")
