"""How a stream is started: trigger, checkpoint, name."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

# Commit interval and allowed disorder of the jobs.
COMMIT_INTERVAL = "5 seconds"
WATERMARK_DELAY = "10 seconds"


@dataclass(frozen=True)
class Trigger:
    """Run continuously, or once over everything that is there (``available_now``)."""

    interval: str = COMMIT_INTERVAL
    available_now: bool = False

    def on(self, writer: DataStreamWriter) -> DataStreamWriter:
        if self.available_now:
            return writer.trigger(availableNow=True)
        return writer.trigger(processingTime=self.interval)


def start(writer: DataStreamWriter, name: str, checkpoints: str, trigger: Trigger) -> StreamingQuery:
    """Start one output. Its checkpoint is kept when the query stops; a restart resumes from it."""
    writer = writer.queryName(name).option("checkpointLocation", f"{checkpoints.rstrip('/')}/{name}")
    return trigger.on(writer).start()


def chosen(outputs: dict, only: Collection[str] | None) -> dict:
    """The outputs to start: all of them, or those named."""
    unknown = set(only or ()) - set(outputs)
    if unknown:
        raise ValueError(f"no such output: {sorted(unknown)}; there are {sorted(outputs)}")
    return {name: output for name, output in outputs.items() if only is None or name in only}


def finish(queries: list[StreamingQuery]) -> None:
    """Wait until bounded queries have taken all input; the first error is raised."""
    for query in queries:
        query.awaitTermination()
