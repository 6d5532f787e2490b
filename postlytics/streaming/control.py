"""Start, wait and stop."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from postlytics.settings import DEFAULTS, Settings


def start(writer: DataStreamWriter, once: bool = False, settings: Settings = DEFAULTS) -> StreamingQuery:
    """Start with the micro-batch interval, or over what is there now and then end."""
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=settings.trigger).start()


def run_for(query: StreamingQuery, minutes: float = DEFAULTS.run_minutes) -> None:
    """Let the query run for a bounded time, then stop it; its errors are raised here."""
    try:
        query.awaitTermination(int(minutes * 60))
    finally:
        query.stop()


def finish(query: StreamingQuery) -> None:
    """Wait for a query started with `once`."""
    query.awaitTermination()
