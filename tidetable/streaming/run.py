"""Running streams: bounded runs over everything available, end-of-input flush and firing policies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from tidetable.functions import timewin

Sink = Callable[[DataStreamWriter], DataStreamWriter]


def drain(stream: DataFrame, sink: Sink, checkpoint: str, mode: str = "append", name: str | None = None) -> None:
    """Process everything available, then stop. A later call with the same checkpoint goes on from there."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer = sink(writer.queryName(name) if name else writer)
    writer.start().awaitTermination()


def drain_and_flush(
    stream: DataFrame, sink: Sink, checkpoint: str, flush: Callable[[], None], mode: str = "append"
) -> None:
    """Drain, let ``flush`` add a far-future row to the source, and drain again from the checkpoint.

    The late row moves the watermark past every window with data, as the end of a bounded input does. It comes only
    after all data is processed, so it can make no row late.
    """
    drain(stream, sink, checkpoint, mode)
    flush()
    drain(stream, sink, checkpoint, mode)


def continuous(stream: DataFrame, sink: Sink, checkpoint: str, every: str = "1 second", mode: str = "append", name=None):
    """Start a standing query with one micro-batch per ``every``; its state commits exactly once per batch."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = sink(writer.queryName(name) if name else writer)
    return writer.trigger(processingTime=every).start()


def with_lateness(df: DataFrame, ts: str, disorder: str, lateness: str) -> DataFrame:
    """Watermark that keeps windows open for late refinements: bounded disorder plus allowed lateness.

    In update mode each micro-batch emits the windows it changed: before the watermark as early results, and for
    ``lateness`` longer as late ones.
    """
    total = timewin.micros_of(disorder) + timewin.micros_of(lateness)
    return df.withWatermark(ts, f"{total // 1000} milliseconds")
