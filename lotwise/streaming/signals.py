"""Streaming twins: incremental change detection, late duplicates, rolling activity."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lotwise import rules
from lotwise.sources.state import SignalState


def stream_into_state(signals: DataFrame, state: SignalState, checkpoint: str, at: dt.datetime,
                      name: str | None = None) -> StreamingQuery:
    """Feed a stream of identified signals into the state, one run per micro-batch.

    Each batch is reduced to the latest row per key before it meets the state.  Its line in
    the run log carries the stream's ``name`` (its checkpoint folder unless given) and the
    batch id: a batch repeated after a failure is found there and changes nothing, whatever
    runs the state has seen before or in between.
    """
    stream = name or checkpoint

    def apply(batch: DataFrame, batch_id: int) -> None:
        state.run(batch, at, (stream, batch_id))

    return (signals.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def without_redeliveries(stream: DataFrame, delivery_id: str, event_time: str = "event_ts",
                         overlap_days: int = rules.OVERLAP_DAYS) -> DataFrame:
    """Drop repeated deliveries of the same id within the overlap window.

    Only the delivery id counts: content that goes from A to B and back to A stays two
    changes.  State is dropped once the watermark has passed an id.
    """
    return (stream.withWatermark(event_time, f"{overlap_days} days")
            .dropDuplicatesWithinWatermark([delivery_id]))


def land(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to parquet files, exactly once per checkpoint."""
    return (stream.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
