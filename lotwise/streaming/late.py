"""Late rows of a stream go to a bucket of their own, judged by the watermark the state carries."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lotwise.operators import delta
from lotwise.operators.signals import OPEN_TENDER
from lotwise.sources.state import SignalState


def stream_with_late_bucket(signals: DataFrame, state: SignalState, checkpoint: str, at: dt.datetime,
                            name: str | None = None, default: dt.date | None = None) -> StreamingQuery:
    """Feed a stream into the state; rows older than their source is read from are kept apart.

    The watermark of a source is the day its last good run began, less the overlap, as the state's
    run log has it when the batch arrives (``default`` for a source without one).  A batch
    writes its late rows into a folder named by stream and batch, replacing it, and then commits
    the others as a run.  Until that line is in the log the watermarks cannot move, so
    a batch repeated after a failure parts its rows as before; afterwards it is left alone.  So
    every row is in exactly one of the two places, once.
    """
    stream = name or checkpoint
    first_day = default or delta.first_fetch_day(at.date())

    def apply(batch: DataFrame, batch_id: int) -> None:
        if state.run_of((stream, batch_id)):
            return
        since = delta.fetch_since(state.runs(), at.date())
        tagged = delta.tag_late(batch, since, first_day, F.col("signal_type") == OPEN_TENDER).persist()
        try:
            (tagged.filter("late").drop("late").write.mode("overwrite")
             .parquet(f"{late_root(state, stream)}/batch={batch_id}"))
            state.run(tagged.filter("NOT late").drop("late"), at, (stream, batch_id))
        finally:
            tagged.unpersist()

    return (signals.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def late_root(state: SignalState, stream: str) -> str:
    return f"{state.root}/late_stream/{stream.rstrip('/').rpartition('/')[2]}"


def late_rows(spark: SparkSession, state: SignalState, stream: str, like: DataFrame) -> DataFrame:
    """What the stream has put aside so far."""
    try:
        return spark.read.schema(like.schema).parquet(late_root(state, stream)).select(*like.columns)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], like.schema)
