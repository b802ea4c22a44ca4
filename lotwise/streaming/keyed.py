"""Change detection in keyed stream state: a signal in, its status out, no stored table joined.

Each signal's content hash, first sighting and number of changes live in the stream's own state
store (RocksDB, so it may be larger than memory), next to the task that handles the key.  A call
into the state costs far more than a signal's own work, so signals are kept by bucket of their
id: one call reads a bucket, one writes it back, and a batch costs the buckets it mentions.
Entries that were not delivered for longer than a signal stays active plus the overlap are
forgotten; one delivered again after that is new.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from lotwise import rules
from lotwise.operators.delta import CHANGED, NEW, UNCHANGED

# A bucket's signals, one after the other; first_seen in microseconds, kept_until in milliseconds.
KNOWN = "signal_id array<{id}>, content_hash array<string>, first_seen array<long>, change_count array<int>, kept_until array<long>"
BUCKETS = 8192  # part of the state: another number would not find what a checkpoint knows
KEEP_DAYS = rules.ACTIVE_DAYS + rules.OVERLAP_DAYS
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # State that expires by the clock would ask for empty batches for ever, and a run would not end.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
ORDER = ["event_date", "notice_id", "content_hash"]
NO_END = 2**63 - 1


class SignalMemory(StatefulProcessor):
    """What is known of a bucket's signals, each updated by the latest of the rows a batch has of it."""

    def __init__(self, keep_days: int, id_type: str = "string"):
        self.keep_ms = int(dt.timedelta(days=keep_days).total_seconds() * 1000)
        self.kept = KNOWN.format(id=id_type)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", self.kept, self.keep_ms)  # a bucket goes with its last signal

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        latest, told = {}, Row("signal", "status", "first_seen", "change_count")
        rank = lambda signal: [(signal[c] is not None, signal[c]) for c in ORDER]
        for row in rows:  # of each signal one row is held, whatever a batch has of it
            signal = row["signal"]
            held = latest.setdefault(signal["signal_id"], signal)
            if held is not signal and rank(signal) >= rank(held):
                latest[signal["signal_id"]] = signal
        now = timerValues.getCurrentProcessingTimeInMs()
        kept_until = now + self.keep_ms if self.keep_ms else NO_END
        known = {i: entry for i, *entry in zip(*(self.known.get() or [])) if entry[-1] > now}
        for i, signal in latest.items():
            content = signal["content_hash"]
            if i in known:
                before, first_seen, changes, _ = known[i]
                status = UNCHANGED if before == content else CHANGED
                changes += status == CHANGED
            else:
                status, first_seen, changes = NEW, signal["_seen"], 0
            known[i] = (content, first_seen, changes, kept_until)  # kept from this delivery on, also when nothing changed
            yield told(signal, status, first_seen, changes)
        self.known.update(([*known], *map(list, zip(*known.values()))))

    def close(self) -> None:
        pass


def changes(signals: DataFrame, keep_days: int = KEEP_DAYS) -> DataFrame:
    """A stream of identified signals with ``seen_at`` -> per batch and signal its latest row with
    ``status``, ``first_seen_at`` and ``change_count``.

    Content that goes from A to B and back to A in three batches is reported as changed twice.
    """
    bucket = F.pmod(F.xxhash64("signal_id"), F.lit(BUCKETS)).cast("int")
    rest = [c for c in signals.columns if c != "seen_at"]
    whole = signals.select(bucket.alias("bucket"), F.struct(*rest, F.unix_micros("seen_at").alias("_seen")).alias("signal"))
    told = StructType([whole.schema["signal"], *StructType.fromDDL("status string, first_seen long, change_count int").fields])
    memory = SignalMemory(keep_days, signals.schema["signal_id"].dataType.simpleString())
    out = whole.groupBy("bucket").transformWithState(memory, told, "Append", "ProcessingTime")
    own = [F.timestamp_micros("signal._seen").alias(c) if c == "seen_at" else F.col("signal").getField(c).alias(c) for c in signals.columns]
    return out.select(*own, "status", F.timestamp_micros("first_seen").alias("first_seen_at"), "change_count")


@contextmanager
def keyed_settings(spark: SparkSession):
    """Streams started inside keep their state in RocksDB and end when their input does."""
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def emit_changes(signals: DataFrame, out: str, checkpoint: str, at: dt.datetime, keep_days: int = KEEP_DAYS) -> StreamingQuery:
    """Append what the deliveries so far have not been told yet; the checkpoint carries the state from call to call."""
    seen = changes(signals.withColumn("seen_at", F.lit(at).cast("timestamp")), keep_days)
    with keyed_settings(signals.sparkSession):
        return (seen.writeStream.format("parquet").outputMode("append").option("path", out)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
