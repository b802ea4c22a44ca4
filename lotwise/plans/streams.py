"""Streaming queries over the event table, landed in the shared folder and read back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from lotwise.operators import accounts, signals as ops
from lotwise.plans.registry import ORACLES, query
from lotwise.plans.signals import DELTA, FIRST_END, ROLLING, SECOND_START, run_log
from lotwise.plans.views import table
from lotwise.schemas import RUN_LOG, SIGNAL_COLUMNS
from lotwise.session import shared_folder
from lotwise.sources.bucketed import BucketedState
from lotwise.sources.state import STATUS, SignalState
from lotwise.streaming.keyed import emit_changes
from lotwise.streaming.late import late_rows as late_bucket, stream_with_late_bucket
from lotwise.streaming.signals import land, stream_into_state, without_redeliveries

RUN_AT = dt.datetime(2024, 2, 1)
CLOSING = "-closing-"
SHIFT = 9000  # days between the run log's orders and the events


def run_folder(spark, name: str) -> str:
    """A fresh folder per call under the shared one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def event_stream(spark, d):
    """The event table as a stream; the pattern fits a single file and a folder of files."""
    schema = table(spark, d, "events").schema
    return spark.readStream.schema(schema).parquet(f"{d}/events.parque[t]").withColumn(
        "event_ts", F.col("ts").cast("timestamp"))


def as_signals(events):
    """Events in the full signal shape; the payload carries the value that may change."""
    k = F.coalesce(F.get_json_object("props", "$.k"), F.lit("-"))
    cents = F.bround(F.col("value") * 100, 0).cast("long").cast("string")
    filled = {
        "source": F.col("event_type"), "external_id": F.concat_ws(":", F.col("user_id").cast("string"), k),
        "signal_type": F.lit("teilnahme_belegt"), "event_date": F.to_date("ts"),
        "org_name_raw": F.concat(F.lit("Firma "), F.col("user_id").cast("string")), "title": F.lit(""),
        "notice_id": F.format_string("%020d", F.col("event_id")), "is_buyer_side": F.lit(False), "payload": cents,
        "cpv": F.array().cast("array<string>"),
    }
    kinds = {"contract_end": "date", "deadline": "date", "value": "double"}
    cols = [filled.get(c, F.lit(None).cast(kinds.get(c, "string"))).alias(c) for c in SIGNAL_COLUMNS]
    rows = events.select(*cols, F.col("user_id").cast("string").alias("company_id"),
                         F.lit(0.5).alias("match_confidence"), F.lit(False).alias("consortium"))
    return (rows.withColumn("signal_id", ops.signal_id(F.col("source"), F.col("external_id")))
            .withColumn("content_hash", F.substring(F.sha2("payload", 256), 1, 32)))


@query("delta_status_stream", f"WITH {DELTA} SELECT signal_id, source, external_id, content_hash, status FROM st")
def delta_status_stream(spark, d):
    """Two overlapping deliveries through the same state; the second run's statuses."""
    root = run_folder(spark, "delta")
    state = SignalState(spark, f"{root}/state")
    deliveries = [F.col("ts") < F.lit(FIRST_END), F.col("ts") >= F.lit(SECOND_START)]
    for i, part in enumerate(deliveries, 1):
        stream = as_signals(event_stream(spark, d).filter(part))
        stream_into_state(stream, state, f"{root}/checkpoint-{i}", RUN_AT).awaitTermination()
    return state.delta(len(deliveries)).select("signal_id", "source", "external_id", "content_hash", "status")


def three_runs(spark, d):
    """Two overlapping deliveries and a quiet run through the state, all sources asked each time."""
    state = SignalState(spark, f"{run_folder(spark, 'weekly')}/state")
    events = as_signals(table(spark, d, "events"))
    day = F.col("notice_id").cast("long")
    times = table(spark, d, "events").select(F.col("event_id").alias("_e"), F.col("ts").alias("_ts"))
    dated = events.join(times, day == F.col("_e")).drop("_e")
    asked = [r.event_type for r in table(spark, d, "events").select("event_type").distinct().collect()]
    for part in (F.col("_ts") < F.lit(FIRST_END), F.col("_ts") >= F.lit(SECOND_START), F.lit(False)):
        state.run(dated.filter(part).drop("_ts"), RUN_AT, sources=[*asked, "silent"])
    return state


RUN_LOG_SQL = f"""
WITH {DELTA}, asked AS (SELECT DISTINCT event_type AS source FROM events UNION ALL SELECT 'silent'),
r AS (SELECT 1 AS run_id, source, 'new' AS status FROM old UNION ALL SELECT 2, source, status FROM st),
g AS (SELECT run_id, source, count(*) AS rows_in, count(*) FILTER (WHERE status = 'new') AS rows_new,
  count(*) FILTER (WHERE status = 'changed') AS rows_changed, count(*) FILTER (WHERE status = 'unchanged') AS rows_unchanged FROM r GROUP BY ALL)
SELECT CAST(n.run_id AS BIGINT) AS run_id, source, coalesce(rows_in, 0) AS rows_in, coalesce(rows_new, 0) AS rows_new,
  coalesce(rows_changed, 0) AS rows_changed, coalesce(rows_unchanged, 0) AS rows_unchanged
FROM range(1, 4) n(run_id) CROSS JOIN asked LEFT JOIN g USING (run_id, source)"""


@query("weekly_run_log", RUN_LOG_SQL)
def weekly_run_log(spark, d):
    return three_runs(spark, d).runs().select("run_id", "source", "rows_in", "rows_new", "rows_changed", "rows_unchanged")


@query("weekly_state", f"""
WITH {DELTA}
SELECT coalesce(new.signal_id, old.signal_id) AS signal_id, coalesce(new.content_hash, old.content_hash) AS content_hash,
  CAST(CASE WHEN old.signal_id IS NULL THEN 2 ELSE 1 END AS BIGINT) AS first_seen_run,
  CAST(CASE WHEN new.signal_id IS NULL THEN 1 ELSE 2 END AS BIGINT) AS last_seen_run,
  CAST(CASE WHEN new.content_hash <> old.content_hash THEN 1 ELSE 0 END AS INTEGER) AS change_count
FROM new FULL JOIN old USING (signal_id)""")
def weekly_state(spark, d):
    return three_runs(spark, d).current().select("signal_id", "content_hash", "first_seen_run", "last_seen_run", "change_count")


@query("dedupe_watermark_stream", "SELECT event_id, event_type FROM events")
def dedupe_watermark_stream(spark, d):
    """Every event delivered twice, landed once."""
    root = run_folder(spark, "dedupe")
    e = event_stream(spark, d).select("event_id", "event_type", "event_ts")
    twice = e.unionByName(event_stream(spark, d).select("event_id", "event_type", "event_ts"))
    land(without_redeliveries(twice, "event_id"), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema("event_id long, event_type string, event_ts timestamp").parquet(f"{root}/out").select(
        "event_id", "event_type")


@query("rolling_activity_stream", ROLLING)
def rolling_activity_stream(spark, d):
    """Rolling account activity, landed as the watermark passes the windows.

    One closing row, a copy of an event a year later, moves the watermark past all data.
    """
    root = run_folder(spark, "rolling")
    account = F.col("user_id").cast("string")
    last = table(spark, d, "events").agg(F.max("ts"), F.min("event_id")).first()
    e = event_stream(spark, d).select(account.alias("account_id"), "event_ts", "event_id")
    closing = e.filter(F.col("event_id") == last[1]).withColumn("account_id", F.lit(CLOSING)).withColumn(
        "event_ts", F.lit(last[0]).cast("timestamp") + F.expr("INTERVAL 365 DAYS"))
    out = accounts.rolling_activity(e.unionByName(closing).withWatermark("event_ts", "1 day"))
    land(out, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    rows = spark.read.schema("account_id string, window_start timestamp, window_end timestamp, signals long").parquet(f"{root}/out")
    return rows.filter(F.col("account_id") != CLOSING)


KEYED_CHANGES = f"""
WITH {DELTA},
three AS (
  SELECT 1 AS delivery, signal_id, content_hash, 'new' AS status, 0 AS change_count, 1 AS first_delivery FROM old
  UNION ALL SELECT 2, new.signal_id, new.content_hash, st.status, CASE st.status WHEN 'changed' THEN 1 ELSE 0 END, CASE st.status WHEN 'new' THEN 2 ELSE 1 END
    FROM new JOIN st USING (signal_id)
  UNION ALL SELECT 3, old.signal_id, old.content_hash, CASE WHEN st.status = 'changed' THEN 'changed' ELSE 'unchanged' END,
    CASE WHEN st.status = 'changed' THEN 2 ELSE 0 END, 1 FROM old LEFT JOIN st USING (signal_id))
SELECT CAST(delivery AS INTEGER) AS delivery, signal_id, content_hash, status, CAST(change_count AS INTEGER) AS change_count,
  CAST(first_delivery AS INTEGER) AS first_delivery FROM three"""


@query("keyed_changes_stream", KEYED_CHANGES)
def keyed_changes_stream(spark, d):
    """Three deliveries, the third a repetition of the first, through keyed stream state.

    What the second changed and the third changes back is reported both times.
    """
    root = run_folder(spark, "keyed")
    times = [F.col("ts") < F.lit(FIRST_END), F.col("ts") >= F.lit(SECOND_START), F.col("ts") < F.lit(FIRST_END)]
    events = table(spark, d, "events")
    signals = ["signal_id", "source", "external_id", "event_date", "notice_id", "content_hash"]
    schema = as_signals(events).select(*signals).schema
    for n, part in enumerate(times, 1):
        as_signals(events.filter(part)).select(*signals).write.parquet(f"{root}/landed/delivery-{n}")
        stream = spark.readStream.schema(schema).parquet(f"{root}/landed/delivery-*")
        emit_changes(stream, f"{root}/out", f"{root}/checkpoint", RUN_AT + dt.timedelta(days=n)).awaitTermination()
    told = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in schema)}, seen_at timestamp, status string, first_seen_at timestamp, change_count int"
    number = lambda c: F.datediff(F.col(c), F.lit(RUN_AT)).cast("int")
    return spark.read.schema(told).parquet(f"{root}/out").select(
        number("seen_at").alias("delivery"), "signal_id", "content_hash", "status", "change_count", number("first_seen_at").alias("first_delivery"))


def two_bucketed_runs(spark, d):
    """Both deliveries through the bucketed state; the state and the number of the second run."""
    state = BucketedState(spark, f"{run_folder(spark, 'bucketed')}/state", buckets=8, prefix=1)
    events = table(spark, d, "events")
    for part in (F.col("ts") < F.lit(FIRST_END), F.col("ts") >= F.lit(SECOND_START)):
        run = state.run(as_signals(events.filter(part)), RUN_AT)
    return state, run


@query("bucketed_delta", f"WITH {DELTA} SELECT signal_id, source, external_id, content_hash, status FROM st")
def bucketed_delta(spark, d):
    """Statuses of the second delivery against a bucketed state."""
    state, run = two_bucketed_runs(spark, d)
    return state.delta(run).select("signal_id", "source", "external_id", "content_hash", "status")


@query("bucketed_state", ORACLES["weekly_state"])
def bucketed_state(spark, d):
    """The folded state after both deliveries."""
    state, _ = two_bucketed_runs(spark, d)
    state.fold()
    return state.known().select("signal_id", "content_hash", "first_seen_run", "last_seen_run", "change_count")


@query("late_rows_stream", ORACLES["late_rows"])
def late_rows_stream(spark, d):
    """Every event as a signal of its own through the stream with a late bucket; where each row went."""
    root = run_folder(spark, "late")
    state, name = SignalState(spark, f"{root}/state"), f"{root}/checkpoint"
    log = run_log(spark, d).withColumns({c: F.date_add(F.to_date(c), SHIFT).cast("timestamp") for c in ("started_at", "finished_at")})
    named = F.when(F.col("source") == "1-URGENT", F.lit("click")).when(F.col("source") == "2-HIGH", F.lit("view")).otherwise(F.col("source"))
    earlier = spark.createDataFrame([], RUN_LOG).unionByName(log.withColumn("source", named), allowMissingColumns=True)
    earlier.write.parquet(f"{state.root}/runs")  # the runs before this one ...
    spark.createDataFrame([], STATUS).write.parquet(f"{state.root}/touched/run=0")  # ... which left no signals
    signals = as_signals(event_stream(spark, d)).withColumn("external_id", F.col("notice_id")).withColumn(
        "signal_id", ops.signal_id(F.col("source"), F.col("external_id")))
    stream_with_late_bucket(signals, state, name, RUN_AT, default=dt.date(2024, 1, 16)).awaitTermination()
    parts = [(late_bucket(spark, state, name, signals), True), (state.delta(state.last_version()), False)]
    late, kept = (rows.select(F.col("notice_id").cast("long").alias("event_id"), "source", F.lit(is_late).alias("late")) for rows, is_late in parts)
    return late.unionByName(kept)
