"""Keyed change detection between runs, run statistics and the fetch watermark."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from lotwise import rules
from lotwise.operators.signals import latest_per_key

NEW, CHANGED, UNCHANGED = "new", "changed", "unchanged"


def classify_changes(incoming: DataFrame, state: DataFrame, key: str = "signal_id",
                     content: str = "content_hash") -> DataFrame:
    """``status`` per incoming row against the stored content of the same key.

    ``incoming`` holds one row per key.  Keys are hashes, so the join is even whatever
    the sources look like; only key and content of the state are read.
    """
    known = state.select(key, F.col(content).alias("_known"))
    return incoming.join(known, key, "left").withColumn(
        "status", F.when(F.col("_known").isNull(), F.lit(NEW))
        .when(F.col("_known") != F.col(content), F.lit(CHANGED))
        .otherwise(F.lit(UNCHANGED))).drop("_known")


BOOKKEEPING = ["first_seen_run", "first_seen_at", "last_seen_run", "last_seen_at", "change_count"]


def apply_run(incoming: DataFrame, known: DataFrame, run_id: int, at: dt.datetime) -> DataFrame:
    """The rows one run touches, ready for the state, each with its ``status``.

    ``known`` holds one row per stored key: signal_id, content_hash, first_seen_run,
    first_seen_at, change_count.  The state is only read in these narrow columns and never
    rewritten; what the run does not mention stays where it is.
    """
    first = latest_per_key(incoming, ["signal_id"],
                           [F.desc_nulls_last("event_date"), F.desc_nulls_last("notice_id"), F.desc("content_hash")])
    before = known.select("signal_id", F.struct("content_hash", "first_seen_run", "first_seen_at", "change_count").alias("o"))
    new, changed = F.col("o").isNull(), F.col("o.content_hash") != F.col("content_hash")
    run, now = F.lit(run_id).cast("long"), F.lit(at).cast("timestamp")
    return first.join(before, "signal_id", "left").select(
        *first.columns,
        F.coalesce("o.first_seen_run", run).alias("first_seen_run"),
        F.coalesce("o.first_seen_at", now).alias("first_seen_at"),
        run.alias("last_seen_run"), now.alias("last_seen_at"),
        (F.coalesce("o.change_count", F.lit(0)) + F.when(changed, 1).otherwise(0)).cast("int").alias("change_count"),
        F.when(new, F.lit(NEW)).when(changed, F.lit(CHANGED)).otherwise(F.lit(UNCHANGED)).alias("status"))


def emitted(applied: DataFrame) -> DataFrame:
    """What a run puts out: new and changed rows only, newest first."""
    return applied.filter(F.col("status").isin(NEW, CHANGED)).orderBy(
        F.desc_nulls_last("event_date"), "signal_id")


def tag_late(signals: DataFrame, since: DataFrame, default: dt.date, always: Column | None = None) -> DataFrame:
    """``late`` marks rows older than the day their source is read from.

    Rows inside the overlap are ordinary corrections; older ones go to a bucket of their
    own instead of being dropped.  ``since``: source, since - one row per source, so it is
    broadcast.  ``always`` marks rows that are due by another date than their own, such as
    open tenders; they are never late.
    """
    days = F.broadcast(since.select("source", F.col("since").alias("_since")))
    late = F.coalesce(F.col("event_date") < F.coalesce("_since", F.lit(default).cast("date")), F.lit(False))
    if always is not None:
        late = late & ~F.coalesce(always, F.lit(False))
    return signals.join(days, "source", "left").withColumn("late", late).drop("_since")


def run_statistics(statuses: DataFrame) -> DataFrame:
    """Rows read, new, changed and unchanged per source, plus one row for all (source null)."""
    return statuses.rollup("source").agg(
        F.count(F.lit(1)).alias("rows_in"),
        *[F.count_if(F.col("status") == s).alias(f"rows_{s}") for s in (NEW, CHANGED, UNCHANGED)])


def with_quiet_sources(statistics: DataFrame, sources: list[str]) -> DataFrame:
    """The statistics with a line of zeros for every source asked that gave no rows."""
    asked = statistics.sparkSession.createDataFrame([(s,) for s in sources], "source string")
    counts = [c for c in statistics.columns if c != "source"]
    return asked.join(statistics, "source", "full").select("source", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])


def type_coverage(signals: DataFrame) -> DataFrame:
    """Rows per configured signal type, silent types included."""
    spark = signals.sparkSession
    types = spark.createDataFrame(list(rules.SIGNAL_WEIGHTS.items()), "signal_type string, weight int")
    seen = signals.groupBy("signal_type").agg(F.count(F.lit(1)).alias("n"))
    return (types.join(seen, "signal_type", "left")
            .select("signal_type", "weight", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
            .withColumn("silent", F.col("n") == 0)
            .orderBy(F.desc("weight"), "signal_type"))


def fetch_since(runs: DataFrame, as_of: dt.date) -> DataFrame:
    """Per source, the day to read from: last run without errors minus the overlap."""
    ok = runs.filter("finished_at IS NOT NULL AND errors IS NULL")
    return ok.groupBy("source").agg(
        F.date_sub(F.to_date(F.max_by("started_at", "run_id")), rules.OVERLAP_DAYS).alias("since"))


def first_fetch_day(as_of: dt.date) -> dt.date:
    return as_of - dt.timedelta(days=rules.ACTIVE_DAYS)


def last_runs(runs: DataFrame, n: int = 20) -> DataFrame:
    return runs.orderBy(F.desc("run_id")).limit(n)
