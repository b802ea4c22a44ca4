"""Signal state as an append-only log of touched rows with a commit log.

A run writes the rows it touched into a folder of its own and only then appends its
lines to the run log.  Readers follow the log, so a run that died half way leaves the
state as it was and may simply be repeated.  Older runs are folded into a base now and
then; between two foldings a run costs what it touches, not what the state holds.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise.operators import delta
from lotwise.operators.signals import latest_per_key, review_queue
from lotwise.schemas import RUN_LOG, STATE
from lotwise.sources.counted import RunCounts

STATUS = STATE + ", status string"
STATISTICS = "source string, rows_in long, rows_new long, rows_changed long, rows_unchanged long"
CONTENT = [c for c in (part.strip().split(" ")[0] for part in STATE.split(", ")) if c not in delta.BOOKKEEPING]


class SignalState:
    """State tables under ``root`` (a folder all executors reach)."""

    def __init__(self, spark: SparkSession, root: str, fold_every: int = 12):
        self.spark, self.root, self.fold_every = spark, root.rstrip("/"), fold_every

    def _read(self, schema: str, name: str) -> DataFrame | None:
        """A table of the state, None while nothing has been written to it."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def runs(self) -> DataFrame:
        log = self._read(RUN_LOG, "runs")
        return self.spark.createDataFrame([], RUN_LOG) if log is None else log

    def last_version(self) -> int:
        """Number of the last committed run; one value, whatever the size of the state."""
        ok = self.runs().filter("errors IS NULL AND finished_at IS NOT NULL")
        return ok.agg(F.coalesce(F.max("run_id"), F.lit(0))).first()[0]

    def next_run_id(self) -> int:
        return self.runs().agg(F.coalesce(F.max("run_id"), F.lit(0))).first()[0] + 1

    def base_version(self) -> int:
        """Last run folded into the base."""
        bases = self._read("version long", "bases")
        if bases is None:
            return 0
        return bases.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def _rows(self) -> DataFrame:
        """Every stored version of every key since the last folding."""
        last, base = self.last_version(), self.base_version()
        out = self.spark.createDataFrame([], STATE)
        if base:
            out = self.spark.read.schema(STATE).parquet(f"{self.root}/base/version={base}")
        if last > base:
            runs = self.spark.read.schema(STATUS + ", run long").parquet(f"{self.root}/touched")
            runs = runs.filter(F.col("run").between(base + 1, last)).drop("run", "status")
            out = out.unionByName(runs) if base else runs
        return out

    def known(self) -> DataFrame:
        """Key, content hash and bookkeeping of every stored signal; narrow columns only."""
        narrow = F.struct("content_hash", "first_seen_run", "first_seen_at", "change_count")
        return (self._rows().groupBy("signal_id").agg(F.max_by(narrow, "last_seen_run").alias("k"))
                .select("signal_id", "k.*"))

    def current(self) -> DataFrame:
        """The latest version of every signal."""
        return latest_per_key(self._rows(), ["signal_id"], [F.desc("last_seen_run")])

    def fold(self) -> None:
        """Write the current state as the next base."""
        version = self.last_version()
        self.current().write.mode("overwrite").parquet(f"{self.root}/base/version={version}")
        self.spark.createDataFrame([(version,)], "version long").coalesce(1).write.mode("append").parquet(
            f"{self.root}/bases")

    def delta(self, run_id: int) -> DataFrame:
        return self.spark.read.schema(STATUS).parquet(f"{self.root}/touched/run={run_id}")

    def emitted(self, run_id: int) -> DataFrame:
        return delta.emitted(self.delta(run_id))

    def review(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/review")

    def run_of(self, batch: tuple[str, int]) -> int | None:
        """The run that committed a batch (stream, number), if one has."""
        done = self.runs().filter((F.col("stream") == batch[0]) & (F.col("batch") == batch[1])).agg(F.max("run_id"))
        return done.first()[0]

    def run(self, resolved: DataFrame, at: dt.datetime, batch: tuple[str, int] | None = None,
            sources: list[str] | None = None) -> int:
        """Apply resolved signals with identity columns as one run and commit it; its number.

        Run numbers come from the log.  A ``batch`` (stream, number) that is already in the
        log is left alone, so a repeated one changes nothing; the folders of a run that
        died before its line was written are overwritten.  ``sources`` are those asked:
        each gets a line, zeros included.
        """
        if batch and (done := self.run_of(batch)):
            return done
        run_id = self.next_run_id()
        touched = delta.apply_run(resolved.select(*CONTENT), self.known(), run_id, at)
        counts = RunCounts(sources or [])
        counts.watch(touched).write.mode("overwrite").parquet(f"{self.root}/touched/run={run_id}")
        (review_queue(self.delta(run_id)).withColumn("created_at", F.lit(at).cast("timestamp"))
         .write.mode("overwrite").parquet(f"{self.root}/review/run={run_id}"))
        stats = counts.statistics(self.spark)
        if stats is None:  # rows of sources nobody named
            stats = delta.run_statistics(self.delta(run_id)).filter("source IS NOT NULL")
            if sources:
                stats = delta.with_quiet_sources(stats, sources)
        self._log(run_id, stats, at, None, batch)
        if run_id - self.base_version() >= self.fold_every:
            self.fold()
        return run_id

    def fail(self, source: str, at: dt.datetime, error: str) -> int:
        """Record a failed run; it moves neither the state nor the fetch watermark."""
        run_id = self.next_run_id()
        stats = self.spark.createDataFrame(
            [(source, 0, 0, 0, 0)], STATISTICS)
        self._log(run_id, stats, at, error)
        return run_id

    def _log(self, run_id: int, stats: DataFrame, at: dt.datetime, error: str | None,
             batch: tuple[str, int] | None = None) -> None:
        stream, number = batch or (None, None)
        if stats.isEmpty():  # a run without rows of any source still is one
            stats = self.spark.createDataFrame([(stream, 0, 0, 0, 0)], STATISTICS)
        now = F.lit(at).cast("timestamp")
        stats.select(
            F.lit(run_id).cast("long").alias("run_id"), "source", now.alias("started_at"), now.alias("finished_at"),
            "rows_in", "rows_new", "rows_changed", "rows_unchanged",
            F.lit(error).cast("string").alias("errors"), F.lit(stream).cast("string").alias("stream"),
            F.lit(number).cast("long").alias("batch")).coalesce(1).write.mode("append").parquet(f"{self.root}/runs")
