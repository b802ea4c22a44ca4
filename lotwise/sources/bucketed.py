"""Signal state in a bucketed table: a run meets the buckets its own signals fall into, where they lie.

The table is partitioned by the run's attempt and by the first characters of the signal id, and bucketed by the
whole id.  A run reads only the partitions its signals fall into, and the join needs no exchange on the
state's side: the incoming rows are dealt into the table's buckets instead.  Attempts count once
their line stands in the commit log, so a run that died half way leaves the state as it was.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise.operators import delta
from lotwise.session import landed

KNOWN = "signal_id string, content_hash string, first_seen_run long, first_seen_at timestamp, last_seen_run long, change_count int"
COMMITS = "run long, attempt string, base boolean"
COLUMNS = [c.split(" ")[0] for c in KNOWN.split(", ")]


class BucketedState:
    """State under ``root`` (a folder all executors reach)."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 32, prefix: int = 2, fold_every: int = 12):
        self.spark, self.root, self.buckets, self.prefix, self.fold_every = spark, root.rstrip("/"), buckets, prefix, fold_every
        self.name = f"lotwise_state_{hashlib.sha256(self.root.encode()).hexdigest()[:16]}"
        spark.sql(f"""CREATE TABLE IF NOT EXISTS {self.name} ({KNOWN}, attempt string, prefix string) USING parquet
            PARTITIONED BY (attempt, prefix) CLUSTERED BY (signal_id) SORTED BY (signal_id) INTO {buckets} BUCKETS LOCATION '{self.root}/known'""")

    def commits(self) -> list[tuple[int, str]]:
        """(run, attempt) since the last folding; at most ``fold_every`` and a base."""
        try:
            log = self.spark.read.schema(COMMITS).parquet(f"{self.root}/commits")
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        base = log.filter("base").agg(F.max("run")).first()[0] or 0
        kept = log.filter((F.col("run") > base) | (F.col("base") & (F.col("run") == base)))
        return sorted((r.run, r.attempt) for r in kept.collect())

    def known(self, prefixes: list[str] | None = None) -> DataFrame:
        """The latest version of every signal; of the given prefixes only."""
        rows = self.spark.table(self.name).filter(F.col("attempt").isin([a for _, a in self.commits()]))
        if prefixes is not None:
            rows = rows.filter(F.col("prefix").isin(prefixes))
        narrow = F.struct(*[c for c in COLUMNS if c not in ("signal_id", "last_seen_run")])
        latest = rows.groupBy("signal_id").agg(F.max_by(narrow, "last_seen_run").alias("k"), F.max("last_seen_run").alias("last_seen_run"))
        return latest.select("signal_id", "k.*", "last_seen_run")

    def with_status(self, incoming: DataFrame, run: int, at: dt.datetime) -> DataFrame:
        """The incoming rows, one per signal, with bookkeeping and ``status``."""
        first = F.substring("signal_id", 1, self.prefix)
        touched = [r.p for r in incoming.select(first.alias("p")).distinct().collect()]  # at most 16 ** prefix
        return delta.apply_run(incoming.repartition(self.buckets, "signal_id"), self.known(touched), run, at)

    def run(self, incoming: DataFrame, at: dt.datetime) -> int:
        """Apply identified signals as one run and commit it; its number."""
        run = max((r for r, _ in self.commits()), default=0) + 1
        attempt = f"{run}-{uuid.uuid4().hex}"
        applied = self.with_status(landed(incoming, "incoming"), run, at)
        applied.write.mode("overwrite").parquet(f"{self.root}/touched/run={run}")
        self._put(self.spark.read.schema(applied.schema).parquet(f"{self.root}/touched/run={run}"), attempt)
        self._commit(run, attempt, False)
        if len(self.commits()) > self.fold_every:
            self.fold()
        return run

    def delta(self, run: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/touched/run={run}")

    def fold(self) -> None:
        """Write the current state as one attempt that stands for all before it."""
        run = max(r for r, _ in self.commits())
        attempt = f"base-{run}-{uuid.uuid4().hex}"
        self._put(self.known(), attempt)
        self._commit(run, attempt, True)

    def _put(self, rows: DataFrame, attempt: str) -> None:
        """Append rows to the table under a new attempt, each bucket's rows dealt to one task."""
        (rows.repartition(self.buckets, "signal_id").select(*COLUMNS, F.lit(attempt).alias("attempt"), F.substring("signal_id", 1, self.prefix).alias("prefix"))
         .write.insertInto(self.name))
        self.spark.catalog.refreshTable(self.name)

    def _commit(self, run: int, attempt: str, base: bool) -> None:
        self.spark.createDataFrame([(run, attempt, base)], COMMITS).coalesce(1).write.mode("append").parquet(f"{self.root}/commits")
