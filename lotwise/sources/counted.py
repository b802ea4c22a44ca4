"""Counts of a run taken while its rows are written."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from lotwise.operators.delta import CHANGED, NEW, UNCHANGED

STATUSES = (NEW, CHANGED, UNCHANGED)


class RunCounts:
    """Rows by named source and status, observed on the way to the sink; no second pass reads them."""

    def __init__(self, sources: list[str]):
        self.sources, self.seen = list(dict.fromkeys(sources)), Observation()

    def watch(self, rows: DataFrame) -> DataFrame:
        """rows (source, status, ...), unchanged; write them once."""
        if not self.sources:
            return rows
        each = [F.count_if((F.col("source") == s) & (F.col("status") == k)).alias(f"{i}_{k}") for i, s in enumerate(self.sources) for k in STATUSES]
        return rows.observe(self.seen, F.count(F.lit(1)).alias("total"), *each)

    def statistics(self, spark: SparkSession) -> DataFrame | None:
        """A line per source, zeros included; None if rows of a source that wasn't named came by."""
        if not self.sources:
            return None
        got = self.seen.get
        lines = [(s, *(got[f"{i}_{k}"] for k in STATUSES)) for i, s in enumerate(self.sources)]
        if sum(sum(line[1:]) for line in lines) != got["total"]:
            return None
        return spark.createDataFrame([(s, sum(n), *n) for s, *n in lines], "source string, rows_in long, " + ", ".join(f"rows_{k} long" for k in STATUSES))
