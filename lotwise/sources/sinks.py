"""Result files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F


def _flat(df: DataFrame, yes_no: bool) -> list[Column]:
    """CSV cells: lists joined, booleans as ja/nein, missing as empty text."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "boolean" and yes_no:
            c = F.when(c, F.lit("ja")).when(~c, F.lit("nein"))
        elif kind.startswith("array<"):
            c = F.array_join(c.cast("array<string>"), ";")
        elif kind.startswith(("struct", "map")):
            c = F.to_json(c)
        out.append(F.coalesce(c.cast("string"), F.lit("")).alias(name))
    return out


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, yes_no: bool = True) -> None:
    """Header, every field quoted, fixed column order.  One file per task; the order of a
    sorted frame is the order of the file names."""
    rows = df.select(*columns) if columns else df
    (rows.select(*_flat(rows, yes_no)).write.mode("overwrite")
     .option("header", True).option("quoteAll", True).option("escape", '"').csv(path))


def write_buckets(df: DataFrame, path: str, bucket: str = "bucket") -> None:
    """One folder per bucket; nothing is dropped on the way."""
    df.write.mode("overwrite").partitionBy(bucket).parquet(path)


def write_top(df: DataFrame, path: str, order: list[Column], n: int, name: str) -> DataFrame:
    """The first n (1 or more) rows in order, and beside them a record of how many there were.

    The rows are counted on their way into the top-n step, so nothing is read twice and no cut goes unsaid.
    For rows read from files; of a frame whose size Spark knows beforehand (a range) it may sort twice.
    """
    if n < 1:  # an empty export would never read the rows it has to count
        raise ValueError("an export holds one row at least")
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("total")).orderBy(*order).limit(n).write.mode("overwrite").parquet(f"{path}/rows")
    kept = df.sparkSession.read.parquet(f"{path}/rows").count()
    total = seen.get["total"] if kept == n else kept
    record = df.sparkSession.createDataFrame([(name, total, kept, total - kept)], "name string, total long, kept long, truncated long")
    record.coalesce(1).write.mode("overwrite").parquet(f"{path}/truncation")
    return record
