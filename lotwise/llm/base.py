"""Small helpers shared by the operators: tables, words and the registry of their queries."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.session import landed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Java patterns of one word: no white space; or letters, digits and everything beyond ASCII.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
NOT_A_LETTER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def sheltered(rows: DataFrame) -> tuple[DataFrame, dict[str, str], list[Column]]:
    """The rows under names no operator works with, the new name of every column, and the columns that give the old names back."""
    inner = {c: f"__own_{i}" for i, c in enumerate(rows.columns)}
    return rows.toDF(*inner.values()), inner, [F.col(new).alias(old) for old, new in inner.items()]


@contextmanager
def small_batches(spark, rows: int = 500):
    """Texts of a few megabytes at a time go to Python in the jobs run inside; the setting is put back after."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of the links ``a``, ``b`` (longs, a != b): one row (node, root) per linked node.

    Alternating large and small stars: every round points nodes at smaller neighbours, so
    the number of rounds grows with the logarithm of the longest chain.  Each round is two
    aggregates with joins on the node, written to the shared folder.  No edges give no rows.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        if large:
            out = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = (both.where("b < a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                   .unionByName(low.where("m < a").select("a", F.col("m").alias("b"))))
        return out.where("a != b").distinct()

    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = landed(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = mark(now)
    for _ in range(rounds):
        now = landed(star(star(now, True), False), "links")
        after = mark(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return (now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")))).distinct()
