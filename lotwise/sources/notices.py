"""Release documents as landed: packages, single releases and lists, by publication month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lotwise.schemas import RELEASE, RELEASE_FIELDS
from lotwise.session import landed

DOCUMENT = f"array<struct<releases:array<struct<{RELEASE_FIELDS}>>,{RELEASE_FIELDS}>>"
COLUMNS = ["id", "ocid", "date", "tag", "buyer", "tender", "awards", "parties"]


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per JSON document; partition folders (``pub_month=2026-03``) become columns."""
    docs = spark.read.text(path, wholetext=True)
    return docs.withColumn("doc", F.from_json("value", DOCUMENT)).withColumn("path", F.col("_metadata.file_path"))


def releases_of_documents(docs: DataFrame) -> DataFrame:
    """Releases of readable documents.  An object counts as a list of one, a package is
    replaced by its content."""
    keep = [c for c in docs.columns if c not in ("value", "doc", "path")]
    items = docs.select(*keep, F.explode("doc").alias("x"))
    own = F.array(F.struct(*[F.col(f"x.{c}").alias(c) for c in COLUMNS]))
    return items.select(*keep, F.explode(F.coalesce("x.releases", own)).alias("r")).select(*keep, "r.*")


def rejected_documents(docs: DataFrame) -> DataFrame:
    """Documents that are not JSON, kept for inspection instead of being skipped."""
    return docs.filter(F.col("doc").isNull()).select("path", "value")


def read_checked(spark: SparkSession, path: str, months: list[str] | None = None, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """Releases under ``path`` and what could not be read (path, value).

    Input is parsed once and landed; the text is kept of unreadable documents or lines only.
    """
    if lines:
        schema = _struct(RELEASE).add("_broken", "string")
        docs = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_broken").json(path).withColumn("path", F.col("_metadata.file_path"))
    else:
        docs = read_documents(spark, path)
        docs = docs.withColumn("value", F.when(F.col("doc").isNull(), F.col("value")))
    if months is not None:
        docs = docs.filter(F.col("pub_month").isin(months))
    parsed = landed(docs, "documents")
    if lines:
        return (parsed.filter("_broken IS NULL").drop("_broken", "path"),
                parsed.filter("_broken IS NOT NULL").select("path", F.col("_broken").alias("value")))
    return releases_of_documents(parsed), rejected_documents(parsed)


def compact(spark: SparkSession, path: str, out: str, rejects: str) -> int:
    """Turn packages into one release per line, by publication month where the input has months.

    A package is one string and one task however large it is; lines split over tasks, so
    this is done once per landed package and the jobs read the lines.  Returns the number
    of unreadable documents, which are written to ``rejects``.
    """
    releases, broken = read_checked(spark, path)
    writer = releases.write.mode("append")
    (writer.partitionBy("pub_month") if "pub_month" in releases.columns else writer).json(out)
    n = broken.count()
    if n:
        broken.write.mode("append").parquet(rejects)
    return n


def _struct(ddl: str) -> StructType:
    return StructType.fromDDL("r " + ddl)["r"].dataType


def read_releases(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Releases under ``path``; ``lines=True`` for one release per line (the compacted form,
    which splits large files over tasks)."""
    if lines:
        return spark.read.schema(_struct(RELEASE)).json(path)
    return releases_of_documents(read_documents(spark, path))


def read_months(spark: SparkSession, root: str, months: list[str], lines: bool = False) -> DataFrame:
    """Only the wanted month folders are listed and read."""
    return read_releases(spark, root, lines).filter(F.col("pub_month").isin(months))


def month_coverage(releases: DataFrame, months: list[str]) -> DataFrame:
    """Releases per expected month, missing months included with zero."""
    spark = releases.sparkSession
    expected = spark.createDataFrame([(m,) for m in months], "pub_month string")
    seen = releases.groupBy("pub_month").agg(F.count(F.lit(1)).alias("releases"))
    return expected.join(seen, "pub_month", "left").select(
        "pub_month", F.coalesce("releases", F.lit(0)).cast("long").alias("releases")).withColumn(
        "missing", F.col("releases") == 0)
