"""Enrichment exports under whatever column names they come with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise import rules
from lotwise.functions.hosts import clean_domain
from lotwise.functions.text import blank_to_null
from lotwise.functions.verdicts import to_int


def _plain(name: str) -> str:
    return name.strip().lstrip("﻿").lower().replace(" ", "_").replace("-", "_")


def rename_aliases(df: DataFrame) -> DataFrame:
    """Known fields by their aliases, first filled alias first; unknown columns are dropped."""
    by_name = {_plain(c): c for c in df.columns}
    out = []
    for field, aliases in rules.FIELD_ALIASES.items():
        found = [blank_to_null(F.col(f"`{by_name[a]}`").cast("string")) for a in aliases if a in by_name]
        out.append((F.coalesce(*found) if found else F.lit(None).cast("string")).alias(field))
    return df.select(*out, *[c for c in ("row_no",) if c in df.columns])


def read_enrichment(spark: SparkSession, path: str) -> DataFrame:
    """CSV or JSON records with cleaned domain, integer head count and a row order.

    ``row_no`` orders by file name, place in the file and row, so that "the later row wins"
    means the same however the files are split over tasks.
    """
    place = [F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    if path.lower().endswith((".json", ".jsonl")):
        raw = spark.read.option("multiLine", path.lower().endswith(".json")).json(path).select("*", *place)
        if raw.columns == ["records", "_file", "_block"]:
            raw = raw.select(F.explode("records").alias("r"), "_file", "_block").select("r.*", "_file", "_block")
    else:
        raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).select("*", *place)
    ordered = raw.withColumn("row_no", F.struct("_file", "_block", F.monotonically_increasing_id().alias("row"))).drop("_file", "_block")
    fields = rename_aliases(ordered)
    return fields.withColumn("domain", clean_domain(F.col("domain"))).withColumn(
        "employees", to_int(F.col("employees")))
