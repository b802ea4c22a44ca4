"""Job ads, tolerant to the two spellings that coexist in one feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lotwise import rules
from lotwise.functions.dates import iso_date
from lotwise.functions.text import blank_to_null, job_title_rule, strip
from lotwise.operators.signals import latest_per_key
from lotwise.schemas import JOB, SIGNAL_COLUMNS


def pick(*names: str) -> Column:
    """First non-blank of several spellings of a field."""
    return F.coalesce(*[blank_to_null(F.col(n)) for n in names])


def read_jobs(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    return spark.read.schema(JOB).option("multiLine", not lines).json(path)


def job_ads(raw: DataFrame) -> DataFrame:
    """One normalised row per reference number."""
    place = F.coalesce(F.get("stellenlokationen", F.lit(0))["adresse"], F.col("arbeitsort"))
    ads = raw.select(
        pick("referenznummer", "refnr").alias("ref"), pick("stellenangebotsTitel", "titel").alias("title"),
        pick("hauptberuf", "beruf").alias("beruf"), pick("firma", "arbeitgeber").alias("employer"),
        place["ort"].alias("ort"), place["plz"].alias("plz"), place["region"].alias("region"),
        iso_date(pick("datumErsteVeroeffentlichung", "aktuelleVeroeffentlichungsdatum",
                      "veroeffentlichungszeitraum.von")).alias("d"),
        "vertragsdauer", "homeofficemoeglich").filter("ref IS NOT NULL")
    return latest_per_key(ads, ["ref"], [F.desc_nulls_last("d"), "title", "employer"])


def job_signals(ads: DataFrame) -> DataFrame:
    """Signals of ads on the bidding side with a named employer."""
    rule = job_title_rule(F.coalesce("title", F.lit("")), F.col("beruf"))
    fit = ads.withColumn("rule", rule).filter(
        F.col("rule").startswith("include:") & (F.coalesce(strip(F.col("employer")), F.lit("")) != ""))
    payload = F.to_json(F.struct(
        F.col("beruf").alias("hauptberuf"), F.col("homeofficemoeglich").alias("homeoffice"), "plz", "region",
        F.col("rule").alias("title_match"), "vertragsdauer"))
    none_s = F.lit(None).cast("string")
    return fit.select(
        F.lit(rules.JOB_SOURCE).alias("source"), F.col("ref").alias("external_id"),
        F.lit("bid_rolle_ausgeschrieben").alias("signal_type"), F.col("d").alias("event_date"),
        F.col("employer").alias("org_name_raw"), F.col("ort").alias("org_place"),
        F.concat(F.lit(rules.JOB_URL), "ref").alias("source_url"), "title", F.col("ref").alias("notice_id"),
        none_s.alias("buyer"), F.lit(None).cast("date").alias("contract_end"),
        F.lit(None).cast("date").alias("deadline"), F.lit(None).cast("double").alias("value"),
        none_s.alias("supplier_id"), F.lit(False).alias("is_buyer_side"),
        F.array().cast("array<string>").alias("cpv"), payload.alias("payload")).select(*SIGNAL_COLUMNS)
