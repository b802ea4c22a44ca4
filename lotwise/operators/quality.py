"""Gaps and reconciliations reported as tables instead of being hidden."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lotwise import rules
from lotwise.functions.scoring import lookup
from lotwise.functions.text import (
    FIRM_PATTERN, ROLE_PATTERN, file_numbers, mention_windows,
)
from lotwise.functions.verdicts import source_verdict
from lotwise.operators.parties import _or_empty


def expected_months(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(
        F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 month"))).alias("month"))


def missing_months(dated: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Expected months without a single row in ``dated`` (column ``month``)."""
    return expected_months(dated.sparkSession, first, last).join(
        dated.select("month").distinct(), "month", "left_anti")


def reconcile_counts(expected: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    """Announced against loaded rows per key, both directions."""
    got = loaded.groupBy(key).agg(F.count(F.lit(1)).alias("loaded"))
    return (expected.join(got, key, "full")
            .select(key, F.coalesce("expected", F.lit(0)).cast("long").alias("expected"),
                    F.coalesce("loaded", F.lit(0)).alias("loaded"))
            .withColumn("missing", F.col("expected") - F.col("loaded"))
            .withColumn("complete", F.col("missing") <= 0))


def deadline_coverage(deadlines: DataFrame) -> DataFrame:
    """Lookup results with and without a deadline; warns above one half without."""
    t = deadlines.agg(F.count(F.lit(1)).alias("total"), F.count("deadline").alias("with_deadline"))
    rate = (F.col("total") - F.col("with_deadline")) / F.nullif("total", F.lit(0))
    return (t.withColumn("without_deadline", F.col("total") - F.col("with_deadline"))
            .withColumn("error_rate", F.bround(rate, 3)).withColumn("warn", rate > 0.5))


def seeded_sample(df: DataFrame, key: Column, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows chosen by a hash of their key and a seed: the same rows on every run and engine."""
    return df.withColumn("_h", F.sha2(F.concat_ws("|", key.cast("string"), F.lit(str(seed))), 256)) \
        .orderBy("_h").limit(n).drop("_h")


def head_sample(df: DataFrame, key: list[str], n: int) -> DataFrame:
    return df.orderBy(*key).limit(n)


def sample_bucket(notices: DataFrame, as_of: dt.date) -> DataFrame:
    """The rarest trait of a nested notice decides its stratum."""
    today = F.lit(as_of).cast("date")
    suppliers = F.filter(F.flatten(F.transform(_or_empty(F.col("awards")), lambda a: _or_empty(a["suppliers"]))),
                         lambda s: F.coalesce(s["name"], F.lit("")) != "")
    bidders = F.filter(_or_empty(F.col("tender.tenderers")), lambda t: F.coalesce(t["name"], F.lit("")) != "")
    expiring = F.exists(_or_empty(F.col("tender.lots")), lambda lot: F.coalesce(F.datediff(
        F.try_to_date(F.substring(lot["contractPeriod"]["endDate"], 1, 10), "yyyy-MM-dd"), today)
        .between(*rules.EXPIRY_WINDOW), F.lit(False)))
    names = F.lower(F.array_join(F.concat(F.transform(suppliers, lambda s: s["name"]),
                                          F.transform(bidders, lambda t: t["name"])), " "))
    joint = names.contains("bietergemeinschaft") | names.contains(" arge ") | names.contains("konsortium")
    return notices.withColumn("bucket", bucket_label(expiring, joint, F.size(suppliers), F.size(bidders)))


def bucket_label(expiring: Column, joint: Column, suppliers: Column, bidders: Column) -> Column:
    return (F.when(expiring, F.lit("rahmenvertrag_ablauf")).when(joint, F.lit("konsortium"))
            .when(suppliers > 0, F.lit("zuschlag_mit_gewinner")).when(bidders == 1, F.lit("alleinbieter"))
            .when(bidders > 1, F.lit("mehrbieter")).otherwise(F.lit("rest")))


def stratified_sample(bucketed: DataFrame, targets: dict[str, int] = rules.STRATA) -> DataFrame:
    """The newest rows of every stratum up to its target.

    Every task keeps at most the target per stratum before the shuffle, so a stratum
    holding most of the corpus is no heavier than the others.
    """
    w = Window.partitionBy("bucket").orderBy(F.desc_nulls_last("d"), "notice_id")
    return (bucketed.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= max(targets.values()))
            .filter(F.col("rank") <= lookup(F.col("bucket"), targets, 0)))


def truncation_report(name: str, rows: DataFrame, kept: DataFrame) -> DataFrame:
    """One line next to a sink: rows seen, rows written, rows cut."""
    n, k = (x.agg(F.count(F.lit(1)).alias("n")) for x in (rows, kept))
    return n.select(F.lit(name).alias("sink"), F.col("n").alias("seen"), k.scalar().alias("written")).withColumn(
        "cut", F.col("seen") - F.col("written"))


def name_quota(documents: DataFrame, text: str = "text", roles: str = ROLE_PATTERN,
               firms: str = FIRM_PATTERN) -> DataFrame:
    """Per document: role mentions, mentions with a firm name nearby, their share, the same per
    role (``roles``), distinct file numbers.  Mentions stay inside the row; nothing is exploded
    or shuffled, and a role is one of the few words of the pattern."""
    seen = F.transform(mention_windows(F.col(text), roles), lambda w: F.struct(
        F.lower(w["word"]).alias("role"), w["window"].rlike(firms).alias("near")))

    def of(role: Column) -> Column:
        own = F.filter(F.col("_w"), lambda w: w["role"] == role)
        return F.struct(role.alias("role"), F.size(own).cast("long").alias("mentions"),
                        F.size(F.filter(own, lambda w: w["near"])).cast("long").alias("with_firm"))

    return (
        documents.withColumn("_w", seen)
        .withColumn("mentions", F.size("_w").cast("long"))
        .withColumn("with_firm", F.size(F.filter("_w", lambda w: w["near"])).cast("long"))
        .withColumn("roles", F.transform(F.array_sort(F.array_distinct(F.transform("_w", lambda w: w["role"]))), of))
        .withColumn("quota", F.when(F.col("mentions") > 0, F.bround(F.col("with_firm") / F.col("mentions"), 3))
                    .otherwise(F.lit(0.0)))
        .withColumn("file_numbers", F.size(file_numbers(F.col(text))).cast("long"))
        .drop("_w"))


def name_quota_by(quotas: DataFrame, key: str) -> DataFrame:
    """Summed quota per source."""
    t = quotas.groupBy(key).agg(*[F.sum(c).alias(c) for c in ("mentions", "with_firm", "file_numbers")],
                                F.count(F.lit(1)).alias("documents"))
    return t.withColumn("quota", F.when(F.col("mentions") > 0, F.bround(F.col("with_firm") / F.col("mentions"), 3)))


def source_audit(probes: DataFrame, links: DataFrame, quotas: DataFrame) -> DataFrame:
    """Usability verdict per source from its probe, its decision links and its name quota.

    ``probes``: source, status, bytes; ``links``: source, link; ``quotas``: as ``name_quota_by``.
    """
    n_links = links.groupBy("source").agg(F.countDistinct("link").alias("links"))
    rows = probes.join(n_links, "source", "left").join(
        quotas.select("source", "quota", F.col("documents").alias("checked")), "source", "left")
    rows = rows.withColumn("links", F.coalesce("links", F.lit(0))).withColumn(
        "checked", F.coalesce("checked", F.lit(0)))
    return rows.withColumn("urteil", source_verdict(
        F.col("status"), F.col("links"), F.col("checked"), F.col("quota")))


def audit_pass_rate(verdicts: DataFrame) -> DataFrame:
    """Share of checkable links that are fine, and whether it passes the gate."""
    t = verdicts.agg(F.count(F.lit(1)).alias("sampled"), F.count_if(F.col("verdict") == "ok").alias("ok"),
                     F.count_if(F.col("verdict") == "unverifiable").alias("unverifiable"))
    rate = F.col("ok") / F.nullif(F.col("sampled") - F.col("unverifiable"), F.lit(0))
    return (t.withColumn("checkable", F.col("sampled") - F.col("unverifiable"))
            .withColumn("rate", F.coalesce(F.bround(rate, 4), F.lit(0.0)))
            .withColumn("passed", F.coalesce(rate >= rules.AUDIT_GATE, F.lit(False))))


def volume_by_normal_name(rows: DataFrame, name: Column) -> DataFrame:
    """Volume per normalised body name: spelling variants count once."""
    return rows.groupBy(name.alias("body")).agg(F.count(F.lit(1)).alias("volume"))


def open_tender_bidders(open_tenders: DataFrame, past_bids: DataFrame) -> DataFrame:
    """Past bidders that have a reason to look at an open tender: same buyer, same code prefix.

    Open tenders are reduced to the next one (and their number) per buyer and prefix, past
    bids to one row per company, so the join is many-to-one and never multiplies a group.
    """
    upcoming = open_tenders.groupBy("buyer", "code_prefix").agg(
        F.count(F.lit(1)).alias("open_tenders"),
        F.min(F.struct("deadline", "notice_id")).alias("next"))
    past = past_bids.groupBy("buyer", "code_prefix", "company_id").agg(
        F.count(F.lit(1)).alias("past_bids"), F.max("d").alias("last_bid"))
    return past.join(upcoming, ["buyer", "code_prefix"]).select(
        "company_id", "buyer", "code_prefix", "past_bids", "last_bid", "open_tenders",
        F.col("next.notice_id").alias("next_notice"), F.col("next.deadline").alias("next_deadline"))
