"""Who bid, who won, and what the notice tells about the rest.

Two entries to the same rule: ``participations_of_notices`` works inside each nested
notice and needs no shuffle, ``bidder_outcomes`` takes flat (notice, company) facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lotwise import rules
from lotwise.functions.codes import tender_codes, verdict
from lotwise.functions.dates import iso_date
from lotwise.functions.text import (
    clean_name, company_key, consortium_members, exclusion_reason, is_consortium, let, strip,
)

WON_ALONE, LOST, OPEN = "alleinbieter_gewonnen", "unterlegen", "offen"


def outcome_of(award_notice: Column, winners: Column, bidders: Column, announced: Column) -> Column:
    """Outcome of a bidder that is not a named winner."""
    sole = award_notice & (winners == 0) & (bidders == 1) & (announced.isNull() | (announced == 1))
    return F.when(sole, F.lit(WON_ALONE)).when(winners > 0, F.lit(LOST)).otherwise(F.lit(OPEN))


def notice_url(notice_id: Column, fmt: str = "pdf") -> Column:
    """Evidence address of one notice; empty when the id is."""
    suffix = f"?format={fmt}" if fmt else ""
    return F.when(F.coalesce(notice_id, F.lit("")) == "", F.lit("")).otherwise(
        F.concat(F.lit(rules.NOTICE_URL), notice_id, F.lit(suffix)))


def _or_empty(c: Column) -> Column:
    return F.coalesce(c, F.array())


def notices_of_releases(releases: DataFrame) -> DataFrame:
    """Releases with their scope verdict; everything else stays nested."""
    main, codes = tender_codes(F.col("tender"))
    # The outer form keeps Spark from computing the verdict a second time for a filter on it.
    return (
        releases.withColumn("verdict", F.explode_outer(F.array(verdict(main, codes))))
        .select(
            F.col("id").alias("notice_id"), F.col("ocid"), iso_date(F.col("date")).alias("d"), "tag",
            F.col("buyer.name").alias("buyer"), F.col("buyer.address.locality").alias("buyer_place"),
            F.col("tender.title").alias("title"), "tender", "awards", "parties",
            F.col("verdict.*"))
        .withColumn("is_award", (F.size(_or_empty(F.col("awards"))) > 0)
                    | F.coalesce(F.array_contains("tag", "award"), F.lit(False)))
    )


def named_members(org: Column) -> Column:
    """Members behind one party entry as struct(name, key, consortium, org fields)."""
    named = let(clean_name(org["name"]), lambda raw: let(is_consortium(raw), lambda joint: F.struct(
        joint.alias("joint"), F.filter(consortium_members(raw, joint), lambda m: strip(m) != "").alias("members"))))
    return let(named, lambda x: F.transform(x["members"], lambda m: F.struct(
        strip(m).alias("legal_name"), company_key(m).alias("company_id"),
        x["joint"].alias("consortium"), org["id"].alias("supplier_id"),
        org["address"]["locality"].alias("city"), org["address"]["region"].alias("region"),
        org["address"]["postalCode"].alias("postal_code"))))


def winner_keys(awards: Column) -> Column:
    """Keys of all named award winners of one notice."""
    suppliers = F.flatten(F.transform(_or_empty(awards), lambda a: _or_empty(a["suppliers"])))
    keys = F.flatten(F.transform(suppliers, lambda s: F.transform(
        consortium_members(clean_name(s["name"])), company_key)))
    return F.array_distinct(F.filter(keys, lambda k: k.isNotNull() & (k != "")))


def participations_of_notices(notices: DataFrame, exclusion_mode: str = "listed") -> DataFrame:
    """One row per company and award or bid row of the notices in scope.

    Award rows come from the named suppliers; bid rows from the named tenderers that are
    not winners of the same notice.  All of it happens inside the row, so the result is
    produced without a shuffle however long a notice's party list is.
    """
    awards = F.transform(_or_empty(F.col("awards")), lambda a: F.struct(
        iso_date(a["date"]).alias("award_d"), a["value"]["amount"].alias("value"),
        F.flatten(F.transform(_or_empty(a["suppliers"]), named_members)).alias("members")))
    # The members already have the keys that ``winner_keys`` would make out of the names again.
    keys = F.flatten(F.transform("awarded", lambda a: F.transform(a["members"], lambda m: m["company_id"])))
    in_scope = notices.filter("is_it").withColumn("awarded", awards).withColumn(
        "won", F.array_distinct(F.filter(keys, lambda k: k != "")))
    award_rows = F.flatten(F.transform("awarded", lambda a: F.transform(a["members"], lambda m: F.struct(
        F.lit("award").alias("role"), F.lit(None).cast("string").alias("outcome"),
        F.coalesce(a["award_d"], F.col("d")).alias("row_d"), a["value"].alias("value"),
        m.alias("m")))))
    named = F.filter(_or_empty(F.col("tender.tenderers")), lambda t: F.coalesce(t["name"], F.lit("")) != "")
    outcome = outcome_of(F.col("is_award"), F.size("won"), F.size(named), F.col("tender.numberOfTenderers"))
    bidders = F.flatten(F.transform(named, named_members))
    bid_rows = F.transform(
        F.filter(bidders, lambda m: ~F.array_contains(F.col("won"), m["company_id"])),
        lambda m: F.struct(
            F.lit("bid").alias("role"), outcome.alias("outcome"), F.col("d").alias("row_d"),
            F.lit(None).cast("double").alias("value"), m.alias("m")))
    kept = ["notice_id", "ocid", "buyer", "mixed_lot", "main_cpv", "all_codes", "it_share",
            F.col("tender.numberOfTenderers").alias("bidder_count")]
    # The outer form keeps Spark from computing the rows a second time for a size filter.
    rows = in_scope.select(*kept, F.concat(award_rows, bid_rows).alias("rows")).select(
        "*", F.posexplode_outer("rows").alias("pos", "row"))
    return (
        rows.select(
            F.col("row.m.company_id"), "notice_id", "ocid", F.col("row.row_d").alias("d"),
            F.col("row.role"), F.col("row.outcome"), F.col("row.m.legal_name"), "buyer",
            F.col("row.value"), F.col("row.m.consortium"), "mixed_lot", "main_cpv",
            F.col("all_codes").alias("cpv"), "it_share",
            F.col("row.m.city"), F.col("row.m.postal_code"), F.col("row.m.supplier_id"),
            "bidder_count", "pos",
            F.lit("dovs").alias("source"), notice_url(F.col("notice_id")).alias("url"))
        .filter((F.coalesce("company_id", F.lit("")) != "") & exclusion_reason(
            F.col("legal_name"), exclusion_mode, F.col("company_id")).isNull())
    )


def bidder_outcomes(parties: DataFrame, notices: DataFrame) -> DataFrame:
    """Outcome per (notice, company) from flat party rows.

    ``parties``: notice_id, company_id, is_winner (several rows per pair allowed);
    ``notices``: notice_id, award_notice, announced (nullable) and more, one row per notice.
    The join comes first, so parties of notices out of scope go no further; pairs and the
    counts per notice then reuse its partitioning by notice.
    """
    facts = [c for c in notices.columns if c != "notice_id"]
    pairs = parties.join(notices, "notice_id").groupBy("notice_id", "company_id", *facts).agg(
        F.max("is_winner").alias("is_winner"), F.count_if("is_winner").alias("award_rows"))
    notice = Window.partitionBy("notice_id")
    counted = pairs.withColumn("winners", F.count_if("is_winner").over(notice)).withColumn(
        "bidders", F.count(F.lit(1)).over(notice))
    return counted.withColumn(
        "outcome", F.when(F.col("is_winner"), F.lit("award")).otherwise(
            outcome_of(F.col("award_notice"), F.col("winners"), F.col("bidders"), F.col("announced"))))


def losing_bidders(parties: DataFrame) -> DataFrame:
    """Bidders minus the winners of the same notice, as an anti join."""
    winners = parties.filter("is_winner").select("notice_id", "company_id").distinct()
    return parties.select("notice_id", "company_id").distinct().join(
        winners, ["notice_id", "company_id"], "left_anti")

