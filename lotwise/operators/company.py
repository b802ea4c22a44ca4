"""One row per company out of its participations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from lotwise import rules
from lotwise.functions.dates import age_days, as_of_lit
from lotwise.functions.scoring import award_proof, lookup, tier_of, tier_rank
from lotwise.operators.parties import LOST, OPEN, WON_ALONE

NEVER = "0001-01-01"
# What a procedure's row is made of, and with it all that the market list reads of a participation.
OF_PROCEDURE = ["company_id", "ocid", "notice_id", "pos", "d", "role", "outcome", "legal_name", "city", "postal_code", "main_cpv",
                "mixed_lot", "consortium", "url"]
EVIDENCE = [*OF_PROCEDURE, "buyer", "cpv", "supplier_id", "source"]
KINDS = ["buyer", "supplier_id", "source", "code"]


def _best(value: Column, order: Column, cond: Column) -> Column:
    return F.max_by(F.when(cond, value), F.when(cond, order))


def per_procedure(parts: DataFrame) -> DataFrame:
    """Participations reduced to one row per (company, procedure).

    All distinct counts of the company row become plain sums after this step, so the
    company aggregate needs no row expansion and a company with very many rows is
    spread over its procedures first.  Participations travel as they are, since half-made
    rows, which hold a notice several times over, are more than twice as large; those
    without a procedure id do not count, so each notice makes a row of its own.
    """
    own = F.when(F.coalesce("ocid", F.lit("")) == "", F.col("notice_id")).alias("_own")
    counted = [c for c in ["n_rows"] if c in parts.columns]
    parts = parts.select(*OF_PROCEDURE, *counted, own).repartition("company_id", "ocid", "_own")
    role, outcome = F.col("role"), F.col("outcome")
    rows = F.col("n_rows") if "n_rows" in parts.columns else (role == "award").cast("int")
    newest = F.struct(F.coalesce("d", F.lit(NEVER).cast("date")), F.col("notice_id"), -F.col("pos"))
    oldest = F.struct((role != "award").alias("later"), F.col("d"), F.col("notice_id"), F.col("pos"))
    first = F.struct(F.col("d").isNull(), F.col("d"), F.col("notice_id"), F.col("pos"))
    proof = F.struct(F.col("d").alias("d"), F.col("notice_id").alias("notice_id"), F.col("url").alias("url"))
    named = F.struct("legal_name", "city", "postal_code")
    aggs = [
        F.sum(rows).alias("award_rows"),
        F.max(role == "award").alias("awarded"),
        F.max(F.when(role == "award", F.col("d"))).alias("last_award"),
        F.max(F.when(role == "bid", F.col("d"))).alias("last_bid"),
        F.min("mixed_lot").alias("mixed"),
        F.min("consortium").alias("consortium"),
        F.min(F.struct(first.alias("k"), named.alias("v"))).alias("first_row"),
        F.min(F.when(F.col("main_cpv").isNotNull(),
                     F.struct(oldest.alias("k"), F.col("main_cpv").alias("v")))).alias("first_cpv"),
    ]
    for name, cond in (("award", role == "award"), ("lost", outcome == LOST),
                       ("sole", outcome == WON_ALONE), ("open", outcome == OPEN)):
        aggs.append(F.max(F.when(cond, F.struct(newest.alias("k"), proof.alias("v")))).alias(f"proof_{name}"))
    return parts.groupBy("company_id", "ocid", "_own").agg(*aggs).drop("_own")


def distinct_facts(parts: DataFrame, kinds: list[str] = KINDS) -> DataFrame:
    """(company, kind, value) without repeats for buyers, codes, supplier ids and sources.

    The kind comes out of the aggregate, so a filter on it stays above, and all that is asked
    of the facts reads one shuffle; ``kinds`` is for those who want some of them only.
    """
    values = {k: F.array(F.col(k)) for k in KINDS if k != "code"} | {"code": F.coalesce("cpv", F.array())}

    def tagged(kind: str) -> Column:
        return F.transform(values[kind], lambda v: F.struct(F.lit(KINDS.index(kind)).alias("kind"), v.alias("value")))
    return (
        parts.select("company_id", F.explode(F.concat(*map(tagged, kinds))).alias("f"))
        .select("company_id", F.col("f.kind").alias("_kind"), "f.value")
        .filter(F.col("value").isNotNull() & (F.col("value") != ""))
        .groupBy("company_id", "_kind", "value").agg(F.max("_kind").alias("_told"))
        .select("company_id", F.get(F.array(*map(F.lit, KINDS)), F.col("_told")).alias("kind"), "value")
    )


def fact_profile(facts: DataFrame) -> DataFrame:
    """Per company: the first few buyers and codes in order, all supplier ids and sources, the
    number of buyers.

    The rank filter is applied per task before the shuffle, so one task only ever sees
    the leading buyers and codes of a company, not all of them.  Supplier ids are the
    registrations of one company, sources a handful: both are listed whole.
    """
    shown = {"buyer": rules.BUYERS_SHOWN, "code": rules.PROFILE_CODES}
    w = Window.partitionBy("company_id", "kind").orderBy("value")
    cut = F.col("kind").isin(*shown)
    top = (facts.filter(cut).withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= max(shown.values()))
           .filter(F.col("rn") <= lookup(F.col("kind"), shown, 0)).drop("rn")).unionByName(facts.filter(~cut))
    totals = facts.groupBy("company_id").agg(F.count_if(F.col("kind") == "buyer").alias("buyers_total"))

    def joined(kind: str) -> Column:
        return F.array_join(F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.col("value")))), ";")

    lists = top.groupBy("company_id").agg(
        joined("buyer").alias("buyers"), joined("code").alias("cpv_profile"),
        joined("supplier_id").alias("supplier_ids"), joined("source").alias("sources"))
    return lists.join(totals, "company_id")


def company_supplier_ids(facts: DataFrame) -> DataFrame:
    """Every supplier id of every company, one row each."""
    return facts.filter(F.col("kind") == "supplier_id").select(
        "company_id", F.col("value").alias("supplier_id"))


def company_counts(procedures: DataFrame) -> DataFrame:
    """Counts, last dates and strongest proofs per company.  Rows without a procedure id are
    evidence but not a countable procedure."""
    known = F.coalesce("ocid", F.lit("")) != ""
    out = [
        F.count_if(known & F.col("awarded")).alias("awards_total"),
        F.sum("award_rows").alias("award_rows"),
        F.max("last_award").alias("last_award_date"),
        F.count_if(known & F.col("proof_sole").isNotNull()).alias("sole_bidder_wins"),
        F.count_if(known & F.col("proof_lost").isNotNull()).alias("bids_lost"),
        F.count_if(known & F.col("proof_open").isNotNull()).alias("bids_outcome_unknown"),
        F.max("last_bid").alias("last_bid_date"),
        F.count_if(known).alias("participations_total"),
        F.min("mixed").alias("mixed_lot_only"),
        F.min("consortium").alias("consortium_only"),
        F.min("first_row")["v"].alias("first_row"),
        F.min("first_cpv")["v"].alias("main_cpv"),
    ]
    for name in ("award", "lost", "sole", "open"):
        out.append(F.max(f"proof_{name}")["v"].alias(f"proof_{name}"))
    return procedures.groupBy("company_id").agg(*out)


def win_rate(wins: Column, lost: Column) -> Column:
    return F.bround(wins / F.nullif(wins + lost, F.lit(0)), 2)


def strongest_proof(as_of: dt.date) -> Column:
    """struct(proof_type, d, url): a dated award first, then lost, sole and open bids."""
    def proof(kind: Column, src: str) -> Column:
        return F.struct(kind.alias("proof_type"), F.col(f"{src}.d").alias("d"), F.col(f"{src}.url").alias("url"))
    age = age_days(F.col("last_award_date"), as_of_lit(as_of))
    nothing = F.struct(F.lit("P6_nur_branche").alias("proof_type"), F.lit(None).cast("date").alias("d"),
                       F.lit(None).cast("string").alias("url"))
    return (F.when(F.col("last_award_date").isNotNull(), proof(award_proof(age), "proof_award"))
            .when(F.col("proof_lost").isNotNull(), proof(F.lit("P1B_bieter_unterlegen"), "proof_lost"))
            .when(F.col("proof_sole").isNotNull(), proof(F.lit("P1C_alleinbieter"), "proof_sole"))
            .when(F.col("proof_open").isNotNull(), proof(F.lit("P1D_ausgang_offen"), "proof_open"))
            .otherwise(nothing))


def market_list(parts: DataFrame, as_of: dt.date) -> DataFrame:
    """The market list: one evidenced, tiered row per company, best first.

    Blocking steps: one regroup by (company, procedure), one by (company, fact), one by
    company; the latter two combine map-side.
    """
    counts = company_counts(per_procedure(parts)).withColumn("proof", strongest_proof(as_of))
    profile = fact_profile(distinct_facts(parts))
    rows = counts.join(profile, "company_id", "left").withColumn(
        "buyers_total", F.coalesce("buyers_total", F.lit(0).cast("long")))
    rows = rows.withColumn("t", tier_of(
        F.col("proof.proof_type"), F.col("participations_total"),
        age_days(F.col("proof.d"), as_of_lit(as_of)), F.col("buyers_total"), F.col("mixed_lot_only")))
    wins = F.col("awards_total") + F.col("sole_bidder_wins")
    return rows.select(
        "company_id", "first_row.legal_name",
        F.lit(None).cast("string").alias("domain"), F.lit(None).cast("double").alias("domain_confidence"),
        F.lit(None).cast("string").alias("domain_source"), "first_row.city", "first_row.postal_code",
        F.lit(None).cast("long").alias("employees"), F.lit(None).cast("string").alias("employees_scope"),
        "t.tier", "t.tier_status", "t.tier_rationale", "proof.proof_type",
        lookup(F.col("proof.proof_type"), rules.PROOF_CONFIDENCE).alias("proof_confidence"),
        F.col("proof.url").alias("proof_url"), F.col("proof.d").alias("proof_date"),
        "awards_total", "award_rows", "last_award_date", "sole_bidder_wins", "bids_lost",
        "bids_outcome_unknown", "last_bid_date", "participations_total",
        win_rate(wins, F.col("bids_lost")).alias("win_rate"), "buyers", "buyers_total", "cpv_profile",
        "main_cpv", "mixed_lot_only", "consortium_only", "supplier_ids", "sources",
        as_of_lit(as_of).alias("first_seen"),
    ).orderBy(tier_rank(F.col("tier")), F.desc("participations_total"), "company_id")


def market_summary(market: DataFrame) -> DataFrame:
    """Totals and conditional counts of a market list, in one pass."""
    def n(cond: Column, name: str) -> Column:
        return F.count_if(cond).alias(name)
    tiers = [n(F.col("tier") == t, f"tier_{t.lower()}") for t in rules.TIER_ORDER]
    award, sole, lost = F.col("award_rows") > 0, F.col("sole_bidder_wins") > 0, F.col("bids_lost")
    return market.agg(
        F.count(F.lit(1)).alias("companies"), *tiers,
        n(F.col("consortium_only"), "consortium_only"),
        n(F.col("awards_total") > 1, "several_awards"), n(award, "named_award"),
        n(~award & sole, "sole_winners"), n(lost > 0, "losing_bidders"), n(lost > 1, "lost_more_than_once"),
        n(~award & ~sole & (lost == 0), "outcome_open"), n(F.col("domain").isNull(), "without_domain"))


def retier(market: DataFrame, as_of: dt.date) -> DataFrame:
    """Tiers recomputed at a later day; ``tier_before`` keeps the old one.  Only ageing can move a row."""
    t = tier_of(F.col("proof_type"), F.col("participations_total"),
                age_days(F.col("proof_date"), as_of_lit(as_of)), F.col("buyers_total"), F.col("mixed_lot_only"))
    keep = [c for c in market.columns if c not in ("tier", "tier_status", "tier_rationale")]
    return (market.withColumn("t", t)
            .select(*keep, F.col("tier").alias("tier_before"), "t.tier", "t.tier_rationale", "t.tier_status"))


def tier_transitions(retiered: DataFrame) -> DataFrame:
    return retiered.groupBy(F.col("tier_before"), F.col("tier").alias("tier_after")).agg(
        F.count(F.lit(1)).alias("companies"))


def open_work_list(market: DataFrame) -> DataFrame:
    """Companies still without a domain, most valuable first."""
    return (
        market.filter(F.coalesce(F.trim("domain"), F.lit("")) == "")
        .select("company_id", "legal_name", F.coalesce("city", F.lit("")).alias("ort"),
                F.coalesce("postal_code", F.lit("")).alias("plz"), "tier",
                F.col("participations_total").alias("verfahren_12m"),
                F.substring_index("cpv_profile", ";", 3).alias("cpv_kurz"), "proof_url")
        .orderBy(lookup(F.col("tier"), {"A": 0, "B": 1, "C": 2}, 9), F.desc("verfahren_12m"),
                 F.lower("legal_name"), "company_id")
    )
