"""Enrichment merged into the market list: three keys in order of trust, ranked sources."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.functions.scoring import tier_rank
from lotwise.functions.text import blank_to_null, company_key
from lotwise.functions.verdicts import head_count_scope, source_rank
from lotwise.operators.company import retier

RECORD = ["legal_name", "domain", "employees", "country", "city", "matched_name", "industry", "linkedin",
          "domain_source", "domain_confidence"]


MATCH_ORDER = {"id": 1, "name": 2, "domain": 3}


def _keys(by_id: Column, by_name: Column, by_domain: Column) -> Column:
    """One entry per way of matching."""
    return F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), key.alias("key"))
                               for (kind, rank), key in zip(MATCH_ORDER.items(), (by_id, by_name, by_domain))]))


def latest_records(records: DataFrame) -> DataFrame:
    """The latest record (by ``row_no``) per way of matching and non-empty key.

    One pass over the records and one regroup, combining map-side, serve all three ways.
    """
    entries = records.select(_keys(F.col("company_id"), company_key(F.col("legal_name")), F.col("domain")).alias("k"),
                             F.struct(*RECORD).alias("rec"), "row_no")
    return (entries.select("k.kind", "k.key", "rec", "row_no").filter(blank_to_null(F.col("key")).isNotNull())
            .groupBy("kind", "key").agg(F.max_by("rec", "row_no").alias("rec")))


def match_enrichment(market: DataFrame, records: DataFrame) -> DataFrame:
    """Each market row with its record: by company id, else by name key, else by domain."""
    wanted = market.select("company_id", _keys(F.col("company_id"), F.col("company_id"), F.col("domain")).alias("k"))
    hits = wanted.select("company_id", "k.*").join(latest_records(records), ["kind", "key"])
    best = hits.groupBy("company_id").agg(F.min_by(F.struct(F.col("kind").alias("matched_by"), "rec"), "rank").alias("m"))
    return market.join(best, "company_id", "left").select(
        *market.columns, F.col("m.rec").alias("rec"), F.col("m.matched_by").alias("matched_by"))


def apply_enrichment(matched: DataFrame) -> DataFrame:
    """Domain, head count and notes after the overwrite rule; keeps the old tier columns."""
    offered, held = F.col("rec.domain"), F.col("domain")
    has_offer = F.coalesce(offered, F.lit("")) != ""
    same = F.lower(F.trim(offered)) == F.lower(F.trim(F.coalesce(held, F.lit(""))))
    better = (F.coalesce(held, F.lit("")) == "") | (
        source_rank(F.col("rec.domain_source"), F.col("rec.domain_confidence"))
        >= source_rank(F.col("domain_source"), F.col("domain_confidence")))
    action = (F.when(has_offer & same, F.lit("domain_bestaetigt"))
              .when(has_offer & better, F.lit("domain_uebernommen"))
              .when(has_offer, F.lit("domain_bessere_behalten")))
    take = F.coalesce(action == "domain_uebernommen", F.lit(False))
    scope = head_count_scope(F.col("legal_name"),
                             F.coalesce(F.nullif("rec.matched_name", F.lit("")), F.col("rec.legal_name")),
                             F.col("rec.country"), F.col("rec.employees"))
    m = matched.withColumn("domain_action", action).withColumn(
        "scope", F.when(F.col("rec").isNotNull(), scope))
    usable, count = F.col("scope.usable"), F.col("rec.employees")
    note = F.when(count.isNotNull() & ~usable, F.concat(
        "scope.note", F.lit(" | gemeldeter Wert: "), count.cast("string"))).otherwise(F.col("scope.note"))
    replaced = {
        "domain": F.when(take, offered).otherwise(held),
        "domain_source": F.when(take, F.coalesce(F.nullif("rec.domain_source", F.lit("")), F.lit("enrichment")))
        .otherwise(F.col("domain_source")),
        "domain_confidence": F.when(take, F.coalesce(
            F.col("rec.domain_confidence").cast("string").try_cast("double"), F.col("domain_confidence")))
        .otherwise(F.col("domain_confidence")),
        "employees": F.when(count.isNotNull() & usable, count).when(count.isNotNull(), F.lit(None))
        .otherwise(F.col("employees")),
        "employees_scope": F.coalesce("scope.scope", "employees_scope"),
    }
    kept = [replaced.get(c, F.col(c)).alias(c) for c in matched.columns if c not in ("rec",)]
    return m.select(
        *kept, "domain_action",
        F.when(F.col("domain_action") == "domain_bessere_behalten", F.concat(
            offered, F.lit(" verworfen, "), held, F.lit(" ("), F.coalesce("domain_source", F.lit("")),
            F.lit(") ist besser belegt"))).otherwise(F.lit("")).alias("domain_note"),
        F.coalesce(note, F.lit("")).alias("employees_note"),
        F.when(F.col("rec").isNotNull() & count.isNotNull(), F.when(usable, F.lit("mitarbeiterzahl_nutzbar"))
               .otherwise(F.lit("mitarbeiterzahl_verworfen"))).alias("employees_action"),
        F.col("rec.industry").alias("industry"), F.col("rec.linkedin").alias("linkedin"))


def merge_enrichment(market: DataFrame, records: DataFrame, as_of: dt.date) -> DataFrame:
    """Market list with enrichment applied and tiers recomputed at ``as_of``."""
    merged = apply_enrichment(match_enrichment(market, records))
    return retier(merged, as_of).orderBy(tier_rank(F.col("tier")), F.desc("participations_total"), "company_id")


def merge_statistics(merged: DataFrame) -> DataFrame:
    """Matched, taken, kept and discarded counts of one merge."""
    def n(cond, name):
        return F.count_if(cond).alias(name)
    return merged.agg(
        n(F.col("matched_by").isNotNull(), "gematcht"), n(F.col("matched_by").isNull(), "ohne_treffer"),
        *[n(F.col("domain_action") == a, a) for a in
          ("domain_bestaetigt", "domain_uebernommen", "domain_bessere_behalten")],
        *[n(F.col("employees_action") == a, a) for a in ("mitarbeiterzahl_nutzbar", "mitarbeiterzahl_verworfen")],
        n(F.col("tier_before") != F.col("tier"), "tier_geaendert_durch_alterung"),
        n(F.coalesce("domain", F.lit("")) != "", "mit_domain"))


def account_report(domains: DataFrame, firmographics: DataFrame, market: DataFrame) -> DataFrame:
    """Resolved domains with head counts and market facts, largest first.

    ``domains``: company_id, domain, confidence, stage, note; ``firmographics``: domain,
    employees, industry, naics, phone, city, country; one row per key each.
    """
    f = firmographics.select("domain", "employees", "industry", "naics", "phone",
                             F.col("city").alias("hq_city"), F.col("country").alias("hq_country"))
    m = market.select("company_id", "legal_name", "tier", "awards_total", "proof_url")
    return (domains.join(f, "domain", "left").join(m, "company_id", "left")
            .select("company_id", F.coalesce("legal_name", F.lit("")).alias("legal_name"), "domain",
                    F.col("confidence").alias("domain_confidence"), F.col("stage").alias("domain_stage"),
                    F.col("note").alias("domain_beleg"), "employees", "industry",
                    F.array_join("naics", ";").alias("naics"), F.col("phone").alias("phone_zentrale"),
                    "hq_city", "hq_country", "tier", "awards_total", "proof_url")
            .orderBy(F.desc_nulls_last("employees"), "company_id"))


def still_to_do(wanted: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    """Distinct keys without a landed result."""
    return wanted.select(key).filter(blank_to_null(F.col(key).cast("string")).isNotNull()).distinct().join(
        landed.select(key), key, "left_anti")


def lookup_cost(market: DataFrame, domains: DataFrame) -> DataFrame:
    """Upper bound of paid lookups: one per resolved domain, three searches, three matches."""
    t = domains.agg(F.count(F.lit(1)).alias("looked_up"),
                    F.count_if(F.coalesce("domain", F.lit("")) != "").alias("resolved"))
    n = market.agg(F.count(F.lit(1)).alias("c"))
    return t.withColumn("companies", n.scalar()).select(
        "companies", "looked_up", "resolved", (F.col("companies") - F.col("looked_up")).alias("open_lookups"),
        (F.col("resolved") * 3).alias("contact_searches"), (F.col("resolved") * 3).alias("contact_matches"),
        (F.col("resolved") * 7).alias("credit_ceiling"))

