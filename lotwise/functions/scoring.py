"""Proof, tier, confidence and score expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from lotwise import rules
from lotwise.functions.dates import age_text, recency_factor


def lookup(key: Column, table: dict, default=None) -> Column:
    """A fixed rule table as a CASE expression."""
    out = None
    for k, v in table.items():
        out = F.when(key == k, F.lit(v)) if out is None else out.when(key == k, F.lit(v))
    return out.otherwise(F.lit(default))


def award_proof(age: Column) -> Column:
    return (F.when(age <= rules.AWARD_FRESH_DAYS, F.lit("P1_zuschlag_24m"))
            .when(age <= rules.AWARD_OLD_DAYS, F.lit("P2_zuschlag_48m"))
            .otherwise(F.lit("P3_rahmenvertrag")))


def tier_of(proof: Column, procedures: Column, proof_age: Column, buyers: Column,
            mixed_only: Column) -> Column:
    """struct(tier, tier_rationale, tier_status) from notice data alone."""
    strong = proof.isin(rules.STRONG_PROOFS)
    fresh = proof_age.isNotNull() & (proof_age <= rules.TIER_A_MAX_AGE_DAYS)
    age = age_text(proof_age)
    count = procedures.cast("string")
    breadth = F.when(buyers > 1, F.concat(F.lit(", "), buyers.cast("string"),
                                          F.lit(" verschiedene Auftraggeber"))).otherwise(F.lit(""))
    often = F.concat(count, F.lit(" Verfahren in 12 Monaten, "), age, breadth)
    cases = [
        (mixed_only, "C", F.lit("nur ueber Sammelvergabe mit fachfremden Gewerken belegt - "
                                "IT-Eigenschaft nicht gesichert, vor Ansprache pruefen")),
        (proof.isin(rules.WEAK_PROOFS), "C",
         F.lit("Public-Sector-Bezug belegt, aber kein Zuschlag und keine Bieterrolle gefunden")),
        (~strong, "D", F.lit("kein belegter Public-Sector-Bezug")),
        ((procedures >= rules.TIER_A_MIN_PROCEDURES) & fresh, "A",
         F.concat(often, F.lit(" - laufender Angebotsprozess"))),
        (procedures >= 2, "B", F.concat(often, F.lit(" - wiederkehrender Bieter"))),
        (fresh, "B", F.concat(F.lit("1 Verfahren, "), age,
                              F.lit(" - Teilnahme aktuell, aber bisher einmalig"))),
    ]
    last = F.concat(F.when(procedures > 0, count).otherwise(F.lit("1")), F.lit(" Verfahren, "), age,
                    F.lit(" - Teilnahme belegt, aber weder haeufig noch aktuell"))
    tier = reduce(lambda acc, c: acc.when(c[0], F.lit(c[1])), cases[1:], F.when(cases[0][0], F.lit(cases[0][1])))
    text = reduce(lambda acc, c: acc.when(c[0], c[2]), cases[1:], F.when(cases[0][0], cases[0][2]))
    return F.struct(
        tier.otherwise(F.lit("C")).alias("tier"),
        text.otherwise(last).alias("tier_rationale"),
        lookup(proof, rules.TIER_STATUS, "kein_beleg").alias("tier_status"),
    )


def tier_rank(tier: Column) -> Column:
    return lookup(tier, rules.TIER_ORDER, 9)


def resolution_confidence(source: Column, name_sim: Column, place_match: Column,
                          has_register_id: Column, imprint_ok: Column,
                          consortium: Column) -> Column:
    """Source prior times name similarity plus one bonus per checkable feature."""
    def bonus(flag: Column, value: float) -> Column:
        return F.when(flag, F.lit(value)).otherwise(F.lit(0.0))
    prior = lookup(source, rules.SOURCE_PRIOR, rules.DEFAULT_PRIOR)
    score = (prior * F.least(name_sim, F.lit(1.0)) + bonus(place_match, 0.10)
             + bonus(has_register_id, 0.15) + bonus(imprint_ok, 0.15))
    capped = F.bround(F.least(score, F.lit(1.0)), 3)
    return F.bround(F.greatest(capped - bonus(consortium, 0.10), F.lit(0.0)), 3)


def dampen(c: Column) -> Column:
    return F.lit(rules.DAMPEN_FLOOR) + F.lit(1 - rules.DAMPEN_FLOOR) * c


def tier_fit(tier: Column) -> Column:
    return lookup(tier, rules.TIER_FIT, rules.DEFAULT_TIER_FIT)


def signal_factors(signal_type: Column, day: Column, confidence: Column, tier: Column, as_of: Column) -> Column:
    """struct(weight, recency, fit, confidence, dampened): what a signal's raw score is made of."""
    conf = F.coalesce(F.nullif(confidence, F.lit(0.0)), F.lit(rules.DEFAULT_CONFIDENCE))
    return F.struct(
        lookup(signal_type, rules.SIGNAL_WEIGHTS, rules.DEFAULT_SIGNAL_WEIGHT).alias("weight"),
        recency_factor(day, as_of).alias("recency"), dampen(tier_fit(tier)).alias("fit"),
        conf.alias("confidence"), dampen(conf).alias("dampened"))


def signal_raw(factors: Column) -> Column:
    """Weight x recency x dampened fit x dampened confidence."""
    return F.bround(factors["weight"] * factors["recency"] * factors["fit"] * factors["dampened"], 3)


def account_score(best_raw: Column, n_types: Column, tier: Column) -> Column:
    raw = best_raw + stacking_bonus(n_types, tier)
    return F.bround(F.least(raw / rules.SCORE_CAP, F.lit(1.0)) * 100, 0).cast("int")


def stacking_bonus(n_types: Column, tier: Column) -> Column:
    return F.when(n_types >= 2, rules.STACKING_BONUS * tier_fit(tier)).otherwise(F.lit(0.0))
