"""Active signals to ranked accounts with a traceable score."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from lotwise import rules
from lotwise.functions.dates import as_of_lit
from lotwise.functions.scoring import account_score, signal_factors, signal_raw, stacking_bonus, tier_fit
from lotwise.functions.wording import why_now

BUYER_SIDE, JOB_CHECK, ACCOUNT = "buyer_side", "job_check", "account"
TRACE_SIGNALS = 5
#: Fixed texts of the trace.
FORMULA = "min(best(weight x recency x fit_d x conf_d) + stacking, cap) / cap x 100"
DAMPENING = "fit und confidence wirken auf [0.4 .. 1.0]"
DRIVER = ["org_name_raw", "org_place", "signal_type", "event_date", "source_url", "match_confidence", "title",
          "buyer", "contract_end", "deadline"]
JOB_HINT = "Bid-Rolle ausgeschrieben, aber kein IT-Vergabebeleg - ICP vor Ansprache pruefen"


def account_key(df: DataFrame) -> DataFrame:
    return df.withColumn("account_id", F.coalesce(F.nullif("company_id", F.lit("")), F.col("org_name_raw")))


def it_universe(signals: DataFrame) -> DataFrame:
    """Companies proven by procurement data; buyers do not count."""
    return (account_key(signals)
            .filter(F.col("source").isin(rules.PROCUREMENT_SOURCES) & ~F.coalesce("is_buyer_side", F.lit(False)))
            .select("account_id").distinct())


def _bucket() -> Column:
    job_only = (F.col("source") == rules.JOB_SOURCE) & F.col("proven").isNull()
    return (F.when(F.coalesce("is_buyer_side", F.lit(False)), F.lit(BUYER_SIDE))
            .when(job_only, F.lit(JOB_CHECK)).otherwise(F.lit(ACCOUNT)))


def tag_buckets(signals: DataFrame) -> DataFrame:
    """Every active signal with its bucket: account, buyer side, or job ad without proof.

    Nothing is dropped; a sink partitions by ``bucket``.  The lookup has one row per account,
    so adaptive execution can split an account that holds a large share of the signals.
    """
    proven = it_universe(signals).withColumn("proven", F.lit(True))
    rows = account_key(signals).join(proven, "account_id", "left")
    return rows.withColumn("bucket", _bucket()).drop("proven")


def proven_job_ads(signals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Job ads of proven companies, and the rest for a manual check."""
    universe = it_universe(signals)
    jobs = account_key(signals).filter(F.col("source") == rules.JOB_SOURCE)
    return jobs.join(universe, "account_id", "left_semi"), jobs.join(universe, "account_id", "left_anti")


def with_tier(signals: DataFrame, tiers: DataFrame) -> DataFrame:
    """Tier of each account (default C) and whether it is on the market list at all.

    ``tiers`` (account_id, tier) has one row per account.
    """
    named = tiers.select("account_id", F.col("tier").alias("_t"))
    return _tiered(signals.join(named, "account_id", "left"))


def _tiered(rows: DataFrame) -> DataFrame:
    return (rows.withColumn("in_market_list", F.col("_t").isNotNull())
            .withColumn("tier", F.coalesce("_t", F.lit("C"))).drop("_t"))


def account_rows(signals: DataFrame, tiers: DataFrame) -> DataFrame:
    """The signals that count for accounts, with their tier: bucket and tier in one lookup."""
    proven = it_universe(signals).withColumn("proven", F.lit(True))
    facts = proven.join(tiers.select("account_id", F.col("tier").alias("_t")), "account_id", "full")
    rows = account_key(signals).join(facts, "account_id", "left")
    return _tiered(rows.filter(_bucket() == ACCOUNT).drop("proven"))


def scored_signals(signals: DataFrame, as_of: dt.date) -> DataFrame:
    """Signals with every factor of their raw score."""
    facts = signal_factors(F.col("signal_type"), F.col("event_date"), F.col("match_confidence"), F.col("tier"), as_of_lit(as_of))
    return signals.withColumn("factors", facts).select("*", signal_raw(F.col("factors")).alias("raw"))


def _by_strength():
    return [F.desc("raw"), F.desc_nulls_last("event_date"), F.col("signal_id")]


def driver_signals(scored: DataFrame, n: int = 1) -> DataFrame:
    """The ``n`` strongest signals per account with their rank."""
    w = Window.partitionBy("account_id").orderBy(*_by_strength())
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def account_scores(scored: DataFrame, driver: list[str] | None = None) -> DataFrame:
    """Best single signal plus a bonus for independent types; one row per account.

    With ``driver`` the strongest signal's columns come along as a struct.  Everything is
    one aggregate that combines map-side: distinct types are a fixed small set and the
    driver is a running minimum, so an account with very many signals stays cheap.
    """
    strength = [(-F.col("raw")).alias("r"), F.coalesce(-F.unix_date("event_date"), F.lit(2 ** 31 - 1)).alias("d"),
                F.col("signal_id").alias("i")]
    best = [F.min(F.struct(*strength, F.struct(*driver).alias("v")))["v"].alias("driver")] if driver else []
    agg = scored.groupBy("account_id", "tier", "in_market_list").agg(
        F.max("raw").alias("best_raw"), F.count(F.lit(1)).alias("signal_count"),
        F.array_sort(F.collect_set("signal_type")).alias("types"), *best)
    n_types = F.size("types")
    return agg.select(
        "account_id", "tier", "in_market_list", "signal_count",
        n_types.alias("n_types"), F.array_join("types", ";").alias("signal_types"), "best_raw",
        F.bround(stacking_bonus(n_types, F.col("tier")), 3).alias("stacking_bonus"),
        account_score(F.col("best_raw"), n_types, F.col("tier")).alias("score"),
        *(["driver"] if driver else []),
    ).withColumn("enrich", F.col("score") >= rules.ENRICH_SCORE)


def account_signals(signals: DataFrame, tiers: DataFrame, as_of: dt.date) -> DataFrame:
    """The weekly account list, best score first."""
    scored = scored_signals(account_rows(signals, tiers), as_of)
    rows = account_scores(scored, DRIVER).select(
        "*", *[F.col(f"driver.{c}").alias(f"d_{c}") for c in DRIVER])

    def d(name: str) -> Column:
        return F.col(f"d_{name}")

    return rows.select(
        F.col("account_id").alias("company_id"), d("org_name_raw").alias("firma_raw"),
        F.coalesce(d("org_place"), F.lit("")).alias("ort"), "tier", "score", d("signal_type").alias("signal_type"),
        d("event_date").alias("signal_datum"), F.coalesce(d("source_url"), F.lit("")).alias("quell_url"),
        F.col("signal_count").alias("signal_anzahl"), F.col("signal_types").alias("signal_typen"),
        d("match_confidence").alias("match_confidence"), F.col("in_market_list").alias("in_longlist_1"), "enrich",
        why_now(d("signal_type"), d("title"), d("buyer"), d("org_name_raw"), d("org_place"), d("event_date"),
                d("contract_end"), F.datediff(d("deadline"), as_of_lit(as_of))).alias("why_now"),
    ).orderBy(F.desc("score"), "company_id")


def score_trace(scored: DataFrame) -> DataFrame:
    """Per account the derivation of its score as JSON: formula, bonus, the strongest signals
    with all their factors and, first among them, the driver; a score can be recomputed from it."""
    w = Window.partitionBy("account_id").orderBy(*_by_strength())
    top = (scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= TRACE_SIGNALS)
           .groupBy("account_id").agg(F.sort_array(F.collect_list(F.struct(
               "rank", "signal_type", "event_date", "factors.weight", "factors.recency",
               F.bround("factors.fit", 3).alias("icp_fit_dampened"), F.bround("factors.confidence", 3).alias("confidence"),
               F.bround("factors.dampened", 3).alias("confidence_dampened"), "raw", "source_url", "signal_id"))).alias("top")))
    rows = account_scores(scored).join(top, "account_id")
    fit = tier_fit(F.col("tier"))
    return rows.select("account_id", "score", F.to_json(F.struct(
        F.lit(FORMULA).alias("formula"), "tier", fit.alias("icp_fit"), F.lit(DAMPENING).alias("dampening"), "signal_count",
        "signal_types", "stacking_bonus", F.get("top", F.lit(0)).alias("driver"), "top")).alias("score_components"))


def open_procedures(signals: DataFrame, as_of: dt.date) -> DataFrame:
    """Buyer-side rows as a feed of their own."""
    return signals.filter(F.coalesce("is_buyer_side", F.lit(False))).select(
        F.get_json_object("payload", "$.ocid").alias("ocid"), F.col("org_name_raw").alias("vergabestelle"),
        F.col("title").alias("titel"), F.array_join("cpv", ";").alias("cpv"), F.col("deadline").alias("frist"),
        F.datediff("deadline", as_of_lit(as_of)).alias("tage_bis_frist"), F.col("value").alias("wert"),
        F.col("source_url").alias("quell_url"))


def job_check_list(signals: DataFrame) -> DataFrame:
    _, unproven = proven_job_ads(signals)
    return unproven.select(
        F.col("org_name_raw").alias("firma_raw"), F.coalesce("org_place", F.lit("")).alias("ort"),
        F.col("title").alias("titel"), F.col("event_date").alias("datum"), F.col("source_url").alias("quell_url"),
        F.lit(JOB_HINT).alias("hinweis"))


def rolling_activity(signals: DataFrame, days: int = rules.ACTIVE_DAYS, step: int = 7) -> DataFrame:
    """Signals per account and rolling eight-week window; works on a batch and on a stream."""
    return signals.groupBy("account_id", F.window("event_ts", f"{days} days", f"{step} days").alias("w")).agg(
        F.count(F.lit(1)).alias("signals")).select(
        "account_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "signals")
