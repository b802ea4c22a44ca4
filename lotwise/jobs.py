"""The whole runs: market list, weekly signals, account list, enrichment, completeness, contacts.

Each job reads landed files, composes the operators and writes tables.  Paths name
folders all executors reach; the day of the run is always given.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise import rules
from lotwise.operators import accounts, company, contacts, delta, domains, enrich, population, quality
from lotwise.operators.parties import notices_of_releases, participations_of_notices
from lotwise.operators.signals import OPEN_TENDER, active_signals, resolve_signals, with_identity
from lotwise.schemas import MARKET_COLUMNS
from lotwise.session import landed
from lotwise.sources.notices import month_coverage, read_checked, read_months
from lotwise.sources.registry import SOURCES, report_rejects
from lotwise.sources.sinks import write_buckets, write_csv
from lotwise.sources.state import SignalState


class RunFailed(RuntimeError):
    """At least one source failed; its zeros mean an outage, not "no changes"."""


def market_list(spark: SparkSession, corpus: str, months: list[str], as_of: dt.date, out: str, lines: bool = False) -> DataFrame:
    """Market list of the given months: list, supplier ids, summary and missing months.

    ``lines`` is for a compacted corpus (one release per line, see ``notices.compact``).
    What cannot be read is written to ``rejects`` and stops the job.
    """
    releases, rejects = read_checked(spark, corpus, months, lines)
    report_rejects(rejects, f"{out}/rejects")
    parts = landed(participations_of_notices(notices_of_releases(releases)), "participations")
    company.market_list(parts, as_of).write.mode("overwrite").parquet(f"{out}/market")
    market = spark.read.parquet(f"{out}/market")
    write_csv(market.orderBy(company.tier_rank(F.col("tier")), F.desc("participations_total"), "company_id"),
              f"{out}/market_csv", MARKET_COLUMNS)
    company.company_supplier_ids(company.distinct_facts(parts, ["supplier_id"])).write.mode("overwrite").parquet(f"{out}/supplier_ids")
    company.market_summary(market).write.mode("overwrite").parquet(f"{out}/summary")
    month_coverage(releases, months).write.mode("overwrite").parquet(f"{out}/months")
    return market


def weekly_run(spark: SparkSession, paths: dict[str, str], state: SignalState, at: dt.datetime) -> int:
    """Fetch, resolve and store all sources as one run; failed sources are logged and raised.

    Every source is landed on its own first, so one that cannot be read does not keep the
    others from being stored.  Rows older than the overlap are kept in a late bucket; open
    tenders are due by their deadline and never late.  Every source that was read gets a
    line in the run log, also without rows.
    """
    as_of = at.date()
    first_day = delta.first_fetch_day(as_of)
    since = delta.fetch_since(state.runs(), as_of)
    read, failed = [], {}
    for name, source in SOURCES.items():
        if name not in paths:
            continue
        try:
            raw = source(spark, paths, first_day, as_of)
            read.append((name, landed(with_identity(resolve_signals(raw)), f"signals-{name}")))
        except Exception as exc:  # noqa: BLE001 - any failure of one source is reported below
            failed[name] = f"{type(exc).__name__}: {exc}"
    run_id = 0
    if read:
        union = reduce(lambda a, b: a.unionByName(b), [signals for _, signals in read])
        tagged = delta.tag_late(union, since, first_day, F.col("signal_type") == OPEN_TENDER)
        run_id = state.run(tagged.filter("NOT late").drop("late"), at, sources=[name for name, _ in read])
        delta.type_coverage(union).write.mode("overwrite").parquet(f"{state.root}/coverage/run={run_id}")
        tagged.filter("late").drop("late").write.mode("overwrite").parquet(f"{state.root}/late/run={run_id}")
    for name, error in failed.items():
        state.fail(name, at, error)
    if failed:
        raise RunFailed(f"{len(failed)} of {len(failed) + len(read)} sources: {failed}")
    return run_id


def account_list(spark: SparkSession, state: SignalState, market: DataFrame, as_of: dt.date, out: str,
                 days: int = rules.ACTIVE_DAYS) -> DataFrame:
    """Ranked accounts with trace, open procedures, job ads to check; every active signal keeps a bucket."""
    active = landed(active_signals(state.current(), as_of, days), "active")
    tiers = market.select(F.col("company_id").alias("account_id"), "tier")
    rows = accounts.account_signals(active, tiers, as_of)
    write_csv(rows, f"{out}/accounts")
    write_buckets(accounts.tag_buckets(active), f"{out}/buckets")
    scored = accounts.scored_signals(accounts.account_rows(active, tiers), as_of)
    write_csv(accounts.score_trace(scored), f"{out}/score_trace")
    write_csv(accounts.open_procedures(active, as_of), f"{out}/open_procedures")
    write_csv(accounts.job_check_list(active), f"{out}/job_check")
    return rows


def domain_findings(spark: SparkSession, corpus: str, months: list[str], market: DataFrame, out: str) -> DataFrame:
    """Domains from the notices' contact points and the outcome counts."""
    notices = notices_of_releases(read_months(spark, corpus, months))
    decided = landed(domains.resolve_domains(notices, market.select("company_id", "legal_name")), "domains")
    write_csv(domains.domain_findings(decided), f"{out}/findings")
    domains.domain_statistics(decided).write.mode("overwrite").parquet(f"{out}/statistics")
    return decided


def merge_enrichment(market: DataFrame, records: DataFrame, as_of: dt.date, out: str) -> DataFrame:
    """Enriched, retiered market list with merge statistics and tier transitions."""
    merged = landed(enrich.merge_enrichment(market, records, as_of), "merged")
    merged.write.mode("overwrite").parquet(f"{out}/market")
    enrich.merge_statistics(merged).write.mode("overwrite").parquet(f"{out}/statistics")
    company.tier_transitions(merged).write.mode("overwrite").parquet(f"{out}/transitions")
    return merged


def completeness(participations: DataFrame, notices: DataFrame, out: str) -> DataFrame:
    """Capture-recapture table over the full months: three splits and the Chao1 bound."""
    dated = notices.filter("is_it").select("notice_id", population.month_of(F.col("d")).alias("month"))
    full = population.full_months(dated).filter("is_full").select("month")
    seen = participations.select("company_id", "notice_id").join(
        dated.dropDuplicates(["notice_id"]), "notice_id").select("company_id", "month").distinct()
    flags = landed(population.occasion_flags(seen.join(full, "month", "left_semi")), "occasions")
    splits, chao = population.chapman_splits(flags), population.chao1(flags)
    rows = splits.select(F.col("split").alias("schnitt"), "n1", "n2", F.col("both").alias("beide"), "n", "lo", "hi",
                         "observed", "coverage").unionByName(chao.select(
                             F.lit("Chao1 (Monate)").alias("schnitt"), F.col("f1").alias("n1"), F.col("f2").alias("n2"),
                             F.col("observed").alias("beide"), "n", "lo", F.lit(None).cast("double").alias("hi"),
                             "observed", "coverage"))
    table = rows.select(
        "schnitt", "n1", "n2", "beide", F.bround("n", 0).cast("long").alias("n_geschaetzt"),
        F.bround("lo", 0).cast("long").alias("ki_unten"), F.bround("hi", 0).cast("long").alias("ki_oben"),
        F.col("observed").alias("beobachtet"), F.bround("coverage", 3).alias("abdeckung"))
    write_csv(table, f"{out}/completeness")
    population.split_spread(splits).write.mode("overwrite").parquet(f"{out}/spread")
    return table


def contact_package(market_exports: DataFrame, signal_exports: DataFrame, verified: DataFrame, mx: DataFrame, market: DataFrame, account_rows: DataFrame,
                    fetched: DataFrame, out: str, sample: int = 30, seed: int = 42) -> DataFrame:
    """Both contact lists, each from its own exports, the contacts on neither list and the audited sample."""
    def people(exports: DataFrame, name: str) -> DataFrame:
        return landed(contacts.contact_rows(contacts.merge_exports(exports), verified, mx), name)

    market_people, signal_people = people(market_exports, "market-people"), people(signal_exports, "signal-people")
    for_market = landed(contacts.market_contacts(market_people, market), "market-contacts")
    for_signals = landed(contacts.signal_contacts(signal_people, account_rows), "signal-contacts")
    write_csv(for_market.orderBy("round", "account_rank"), f"{out}/market_contacts")
    write_csv(for_signals.orderBy("round", "account_rank"), f"{out}/signal_contacts")
    listed = market.select("company_id").unionByName(account_rows.select("company_id")).distinct()
    everyone = market_people.unionByName(signal_people).dropDuplicates(["person"])
    write_csv(contacts.orphans(everyone, listed), f"{out}/orphans")
    pool = contacts.audit_pool(for_market, for_signals)
    key = F.concat_ws("|", "liste", "person")
    audit = contacts.audit_findings(quality.seeded_sample(pool, key, sample, seed), fetched)
    write_csv(audit, f"{out}/validation_sample")
    return audit
