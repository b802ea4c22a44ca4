"""Contact lists: merged exports, statuses, and a round-robin choice over the best accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lotwise import rules
from lotwise.functions.hosts import domain_check, email_domain
from lotwise.functions.scoring import tier_rank
from lotwise.functions.text import blank_to_null, company_key
from lotwise.functions.verdicts import (
    copy_warning, email_status, filled_count, link_verdict, persona, persona_rank, person_key,
)
from lotwise.operators.joins import salted_lookup
from lotwise.session import landed, numbered

EXPORT_FIELDS = ["company_name", "company_domain", "full_name", "job_title", "location", "profile",
                 "work_email", "mobile_phone", "email_1", "email_2", "email_3"]
#: Columns an export for the signal list may bring along; used where the list itself has none.
SIGNAL_FIELDS = ["signal_type", "signal_datum", "why_now", "quell_url"]
NOT_LISTED = "NEIN - nicht zuordenbar"
NO_ADDRESS = "keine_adresse"


def merge_exports(exports: DataFrame) -> DataFrame:
    """One row per person, the one with most filled fields; the earlier export wins ties.

    ``exports``: the contact fields plus ``file_order`` and ``row_no``.  The rank filter
    works per task first, so a person repeated very often costs one row per task.
    """
    keyed = exports.withColumn("person", person_key(
        F.col("profile"), F.col("work_email"), F.col("full_name"), F.col("company_name")))
    filled = filled_count(*[F.col(c) for c in EXPORT_FIELDS])
    w = Window.partitionBy("person").orderBy(F.desc("filled"), "file_order", "row_no")
    return (keyed.withColumn("filled", filled).withColumn("_rn", F.row_number().over(w))
            .filter("_rn = 1").drop("_rn"))


def contact_rows(contacts: DataFrame, verified: DataFrame, mx: DataFrame) -> DataFrame:
    """Merged contacts with persona, mail status, domain check and text warning.

    ``verified``: email of confirmed addresses, optionally origin (where and when); ``mx``: domain, mx.  Mail
    domains are very uneven, so that lookup is salted over the addresses.
    """
    base = (contacts.withColumn("company_id", company_key(F.coalesce("company_name", F.lit(""))))
            .withColumn("email", F.lower(F.trim(F.coalesce("work_email", F.lit("")))))
            .withColumn("mail_domain", email_domain(F.col("email"))))
    origin = F.col("origin") if "origin" in verified.columns else F.lit(None).cast("string")
    known = verified.groupBy(F.lower(F.trim("email")).alias("email")).agg(F.max(origin).alias("_origin")).withColumn("ok", F.lit(True))
    # People without an address would all meet in one key; they get keys of their own that nothing matches.
    key = F.when(F.col("email") == "", F.concat(F.lit("?"), F.pmod(F.xxhash64("person"), F.lit(256)).cast("string"))).otherwise(F.col("email"))
    base = (base.withColumn("_key", key).join(known.withColumnRenamed("email", "_key"), "_key", "left")
            .withColumn("verified", F.coalesce("ok", F.lit(False))).drop("ok", "_key"))
    base = salted_lookup(base, mx.select(F.col("domain").alias("mail_domain"), "mx"), "mail_domain",
                         ["email", "full_name"])
    own = F.replace(F.lower(F.coalesce("company_domain", F.lit(""))), F.lit("www."))
    phone = blank_to_null(F.col("mobile_phone")).isNotNull()
    return base.withColumn("s", email_status(F.col("work_email"), F.col("verified"), F.col("mx"), F.col("_origin"))).select(
        "person", "company_id", F.coalesce("company_name", F.lit("")).alias("firma"), own.alias("domain"),
        F.coalesce("full_name", F.lit("")).alias("name"), F.coalesce("job_title", F.lit("")).alias("jobtitel"),
        persona(F.col("job_title")).alias("persona"), F.coalesce("location", F.lit("")).alias("ort"),
        F.coalesce("profile", F.lit("")).alias("linkedin"), F.coalesce("work_email", F.lit("")).alias("email"),
        "s.email_status", "s.email_quelle",
        domain_check(email_domain(F.coalesce("work_email", F.lit(""))), own).alias("email_domain_abgleich"),
        F.coalesce("mobile_phone", F.lit("")).alias("telefon"),
        F.when(phone, F.lit("mobil")).otherwise(F.lit("")).alias("telefon_typ"),
        F.when(phone, F.lit("clay_export")).otherwise(F.lit("")).alias("telefon_quelle"),
        copy_warning(F.col("email_1"), F.col("email_2"), F.col("email_3")).alias("copy_warnung"),
        *[(F.col(c) if c in contacts.columns else F.lit(None)).cast("string").alias(f"export_{c}") for c in SIGNAL_FIELDS])


def attach_list(rows: DataFrame, listed: DataFrame, flag: str) -> DataFrame:
    """Contacts joined to a list by company key; unmatched ones are flagged, not dropped."""
    return rows.join(listed.withColumn("_hit", F.lit(True)), "company_id", "left").withColumn(
        flag, F.when(F.col("_hit"), F.lit("ja")).otherwise(F.lit(NOT_LISTED))).drop("_hit")


def orphans(rows: DataFrame, listed: DataFrame) -> DataFrame:
    """Contacts whose company is on no list."""
    return rows.join(listed.select("company_id").distinct(), "company_id", "left_anti")


def unusable_reason(flag: Column) -> Column:
    return (F.when(F.col("email_status") == NO_ADDRESS, F.lit("ohne E-Mail-Adresse"))
            .when(flag != "ja", F.lit("nicht in der Longlist")))


def choose_contacts(rows: DataFrame, listed: DataFrame, flag: str, account_order: list[Column], lead_cap: int | None,
                    account_cap: int | None, per_account: int = rules.CONTACTS_PER_ACCOUNT) -> DataFrame:
    """Up to three contacts per account, dealt out round by round over the best accounts.

    Unusable contacts (no address, company not ``listed``) go only when enough others
    remain.  ``account_order`` ranks an account by its first contact's columns.  Contacts
    without an address rank last in their account, so cutting to three before the list is
    joined changes nothing and keeps an account with very many contacts cheap.  Accounts
    are cut with a top-k before anything is numbered.  Without caps (None) every contact
    counts as needed, and all accounts are numbered by a range sort.
    """
    w = Window.partitionBy("company_id").orderBy(
        F.col("email_status") == NO_ADDRESS,
        F.when(F.col("email_status") == "verifiziert_apollo", 0).otherwise(1),
        persona_rank(F.col("persona")), "name", "email", *[c for c in ("person",) if c in rows.columns])
    top = rows.withColumn("round", F.row_number().over(w)).filter(F.col("round") <= per_account)
    pool = attach_list(top, listed, flag)
    if lead_cap is not None:
        reachable = rows.groupBy("company_id").agg(F.count_if(F.col("email_status") != NO_ADDRESS).alias("n"))
        usable = reachable.join(listed.select("company_id"), "company_id").agg(
            (F.coalesce(F.sum("n"), F.lit(0)) >= lead_cap).alias("x"))
        pool = (pool.withColumn("_enough", usable.scalar())
                .filter(~F.col("_enough") | unusable_reason(F.col(flag)).isNull()).drop("_enough"))
    # The pool ranks the accounts and is joined to their ranks, so it is written once.
    pool = landed(pool, "pool")
    order = [*account_order, F.col("company_id")]
    firsts = pool.filter("round = 1")
    if account_cap is None:
        chosen = pool.join(numbered(firsts, order, "account_rank").select("company_id", "account_rank"), "company_id")
    else:
        best = firsts.orderBy(*order).limit(account_cap)
        chosen = pool.join(F.broadcast(best.select("company_id", F.row_number().over(Window.orderBy(*order)).alias("account_rank"))), "company_id")
    chosen = chosen.orderBy("round", "account_rank")
    return chosen if lead_cap is None else chosen.limit(lead_cap)


def market_contacts(rows: DataFrame, market: DataFrame, lead_cap: int = rules.MARKET_LEADS,
                    account_cap: int = rules.MARKET_ACCOUNTS) -> DataFrame:
    listed = market.select("company_id", "tier", "tier_status", "proof_type", "proof_url", "proof_date",
                           F.col("participations_total").alias("verfahren_12m"),
                           F.col("buyers_total").alias("auftraggeber_12m"))
    order = [tier_rank(F.col("tier")), F.desc(F.coalesce("verfahren_12m", F.lit(0).cast("long"))), F.col("firma")]
    return choose_contacts(rows, listed, "in_longlist", order, lead_cap, account_cap)


def signal_contacts(rows: DataFrame, accounts: DataFrame, lead_cap: int | None = rules.SIGNAL_LEADS,
                    account_cap: int | None = rules.SIGNAL_ACCOUNTS) -> DataFrame:
    listed = accounts.select("company_id", "tier", "score", "signal_type", "signal_datum", "why_now",
                             "quell_url", "match_confidence")
    order = [F.desc(F.coalesce("score", F.lit(0))), F.col("firma")]
    chosen = choose_contacts(rows, listed, "in_longlist_signale", order, lead_cap, account_cap)
    # The list's own wording counts; the export's fills in for companies that are on no list.
    return chosen.withColumns({c: F.coalesce(F.col(c).cast("string"), F.col(f"export_{c}"), F.lit("")) for c in SIGNAL_FIELDS})


def audit_pool(market_rows: DataFrame, signal_rows: DataFrame) -> DataFrame:
    """Both chosen lists as one tagged pool with a common evidence address."""
    cols = ["person", "company_id", "firma", "name", "email", "email_status", "email_domain_abgleich", "copy_warnung"]
    a = market_rows.select(F.lit("markt").alias("liste"), *cols, F.col("proof_url").alias("url"),
                           F.col("in_longlist").alias("gelistet"))
    b = signal_rows.select(F.lit("signale").alias("liste"), *cols, F.col("quell_url").alias("url"),
                           F.col("in_longlist_signale").alias("gelistet"))
    return a.unionByName(b)


def audit_findings(sample: DataFrame, fetched: DataFrame) -> DataFrame:
    """Findings and verdict per sampled contact; ``fetched``: url, status, bytes, content_type."""
    joined = sample.join(fetched, "url", "left").withColumn("v", link_verdict(
        F.coalesce("url", F.lit("")), F.col("status"), F.col("bytes"), F.col("content_type")))
    findings = F.array_compact(F.array(
        F.when(F.col("v.verdict") == "failed", F.concat(F.lit("Beleg: "), F.col("v.reason"))),
        F.when(F.col("v.verdict") == "unverifiable", F.lit("Beleg maschinell nicht pruefbar (JS-Challenge)")),
        F.when(F.col("gelistet") != "ja", F.lit("Firma nicht in der Longlist zuordenbar")),
        F.when(F.col("email_status").isin("kein_mx", NO_ADDRESS), F.concat(F.lit("E-Mail: "), "email_status")),
        F.when(F.col("email_domain_abgleich") != "ok", F.col("email_domain_abgleich")),
        F.when(F.col("copy_warnung") != "", F.lit("Textqualitaet"))))
    return joined.select(
        "liste", "firma", "name", F.col("url").alias("geprueft_beleg_url"), F.col("status").alias("beleg_http"),
        F.col("content_type").alias("beleg_typ"),
        F.when(F.col("v.verdict") == "ok", F.lit("ja")).when(F.col("v.verdict") == "unverifiable", F.lit("n/a"))
        .otherwise(F.lit("nein")).alias("beleg_ok"),
        "email", "email_status", "email_domain_abgleich", "copy_warnung",
        F.when(F.size(findings) == 0, F.lit("keine")).otherwise(F.array_join(findings, "; ")).alias("befunde"),
        F.when(F.size(findings) == 0, F.lit("ok")).otherwise(F.lit("pruefen")).alias("urteil"))


def qualified_leads(market: DataFrame, signals: DataFrame, domains: DataFrame, contacts: DataFrame) -> DataFrame:
    """Companies with a proof address, an active signal, a verified domain and a contact with a
    verified mail: a chain of semi joins, so no side can multiply rows."""
    proven = market.filter(blank_to_null(F.col("proof_url")).isNotNull())
    trusted = domains.filter((F.coalesce("domain", F.lit("")) != "")
                             & (F.col("domain_confidence") >= rules.MIN_RESOLUTION_CONFIDENCE))
    reachable = contacts.filter(F.col("email_status") == "verifiziert_apollo")
    out = proven
    for side in (signals, trusted, reachable):
        out = out.join(side.select("company_id").distinct(), "company_id", "left_semi")
    return out

