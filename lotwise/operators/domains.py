"""Company domains from the contact points of the notices, accepted only on evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotwise import rules
from lotwise.functions.hosts import host_of, name_matches_domain
from lotwise.functions.text import company_key
from lotwise.operators.joins import salted_lookup
from lotwise.session import landed

CONFIRMED, RELATED, SINGLE = "amtlich_bestaetigt", "amtlich_namensbezug", "amtlich_unbestaetigt"
NO_CANDIDATE, SUSPECT = "ohne_kandidat", "verworfen_verdacht"
CONFLICT, BELOW = "verworfen_widerspruch", "unter_schwelle"


def contact_rows(notices: DataFrame) -> DataFrame:
    """One row per party: name, roles, hosts of its URL and mail, and its place in the corpus."""
    return (
        notices.select("notice_id", "d", F.posexplode(F.coalesce("parties", F.array())).alias("pos", "p"))
        .select("notice_id", "d", "pos", F.col("p.name").alias("name"), F.col("p.roles").alias("roles"),
                host_of(F.col("p.contactPoint.url")).alias("url_host"),
                host_of(F.col("p.contactPoint.email")).alias("mail_host")))


def buyer_domains(contacts: DataFrame) -> DataFrame:
    """Hosts that occur in a buying-side role."""
    buying = contacts.filter(F.arrays_overlap("roles", F.array(*map(F.lit, rules.BUYER_ROLES))))
    return (buying.select(F.explode(F.array("url_host", "mail_host")).alias("domain"))
            .filter("domain IS NOT NULL").distinct())


def bidder_contacts(contacts: DataFrame) -> DataFrame:
    """Bidding-side contact rows with their company key."""
    bidding = contacts.filter(F.arrays_overlap("roles", F.array(*map(F.lit, rules.BIDDER_ROLES))))
    return bidding.withColumn("company_id", company_key(F.coalesce("name", F.lit(""))))


def first_candidates(bidding: DataFrame, companies: DataFrame) -> DataFrame:
    """Earliest URL and mail host per listed company (companies: company_id, legal_name).

    Reduced to one row per company before the list is joined.
    """
    order = F.struct("d", "notice_id", "pos")
    earliest = bidding.groupBy("company_id").agg(
        F.min_by("url_host", F.when(F.col("url_host").isNotNull(), order)).alias("url_host"),
        F.min_by("mail_host", F.when(F.col("mail_host").isNotNull(), order)).alias("mail_host"))
    return earliest.join(companies.select("company_id"), "company_id", "left_semi")


def with_relation(candidates: DataFrame) -> DataFrame:
    """Candidates (company_id, name_key, url_host, mail_host) plus whether the name shows in
    either host."""
    def related(host: str) -> Column:
        return F.coalesce(F.col(host).isNotNull() & name_matches_domain(F.col("name_key"), F.col(host)), F.lit(False))
    return candidates.withColumn("url_related", related("url_host")).withColumn("mail_related", related("mail_host"))


def claims(related: DataFrame) -> DataFrame:
    """One row per (company, field, host) of ``with_relation`` rows."""
    entry = [F.struct(F.lit(f).alias("field"), F.col(f"{f}_host").alias("domain"), F.col(f"{f}_related").alias("related"))
             for f in ("url", "mail")]
    return (related.select("company_id", F.explode(F.array(*entry)).alias("c")).select("company_id", "c.*")
            .filter("domain IS NOT NULL"))


def domain_spread(claimed: DataFrame, at_least: int = rules.MAX_UNRELATED_COMPANIES) -> DataFrame:
    """Hosts claimed by several companies whose names have nothing to do with them."""
    return (claimed.filter(~F.col("related")).groupBy("domain")
            .agg(F.count(F.lit(1)).alias("unrelated")).filter(F.col("unrelated") >= at_least))


def decide_domains(companies: DataFrame, candidates: DataFrame, buyers: DataFrame) -> DataFrame:
    """Domain, confidence, origin and finding per company.

    A host may be shared by a third of all claims, so its lookup is salted over the
    companies claiming it.  The candidates with their name relations feed the spread, the
    checks and the result, so they are written once.
    """
    named = companies.select("company_id", "legal_name").withColumn("name_key", company_key(F.col("legal_name")))
    cand = landed(with_relation(named.join(candidates, "company_id", "left")), "candidates")
    claimed = claims(cand)
    spread = domain_spread(claimed)
    flags = spread.join(buyers.withColumn("is_buyer", F.lit(True)), "domain", "full")
    checked = salted_lookup(claimed.filter(~F.col("related")), flags, "domain", ["company_id", "field"])
    suspicion = F.when(F.col("is_buyer"), F.concat("domain", F.lit(" ist eine Auftraggeberadresse")))
    shared = F.when(F.col("unrelated").isNotNull(), F.concat(
        "domain", F.lit(" steht bei "), F.col("unrelated").cast("string"), F.lit(" fremden Firmen")))
    # At most two fields times two suspicions per company.
    doubts = (checked.withColumn("s", F.array_compact(F.array(suspicion, shared)))
              .filter(F.size("s") > 0).groupBy("company_id").agg(
                  F.array_join(F.array_distinct(F.flatten(F.transform(
                      F.sort_array(F.collect_list(F.struct((F.col("field") == "mail").alias("o"), "s"))),
                      lambda x: x["s"]))), "; ").alias("doubt")))
    return _decided(cand.join(doubts, "company_id", "left"))


def _decided(rows: DataFrame) -> DataFrame:
    u, m, ru, rm = (F.col(c) for c in ("url_host", "mail_host", "url_related", "mail_related"))
    both, one, status = u.isNotNull() & m.isNotNull(), F.coalesce(u, m), F.col("status")
    rows = rows.withColumn(
        "status",
        F.when(one.isNull(), F.lit(NO_CANDIDATE))
        .when(F.col("doubt").isNotNull(), F.lit(SUSPECT))
        .when(both & (u == m), F.lit(CONFIRMED))
        .when(both & (ru == rm), F.lit(CONFLICT))
        .when(both | ru | rm, F.lit(RELATED))
        .otherwise(F.lit(BELOW)))
    confidence = (F.when(status == CONFIRMED, F.lit(0.95)).when(status == RELATED, F.lit(0.90))
                  .when(status == BELOW, F.lit(0.60)))
    found = status.isin(CONFIRMED, RELATED) & (confidence >= rules.MIN_RESOLUTION_CONFIDENCE)
    return rows.select(
        "company_id", "legal_name",
        F.when(found, F.when(both & ~ru, m).otherwise(one)).otherwise(F.lit("")).alias("domain"),
        confidence.alias("domain_confidence"),
        F.when(found, status).when(status == BELOW, F.lit(SINGLE)).otherwise(F.lit("")).alias("domain_source"),
        F.coalesce(u, F.lit("")).alias("kandidat_url"), F.coalesce(m, F.lit("")).alias("kandidat_mail"),
        F.when(status == SUSPECT, F.col("doubt"))
        .when(status == CONFLICT, F.lit("url und Mail widersprechen sich, Namensbezug entscheidet nicht"))
        .when(status == BELOW, F.lit("kein Namensbezug, Einzelquelle - unter Schwelle"))
        .otherwise(F.lit("")).alias("befund"), "status")


def domain_findings(decisions: DataFrame) -> DataFrame:
    """The findings file: companies with any candidate, those with a domain first."""
    return decisions.filter(F.col("status") != NO_CANDIDATE).drop("status").orderBy(
        F.col("domain") == "", F.lower("legal_name"), "company_id")


def domain_statistics(decisions: DataFrame, buyers: DataFrame | None = None, spread: DataFrame | None = None) -> DataFrame:
    """Companies per status and, where given, the known buyer hosts and the spread hosts."""
    out = decisions.groupBy("status").agg(F.count(F.lit(1)).alias("companies"))
    for name, hosts in (("buyer_domains_bekannt", buyers), ("gestreute_domains", spread)):
        if hosts is not None:
            out = out.unionByName(hosts.agg(F.countDistinct("domain").alias("companies")).select(F.lit(name).alias("status"), "companies"))
    return out


def resolve_domains(notices: DataFrame, companies: DataFrame) -> DataFrame:
    """Whole chain over nested notices; the contact points feed bidders and buyers and are landed once."""
    contacts = landed(contact_rows(notices), "contact-points")
    candidates = first_candidates(bidder_contacts(contacts), companies)
    return decide_domains(companies, candidates, buyer_domains(contacts))

