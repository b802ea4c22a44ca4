"""Contact lists, samples and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise import rules
from lotwise.functions.verdicts import link_verdict, persona, source_verdict
from lotwise.operators import contacts as ops, quality
from lotwise.operators.signals import within
from lotwise.functions.dates import as_of_lit
from lotwise.plans import views
from lotwise.plans.market import OUTCOMES
from lotwise.plans.names import fetched_pages
from lotwise.plans.registry import query
from lotwise.plans.signals import TIERS, customer_tiers
from lotwise.plans.views import table
from lotwise.session import landed

# --- contacts: every order is a contact of its customer's account --------------------------------
TITLES = {"1-URGENT": "Bid Manager", "2-HIGH": "Geschäftsführer", "3-MEDIUM": "Referent Angebotswesen",
          "4-NOT SPECIFIED": "Systemadministrator", "5-LOW": "Vertriebsleitung"}
TITLE_SQL = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TITLES.items()) + " END"


def contacts(spark, d):
    """Contact exports: several export files, the same person in more than one of them."""
    k, o = F.col("o_custkey"), F.col("o_orderkey")
    title = F.create_map(*[F.lit(x) for p in TITLES.items() for x in p])[F.col("o_orderpriority")]
    firm = F.concat(F.lit("firma "), k.cast("string"))
    person = F.concat(F.lit("P"), (o % 4).cast("string"))
    mail = F.concat(F.lower(person), F.lit("@"), F.when(o % 3 == 0, F.lit("firma")).otherwise(F.lit("gruppe")),
                    (k % 40).cast("string"), F.lit(".de"))
    s = F.col("o_orderstatus")
    return table(spark, d, "orders").select(
        firm.alias("company_name"), F.concat(F.lit("www.firma"), (k % 40).cast("string"), F.lit(".de")).alias("company_domain"),
        F.concat_ws(" ", person, firm).alias("full_name"), title.alias("job_title"),
        F.when(o % 2 == 0, F.lit("Bonn")).alias("location"),
        F.when(s == "F", F.concat(F.lit("https://profil/"), k.cast("string"), F.lit("-"), (o % 4).cast("string"))).alias("profile"),
        F.when(o % 7 != 0, mail).alias("work_email"), F.when(o % 5 == 0, F.lit("+49 1")).alias("mobile_phone"),
        F.when(o % 11 == 0, F.lit("Ich konnte online wenig finden, nehme aber an")).otherwise(F.lit("Guten Tag")).alias("email_1"),
        F.when(o % 13 == 0, F.lit("Ich hoffe")).alias("email_2"), F.lit(None).cast("string").alias("email_3"),
        (o % 2).cast("int").alias("file_order"), o.alias("row_no"))


CONTACTS = f"""
ct AS (SELECT o_orderkey AS o, o_custkey AS k, 'firma ' || o_custkey AS firm, 'P' || o_orderkey % 4 || ' firma ' || o_custkey AS name,
  {TITLE_SQL} AS title, CASE WHEN o_orderkey % 2 = 0 THEN 'Bonn' END AS loc,
  CASE WHEN o_orderstatus = 'F' THEN 'https://profil/' || o_custkey || '-' || o_orderkey % 4 END AS profile,
  CASE WHEN o_orderkey % 7 <> 0 THEN 'p' || o_orderkey % 4 || '@' || CASE WHEN o_orderkey % 3 = 0 THEN 'firma' ELSE 'gruppe' END || o_custkey % 40 || '.de' END AS mail,
  CASE WHEN o_orderkey % 5 = 0 THEN '+49 1' END AS phone, CASE WHEN o_orderkey % 13 = 0 THEN 'Ich hoffe' END AS e2 FROM orders),
ps AS (SELECT *, coalesce(profile, mail, lower(name) || '|' || firm) AS person, 6 + (loc IS NOT NULL)::INT + (profile IS NOT NULL)::INT
   + (mail IS NOT NULL)::INT + (phone IS NOT NULL)::INT + (e2 IS NOT NULL)::INT - 1 AS filled FROM ct),
best AS (SELECT * FROM ps QUALIFY row_number() OVER (PARTITION BY person ORDER BY filled DESC, o % 2, o) = 1)"""


@query("merge_most_complete", f"WITH {CONTACTS} SELECT person, o AS row_no, CAST(filled AS INTEGER) AS filled FROM best")
def merge_most_complete(spark, d):
    return ops.merge_exports(contacts(spark, d)).select("person", "row_no", "filled")


def verified_mails(spark, d):
    return contacts(spark, d).filter((F.col("row_no") % 10 == 3) & F.col("work_email").isNotNull()).select(
        F.col("work_email").alias("email"))


def mx_table(spark, d):
    """Landed mail-server lookups: by domain, some without a server, some never looked up."""
    dom = F.explode(F.array(F.concat(F.lit("firma"), F.col("n").cast("string"), F.lit(".de")),
                            F.concat(F.lit("gruppe"), F.col("n").cast("string"), F.lit(".de"))))
    keys = table(spark, d, "customer").select((F.col("c_custkey") % 40).alias("n")).distinct()
    return keys.filter("n % 4 <> 1").select(dom.alias("domain"), (F.col("n") % 4 != 2).alias("mx"))


def prepared(spark, d):
    """Merged and checked contacts; several steps read them, so they are written once."""
    people = ops.merge_exports(contacts(spark, d))
    return landed(ops.contact_rows(people, verified_mails(spark, d), mx_table(spark, d)), "contacts")


CHECKED = f"""{CONTACTS},
vf AS (SELECT DISTINCT lower(mail) AS m FROM ct WHERE o % 10 = 3 AND mail IS NOT NULL),
ck AS (SELECT b.*, CASE WHEN mail IS NULL THEN 'keine_adresse' WHEN vf.m IS NOT NULL THEN 'verifiziert_apollo'
    WHEN (k % 40) % 4 = 1 THEN 'ungeprueft' WHEN (k % 40) % 4 = 2 THEN 'kein_mx' ELSE 'mx_ok' END AS email_status,
  CASE title WHEN 'Bid Manager' THEN 'Champion - Bid/Tender' WHEN 'Referent Angebotswesen' THEN 'Champion - Bid/Tender'
    WHEN 'Systemadministrator' THEN 'Nutzer / Fuersprecher' ELSE 'Economic Buyer' END AS persona,
  CASE WHEN split_part(coalesce(mail, ''), '@', -1) = 'firma' || k % 40 || '.de' THEN 'ok'
    ELSE 'PRUEFEN: ' || split_part(coalesce(mail, ''), '@', -1) || ' vs firma' || k % 40 || '.de' END AS email_domain_abgleich,
  CASE WHEN o % 11 = 0 AND e2 IS NOT NULL THEN 'Textbaustein gibt fehlende Recherche zu: ich hoffe, konnte online wenig, nehme aber an'
    WHEN o % 11 = 0 THEN 'Textbaustein gibt fehlende Recherche zu: konnte online wenig, nehme aber an'
    WHEN e2 IS NOT NULL THEN 'Textbaustein gibt fehlende Recherche zu: ich hoffe' ELSE '' END AS copy_warnung
  FROM best b LEFT JOIN vf ON vf.m = lower(mail))"""


@query("contact_checks", f"""
WITH {CHECKED} SELECT firm AS company_id, name, coalesce(mail, '') AS email, email_status, persona, email_domain_abgleich, copy_warnung FROM ck""")
def contact_checks(spark, d):
    return prepared(spark, d).select("company_id", "name", "email", "email_status", "persona",
                                     "email_domain_abgleich", "copy_warnung")


def listed(spark, d):
    t = customer_tiers(spark, d)
    return t.select(F.concat(F.lit("firma "), "account_id").alias("company_id"), "tier", "participations_total",
                    "tier_status", "proof_type", "proof_date", "buyers_total",
                    F.concat(F.lit("https://beleg/"), "account_id").alias("proof_url"))


@query("contacts_round_robin", f"""
WITH {CHECKED}, {TIERS},
al AS (SELECT ck.*, t.tier, t.n, CASE WHEN t.tier IS NULL THEN 'NEIN - nicht zuordenbar' ELSE 'ja' END AS in_longlist
   FROM ck LEFT JOIN tiers t ON t.account_id = CAST(ck.k AS VARCHAR)),
us AS (SELECT * FROM al WHERE (SELECT count(*) FROM al WHERE email_status <> 'keine_adresse' AND in_longlist = 'ja') < 40
   OR (email_status <> 'keine_adresse' AND in_longlist = 'ja')),
rk AS (SELECT *, row_number() OVER (PARTITION BY firm ORDER BY (email_status = 'keine_adresse')::INT,
    CASE WHEN email_status = 'verifiziert_apollo' THEN 0 ELSE 1 END,
    CASE persona WHEN 'Champion - Bid/Tender' THEN 0 WHEN 'Economic Buyer' THEN 1 ELSE 2 END, name, coalesce(mail, ''), person) AS round FROM us),
ac AS (SELECT firm, row_number() OVER (ORDER BY CASE tier WHEN 'A' THEN 0 WHEN 'B' THEN 1 WHEN 'C' THEN 2 WHEN 'D' THEN 3 ELSE 9 END,
    coalesce(n, 0) DESC, firm) AS account_rank FROM rk WHERE round = 1 QUALIFY account_rank <= 40)
SELECT firm AS company_id, name, persona, email_status, tier, CAST(round AS BIGINT) AS round, account_rank FROM rk JOIN ac USING (firm) WHERE round <= 3
ORDER BY round, account_rank LIMIT 40""")
def contacts_round_robin(spark, d):
    return ops.market_contacts(prepared(spark, d), listed(spark, d)).select(
        "company_id", "name", "persona", "email_status", "tier", F.col("round").cast("long").alias("round"),
        F.col("account_rank").cast("long").alias("account_rank"))


@query("signal_contacts", f"""
WITH {CHECKED}, {TIERS},
al AS (SELECT ck.*, t.tier, t.n * 10 AS score, CASE WHEN t.tier IS NULL THEN 'NEIN - nicht zuordenbar' ELSE 'ja' END AS listed,
   coalesce(CASE WHEN t.tier IS NOT NULL THEN 'zuschlag_gewonnen' END, 'export ' || o % 3) AS signal_type,
   coalesce(CAST(t.last AS VARCHAR), '') AS signal_datum, coalesce(CASE WHEN t.tier IS NOT NULL THEN 'Satz ' || t.account_id END, 'Text ' || o % 3) AS why_now
   FROM ck LEFT JOIN tiers t ON t.account_id = CAST(ck.k AS VARCHAR) AND t.n >= 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY firm ORDER BY (email_status = 'keine_adresse')::INT,
    CASE WHEN email_status = 'verifiziert_apollo' THEN 0 ELSE 1 END,
    CASE persona WHEN 'Champion - Bid/Tender' THEN 0 WHEN 'Economic Buyer' THEN 1 ELSE 2 END, name, coalesce(mail, ''), person) AS round FROM al),
ac AS (SELECT firm, row_number() OVER (ORDER BY coalesce(score, 0) DESC, firm) AS account_rank FROM rk WHERE round = 1)
SELECT firm AS company_id, name, listed AS in_longlist_signale, signal_type, signal_datum, why_now, CAST(round AS BIGINT) AS round, account_rank
FROM rk JOIN ac USING (firm) WHERE round <= 3""")
def signal_contacts(spark, d):
    """The signal list with fallback columns from the export, for every account."""
    o = F.col("row_no")
    exports = contacts(spark, d).withColumn("signal_type", F.concat(F.lit("export "), (o % 3).cast("string"))).withColumn(
        "why_now", F.concat(F.lit("Text "), (o % 3).cast("string")))
    people = landed(ops.contact_rows(ops.merge_exports(exports), verified_mails(spark, d), mx_table(spark, d)), "contacts")
    t = customer_tiers(spark, d).filter("participations_total >= 2")
    on_list = t.select(F.concat(F.lit("firma "), "account_id").alias("company_id"), "tier", (F.col("participations_total") * 10).alias("score"),
                       F.lit("zuschlag_gewonnen").alias("signal_type"), F.col("proof_date").alias("signal_datum"),
                       F.concat(F.lit("Satz "), "account_id").alias("why_now"), F.lit(None).cast("string").alias("quell_url"),
                       F.lit(None).cast("double").alias("match_confidence"))
    got = ops.signal_contacts(people, on_list, None, None)
    return got.select("company_id", "name", "in_longlist_signale", "signal_type", "signal_datum", "why_now",
                      F.col("round").cast("long").alias("round"), F.col("account_rank").cast("long").alias("account_rank"))


@query("orphan_contacts", f"""
WITH {CONTACTS}, {TIERS} SELECT person, firm AS company_id FROM best WHERE CAST(k AS VARCHAR) NOT IN (SELECT account_id FROM tiers)""")
def orphan_contacts(spark, d):
    people = ops.merge_exports(contacts(spark, d)).withColumn("company_id", F.col("company_name"))
    return ops.orphans(people, listed(spark, d)).select("person", "company_id")


@query("qualified_leads", f"""
WITH {CHECKED}, {TIERS}
SELECT DISTINCT 'firma ' || account_id AS company_id, tier FROM tiers JOIN ck ON CAST(ck.k AS VARCHAR) = account_id
WHERE email_status = 'verifiziert_apollo' AND ck.k % 4 <> 0
  AND EXISTS (SELECT 1 FROM events e WHERE e.user_id = ck.k)""")
def qualified_leads(spark, d):
    def firm(c):
        return F.concat(F.lit("firma "), F.col(c).cast("string")).alias("company_id")
    sig = table(spark, d, "events").select(firm("user_id"))
    dom = table(spark, d, "customer").select(
        firm("c_custkey"), F.when(F.col("c_custkey") % 4 != 0, F.lit("x.de")).alias("domain"), F.lit(0.9).alias("domain_confidence"))
    return ops.qualified_leads(listed(spark, d), sig, dom, prepared(spark, d)).select("company_id", "tier")


# --- samples ----------------------------------------------------------------------------------------
@query("stratified_sample", f"""
WITH {OUTCOMES.replace("JOIN verdicts v ON v.k = p.k WHERE v.is_it", "JOIN verdicts v ON v.k = p.k")},
ex AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_shipdate::DATE - DATE '2000-01-01' BETWEEN 180 AND 270),
b AS (SELECT o_orderkey AS notice_id, o_orderdate::DATE AS d, CASE WHEN ex.k IS NOT NULL THEN 'rahmenvertrag_ablauf'
   WHEN o_orderpriority = '5-LOW' AND o_orderkey % 9 = 0 THEN 'konsortium' WHEN n.winners > 0 THEN 'zuschlag_mit_gewinner'
   WHEN n.bidders = 1 THEN 'alleinbieter' WHEN n.bidders > 1 THEN 'mehrbieter' ELSE 'rest' END AS bucket
   FROM orders LEFT JOIN per_notice n ON n.k = o_orderkey LEFT JOIN ex ON ex.k = o_orderkey)
SELECT bucket, notice_id, d, row_number() OVER (PARTITION BY bucket ORDER BY d DESC, notice_id) AS rank FROM b
QUALIFY rank <= CASE bucket WHEN 'zuschlag_mit_gewinner' THEN 60 WHEN 'alleinbieter' THEN 60 WHEN 'mehrbieter' THEN 40
  WHEN 'rahmenvertrag_ablauf' THEN 40 WHEN 'konsortium' THEN 15 ELSE 60 END""")
def stratified_sample(spark, d):
    pairs = views.parties(spark, d).groupBy("notice_id", "company_id").agg(F.max("is_winner").alias("w"))
    sizes = pairs.groupBy("notice_id").agg(F.count_if("w").alias("winners"), F.count(F.lit(1)).alias("bidders"))
    ends = table(spark, d, "lineitem").filter(within(F.to_date("l_shipdate"), as_of_lit(views.AS_OF), rules.EXPIRY_WINDOW)) \
        .select(F.col("l_orderkey").alias("notice_id"), F.lit(True).alias("expiring")).distinct()
    rows = (table(spark, d, "orders").select(F.col("o_orderkey").alias("notice_id"), F.to_date("o_orderdate").alias("d"),
                                             ((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderkey") % 9 == 0)).alias("joint"))
            .join(sizes, "notice_id", "left").join(ends, "notice_id", "left"))
    bucketed = rows.withColumn("bucket", quality.bucket_label(
        F.coalesce("expiring", F.lit(False)), F.col("joint"), F.coalesce("winners", F.lit(0)), F.coalesce("bidders", F.lit(0))))
    return quality.stratified_sample(bucketed).select("bucket", "notice_id", "d", F.col("rank").cast("long").alias("rank"))


@query("seeded_sample", """
SELECT page_id, url FROM pages ORDER BY sha256(CAST(page_id AS VARCHAR) || '|42') LIMIT 25""")
def seeded_sample(spark, d):
    return quality.seeded_sample(table(spark, d, "pages").select("page_id", "url"), F.col("page_id"), 25)


@query("head_sample", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 400")
def head_sample(spark, d):
    o = table(spark, d, "orders").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(400)
    return o.select("o_orderkey", "o_custkey")


@query("validation_sample", f"""
WITH {CHECKED}, {TIERS},
pool AS (SELECT 'markt' AS liste, ck.*, 'https://seite/' || k AS url, CASE WHEN t.tier IS NULL THEN 'NEIN - nicht zuordenbar' ELSE 'ja' END AS gelistet
    FROM ck LEFT JOIN tiers t ON t.account_id = CAST(ck.k AS VARCHAR)
  UNION ALL SELECT 'signale', ck.*, '' AS url, CASE WHEN EXISTS (SELECT 1 FROM events WHERE user_id = ck.k) THEN 'ja' ELSE 'NEIN - nicht zuordenbar' END FROM ck),
smp AS (SELECT * FROM pool ORDER BY sha256(liste || '|' || person_key || '|42') LIMIT 30),
fe AS (SELECT 'https://seite/' || c_custkey AS url, CASE WHEN c_custkey % 4 = 0 THEN 404 ELSE 200 END AS status, 900 AS bytes FROM customer),
fd AS (SELECT s.*, status, list_filter([
   CASE WHEN s.url = '' THEN 'Beleg: keine URL' WHEN status IS NULL THEN 'Beleg: nicht erreichbar' WHEN status <> 200 THEN 'Beleg: HTTP ' || status END,
   CASE WHEN gelistet <> 'ja' THEN 'Firma nicht in der Longlist zuordenbar' END,
   CASE WHEN email_status IN ('kein_mx', 'keine_adresse') THEN 'E-Mail: ' || email_status END,
   CASE WHEN email_domain_abgleich <> 'ok' THEN email_domain_abgleich END,
   CASE WHEN copy_warnung <> '' THEN 'Textqualitaet' END], lambda x: x IS NOT NULL) AS f FROM smp s LEFT JOIN fe USING (url))
SELECT liste, firm AS firma, name, CASE WHEN len(f) = 0 THEN 'keine' ELSE array_to_string(f, '; ') END AS befunde,
  CASE WHEN len(f) = 0 THEN 'ok' ELSE 'pruefen' END AS urteil FROM fd""".replace("ck AS (SELECT b.*,", "ck AS (SELECT b.*, person AS person_key,"))
def validation_sample(spark, d):
    """Seeded sample over both lists with its findings."""
    people = ops.contact_rows(ops.merge_exports(contacts(spark, d)), verified_mails(spark, d), mx_table(spark, d))
    users = table(spark, d, "events").select(F.concat(F.lit("firma "), F.col("user_id").cast("string")).alias("company_id")).distinct()
    a = ops.attach_list(people, listed(spark, d).select("company_id"), "in_longlist").withColumn(
        "proof_url", F.concat(F.lit("https://seite/"), F.substring_index("company_id", " ", -1)))
    b = ops.attach_list(people, users, "in_longlist_signale").withColumn("quell_url", F.lit(""))
    pool = ops.audit_pool(a, b)
    key = F.concat_ws("|", "liste", "person")
    sample = quality.seeded_sample(pool, key, 30)
    k = F.col("c_custkey")
    fetched = table(spark, d, "customer").select(
        F.concat(F.lit("https://seite/"), k.cast("string")).alias("url"), F.when(k % 4 == 0, 404).otherwise(200).alias("status"),
        F.lit(900).alias("bytes"), F.lit("application/pdf").alias("content_type"))
    return ops.audit_findings(sample, fetched).select("liste", "firma", "name", "befunde", "urteil")


AUDIT = """
f AS (SELECT page_id, page_id % 13 AS m, length(html) AS n FROM pages),
v AS (SELECT CASE WHEN m = 5 THEN 'unverifiable' WHEN m IN (3, 4, 6, 7, 8, 9) OR n < 500 OR n = 1309 THEN 'failed' ELSE 'ok' END AS verdict FROM f)"""


@query("audit_pass_rate", f"""
WITH {AUDIT}, t AS (SELECT count(*) AS sampled, count(*) FILTER (WHERE verdict = 'ok') AS ok,
   count(*) FILTER (WHERE verdict = 'unverifiable') AS unverifiable FROM v)
SELECT *, sampled - unverifiable AS checkable, round_even(ok::DOUBLE / (sampled - unverifiable), 4) AS rate,
  ok::DOUBLE / (sampled - unverifiable) >= 0.95 AS passed FROM t""")
def audit_pass_rate(spark, d):
    v = fetched_pages(spark, d).select(link_verdict(F.col("url"), F.col("status"), F.col("bytes"), F.col("ctype"))["verdict"].alias("verdict"))
    return quality.audit_pass_rate(v)


@query("deadline_coverage", """
WITH x AS (SELECT l_orderkey, min(l_shipdate) FILTER (WHERE l_returnflag = 'R') AS dl FROM lineitem GROUP BY 1),
t AS (SELECT count(*) AS total, count(dl) AS with_deadline FROM x)
SELECT total, with_deadline, total - with_deadline AS without_deadline,
  round_even((total - with_deadline)::DOUBLE / total, 3) AS error_rate, (total - with_deadline)::DOUBLE / total > 0.5 AS warn FROM t""")
def deadline_coverage(spark, d):
    x = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.min(F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))).alias("deadline"))
    return quality.deadline_coverage(x)


# --- source audit: documents by source, their mentions and the pages as probes ------------------------
@query("source_quota", """
WITH m AS (SELECT source, len(regexp_extract_all(text, ' (?:der|the|que|los) ')) AS n FROM documents)
SELECT source, CAST(sum(n) AS BIGINT) AS mentions, count(*) AS documents FROM m GROUP BY 1""")
def source_quota(spark, d):
    q = quality.name_quota(table(spark, d, "documents").select("source", "text"), "text",
                           " (?:der|the|que|los) ", "[0-9]|###|zung")
    return quality.name_quota_by(q, "source").select("source", "mentions", "documents")


@query("source_audit", """
WITH p AS (SELECT page_id, CASE page_id % 6 WHEN 0 THEN 403 WHEN 1 THEN 404 ELSE 200 END AS status,
   len(list_distinct(list_filter(regexp_extract_all(html, 'href="([^"]+)"', 1), lambda u: starts_with(u, '/t')))) AS links,
   page_id % 4 AS checked, (page_id % 10) / 10.0::DOUBLE AS quota FROM pages)
SELECT page_id, links, CASE WHEN status = 403 THEN 'browser_noetig' WHEN status = 404 OR links = 0 THEN 'einstieg_unklar'
  WHEN checked = 0 THEN 'text_nicht_lesbar' WHEN quota < 0.3 THEN 'zu_stark_anonymisiert' ELSE 'brauchbar' END AS urteil FROM p""")
def source_audit(spark, d):
    pages = table(spark, d, "pages")
    pid = F.col("page_id")
    hrefs = F.array_distinct(F.filter(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1)),
                                      lambda u: u.startswith("/t")))
    status = F.when(pid % 6 == 0, 403).when(pid % 6 == 1, 404).otherwise(200)
    return pages.select("page_id", F.size(hrefs).cast("long").alias("links")).withColumn(
        "urteil", source_verdict(status, F.col("links"), pid % 4, (pid % 10) / F.lit(10.0)))


@query("persona_counts", f"""
WITH {CONTACTS} SELECT CASE title WHEN 'Bid Manager' THEN 'Champion - Bid/Tender' WHEN 'Referent Angebotswesen' THEN 'Champion - Bid/Tender'
    WHEN 'Systemadministrator' THEN 'Nutzer / Fuersprecher' ELSE 'Economic Buyer' END AS persona, count(*) AS people FROM best GROUP BY 1""")
def persona_counts(spark, d):
    return ops.merge_exports(contacts(spark, d)).groupBy(persona(F.col("job_title")).alias("persona")).agg(
        F.count(F.lit(1)).alias("people"))

