"""Domain decisions, enrichment merge and lookup bookkeeping over customers and orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lotwise.functions.hosts import host_of
from lotwise.functions.text import company_key
from lotwise.functions.verdicts import to_int
from lotwise.operators import domains as ops, enrich, quality
from lotwise.plans.names import FIRMS, firm_names, sql_key
from lotwise.plans.registry import query
from lotwise.plans.signals import customer_tiers, TIERS
from lotwise.plans.views import AS_OF, table

# --- contact points: every order names its customer as a bidder with an address or two ----------


def bidder_contacts(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("d"))
    f = firm_names(spark, d).select(F.col("k").alias("o_custkey"), F.lower(F.substring_index("name", " ", 1)).alias("w"), "city")
    k = F.col("o_custkey")
    ks = k.cast("string")
    url = (F.when(k % 7 == 0, F.concat(F.lit("https://www."), "w", F.lit("-"), ks, F.lit(".de/start?x=1")))
           .when(k % 7 == 1, F.concat(F.lit("HTTP://"), "w", F.lit(".example.net:8080/")))
           .when(k % 7 == 2, F.concat(F.lit("einkauf."), F.lower(F.replace("city", F.lit("_"), F.lit("-"))), F.lit(".de")))
           .when(k % 7 == 3, F.concat(F.lit("portal"), (F.floor(k / 7) % 9).cast("string"), F.lit(".example.org")))
           .when(k % 7 == 4, F.concat(F.lit("https://"), "w", F.lit(".com")))
           .when(k % 7 == 5, F.lit("https")))
    mail = (F.when(k % 7 == 0, F.concat(F.lit("info@"), "w", F.lit("-"), ks, F.lit(".de")))
            .when(k % 7 == 1, F.concat(F.lit("a@anders"), ks, F.lit(".de")))
            .when(k % 7 == 4, F.concat(F.lit("b@"), "w", F.lit(".eu")))
            .when((k % 7 == 5) & (k % 2 == 0), F.concat(F.lit("post@fremd"), ks, F.lit(".io")))
            .when(k % 7 == 5, F.lit("post@gmail.com")))
    rows = o.join(f, "o_custkey")
    s = F.col("o_orderstatus")
    return rows.select(
        k.cast("string").alias("company_id"), F.col("o_orderkey").alias("notice_id"), "d", F.lit(0).alias("pos"),
        host_of(F.when(s != "O", url)).alias("url_host"), host_of(F.when(s != "F", mail)).alias("mail_host"))


def buyer_hosts(spark, d):
    return table(spark, d, "nation").select(
        F.concat(F.lit("einkauf."), F.lower(F.replace("n_name", F.lit("_"), F.lit("-"))), F.lit(".de")).alias("domain"))


def companies(spark, d):
    return firm_names(spark, d).select(F.col("k").cast("string").alias("company_id"), F.col("name").alias("legal_name"))


CONTACTS = f"""{FIRMS},
cw AS (SELECT k, name, lower(split_part(name, ' ', 1)) AS w, lower(replace(city, '_', '-')) AS c FROM firms),
pt AS (SELECT o_orderkey AS id, o_orderdate::DATE AS d, k, o_orderstatus AS s,
  CASE k % 7 WHEN 0 THEN w || '-' || k || '.de' WHEN 1 THEN w || '.example.net' WHEN 2 THEN 'einkauf.' || c || '.de'
    WHEN 3 THEN 'portal' || (k // 7) % 9 || '.example.org' WHEN 4 THEN w || '.com' END AS u,
  CASE WHEN k % 7 = 0 THEN w || '-' || k || '.de' WHEN k % 7 = 1 THEN 'anders' || k || '.de' WHEN k % 7 = 4 THEN w || '.eu'
    WHEN k % 7 = 5 AND k % 2 = 0 THEN 'fremd' || k || '.io' END AS m FROM orders JOIN cw ON k = o_custkey),
cand AS (SELECT k, arg_min(u, (d, id)) FILTER (WHERE s <> 'O' AND u IS NOT NULL) AS u,
   arg_min(m, (d, id)) FILTER (WHERE s <> 'F' AND m IS NOT NULL) AS m FROM pt GROUP BY k),
nm AS (SELECT f.k, f.name, u, m, [replace(x, '-', '') FOR x IN string_split({sql_key('f.name')}, ' ')] AS t
       FROM firms f LEFT JOIN cand USING (k)),
rel AS (SELECT *,
  u IS NOT NULL AND len(list_filter(t, lambda x: (length(x) >= 4 AND contains(replace(replace(u, '-', ''), '.', ''), x))
     OR (length(x) BETWEEN 2 AND 3 AND list_contains(string_split(split_part(u, '.', 1), '-'), x)))) > 0 AS ru,
  m IS NOT NULL AND len(list_filter(t, lambda x: (length(x) >= 4 AND contains(replace(replace(m, '-', ''), '.', ''), x))
     OR (length(x) BETWEEN 2 AND 3 AND list_contains(string_split(split_part(m, '.', 1), '-'), x)))) > 0 AS rm FROM nm),
claim AS (SELECT u AS dom, ru AS r FROM rel WHERE u IS NOT NULL UNION ALL SELECT m, rm FROM rel WHERE m IS NOT NULL),
spread AS (SELECT dom, count(*) AS unrelated FROM claim WHERE NOT r GROUP BY 1 HAVING count(*) >= 3),
bh AS (SELECT 'einkauf.' || lower(replace(n_name, '_', '-')) || '.de' AS dom FROM nation),
doubt AS (SELECT rel.*, array_to_string(list_filter([
   CASE WHEN u IS NOT NULL AND NOT ru AND bu.dom IS NOT NULL THEN u || ' ist eine Auftraggeberadresse' END,
   CASE WHEN u IS NOT NULL AND NOT ru AND su.dom IS NOT NULL THEN u || ' steht bei ' || su.unrelated || ' fremden Firmen' END,
   CASE WHEN m IS DISTINCT FROM u AND m IS NOT NULL AND NOT rm AND bm.dom IS NOT NULL THEN m || ' ist eine Auftraggeberadresse' END,
   CASE WHEN m IS DISTINCT FROM u AND m IS NOT NULL AND NOT rm AND sm.dom IS NOT NULL THEN m || ' steht bei ' || sm.unrelated || ' fremden Firmen' END],
   lambda x: x IS NOT NULL), '; ') AS dt, len(list_filter([u IS NOT NULL AND NOT ru AND (bu.dom IS NOT NULL OR su.dom IS NOT NULL),
   m IS NOT NULL AND NOT rm AND (bm.dom IS NOT NULL OR sm.dom IS NOT NULL)], lambda x: x)) AS nd
  FROM rel LEFT JOIN bh bu ON bu.dom = u LEFT JOIN bh bm ON bm.dom = m LEFT JOIN spread su ON su.dom = u LEFT JOIN spread sm ON sm.dom = m),
dec AS (SELECT *, CASE WHEN u IS NULL AND m IS NULL THEN 'ohne_kandidat' WHEN nd > 0 THEN 'verworfen_verdacht'
   WHEN u = m THEN 'amtlich_bestaetigt' WHEN u IS NOT NULL AND m IS NOT NULL AND ru = rm THEN 'verworfen_widerspruch'
   WHEN (u IS NOT NULL AND m IS NOT NULL) OR ru OR rm THEN 'amtlich_namensbezug' ELSE 'unter_schwelle' END AS status FROM doubt)"""


@query("domain_candidates", f"WITH {CONTACTS} SELECT CAST(k AS VARCHAR) AS company_id, u AS url_host, m AS mail_host FROM cand")
def domain_candidates(spark, d):
    return ops.first_candidates(bidder_contacts(spark, d), companies(spark, d))


def named_candidates(spark, d):
    cand = ops.first_candidates(bidder_contacts(spark, d), companies(spark, d))
    return companies(spark, d).withColumn("name_key", company_key(F.col("legal_name"))).join(cand, "company_id", "left")


@query("domain_spread", f"WITH {CONTACTS} SELECT dom AS domain, unrelated FROM spread")
def domain_spread(spark, d):
    return ops.domain_spread(ops.claims(ops.with_relation(named_candidates(spark, d))))


def decisions(spark, d):
    cand = ops.first_candidates(bidder_contacts(spark, d), companies(spark, d))
    return ops.decide_domains(companies(spark, d), cand, buyer_hosts(spark, d))


DECISION = f"""WITH {CONTACTS} SELECT CAST(k AS VARCHAR) AS company_id, name AS legal_name,
  CASE WHEN status = 'amtlich_bestaetigt' THEN u WHEN status = 'amtlich_namensbezug' THEN
     CASE WHEN u IS NOT NULL AND m IS NOT NULL AND NOT ru THEN m ELSE coalesce(u, m) END ELSE '' END AS domain,
  CASE status WHEN 'amtlich_bestaetigt' THEN 0.95 WHEN 'amtlich_namensbezug' THEN 0.90 WHEN 'unter_schwelle' THEN 0.60 END::DOUBLE AS domain_confidence,
  CASE WHEN status IN ('amtlich_bestaetigt', 'amtlich_namensbezug') THEN status WHEN status = 'unter_schwelle' THEN 'amtlich_unbestaetigt' ELSE '' END AS domain_source,
  coalesce(u, '') AS kandidat_url, coalesce(m, '') AS kandidat_mail,
  CASE status WHEN 'verworfen_verdacht' THEN dt WHEN 'verworfen_widerspruch' THEN 'url und Mail widersprechen sich, Namensbezug entscheidet nicht'
    WHEN 'unter_schwelle' THEN 'kein Namensbezug, Einzelquelle - unter Schwelle' ELSE '' END AS befund, status FROM dec"""


@query("domain_decision", DECISION)
def domain_decision(spark, d):
    return decisions(spark, d)


@query("domain_findings", f"SELECT * EXCLUDE (status) FROM ({DECISION}) WHERE status <> 'ohne_kandidat'")
def domain_findings(spark, d):
    return ops.domain_findings(decisions(spark, d))


@query("domain_statistics", f"""WITH {CONTACTS} SELECT status, count(*) AS companies FROM dec GROUP BY 1
UNION ALL SELECT 'buyer_domains_bekannt', count(DISTINCT dom) FROM bh UNION ALL SELECT 'gestreute_domains', count(*) FROM spread""")
def domain_statistics(spark, d):
    spread = ops.domain_spread(ops.claims(ops.with_relation(named_candidates(spark, d))))
    return ops.domain_statistics(decisions(spark, d), buyer_hosts(spark, d), spread)


# --- enrichment: every order is one record of an export, later rows win ---------------------------
def market_rows(spark, d):
    """Customers with a tier as a market list; two of three already hold a domain."""
    k = F.col("company_id").cast("long")
    tiers = customer_tiers(spark, d).withColumnRenamed("account_id", "company_id")
    w = F.lower(F.substring_index("legal_name", " ", 1))
    return companies(spark, d).join(tiers, "company_id").select(
        "*", F.when(k % 3 == 0, F.concat(w, F.lit("-"), k.cast("string"), F.lit(".de")))
        .when(k % 3 == 1, F.concat(w, k.cast("string"), F.lit(".com"))).alias("domain"),
        F.when(k % 3 == 0, F.lit("amtlich_bestaetigt")).when(k % 3 == 1, F.lit("enrichment")).alias("domain_source"),
        F.when(k % 3 == 0, F.lit(0.95)).when(k % 3 == 1, F.lit(0.65)).alias("domain_confidence"),
        F.lit(None).cast("long").alias("employees"), F.lit("").alias("employees_scope"),
        company_key(F.col("legal_name")).alias("name_id"))


def enrichment_records(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("k"), "o_orderstatus", "o_totalprice", "o_orderpriority")
    f = firm_names(spark, d).select("k", "name", "city", F.lower(F.substring_index("name", " ", 1)).alias("w"))
    k, s, p = F.col("k"), F.col("o_orderstatus"), F.col("o_orderpriority")
    dom = (F.when(k % 2 == 0, F.concat("w", F.lit("-"), k.cast("string"), F.lit(".de")))
           .otherwise(F.concat("w", k.cast("string"), F.lit(".com"))))
    size = F.when(k % 4 != 3, F.floor(F.col("o_totalprice") / 150).cast("long").cast("string"))
    return o.join(f, "k").select(
        F.when((s == "F") & (k % 5 != 0), k.cast("string")).alias("company_id"),
        F.when(s == "P", F.col("name")).alias("legal_name"), F.when((s != "F") | (k % 2 == 0), dom).alias("domain"),
        to_int(size).alias("employees"), F.when(p == "1-URGENT", F.col("city")).alias("country"), "city",
        F.lit(None).cast("string").alias("matched_name"), F.lit(None).cast("string").alias("industry"),
        F.lit(None).cast("string").alias("linkedin"), F.when(p == "2-HIGH", F.lit("clay_ai")).alias("domain_source"),
        F.when(p == "3-MEDIUM", F.lit("0.5")).alias("domain_confidence"), F.col("o_orderkey").alias("row_no"))


def matched(spark, d):
    return enrich.match_enrichment(market_rows(spark, d), enrichment_records(spark, d))


ENRICH = f"""{FIRMS}, {TIERS},
mk AS (SELECT CAST(k AS VARCHAR) AS company_id, k, name, lower(split_part(name, ' ', 1)) AS w, {sql_key('name')} AS nkey, t.tier, t.n, t.last FROM firms
       JOIN tiers t ON t.account_id = CAST(k AS VARCHAR)),
mk2 AS (SELECT *, CASE k % 3 WHEN 0 THEN w || '-' || k || '.de' WHEN 1 THEN w || k || '.com' END AS dom,
   CASE k % 3 WHEN 0 THEN 'amtlich_bestaetigt' WHEN 1 THEN 'enrichment' END AS src,
   CASE k % 3 WHEN 0 THEN 0.95 WHEN 1 THEN 0.65 ELSE 0.70 END AS rk FROM mk),
rec AS (SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' AND o_custkey % 5 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS cid,
   CASE WHEN o_orderstatus = 'P' THEN f.name END AS lname,
   CASE WHEN o_orderstatus <> 'F' OR o_custkey % 2 = 0 THEN CASE WHEN o_custkey % 2 = 0 THEN lower(split_part(name, ' ', 1)) || '-' || k || '.de'
        ELSE lower(split_part(name, ' ', 1)) || k || '.com' END END AS rdom,
   CASE WHEN k % 4 <> 3 THEN CAST(floor(o_totalprice / 150) AS BIGINT) END AS emp,
   CASE WHEN o_orderpriority = '1-URGENT' THEN city END AS country,
   CASE WHEN o_orderpriority = '2-HIGH' THEN 'clay_ai' END AS rsrc, CASE WHEN o_orderpriority = '3-MEDIUM' THEN '0.5' END AS rconf
   FROM orders JOIN firms f ON k = o_custkey),
byid AS (SELECT * FROM rec WHERE cid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY cid ORDER BY id DESC) = 1),
byname AS (SELECT *, {sql_key('lname')} AS rkey FROM rec WHERE lname IS NOT NULL
           QUALIFY row_number() OVER (PARTITION BY {sql_key('lname')} ORDER BY id DESC) = 1),
bydom AS (SELECT * FROM rec WHERE rdom IS NOT NULL QUALIFY row_number() OVER (PARTITION BY rdom ORDER BY id DESC) = 1),
jn AS (SELECT m.*, CASE WHEN a.id IS NOT NULL THEN 'id' WHEN b.id IS NOT NULL THEN 'name' WHEN c.id IS NOT NULL THEN 'domain' END AS matched_by,
   coalesce(a.id, b.id, c.id) AS rid FROM mk2 m LEFT JOIN byid a ON a.cid = m.company_id LEFT JOIN byname b ON b.rkey = m.{{name_key}}
   LEFT JOIN bydom c ON c.rdom = m.dom),
rr AS (SELECT jn.*, rdom, emp, country, rsrc, rconf, lname,
   least(CASE rsrc WHEN 'clay_ai' THEN 0.55 ELSE 0.70 END, coalesce(CAST(rconf AS DOUBLE), 1.0)) AS offer FROM jn LEFT JOIN rec ON rec.id = jn.rid),
act AS (SELECT *, CASE WHEN rdom IS NULL THEN NULL WHEN rdom = dom THEN 'domain_bestaetigt'
   WHEN dom IS NULL OR offer >= rk THEN 'domain_uebernommen' ELSE 'domain_bessere_behalten' END AS domain_action,
   list_filter([CASE WHEN country IS NOT NULL THEN 'Sitz ' || country || ', Zuschlag ging an deutschen Rechtstraeger' END,
     CASE WHEN emp > 2000 THEN emp || ' MA liegt ueber der ICP-Oberkante 2000' END], lambda x: x IS NOT NULL) AS fl FROM rr),
fin AS (SELECT *, CASE WHEN rid IS NULL OR emp IS NULL THEN NULL WHEN len(fl) = 0 THEN 'mitarbeiterzahl_nutzbar' ELSE 'mitarbeiterzahl_verworfen' END AS employees_action FROM act)"""
ENRICH_BY_NAME = ENRICH.replace("{name_key}", "nkey")


def keyed_records(spark, d):
    """Enrichment records with the name key as company id."""
    keyed = firm_names(spark, d).select(F.col("k").cast("string").alias("company_id"), company_key(F.col("name")).alias("key"))
    # Records without an id find none; under a key of their own they do not all meet in one task.
    wanted = F.coalesce("company_id", F.concat(F.lit("row "), F.col("row_no").cast("string")))
    return (enrichment_records(spark, d).withColumn("company_id", wanted).join(keyed, "company_id", "left")
            .withColumn("company_id", F.col("key")).drop("key"))


def merged(spark, d):
    """The name key is offered as company id, as in a real market list whose id is that key."""
    market = market_rows(spark, d).withColumn("customer", F.col("company_id")).withColumn("company_id", F.col("name_id"))
    # Several customers may share a name key; the market list keeps the first of them.
    market = market.groupBy("company_id").agg(F.min_by(F.struct(*[c for c in market.columns if c != "company_id"]),
                                                       F.col("customer").cast("long")).alias("m")).select("company_id", "m.*")
    return enrich.merge_enrichment(market, keyed_records(spark, d), AS_OF + dt.timedelta(days=180))


MERGED = (ENRICH.replace("{name_key}", "nkey")
          .replace("m.company_id LEFT JOIN byname", "m.nkey LEFT JOIN byname")
          .replace("mk2 AS (SELECT *,", "mk2 AS (SELECT * EXCLUDE (rn),", 1)
          .replace("CASE k % 3 WHEN 0 THEN 0.95 WHEN 1 THEN 0.65 ELSE 0.70 END AS rk FROM mk)",
                   "CASE k % 3 WHEN 0 THEN 0.95 WHEN 1 THEN 0.65 ELSE 0.70 END AS rk FROM "
                   "(SELECT *, row_number() OVER (PARTITION BY nkey ORDER BY k) AS rn FROM mk) WHERE rn = 1)")
          .replace("byid AS (SELECT * FROM rec WHERE cid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY cid ORDER BY id DESC) = 1)",
                   f"byid AS (SELECT rec.* EXCLUDE (cid), {sql_key('f2.name')} AS cid FROM rec JOIN firms f2 ON CAST(f2.k AS VARCHAR) = rec.cid "
                   f"QUALIFY row_number() OVER (PARTITION BY {sql_key('f2.name')} ORDER BY id DESC) = 1)"))


@query("enrich_priority", f"""
WITH {MERGED}
SELECT nkey AS company_id, matched_by, CASE WHEN domain_action = 'domain_uebernommen' THEN rdom ELSE dom END AS domain,
  CASE WHEN domain_action = 'domain_uebernommen' THEN coalesce(rsrc, 'enrichment') ELSE src END AS domain_source,
  CASE WHEN employees_action = 'mitarbeiterzahl_nutzbar' THEN emp END AS employees, domain_action, employees_action,
  CASE WHEN domain_action = 'domain_bessere_behalten' THEN rdom || ' verworfen, ' || dom || ' (' || coalesce(src, '') || ') ist besser belegt' ELSE '' END AS domain_note,
  CASE WHEN rid IS NULL THEN '' WHEN employees_action = 'mitarbeiterzahl_verworfen' THEN array_to_string(fl, ' | ') || ' | gemeldeter Wert: ' || emp
       ELSE array_to_string(fl, ' | ') END AS employees_note FROM fin""")
def enrich_priority(spark, d):
    return merged(spark, d).select("company_id", "matched_by", "domain", "domain_source", "employees", "domain_action",
                                   "employees_action", "domain_note", "employees_note")


@query("merge_statistics", f"""
WITH {MERGED}
SELECT count(*) FILTER (WHERE matched_by IS NOT NULL) AS gematcht, count(*) FILTER (WHERE matched_by IS NULL) AS ohne_treffer,
  count(*) FILTER (WHERE domain_action = 'domain_bestaetigt') AS domain_bestaetigt,
  count(*) FILTER (WHERE domain_action = 'domain_uebernommen') AS domain_uebernommen,
  count(*) FILTER (WHERE domain_action = 'domain_bessere_behalten') AS domain_bessere_behalten,
  count(*) FILTER (WHERE employees_action = 'mitarbeiterzahl_nutzbar') AS mitarbeiterzahl_nutzbar,
  count(*) FILTER (WHERE employees_action = 'mitarbeiterzahl_verworfen') AS mitarbeiterzahl_verworfen,
  count(*) FILTER (WHERE tier <> CASE WHEN n >= 3 AND DATE '2000-06-29' - last <= 180 THEN 'A'
     WHEN n >= 2 OR DATE '2000-06-29' - last <= 180 THEN 'B' ELSE 'C' END) AS tier_geaendert_durch_alterung,
  count(*) FILTER (WHERE dom IS NOT NULL OR domain_action = 'domain_uebernommen') AS mit_domain FROM fin""")
def merge_statistics(spark, d):
    return enrich.merge_statistics(merged(spark, d))


# --- landed lookups ---------------------------------------------------------------------------------
def landed_domains(spark, d):
    k = F.col("company_id").cast("long")
    dec = decisions(spark, d)
    return dec.filter(F.col("status") != ops.NO_CANDIDATE).select(
        "company_id", F.nullif("domain", F.lit("")).alias("domain"), F.col("domain_confidence").alias("confidence"),
        (k % 2 + 1).cast("int").alias("stage"), F.col("befund").alias("note"))


@query("still_to_do", f"""
WITH {CONTACTS} SELECT CAST(k AS VARCHAR) AS company_id FROM dec WHERE status = 'ohne_kandidat'""")
def still_to_do(spark, d):
    return enrich.still_to_do(companies(spark, d), landed_domains(spark, d), "company_id")


@query("lookup_cost", f"""
WITH {CONTACTS}, t AS (SELECT count(*) FILTER (WHERE status <> 'ohne_kandidat') AS looked_up,
  count(*) FILTER (WHERE status IN ('amtlich_bestaetigt', 'amtlich_namensbezug')) AS resolved, count(*) AS companies FROM dec)
SELECT companies, looked_up, resolved, companies - looked_up AS open_lookups, resolved * 3 AS contact_searches,
  resolved * 3 AS contact_matches, resolved * 7 AS credit_ceiling FROM t""")
def lookup_cost(spark, d):
    return enrich.lookup_cost(companies(spark, d), landed_domains(spark, d))


@query("account_report", f"""
WITH {CONTACTS}, {TIERS}, r AS (SELECT CAST(k AS VARCHAR) AS company_id, name, k, status,
   CASE WHEN status = 'amtlich_bestaetigt' THEN u WHEN status = 'amtlich_namensbezug' THEN
     CASE WHEN u IS NOT NULL AND m IS NOT NULL AND NOT ru THEN m ELSE coalesce(u, m) END END AS domain FROM dec WHERE status <> 'ohne_kandidat'),
fm AS (SELECT domain, max(k) * 3 AS employees FROM r WHERE domain IS NOT NULL GROUP BY 1)
SELECT r.company_id, CASE WHEN t.tier IS NULL THEN '' ELSE name END AS legal_name, r.domain, CAST(k % 2 + 1 AS INTEGER) AS domain_stage, fm.employees, t.tier
FROM r LEFT JOIN fm USING (domain) LEFT JOIN tiers t ON t.account_id = r.company_id""")
def account_report(spark, d):
    dom = landed_domains(spark, d)
    firmo = dom.filter("domain IS NOT NULL").groupBy("domain").agg(
        (F.max(F.col("company_id").cast("long")) * 3).alias("employees")).select(
        "domain", "employees", F.lit("IT").alias("industry"), F.array(F.lit("541512")).alias("naics"),
        F.lit(None).cast("string").alias("phone"), F.lit(None).cast("string").alias("city"), F.lit("Germany").alias("country"))
    market = market_rows(spark, d).withColumn("awards_total", F.lit(0)).withColumn("proof_url", F.lit(""))
    return enrich.account_report(dom, firmo, market).select(
        "company_id", "legal_name", "domain", "domain_stage", "employees", "tier")


@query("volume_by_body", f"""
WITH {FIRMS}, b AS (SELECT regexp_replace({sql_key('name')}, ' x[0-9]+$', '') AS body, o_orderkey FROM firms JOIN orders ON o_custkey = k)
SELECT body, count(*) AS volume FROM b GROUP BY 1""")
def volume_by_body(spark, d):
    """Procedures per body after its name variants are brought together."""
    body = firm_names(spark, d).select("k", F.regexp_replace(company_key(F.col("name")), " x[0-9]+$", "").alias("body"))
    per_firm = table(spark, d, "orders").select(F.col("o_custkey").alias("k"))
    return quality.volume_by_normal_name(per_firm.join(body, "k"), F.col("body"))
