"""Company keys, consortium members, name rules, blocked matching and text rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lotwise import rules
from lotwise.functions import text as tx
from lotwise.functions.verdicts import head_count_scope, link_verdict, persona, text_flags, to_int, verify_candidate, \
    verify_imprint
from lotwise.functions.hosts import domain_stem, host_of, name_matches_domain, tld_of
from lotwise.operators import matching, quality
from lotwise.plans.registry import query
from lotwise.plans.views import table
from lotwise.session import dealt, landed

# Names made of each customer's own fields, dressed like the names in notices.
WORDS = ["Daten", "Netz", "Cloud", "Systeme", "Büro - Technik", "Software", "Consulting"]
AREAS = ["Nord", "Süd", "Ost", "Wést", "Mitte"]
FORMS = ["GmbH", "AG", "GmbH & Co. KG", "e.K.", "", "SE & Co. KGaA", "OHG", "mbH", "UG", "gGmbH", "Ltd."]
DRESS = [
    "{n}", "ARGE {n} / Partnerhaus {k} GmbH", "Mitglied 2: {n}", "Bietergemeinschaft {n} und Nebenhaus {k} AG",
    "{n}", "Keine Angabe - mehrere Lose", "{n}", "Nagel {n}", "{n}, Dataport", "Auftragnehmer", "KDO {n}",
    "Software AG", "{n}\nPasteurstr. {k}", "na",
]


def _pick(key: Column, values: list[str], step: int = 1) -> Column:
    return F.get(F.array(*map(F.lit, values)), (F.floor(key / step) % len(values)).cast("int"))


def firm_names(spark, d):
    """(k, name, dressed, city, postal_code) per customer.

    The rows are few bytes and long work, so they are dealt over all tasks first; a customer file makes only a task or two.
    """
    c, n = dealt(table(spark, d, "customer"), "c_custkey"), table(spark, d, "nation")
    k = F.col("c_custkey")
    base = c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
    name = F.concat_ws(" ", F.initcap(F.lower("c_mktsegment")), "n_name", _pick(k, WORDS), _pick(k, AREAS, 7),
                       F.concat(F.lit("x"), F.floor(k / 20).cast("string")), F.nullif(_pick(k, FORMS), F.lit("")))
    dressed = F.get(F.array(*[_dress(t, name, k) for t in DRESS]), (k % len(DRESS)).cast("int"))
    return base.select(k.alias("k"), name.alias("name"), dressed.alias("dressed"), F.col("n_name").alias("city"),
                       F.format_string("%02d000", F.col("c_nationkey")).alias("postal_code"))


def _dress(template: str, name: Column, k: Column) -> Column:
    out, rest = [], template
    for token, col in (("{n}", name), ("{k}", k.cast("string"))):
        if token in rest:
            head, rest = rest.split(token, 1)
            out += [F.lit(head), col]
    return F.concat(*out, F.lit(rest))


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def sql_fold(x: str) -> str:
    return (f"strip_accents(replace(replace(replace(replace(lower(trim({x})), 'ä', 'ae'), 'ö', 'oe'), "
            f"'ü', 'ue'), 'ß', 'ss'))")


def sql_key(x: str) -> str:
    """Company key in SQL: a fold over the legal forms instead of a chain of patterns."""
    flat = (f"trim(regexp_replace(regexp_replace(replace({sql_fold(x)}, '&', ' und '), "
            f"'[.,\"''`()\\[\\]]', ' ', 'g'), '\\s+', ' ', 'g'))")
    forms = _sql_list(" ".join(f.replace("&", " und ").replace(".", " ").split()) for f in rules.LEGAL_FORMS)
    stripped = (f"list_reduce({forms}, lambda a, f: CASE WHEN ends_with(a, ' ' || f) "
                f"THEN a[1:length(a) - length(f) - 1] ELSE a END, {flat})")
    return f"regexp_replace({stripped}, '\\s*-\\s*', '-', 'g')"


def _sql_dress() -> str:
    cases = []
    for t in DRESS:
        s = "'" + t.replace("\n", "' || chr(10) || '").replace("{n}", "' || name || '").replace("{k}", "' || k || '") + "'"
        cases.append(s)
    return f"[{', '.join(cases)}][CAST(k % {len(DRESS)} AS INTEGER) + 1]"


FIRMS = f"""
base AS (SELECT c_custkey AS k, concat_ws(' ', upper(c_mktsegment[1]) || lower(c_mktsegment[2:]), n_name,
           {_sql_list(WORDS)}[CAST(c_custkey % 7 AS INTEGER) + 1],
           {_sql_list(AREAS)}[CAST((c_custkey // 7) % 5 AS INTEGER) + 1], 'x' || (c_custkey // 20),
           nullif({_sql_list(FORMS)}[CAST(c_custkey % 11 AS INTEGER) + 1], '')) AS name,
         n_name AS city, printf('%02d000', c_nationkey) AS postal_code
         FROM customer JOIN nation ON n_nationkey = c_nationkey),
firms AS (SELECT *, {_sql_dress()} AS dressed FROM base)"""
SQL_ROLE = r"regexp_replace({x}, '(?i)^\s*(?:mitglied|bieter|los|teilnehmer|partner|nr\.?)\s*\d*\s*[:\-]\s*', '')"
SQL_CLEAN = "trim(" + SQL_ROLE.format(x="split_part(dressed, chr(10), 1)") + ")"


@query("company_key", f"""
WITH {FIRMS}
SELECT k AS custkey, {sql_fold('dressed')} AS folded, {sql_key('name')} AS company_id,
  array_to_string(string_split({sql_key('name')}, ' ')[1:2], '-') || '|' || postal_code[1:2] AS block FROM firms""")
def company_key(spark, d):
    key = tx.company_key(F.col("name"))
    return firm_names(spark, d).select(
        F.col("k").alias("custkey"), tx.fold(F.col("dressed")).alias("folded"), key.alias("company_id"),
        tx.blocking_key(key, F.col("postal_code")).alias("block"))


MEMBERS = f"""
cleaned AS (SELECT k, {SQL_CLEAN} AS raw FROM firms),
flagged AS (SELECT k, raw, list_bool_or([contains(' ' || {sql_fold('raw')} || ' ', m)
              FOR m IN {_sql_list(rules.CONSORTIUM_MARKERS)}]) AS joint FROM cleaned),
parts AS (SELECT k, raw, joint, list_filter([trim(p, ' -,;') FOR p IN string_split_regex(
            regexp_replace(raw, '(?i)\\b(?:arge|arbeitsgemeinschaft|bietergemeinschaft|konsortium|consortium)\\b[:\\-]?', ' ', 'g'),
            '(?i)\\s*(?:\\+|/|;|\\bund\\b|\\bu\\.\\b|&amp;)\\s*')], lambda p: length(p) > 2) AS ps FROM flagged),
members AS (SELECT k, joint, unnest(CASE WHEN joint AND len(ps) > 0 THEN ps ELSE [raw] END) AS member FROM parts)"""


@query("consortium_members", f"""
WITH {FIRMS}, {MEMBERS}
SELECT k AS custkey, joint AS is_consortium, member, {sql_key('member')} AS company_id FROM members""")
def consortium_members(spark, d):
    raw = tx.clean_name(F.col("dressed"))
    return (firm_names(spark, d).select(F.col("k").alias("custkey"), tx.is_consortium(raw).alias("is_consortium"),
                                        F.explode(tx.consortium_members(raw)).alias("member"))
            .withColumn("company_id", tx.company_key(F.col("member"))))


def _sql_exclusion() -> str:
    cases = []
    for reason in rules.EXCLUSIONS:
        tests = []
        for r, entry, mode in tx.exclusion_modes():
            if r == reason:
                tests.append({"exact": f"key = '{entry}'", "token": f"regexp_matches(key, '(^|[^0-9a-z]){entry}($|[^0-9a-z])')",
                              "substring": f"contains(key, '{entry}')"}[mode])
        cases.append(f"WHEN {' OR '.join(tests)} THEN '{reason}'")
    return " ".join(cases)


JUNK = f"""CASE WHEN length(raw) < 3 THEN 'zu kurz'
  WHEN length(raw) > 120 THEN 'laenger als 120 Zeichen - vermutlich Freitext'
  WHEN raw_key = '' THEN 'nach Normalisierung leer'
  WHEN list_contains({_sql_list(rules.JUNK_EXACT)}, raw_key) THEN 'Rollenbezeichnung statt Firmierung'
  WHEN len(list_filter({_sql_list(rules.JUNK_PREFIXES)}, lambda p: regexp_matches(raw_key, '^' || p || '($|[^0-9a-z])'))) > 0
    THEN 'Platzhaltertext statt Firmierung'
  WHEN len(list_filter({_sql_list(rules.JUNK_MARKERS)}, lambda m: contains({sql_fold('raw')}, m))) > 0
    THEN 'Satzbaustein aus der Bekanntmachung statt Firmierung' END"""


@query("name_exclusion", f"""
WITH {FIRMS}, named AS (SELECT k, dressed, trim({SQL_ROLE.format(x='dressed')}) AS raw FROM firms),
keyed AS (SELECT k, dressed, raw, {sql_key('raw')} AS raw_key, {sql_key('dressed')} AS key FROM named),
judged AS (SELECT k, key, {JUNK} AS junk FROM keyed)
SELECT k AS custkey, CASE WHEN junk IS NOT NULL THEN 'kein Firmenname: ' || junk {_sql_exclusion()} END AS reason
FROM judged""")
def name_exclusion(spark, d):
    return firm_names(spark, d).select(
        F.col("k").alias("custkey"), tx.exclusion_reason(F.col("dressed")).alias("reason"))


@query("block_match", f"""
WITH {FIRMS}, keyed AS (SELECT DISTINCT {sql_key('name')} AS key,
   array_to_string(string_split({sql_key('name')}, ' ')[1:2], '-') || '|' || postal_code[1:2] AS block FROM firms),
toks AS (SELECT key, block, list_distinct(string_split(key, ' ')) AS t FROM keyed),
scored AS (SELECT a.block, a.key AS key_a, b.key AS key_b,
   len(list_intersect(a.t, b.t))::DOUBLE / len(list_distinct(list_concat(a.t, b.t))) AS score
   FROM toks a JOIN toks b ON a.block = b.block AND a.key < b.key)
SELECT block, key_a, key_b, round_even(score, 6) AS score FROM scored WHERE score >= 0.6 - 1e-9""")
def block_match(spark, d):
    keyed = landed(matching.keyed_names(firm_names(spark, d)), "names")
    return matching.pairs_once(keyed, 0.6, digits=6)


@query("best_match", f"""
WITH {FIRMS}, keyed AS (SELECT DISTINCT {sql_key('name')} AS key,
   array_to_string(string_split({sql_key('name')}, ' ')[1:2], '-') || '|' || postal_code[1:2] AS block FROM firms),
toks AS (SELECT key, block, list_distinct(string_split(key, ' ')) AS t FROM keyed),
scored AS (SELECT a.block, a.key AS key_a, b.key AS key_b,
   len(list_intersect(a.t, b.t))::DOUBLE / len(list_distinct(list_concat(a.t, b.t))) AS score
   FROM toks a JOIN toks b ON a.block = b.block AND a.key <> b.key)
SELECT block, key_a, key_b, round_even(score, 6) AS score FROM scored WHERE score >= 0.6 - 1e-9
QUALIFY row_number() OVER (PARTITION BY block, key_a ORDER BY scored.score DESC, key_b) = 1""")
def best_match(spark, d):
    keyed = landed(matching.keyed_names(firm_names(spark, d)), "names")
    return matching.best_match(keyed, keyed, 0.6).withColumn("score", F.bround("score", 6))


TITLES = ["Bid Manager (m/w/d)", "Strategischer Einkäufer IT", "Referent Ausschreibungen", "Sachbearbeiter",
          "Vergabemanager Beschaffung"]
JOBS = ["Tender-Manager/in", "Kaufmann/-frau", "Vergabestelle"]


def _sql_first(lists) -> str:
    return " ".join(f"WHEN contains(hay, '{e}') THEN '{p}{e}'" for p, es in lists for e in es)


@query("job_relevance", f"""
WITH t AS (SELECT o_orderkey, {sql_fold(_sql_list(TITLES) + '[CAST(substr(o_orderpriority, 1, 1) AS INTEGER)]')} || ' ' ||
   {sql_fold(_sql_list(JOBS) + "[CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END]")} AS hay FROM orders)
SELECT o_orderkey, CASE {_sql_first([('exclude:', rules.JOB_EXCLUDE), ('include:', rules.JOB_INCLUDE)])}
  ELSE 'no_match' END AS rule FROM t""")
def job_relevance(spark, d):
    title = F.get(F.array(*map(F.lit, TITLES)), F.substring("o_orderpriority", 1, 1).cast("int") - 1)
    job = (F.when(F.col("o_orderstatus") == "F", JOBS[0]).when(F.col("o_orderstatus") == "O", JOBS[1])
           .otherwise(JOBS[2]))
    return table(spark, d, "orders").select("o_orderkey", tx.job_title_rule(title, job).alias("rule"))


CHAMPION, BUYER = ["gear", "bolt"], ["widget", "economy"]


@query("persona_class", f"""
WITH t AS (SELECT p_partkey, lower(p_name || ' ' || p_type) AS t FROM part)
SELECT p_partkey, CASE WHEN contains(t, 'gear') OR contains(t, 'bolt') THEN 'Champion - Bid/Tender'
  WHEN contains(t, 'widget') OR contains(t, 'economy') THEN 'Economic Buyer' ELSE 'Nutzer / Fuersprecher' END AS persona
FROM t""")
def persona_class(spark, d):
    return table(spark, d, "part").select("p_partkey", persona(
        F.concat_ws(" ", "p_name", "p_type"), CHAMPION, BUYER).alias("persona"))


FLAGS = ["token =", "@mail", "für die", " the that ", "license", "ñ"]


@query("text_flags", f"""
WITH h AS (SELECT doc_id, list_sort(list_filter({_sql_list(FLAGS)}, lambda f: contains(lower(text), f))) AS hits FROM documents)
SELECT doc_id, array_to_string(hits, ', ') AS flags, len(hits) AS n_flags FROM h WHERE len(hits) > 0""")
def flagged_texts(spark, d):
    hits = text_flags(F.col("text"), FLAGS)
    return (table(spark, d, "documents").select("doc_id", hits.alias("h")).filter(F.size("h") > 0)
            .select("doc_id", F.array_join("h", ", ").alias("flags"), F.size("h").cast("long").alias("n_flags")))


SQL_TEXT = (r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', ' ', 'g'), "
            r"'(?is)<style[^>]*>.*?</style>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g'), '[\s\x{00A0}\x{2000}-\x{200A}\x{202F}\x{3000}]+', ' ', 'g')")


@query("page_text", f"SELECT page_id, {SQL_TEXT} AS text FROM pages")
def page_text(spark, d):
    return table(spark, d, "pages").select("page_id", tx.html_text(F.col("html")).alias("text"))


@query("page_links", r"""
WITH l AS (SELECT page_id, url, list_distinct([
    CASE WHEN starts_with(u, '/') THEN regexp_extract(url, '^https?://[^/]+') || u ELSE u END
    FOR u IN list_filter([replace(x, '&amp;', '&') FOR x IN regexp_extract_all(html, 'href="([^"]+)"', 1)],
                         lambda u: regexp_matches(u, '^/[A-Zt]'))]) AS links FROM pages)
SELECT page_id, u AS link FROM (SELECT page_id, unnest(links) AS u FROM l) WHERE starts_with(u, 'http')""")
def page_links(spark, d):
    base = F.regexp_extract("url", "^https?://[^/]+", 0)
    return table(spark, d, "pages").select("page_id", F.explode(
        tx.decision_links(F.col("html"), base, "^/[A-Zt]")).alias("link"))


@query("host_of", r"""
WITH v AS (SELECT page_id, url AS field, 'url' AS kind FROM pages
           UNION ALL SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+')), 'mail' FROM documents),
h AS (SELECT page_id AS id, kind, trim(regexp_replace(split_part(regexp_replace(regexp_replace(regexp_replace(lower(trim(field)),
        '^[a-z][a-z0-9+.-]*://', ''), '^.*@', ''), '[/?#].*$', ''), ':', 1), '^www\.', ''), '. ') AS host FROM v)
SELECT id, kind, host, regexp_extract(host, '([^.]+)\.[^.]+$', 1) AS stem, regexp_extract(host, '[^.]+$') AS tld FROM h
WHERE regexp_matches(host, '^(?:[a-z0-9](?:[a-z0-9-]*[a-z0-9])?\.)+[a-z]{2,}$')
  AND host NOT IN ('gmail.com','web.de','gmx.de','example.com','example.de','test.de')""")
def hosts(spark, d):
    urls = table(spark, d, "pages").select(F.col("page_id").alias("id"), F.col("url").alias("field"), F.lit("url").alias("kind"))
    mails = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.explode(F.regexp_extract_all(
        "text", F.lit("[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+"), F.lit(0))).alias("field"), F.lit("mail").alias("kind"))
    host = host_of(F.col("field"))
    return urls.unionByName(mails).select("id", "kind", host.alias("host")).filter("host IS NOT NULL").select(
        "id", "kind", "host", domain_stem(F.col("host")).alias("stem"), tld_of(F.col("host")).alias("tld"))


@query("name_domain_relation", f"""
WITH {FIRMS}, keyed AS (SELECT k, {sql_key('name')} AS key, lower(split_part(name, ' ', 1)) || '-' || (k % 9) ||
    CASE k % 3 WHEN 0 THEN '.netz-werk.de' WHEN 1 THEN '.com' ELSE '.cloud.eu' END AS dom FROM firms),
t AS (SELECT *, replace(replace(dom, '-', ''), '.', '') AS flat, string_split(split_part(dom, '.', 1), '-') AS labels,
   [replace(x, '-', '') FOR x IN string_split(key, ' ')] AS toks FROM keyed)
SELECT k AS custkey, dom AS domain, len(list_filter(toks, lambda x: (length(x) >= 4 AND contains(flat, x))
   OR (length(x) BETWEEN 2 AND 3 AND list_contains(labels, x)))) > 0 AS related FROM t""")
def name_domain_relation(spark, d):
    k = F.col("k")
    tail = F.get(F.array(F.lit(".netz-werk.de"), F.lit(".com"), F.lit(".cloud.eu")), (k % 3).cast("int"))
    dom = F.concat(F.lower(F.substring_index("name", " ", 1)), F.lit("-"), (k % 9).cast("string"), tail)
    return firm_names(spark, d).select(k.alias("custkey"), dom.alias("domain")
                                       , name_matches_domain(tx.company_key(F.col("name")), dom).alias("related"))


@query("headcount_scope", f"""
WITH {FIRMS}, raw AS (SELECT k, name, CASE k % 5 WHEN 0 THEN '1.' || printf('%03d', k % 1000) WHEN 1 THEN (k % 90 + 10) || '-' || (k % 90 + 210)
     WHEN 2 THEN '10.000+' WHEN 3 THEN (k % 700) || '.0' ELSE 'k.A.' END AS txt,
   CASE k % 3 WHEN 0 THEN 'Germany' WHEN 1 THEN city ELSE NULL END AS country,
   CASE WHEN k % 4 = 0 THEN 'Holding ' || name ELSE name END AS found FROM firms),
num AS (SELECT *, CASE k % 5 WHEN 0 THEN 1000 + k % 1000 WHEN 1 THEN nullif((k % 90 + 10 + k % 90 + 210) // 2, 0)
   WHEN 2 THEN 10000 WHEN 3 THEN k % 700 END AS employees FROM raw),
f AS (SELECT *, list_filter([
   CASE WHEN country IS NOT NULL AND lower(country) <> 'germany' THEN 'Sitz ' || country || ', Zuschlag ging an deutschen Rechtstraeger' END,
   CASE WHEN employees > 2000 THEN employees || ' MA liegt ueber der ICP-Oberkante 2000' END,
   CASE WHEN k % 4 = 0 THEN 'Name weicht ab: ''' || found || ''' vs. Zuschlag ''' || name || '''' END],
   lambda x: x IS NOT NULL) AS flags FROM num)
SELECT k AS custkey, CAST(employees AS BIGINT) AS employees,
  CASE WHEN len(flags) = 0 THEN 'rechtstraeger' ELSE 'konzern_oder_unklar' END AS scope,
  array_to_string(flags, ' | ') AS note, len(flags) = 0 AS usable FROM f""")
def headcount_scope(spark, d):
    k = F.col("k")
    txt = (F.when(k % 5 == 0, F.concat(F.lit("1."), F.format_string("%03d", k % 1000)))
           .when(k % 5 == 1, F.concat_ws("-", (k % 90 + 10).cast("string"), (k % 90 + 210).cast("string")))
           .when(k % 5 == 2, F.lit("10.000+")).when(k % 5 == 3, F.concat((k % 700).cast("string"), F.lit(".0")))
           .otherwise(F.lit("k.A.")))
    country = F.when(k % 3 == 0, F.lit("Germany")).when(k % 3 == 1, F.col("city"))
    found = F.when(k % 4 == 0, F.concat(F.lit("Holding "), "name")).otherwise(F.col("name"))
    rows = firm_names(spark, d).withColumn("employees", to_int(txt))
    return rows.withColumn("s", head_count_scope(F.col("name"), found, country, F.col("employees"))).select(
        k.alias("custkey"), "employees", "s.*")


@query("link_verdict", """
WITH f AS (SELECT page_id, CASE WHEN page_id % 13 = 5 THEN 'https://ted.europa.eu/n/' || page_id ELSE url END AS url,
   CASE page_id % 13 WHEN 3 THEN 404 WHEN 4 THEN 0 WHEN 5 THEN 202 ELSE 200 END AS status,
   CASE page_id % 13 WHEN 5 THEN 0 WHEN 6 THEN 1309 WHEN 7 THEN 120 ELSE length(html) END AS bytes,
   CASE WHEN page_id % 13 IN (8, 9) THEN 'text/html; charset=utf-8' ELSE 'application/pdf' END AS ctype FROM pages),
r AS (SELECT page_id, CASE WHEN status = 0 THEN 'nicht erreichbar'
   WHEN status = 202 AND bytes = 0 AND contains(url, 'ted.europa.eu') THEN 'JS-Challenge - maschinell nicht pruefbar'
   WHEN status <> 200 THEN 'HTTP ' || status WHEN bytes = 1309 THEN 'SPA-Huelle - die Seite zeigt im Browser 404'
   WHEN ctype <> 'application/pdf' THEN 'unerwarteter Content-Type text/html'
   WHEN bytes < 500 THEN 'Antwort verdaechtig klein' ELSE '' END AS reason FROM f)
SELECT page_id, reason, CASE WHEN reason = '' THEN 'ok' WHEN starts_with(reason, 'JS-') THEN 'unverifiable' ELSE 'failed' END AS verdict
FROM r""")
def link_verdicts(spark, d):
    return fetched_pages(spark, d).withColumn("v", link_verdict(
        F.col("url"), F.col("status"), F.col("bytes"), F.col("ctype"))).select("page_id", "v.*")


def fetched_pages(spark, d):
    """Pages as fetch results with every kind of answer."""
    m = F.col("page_id") % 13
    return table(spark, d, "pages").select(
        "page_id", F.when(m == 5, F.concat(F.lit("https://ted.europa.eu/n/"), F.col("page_id").cast("string")))
        .otherwise(F.col("url")).alias("url"),
        F.when(m == 3, 404).when(m == 4, 0).when(m == 5, 202).otherwise(200).alias("status"),
        F.when(m == 5, 0).when(m == 6, 1309).when(m == 7, 120).otherwise(F.length("html")).alias("bytes"),
        F.when(m.isin(8, 9), F.lit("text/html; charset=utf-8")).otherwise(F.lit("application/pdf")).alias("ctype"))


ROLES, NEARBY = "(?i) (?:der|the|que|los) ", "[0-9]|###|zung"


@query("role_name_quota", f"""
WITH m AS (SELECT doc_id, text, regexp_extract_all(text, '{ROLES}') AS ws, string_split_regex(text, '{ROLES}') AS ps FROM documents),
s AS (SELECT doc_id, text, unnest(ps[1:len(ws)]) AS p, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM m WHERE len(ws) > 0),
pos AS (SELECT doc_id, text, i, sum(length(p) + length(w)) OVER (PARTITION BY doc_id ORDER BY i) - length(w) AS st FROM s),
hit AS (SELECT doc_id, regexp_matches(text[CAST(greatest(st - 260, 0) + 1 AS BIGINT):CAST(st + 260 AS BIGINT)], '{NEARBY}') AS near FROM pos),
agg AS (SELECT doc_id, count(*) AS mentions, count(*) FILTER (WHERE near) AS with_firm FROM hit GROUP BY 1)
SELECT d.doc_id, coalesce(mentions, 0) AS mentions, coalesce(with_firm, 0) AS with_firm,
  CASE WHEN mentions > 0 THEN round_even(with_firm::DOUBLE / mentions, 3) ELSE 0.0::DOUBLE END AS quota,
  0::BIGINT AS file_numbers FROM documents d LEFT JOIN agg USING (doc_id)""")
def role_name_quota(spark, d):
    return quality.name_quota(table(spark, d, "documents").select("doc_id", "text"), "text", ROLES, NEARBY).drop("text", "roles")


@query("verify_candidate", f"""
WITH {FIRMS}, c AS (SELECT k, name, city, CASE k % 4 WHEN 0 THEN name WHEN 1 THEN split_part(name, ' ', 1) || ' ' || city
    WHEN 2 THEN 'Ganz Anders' ELSE name || ' Plus' END AS cand,
  CASE k % 6 WHEN 0 THEN '' ELSE 'haus' || k || ['.de', '.at', '.com', '.de', '.org'][CAST(k % 6 AS INTEGER)] END AS dom,
  CASE WHEN k % 5 < 2 THEN 'Germany' END AS country, CAST(k % 2 + 1 AS INTEGER) AS st FROM firms),
t AS (SELECT *, list_distinct(string_split({sql_key('name')}, ' ')) AS ta, list_distinct(string_split({sql_key('cand')}, ' ')) AS tb,
   regexp_extract(dom, '[^.]+$') AS tld FROM c),
o AS (SELECT *, len(list_intersect(ta, tb))::DOUBLE / greatest(len(list_distinct(list_concat(ta, tb))), 1) AS ov FROM t),
s AS (SELECT *, CASE WHEN dom = '' THEN 'x' WHEN st = 2 AND tld IN ('at', 'org') THEN 'x' WHEN ov < 0.2 THEN 'x' END AS rej,
  round_even(least(CASE WHEN st = 1 THEN 0.45 ELSE 0 END::DOUBLE + CASE WHEN tld = 'de' THEN 0.30 ELSE 0 END::DOUBLE + CASE WHEN tld = 'com' THEN 0.10 ELSE 0 END::DOUBLE
   + CASE WHEN country IS NOT NULL THEN 0.25 ELSE 0 END::DOUBLE + CASE WHEN ov >= 0.5 THEN 0.20 ELSE 0 END::DOUBLE
   + CASE WHEN contains({sql_fold('cand')}, {sql_fold('city')}) THEN 0.10 ELSE 0 END::DOUBLE, 1.0), 3) AS score FROM o)
SELECT k AS custkey, rej IS NULL AND score >= 0.6 AS accepted, CASE WHEN rej IS NULL AND score >= 0.6 THEN dom ELSE '' END AS domain,
  CASE WHEN rej IS NULL THEN score ELSE 0.0::DOUBLE END AS confidence FROM s""")
def candidate_check(spark, d):
    k = F.col("k")
    first = F.substring_index("name", " ", 1)
    cand = (F.when(k % 4 == 0, F.col("name")).when(k % 4 == 1, F.concat_ws(" ", first, "city"))
            .when(k % 4 == 2, F.lit("Ganz Anders")).otherwise(F.concat("name", F.lit(" Plus"))))
    tail = F.get(F.array(*map(F.lit, ["", ".de", ".at", ".com", ".de", ".org"])), (k % 6).cast("int"))
    dom = F.when(k % 6 == 0, F.lit("")).otherwise(F.concat(F.lit("haus"), k.cast("string"), tail))
    country = F.when(k % 5 < 2, F.lit("Germany"))
    v = verify_candidate(F.col("name"), F.col("city"), cand, dom, country, (k % 2 + 1).cast("int"))
    return firm_names(spark, d).withColumn("v", v).select(
        k.alias("custkey"), "v.accepted", "v.domain", "v.confidence")


@query("imprint_check", f"""
WITH p AS (SELECT page_id, {SQL_TEXT} AS txt, regexp_extract(url, '^https?://(?:www\\.)?([^/]+)', 1) AS host FROM pages),
q AS (SELECT page_id, host, {sql_fold('txt')} AS hay, host || ' tion' AS name, CASE WHEN page_id % 2 = 0 THEN 'the' ELSE 'nirgendwo' END AS city FROM p),
c AS (SELECT *, list_filter(string_split({sql_key('name')}, ' '), lambda t: length(t) > 2) AS core FROM q),
r AS (SELECT *, len(list_filter(core, lambda t: contains(hay, t))) AS hits, len(core) AS n, contains(hay, city) AS town FROM c),
z AS (SELECT *, CASE WHEN n > 0 THEN hits::DOUBLE / n ELSE 0 END AS ratio FROM r)
SELECT page_id, ratio >= 0.6 AND town AS match, round_even(ratio, 2) AS name_ratio,
  CASE WHEN ratio >= 0.6 AND NOT town THEN 0.0::DOUBLE ELSE round_even(
    CASE WHEN ratio >= 0.6 THEN 0.45 WHEN ratio > 0 THEN 0.15 ELSE 0 END::DOUBLE + CASE WHEN town THEN 0.2 ELSE 0 END::DOUBLE, 3) END AS confidence_delta
FROM z""")
def imprint_check(spark, d):
    host = F.regexp_extract("url", r"^https?://(?:www\.)?([^/]+)", 1)
    city = F.when(F.col("page_id") % 2 == 0, F.lit("the")).otherwise(F.lit("nirgendwo"))
    v = verify_imprint(tx.html_text(F.col("html")), host, F.concat(host, F.lit(" tion")), city)
    return table(spark, d, "pages").withColumn("v", v).select(
        "page_id", "v.match", "v.name_ratio", "v.confidence_delta")


GAP = "repeat('. ', 200)"
RULING = f"""concat('In der Sache VK 2 - ', doc_id % 90 + 10, '/26 der Antragstellerin ', CASE WHEN doc_id % 3 <> 0 THEN concat('Netz', doc_id % 7, ' GmbH') ELSE 'ohne Namen' END,
  {GAP}, text, {GAP}, 'die ANTRAGSGEGNERIN und die Beigeladene ', CASE WHEN doc_id % 2 = 0 THEN 'Cloud und Daten AG' ELSE 'unbekannt' END,
  {GAP}, 'Beigeladene, siehe 1 Verg ', doc_id % 9 + 1, '/25 und VK 2 - ', doc_id % 90 + 10, '/26')"""


@query("role_mentions", """
SELECT doc_id, role, CAST(CASE role WHEN 'beigeladene' THEN 2 ELSE 1 END AS BIGINT) AS mentions,
  CAST(CASE role WHEN 'antragstellerin' THEN doc_id % 3 <> 0 ELSE doc_id % 2 = 0 END AS BIGINT) AS with_firm, CAST(2 AS BIGINT) AS file_numbers
FROM documents CROSS JOIN (VALUES ('antragstellerin'), ('antragsgegnerin'), ('beigeladene')) r(role)""")
def role_mentions(spark, d):
    """The real patterns on every document, dressed as a ruling: roles, firms and file numbers around its text."""
    rulings = table(spark, d, "documents").select("doc_id", F.expr(RULING).alias("text"))
    q = quality.name_quota(rulings)
    return q.select("doc_id", F.explode("roles").alias("r"), "file_numbers").select("doc_id", "r.*", "file_numbers")
