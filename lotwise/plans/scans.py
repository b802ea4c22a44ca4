"""The tables written out as the feeds' own files in the shared folder and read back by the real scans."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise.plans.registry import query
from lotwise.plans.views import table
from lotwise.session import landed, shared_folder
from lotwise.sources import deadlines, enrichment, jobs, notices, ted

MONTHS = [f"1997-{m:02d}" for m in range(1, 13)]
ABSENT = "1989-07"  # a month no order falls into
PER_DOCUMENT = 500


def folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def write_packages(spark: SparkSession, d: str, out: str) -> None:
    """Orders as release documents by month: every 500th key a document of its own, the others in packages and lists.

    A document holds some ``PER_DOCUMENT`` releases, so there are more documents when there are more orders.  Each
    month also has a document that breaks off.
    """
    lots = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set(F.struct(
        F.col("l_linenumber").cast("string").alias("id"), F.struct(F.date_format("l_shipdate", "yyyy-MM-dd").alias("endDate")).alias("contractPeriod")))).alias("lots"))
    o = table(spark, d, "orders").join(lots, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    key = F.col("o_orderkey").cast("string")
    release = F.to_json(F.struct(
        key.alias("id"), F.concat(F.lit("ocid-"), key).alias("ocid"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("date"),
        F.array(F.lit("tender")).alias("tag"), F.struct(F.concat(F.lit('K "\\ü{[ '), F.col("o_custkey").cast("string")).alias("name")).alias("buyer"),
        F.struct(F.struct(F.col("o_totalprice").alias("amount")).alias("value"), "lots").alias("tender")))
    rows = landed(o.select(F.date_format("o_orderdate", "yyyy-MM").alias("pub_month"), "o_orderkey", release.alias("json")), "releases")
    single = F.col("o_orderkey") % 500 == 0
    sizes = rows.groupBy("pub_month").agg(F.ceil(F.count(F.lit(1)) / PER_DOCUMENT).alias("docs"))
    many = (rows.filter(~single).join(sizes, "pub_month").groupBy("pub_month", F.pmod(F.xxhash64("o_orderkey"), F.col("docs")).alias("doc"))
            .agg(F.concat(F.lit("["), F.array_join(F.collect_list("json"), ","), F.lit("]")).alias("list")))
    shaped = many.select("pub_month", F.when(F.col("doc") % 2 == 0, F.concat(F.lit('{"uri": "x", "releases": '), "list", F.lit("}"))).otherwise(F.col("list")).alias("value"))
    broken = many.filter("doc = 0").select("pub_month", F.expr("left(list, length(list) div 2)").alias("value"))
    documents = shaped.unionByName(rows.filter(single).select("pub_month", F.col("json").alias("value"))).unionByName(broken)
    documents.write.option("maxRecordsPerFile", 1).partitionBy("pub_month").text(out)


@query("scan_packages", """
WITH lots AS (SELECT l_orderkey AS k, count(DISTINCT (l_linenumber, l_shipdate)) AS n, max(l_shipdate)::DATE AS last FROM lineitem GROUP BY 1)
SELECT strftime(o_orderdate, '%Y-%m') AS pub_month, 'release' AS kind, CAST(o_orderkey AS VARCHAR) AS id, 'ocid-' || o_orderkey AS ocid,
  'K "\\ü{[ ' || o_custkey AS buyer, CAST(o_totalprice AS DOUBLE) AS amount, coalesce(lots.n, 0) AS lots, last AS last_end, 1::BIGINT AS n
FROM orders LEFT JOIN lots ON lots.k = o_orderkey WHERE year(o_orderdate) = 1997
UNION ALL SELECT DISTINCT strftime(o_orderdate, '%Y-%m'), 'reject', NULL, NULL, NULL, NULL, 0, NULL, 1 FROM orders WHERE year(o_orderdate) = 1997 AND o_orderkey % 500 <> 0""".replace("\\\\", "\\"))
def scan_packages(spark, d):
    """A year of the corpus: every release of all three shapes, and the unreadable documents counted by month."""
    out = folder(spark, "corpus")
    write_packages(spark, d, out)
    releases, rejects = notices.read_checked(spark, out, [*MONTHS, ABSENT])
    rows = releases.select(
        "pub_month", F.lit("release").alias("kind"), "id", "ocid", F.col("buyer.name").alias("buyer"), F.col("tender.value.amount").alias("amount"),
        F.coalesce(F.size("tender.lots"), F.lit(0)).cast("long").alias("lots"),
        F.to_date(F.array_max(F.transform("tender.lots", lambda x: x["contractPeriod"]["endDate"]))).alias("last_end"), F.lit(1).cast("long").alias("n"))
    broken = rejects.groupBy(F.regexp_extract("path", "pub_month=([0-9-]+)", 1).alias("pub_month")).agg(F.count(F.lit(1)).alias("n"))
    return rows.unionByName(broken.withColumn("kind", F.lit("reject")).withColumn("lots", F.lit(0).cast("long")), allowMissingColumns=True)


@query("scan_months", f"""
SELECT m.pub_month, count(o_orderkey) AS releases, count(o_orderkey) = 0 AS missing
FROM (SELECT unnest([{', '.join(f"'{m}'" for m in [*MONTHS, ABSENT])}]) AS pub_month) m
LEFT JOIN orders ON strftime(o_orderdate, '%Y-%m') = m.pub_month GROUP BY 1""")
def scan_months(spark, d):
    """Releases by month wanted after the corpus was turned into lines, the absent month among them."""
    out = folder(spark, "corpus")
    write_packages(spark, d, f"{out}/packages")
    notices.compact(spark, f"{out}/packages", f"{out}/lines", f"{out}/rejects")
    months = [*MONTHS, ABSENT]
    return notices.month_coverage(notices.read_months(spark, f"{out}/lines", months, lines=True), months)


def notice_xml(spark: SparkSession, d: str) -> DataFrame:
    """An XML notice per order, a lot per line: two prefixes or none for the fields, times with and without offset.

    Lines that came back without remark have no deadline; every 97th notice breaks off.
    """
    ns = F.element_at(F.array(*map(F.lit, ("cbc:", "b:", ""))), (F.col("l_orderkey") % 3 + 1).cast("int"))
    offset = F.when(F.col("l_linenumber") % 2 == 0, F.lit("+02:00")).otherwise(F.lit(""))

    def field(name, value):
        return F.concat(F.lit("<"), ns, F.lit(f"{name}>"), value, F.lit("</"), ns, F.lit(f"{name}>"))
    period = F.concat(F.lit("<cac:TenderSubmissionDeadlinePeriod>"), field("EndDate", F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), offset)),
                      field("EndTime", F.concat(F.format_string("%02d:30:00", F.col("l_linenumber") + 9), offset)), F.lit("</cac:TenderSubmissionDeadlinePeriod>"))
    lot = F.concat(F.lit("<cac:ProcurementProjectLot><cac:TenderingProcess>"), F.when(F.col("l_returnflag") == "N", F.lit("")).otherwise(period),
                   F.lit("</cac:TenderingProcess></cac:ProcurementProjectLot>"))
    per_order = (table(spark, d, "lineitem").groupBy("l_orderkey")
                 .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_shipdate", lot.alias("x")))), lambda s: s["x"]), "\n").alias("lots")))
    xml = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<ContractNotice xmlns="urn:n" xmlns:cac="urn:a" xmlns:cbc="urn:b" xmlns:b="urn:b">'),
                   "lots", F.lit("</ContractNotice>"))
    whole = F.when(F.col("l_orderkey") % 97 == 0, F.expr("left(xml, length(xml) - 9)")).otherwise(F.col("xml"))
    return per_order.withColumn("xml", xml).select(F.col("l_orderkey").cast("string").alias("notice_id"), whole.alias("xml"))


@query("xml_deadlines", """
WITH x AS (SELECT l_orderkey AS k, l_linenumber AS ln, l_shipdate::DATE AS day, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate) AS i
           FROM lineitem WHERE l_returnflag <> 'N'),
f AS (SELECT k, arg_min(ln, (day, i)) AS ln, min(day) AS day, count(*) AS n FROM x GROUP BY k)
SELECT CAST(l.k AS VARCHAR) AS notice_id, CASE WHEN l.k % 97 <> 0 THEN day END AS deadline,
  CASE WHEN l.k % 97 <> 0 AND f.k IS NOT NULL THEN printf('%02d:30:00', ln + 9) END AS uhrzeit,
  CASE WHEN l.k % 97 <> 0 AND ln % 2 = 0 THEN '+02:00' END AS versatz,
  CAST(CASE WHEN l.k % 97 <> 0 THEN n END AS INTEGER) AS lose_mit_frist,
  CASE WHEN l.k % 97 = 0 THEN 'XML nicht lesbar' WHEN f.k IS NULL THEN 'keine Frist im XML' END AS fehler
FROM (SELECT DISTINCT l_orderkey AS k FROM lineitem) l LEFT JOIN f ON f.k = l.k""")
def xml_deadlines(spark, d):
    """Deadlines by a real parse of every notice, whatever its prefixes."""
    return deadlines.parsed_deadlines(notice_xml(spark, d))


def write_notices(spark: SparkSession, d: str, out: str) -> None:
    """Orders as EU notices, a field now text, now list, now language map five deep; every tenth in a page of its own."""
    k = F.col("o_orderkey")
    names = table(spark, d, "supplier").select("s_suppkey", "s_name")
    won = (table(spark, d, "lineitem").filter("l_linestatus = 'F'").join(names, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("l_orderkey")
           .agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_shipdate", "s_suppkey", "s_name"))).alias("won")))
    rows = table(spark, d, "orders").join(won, k == F.col("l_orderkey"))
    text = lambda *parts: F.to_json(F.array(F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])))
    inner = lambda c: F.substring(c, 2, 1 << 20).substr(F.lit(1), F.length(c) - 2)  # noqa: E731  the list's only text, quoted
    title = inner(text("Titel ", k))
    deep = F.concat(F.lit('{"x": [{"b": [" ", {"fra": "F", "eng": {"q": ["E"]}, "deu": [[" "], {"value": '), inner(text('Käufer "', F.col("o_custkey"), '"')),
                    F.lit(', "a": "A"}]}]}, "W"]}'))
    by = lambda *values: F.element_at(F.array(*values), (k % len(values) + 1).cast("int"))
    field = {
        "publication-number": by(inner(text(k, "-1997")), text(k, "-1997")),
        "publication-date": inner(text(F.date_format("o_orderdate", "yyyy-MM-dd"), "+01:00")),
        "notice-title": by(title, F.concat(F.lit('{"eng": "T", "deu": '), title, F.lit("}")), F.concat(F.lit('{"zzz": "T", "eng": ['), title, F.lit("]}"))),
        "buyer-name": by(deep, F.concat(F.lit('{"deu": ['), deep, F.lit("]}"))),
        "classification-cpv": F.to_json(F.array(F.lit("72000000"), F.concat(F.lit("4800000"), (k % 10).cast("string")))),
        "total-value": by(F.col("o_totalprice").cast("string"), inner(text(F.col("o_totalprice")))),
        "notice-type": F.lit('"can-standard"'),
        "winner-name": F.to_json(F.transform("won", lambda w: w["s_name"])),
        "winner-post-code": F.to_json(F.transform("won", lambda w: F.concat(F.lit("P"), w["s_suppkey"].cast("string")))),
    }
    notice = F.concat(F.lit("{"), F.concat_ws(", ", *[F.concat(F.lit(f'"{name}": '), value) for name, value in field.items()]), F.lit("}"))
    page = F.concat(F.lit('{"total": 1, "notices": ['), F.col("n"), F.lit("]}"))
    rows.select(k.alias("k"), notice.alias("n")).select(F.when(F.col("k") % 10 == 0, page).otherwise(F.col("n")).alias("value")).write.text(out)


@query("ted_scan", """
WITH w AS (SELECT l_orderkey AS k, s_name AS winner, s_suppkey AS s, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, s_suppkey, s_name) - 1 AS i
           FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_linestatus = 'F'),
f AS (SELECT k, winner, arg_min(s, i) AS s, min(i) AS i FROM w GROUP BY k, winner),
x AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY i) - 1 AS idx FROM f)
SELECT o_orderkey || '-1997:' || idx AS external_id, o_orderdate::DATE AS event_date, winner AS org_name_raw, 'Titel ' || o_orderkey AS title,
  'Käufer "' || o_custkey || '"' AS buyer, CAST(o_totalprice AS DOUBLE) AS value, '72000000;4800000' || (o_orderkey % 10) AS cpv, 'P' || s AS postcode
FROM x JOIN orders ON o_orderkey = x.k""")
def ted_scan(spark, d):
    """Award signals of EU notices read from files: every shape of a field, preferred language at any depth."""
    out = folder(spark, "ted")
    write_notices(spark, d, out)
    found = ted.ted_signals(ted.read_ted(spark, out))
    return found.select("external_id", "event_date", "org_name_raw", "title", "buyer", "value", F.array_join("cpv", ";").alias("cpv"),
                        F.get_json_object("payload", "$.winner_post_code").alias("postcode"))


@query("job_scan", """
WITH e AS (SELECT event_id, user_id, event_type, ts::DATE AS d, 'Ref-' || (user_id % 500) || '-' || event_type AS ref FROM events),
l AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY ref ORDER BY d DESC, 'Bid Manager ' || event_id, 'Firma ' || user_id) = 1)
SELECT ref, 'Bid Manager ' || event_id AS title, 'Firma ' || user_id AS employer, d, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'Ort ' || user_id END AS ort,
  CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN 'neu' ELSE 'alt' END AS region FROM l""")
def job_scan(spark, d):
    """Job ads of two coexisting spellings read from files, the latest per reference, blanks as missing."""
    i, u = F.col("event_id"), F.col("user_id").cast("string")
    new, day = i % 3 == 1, F.date_format("ts", "yyyy-MM-dd")
    ref, title, firm = F.concat(F.lit("Ref-"), (F.col("user_id") % 500).cast("string"), F.lit("-"), F.col("event_type")), F.concat(F.lit("Bid Manager "), i.cast("string")), F.concat(F.lit("Firma "), u)
    address = lambda region: F.struct(F.concat(F.lit("Ort "), u).alias("ort"), F.lit(region).alias("region"))
    ad = F.struct(
        F.when(new, ref).otherwise(F.lit(" ")).alias("referenznummer"), F.when(~new, ref).alias("refnr"),
        F.when(new, title).alias("stellenangebotsTitel"), F.when(~new, title).alias("titel"), F.when(new, firm).otherwise(F.lit("")).alias("firma"), F.when(~new, firm).alias("arbeitgeber"),
        F.when(new, F.array(F.struct(address("neu").alias("adresse")))).alias("stellenlokationen"), F.when(i % 3 == 2, address("alt")).alias("arbeitsort"),
        F.when(new, day).alias("datumErsteVeroeffentlichung"), F.when(i % 3 == 0, F.concat(day, F.lit("T08:00:00"))).alias("aktuelleVeroeffentlichungsdatum"),
        F.when(i % 3 == 2, F.struct(day.alias("von"))).alias("veroeffentlichungszeitraum"), F.lit("x").alias("unbekanntes_feld"))
    out = folder(spark, "jobs")
    table(spark, d, "events").select(F.to_json(ad).alias("value")).write.text(out)
    return jobs.job_ads(jobs.read_jobs(spark, out)).select("ref", "title", "employer", "d", "ort", "region")


@query("enrichment_scan", """
SELECT CAST(c_custkey AS VARCHAR) AS company_id, c_name AS legal_name, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'firma' || c_custkey || '.de' END AS domain,
  CASE c_custkey % 3 WHEN 0 THEN 1000 + c_custkey WHEN 1 THEN NULL ELSE 375 END::BIGINT AS employees, 'Ort, "' || c_nationkey || '"' AS city, src AS source
FROM customer CROSS JOIN (VALUES ('csv'), ('jsonl')) s(src)""")
def enrichment_scan(spark, d):
    """The same export as CSV under one set of column names and as JSON lines under another."""
    k = F.col("c_custkey")
    fields = {
        "id": k.cast("string"), "name": F.col("c_name"),
        "web": F.when(k % 4 != 0, F.concat(F.lit("https://www.Firma"), k.cast("string"), F.lit(".de/impressum"))),
        "size": F.when(k % 3 == 0, F.format_number(1000 + k, 0)).when(k % 3 == 2, F.lit("250-500")), "city": F.concat(F.lit('Ort, "'), F.col("c_nationkey").cast("string"), F.lit('"'))}
    spelled = {"csv": ["Company-ID", "Firma", "Website", "Mitarbeiter", "Ort"], "jsonl": ["companyid", "company_name", "domain_final", "headcount", "hq_city"]}
    parts = []
    for kind, names in spelled.items():
        out = f"{folder(spark, 'enrichment')}.{kind}"
        rows = table(spark, d, "customer").select(*[v.alias(n) for n, v in zip(names, fields.values())], F.lit("x").alias("unknown column"))
        (rows.write.option("header", True).option("escape", '"').csv(out) if kind == "csv" else rows.write.json(out))
        found = enrichment.read_enrichment(spark, out)
        parts.append(found.select("company_id", "legal_name", "domain", F.col("employees").cast("long").alias("employees"), "city", F.lit(kind).alias("source")))
    return parts[0].unionByName(parts[1])
