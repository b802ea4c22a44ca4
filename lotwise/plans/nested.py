"""The nested path end to end: release documents built per order, parsed by the scan's own schema.

A release holds the lines of its order only: tenderers are the distinct suppliers, awards
the won lines, lots one per line with the ship date as contract end, items the codes of the parts.
Brands become codes: ``Brand#1x`` lies in scope (72...), every other one does not (45...).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise import rules
from lotwise.operators import company, parties as ops, signals
from lotwise.plans import views
from lotwise.plans.market import AGE, MARKET, MARKET_COLUMNS, MARKET_SQL_COLUMNS, OUTCOMES
from lotwise.plans.registry import query
from lotwise.plans.views import AS_OF, table
from lotwise.schemas import RELEASE
from lotwise.session import landed

SINCE, DAY = dt.date(1998, 6, 1), dt.date(1998, 8, 1)


def releases(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").select("p_partkey", "p_brand")
    nation = F.broadcast(table(spark, d, "nation").select("n_nationkey", "n_name"))  # 25 rows
    supplier = table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        "s_suppkey", "s_name", "n_name")
    code = F.concat(F.when(F.col("p_brand").startswith("Brand#1"), F.lit("72")).otherwise(F.lit("45")),
                    F.substring("p_brand", 7, 2), F.lit("0000"))
    # Lines travel as plain columns and are landed before they meet by order: the documents' structs are made
    # where they are used, and the lookups' shuffle files are gone when the next ones are written.
    lines = landed(
        table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("end"),
                                           "l_extendedprice", views.won_line().alias("won"))
        .join(part, F.col("l_partkey") == F.col("p_partkey")).withColumn("code", code).drop("l_partkey", "p_partkey", "p_brand")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).drop("s_suppkey"), "lines")
    party = F.struct(F.concat(F.lit("ORG-"), F.col("l_suppkey").cast("string")).alias("id"), F.col("s_name").alias("name"),
                     F.struct(F.col("n_name").alias("locality")).alias("address"))
    lot = F.col("l_linenumber").cast("string")
    end = F.struct(F.date_format("end", "yyyy-MM-dd").alias("endDate"))
    award = F.struct(lot.alias("id"), F.array(lot).alias("relatedLots"), F.struct(F.col("l_extendedprice").alias("amount"),
                     F.lit("EUR").alias("currency")).alias("value"), F.array(party).alias("suppliers"))
    per_order = lines.repartition("l_orderkey").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_set(party)).alias("tenderers"),
        F.array_sort(F.collect_list(F.when(F.col("won"), award))).alias("awards"),
        F.array_sort(F.collect_set(F.struct(lot.alias("id"), end.alias("contractPeriod")))).alias("lots"),
        F.min(F.when(F.col("l_linenumber") == 1, F.col("code"))).alias("main"), F.collect_set("code").alias("codes"))
    o = table(spark, d, "orders").join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
    opens = (F.col("o_orderstatus") == "O") & (F.size("awards") == 0)
    tender = F.struct(
        F.concat(F.lit("Verfahren "), F.col("o_orderkey").cast("string")).alias("title"),
        F.struct(F.col("o_totalprice").alias("amount")).alias("value"), F.struct(F.col("main").alias("id")).alias("classification"),
        F.transform("codes", lambda c: F.struct(F.struct(c.alias("id")).alias("classification"))).alias("items"), "lots",
        F.struct(F.when(opens, F.date_format(F.date_add(F.to_date("o_orderdate"), 30), "yyyy-MM-dd")).alias("endDate")).alias("tenderPeriod"),
        "tenderers")
    key = F.col("o_orderkey").cast("string")
    document = F.to_json(F.struct(
        key.alias("id"), key.alias("ocid"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("date"),
        F.array(F.when(F.col("o_orderstatus") == "F", F.lit("award")).otherwise(F.lit("tender"))).alias("tag"),
        F.struct(F.col("o_custkey").cast("string").alias("name")).alias("buyer"), tender.alias("tender"), "awards"))
    return o.select(F.from_json(document, RELEASE).alias("r")).select("r.*")


def notices(spark, d):
    return ops.notices_of_releases(releases(spark, d))


def nested(sql: str) -> str:
    """An oracle over flat rows, said of the documents above."""
    return (sql.replace("p_brand AS b", "CASE WHEN starts_with(p_brand, 'Brand#1') THEN '72' ELSE '45' END || p_brand[7:8] || '0000' AS b")
            .replace("starts_with(b, 'Brand#1')", "starts_with(b, '72')").replace("starts_with(main, 'Brand#1')", "starts_with(main, '72')")
            .replace("o.o_orderpriority = '5-LOW' AS consortium", "false AS consortium")
            .replace("'ORG-' || bidders", "'ORG-' || s").replace("CAST(aged.s AS VARCHAR) AS company_id", "lower(s_name) AS company_id"))


@query("nested_verdicts", nested(f"""
WITH {OUTCOMES}
SELECT CAST(k AS VARCHAR) AS notice_id, is_it, main AS main_cpv, round_even(share, 3) AS it_share, n AS cpv_count,
  array_to_string(every, ';') AS codes, mixed AS mixed_lot FROM verdicts JOIN orders ON o_orderkey = k"""))
def nested_verdicts(spark, d):
    return notices(spark, d).select("notice_id", "is_it", "main_cpv", "it_share", F.col("cpv_count").cast("long").alias("cpv_count"),
                                    F.array_join("all_codes", ";").alias("codes"), "mixed_lot")


@query("nested_participations", nested(f"""
WITH {OUTCOMES}
SELECT CAST(k AS VARCHAR) AS notice_id, lower(s_name) AS company_id, CASE WHEN won THEN 'award' ELSE 'bid' END AS role,
  CASE WHEN NOT won THEN outcome END AS outcome, d, CAST(buyer AS VARCHAR) AS buyer, s_name AS legal_name, n_name AS city,
  'ORG-' || s AS supplier_id, main AS main_cpv, array_to_string(every, ';') AS codes,
  unnest(range(CASE WHEN won THEN won_rows ELSE 1 END)) AS nth
FROM rows_ JOIN supplier ON s_suppkey = s LEFT JOIN nation ON n_nationkey = s_nationkey"""))
def nested_participations(spark, d):
    """Every award row of a company counts; ``nth`` numbers them inside the notice."""
    parts = ops.participations_of_notices(notices(spark, d))
    rows = parts.groupBy("notice_id", "company_id", "role", "outcome", "d", "buyer", "legal_name", "city", "supplier_id", "main_cpv",
                         F.array_join("cpv", ";").alias("codes")).agg(F.count(F.lit(1)).alias("n"))
    return rows.select("*", F.explode(F.expr("sequence(0L, n - 1)")).alias("nth")).drop("n")


@query("nested_market_list", nested(f"""
WITH {MARKET}
SELECT {MARKET_SQL_COLUMNS},
  CASE WHEN mixed_lot_only THEN 'nur ueber Sammelvergabe mit fachfremden Gewerken belegt - IT-Eigenschaft nicht gesichert, vor Ansprache pruefen'
   WHEN proof_type = 'P3_rahmenvertrag' THEN 'Public-Sector-Bezug belegt, aber kein Zuschlag und keine Bieterrolle gefunden'
   WHEN proof_type = 'P6_nur_branche' THEN 'kein belegter Public-Sector-Bezug'
   WHEN participations_total >= 2 THEN participations_total || ' Verfahren in 12 Monaten, ' || {AGE}
     || CASE WHEN buyers_total > 1 THEN ', ' || buyers_total || ' verschiedene Auftraggeber' ELSE '' END
     || CASE WHEN participations_total >= 3 AND age <= 180 THEN ' - laufender Angebotsprozess' ELSE ' - wiederkehrender Bieter' END
   WHEN age <= 180 THEN '1 Verfahren, ' || {AGE} || ' - Teilnahme aktuell, aber bisher einmalig'
   ELSE participations_total || ' Verfahren, ' || {AGE} || ' - Teilnahme belegt, aber weder haeufig noch aktuell'
  END AS tier_rationale
FROM market"""))
def nested_market_list(spark, d):
    parts = landed(ops.participations_of_notices(notices(spark, d)).select(*company.EVIDENCE), "participations")
    return company.market_list(parts, AS_OF).select(*MARKET_COLUMNS)


@query("nested_signals", nested(f"""
WITH {OUTCOMES},
lots AS (SELECT l_orderkey AS k, l_linenumber AS ln, l_shipdate::DATE AS e FROM lineitem GROUP BY ALL),
w AS (SELECT l_orderkey AS k, l_linenumber AS ln, l_suppkey AS s, l_extendedprice AS v,
        (SELECT max(e) FROM lots WHERE lots.k = l_orderkey AND lots.ln = l_linenumber) AS e
      FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F'),
n AS (SELECT v.k, o_orderdate::DATE AS d, o_custkey AS buyer, o_orderstatus AS st, o_totalprice AS total, coalesce(p.winners, 0) AS winners,
        (SELECT min(e) FROM lots WHERE lots.k = v.k) AS first_end
      FROM verdicts v JOIN orders ON o_orderkey = v.k JOIN per_notice p ON p.k = v.k WHERE v.is_it),
aw AS (SELECT n.k, n.d, w.ln, w.s, w.e, CAST(w.v AS DOUBLE) AS v, s_name FROM n JOIN w USING (k) JOIN supplier ON s_suppkey = w.s),
b AS (SELECT r.k, r.d, r.s, r.outcome, n.first_end, s_name FROM rows_ r JOIN n USING (k) JOIN supplier ON s_suppkey = r.s WHERE NOT won),
sig AS (
  SELECT k || ':award:' || ln || ':ORG-' || s AS external_id, 'zuschlag_gewonnen' AS signal_type, d AS event_date, s_name AS org_name_raw, e AS contract_end, v AS value, NULL::DATE AS deadline FROM aw WHERE d >= DATE '1998-06-01'
  UNION ALL SELECT k || ':expiry:' || ln || ':ORG-' || s, 'rahmenvertrag_laeuft_aus', DATE '1998-08-01', s_name, e, v, NULL FROM aw WHERE e - DATE '1998-08-01' BETWEEN 180 AND 270
  UNION ALL SELECT k || ':bidder:' || lower(s_name), CASE outcome WHEN 'alleinbieter_gewonnen' THEN 'zuschlag_gewonnen' WHEN 'unterlegen' THEN 'angebot_ohne_zuschlag' ELSE 'teilnahme_belegt' END,
    d, s_name, first_end, NULL, NULL FROM b WHERE d >= DATE '1998-06-01'
  UNION ALL SELECT k || ':expiry:bidder:' || lower(s_name), 'rahmenvertrag_laeuft_aus', DATE '1998-08-01', s_name, first_end, NULL, NULL
    FROM b WHERE outcome = 'alleinbieter_gewonnen' AND first_end - DATE '1998-08-01' BETWEEN 180 AND 270
  UNION ALL SELECT k || ':open', 'offene_ausschreibung_im_profil', d, CAST(buyer AS VARCHAR), NULL, CAST(total AS DOUBLE), d + 30
    FROM n WHERE st = 'O' AND winners = 0 AND d + 30 - DATE '1998-08-01' BETWEEN 10 AND 32)
SELECT external_id, signal_type, event_date, org_name_raw, contract_end, round_even(value, 2) AS value, deadline,
  substr(sha256('vergabe_dovs|' || external_id), 1, 32) AS signal_id FROM sig
QUALIFY row_number() OVER (PARTITION BY external_id ORDER BY CAST(value AS VARCHAR) DESC) = 1"""))
def nested_signals(spark, d):
    found = signals.signals_of_notices(notices(spark, d), SINCE, DAY)
    return found.select("external_id", "signal_type", "event_date", "org_name_raw", "contract_end", F.bround("value", 2).alias("value"), "deadline",
                        signals.signal_id(F.col("source"), F.col("external_id")).alias("signal_id"))


@query("nested_winner_keys", nested(f"""
WITH {OUTCOMES} SELECT CAST(k AS VARCHAR) AS notice_id, array_to_string(list_sort(list(DISTINCT lower(s_name))), ';') AS winners
FROM pairs JOIN supplier ON s_suppkey = s WHERE won GROUP BY k"""))
def nested_winner_keys(spark, d):
    keys = F.array_join(F.array_sort(ops.winner_keys(F.col("awards"))), ";")
    return releases(spark, d).select(F.col("id").alias("notice_id"), keys.alias("winners")).filter("winners <> ''")


@query("nested_deadline_work", nested(f"""
WITH {OUTCOMES}
SELECT CAST(v.k AS VARCHAR) AS notice_id, o_orderdate::DATE AS d FROM verdicts v JOIN orders ON o_orderkey = v.k JOIN per_notice p ON p.k = v.k
WHERE v.is_it AND winners = 0 AND o_orderstatus = 'P' AND o_orderdate::DATE >= DATE '1998-08-01' - {rules.DEADLINE_LOOKBACK_DAYS}"""))
def nested_deadline_work(spark, d):
    return signals.tenders_without_deadline(notices(spark, d), DAY).select("notice_id", "d")
