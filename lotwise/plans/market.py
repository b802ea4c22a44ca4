"""Market list, verdicts, outcomes and tiers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lotwise import rules
from lotwise.functions.dates import age_days, as_of_lit
from lotwise.functions.scoring import tier_of
from lotwise.operators import company, parties as ops, signals
from lotwise.plans import views
from lotwise.plans.registry import query
from lotwise.session import landed

# Oracle fragments: the same concepts in plain SQL.
CODES = """
code_rows AS (SELECT l_orderkey AS k, l_linenumber AS ln, p_brand AS b
              FROM lineitem JOIN part ON l_partkey = p_partkey),
codes AS (SELECT k, min(b) FILTER (WHERE ln = 1) AS main, count(DISTINCT b) AS n,
                 count(DISTINCT b) FILTER (WHERE starts_with(b, 'Brand#1')) AS n_it,
                 list_sort(list(DISTINCT b)) AS every, list_sort(list(DISTINCT b))[1:12] AS kept
          FROM code_rows GROUP BY k),
verdicts AS (SELECT k, main, n, n_it, kept, every, n_it::DOUBLE / n AS share,
                    CASE WHEN main IS NOT NULL THEN starts_with(main, 'Brand#1')
                         ELSE n_it::DOUBLE / n >= 0.5 END AS is_it,
                    n >= 8 AND n_it::DOUBLE / n < 0.5 AS mixed
             FROM codes)"""
OUTCOMES = CODES + """,
pairs AS (SELECT l_orderkey AS k, l_suppkey AS s, bool_or(l_returnflag = 'A' AND l_linestatus = 'F') AS won,
                 count(*) FILTER (WHERE l_returnflag = 'A' AND l_linestatus = 'F') AS won_rows
          FROM lineitem GROUP BY 1, 2),
per_notice AS (SELECT k, count(*) FILTER (WHERE won) AS winners, count(*) AS bidders FROM pairs GROUP BY k),
rows_ AS (SELECT p.k, p.s, p.won, p.won_rows, n.winners, n.bidders, o.o_orderdate::DATE AS d, o.o_custkey AS buyer,
                o.o_orderpriority = '5-LOW' AS consortium, v.main, v.mixed, v.every, v.share,
                CASE WHEN p.won THEN 'award'
                     WHEN o.o_orderstatus = 'F' AND n.winners = 0 AND n.bidders = 1 THEN 'alleinbieter_gewonnen'
                     WHEN n.winners > 0 THEN 'unterlegen' ELSE 'offen' END AS outcome
         FROM pairs p JOIN per_notice n USING (k) JOIN orders o ON o.o_orderkey = p.k
         JOIN verdicts v ON v.k = p.k WHERE v.is_it)"""

AGE_TEXT = """CASE WHEN {a} IS NULL THEN 'ohne Datum' WHEN {a} <= 1 THEN 'juengster Beleg von heute'
 WHEN {a} <= 31 THEN 'juengster Beleg vor ' || {a} || ' Tagen'
 ELSE 'juengster Beleg vor ' || ({a} // 30) || ' Monat' || CASE WHEN {a} // 30 = 1 THEN '' ELSE 'en' END END"""


@query("notice_verdict", f"""
WITH {CODES}
SELECT k AS notice_id, is_it, main AS main_cpv, round_even(share, 3) AS it_share, n AS cpv_count,
       array_to_string(kept, ';') AS cpv_codes, mixed AS mixed_lot,
       CASE WHEN main IS NOT NULL THEN 'Hauptklassifikation ' || main ||
                 CASE WHEN starts_with(main, 'Brand#1') THEN ' ist IT' ELSE ' ist nicht IT' END
            ELSE 'keine Hauptklassifikation; IT-Anteil ' || n_it || '/' || n || ' = '
                 || CAST(round_even(share * 100, 0) AS INTEGER) || '%'
                 || CASE WHEN share >= 0.5 THEN ' >= ' ELSE ' < ' END || '50%' END AS reason
FROM verdicts""")
def notice_verdict(spark, d):
    return views.notice_verdicts(spark, d).select(
        "notice_id", "is_it", "main_cpv", "it_share", F.col("cpv_count").cast("long").alias("cpv_count"),
        F.array_join("cpv_codes", ";").alias("cpv_codes"), "mixed_lot", "reason")


@query("bidder_outcome", f"""
WITH {OUTCOMES}
SELECT k AS notice_id, s AS company_id, outcome, winners, bidders, won_rows AS award_rows FROM rows_""")
def bidder_outcome(spark, d):
    return views.outcomes(spark, d).select(
        "notice_id", "company_id", "outcome", "winners", "bidders", "award_rows")


@query("losing_bidders", """
SELECT DISTINCT l_orderkey AS notice_id, l_suppkey AS company_id FROM lineitem
EXCEPT
SELECT l_orderkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F'""")
def losing_bidders(spark, d):
    return ops.losing_bidders(views.parties(spark, d))


MARKET = OUTCOMES + """,
firm AS (SELECT s, count(*) FILTER (WHERE outcome = 'award') AS awards_total,
   CAST(sum(won_rows) AS BIGINT) AS award_rows,
   max(d) FILTER (WHERE outcome = 'award') AS last_award_date,
   count(*) FILTER (WHERE outcome = 'alleinbieter_gewonnen') AS sole_bidder_wins,
   count(*) FILTER (WHERE outcome = 'unterlegen') AS bids_lost,
   count(*) FILTER (WHERE outcome = 'offen') AS bids_outcome_unknown,
   max(d) FILTER (WHERE outcome <> 'award') AS last_bid_date,
   count(*) AS participations_total, bool_and(mixed) AS mixed_lot_only, bool_and(consortium) AS consortium_only,
   count(DISTINCT buyer) AS buyers_total,
   array_to_string(list_sort(list(DISTINCT CAST(buyer AS VARCHAR)))[1:5], ';') AS buyers,
   array_to_string(list_sort(list(DISTINCT 'ORG-' || bidders)), ';') AS supplier_ids,
   arg_min(main, (CASE WHEN outcome = 'award' THEN 0 ELSE 1 END, d, CAST(k AS VARCHAR)))
     FILTER (WHERE main IS NOT NULL) AS main_cpv,
   arg_max(CAST(k AS VARCHAR), (d, CAST(k AS VARCHAR))) FILTER (WHERE outcome = 'award') AS pa,
   arg_max(CAST(k AS VARCHAR), (d, CAST(k AS VARCHAR))) FILTER (WHERE outcome = 'unterlegen') AS pl,
   arg_max(CAST(k AS VARCHAR), (d, CAST(k AS VARCHAR))) FILTER (WHERE outcome = 'alleinbieter_gewonnen') AS ps,
   arg_max(CAST(k AS VARCHAR), (d, CAST(k AS VARCHAR))) FILTER (WHERE outcome = 'offen') AS po,
   max(d) FILTER (WHERE outcome = 'unterlegen') AS dl,
   max(d) FILTER (WHERE outcome = 'alleinbieter_gewonnen') AS ds, max(d) FILTER (WHERE outcome = 'offen') AS do_
 FROM rows_ GROUP BY s),
profile AS (SELECT s, array_to_string(list_sort(list(DISTINCT c))[1:10], ';') AS cpv_profile
            FROM (SELECT s, unnest(every) AS c FROM rows_) GROUP BY s),
proofs AS (SELECT firm.*,
   CASE WHEN last_award_date IS NOT NULL THEN
          CASE WHEN DATE '2000-01-01' - last_award_date <= 730 THEN 'P1_zuschlag_24m'
               WHEN DATE '2000-01-01' - last_award_date <= 1460 THEN 'P2_zuschlag_48m' ELSE 'P3_rahmenvertrag' END
        WHEN pl IS NOT NULL THEN 'P1B_bieter_unterlegen' WHEN ps IS NOT NULL THEN 'P1C_alleinbieter'
        WHEN po IS NOT NULL THEN 'P1D_ausgang_offen' ELSE 'P6_nur_branche' END AS proof_type,
   CASE WHEN last_award_date IS NOT NULL THEN last_award_date WHEN pl IS NOT NULL THEN dl
        WHEN ps IS NOT NULL THEN ds ELSE do_ END AS proof_date,
   CASE WHEN last_award_date IS NOT NULL THEN pa WHEN pl IS NOT NULL THEN pl
        WHEN ps IS NOT NULL THEN ps ELSE po END AS proof_id FROM firm),
aged AS (SELECT proofs.*, DATE '2000-01-01' - proof_date AS age FROM proofs),
market AS (SELECT CAST(aged.s AS VARCHAR) AS company_id, s_name AS legal_name, n_name AS city,
   CASE WHEN mixed_lot_only THEN 'C' WHEN proof_type = 'P3_rahmenvertrag' THEN 'C'
        WHEN proof_type = 'P6_nur_branche' THEN 'D'
        WHEN participations_total >= 3 AND age <= 180 THEN 'A' WHEN participations_total >= 2 THEN 'B'
        WHEN age <= 180 THEN 'B' ELSE 'C' END AS tier,
   CASE proof_type WHEN 'P1_zuschlag_24m' THEN 'zuschlag_benannt' WHEN 'P2_zuschlag_48m' THEN 'zuschlag_benannt'
        WHEN 'P1B_bieter_unterlegen' THEN 'zuschlag_benannt' WHEN 'P1C_alleinbieter' THEN 'zuschlag_erschlossen'
        WHEN 'P1D_ausgang_offen' THEN 'teilnahme_offen' WHEN 'P3_rahmenvertrag' THEN 'schwacher_beleg'
        ELSE 'kein_beleg' END AS tier_status,
   proof_type,
   CASE proof_type WHEN 'P1_zuschlag_24m' THEN 0.95 WHEN 'P2_zuschlag_48m' THEN 0.85
        WHEN 'P1B_bieter_unterlegen' THEN 0.90 WHEN 'P1C_alleinbieter' THEN 0.85
        WHEN 'P1D_ausgang_offen' THEN 0.88 WHEN 'P3_rahmenvertrag' THEN 0.80 ELSE 0.20 END::DOUBLE AS proof_confidence,
   'https://oeffentlichevergabe.de/api/notices/' || proof_id || '?format=pdf' AS proof_url, proof_date,
   awards_total, award_rows, last_award_date, sole_bidder_wins, bids_lost, bids_outcome_unknown, last_bid_date,
   participations_total,
   round_even((awards_total + sole_bidder_wins)::DOUBLE
              / nullif(awards_total + sole_bidder_wins + bids_lost, 0), 2) AS win_rate,
   buyers, buyers_total, cpv_profile, main_cpv, mixed_lot_only, consortium_only, supplier_ids, 'dovs' AS sources,
   age
 FROM aged JOIN profile USING (s) JOIN supplier ON s_suppkey = aged.s LEFT JOIN nation ON n_nationkey = s_nationkey)"""
AGE = AGE_TEXT.format(a="age")
MARKET_SQL_COLUMNS = """company_id, legal_name, city, tier, tier_status, proof_type, proof_confidence, proof_url,
 proof_date, awards_total, award_rows, last_award_date, sole_bidder_wins, bids_lost, bids_outcome_unknown,
 last_bid_date, participations_total, win_rate, buyers, buyers_total, cpv_profile, main_cpv, mixed_lot_only,
 consortium_only, supplier_ids, sources"""
MARKET_COLUMNS = [c.strip() for c in MARKET_SQL_COLUMNS.replace("\n", " ").split(",")] + ["tier_rationale"]


def market_rows(spark, d):
    """Participations, computed once for the counts and the facts of the list."""
    return landed(views.participations(spark, d), "participations")


@query("market_list", f"""
WITH {MARKET}
SELECT {MARKET_SQL_COLUMNS},
  CASE WHEN mixed_lot_only THEN 'nur ueber Sammelvergabe mit fachfremden Gewerken belegt - IT-Eigenschaft nicht gesichert, vor Ansprache pruefen'
   WHEN proof_type = 'P3_rahmenvertrag' THEN 'Public-Sector-Bezug belegt, aber kein Zuschlag und keine Bieterrolle gefunden'
   WHEN proof_type = 'P6_nur_branche' THEN 'kein belegter Public-Sector-Bezug'
   WHEN participations_total >= 2 THEN participations_total || ' Verfahren in 12 Monaten, ' || {AGE}
     || CASE WHEN buyers_total > 1 THEN ', ' || buyers_total || ' verschiedene Auftraggeber' ELSE '' END
     || CASE WHEN participations_total >= 3 AND age <= 180 THEN ' - laufender Angebotsprozess'
             ELSE ' - wiederkehrender Bieter' END
   WHEN age <= 180 THEN '1 Verfahren, ' || {AGE} || ' - Teilnahme aktuell, aber bisher einmalig'
   ELSE participations_total || ' Verfahren, ' || {AGE} || ' - Teilnahme belegt, aber weder haeufig noch aktuell'
  END AS tier_rationale
FROM market""")
def market_list(spark, d):
    return company.market_list(market_rows(spark, d), views.AS_OF).select(*MARKET_COLUMNS)


@query("market_summary", f"""
WITH {MARKET}
SELECT count(*) AS companies, count(*) FILTER (WHERE tier = 'A') AS tier_a, count(*) FILTER (WHERE tier = 'B') AS tier_b,
  count(*) FILTER (WHERE tier = 'C') AS tier_c, count(*) FILTER (WHERE tier = 'D') AS tier_d,
  count(*) FILTER (WHERE consortium_only) AS consortium_only, count(*) FILTER (WHERE awards_total > 1) AS several_awards,
  count(*) FILTER (WHERE award_rows > 0) AS named_award,
  count(*) FILTER (WHERE award_rows = 0 AND sole_bidder_wins > 0) AS sole_winners,
  count(*) FILTER (WHERE bids_lost > 0) AS losing_bidders, count(*) FILTER (WHERE bids_lost > 1) AS lost_more_than_once,
  count(*) FILTER (WHERE award_rows = 0 AND sole_bidder_wins = 0 AND bids_lost = 0) AS outcome_open,
  count(*) AS without_domain
FROM market""")
def market_summary(spark, d):
    return company.market_summary(company.market_list(market_rows(spark, d), views.AS_OF))


@query("open_work_list", f"""
WITH {MARKET}
SELECT company_id, legal_name, city AS ort, '' AS plz, tier, participations_total AS verfahren_12m,
  array_to_string(string_split(cpv_profile, ';')[1:3], ';') AS cpv_kurz, proof_url FROM market""")
def open_work_list(spark, d):
    return company.open_work_list(company.market_list(market_rows(spark, d), views.AS_OF))
