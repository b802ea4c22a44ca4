"""Contract ends, deadlines, identity, change detection, scores and account lists."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lotwise import rules
from lotwise.functions.dates import as_of_lit
from lotwise.functions.scoring import resolution_confidence
from lotwise.functions.wording import why_now
from lotwise.operators import accounts, company, delta, quality, signals as ops
from lotwise.plans import views
from lotwise.plans.market import AGE_TEXT, OUTCOMES
from lotwise.plans.registry import query
from lotwise.plans.views import AS_OF, table

FIRST_END, SECOND_START = dt.datetime(2024, 1, 20), dt.datetime(2024, 1, 6)
SCORE_DAY = dt.date(2024, 3, 1)


# --- contract ends and deadlines -----------------------------------------------------------
@query("expiring_contracts", """
WITH lots AS (SELECT l_orderkey AS k, l_linenumber AS ln, max(l_shipdate)::DATE AS e FROM lineitem
              WHERE l_linestatus = 'O' GROUP BY 1, 2),
aw AS (SELECT l_orderkey AS k, l_linenumber AS ln, l_suppkey AS s,
         max(l_shipdate) FILTER (WHERE l_tax > 0.06)::DATE AS own FROM lineitem
       WHERE l_returnflag = 'A' AND l_linestatus = 'F' GROUP BY 1, 2, 3),
ends AS (SELECT aw.*, coalesce(own, (SELECT arg_min(e, lots.ln) FROM lots
            WHERE lots.k = aw.k AND lots.ln BETWEEN aw.ln AND aw.ln + 2)) AS period_end FROM aw)
SELECT k AS notice_id, s AS company_id, ln AS award_no, period_end,
       CAST(period_end - DATE '2000-01-01' AS BIGINT) AS days_left
FROM ends WHERE period_end - DATE '2000-01-01' BETWEEN 180 AND 270""")
def expiring_contracts(spark, d):
    li = table(spark, d, "lineitem")
    lots = li.filter("l_linestatus = 'O'").groupBy(
        F.col("l_orderkey").alias("notice_id"), F.col("l_linenumber").alias("lot_id")).agg(
        F.to_date(F.max("l_shipdate")).alias("contract_end"))
    awards = li.filter(views.won_line()).groupBy(
        F.col("l_orderkey").alias("notice_id"), F.col("l_linenumber").alias("award_no"),
        F.col("l_suppkey").alias("company_id")).agg(
        F.to_date(F.max(F.when(F.col("l_tax") > 0.06, F.col("l_shipdate")))).alias("own_end"))
    n = F.col("award_no")
    awards = awards.withColumn("related_lots", F.array(n, n + 1, n + 2)).withColumn(
        "award_id", F.concat_ws(":", n.cast("string"), F.col("company_id").cast("string")))
    ends = ops.award_contract_ends(awards, lots)
    today = as_of_lit(AS_OF)
    return ends.filter(ops.within(F.col("period_end"), today, rules.EXPIRY_WINDOW)).select(
        "notice_id", "company_id", "award_no", "period_end",
        F.datediff("period_end", today).cast("long").alias("days_left"))


@query("open_deadlines", """
WITH own AS (SELECT l_orderkey AS k, min(l_shipdate)::DATE AS dl FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
xml AS (SELECT l_orderkey AS k, min(l_shipdate)::DATE AS dl FROM lineitem GROUP BY 1)
SELECT o_orderkey AS notice_id, o_custkey AS buyer, coalesce(own.dl, xml.dl) AS deadline,
  CAST(coalesce(own.dl, xml.dl) - DATE '2000-01-01' AS BIGINT) AS days_left
FROM orders LEFT JOIN own ON own.k = o_orderkey LEFT JOIN xml ON xml.k = o_orderkey
WHERE o_orderstatus = 'O' AND coalesce(own.dl, xml.dl) - DATE '2000-01-01' BETWEEN 10 AND 32""")
def open_deadlines(spark, d):
    """Own deadline first, looked-up one otherwise; both come from one pass over the lines."""
    today = as_of_lit(AS_OF)
    lookup = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("notice_id")).agg(
        F.to_date(F.min(F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")))).alias("own"),
        F.to_date(F.min("l_shipdate")).alias("xml"))
    rows = table(spark, d, "orders").filter("o_orderstatus = 'O'").select(
        F.col("o_orderkey").alias("notice_id"), F.col("o_custkey").alias("buyer")).join(lookup, "notice_id", "left")
    return (rows.withColumn("deadline", F.coalesce("own", "xml"))
            .filter(ops.within(F.col("deadline"), today, rules.DEADLINE_WINDOW))
            .select("notice_id", "buyer", "deadline", F.datediff("deadline", today).cast("long").alias("days_left")))


@query("bidder_signals", f"""
WITH {OUTCOMES}
SELECT k || ':bidder:' || s AS external_id, d AS event_date,
  CASE outcome WHEN 'alleinbieter_gewonnen' THEN 'zuschlag_gewonnen' WHEN 'unterlegen' THEN 'angebot_ohne_zuschlag'
       ELSE 'teilnahme_belegt' END AS signal_type
FROM rows_ WHERE outcome <> 'award' AND d >= DATE '1999-11-06'""")
def bidder_signals(spark, d):
    """Signals of bidders that are no named winners, within the look-back."""
    since = F.lit(delta.first_fetch_day(AS_OF)).cast("date")
    rows = views.outcomes(spark, d).filter(~F.col("is_winner") & (F.col("d") >= since))
    kind = (F.when(F.col("outcome") == "alleinbieter_gewonnen", F.lit(ops.WON))
            .when(F.col("outcome") == "unterlegen", F.lit(ops.NOT_AWARDED)).otherwise(F.lit(ops.TOOK_PART)))
    return rows.select(F.concat(F.col("notice_id").cast("string"), F.lit(":bidder:"),
                                F.col("company_id").cast("string")).alias("external_id"),
                       F.col("d").alias("event_date"), kind.alias("signal_type"))


# --- identity and change detection over the event stream --------------------------------------
def event_signals(spark, d):
    """Events as keyed content: key = user, type and k; content = value."""
    e = table(spark, d, "events")
    k = F.coalesce(F.get_json_object("props", "$.k"), F.lit("-"))
    return e.select(
        "event_id", "ts", F.col("event_type").alias("source"),
        F.concat_ws(":", F.col("user_id").cast("string"), k).alias("external_id"),
        F.bround(F.col("value") * 100, 0).cast("long").alias("cents"))


def identified(events):
    """Latest row per key with its identity and content hash."""
    last = ops.latest_per_key(events, ["source", "external_id"], [F.desc("ts"), F.desc("event_id")])
    return last.withColumn("signal_id", ops.signal_id(F.col("source"), F.col("external_id"))).withColumn(
        "content_hash", F.substring(F.sha2(F.col("cents").cast("string"), 256), 1, 32))


KEYED = """
ev AS (SELECT event_id, ts, event_type AS source,
         user_id || ':' || coalesce(json_extract_string(props, '$.k'), '-') AS external_id,
         CAST(round_even(value * 100, 0) AS BIGINT) AS cents FROM events)"""
LATEST = """SELECT *, substr(sha256(source || '|' || external_id), 1, 32) AS signal_id,
    substr(sha256(CAST(cents AS VARCHAR)), 1, 32) AS content_hash FROM ev {where}
    QUALIFY row_number() OVER (PARTITION BY source, external_id ORDER BY ts DESC, event_id DESC) = 1"""
DELTA = f"""{KEYED},
old AS ({LATEST.format(where="WHERE ts < TIMESTAMP '2024-01-20'")}),
new AS ({LATEST.format(where="WHERE ts >= TIMESTAMP '2024-01-06'")}),
st AS (SELECT new.*, CASE WHEN old.signal_id IS NULL THEN 'new' WHEN old.content_hash <> new.content_hash
         THEN 'changed' ELSE 'unchanged' END AS status FROM new LEFT JOIN old USING (signal_id))"""


@query("latest_per_key", f"WITH {KEYED} SELECT event_id, signal_id, content_hash FROM ({LATEST.format(where='')})")
def latest_per_key(spark, d):
    return identified(event_signals(spark, d)).select("event_id", "signal_id", "content_hash")


def two_batches(spark, d):
    """The stored first batch and the overlapping second one."""
    e = event_signals(spark, d)
    return (identified(e.filter(F.col("ts") < F.lit(FIRST_END))),
            identified(e.filter(F.col("ts") >= F.lit(SECOND_START))))


@query("delta_status", f"WITH {DELTA} SELECT signal_id, source, external_id, content_hash, status FROM st")
def delta_status(spark, d):
    old, new = two_batches(spark, d)
    return delta.classify_changes(new, old).select("signal_id", "source", "external_id", "content_hash", "status")


@query("run_stats", f"""
WITH {DELTA}
SELECT source, count(*) AS rows_in, count(*) FILTER (WHERE status = 'new') AS rows_new,
  count(*) FILTER (WHERE status = 'changed') AS rows_changed, count(*) FILTER (WHERE status = 'unchanged') AS rows_unchanged
FROM st GROUP BY ROLLUP (source)""")
def run_stats(spark, d):
    old, new = two_batches(spark, d)
    return delta.run_statistics(delta.classify_changes(new, old))


@query("emitted_signals", f"WITH {DELTA} SELECT signal_id, ts, status FROM st WHERE status <> 'unchanged'")
def emitted_signals(spark, d):
    old, new = two_batches(spark, d)
    rows = delta.classify_changes(new, old).withColumn("event_date", F.to_date("ts"))
    return delta.emitted(rows).select("signal_id", "ts", "status")


RUNS = """
runs AS (SELECT o_orderkey AS run_id, o_orderpriority AS source, o_orderdate AS started_at,
    CASE WHEN o_orderstatus = 'P' THEN 'HTTPError: 503' END AS errors FROM orders)"""


def run_log(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("run_id"), F.col("o_orderpriority").alias("source"),
        F.col("o_orderdate").alias("started_at"), F.col("o_orderdate").alias("finished_at"),
        F.when(F.col("o_orderstatus") == "P", F.lit("HTTPError: 503")).alias("errors"))


@query("fetch_since", f"""
WITH {RUNS} SELECT source, CAST(CAST(arg_max(started_at, run_id) AS DATE) - INTERVAL 14 DAY AS DATE) AS since
FROM runs WHERE errors IS NULL GROUP BY source""")
def fetch_since(spark, d):
    return delta.fetch_since(run_log(spark, d), AS_OF)


@query("late_rows", f"""
WITH {KEYED}, {RUNS.replace("runs AS", "all_runs AS")},
since AS (SELECT CASE source WHEN '1-URGENT' THEN 'click' WHEN '2-HIGH' THEN 'view' ELSE source END AS source,
   CAST(CAST(arg_max(started_at, run_id) AS DATE) - INTERVAL 14 DAY AS DATE) + 9000 AS d FROM all_runs WHERE errors IS NULL GROUP BY source)
SELECT event_id, ev.source, ev.ts::DATE < coalesce(since.d, DATE '2024-01-16') AS late FROM ev LEFT JOIN since USING (source)""")
def late_rows(spark, d):
    """Rows older than the day their source is read from, kept apart."""
    since = delta.fetch_since(run_log(spark, d), AS_OF).withColumn("since", F.date_add("since", 9000)).withColumn(
        "source", F.when(F.col("source") == "1-URGENT", F.lit("click")).when(F.col("source") == "2-HIGH", F.lit("view"))
        .otherwise(F.col("source")))
    e = event_signals(spark, d).withColumn("event_date", F.to_date("ts"))
    return delta.tag_late(e, since, dt.date(2024, 1, 16)).select("event_id", "source", "late")


@query("last_runs", f"WITH {RUNS} SELECT run_id, source, errors FROM runs ORDER BY run_id DESC LIMIT 20")
def last_runs(spark, d):
    return delta.last_runs(run_log(spark, d)).select("run_id", "source", "errors")


# --- accounts and scores -------------------------------------------------------------------------
TYPES = {"click": "teilnahme_belegt", "view": "zuschlag_gewonnen", "error": "angebot_ohne_zuschlag",
         "purchase": "rahmenvertrag_laeuft_aus", "signup": "bid_rolle_ausgeschrieben"}
TYPE_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TYPES.items()) + " END"
EVENT_SIGNALS = f"""
sig AS (SELECT event_id, CAST(user_id AS VARCHAR) AS account_id, {TYPE_SQL} AS signal_type, ts::DATE AS event_date,
  CASE WHEN user_id % 5 = 0 THEN 'ba_jobs' WHEN event_type IN ('click', 'signup') THEN 'ba_jobs'
       WHEN event_type = 'view' THEN 'ted' ELSE 'vergabe_dovs' END AS source,
  value >= 150 AS is_buyer_side, round_even(0.5::DOUBLE + (event_id % 50) / 100.0::DOUBLE, 3) AS match_confidence,
  sha256(CAST(event_id AS VARCHAR)) AS signal_id FROM events),
active AS (SELECT * FROM sig WHERE event_date >= DATE '2024-03-01' - 56),
universe AS (SELECT DISTINCT account_id FROM active WHERE source IN ('vergabe_dovs', 'ted') AND NOT is_buyer_side),
tagged AS (SELECT a.*, CASE WHEN is_buyer_side THEN 'buyer_side'
     WHEN source = 'ba_jobs' AND u.account_id IS NULL THEN 'job_check' ELSE 'account' END AS bucket
   FROM active a LEFT JOIN universe u USING (account_id))"""
TIERS = """
procs AS (SELECT o_custkey AS c, count(*) AS n, max(o_orderdate)::DATE AS last FROM orders
          WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1),
tiers AS (SELECT CAST(c AS VARCHAR) AS account_id, n, last,
   CASE WHEN n >= 3 AND DATE '2000-01-01' - last <= 180 THEN 'A' WHEN n >= 2 OR DATE '2000-01-01' - last <= 180 THEN 'B'
        ELSE 'C' END AS tier FROM procs)"""
FIT = "CASE tier WHEN 'A' THEN 1.0 WHEN 'B' THEN 0.8 WHEN 'C' THEN 0.6 ELSE 0.3 END::DOUBLE"
WEIGHT = "CASE signal_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in rules.SIGNAL_WEIGHTS.items()) + " ELSE 1 END"
SCORED = f"""{EVENT_SIGNALS}, {TIERS},
ready AS (SELECT t.*, coalesce(x.tier, 'C') AS tier, x.tier IS NOT NULL AS listed FROM tagged t
          LEFT JOIN tiers x USING (account_id) WHERE bucket = 'account'),
scored AS (SELECT *, round_even({WEIGHT} *
   CASE WHEN DATE '2024-03-01' - event_date <= 14 THEN 1.0 WHEN DATE '2024-03-01' - event_date <= 28 THEN 0.8
        WHEN DATE '2024-03-01' - event_date <= 42 THEN 0.6 WHEN DATE '2024-03-01' - event_date <= 56 THEN 0.4 ELSE 0.2 END::DOUBLE
   * (0.4::DOUBLE + 0.6::DOUBLE * {FIT}) * (0.4::DOUBLE + 0.6::DOUBLE * match_confidence), 3) AS raw FROM ready),
acc AS (SELECT account_id, any_value(tier) AS tier, any_value(listed) AS in_market_list, max(raw) AS best_raw, count(*) AS signal_count,
   count(DISTINCT signal_type) AS n_types, array_to_string(list_sort(list(DISTINCT signal_type)), ';') AS signal_types
   FROM scored GROUP BY account_id),
final AS (SELECT *, CASE WHEN n_types >= 2 THEN 2.0::DOUBLE * {FIT} ELSE 0.0::DOUBLE END AS stack,
   CAST(round_even(least((best_raw + CASE WHEN n_types >= 2 THEN 2.0::DOUBLE * {FIT} ELSE 0.0::DOUBLE END) / 12.0::DOUBLE, 1.0) * 100, 0) AS INTEGER) AS score
   FROM acc)"""


def event_account_signals(spark, d):
    e, u = table(spark, d, "events"), F.col("user_id")
    kind = F.create_map(*[F.lit(x) for pair in TYPES.items() for x in pair])[F.col("event_type")]
    src = (F.when((u % 5 == 0) | F.col("event_type").isin("click", "signup"), F.lit(rules.JOB_SOURCE))
           .when(F.col("event_type") == "view", F.lit("ted")).otherwise(F.lit("vergabe_dovs")))
    k = F.get_json_object("props", "$.k")
    return e.select(
        "event_id", u.cast("string").alias("company_id"), F.concat(F.lit("Firma "), u.cast("string")).alias("org_name_raw"),
        kind.alias("signal_type"), F.to_date("ts").alias("event_date"), F.col("ts").alias("event_ts"), src.alias("source"),
        (F.col("value") >= 150).alias("is_buyer_side"),
        F.bround(F.lit(0.5) + (F.col("event_id") % 50) / F.lit(100.0), 3).alias("match_confidence"),
        F.sha2(F.col("event_id").cast("string"), 256).alias("signal_id"),
        F.concat(F.lit("Verfahren "), k).alias("title"),
        F.when(u % 2 == 0, F.concat(F.lit("Stelle "), (u % 7).cast("string"))).alias("buyer"),
        F.when(u % 3 == 0, F.lit("Ort")).alias("org_place"), F.lit(None).cast("string").alias("source_url"),
        F.when(u % 4 != 0, F.date_add(F.to_date("ts"), 200)).alias("contract_end"),
        F.when(u % 5 != 0, F.date_add(F.to_date("ts"), 60)).alias("deadline"))


def customer_tiers(spark, d):
    """Tier per customer from its procedures of one year."""
    o = table(spark, d, "orders").filter((F.col("o_orderdate") >= F.lit(dt.datetime(1999, 1, 1)))
                                         & (F.col("o_orderdate") < F.lit(dt.datetime(2000, 1, 1))))
    return o.groupBy(F.col("o_custkey").cast("string").alias("account_id")).agg(
        F.count(F.lit(1)).alias("participations_total"), F.to_date(F.max("o_orderdate")).alias("proof_date"),
        F.count_distinct("o_orderpriority").alias("buyers_total")).withColumn(
        "proof_type", F.lit("P1D_ausgang_offen")).withColumn("mixed_lot_only", F.lit(False)).withColumn(
        "t", company.tier_of(F.col("proof_type"), F.col("participations_total"),
                             F.datediff(as_of_lit(AS_OF), F.col("proof_date")), F.col("buyers_total"),
                             F.col("mixed_lot_only"))).select("*", "t.*").drop("t")


def scored(spark, d):
    active = ops.active_signals(event_account_signals(spark, d), SCORE_DAY)
    return accounts.scored_signals(accounts.account_rows(active, customer_tiers(spark, d)), SCORE_DAY)


@query("active_accounts", f"WITH {EVENT_SIGNALS} SELECT event_id, account_id, bucket FROM tagged")
def active_accounts(spark, d):
    active = ops.active_signals(event_account_signals(spark, d), SCORE_DAY)
    return accounts.tag_buckets(active).select("event_id", "account_id", "bucket")


@query("unproven_job_ads", f"""
WITH {EVENT_SIGNALS} SELECT event_id, account_id FROM active a
WHERE source = 'ba_jobs' AND NOT EXISTS (SELECT 1 FROM universe u WHERE u.account_id = a.account_id)""")
def unproven_job_ads(spark, d):
    _, rest = accounts.proven_job_ads(ops.active_signals(event_account_signals(spark, d), SCORE_DAY))
    return rest.select("event_id", "account_id")


@query("account_score", f"""
WITH {SCORED} SELECT account_id, tier, in_market_list, signal_count, n_types, signal_types, best_raw,
  round_even(stack, 3) AS stacking_bonus, score, score >= 40 AS enrich FROM final""")
def account_score(spark, d):
    return accounts.account_scores(scored(spark, d)).withColumn("n_types", F.col("n_types").cast("long"))


ORDER = "ORDER BY raw DESC, event_date DESC, signal_id"


@query("score_trace_top5", f"""
WITH {SCORED} SELECT account_id, row_number() OVER (PARTITION BY account_id {ORDER}) AS rank, event_id, raw, signal_type
FROM scored QUALIFY row_number() OVER (PARTITION BY account_id {ORDER}) <= 5""")
def score_trace_top5(spark, d):
    return accounts.driver_signals(scored(spark, d), accounts.TRACE_SIGNALS).select(
        "account_id", F.col("rank").cast("long").alias("rank"), "event_id", "raw", "signal_type")


RECENCY = """CASE WHEN DATE '2024-03-01' - event_date <= 14 THEN 1.0 WHEN DATE '2024-03-01' - event_date <= 28 THEN 0.8
   WHEN DATE '2024-03-01' - event_date <= 42 THEN 0.6 WHEN DATE '2024-03-01' - event_date <= 56 THEN 0.4 ELSE 0.2 END::DOUBLE"""


@query("score_trace", f"""
WITH {SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY account_id {ORDER}) AS rank FROM scored)
SELECT r.account_id, f.score, f.tier, f.signal_count, round_even(f.stack, 3) AS stacking_bonus, rank, r.signal_type, event_date,
  CAST({WEIGHT} AS DOUBLE) AS weight, {RECENCY} AS recency, round_even(0.4::DOUBLE + 0.6::DOUBLE * {FIT.replace('tier', 'r.tier')}, 3) AS icp_fit_dampened,
  match_confidence AS confidence, round_even(0.4::DOUBLE + 0.6::DOUBLE * match_confidence, 3) AS confidence_dampened, raw,
  rank = 1 AS is_driver
FROM r JOIN final f USING (account_id) WHERE rank <= 5""")
def score_trace(spark, d):
    """The trace read back from its JSON, one row per signal in it."""
    one = "rank long, signal_type string, event_date date, weight double, recency double, icp_fit_dampened double, confidence double, confidence_dampened double, raw double, signal_id string"
    text = f"formula string, tier string, signal_count long, stacking_bonus double, driver struct<{one.replace(' ', ':').replace(',:', ', ')}>, top array<struct<{one.replace(' ', ':').replace(',:', ', ')}>>"
    parsed = accounts.score_trace(scored(spark, d)).withColumn("j", F.from_json("score_components", text))
    rows = parsed.select("account_id", "score", "j.tier", "j.signal_count", "j.stacking_bonus", F.col("j.driver.signal_id").alias("driver"),
                         F.explode("j.top").alias("s"))
    return rows.select("account_id", "score", "tier", "signal_count", "stacking_bonus", "s.*", (F.col("s.signal_id") == F.col("driver")).alias("is_driver")).drop("signal_id")


@query("account_list", f"""
WITH {SCORED}, best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY account_id {ORDER}) = 1)
SELECT f.account_id AS company_id, f.tier, score, b.signal_type, b.event_date AS signal_datum, signal_count AS signal_anzahl,
  signal_types AS signal_typen, b.match_confidence, in_market_list AS in_longlist_1, score >= 40 AS enrich
FROM final f JOIN best b USING (account_id)""")
def account_list(spark, d):
    active = ops.active_signals(event_account_signals(spark, d), SCORE_DAY)
    return accounts.account_signals(active, customer_tiers(spark, d), SCORE_DAY).select(
        "company_id", "tier", "score", "signal_type", "signal_datum", "signal_anzahl", "signal_typen",
        "match_confidence", "in_longlist_1", "enrich")


@query("why_now", f"""
WITH s AS (SELECT event_id, user_id AS u, event_type, {TYPE_SQL} AS signal_type, strftime(ts, '%d.%m.%Y') AS dd,
   coalesce('Verfahren ' || json_extract_string(props, '$.k'), 'dem Verfahren') AS t,
   CASE WHEN user_id % 2 = 0 THEN 'Stelle ' || user_id % 7 ELSE 'Firma ' || user_id END AS b,
   CASE WHEN user_id % 4 <> 0 THEN strftime(ts + INTERVAL 200 DAY, '%d.%m.%Y') ELSE 'zuletzt' END AS ce,
   CASE WHEN user_id % 3 = 0 THEN ', Standort Ort' ELSE '' END AS p FROM events)
SELECT event_id, CASE event_type
  WHEN 'purchase' THEN 'Ihr Rahmenvertrag „' || t || '“ mit ' || b || ' endet am ' || ce || ' — die Neuausschreibung startet erfahrungsgemäß rund sechs Monate vorher.'
  WHEN 'view' THEN 'Sie haben am ' || dd || ' den Zuschlag für „' || t || '“ (' || b || ') erhalten — im selben CPV-Segment laufen aktuell weitere Verfahren.'
  WHEN 'signup' THEN 'Sie suchen seit ' || dd || ' eine Verstärkung im Angebotsmanagement (' || t || p || ') — das Verfahrensvolumen wächst offenbar schneller als das Team.'
  ELSE 'Signal ' || signal_type || ' vom ' || dd || '.' END AS why_now FROM s""")
def why_now_texts(spark, d):
    return event_account_signals(spark, d).select("event_id", why_now(
        F.col("signal_type"), F.col("title"), F.col("buyer"), F.col("org_name_raw"), F.col("org_place"),
        F.col("event_date"), F.col("contract_end"), F.datediff("deadline", F.col("event_date"))).alias("why_now"))


@query("type_coverage", f"""
WITH types(signal_type, weight) AS (VALUES {', '.join(f"('{k}', {v})" for k, v in rules.SIGNAL_WEIGHTS.items())}),
seen AS (SELECT {TYPE_SQL} AS signal_type, count(*) AS n FROM events GROUP BY 1)
SELECT signal_type, weight, coalesce(n, 0) AS n, coalesce(n, 0) = 0 AS silent FROM types LEFT JOIN seen USING (signal_type)""")
def type_coverage(spark, d):
    return delta.type_coverage(event_account_signals(spark, d))


@query("resolution_confidence", """
WITH c AS (SELECT event_id, round_even(least(CASE WHEN user_id % 5 = 0 OR event_type IN ('click', 'signup') THEN 0.5
    WHEN event_type = 'view' THEN 0.72 ELSE 0.75 END::DOUBLE + CASE WHEN user_id % 3 = 0 THEN 0.1 ELSE 0 END::DOUBLE
    + CASE WHEN user_id % 2 = 0 THEN 0.15 ELSE 0 END::DOUBLE, 1.0), 3) AS base, user_id % 7 = 0 AS joint FROM events),
s AS (SELECT event_id, round_even(greatest(base - CASE WHEN joint THEN 0.1 ELSE 0 END::DOUBLE, 0.0), 3) AS confidence FROM c)
SELECT event_id, confidence, confidence < 0.70 AS review FROM s""")
def confidences(spark, d):
    s = event_account_signals(spark, d)
    conf = resolution_confidence(F.col("source"), F.lit(1.0), F.col("org_place").isNotNull(),
                                 F.col("buyer").isNotNull(), F.lit(False), F.col("company_id").cast("long") % 7 == 0)
    return s.select("event_id", conf.alias("confidence")).withColumn(
        "review", F.col("confidence") < rules.MIN_RESOLUTION_CONFIDENCE)


@query("customer_tiers", f"""
WITH {TIERS}, b AS (SELECT CAST(o_custkey AS VARCHAR) AS account_id, count(DISTINCT o_orderpriority) AS buyers FROM orders
    WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1),
x AS (SELECT *, CAST(DATE '2000-01-01' - last AS BIGINT) AS age FROM tiers JOIN b USING (account_id)),
y AS (SELECT *, {AGE_TEXT.format(a="age")} AS txt,
   CASE WHEN buyers > 1 THEN ', ' || buyers || ' verschiedene Auftraggeber' ELSE '' END AS br FROM x)
SELECT account_id, n AS participations, last AS proof_date, tier, 'teilnahme_offen' AS tier_status,
  CASE WHEN n >= 3 AND age <= 180 THEN n || ' Verfahren in 12 Monaten, ' || txt || br || ' - laufender Angebotsprozess'
       WHEN n >= 2 THEN n || ' Verfahren in 12 Monaten, ' || txt || br || ' - wiederkehrender Bieter'
       WHEN age <= 180 THEN '1 Verfahren, ' || txt || ' - Teilnahme aktuell, aber bisher einmalig'
       ELSE n || ' Verfahren, ' || txt || ' - Teilnahme belegt, aber weder haeufig noch aktuell' END AS tier_rationale FROM y""")
def tiers(spark, d):
    return customer_tiers(spark, d).select(
        "account_id", F.col("participations_total").alias("participations"), "proof_date", "tier", "tier_status",
        "tier_rationale")


@query("tier_transition", f"""
WITH {TIERS} SELECT tier AS tier_before, CASE WHEN n >= 3 AND DATE '2000-06-29' - last <= 180 THEN 'A'
  WHEN n >= 2 OR DATE '2000-06-29' - last <= 180 THEN 'B' ELSE 'C' END AS tier_after, count(*) AS companies
FROM tiers GROUP BY 1, 2""")
def tier_transition(spark, d):
    return company.tier_transitions(company.retier(customer_tiers(spark, d), AS_OF + dt.timedelta(days=180)))


ROLLING = """
WITH w AS (SELECT CAST(user_id AS VARCHAR) AS account_id, ts,
   make_timestamp(CAST(floor(epoch(ts) / 604800.0) * 604800 AS BIGINT) * 1000000) AS last FROM events),
x AS (SELECT account_id, last - to_days(7 * i) AS window_start FROM w, range(8) r(i))
SELECT account_id, window_start, window_start + INTERVAL 56 DAY AS window_end, count(*) AS signals FROM x GROUP BY ALL"""


@query("rolling_activity", ROLLING)
def rolling_activity(spark, d):
    return accounts.rolling_activity(accounts.account_key(event_account_signals(spark, d)))


@query("open_tender_bidders", f"""
WITH {OUTCOMES.replace("v ON v.k = p.k WHERE v.is_it", "v ON v.k = p.k WHERE v.is_it")},
ot AS (SELECT o_custkey AS buyer, v.main[1:7] AS code_prefix, count(*) AS open_tenders,
   min((o_orderdate::DATE + 30, o_orderkey)) AS nx FROM orders JOIN verdicts v ON v.k = o_orderkey
   WHERE o_orderstatus = 'O' AND v.is_it AND main IS NOT NULL GROUP BY 1, 2),
past AS (SELECT buyer, main[1:7] AS code_prefix, s AS company_id, count(*) AS past_bids, max(d) AS last_bid FROM rows_
   WHERE main IS NOT NULL AND NOT won GROUP BY 1, 2, 3)
SELECT company_id, CAST(buyer AS VARCHAR) AS buyer, code_prefix, past_bids, last_bid, open_tenders,
  nx[2] AS next_notice, nx[1] AS next_deadline FROM past JOIN ot USING (buyer, code_prefix)""")
def open_tender_bidders(spark, d):
    scope = views.notice_verdicts(spark, d).filter("is_it AND main_cpv IS NOT NULL").select(
        "notice_id", F.substring("main_cpv", 1, 7).alias("code_prefix"))
    open_ = table(spark, d, "orders").filter("o_orderstatus = 'O'").select(
        F.col("o_orderkey").alias("notice_id"), F.col("o_custkey").cast("string").alias("buyer"),
        F.date_add(F.to_date("o_orderdate"), 30).alias("deadline")).join(scope, "notice_id")
    past = views.outcomes(spark, d).filter(~F.col("is_winner") & F.col("main_cpv").isNotNull()).withColumn(
        "code_prefix", F.substring("main_cpv", 1, 7))
    return quality.open_tender_bidders(open_, past)


@query("winner_keys", """
SELECT DISTINCT l_orderkey AS notice_id, l_suppkey AS company_id FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F'""")
def winner_keys(spark, d):
    return views.parties(spark, d).filter("is_winner").select("notice_id", "company_id").distinct()


@query("review_queue", """
WITH c AS (SELECT event_id, user_id, event_type, round_even(0.5::DOUBLE + (event_id % 50) / 100.0::DOUBLE, 3) AS confidence FROM events)
SELECT substr(sha256(event_type || '|' || user_id || ':' || event_id), 1, 32) AS signal_id, 'Firma ' || user_id AS org_name_raw,
  'confidence unter Schwelle' AS reason FROM c WHERE confidence < 0.70""")
def review_queue(spark, d):
    e = event_account_signals(spark, d).withColumn("external_id", F.concat_ws(":", "company_id", F.col("event_id").cast("string")))
    kinds = {v: k for k, v in TYPES.items()}
    named = e.withColumn("source", F.create_map(*[F.lit(x) for p in kinds.items() for x in p])[F.col("signal_type")])
    return ops.review_queue(named).select("signal_id", "org_name_raw", "reason")
