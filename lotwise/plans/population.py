"""Completeness estimates over customers as companies."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lotwise.operators import population as ops, quality
from lotwise.plans.registry import query
from lotwise.plans.views import table

YEAR = (dt.datetime(1999, 1, 1), dt.datetime(2000, 1, 1))


def dated_orders(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("notice_id"), F.col("o_custkey").alias("company_id"), "o_orderdate",
        ops.month_of(F.col("o_orderdate")).alias("month"))


def year_flags(spark, d):
    """Capture flags per customer over the full months of one year, in one regroup."""
    o = dated_orders(spark, d).filter((F.col("o_orderdate") >= F.lit(YEAR[0])) & (F.col("o_orderdate") < F.lit(YEAR[1])))
    full = ops.full_months(o).filter("is_full").select("month")
    pairs = o.select("company_id", "month").distinct().join(F.broadcast(full), "month", "left_semi")
    return ops.occasion_flags(pairs)


MONTHS = """
ord AS (SELECT o_orderkey, o_custkey AS c, o_orderdate, date_trunc('month', o_orderdate)::DATE AS month FROM orders),
yr AS (SELECT * FROM ord WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'),
per AS (SELECT month, count(*) AS n FROM {src} GROUP BY 1),
med AS (SELECT list_sort(list(n))[len(list(n)) // 2 + 1] / 2.0::DOUBLE AS threshold FROM per),
fullm AS (SELECT month FROM per, med WHERE n >= threshold)"""
FLAGS = MONTHS.format(src="yr") + """,
idx AS (SELECT month, row_number() OVER (ORDER BY month) - 1 AS i, count(*) OVER () AS nm FROM fullm),
pm AS (SELECT DISTINCT c, month FROM yr WHERE month IN (SELECT month FROM fullm)),
fl AS (SELECT c, count(*) AS occ, max((i < nm // 2)::INT) AS a0, max((i >= nm // 2)::INT) AS b0,
   max((i % 2 = 0)::INT) AS a1, max((i % 2 <> 0)::INT) AS b1, max(((i // 3) % 2 = 0)::INT) AS a2, max(((i // 3) % 2 <> 0)::INT) AS b2
   FROM pm JOIN idx USING (month) GROUP BY c)"""
SPLITS = FLAGS + """,
sp AS (SELECT 'Halbjahre' AS split, CAST(sum(a0) AS BIGINT) AS n1, CAST(sum(b0) AS BIGINT) AS n2, CAST(sum(a0*b0) AS BIGINT) AS m, count(*) AS s FROM fl
 UNION ALL SELECT 'Monate abwechselnd', CAST(sum(a1) AS BIGINT), CAST(sum(b1) AS BIGINT), CAST(sum(a1*b1) AS BIGINT), count(*) FROM fl
 UNION ALL SELECT 'Quartale abwechselnd', CAST(sum(a2) AS BIGINT), CAST(sum(b2) AS BIGINT), CAST(sum(a2*b2) AS BIGINT), count(*) FROM fl),
est AS (SELECT *, (n1 + 1)::DOUBLE * (n2 + 1) / (m + 1) - 1 AS n,
   sqrt((n1 + 1)::DOUBLE * (n2 + 1) * (n1 - m) * (n2 - m) / ((m + 1)::DOUBLE * (m + 1) * (m + 2))) AS se FROM sp)"""


@query("full_months", f"""
WITH {MONTHS.format(src='ord')} SELECT month, n, threshold, n >= threshold AS is_full FROM per, med""")
def full_months(spark, d):
    return ops.full_months(dated_orders(spark, d))


@query("chapman_splits", f"""
WITH {SPLITS} SELECT split, n1, n2, m AS both, round_even(n, 4) AS n, round_even(n - 1.96::DOUBLE * se, 4) AS lo,
  round_even(n + 1.96::DOUBLE * se, 4) AS hi, s AS observed, round_even(s / n, 4) AS coverage FROM est""")
def chapman_splits(spark, d):
    e = ops.chapman_splits(year_flags(spark, d))
    return e.select("split", "n1", "n2", "both", *[F.bround(c, 4).alias(c) for c in ("n", "lo", "hi")],
                    "observed", F.bround("coverage", 4).alias("coverage"))


@query("chao1", f"""
WITH {FLAGS}, t AS (SELECT count(*) AS s, count(*) FILTER (WHERE occ = 1) AS f1, count(*) FILTER (WHERE occ = 2) AS f2 FROM fl),
e AS (SELECT *, s + f1 * (f1 - 1)::DOUBLE / (2 * (f2 + 1)) AS n FROM t),
v AS (SELECT *, n - s AS f0, f1::DOUBLE / (2 * (f2 + 1)) AS q, f1::DOUBLE / (f2 + 1) AS r FROM e)
SELECT s AS observed, f1, f2, round_even(n, 4) AS n, round_even(n - 1.96::DOUBLE * sqrt(f0 * q * q + f0 * r * r / 2 + f0 * f0 / (f2 + 1) / 4), 4) AS lo,
  round_even(s / n, 4) AS coverage FROM v""")
def chao1(spark, d):
    return ops.chao1(year_flags(spark, d)).select(
        "observed", "f1", "f2", *[F.bround(c, 4).alias(c) for c in ("n", "lo", "coverage")])


@query("occasion_histogram", f"""
WITH {FLAGS} SELECT occ AS occasions, count(*) AS companies FROM fl GROUP BY 1""")
def occasion_histogram(spark, d):
    return ops.occasion_histogram(year_flags(spark, d))


@query("split_spread", f"""
WITH {SPLITS}, r AS (SELECT min(round_even(n, 0)) AS lowest, max(round_even(n, 0)) AS highest FROM est)
SELECT lowest, highest, round_even((highest - lowest) / lowest, 6) AS spread, (highest - lowest) / lowest > 0.35 AS too_far_apart FROM r""")
def split_spread(spark, d):
    return ops.split_spread(ops.chapman_splits(year_flags(spark, d))).withColumn("spread", F.bround("spread", 6))


@query("seen_in_both", """
SELECT o_custkey AS company_id FROM orders WHERE o_orderdate < TIMESTAMP '1998-05-01'
INTERSECT SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-05-01'""")
def seen_in_both(spark, d):
    o, cut = dated_orders(spark, d), F.lit(dt.datetime(1998, 5, 1))
    return ops.seen_in_both(o.filter(F.col("o_orderdate") < cut), o.filter(F.col("o_orderdate") >= cut))


@query("missing_months", """
WITH e AS (SELECT unnest(generate_series(DATE '1994-12-01', DATE '2001-09-01', INTERVAL 1 MONTH))::DATE AS month)
SELECT month FROM e WHERE month NOT IN (SELECT date_trunc('month', o_orderdate)::DATE FROM orders)""")
def missing_months(spark, d):
    return quality.missing_months(dated_orders(spark, d), dt.date(1994, 12, 1), dt.date(2001, 9, 1))


@query("reconcile_counts", """
WITH e AS (SELECT date_trunc('month', o_orderdate)::DATE AS month, count(*) AS expected FROM orders GROUP BY 1),
l AS (SELECT date_trunc('month', o_orderdate)::DATE AS month, count(*) AS loaded FROM orders
      WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1)
SELECT month, expected, coalesce(loaded, 0) AS loaded, expected - coalesce(loaded, 0) AS missing,
  expected - coalesce(loaded, 0) <= 0 AS complete FROM e LEFT JOIN l USING (month)""")
def reconcile_counts(spark, d):
    """Announced notices per month against those that arrived with lines."""
    o = dated_orders(spark, d)
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("notice_id")).distinct()
    expected = o.groupBy("month").agg(F.count(F.lit(1)).alias("expected"))
    return quality.reconcile_counts(expected, o.join(lines, "notice_id", "left_semi"), "month")
