"""How much of the market is still unseen: capture-recapture over one pass of distinct
(company, month) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotwise import rules

SPLITS = ["Halbjahre", "Monate abwechselnd", "Quartale abwechselnd"]


def month_of(day: Column) -> Column:
    return F.date_trunc("month", day).cast("date")


def full_months(dated: DataFrame) -> DataFrame:
    """Months with at least half of the (upper) median month's rows.

    ``dated`` has one row per notice with a column ``month``; everything after the first
    aggregate works on the handful of months.
    """
    per_month = dated.filter("month IS NOT NULL").groupBy("month").agg(F.count(F.lit(1)).alias("n"))
    sizes = F.sort_array(F.collect_list("n"))
    median = per_month.agg(F.element_at(sizes, F.floor(F.size(sizes) / 2).cast("int") + 1).alias("m"))
    return per_month.withColumn("threshold", median.scalar() / 2).withColumn(
        "is_full", F.col("n") >= F.col("threshold"))


def month_index(months: DataFrame) -> DataFrame:
    """Position of each month in calendar order, from a sorted array of the few months."""
    ordered = months.agg(F.sort_array(F.collect_set("month")).alias("all"))
    return (ordered.select(F.posexplode("all").alias("i", "month"), F.size("all").alias("n_months")))


def occasion_flags(company_months: DataFrame) -> DataFrame:
    """Per company: seen in either half of each two-way split, and in how many months.

    ``company_months``: distinct (company_id, month) of full months.  Three splits and
    the monthly occasions come out of the same single regroup.
    """
    idx = month_index(company_months.select("month").distinct())
    i, n = F.col("i"), F.col("n_months")
    first = {
        SPLITS[0]: i < F.floor(n / 2),
        SPLITS[1]: i % 2 == 0,
        SPLITS[2]: F.floor(i / 3) % 2 == 0,
    }
    flags = []
    for k, (_, cond) in enumerate(first.items()):
        flags += [F.max(cond.cast("int")).alias(f"a{k}"), F.max((~cond).cast("int")).alias(f"b{k}")]
    return (company_months.join(F.broadcast(idx), "month")
            .groupBy("company_id").agg(F.count(F.lit(1)).alias("occasions"), *flags))


def chapman(n1: Column, n2: Column, m: Column) -> Column:
    """struct(n, lo, hi): Chapman estimate with its 95 % interval; null without overlap."""
    n = (n1 + 1.0) * (n2 + 1) / (m + 1) - 1
    var = (n1 + 1.0) * (n2 + 1) * (n1 - m) * (n2 - m) / ((m + 1.0) * (m + 1) * (m + 2))
    se = F.sqrt(F.greatest(var, F.lit(0.0)))
    return F.when(m > 0, F.struct(n.alias("n"), (n - 1.96 * se).alias("lo"), (n + 1.96 * se).alias("hi")))


def chapman_splits(flags: DataFrame) -> DataFrame:
    """n1, n2, both and the estimate for the three two-way splits."""
    sums = [F.count(F.lit(1)).alias("observed")]
    for k in range(len(SPLITS)):
        a, b = F.col(f"a{k}"), F.col(f"b{k}")
        sums += [F.sum(a).alias(f"n1_{k}"), F.sum(b).alias(f"n2_{k}"), F.sum(a * b).alias(f"m_{k}")]
    totals = flags.agg(*sums)
    rows = F.explode(F.array(*[F.struct(
        F.lit(s).alias("split"), F.col(f"n1_{k}").alias("n1"), F.col(f"n2_{k}").alias("n2"),
        F.col(f"m_{k}").alias("both")) for k, s in enumerate(SPLITS)]))
    est = totals.select("observed", rows.alias("r")).select("observed", "r.*").withColumn(
        "e", chapman(F.col("n1"), F.col("n2"), F.col("both")))
    return est.select("split", "n1", "n2", "both", "e.n", "e.lo", "e.hi", "observed",
                      (F.col("observed") / F.col("e.n")).alias("coverage"))


def chao1(flags: DataFrame) -> DataFrame:
    """Bias-corrected Chao1 lower bound from the number of months each company was seen."""
    t = flags.agg(F.count(F.lit(1)).alias("observed"), F.count_if(F.col("occasions") == 1).alias("f1"),
                  F.count_if(F.col("occasions") == 2).alias("f2"))
    f1, f2 = F.col("f1"), F.col("f2")
    n = F.col("observed") + f1 * (f1 - 1.0) / (2.0 * (f2 + 1))
    unseen = F.col("n") - F.col("observed")
    var = (unseen * F.pow(f1 / (2.0 * (f2 + 1)), F.lit(2)) + unseen * F.pow(f1 / (f2 + 1.0), F.lit(2)) / 2
           + unseen * unseen / (f2 + 1.0) / 4)
    se = F.when(unseen > 0, F.sqrt(F.abs(var))).otherwise(F.lit(0.0))
    return t.withColumn("n", n).select("observed", "f1", "f2", "n", (F.col("n") - 1.96 * se).alias("lo"),
                                       (F.col("observed") / F.col("n")).alias("coverage"))


def occasion_histogram(flags: DataFrame) -> DataFrame:
    """Companies by the number of months they were seen in."""
    return flags.groupBy("occasions").agg(F.count(F.lit(1)).alias("companies"))


def split_spread(estimates: DataFrame) -> DataFrame:
    """Do the splits agree?  Spread of the rounded estimates and a warning flag."""
    n = F.bround("n", 0)
    return estimates.agg(F.min(n).alias("lowest"), F.max(n).alias("highest")).select(
        "lowest", "highest", ((F.col("highest") - F.col("lowest")) / F.col("lowest")).alias("spread"),
    ).withColumn("too_far_apart", F.col("spread") > rules.SPREAD_WARN)


def seen_in_both(first: DataFrame, second: DataFrame) -> DataFrame:
    """Companies seen in both periods."""
    return first.select("company_id").intersect(second.select("company_id"))
