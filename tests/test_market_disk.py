"""What the market list leaves on disk on its way."""

import datetime as dt
import time
from pathlib import Path

from pyspark.sql import functions as F

from lotwise.operators import company
from lotwise.session import landed

DAY = dt.date(2026, 1, 1)
PARTS = ("company_id string, ocid string, notice_id string, pos int, d date, role string, outcome string, legal_name string, city string, "
         "postal_code string, main_cpv string, mixed_lot boolean, consortium boolean, url string, buyer string, cpv array<string>, supplier_id string, source string")


def part(c, ocid, notice, role="award", outcome=None, d=DAY, buyer="b", cpv=("72000000",), pos=0):
    return (c, ocid, notice, pos, d, role, outcome, c.upper(), "X", None, cpv[0] if cpv else None, False, False, f"u/{notice}", buyer, list(cpv), "i" + c, "dovs")


def shuffle_files(spark) -> int:
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return sum(1 for d in dirs for _ in Path(d.getPath()).rglob("shuffle_*.data"))


def test_landing_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = landed(spark.range(1000).repartition(7, "id").groupBy((F.col("id") % 10).alias("k")).count(), "rows")
    for _ in range(50):  # files go in the background
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before and rows.count() == 10
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") in ("false", "true")


def test_facts_are_shuffled_once(spark, tmp_path):
    spark.createDataFrame([part("a", "o", "n")], PARTS).write.parquet(f"{tmp_path}/parts")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        profile = company.fact_profile(company.distinct_facts(spark.read.parquet(f"{tmp_path}/parts")))
        p = profile._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert p.count("Generate explode") == 1 and p.count("ReusedExchange") >= 2, p


def test_some_facts_are_the_facts_of_some(spark):
    rows = spark.createDataFrame([part("a", "o", "n", cpv=("1", "2")), part("a", "p", "m", buyer="", cpv=()), part("b", "o", "n", buyer=None)], PARTS)
    every = {tuple(r) for r in company.distinct_facts(rows).collect()}
    assert every == {("a", "buyer", "b"), ("a", "code", "1"), ("a", "code", "2"), ("a", "supplier_id", "ia"), ("a", "source", "dovs"),
                     ("b", "code", "72000000"), ("b", "supplier_id", "ib"), ("b", "source", "dovs")}
    assert {tuple(r) for r in company.distinct_facts(rows, ["supplier_id"]).collect()} == {r for r in every if r[1] == "supplier_id"}


def test_rows_without_a_procedure_are_evidence_only(spark):
    """Not counted, and spread over their notices; the newest of them may still be the proof."""
    late = DAY + dt.timedelta(days=9)
    rows = [part("a", o, f"n{i}", d=late if i == 7 else DAY) for o in (None, "") for i in range(20)]
    rows += [part("a", "o1", "z"), part("a", "o1", "z", pos=1), part("a", "o2", "y", "bid", "unterlegen")]
    df = spark.createDataFrame(rows, PARTS)
    got = company.market_list(df, late).first()
    assert (got.awards_total, got.award_rows, got.participations_total, got.bids_lost) == (1, 42, 2, 1)
    assert (got.last_award_date, got.proof_date, got.proof_url, got.legal_name) == (late, late, "u/n7", "A")
    assert company.per_procedure(df).count() == 42
