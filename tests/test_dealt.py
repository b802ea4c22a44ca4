"""Costly work per name is spread over all tasks, and plain texts take none of the folding passes."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lotwise.functions import text as tx

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["consortium_members", "headcount_scope", "verify_candidate"])
def test_names_are_dealt_over_tasks(spark, name):
    df = entry.queries()[name](spark, SF)
    assert "REPARTITION_BY_NUM" in df._jdf.queryExecution().executedPlan().toString()
    sizes = df.groupBy(F.spark_partition_id()).count().count()
    assert sizes == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_folding_asks_for_plain_text_first(spark, one):
    plan = spark.range(1).select(tx.fold(F.col("id").cast("string")))._jdf.queryExecution().analyzed().toString()
    assert "octet_length" in plan
    for text, folded in (("  Plain GMBH ", "plain gmbh"), ("Größe Ä", "groesse ae"), ("Wést ﬁ Süd", "west fi sued"), (" é", "e"), ("", "")):
        assert one(tx.fold, text) == folded
    assert one(lambda c: tx.fold(F.nullif(c, F.lit("x"))), "x") is None


def test_signal_contacts_lists_every_account(spark):
    got = entry.queries()["signal_contacts"](spark, SF)
    accounts = spark.read.parquet(f"{SF}/orders.parquet").select("o_custkey").distinct().count()
    ranks = sorted(r.account_rank for r in got.filter("round = 1").collect())
    assert ranks == list(range(1, accounts + 1))
    assert got.count() > 20


def test_numbered_is_gapless_in_order(spark):
    from lotwise.session import numbered
    got = numbered(spark.range(1000).selectExpr("(id * 37) % 1000 AS v"), [F.desc("v")], "n").collect()
    assert sorted((r.n, r.v) for r in got) == [(i + 1, 999 - i) for i in range(1000)]


def shares(df):
    """Rows per task, largest first."""
    return sorted((r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()), reverse=True)


def test_records_without_id_do_not_meet_in_one_task(spark):
    from lotwise.plans import domains
    plain = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in plain}
    try:
        for k, v in plain.items():
            spark.conf.set(k, v)
        got = shares(domains.keyed_records(spark, SF).select("row_no"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got[0] < 0.4 * sum(got)
