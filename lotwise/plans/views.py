"""The procurement concepts projected onto the driver's tables.

notice = order, bidder = supplier of a line, named winner = line with return flag A and
status F, classification code = brand of the line's part (main code = line 1), buyer =
customer, contract end = ship date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lotwise.functions.codes import verdict
from lotwise.operators.parties import bidder_outcomes, notice_url

AS_OF = dt.date(2000, 1, 1)
IN_SCOPE = ["Brand#1"]


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is inferred once per path."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def won_line() -> Column:
    return (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F")


def line_codes(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").select("p_partkey", "p_brand")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").join(
        part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "p_brand")


def notice_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Scope verdict per order.  A notice's code set is bounded by the code vocabulary."""
    per_notice = line_codes(spark, d).groupBy(F.col("l_orderkey").alias("notice_id")).agg(
        F.min(F.when(F.col("l_linenumber") == 1, F.col("p_brand"))).alias("main"),
        F.collect_set("p_brand").alias("codes"))
    return per_notice.withColumn("v", verdict(F.col("main"), F.col("codes"), IN_SCOPE)).select("notice_id", "v.*")


def orders_as_notices(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("notice_id"), F.to_date("o_orderdate").alias("d"),
        (F.col("o_orderstatus") == "F").alias("award_notice"), F.lit(None).cast("int").alias("announced"),
        F.col("o_custkey").cast("string").alias("buyer"), (F.col("o_orderpriority") == "5-LOW").alias("consortium"))


def parties(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("notice_id"), F.col("l_suppkey").alias("company_id"),
        won_line().alias("is_winner"))


def outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Outcome per (order in scope, supplier)."""
    scope = notice_verdicts(spark, d).filter("is_it").select(
        "notice_id", "main_cpv", "mixed_lot", "all_codes", "it_share")
    notices = orders_as_notices(spark, d).join(scope, "notice_id")
    return bidder_outcomes(parties(spark, d), notices)


def participations(spark: SparkSession, d: str) -> DataFrame:
    supplier = table(spark, d, "supplier").join(
        F.broadcast(table(spark, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("s_suppkey").alias("company_id"), F.col("s_name").alias("legal_name"), F.col("n_name").alias("city"))
    rows = outcomes(spark, d).join(supplier, "company_id", "left")
    won = F.col("is_winner")
    return rows.select(
        F.col("company_id").cast("string").alias("company_id"),
        F.col("notice_id").cast("string").alias("notice_id"), F.col("notice_id").cast("string").alias("ocid"),
        "d", F.when(won, F.lit("award")).otherwise(F.lit("bid")).alias("role"),
        F.when(~won, F.col("outcome")).alias("outcome"), "legal_name", "buyer", "consortium", "mixed_lot",
        "main_cpv", F.col("all_codes").alias("cpv"), "it_share", "city",
        F.lit(None).cast("string").alias("postal_code"),
        F.concat(F.lit("ORG-"), F.col("bidders").cast("string")).alias("supplier_id"),
        F.lit(0).alias("pos"), F.lit("dovs").alias("source"),
        F.when(won, F.col("award_rows")).otherwise(F.lit(0)).alias("n_rows"),
        notice_url(F.col("notice_id").cast("string")).alias("url"))
