"""Heavy keys are found and split, light ones are not."""

from pyspark.sql import functions as F

from lotwise.operators import joins


def test_only_heavy_keys_are_split(spark):
    rows = spark.range(6000).select("id", F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 10 = 1 THEN 'warm' WHEN id % 10 = 2 THEN NULL ELSE 'k' || id END").alias("key"))
    assert joins.heavy_keys(rows, "key") == ["hot", "warm"]
    assert joins.heavy_keys(rows.where("false"), "key") == []
    lookup = spark.range(6000).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("found")).unionByName(
        spark.createDataFrame([("hot", -1), ("warm", -2)], "key string, found long"))
    got = joins.salted_lookup(rows, lookup, "key", ["id"])
    want = rows.join(lookup, "key", "left")
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and got.count() == 6000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence" in plan and "hot" in plan
    copies = lookup.withColumn("s", F.when(F.col("key").isin(joins.heavy_keys(rows, "key")), joins.SALTS).otherwise(1)).agg(F.sum("s")).first()[0]
    assert copies == 6000 + 2 * joins.SALTS


def test_an_even_table_is_joined_as_it_is(spark):
    rows = spark.range(1000).withColumnRenamed("id", "key")
    got = joins.salted_lookup(rows, rows.withColumn("v", F.col("key") * 2), "key", ["key"])
    assert joins.heavy_keys(rows, "key") == [] and got.where("v = key * 2").count() == 1000
