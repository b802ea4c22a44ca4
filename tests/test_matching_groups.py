"""Pairs of names in large groups: all of them, once, and not in one task."""

import itertools

import pytest
from pyspark.sql import functions as F

from lotwise.operators import matching


def jaccard(a, b):
    a, b = set(a.split()), set(b.split())
    return len(a & b) / len(a | b)


def wanted(names, threshold, once):
    return sorted((k, a, b, round(jaccard(a, b), 6)) for (a, k), (b, j) in itertools.permutations(names, 2)
                  if k == j and jaccard(a, b) >= threshold - 1e-9 and (a < b or not once))


@pytest.mark.parametrize("threshold", [0.5, 0.6, 0.75, 1.0])
def test_split_groups_hold_every_pair_once(spark, monkeypatch, threshold):
    """Names of several sizes, repeated and reordered tokens, more shared than needed; groups split from three names on."""
    monkeypatch.setattr(matching, "LARGE", 3)
    texts = {" ".join(p) for n in (1, 2, 3, 4) for p in itertools.combinations("a b c d e".split(), n)}
    texts |= {"b a", "a b a", "c b a", "d c b a", "a a", "a b c d e f", "f e d c b a", "a b c d e f g h"}
    names = [(f"h i {t}", k) for t in sorted(texts) for k in ("x", "y") if k == "x" or len(t) < 6]
    df = spark.createDataFrame(names, "key string, block string")

    def rows(pairs):
        return sorted((r.block, r.key_a, r.key_b, r.score) for r in pairs.withColumn("score", F.round("score", 6)).collect())
    assert rows(matching.similar_names(df, df, threshold)) == wanted(names, threshold, False)
    assert rows(matching.pairs_once(df, threshold, digits=6)) == wanted(names, threshold, True)


def test_a_large_group_is_not_paired_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(matching, "LARGE", 8)
    df = spark.createDataFrame([(f"sun nation word area x{i}", "x") for i in range(80)], "key string, block string")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        made = [r["count"] for r in matching.pairs_once(df, 0.6).groupBy(F.spark_partition_id().alias("task")).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(made) == 80 * 79 // 2 and len(made) > 2 and max(made) < sum(made) * 2 / 3, made
