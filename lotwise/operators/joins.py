"""Lookups that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SALTS = 16
HEAVY = 64  # a key with more than one row in so many is heavy, so there are fewer heavy keys than that
TRACKED = 4096  # keys the sketch tracks at a time; it misses none of the heavy ones


def heavy_keys(rows: DataFrame, key: str) -> list:
    """Keys that hold more than one in ``HEAVY`` of the rows, found by a sketch in one pass over the key."""
    found = rows.agg(F.expr(f"approx_top_k(`{key}`, {HEAVY}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return sorted(t["item"] for t in found["top"] or [] if t["item"] is not None and t["count"] * HEAVY > found["n"])


def salted_lookup(left: DataFrame, right: DataFrame, key: str, spread_by: list[str],
                  salts: int = SALTS) -> DataFrame:
    """Left join to a lookup with one row per key, with every heavy key spread over ``salts`` tasks.

    The salt is a hash of ``spread_by`` (columns telling the rows of one key apart), so a
    re-run task puts every row where it was before.  Only the heavy keys' lookup rows are
    repeated; rows without a key find nothing and are spread as well.
    """
    heavy = heavy_keys(left, key)
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    split = F.col(f"`{key}`").isin(heavy) if heavy else F.lit(False)
    salted = left.withColumn("_salt", F.when(split | F.col(f"`{key}`").isNull(), salt).otherwise(0))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.when(split, salts - 1).otherwise(0))))
    return salted.join(copies, [key, "_salt"], "left").drop("_salt")
