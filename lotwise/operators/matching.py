"""Exact blocked name matching without comparing every pair of a block."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from lotwise.functions.text import blocking_key, company_key, tokens

DEFAULT_THRESHOLD = 0.75
FEW = 64  # subsets of a name, per size of a partner, up to which names meet by them
LARGE = 4096  # names with one subset from which their pairs are made in several tasks


def keyed_names(names: DataFrame) -> DataFrame:
    """Distinct company keys per block; ``names``: name, postal_code."""
    key = company_key(F.col("name"))
    return (names.select(key.alias("key"), blocking_key(key, F.col("postal_code")).alias("block"))
            .filter("key <> ''").distinct())


def _sized(entries: DataFrame) -> DataFrame:
    toks = tokens(F.col("key"))
    return entries.select("key", "block", F.array_sort(toks).alias("toks"), F.size(toks).alias("n"))


def _size_pairs(left: DataFrame, right: DataFrame, threshold: float) -> tuple[list, list]:
    """(n, m, need) for the sizes that occur and may be similar: those with few subsets, and the rest.

    Sets of sizes n and m need an overlap of t / (1 + t) * (n + m).  There are no more sizes
    than words in the longest name.
    """
    ns, ms = (sorted(r["n"] for r in side.select("n").distinct().collect()) for side in (left, right))
    few, rest = [], []
    for n in ns:
        for m in ms:
            need = math.ceil((n + m) * threshold / (1 + threshold) - 1e-9)
            if need <= min(n, m):
                subsets = sum(math.comb(max(n, m), o) for o in range(need, min(n, m) + 1))
                (few if subsets <= FEW else rest).append((n, m, need))
    return few, rest


def _subsets(sized: DataFrame, plan: list[tuple[int, int, int]], own: str, other: str) -> DataFrame:
    """Each name once per size a partner may have and per subset of ``plan``'s (n, m, o) size o, as one text, with the tokens left out."""
    rows = [(n, m, o, list(at), [i for i in range(n) if i not in at]) for n, m, o in plan for at in itertools.combinations(range(n), o)]
    at = sized.sparkSession.createDataFrame(rows, f"n int, n_{other} int, shared int, at array<int>, out array<int>")

    def chosen(which: str):
        return F.transform(which, lambda i: F.get("toks", i))
    return sized.join(F.broadcast(at), "n").select(
        "block", F.col("n").alias(f"n_{own}"), f"n_{other}", F.col("key").alias(f"key_{own}"),
        "shared", F.array_join(chosen("at"), " ").alias("subset"), chosen("out").alias(f"rest_{own}"))


def _split(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """The join of both on ``on``; the left rows of a large group are dealt out, each share with all of the right ones.

    A group makes as many pairs as the product of its sides, which one task would have to make
    alone.  There is at most one large group for every ``LARGE`` right rows.
    """
    large = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > LARGE).select(
        *on, F.ceil(F.col("_n") / LARGE).cast("int").alias("_shares"))
    shares = F.coalesce("_shares", F.lit(1))
    dealt = left.join(F.broadcast(large), on, "left").withColumn("_share", F.pmod(F.xxhash64("key_a"), shares).cast("int")).drop("_shares")
    whole = right.join(F.broadcast(large), on, "left").withColumn("_share", F.explode(F.sequence(F.lit(0), shares - 1))).drop("_shares")
    return dealt.join(whole, [*on, "_share"]).drop("_share")


def _pairs_by_subset(a: DataFrame, b: DataFrame, plan: list[tuple[int, int, int]], told: Callable[[Column], Column], once: bool) -> DataFrame:
    """Pairs that share the tokens they need, scored.

    Where nothing that was left out is the same, the subset is all they share: they meet nowhere
    else, and the score is known before they meet.  Those sharing more meet often, and count at
    their first subset.
    """
    left = _subsets(a, plan, "a", "b").withColumn("least", told(F.col("shared")))
    right = _subsets(b, [(m, n, o) for n, m, o in plan], "b", "a").drop("shared")
    one = (F.size("rest_a") == 1) & (F.size("rest_b") == 1)
    more = F.when(one, F.get("rest_a", F.lit(0)) == F.get("rest_b", F.lit(0))).otherwise(F.arrays_overlap("rest_a", "rest_b"))
    both = F.array_intersect(F.array_sort(tokens(F.col("key_a"))), F.array_sort(tokens(F.col("key_b"))))
    first = F.col("subset") == F.array_join(F.slice(both, F.lit(1), F.col("shared")), " ")
    other = F.col("key_a") < F.col("key_b") if once else F.col("key_a") != F.col("key_b")
    return (_split(left, right, ["block", "n_a", "n_b", "subset"]).filter(other & (~more | first))
            .select("block", "key_a", "key_b", F.when(more, told(F.size(both))).otherwise(F.col("least")).alias("score")))


def _jaccard(shared: Column) -> Column:
    return shared / (F.col("n_a") + F.col("n_b") - shared)


def _ranked_tokens(entries: DataFrame, order: DataFrame) -> DataFrame:
    """Each name with its tokens, rarest first, in one common order.

    The two leading tokens are the same all over a block and tell nothing apart, so they
    come last.
    """
    toks = entries.select("key", "block", F.slice(F.split("key", " "), 1, 2).alias("head"),
                          F.explode(tokens(F.col("key"))).alias("token"))
    ranked = toks.join(order, "token").groupBy("key", "block").agg(F.sort_array(F.collect_list(F.struct(
        F.array_contains("head", F.col("token")).alias("in_head"), "freq", "token"))).alias("ts"))
    return ranked.select("key", "block", F.transform("ts", lambda t: t["token"]).alias("toks"), F.size("ts").alias("n"))


def _probes(ranked: DataFrame, plan: list[tuple[int, int, int]], own: str, other: str) -> DataFrame:
    """Each name once per size a partner may have and per token it must then be met by.

    Leaving out as many as needed less one of the most frequent tokens, the two must still
    share one of the rest.
    """
    sizes = ranked.sparkSession.createDataFrame(plan, f"n int, n_{other} int, need int")
    return (ranked.join(F.broadcast(sizes), "n")
            .select("block", F.col("n").alias(f"n_{own}"), f"n_{other}", F.col("key").alias(f"key_{own}"),
                    F.col("toks").alias(f"toks_{own}"), F.explode(F.slice("toks", F.lit(1), F.col("n") - F.col("need") + 1)).alias("probe")))


def _pairs_by_rare_token(a: DataFrame, b: DataFrame, plan: list[tuple[int, int, int]]) -> DataFrame:
    """Pairs of long names meet on block, both sizes and one rare token, which every true pair shares."""
    turned = [(m, n, need) for n, m, need in plan]
    a = a.filter(F.col("n").isin(sorted({n for n, _, _ in plan})))
    b = b.filter(F.col("n").isin(sorted({n for n, _, _ in turned})))
    freq = (a.select("key").unionByName(b.select("key")).distinct()
            .select(F.explode(tokens(F.col("key"))).alias("token"))
            .groupBy("token").agg(F.count(F.lit(1)).alias("freq")))
    met = _probes(_ranked_tokens(a, freq), plan, "a", "b").join(_probes(_ranked_tokens(b, freq), turned, "b", "a"), ["block", "n_a", "n_b", "probe"])
    return (met.filter(F.col("key_a") != F.col("key_b")).withColumn("both", F.array_intersect("toks_a", "toks_b"))
            .filter(F.col("probe") == F.get("both", F.lit(0))))


def _jaccard(shared: Column) -> Column:
    return shared / (F.col("n_a") + F.col("n_b") - shared)


def _checked(threshold: float) -> float:
    if not 0 < threshold <= 1 or math.isnan(threshold):
        raise ValueError("threshold must be in (0, 1]")
    return threshold


def similar_names(left: DataFrame, right: DataFrame, threshold: float = DEFAULT_THRESHOLD, once: bool = False,
                  digits: int | None = None) -> DataFrame:
    """Pairs of different keys in one block with token Jaccard >= ``threshold``.

    ``left``, ``right``: key, block (see ``keyed_names``).  Pairs meet on block, both sizes
    and as many tokens as they must share, so that no pair meets in vain; where a name has
    too many such subsets, on one rare token.  The sizes of names are looked up at once.
    ``once`` is for a list against itself; scores are rounded to ``digits``, which costs more than
    a pair and is done once for all that share as little as they may.
    """
    a, b = _sized(left), _sized(right)
    few, rest = _size_pairs(a, b, _checked(threshold))

    def told(shared: Column) -> Column:
        return _jaccard(shared) if digits is None else F.bround(_jaccard(shared), digits)
    pairs = _pairs_by_subset(a, b, few, told, once)
    if rest:
        rare = _pairs_by_rare_token(a, b, rest).filter(_jaccard(F.size("both")) >= F.lit(threshold) - F.lit(1e-9))
        rare = rare.select("block", "key_a", "key_b", told(F.size("both")).alias("score"))
        pairs = pairs.unionByName(rare.filter("key_a < key_b") if once else rare)
    return pairs


def pairs_once(names: DataFrame, threshold: float = DEFAULT_THRESHOLD, digits: int | None = None) -> DataFrame:
    """Similar keys of one list, each pair once, the smaller key first."""
    return similar_names(names, names, threshold, once=True, digits=digits)


def best_match(left: DataFrame, right: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """The most similar registered key per unknown key; ties go to the smaller key.

    Of the registered names of one size that hold the same tokens only the two smallest keys
    can be an answer, so the work grows with the names, not with the pairs.  Only pairs of
    names with too many subsets are made one by one.
    """
    a, b = _sized(left), _sized(right)
    few, rest = _size_pairs(a, b, _checked(threshold))
    levels = [(n, m, o) for n, m, need in few for o in range(need, min(n, m) + 1)]
    group = ["block", "n_b", "subset"]
    # A registered name has its subsets once for all sizes of the unknown ones.
    held = _subsets(b, sorted({(m, 0, o) for _, m, o in levels}), "b", "a").select(*group, "key_b")
    smallest = held.withColumn("nth", F.row_number().over(Window.partitionBy(*group).orderBy("key_b"))).filter("nth <= 2").drop("nth")
    found = _subsets(a, levels, "a", "b").join(smallest, group).filter("key_a <> key_b").select(
        "block", "key_a", "key_b", (F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared"))).alias("score")).filter(
        F.col("score") >= F.lit(threshold) - F.lit(1e-9))
    if rest:
        rare = _pairs_by_rare_token(a, b, rest).withColumn("score", _jaccard(F.size("both"))).filter(F.col("score") >= F.lit(threshold) - F.lit(1e-9))
        found = found.unionByName(rare.select("block", "key_a", "key_b", "score"))
    return found.groupBy("block", "key_a").agg(
        F.min(F.struct((-F.col("score")).alias("neg"), "key_b")).alias("m")).select(
        "block", "key_a", F.col("m.key_b").alias("key_b"), (-F.col("m.neg")).alias("score"))
