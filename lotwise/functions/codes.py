"""Classification codes: is a notice dominated by the wanted codes?"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from lotwise import rules
from lotwise.functions.text import let


def has_prefix(code: Column, prefixes: list[str]) -> Column:
    """Membership by code prefix; an OR of ``startswith`` so that a scan can push it down."""
    return F.coalesce(reduce(lambda a, b: a | b, [code.startswith(p) for p in prefixes]), F.lit(False))


def tender_codes(tender: Column) -> tuple[Column, Column]:
    """(main code, all codes) of a nested tender, both as text."""
    main = F.nullif(tender["classification"]["id"], F.lit(""))
    items = F.coalesce(tender["items"], F.array())
    of_items = F.flatten(F.transform(items, lambda i: F.concat(
        F.array(i["classification"]["id"]),
        F.transform(F.coalesce(i["additionalClassifications"], F.array()), lambda a: a["id"]))))
    extra = F.transform(F.coalesce(tender["additionalClassifications"], F.array()), lambda a: a["id"])
    codes = F.filter(F.concat(F.array(main), of_items, extra), lambda c: c.isNotNull() & (c != ""))
    return main, codes


def percent(share: Column) -> Column:
    return F.concat(F.bround(share * 100, 0).cast("int").cast("string"), F.lit("%"))


def verdict(main: Column, codes: Column, prefixes: list[str] = rules.IT_CODE_PREFIXES) -> Column:
    """Scope verdict of a notice from its main code and all its codes.

    The main code decides where there is one; otherwise at least half of the distinct
    codes must be in scope.
    """
    unique = let(F.array_sort(F.array_distinct(codes)), lambda u: F.struct(
        F.size(u).alias("n"), F.size(F.filter(u, lambda c: has_prefix(c, prefixes))).alias("n_it"),
        u.alias("codes")))
    return let(F.struct(main.alias("main"), unique.alias("u")), lambda x: verdict_from_counts(
        x["main"], x["u"]["n"], x["u"]["n_it"], x["u"]["codes"], prefixes))


def verdict_from_counts(main: Column, n: Column, n_it: Column, codes: Column,
                        prefixes: list[str] = rules.IT_CODE_PREFIXES) -> Column:
    """The same verdict when the distinct codes have already been counted.

    ``cpv_codes`` is for display, ``all_codes`` for whatever is counted or joined later.
    """
    share = F.when(n > 0, n_it / n).otherwise(F.lit(0.0))
    main_ok = has_prefix(main, prefixes)
    share_ok = (n > 0) & (share >= rules.MIN_IT_SHARE)
    reason = (
        F.when(main.isNotNull(), F.concat(
            F.lit("Hauptklassifikation "), main,
            F.when(main_ok, F.lit(" ist IT")).otherwise(F.lit(" ist nicht IT"))))
        .when(n == 0, F.lit("keine CPV-Codes im Datensatz"))
        .otherwise(F.concat(
            F.lit("keine Hauptklassifikation; IT-Anteil "), n_it.cast("string"), F.lit("/"),
            n.cast("string"), F.lit(" = "), percent(share),
            F.when(share_ok, F.lit(" >= ")).otherwise(F.lit(" < ")),
            F.lit(f"{rules.MIN_IT_SHARE:.0%}")))
    )
    return F.struct(
        F.when(main.isNotNull(), main_ok).otherwise(share_ok).alias("is_it"),
        reason.alias("reason"),
        main.alias("main_cpv"),
        F.bround(share, 3).alias("it_share"),
        n.alias("cpv_count"),
        F.slice(codes, 1, rules.CODES_KEPT).alias("cpv_codes"),
        codes.alias("all_codes"),
        ((n >= rules.MIXED_LOT_MIN_CODES) & (share < 0.5)).alias("mixed_lot"),
    )
