"""EU notices whose fields may be text, a list or a map by language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lotwise import rules
from lotwise.functions.dates import iso_date
from lotwise.functions.text import blank_to_null
from lotwise.schemas import SIGNAL_COLUMNS, TED_FIELDS

LANGUAGE_KEYS = ("deu", "eng", "value", "text")
ORDERED_LEVELS = 3  # levels ``all_strings`` reads by language preference; deeper ones in stored order
LEAF = r'("(?:[^"\\]|\\.)*"|-?[0-9][0-9.eE+-]*|true|false)(?=[,}\]])'


def _get(v: Column, path: str, to: str) -> Column:
    return F.try_variant_get(v, path, to)


def _children(v: Column) -> Column:
    """What a list or a map holds; map entries by language preference, then by key."""
    entries = F.transform(F.map_entries(_get(v, "$", "map<string,variant>")), lambda e: F.struct(
        F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, LANGUAGE_KEYS)), e["key"]), F.lit(0).cast("long")),
                   F.lit(len(LANGUAGE_KEYS) + 1).cast("long")).alias("rank"), e["key"].alias("key"), e["value"].alias("value")))
    by_preference = F.array_sort(entries, lambda a, b: F.when(
        (a["rank"] < b["rank"]) | ((a["rank"] == b["rank"]) & (a["key"] < b["key"])), -1).otherwise(1))
    return (F.when(F.schema_of_variant(v).startswith("OBJECT"), F.transform(by_preference, lambda e: e["value"]))
            .otherwise(_get(v, "$", "array<variant>")))


def _leaves(v: Column) -> Column:
    """Every non-blank text of a container of any depth, in stored order: the values of its JSON form."""
    values = F.regexp_extract_all(F.to_json(v), F.lit(LEAF), F.lit(1))
    texts = F.transform(values, lambda x: blank_to_null(F.get(F.from_json(F.concat(F.lit("["), x, F.lit("]")), "array<string>"), F.lit(0))))
    return F.array_compact(texts)


def all_strings(v: Column, depth: int = ORDERED_LEVELS) -> Column:
    """Every non-blank text inside a variant, depth first, preferred languages first."""
    single = F.array_compact(F.array(blank_to_null(_get(v, "$", "string"))))
    nested = F.schema_of_variant(v).rlike("^(ARRAY|OBJECT)")
    inside = F.flatten(F.transform(_children(v), lambda x: all_strings(x, depth - 1))) if depth else _leaves(v)
    return F.when(nested, inside).otherwise(single)


def first_string(v: Column) -> Column:
    """One text of a variant; German before English before anything else."""
    return F.get(all_strings(v), F.lit(0))


def _is_container(v: Column) -> Column:
    return F.schema_of_variant(v).rlike("^(ARRAY|OBJECT)")


def nesting(v: Column) -> Column:
    """How many lists and maps lie inside one another at the deepest place of a variant."""
    brackets = F.regexp_replace(F.regexp_replace(F.to_json(v), r'"(?:[^"\\]|\\.)*"', ""), r"[^\[\]{}]", "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(s: Column, c: Column) -> Column:
        now = s["now"] + F.when(c.isin("[", "{"), 1).when(c.isin("]", "}"), -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(s["most"], now).alias("most"))
    deep = F.aggregate(F.split(brackets, ""), start, step, lambda s: s["most"])
    return F.when(_is_container(v), deep).otherwise(F.lit(0))


def texts_of(notices: DataFrame) -> DataFrame:
    """Every variant column as the list of its non-blank texts, preferred languages first at any depth.

    A level of lists and maps is replaced by its ordered content in place, as often as the field's
    deepest row needs it, so the order is depth first and expressions stay small.
    """
    levels = notices.agg(*[F.max(nesting(F.col(c))).alias(c) for c in notices.columns]).first()

    def opened(items: Column) -> Column:
        return F.flatten(F.transform(items, lambda x: F.when(_is_container(x), _children(x)).otherwise(F.array(x))))

    rows = notices.select(*[F.when(F.col(c).isNull(), F.array().cast("array<variant>")).otherwise(F.array(c)).alias(c) for c in notices.columns])
    for level in range(max(n or 0 for n in levels)):
        rows = rows.select(*[opened(F.col(c)).alias(c) if level < (levels[c] or 0) else F.col(c) for c in notices.columns])
    return rows.select(*[F.array_compact(F.transform(c, lambda x: blank_to_null(_get(x, "$", "string")))).alias(c) for c in notices.columns])


def read_ted(spark: SparkSession, path: str) -> DataFrame:
    """One row per notice, one variant column per known field.

    Accepts one notice per line or pages with a ``notices`` or ``results`` list.
    """
    raw = spark.read.format("json").option("singleVariantColumn", "v").load(path)
    pages = F.coalesce(_get(F.col("v"), "$.notices", "array<variant>"),
                       _get(F.col("v"), "$.results", "array<variant>"), F.array(F.col("v")))
    notices = raw.select(F.explode(pages).alias("n"))
    return notices.select(*[_get(F.col("n"), f"$['{f}']", "variant").alias(f.replace("-", "_")) for f in TED_FIELDS])


def winners_with_postcodes(winners: Column, postcodes: Column) -> Column:
    """Distinct winners with the postcode that stands at their first position."""
    pairs = F.transform(winners, lambda w, i: F.struct(w.alias("winner"), F.get(postcodes, i).alias("postcode"),
                                                      F.array_position(winners, w).alias("first"), (i + 1).alias("at")))
    return F.filter(pairs, lambda p: p["first"] == p["at"])


def ted_signals(notices: DataFrame) -> DataFrame:
    """One award signal per notice and distinct winner; texts by language preference however deep they lie."""
    def one(name: str) -> Column:
        return F.get(name, F.lit(0))
    flat = texts_of(notices).select(
        one("publication_number").alias("pub"), iso_date(one("publication_date")).alias("d"),
        one("notice_title").alias("title"), one("buyer_name").alias("buyer"),
        F.slice("classification_cpv", 1, rules.CODES_IN_ROW).alias("cpv"),
        one("total_value").try_cast("double").alias("value"), one("notice_type").alias("notice_type"),
        one("winner_country").alias("winner_country"),
        iso_date(one("contract_duration_end_date_lot")).alias("contract_end"),
        winners_with_postcodes(F.col("winner_name"), F.col("winner_post_code")).alias("w"),
    ).filter("pub IS NOT NULL")
    rows = flat.select("*", F.posexplode("w").alias("idx", "x"))
    payload = F.to_json(F.struct(
        "buyer", "contract_end", "cpv", "notice_type", F.col("pub").alias("publication_number"),
        F.lit("EU_oberschwellig").alias("source_scope"), "value", "winner_country",
        F.col("x.postcode").alias("winner_post_code")))
    return rows.select(
        F.lit("ted").alias("source"), F.concat_ws(":", "pub", F.col("idx").cast("string")).alias("external_id"),
        F.lit("zuschlag_gewonnen").alias("signal_type"), F.col("d").alias("event_date"),
        F.col("x.winner").alias("org_name_raw"), F.lit(None).cast("string").alias("org_place"),
        F.concat(F.lit(rules.TED_URL), "pub").alias("source_url"), "title", F.col("pub").alias("notice_id"),
        "buyer", "contract_end", F.lit(None).cast("date").alias("deadline"), "value",
        F.lit(None).cast("string").alias("supplier_id"), F.lit(False).alias("is_buyer_side"), "cpv",
        payload.alias("payload")).select(*SIGNAL_COLUMNS)
