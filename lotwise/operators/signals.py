"""Dated signals out of notices, entity resolution and identity hashes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from lotwise import rules
from lotwise.functions.dates import age_days, as_of_lit, iso_date
from lotwise.functions.scoring import resolution_confidence
from lotwise.functions.text import (
    clean_name, company_key, consortium_members, exclusion_reason, is_consortium, let, strip,
)
from lotwise.operators.parties import LOST, WON_ALONE, notice_url, outcome_of, winner_keys
from lotwise.schemas import SIGNAL_COLUMNS

DOVS = "vergabe_dovs"
WON, EXPIRING = "zuschlag_gewonnen", "rahmenvertrag_laeuft_aus"
NOT_AWARDED, TOOK_PART = "angebot_ohne_zuschlag", "teilnahme_belegt"
OPEN_TENDER = "offene_ausschreibung_im_profil"


def newest_first() -> list[Column]:
    """Order of the rows of one external id; the first one counts."""
    return [F.desc_nulls_last("event_date"), F.desc_nulls_last("notice_id"), F.desc("payload"), F.asc("org_name_raw")]


def _or_empty(c: Column) -> Column:
    return F.coalesce(c, F.array())


def within(day: Column, as_of: Column, window: tuple[int, int]) -> Column:
    return F.coalesce(F.datediff(day, as_of).between(*window), F.lit(False))


def lot_contract_end(award: Column, lots: Column) -> Column:
    """Contract end of an award: its own period, else that of the first related lot having one."""
    def end_of(lot_id: Column) -> Column:
        hits = F.filter(_or_empty(lots), lambda lot: lot["id"] == lot_id)
        return iso_date(F.element_at(hits, -1)["contractPeriod"]["endDate"])
    ends = F.filter(F.transform(_or_empty(award["relatedLots"]), end_of), lambda e: e.isNotNull())
    return F.coalesce(iso_date(award["contractPeriod"]["endDate"]), F.get(ends, 0))


def award_contract_ends(awards: DataFrame, lots: DataFrame) -> DataFrame:
    """The same rule for flat tables: ``awards`` (notice_id, award_id, own_end, related_lots),
    ``lots`` (notice_id, lot_id, contract_end)."""
    links = awards.select("notice_id", "award_id", F.posexplode_outer("related_lots").alias("pos", "lot_id"))
    first = (links.join(lots.filter("contract_end IS NOT NULL"), ["notice_id", "lot_id"], "left")
             .groupBy("notice_id", "award_id")
             .agg(F.min_by("contract_end", F.when(F.col("contract_end").isNotNull(), F.col("pos"))).alias("lot_end")))
    return awards.join(first, ["notice_id", "award_id"]).withColumn(
        "period_end", F.coalesce("own_end", "lot_end"))


def _base(kind: Column, external_id: Column, day: Column, name: Column, place: Column,
          contract_end: Column, value: Column, supplier_id: Column, payload: dict[str, Column],
          deadline: Column | None = None, buyer_side: bool = False) -> Column:
    none = F.lit(None)
    return F.struct(
        kind.alias("signal_type"), external_id.alias("external_id"), day.alias("event_date"),
        name.alias("org_name_raw"), place.alias("org_place"), contract_end.alias("contract_end"),
        (none.cast("date") if deadline is None else deadline).alias("deadline"),
        value.cast("double").alias("value"), supplier_id.alias("supplier_id"),
        F.lit(buyer_side).alias("is_buyer_side"),
        F.to_json(F.struct(*[c.alias(k) for k, c in sorted(payload.items())])).alias("payload"))


def signals_of_notices(notices: DataFrame, since: dt.date, as_of: dt.date,
                       deadlines: DataFrame | None = None) -> DataFrame:
    """All procurement signals of the notices in scope, latest notice per external id.

    ``deadlines`` (notice_id, deadline) fills in for notices that carry no tender period.
    Fresh awards, expiring contracts and bidder outcomes are built inside each notice;
    only the deadline lookup and the latest-per-id step move rows.
    """
    today, start = as_of_lit(as_of), as_of_lit(since)
    n = notices.filter("is_it")
    if deadlines is not None:
        n = n.join(deadlines.select("notice_id", F.col("deadline").alias("xml_deadline")), "notice_id", "left")
    else:
        n = n.withColumn("xml_deadline", F.lit(None).cast("date"))

    ocid, lots = F.col("ocid"), F.col("tender.lots")
    cpv = F.slice("cpv_codes", 1, rules.CODES_IN_ROW)
    common = {"ocid": ocid, "notice_id": F.col("notice_id"), "cpv": cpv, "mixed_lot": F.col("mixed_lot"),
              "xml_url": notice_url(F.col("notice_id"), "")}
    none_s, none_v, none_d = F.lit(None).cast("string"), F.lit(None).cast("double"), F.lit(None).cast("date")

    def of_supplier(a: Column, s: Column) -> Column:
        end = lot_contract_end(a, lots)
        day = F.coalesce(iso_date(a["date"]), F.col("d"))
        name, place = strip(s["name"]), F.coalesce(s["address"]["locality"], s["address"]["region"])
        # A supplier without an id is told apart by its name, so none of them is overwritten.
        who = F.coalesce(s["id"], company_key(name))
        tail = F.concat(F.coalesce(a["id"], F.lit("None")), F.lit(":"), who)
        payload = {**common, "buyer": F.col("buyer"), "award_id": a["id"], "value": a["value"]["amount"],
                   "currency": a["value"]["currency"], "contract_end": end, "supplier_id": s["id"],
                   "postal_code": s["address"]["postalCode"]}
        args = (name, place, end, a["value"]["amount"], s["id"], payload)
        usable = F.coalesce(name, F.lit("")) != ""
        return F.array(
            F.when(usable & (day >= start),
                   _base(F.lit(WON), F.concat(ocid, F.lit(":award:"), tail), day, *args)),
            F.when(usable & within(end, today, rules.EXPIRY_WINDOW),
                   _base(F.lit(EXPIRING), F.concat(ocid, F.lit(":expiry:"), tail), today, *args)))

    of_awards = F.flatten(F.flatten(F.transform(_or_empty(F.col("awards")), lambda a: F.transform(
        _or_empty(a["suppliers"]), lambda s: of_supplier(a, s)))))

    named = F.filter(_or_empty(F.col("tender.tenderers")), lambda t: F.coalesce(t["name"], F.lit("")) != "")
    won, outcome, first_end = F.col("won"), F.col("outcome"), F.col("first_end")
    kind = (F.when(outcome == WON_ALONE, F.lit(WON)).when(outcome == LOST, F.lit(NOT_AWARDED))
            .otherwise(F.lit(TOOK_PART)))
    lot_ends = F.filter(F.transform(_or_empty(lots), lambda lot: lot["contractPeriod"]["endDate"]),
                        lambda e: F.coalesce(e, F.lit("")) != "")
    n = (n.withColumn("won", winner_keys(F.col("awards")))
         .withColumn("outcome", outcome_of(F.col("is_award"), F.size("won"), F.size(named),
                                           F.col("tender.numberOfTenderers")))
         .withColumn("first_end", iso_date(F.array_min(lot_ends))))
    day = F.coalesce(F.col("d"), today)

    def of_bidder(t: Column) -> Column:
        return let(clean_name(t["name"]), lambda name: let(company_key(name), lambda key: of_named(t, name, key)))

    def of_named(t: Column, name: Column, key: Column) -> Column:
        place = F.coalesce(t["address"]["locality"], t["address"]["region"])
        payload = {**common, "buyer": F.col("buyer"), "outcome": outcome, "contract_end": first_end,
                   "bidder_count": F.col("tender.numberOfTenderers"), "supplier_id": t["id"],
                   "postal_code": t["address"]["postalCode"]}
        args = (name, place, first_end, none_v, t["id"], payload)
        usable = (name != "") & ~F.array_contains(won, key)
        return F.array(
            F.when(usable & (day >= start), _base(kind, F.concat(ocid, F.lit(":bidder:"), key), day, *args)),
            F.when(usable & (outcome == WON_ALONE) & within(first_end, today, rules.EXPIRY_WINDOW),
                   _base(F.lit(EXPIRING), F.concat(ocid, F.lit(":expiry:bidder:"), key), today, *args)))

    of_bidders = F.flatten(F.transform(named, of_bidder))

    deadline = F.coalesce(iso_date(F.col("tender.tenderPeriod.endDate")), F.col("xml_deadline"))
    no_award = F.size(_or_empty(F.col("awards"))) == 0
    of_tender = F.array(F.when(
        no_award & within(deadline, today, rules.DEADLINE_WINDOW),
        _base(F.lit(OPEN_TENDER), F.concat(ocid, F.lit(":open")), day,
              F.coalesce(F.nullif("buyer", F.lit("")), F.lit("unbekannte Vergabestelle")), F.col("buyer_place"),
              none_d, F.col("tender.value.amount"), none_s,
              {**common, "deadline": deadline, "is_buyer_side": F.lit(True),
               "value": F.col("tender.value.amount")}, deadline=deadline, buyer_side=True)))

    # The outer form keeps Spark from computing the signals a second time for a size filter.
    rows = n.select("notice_id", "buyer", "title", cpv.alias("cpv"),
                    F.array_compact(F.concat(of_awards, of_bidders, of_tender)).alias("rows")).select(
        "notice_id", "buyer", "title", "cpv", F.explode_outer("rows").alias("s"))
    signals = rows.filter("s IS NOT NULL").select(
        F.lit(DOVS).alias("source"), "s.*", F.coalesce("title", F.lit("")).alias("title"), "notice_id", "buyer", "cpv",
        notice_url(F.col("notice_id")).alias("source_url"))
    return latest_per_key(signals.select(*SIGNAL_COLUMNS), ["source", "external_id"], newest_first())


def tenders_without_deadline(notices: DataFrame, as_of: dt.date) -> DataFrame:
    """Open notices in scope that still need their deadline looked up."""
    return notices.filter(
        F.col("is_it") & (F.coalesce("notice_id", F.lit("")) != "") & (F.size(_or_empty(F.col("awards"))) == 0)
        & F.coalesce(F.array_contains("tag", "tender"), F.lit(False))
        & F.col("tender.tenderPeriod.endDate").isNull()
        & (F.col("d") >= F.date_sub(as_of_lit(as_of), rules.DEADLINE_LOOKBACK_DAYS))
    ).select("notice_id", "ocid", "d")


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    The rank filter is applied inside every task before the shuffle, so a key holding a
    large share of the rows arrives as one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def resolve_signals(signals: DataFrame, exclusion_mode: str = "listed") -> DataFrame:
    """Split joint bids, drop excluded names, attach company key and confidence."""
    joint = is_consortium(F.col("org_name_raw"))
    out = (signals.withColumn("consortium", joint)
           .withColumn("member", F.explode_outer(consortium_members(F.col("org_name_raw"))))
           .withColumn("company_id", company_key(F.col("member")))
           .filter(exclusion_reason(F.col("member"), exclusion_mode, F.col("company_id")).isNull()))
    confidence = resolution_confidence(
        F.col("source"), F.lit(1.0), F.coalesce("org_place", F.lit("")) != "",
        F.coalesce("supplier_id", F.lit("")) != "", F.lit(False), F.col("consortium"))
    member_id = F.concat("external_id", F.lit(":"), "company_id")
    return (out.withColumn("external_id", F.when(F.col("consortium"), member_id).otherwise(F.col("external_id")))
            .withColumn("org_name_raw", F.col("member")).drop("member")
            .withColumn("match_confidence", confidence))


def review_queue(resolved: DataFrame) -> DataFrame:
    """Rows that are not sure enough to be used without a look."""
    return resolved.filter(F.col("match_confidence") < rules.MIN_RESOLUTION_CONFIDENCE).select(
        signal_id(F.col("source"), F.col("external_id")).alias("signal_id"), "org_name_raw", "org_place",
        F.array("org_name_raw").alias("candidates"), F.lit("confidence unter Schwelle").alias("reason"))


def signal_id(source: Column, external_id: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", source, external_id), 256), 1, 32)


def content_hash(signal_type: Column, event_date: Column, org_name: Column, place: Column,
                 title: Column, payload: Column) -> Column:
    """Hash of the lasting content.  The date of an expiry signal is the day of the run and
    stays out, otherwise the signal would change daily."""
    day = F.when(signal_type != EXPIRING, event_date)
    content = F.to_json(F.struct(
        day.alias("event_date"), org_name.alias("org_name_raw"), place.alias("org_place"),
        payload.alias("payload"), signal_type.alias("signal_type"), title.alias("title")))
    return F.substring(F.sha2(content, 256), 1, 32)


def with_identity(resolved: DataFrame) -> DataFrame:
    return (resolved.withColumn("signal_id", signal_id(F.col("source"), F.col("external_id")))
            .withColumn("content_hash", content_hash(
                F.col("signal_type"), F.col("event_date"), F.col("org_name_raw"), F.col("org_place"),
                F.col("title"), F.col("payload"))))


def active_signals(signals: DataFrame, as_of: dt.date, days: int = rules.ACTIVE_DAYS) -> DataFrame:
    return signals.filter(F.col("event_date") >= F.date_sub(as_of_lit(as_of), days))


def days_left(day: Column, as_of: dt.date) -> Column:
    return -age_days(day, as_of_lit(as_of))
