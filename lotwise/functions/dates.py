"""Dates, ages and their German wording."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from lotwise import rules


def as_of_lit(as_of: dt.date) -> Column:
    return F.lit(as_of).cast("date")


def iso_date(value: Column) -> Column:
    """Date part of any ISO timestamp, in the zone it is written in; null when unreadable."""
    return F.try_to_date(F.substring(value.cast("string"), 1, 10), "yyyy-MM-dd")


def age_days(day: Column, as_of: Column) -> Column:
    return F.datediff(as_of, day)


def recency_factor(day: Column, as_of: Column) -> Column:
    age = age_days(day, as_of)
    out = F.when(age < 0, F.lit(1.0))
    for limit, factor in rules.RECENCY_BUCKETS:
        out = out.when(age <= limit, F.lit(factor))
    return out.otherwise(F.lit(rules.RECENCY_FLOOR))


def age_text(days: Column) -> Column:
    months = F.floor(days / 30).cast("int")
    return (
        F.when(days.isNull(), F.lit("ohne Datum"))
        .when(days <= 1, F.lit("juengster Beleg von heute"))
        .when(days <= 31, F.concat(F.lit("juengster Beleg vor "), days.cast("string"), F.lit(" Tagen")))
        .otherwise(F.concat(F.lit("juengster Beleg vor "), months.cast("string"), F.lit(" Monat"),
                            F.when(months == 1, F.lit("")).otherwise(F.lit("en"))))
    )


def german_date(day: Column) -> Column:
    return F.coalesce(F.date_format(day, "dd.MM.yyyy"), F.lit("zuletzt"))
