"""Costly expressions stand in a plan once."""

import pytest
from pyspark.sql import functions as F

from lotwise.functions import text as tx
from lotwise.operators.parties import notices_of_releases, participations_of_notices
from lotwise.schemas import RELEASE


def conditions(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.split("\n") if "Filter " in line]


def test_name_is_folded_once_for_all_markers(spark):
    df = spark.range(1).select(tx.is_consortium(F.col("id").cast("string")).alias("joint"))
    assert df._jdf.queryExecution().analyzed().toString().count("btrim(") == 1


def test_scope_filter_does_not_compute_the_verdict_again(spark):
    df = participations_of_notices(notices_of_releases(spark.createDataFrame([], RELEASE)))
    assert not [c for c in conditions(df) if "array_distinct" in c]


@pytest.mark.parametrize("text", ["", "ABC xyz", "ÄÖÜ İI ẞ ΑΣ", "a" * 300 + "Z", "Z" * 200, "Éİ", None])
def test_lower_is_spark_lower(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(tx.lower(F.col("t")).alias("a"), F.lower("t").alias("b")).first()
    assert row.a == row.b


def test_stream_state_is_fed_plain_rows():
    """A pandas frame per key took most of a batch's time; the latest row counts, nulls first, the last of equals."""
    import datetime as dt

    from pyspark.sql import Row

    from lotwise.streaming.keyed import SignalMemory

    class Known:
        value = None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value
    memory = SignalMemory(70)
    memory.known = Known()

    def row(content, day, notice, seen=5):
        return Row(signal_id="s", event_date=day, notice_id=notice, content_hash=content, _seen=seen)
    day = dt.date(2026, 8, 1)
    first = list(memory.handleInputRows(("s",), iter([row("B", day, "1"), row("C", None, "9"), row("A", day, None)]), None))
    assert [(r.content_hash, r.status, r["_first"], r.change_count) for r in first] == [("B", "new", 5, 0)]
    second = list(memory.handleInputRows(("s",), iter([row("A", day, "1", 9)]), None))
    assert [(r.content_hash, r.status, r["_first"], r.change_count) for r in second] == [("A", "changed", 5, 1)]


def test_page_text_is_made_once_per_imprint(spark):
    from lotwise.functions.verdicts import verify_imprint
    page = F.regexp_replace(F.col("id").cast("string"), "dear", "")
    df = spark.range(1).select(verify_imprint(page, F.lit("a.de"), F.lit("Alpha GmbH"), F.lit("Ort")).alias("v"))
    assert df._jdf.queryExecution().analyzed().toString().count("dear") == 1


@pytest.mark.parametrize("pattern", ["ROLE_PATTERN", "FILE_NUMBER_PATTERN", "REGISTER_PATTERN"])
def test_patterns_look_at_one_letter_first(pattern):
    assert getattr(tx, pattern).startswith("(?=[")
