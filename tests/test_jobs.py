import datetime as dt

import pytest
from conftest import rows
from fixtures import AS_OF, org, release, write_documents
from pyspark.sql import functions as F
from test_flow import JOBS, TED, write_json_lines

from lotwise import jobs
from lotwise.operators.signals import OPEN_TENDER
from lotwise.operators.parties import notices_of_releases, participations_of_notices
from lotwise.sources.enrichment import read_enrichment
from lotwise.sources.notices import compact, read_months
from lotwise.sources.registry import UnreadableDocuments
from lotwise.sources.state import SignalState

MONTHS = ["2026-08", "2026-09"]


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    (root / "pub_month=2026-09").mkdir()
    write_documents(root / "pub_month=2026-09")
    return str(root)


def test_a_broken_document_stops_the_jobs(spark, tmp_path):
    (tmp_path / "pub_month=2026-09").mkdir()
    folder = write_documents(tmp_path / "pub_month=2026-09", broken=True)
    with pytest.raises(UnreadableDocuments):
        jobs.market_list(spark, str(tmp_path), MONTHS, AS_OF, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "rejects")).count() == 1
    state = SignalState(spark, str(tmp_path / "state"))
    with pytest.raises(jobs.RunFailed, match="unreadable"):
        jobs.weekly_run(spark, {"vergabe_dovs": folder, "rejects": str(tmp_path / "weekly")}, state, dt.datetime.combine(AS_OF, dt.time(6)))
    assert spark.read.parquet(str(tmp_path / "weekly")).count() == 1 and state.current().count() == 0


def test_open_tenders_reach_the_state_when_due(spark, tmp_path):
    """Published on 1 August, deadline 1 October, a fresh bidder every week: due from 7 September on."""
    state = SignalState(spark, str(tmp_path / "state"))
    for week in range(5):
        day = dt.date(2026, 8, 24) + dt.timedelta(days=7 * week)
        (tmp_path / str(week)).mkdir()
        path = write_documents(tmp_path / str(week), [release("t", "2026-08-01", deadline="2026-10-01")] + [
            release(f"b{week}-{i}", day.isoformat(), tenderers=[org(f"Firma {week} {i} GmbH")]) for i in range(5)])
        jobs.weekly_run(spark, {"vergabe_dovs": path}, state, dt.datetime.combine(day, dt.time(6)))
    stored = state.current().filter(F.col("signal_type") == OPEN_TENDER).collect()
    assert len(stored) == 1 and stored[0].last_seen_run >= 3


def test_whole_chain(spark, corpus, tmp_path):
    market = jobs.market_list(spark, corpus, MONTHS, AS_OF, str(tmp_path / "market"))
    assert market.count() == 4
    assert rows(spark.read.parquet(str(tmp_path / "market" / "months")).filter("missing"), "pub_month") == [("2026-08",)]
    ids = spark.read.parquet(str(tmp_path / "market" / "supplier_ids"))
    assert rows(ids, "company_id", "supplier_id") == [("alpha", "O1"), ("alpha", "O4"), ("beta", "O2"), ("delta", "O4")]

    state = SignalState(spark, str(tmp_path / "state"))
    paths = {"vergabe_dovs": f"{corpus}/pub_month=2026-09", "ba_jobs": write_json_lines(tmp_path / "j.json", JOBS),
             "ted": str(tmp_path / "missing.json")}
    at = dt.datetime.combine(AS_OF, dt.time(6))
    with pytest.raises(jobs.RunFailed, match="1 of 3 sources"):
        jobs.weekly_run(spark, paths, state, at)
    assert state.last_version() == 1 and state.current().count() > 5
    assert state.runs().filter("errors IS NOT NULL").first().source == "ted"

    paths["ted"] = write_json_lines(tmp_path / "t.json", TED)
    run = jobs.weekly_run(spark, paths, state, at + dt.timedelta(days=7))
    assert {r.source for r in state.emitted(run).collect()} == {"ted"}

    got = jobs.account_list(spark, state, market, AS_OF, str(tmp_path / "accounts"))
    assert {r.company_id for r in got.collect()} >= {"alpha", "beta", "gamma"}
    buckets = spark.read.parquet(str(tmp_path / "accounts" / "buckets"))
    assert {r.bucket for r in buckets.select("bucket").distinct().collect()} == {"account", "buyer_side", "job_check"}

    notices = notices_of_releases(read_months(spark, corpus, MONTHS))
    table = jobs.completeness(participations_of_notices(notices), notices, str(tmp_path / "c"))
    assert table.count() == 4

    found = jobs.domain_findings(spark, corpus, MONTHS, market, str(tmp_path / "d"))
    assert found.filter(F.col("status") == "ohne_kandidat").count() == 4


def test_compacted_corpus_gives_the_same_list(spark, corpus, tmp_path):
    lines = str(tmp_path / "lines")
    assert compact(spark, corpus, lines, str(tmp_path / "rejects")) == 0
    got = jobs.market_list(spark, lines, MONTHS, AS_OF, str(tmp_path / "a"), lines=True)
    want = jobs.market_list(spark, corpus, MONTHS, AS_OF, str(tmp_path / "b"))
    assert rows(got, *got.columns) == rows(want, *want.columns)
    (tmp_path / "lines" / "pub_month=2026-09" / "x.json").write_text('{"id": "q", "ocid": ')
    with pytest.raises(UnreadableDocuments):
        jobs.market_list(spark, lines, MONTHS, AS_OF, str(tmp_path / "c"), lines=True)


def test_weekly_source_reads_the_named_months(spark, corpus, tmp_path):
    state = SignalState(spark, str(tmp_path / "state"))
    at = dt.datetime.combine(AS_OF, dt.time(6))
    jobs.weekly_run(spark, {"vergabe_dovs": corpus, "months": "2026-08"}, state, at)
    assert state.current().count() == 0 and state.runs().count() == 1
    other = SignalState(spark, str(tmp_path / "other"))
    jobs.weekly_run(spark, {"vergabe_dovs": corpus, "months": "2026-08,2026-09"}, other, at)
    assert other.current().count() > 5


def test_contact_package(spark, tmp_path):
    def export(names, firm):
        cols = {"company_name": firm, "company_domain": "firma.de", "location": "Bonn", "email_1": "Guten Tag", "email_2": None, "email_3": None,
                "mobile_phone": None, "why_now": "aus dem Export", "signal_type": "export", "signal_datum": "2026-09-01", "quell_url": "https://q"}
        df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "full_name string, row_no long")
        return df.withColumns({k: F.lit(v).cast("string") for k, v in cols.items()}).withColumns({
            "job_title": F.lit("Bid Manager"), "profile": F.concat(F.lit("https://p/"), "full_name"), "file_order": F.lit(0),
            "work_email": F.concat(F.lower("full_name"), F.lit("@firma.de"))})

    market = spark.createDataFrame([("alpha", "A", "zuschlag_benannt", "P1_zuschlag_24m", "u1", AS_OF, 3, 1)],
                                   "company_id string, tier string, tier_status string, proof_type string, proof_url string, proof_date date, participations_total long, buyers_total long")
    accounts = spark.createDataFrame([("beta", "B", 80, "zuschlag_gewonnen", AS_OF, "Satz", "u2", 0.9)],
                                     "company_id string, tier string, score int, signal_type string, signal_datum date, why_now string, quell_url string, match_confidence double")
    verified = spark.createDataFrame([("ann@firma.de", "abgleich 01.09.2026")], "email string, origin string")
    mx = spark.createDataFrame([("firma.de", True)], "domain string, mx boolean")
    fetched = spark.createDataFrame([("u1", 200, 900, "application/pdf")], "url string, status int, bytes long, content_type string")
    jobs.contact_package(export(["Ann", "Bob"], "Alpha GmbH"), export(["Cid"], "Beta AG").unionByName(export(["Dan"], "Nobody KG")),
                         verified, mx, market, accounts, fetched, str(tmp_path))
    read = {n: spark.read.option("header", True).csv(str(tmp_path / n)) for n in ("market_contacts", "signal_contacts", "orphans")}
    assert rows(read["market_contacts"], "name", "email_status") == [("Ann", "verifiziert_apollo"), ("Bob", "mx_ok")]
    assert read["market_contacts"].filter("name = 'Ann'").first().email_quelle == "abgleich 01.09.2026"
    assert rows(read["signal_contacts"], "name", "why_now") == [("Cid", "Satz"), ("Dan", "aus dem Export")]
    assert rows(read["orphans"], "name") == [("Dan",)]


def test_merge_enrichment(spark, corpus, tmp_path):
    market = jobs.market_list(spark, corpus, MONTHS, AS_OF, str(tmp_path / "m"))
    (tmp_path / "e.csv").write_text("company_id,legal_name,domain,employees\nalpha,Alpha GmbH,alpha.de,120\n,Beta AG,beta.de,90\n")
    merged = jobs.merge_enrichment(market, read_enrichment(spark, str(tmp_path / "e.csv")), AS_OF, str(tmp_path / "out"))
    assert {r.company_id: (r.domain, r.matched_by) for r in merged.filter("matched_by IS NOT NULL").collect()} == {
        "alpha": ("alpha.de", "id"), "beta": ("beta.de", "name")}
    assert spark.read.parquet(str(tmp_path / "out" / "statistics")).first().gematcht == 2
