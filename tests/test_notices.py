import datetime as dt
import random

import pytest
from conftest import rows
from fixtures import AS_OF, RELEASES, org, release, write_documents

from lotwise import rules
from lotwise.operators import company, domains, quality, signals
from lotwise.operators.parties import notices_of_releases, participations_of_notices
from lotwise.schemas import MARKET_COLUMNS
from lotwise.sources import notices as src

SINCE = dt.date(2026, 8, 2)


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    return src.read_documents(spark, write_documents(tmp_path_factory.mktemp("docs"), broken=True)).cache()


@pytest.fixture(scope="module")
def notices(docs):
    return notices_of_releases(src.releases_of_documents(docs)).cache()


def test_three_shapes_and_rejects(docs):
    assert src.releases_of_documents(docs).count() == len(RELEASES)
    assert [r.path.rsplit("/", 1)[1] for r in src.rejected_documents(docs).collect()] == ["broken.json"]


def test_lines_equal_documents(spark, notices, tmp_path):
    import json
    (tmp_path / "n.jsonl").write_text("\n".join(json.dumps(r) for r in RELEASES))
    lines = notices_of_releases(src.read_releases(spark, str(tmp_path / "n.jsonl"), lines=True))
    cols = ["notice_id", "ocid", "d", "is_it", "reason", "is_award"]
    assert rows(lines, *cols) == rows(notices, *cols)


def test_rows_without_procedure_are_not_counted(spark):
    n = spark.createDataFrame([("c", "n1", "", "award"), ("c", "n2", "o2", "award"), ("c", "n3", None, "award")],
                              "company_id string, notice_id string, ocid string, role string")
    from pyspark.sql import functions as F
    none = F.lit(None).cast("string")
    parts = n.select("*", F.lit(AS_OF).alias("d"), none.alias("outcome"), none.alias("legal_name"), none.alias("buyer"),
                     F.lit(False).alias("consortium"), F.lit(False).alias("mixed_lot"), none.alias("main_cpv"),
                     F.array().cast("array<string>").alias("cpv"), none.alias("city"), none.alias("postal_code"),
                     none.alias("supplier_id"), F.lit(0).alias("pos"), F.lit("dovs").alias("source"), none.alias("url"))
    m = company.market_list(parts, AS_OF).first()
    assert (m.awards_total, m.award_rows, m.participations_total, m.buyers_total) == (1, 3, 1, 0)


def test_scope(notices):
    assert rows(notices.filter("NOT is_it"), "notice_id") == [("n5",)]


def test_participations(notices):
    got = rows(participations_of_notices(notices), "notice_id", "company_id", "role", "outcome", "consortium")
    assert got == [
        ("n1", "alpha", "award", None, False), ("n1", "beta", "bid", "unterlegen", False),
        ("n2", "beta", "bid", "alleinbieter_gewonnen", False),
        ("n3", "beta", "bid", "offen", False), ("n3", "gamma", "bid", "offen", False),
        ("n4", "alpha", "award", None, True), ("n4", "delta", "award", None, True),
        ("n9", "beta", "bid", "alleinbieter_gewonnen", False),
    ]


def test_participations_need_no_shuffle(notices):
    plan = participations_of_notices(notices)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_market_list(notices):
    m = company.market_list(participations_of_notices(notices), AS_OF)
    assert m.columns == MARKET_COLUMNS
    by = {r.company_id: r for r in m.collect()}
    assert set(by) == {"alpha", "beta", "gamma", "delta"}
    a, b, d = by["alpha"], by["beta"], by["delta"]
    assert (a.awards_total, a.award_rows, a.last_award_date, a.proof_type) == (2, 2, dt.date(2026, 9, 1), "P1_zuschlag_24m")
    assert a.proof_url == "https://oeffentlichevergabe.de/api/notices/n1?format=pdf" and not a.consortium_only
    # n2 and n9 are one procedure
    assert (b.participations_total, b.sole_bidder_wins, b.bids_lost, b.bids_outcome_unknown) == (3, 1, 1, 1)
    assert (b.tier, b.win_rate, b.proof_type, b.buyers, b.buyers_total) == ("A", 0.5, "P1B_bieter_unterlegen", "Land;Stadt Bonn", 2)
    assert b.tier_rationale == ("3 Verfahren in 12 Monaten, juengster Beleg vor 26 Tagen, 2 verschiedene Auftraggeber "
                                "- laufender Angebotsprozess")
    assert d.consortium_only and d.tier == "B" and d.last_award_date == dt.date(2026, 7, 30)
    assert (a.legal_name, b.city, a.supplier_ids, a.main_cpv) == ("Alpha GmbH", "Köln", "O1;O4", "72000000")


def test_market_list_ignores_input_order(spark, tmp_path):
    def run(order, name):
        folder = tmp_path / name
        folder.mkdir()
        m = company.market_list(participations_of_notices(notices_of_releases(
            src.read_releases(spark, write_documents(folder, order)))), AS_OF)
        return [tuple(map(str, r)) for r in m.collect()]
    shuffled = RELEASES[:]
    random.Random(3).shuffle(shuffled)
    assert run(RELEASES, "a") == run(shuffled, "b")


def test_summary(notices):
    s = company.market_summary(company.market_list(participations_of_notices(notices), AS_OF)).first()
    assert (s.companies, s.consortium_only, s.named_award, s.losing_bidders, s.sole_winners, s.outcome_open) == (4, 1, 2, 1, 1, 1)


def test_signals(spark, notices):
    xml = spark.createDataFrame([("n7", dt.date(2026, 10, 20))], "notice_id string, deadline date")
    s = signals.signals_of_notices(notices, SINCE, AS_OF, xml)
    got = rows(s, "external_id", "signal_type", "notice_id", "org_name_raw")
    assert got == [
        ("ocds-n1:award:An1:O1", "zuschlag_gewonnen", "n1", "Alpha GmbH"),
        ("ocds-n1:bidder:beta", "angebot_ohne_zuschlag", "n1", "Beta AG"),
        ("ocds-n1:expiry:An1:O1", "rahmenvertrag_laeuft_aus", "n1", "Alpha GmbH"),
        ("ocds-n2:bidder:beta", "zuschlag_gewonnen", "n2", "Beta AG"),     # the newer notice of one procedure
        ("ocds-n2:expiry:bidder:beta", "rahmenvertrag_laeuft_aus", "n2", "Beta AG"),
        ("ocds-n3:bidder:beta", "teilnahme_belegt", "n3", "Beta AG"),
        ("ocds-n3:bidder:gamma", "teilnahme_belegt", "n3", "Gamma KG"),
        ("ocds-n6:open", "offene_ausschreibung_im_profil", "n6", "Stadt Bonn"),
        ("ocds-n7:open", "offene_ausschreibung_im_profil", "n7", "Stadt Bonn"),
        ("ocds-n8:award:An8:auftragnehmer", "zuschlag_gewonnen", "n8", "Auftragnehmer"),
        ("ocds-n8:award:An8:dataport", "zuschlag_gewonnen", "n8", "Dataport"),
    ]


def test_resolved_signals_drop_excluded_and_split(spark, notices):
    s = signals.signals_of_notices(notices, dt.date(2026, 7, 1), AS_OF)
    r = signals.resolve_signals(s)
    got = {x.external_id: x for x in r.collect()}
    assert got["ocds-n4:award:An4:O4:alpha"].match_confidence == 0.8     # 0.75 + 0.15 - 0.10
    assert got["ocds-n4:award:An4:O4:delta"].consortium
    assert got["ocds-n1:award:An1:O1"].match_confidence == 1.0
    assert not any("n8" in k for k in got)


def test_window_edges(spark):
    ends = [(AS_OF + dt.timedelta(days=n)).isoformat() for n in (179, 180, 270, 271)]
    rel = [release(f"e{i}", "2026-09-01", winners=[org("Alpha GmbH", f"O{i}")], lots=[{"id": "L", "contractPeriod": {"endDate": e}}])
           for i, e in enumerate(ends)]
    rel += [release(f"d{n}", "2026-09-01", deadline=(AS_OF + dt.timedelta(days=n)).isoformat()) for n in (9, 10, 32, 33)]
    import json
    lines = spark.createDataFrame([(json.dumps(rel), "x")], "value string, path string")
    from pyspark.sql import functions as F
    d = src.releases_of_documents(lines.withColumn("doc", F.from_json("value", src.DOCUMENT)))
    s = signals.signals_of_notices(notices_of_releases(d), SINCE, AS_OF)
    assert rows(s.filter("signal_type = 'rahmenvertrag_laeuft_aus'"), "notice_id") == [("e1",), ("e2",)]
    assert rows(s.filter("is_buyer_side"), "notice_id") == [("d10",), ("d32",)]


def test_tenders_without_deadline(notices):
    assert rows(signals.tenders_without_deadline(notices, AS_OF), "notice_id") == [("n3",), ("n7",)]


def test_sample_buckets(notices):
    b = quality.sample_bucket(notices, AS_OF)
    assert dict(rows(b, "notice_id", "bucket")) == {
        "n1": "rahmenvertrag_ablauf", "n2": "rahmenvertrag_ablauf", "n3": "mehrbieter", "n4": "zuschlag_mit_gewinner",
        "n5": "zuschlag_mit_gewinner", "n6": "rest", "n7": "rest", "n8": "zuschlag_mit_gewinner", "n9": "alleinbieter"}
    top = quality.stratified_sample(b, dict.fromkeys(rules.STRATA, 1))
    assert rows(top, "notice_id") == [("n2",), ("n3",), ("n7",), ("n8",), ("n9",)]


def test_domains_from_contact_points(spark):
    def party(name, url, mail, *roles):
        return {"name": name, "roles": list(roles), "contactPoint": {"url": url, "email": mail}}
    parties = [
        party("Alpha GmbH", "https://www.alpha.de", "info@alpha.de", "tenderer"),
        party("Beta AG", "fb.hamburg.de", None, "supplier"), party("Stadt", "https://fb.hamburg.de/x", None, "buyer"),
        party("Gamma KG", "gamma.com", "x@konzern.org", "tenderer"), party("Delta SE", "fremd.io", None, "tenderer"),
        party("Eta UG", "eta-eins.de", "b@zwei.de", "tenderer"),
    ]
    import json
    from pyspark.sql import functions as F
    raw = spark.createDataFrame([(json.dumps(release("p", "2026-09-01", parties=parties)), "x")], "value string, path string")
    n = notices_of_releases(src.releases_of_documents(raw.withColumn("doc", F.from_json("value", src.DOCUMENT))))
    firms = spark.createDataFrame([("alpha", "Alpha GmbH"), ("beta", "Beta AG"), ("gamma", "Gamma KG"), ("delta", "Delta SE"),
                                   ("eta", "Eta UG"), ("zeta", "Zeta GmbH")], "company_id string, legal_name string")
    got = dict((r[0], r[1:]) for r in rows(domains.resolve_domains(n, firms), "company_id", "domain", "status"))
    assert got == {"alpha": ("alpha.de", "amtlich_bestaetigt"), "beta": ("", "verworfen_verdacht"),
                   "gamma": ("gamma.com", "amtlich_namensbezug"), "delta": ("", "unter_schwelle"),
                   "eta": ("eta-eins.de", "amtlich_namensbezug"), "zeta": ("", "ohne_kandidat")}


def test_months(spark, tmp_path):
    for month in ("2026-07", "2026-09"):
        (tmp_path / f"pub_month={month}").mkdir()
        write_documents(tmp_path / f"pub_month={month}")
    r = src.read_months(spark, str(tmp_path), ["2026-07", "2026-08", "2026-09"])
    got = src.month_coverage(r, ["2026-07", "2026-08", "2026-09"])
    assert rows(got, "pub_month", "releases", "missing") == [("2026-07", 9, False), ("2026-08", 0, True), ("2026-09", 9, False)]
