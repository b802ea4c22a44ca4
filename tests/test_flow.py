"""Sources, resolution, state, scores, contacts and estimates on literal rows."""

import datetime as dt
import json

import pytest
from conftest import rows
from fixtures import AS_OF, write_documents
from pyspark.sql import functions as F

from lotwise import rules
from lotwise.functions.scoring import resolution_confidence, tier_of
from lotwise.operators import accounts, contacts, delta, enrich, matching, population, quality, signals
from lotwise.operators.joins import salted_lookup
from lotwise.operators.parties import notices_of_releases
from lotwise.sources.notices import read_releases
from lotwise.sources import deadlines, enrichment, jobs, registry, sinks, ted
from lotwise.sources.state import SignalState
from lotwise.session import landed as land_once
from lotwise.streaming.signals import stream_into_state

NOW = dt.datetime(2026, 9, 27, 6)


def write_json_lines(path, items):
    path.write_text("\n".join(json.dumps(i) for i in items))
    return str(path)


# --- scans ---------------------------------------------------------------------------------
TED = [
    {"publication-number": "1-2026", "publication-date": "2026-09-01Z", "notice-title": {"fra": "T", "deu": ["Titel"]},
     "buyer-name": {"eng": ["Town"]}, "classification-cpv": ["72000000", "48000000"], "total-value": "12.5",
     "winner-name": {"deu": ["Alpha GmbH", "Beta AG", "Alpha GmbH", "Gamma KG"]},
     "winner-post-code": ["1", "2", "3", "4"], "contract-duration-end-date-lot": ["2027-01-01"]},
    {"publication-number": ["2-2026"], "winner-name": "Solo GmbH"},
    {"notice-title": "ohne Nummer", "winner-name": "X"},
]


def test_ted(spark, tmp_path):
    pages = write_json_lines(tmp_path / "ted.json", [{"notices": TED[:1]}, *TED[1:]])
    s = ted.ted_signals(ted.read_ted(spark, pages))
    assert rows(s, "external_id", "org_name_raw", "title", "buyer", "value") == [
        ("1-2026:0", "Alpha GmbH", "Titel", "Town", 12.5), ("1-2026:1", "Beta AG", "Titel", "Town", 12.5),
        ("1-2026:2", "Gamma KG", "Titel", "Town", 12.5), ("2-2026:0", "Solo GmbH", None, None, None)]
    codes = {r.org_name_raw: json.loads(r.payload).get("winner_post_code") for r in s.collect()}
    assert codes == {"Alpha GmbH": "1", "Beta AG": "2", "Gamma KG": "4", "Solo GmbH": None}


JOBS = [
    {"referenznummer": "r1", "stellenangebotsTitel": "Bid Manager (m/w/d)", "firma": " Beta AG ",
     "stellenlokationen": [{"adresse": {"ort": "Bonn", "plz": "53111"}}], "datumErsteVeroeffentlichung": "2026-09-20"},
    {"refnr": "r2", "titel": "Koch", "beruf": "Tendermanagement", "arbeitgeber": "Omega GmbH",
     "arbeitsort": {"ort": "Köln"}, "veroeffentlichungszeitraum": {"von": "2026-09-21"}},
    {"refnr": "r1", "titel": "Bid Manager alt", "arbeitgeber": "Beta AG", "aktuelleVeroeffentlichungsdatum": "2026-08-01"},
    {"refnr": "r3", "titel": "Einkäufer Bid Manager", "arbeitgeber": "Beta AG"},
    {"refnr": "r4", "titel": "Bid Manager", "arbeitgeber": ""}, {"titel": "Bid Manager", "arbeitgeber": "Ohne Nummer"},
]


def test_jobs(spark, tmp_path):
    s = jobs.job_signals(jobs.job_ads(jobs.read_jobs(spark, write_json_lines(tmp_path / "j.json", JOBS))))
    assert rows(s, "external_id", "org_name_raw", "org_place", "event_date") == [
        ("r1", "Beta AG", "Bonn", dt.date(2026, 9, 20)), ("r2", "Omega GmbH", "Köln", dt.date(2026, 9, 21))]


def block(day=None, time=None):
    inner = (f"<cbc:EndDate>{day}</cbc:EndDate>" if day else "") + (f"<cbc:EndTime>{time}</cbc:EndTime>" if time else "")
    return f"<cac:TenderSubmissionDeadlinePeriod>\n{inner}</cac:TenderSubmissionDeadlinePeriod>"


def test_deadlines(spark, tmp_path):
    (tmp_path / "n7.xml").write_text("<x>" + block("2026-11-01+01:00", "10:00:00+01:00") + block("2026-10-20+02:00", "12:00:00Z")
                                     + block() + "</x>")
    (tmp_path / "n8.xml").write_text("<x/>")
    d = deadlines.read_deadlines(spark, str(tmp_path))
    assert rows(d, "notice_id", "deadline", "uhrzeit", "lose_mit_frist", "fehler") == [
        ("n7", dt.date(2026, 10, 20), "12:00:00", 2, None), ("n8", None, None, None, "keine Frist im XML")]
    c = quality.deadline_coverage(d).first()
    assert (c.total, c.with_deadline, c.error_rate, c.warn) == (2, 1, 0.5, False)


def test_enrichment_aliases(spark, tmp_path):
    f = tmp_path / "e.csv"
    f.write_text('"Company ID","Firma","Website","Mitarbeiterzahl","Quelle"\n"alpha","Alpha GmbH","https://www.alpha.de/x","250-500","clay_ai"\n'
                 '"","Beta AG","","10.000+",""\n')
    r = enrichment.read_enrichment(spark, str(f))
    assert rows(r.fillna(""), "legal_name", "company_id", "domain", "employees", "domain_source") == [
        ("Alpha GmbH", "alpha", "alpha.de", 375, "clay_ai"), ("Beta AG", "", "", 10000, "")]


def test_enrichment_json(spark, tmp_path):
    f = tmp_path / "e.json"
    f.write_text(json.dumps({"records": [{"Company Name": "Alpha GmbH", "url": "alpha.de", "headcount": "1.234"}]}))
    r = enrichment.read_enrichment(spark, str(f)).first()
    assert (r.legal_name, r.domain, r.employees) == ("Alpha GmbH", "alpha.de", 1234)


def test_csv_sink(spark, tmp_path):
    df = spark.createDataFrame([("a", True, ["x", "y"], None)], "id string, ok boolean, codes array<string>, n int")
    sinks.write_csv(df, str(tmp_path / "out"), ["n", "codes", "ok", "id"])
    text = max((f.read_text() for f in (tmp_path / "out").glob("*.csv")), key=len)
    assert text == '"n","codes","ok","id"\n"","x;y","ja","a"\n'


# --- the weekly run ---------------------------------------------------------------------------
@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    root = tmp_path_factory.mktemp("landed")
    for name in ("dovs", "xml"):
        (root / name).mkdir()
    write_documents(root / "dovs")
    (root / "xml" / "n7.xml").write_text(block("2026-10-20", "12:00:00"))
    return {"vergabe_dovs": str(root / "dovs"), "deadlines": str(root / "xml"),
            "ted": write_json_lines(root / "ted.json", TED), "ba_jobs": write_json_lines(root / "jobs.json", JOBS)}


def resolved(spark, paths, as_of=AS_OF):
    raw = registry.all_signals(spark, paths, as_of - dt.timedelta(days=56), as_of)
    return signals.with_identity(signals.resolve_signals(raw))


@pytest.fixture(scope="module")
def base(spark, landed):
    return land_once(resolved(spark, landed), "base")


@pytest.fixture(scope="module")
def weekly(spark, base, tmp_path_factory):
    state = SignalState(spark, str(tmp_path_factory.mktemp("state")))
    state.run(base, NOW)
    return state


def test_second_run_emits_nothing(spark, landed, weekly):
    first = weekly.emitted(1).count()
    assert first == weekly.delta(1).count() > 10
    run = weekly.run(resolved(spark, landed, AS_OF + dt.timedelta(days=1)), NOW + dt.timedelta(days=1))
    # A day later the expiry signals carry another date but the same content.
    assert weekly.emitted(run).count() == 0
    last = weekly.current().agg(F.min("last_seen_run"), F.max("first_seen_run"), F.max("change_count")).first()
    assert tuple(last)[1:] == (1, 0)


def test_changed_new_and_untouched(spark, base, tmp_path):
    state = SignalState(spark, str(tmp_path / "s"))
    state.run(base, NOW)
    changed = base.filter("source = 'ba_jobs'").withColumn("title", F.concat("title", F.lit("!"))).withColumn(
        "content_hash", signals.content_hash(F.col("signal_type"), F.col("event_date"), F.col("org_name_raw"),
                                             F.col("org_place"), F.col("title"), F.col("payload")))
    fresh = changed.limit(1).withColumn("external_id", F.lit("r99")).withColumn("signal_id", F.lit("f" * 32))
    run = state.run(changed.unionByName(fresh).unionByName(changed), NOW)
    assert rows(state.delta(run), "external_id", "status") == [("r1", "changed"), ("r2", "changed"), ("r99", "new")]
    assert rows(state.emitted(run), "external_id") == [("r1",), ("r2",), ("r99",)]
    assert state.current().count() == base.count() + 1
    assert state.current().filter("change_count = 1").count() == 2
    log = {r.run_id: r for r in state.runs().filter("source = 'ba_jobs'").collect()}
    assert (log[2].rows_in, log[2].rows_new, log[2].rows_changed, log[2].rows_unchanged) == (3, 1, 2, 0)


def test_failed_run_moves_nothing(spark, weekly):
    before = rows(delta.fetch_since(weekly.runs(), AS_OF), "source", "since")
    version = weekly.last_version()
    weekly.fail("ted", NOW + dt.timedelta(days=9), "HTTPError: 503")
    assert rows(delta.fetch_since(weekly.runs(), AS_OF), "source", "since") == before
    assert weekly.last_version() == version
    assert delta.last_runs(weekly.runs(), 1).first().errors == "HTTPError: 503"


def test_repeated_batch_is_a_no_op(spark, base, tmp_path):
    state = SignalState(spark, str(tmp_path / "s"))
    state.run(base, NOW, ("stream", 5))
    state.run(base.limit(1), NOW, ("stream", 5))
    assert state.current().count() == base.count() and state.runs().select("run_id").distinct().count() == 1


def test_folding_changes_nothing(spark, base, tmp_path):
    """A state folded after every run reads like one that never is."""
    plain, folded = SignalState(spark, str(tmp_path / "a")), SignalState(spark, str(tmp_path / "b"), fold_every=1)
    for state in (plain, folded):
        state.run(base.filter("source <> 'ted'"), NOW)
        state.run(base.filter("source <> 'ba_jobs'"), NOW + dt.timedelta(days=1))
    cols = ["signal_id", "content_hash", "first_seen_run", "last_seen_run", "change_count"]
    assert folded.base_version() == 2 and plain.base_version() == 0
    assert rows(folded.current(), *cols) == rows(plain.current(), *cols)
    assert rows(folded.delta(2), "signal_id", "status") == rows(plain.delta(2), "signal_id", "status")


def test_late_rows_keep_a_bucket(spark, base):
    since = spark.createDataFrame([("vergabe_dovs", dt.date(2026, 9, 6))], "source string, since date")
    got = delta.tag_late(base, since, dt.date(2026, 9, 21))
    assert got.count() == base.count()
    assert rows(got.filter("source = 'ba_jobs'"), "external_id", "late") == [("r1", True), ("r2", False)]
    assert got.filter("late AND source = 'vergabe_dovs' AND event_date >= '2026-09-06'").count() == 0
    assert got.filter("NOT late AND source = 'vergabe_dovs' AND event_date < '2026-09-06'").count() == 0


def test_stream_equals_batch(spark, base, tmp_path):
    base.filter("source <> 'ted'").write.parquet(str(tmp_path / "in"))
    state = SignalState(spark, str(tmp_path / "stream"))

    def feed():
        stream = spark.readStream.schema(base.schema).parquet(str(tmp_path / "in"))
        stream_into_state(stream, state, str(tmp_path / "ckpt"), NOW).awaitTermination()

    feed()
    base.write.mode("append").parquet(str(tmp_path / "in"))
    feed()
    batch = SignalState(spark, str(tmp_path / "batch"))
    batch.run(base.filter("source <> 'ted'"), NOW)
    batch.run(base, NOW)
    cols = ["signal_id", "status", "content_hash"]
    assert rows(state.delta(2), *cols) == rows(batch.delta(2), *cols)
    assert rows(state.current().drop("cpv"), "signal_id", "first_seen_run", "last_seen_run") == \
        rows(batch.current(), "signal_id", "first_seen_run", "last_seen_run")


def test_reversion_is_two_changes(spark, tmp_path):
    def one(payload):
        cols = [F.lit(None).cast(t).alias(c) for c, t in
                (p.strip().split(" ", 1) for p in __import__("lotwise.schemas", fromlist=["x"]).SIGNAL.split(", "))]
        return (spark.range(1).select(*cols).withColumn("source", F.lit("s")).withColumn("external_id", F.lit("k"))
                .withColumn("payload", F.lit(payload)).withColumn("company_id", F.lit("c"))
                .withColumn("match_confidence", F.lit(0.9)).withColumn("consortium", F.lit(False))
                .withColumn("signal_id", F.lit("i")).withColumn("content_hash", F.lit(payload)))
    state = SignalState(spark, str(tmp_path))
    for content in ("A", "B", "A"):
        state.run(one(content), NOW)
    assert state.current().first().change_count == 2
    assert [state.delta(i).first().status for i in (1, 2, 3)] == ["new", "changed", "changed"]


def test_accounts(spark, landed, weekly):
    active = signals.active_signals(weekly.current(), AS_OF)
    tiers = spark.createDataFrame([("beta", "A")], "account_id string, tier string")
    got = {r.company_id: r for r in accounts.account_signals(active, tiers, AS_OF).collect()}
    assert "omega" not in got and "stadt bonn" not in got
    b = got["beta"]
    assert b.tier == "A" and b.in_longlist_1 and got["gamma"].tier == "C" and not got["gamma"].in_longlist_1
    # best: expiring contract 9 x 1.0 x 1.0 x (0.4 + 0.6 x conf); conf 0.85 with a place, 0.75 without
    assert b.signal_type == "rahmenvertrag_laeuft_aus" and b.enrich
    assert b.why_now.startswith("Ihr Rahmenvertrag „Verfahren n2“ mit Stadt Bonn endet am 20.04.2027")
    assert rows(accounts.job_check_list(active), "firma_raw") == [("Omega GmbH",)]
    o = accounts.open_procedures(active, AS_OF).orderBy("ocid").collect()
    assert [(r.ocid, r.tage_bis_frist) for r in o] == [("ocds-n6", 18), ("ocds-n7", 23)]
    trace = accounts.score_trace(accounts.scored_signals(accounts.with_tier(
        accounts.tag_buckets(active).filter("bucket = 'account'"), tiers), AS_OF)).filter("account_id = 'beta'").first()
    parsed = json.loads(trace.score_components)
    assert parsed["icp_fit"] == 1.0 and len(parsed["top"]) == 5 and parsed["stacking_bonus"] == 2.0


def test_type_coverage_lists_silent_types(weekly):
    silent = {r.signal_type for r in delta.type_coverage(weekly.current()).filter("silent").collect()}
    assert silent == {"nachpruefung_vergabekammer", "leitungswechsel_public", "neue_public_referenz"}


# --- rules ----------------------------------------------------------------------------------------
@pytest.mark.parametrize("proof, n, age, tier", [
    ("P1_zuschlag_24m", 3, 180, "A"), ("P1_zuschlag_24m", 3, 181, "B"), ("P1_zuschlag_24m", 1, 180, "B"),
    ("P1_zuschlag_24m", 1, 181, "C"), ("P1_zuschlag_24m", 2, None, "B"), ("P3_rahmenvertrag", 9, 1, "C"), ("P6_nur_branche", 9, 1, "D"),
])
def test_tiers(one, proof, n, age, tier):
    t = one(lambda p: tier_of(p, F.lit(n), F.lit(age).cast("int"), F.lit(1), F.lit(False)), proof)
    assert t.tier == tier
    assert one(lambda p: tier_of(p, F.lit(n), F.lit(age).cast("int"), F.lit(1), F.lit(True)), proof).tier == "C"


def test_confidence(one):
    def conf(src, place, reg, joint):
        return one(lambda s: resolution_confidence(s, F.lit(1.0), F.lit(place), F.lit(reg), F.lit(False), F.lit(joint)), src)
    assert [conf("vergabe_dovs", True, True, False), conf("ted", False, False, False), conf("ba_jobs", True, False, True),
            conf("x", False, False, False)] == [1.0, 0.72, 0.5, 0.5]


def test_chapman_published_row(spark):
    df = spark.createDataFrame([(1554, 1314, 425)], "a int, b int, m int")
    e = df.select(population.chapman(F.col("a"), F.col("b"), F.col("m")).alias("e")).first().e
    assert (round(e.n), round(e.lo), round(e.hi)) == (4799, 4480, 5118)
    assert df.select(population.chapman(F.col("a"), F.col("b"), F.lit(0)).alias("e")).first().e is None


def test_chao1_published_row(spark):
    counts = spark.range(2443).select((F.when(F.col("id") < 1781, 1).when(F.col("id") < 1781 + 363, 2).otherwise(3)).alias("occasions"))
    r = population.chao1(counts).first()
    assert (r.f1, r.f2, r.observed, round(r.n)) == (1781, 363, 2443, 6798)
    assert round(r.lo) == 6206


def test_full_months_use_the_upper_median(spark):
    days = [("2026-01-05", 10), ("2026-02-05", 8), ("2026-03-05", 6), ("2026-04-05", 3)]
    df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d, n in days for _ in range(n)], "d date")
    got = population.full_months(df.withColumn("month", population.month_of(F.col("d"))))
    assert rows(got, "month", "threshold", "is_full")[-1] == (dt.date(2026, 4, 1), 4.0, False)


def test_merge_prefers_better_sources(spark):
    market = spark.createDataFrame([
        ("alpha", "Alpha GmbH", "alpha.de", "amtlich_bestaetigt", 0.95), ("beta", "Beta AG", None, None, None),
        ("gamma", "Gamma KG", "gamma.de", "enrichment", 0.7), ("delta", "Delta SE", None, None, None)],
        "company_id string, legal_name string, domain string, domain_source string, domain_confidence double")
    market = market.select("*", F.lit(None).cast("long").alias("employees"), F.lit(None).cast("string").alias("employees_scope"),
                           F.lit("B").alias("tier"), F.lit("P1_zuschlag_24m").alias("proof_type"), F.lit(2).cast("long").alias("participations_total"),
                           F.lit(AS_OF).alias("proof_date"), F.lit(1).cast("long").alias("buyers_total"), F.lit(False).alias("mixed_lot_only"))
    cols = ["company_id", *enrich.RECORD, "row_no"]
    rec = spark.createDataFrame([
        ("alpha", "Alpha GmbH", "alpha-group.com", 300, "Germany", None, None, None, None, "clay_ai", "0.99", 1),
        (None, "Beta AG", "beta.de", 21000, "United Kingdom", None, "Beta plc Holdings", None, None, None, None, 2),
        (None, None, "gamma.de", 50, None, None, None, "IT", None, None, None, 3)],
        ", ".join(f"{c} {'long' if c in ('employees', 'row_no') else 'string'}" for c in cols))
    got = {r.company_id: r for r in enrich.merge_enrichment(market, rec, AS_OF).collect()}
    assert (got["alpha"].domain, got["alpha"].domain_action, got["alpha"].employees) == ("alpha.de", "domain_bessere_behalten", 300)
    assert got["alpha"].domain_note == "alpha-group.com verworfen, alpha.de (amtlich_bestaetigt) ist besser belegt"
    assert (got["beta"].domain, got["beta"].domain_source, got["beta"].employees, got["beta"].matched_by) == ("beta.de", "enrichment", None, "name")
    assert got["beta"].employees_note.endswith("| gemeldeter Wert: 21000") and got["beta"].employees_scope == "konzern_oder_unklar"
    assert (got["gamma"].domain_action, got["gamma"].matched_by, got["gamma"].employees) == ("domain_bestaetigt", "domain", 50)
    assert got["delta"].matched_by is None and got["delta"].domain is None


def test_round_robin(spark):
    people = [(a, f"{a}{i}", "verifiziert_apollo" if i == 3 else "mx_ok", rules.PERSONA_USER if i else rules.PERSONA_CHAMPION, f"m{i}")
              for a in "abcx" for i in range(5)] + [("d", "d9", "keine_adresse", rules.PERSONA_CHAMPION, "")]
    df = spark.createDataFrame(people, "company_id string, name string, email_status string, persona string, email string")
    listed = spark.createDataFrame([(c,) for c in "abcd"], "company_id string")

    def choose(leads, accounts):
        got = contacts.choose_contacts(df, listed, "f", [F.col("company_id")], leads, accounts)
        return [(r.round, r.company_id, r.name) for r in got.orderBy("round", "account_rank").collect()]

    assert choose(7, 9) == [(1, "a", "a3"), (1, "b", "b3"), (1, "c", "c3"), (2, "a", "a0"), (2, "b", "b0"), (2, "c", "c0"), (3, "a", "a1")]
    # Fifteen usable contacts do not fill sixteen places, so the others stay in.
    everyone = choose(16, 9)
    assert {c for _, c, _ in everyone} == set("abcdx") and len(everyone) == 13
    assert choose(15, 1) == [(1, "a", "a3"), (2, "a", "a0"), (3, "a", "a1")]


def test_similar_names_equal_brute_force(spark):
    import itertools
    import random
    r = random.Random(5)
    words = ["nord", "süd", "netz", "daten", "werk", "cloud", "haus"]
    names = sorted({" ".join(["alpha", "beta"] + r.sample(words, r.randint(0, 4))) for _ in range(60)})
    df = matching.keyed_names(spark.createDataFrame([(n, "53111") for n in names], "name string, postal_code string"))
    keys = [x.key for x in df.collect()]
    for t in (0.5, 0.6, 0.75, 1.0):
        want = sorted((a, b) for a, b in itertools.permutations(keys, 2)
                      if len(set(a.split()) & set(b.split())) / len(set(a.split()) | set(b.split())) >= t - 1e-9)
        assert rows(matching.similar_names(df, df, t), "key_a", "key_b") == want


@pytest.mark.parametrize("few", [64, 8, 0])
def test_matching_by_subsets_and_by_rare_tokens_equals_brute_force(spark, monkeypatch, few):
    import itertools
    import random
    monkeypatch.setattr(matching, "FEW", few)
    r = random.Random(6)
    words = [f"wort{i}" for i in range(9)]
    names = sorted({" ".join(["alpha", "beta"] + r.sample(words, r.randint(0, 8))) for _ in range(60)} | {"alpha beta wort2 wort1", "alpha beta wort1 wort2"})
    df = matching.keyed_names(spark.createDataFrame([(n, "53111") for n in names], "name string, postal_code string")).cache()
    keys = [x.key for x in df.collect()]
    score = lambda a, b: len(set(a.split()) & set(b.split())) / len(set(a.split()) | set(b.split()))
    for t in (0.6, 0.8):
        want = sorted((a, b) for a, b in itertools.permutations(keys, 2) if score(a, b) >= t - 1e-9)
        assert rows(matching.similar_names(df, df, t), "key_a", "key_b") == want
        assert rows(matching.pairs_once(df, t), "key_a", "key_b") == [p for p in want if p[0] < p[1]]
        best = sorted((a, *min(((-score(a, b), b) for x, b in want if x == a))) for a in {a for a, _ in want})
        assert [(k, -s, b) for k, b, s in rows(matching.best_match(df, df, t), "key_a", "key_b", "score")] == best


def rows_joined(df):
    """The most rows any join of a frame makes."""
    df.collect()

    def joined(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return joined(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            return joined(node.plan())
        own = [node.metrics().apply("numOutputRows").value()] if "Join" in node.nodeName() else []
        return own + [n for i in range(node.children().size()) for n in joined(node.children().apply(i))]
    return max(joined(df._jdf.queryExecution().executedPlan()))


def test_similar_names_meet_only_if_similar(spark):
    """One word in seven and one place in five are shared: only pairs that share both are similar."""
    i = F.col("id")
    names = spark.range(350).select(F.format_string("alpha beta w%d a%d x%d", i % 7, i % 5, i).alias("name"), F.lit("53111").alias("postal_code"))
    pairs = matching.pairs_once(matching.keyed_names(names).cache(), 0.6)
    assert pairs.count() == 35 * 45 and rows_joined(pairs) < 350 * 10


def test_best_match_does_not_make_all_pairs(spark):
    """Names that differ in one word only are all similar; the best of each is found without pairing them."""
    names = spark.range(400).select(F.concat(F.lit("alpha beta netz nord x"), F.col("id").cast("string")).alias("name"), F.lit("53111").alias("postal_code"))
    df = matching.keyed_names(names).cache()
    top = matching.best_match(df, df, 0.6)
    assert top.count() == 400 and {r.key_b for r in top.collect()} == {"alpha beta netz nord x0", "alpha beta netz nord x1"}
    assert rows_joined(top) < 400 * 32


def test_salted_lookup_keeps_every_row(spark):
    left = spark.range(1000).select(F.col("id"), F.when(F.col("id") < 700, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    right = spark.createDataFrame([("hot", 1), ("999", 2)], "k string, v int")
    got = salted_lookup(left, right, "k", ["id"], 4)
    assert got.count() == 1000 and got.filter("v = 1").count() == 700 and got.filter("v = 2").count() == 1


def test_audit_findings(spark):
    sample = spark.createDataFrame([("markt", "u1", "f", "n", "e", "mx_ok", "ok", "", "ja"), ("signale", "u2", "f", "n", "", "keine_adresse", "x", "w", "NEIN")],
                                   "liste string, url string, firma string, name string, email string, email_status string, email_domain_abgleich string, copy_warnung string, gelistet string")
    fetched = spark.createDataFrame([("u1", 200, 900, "application/pdf")], "url string, status int, bytes long, content_type string")
    got = {r.liste: r for r in contacts.audit_findings(sample, fetched).collect()}
    assert (got["markt"].urteil, got["markt"].befunde, got["markt"].beleg_ok) == ("ok", "keine", "ja")
    assert got["signale"].befunde == ("Beleg: nicht erreichbar; Firma nicht in der Longlist zuordenbar; E-Mail: keine_adresse; x; Textqualitaet")


def test_truncation_is_reported(spark):
    r = quality.truncation_report("s", spark.range(10), spark.range(7)).first()
    assert (r.seen, r.written, r.cut) == (10, 7, 3)



# --- nothing is lost ------------------------------------------------------------------------------
def test_a_stream_into_a_used_state_keeps_its_rows(spark, base, tmp_path):
    state = SignalState(spark, str(tmp_path / "state"))
    for day in range(5):
        state.run(base.filter("source <> 'ted'"), NOW + dt.timedelta(days=day))
    before = state.current().count()
    base.filter("source = 'ted'").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(base.schema).parquet(str(tmp_path / "in"))
    stream_into_state(stream, state, str(tmp_path / "ckpt"), NOW).awaitTermination()
    assert state.current().count() == before + base.filter("source = 'ted'").count()
    assert state.last_version() == 6


def test_quiet_runs_are_logged_with_numbers_of_their_own(spark, base, tmp_path):
    state = SignalState(spark, str(tmp_path))
    empty = base.filter("false")
    assert [state.run(empty, NOW, sources=["ted", "ba_jobs"]), state.run(base.filter("source = 'ted'"), NOW, sources=["ted", "ba_jobs"]),
            state.run(empty, NOW)] == [1, 2, 3]
    log = rows(state.runs(), "run_id", "rows_in")
    assert log[0] == (1, 0) and log[1] == (1, 0) and log[-1] == (3, 0) and len([x for x in log if x[0] == 2]) == 2
    assert {r.source for r in delta.fetch_since(state.runs(), AS_OF).collect()} >= {"ted", "ba_jobs"}


def test_open_tenders_are_never_late(spark, base):
    since = spark.createDataFrame([("vergabe_dovs", dt.date(2026, 9, 25))], "source string, since date")
    got = delta.tag_late(base, since, dt.date(2026, 9, 21), F.col("signal_type") == signals.OPEN_TENDER)
    assert got.filter(F.col("late") & (F.col("signal_type") == signals.OPEN_TENDER)).count() == 0
    assert delta.tag_late(base, since, dt.date(2026, 9, 21)).filter(F.col("late") & (F.col("signal_type") == signals.OPEN_TENDER)).count() > 0


def test_names_that_share_a_long_beginning_stay_apart(spark, tmp_path):
    from fixtures import org, release
    tail = "Arbeitskreis fuer kommunale Datenverarbeitungssysteme "
    path = write_json_lines(tmp_path / "n.json", [release("n1", "2026-09-20", tenderers=[org(tail + x + " GmbH") for x in ("Nord", "Sued")])])
    got = signals.signals_of_notices(notices_of_releases(read_releases(spark, path, lines=True)), dt.date(2020, 1, 1), AS_OF)
    assert got.filter("org_name_raw LIKE 'Arbeitskreis%'").select("external_id").distinct().count() == 2


def test_text_at_any_depth(spark):
    deep = '{"a":{"b":{"c":{"d":{"e":{"deu":["Alpha \\"GmbH\\", Köln"],"n":7}}}}}}'
    got = spark.createDataFrame([(deep,)], "j string").select(F.parse_json("j").alias("v")).select(ted.all_strings(F.col("v")).alias("x")).first().x
    assert got == ['Alpha "GmbH", Köln', "7"]


def test_later_row_wins_over_files(spark, tmp_path):
    from lotwise.sources.enrichment import read_enrichment
    (tmp_path / "a.csv").write_text("company_id,legal_name,domain\nx,Old,old.de\nx,Mid,mid.de\n" + "y,Other,other.de\n" * 500)
    (tmp_path / "b.csv").write_text("company_id,legal_name,domain\nx,New,new.de\n")
    got = read_enrichment(spark, str(tmp_path) + "/*.csv").filter("company_id = 'x'").orderBy("row_no").collect()
    assert [r.legal_name for r in got] == ["Old", "Mid", "New"]


def test_an_unreadable_state_is_an_error(spark, tmp_path):
    state = SignalState(spark, str(tmp_path))
    (tmp_path / "runs").mkdir()
    (tmp_path / "runs" / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        state.last_version()
