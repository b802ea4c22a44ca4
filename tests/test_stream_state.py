"""Keyed stream state, late buckets, bucketed state and the scans over written files."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from lotwise.plans import scans
from lotwise.plans.views import table
from lotwise.schemas import SIGNAL_COLUMNS
from lotwise.sources import deadlines, notices
from lotwise.sources.bucketed import BucketedState
from lotwise.sources.state import SignalState
from lotwise.streaming import keyed, late

AT = dt.datetime(2026, 9, 1)
SF = "/root/testdata/sf0.001"
NARROW = "signal_id string, content_hash string, event_date date, notice_id string"


def deliver(spark, root, n, rows, keep_days=keyed.KEEP_DAYS):
    spark.createDataFrame(rows, NARROW).write.parquet(f"{root}/in/delivery-{n}")
    stream = spark.readStream.schema(NARROW).parquet(f"{root}/in/delivery-*")
    keyed.emit_changes(stream, f"{root}/out", f"{root}/checkpoint", AT + dt.timedelta(days=n), keep_days).awaitTermination()


def test_there_and_back_is_two_changes(spark, tmp_path):
    day = dt.date(2026, 8, 1)
    a, b, other = ("s", "A", day, "1"), ("s", "B", day, "2"), ("t", "X", None, None)
    for n, rows in enumerate(([a, other], [b, ("s", "A", day, "1"), other], [a]), 1):
        deliver(spark, tmp_path, n, rows)
    got = spark.read.parquet(f"{tmp_path}/out").orderBy("seen_at", "signal_id").collect()
    assert [(r.seen_at.day, r.signal_id, r.content_hash, r.status, r.change_count, r.first_seen_at.day) for r in got] == [
        (2, "s", "A", "new", 0, 2), (2, "t", "X", "new", 0, 2), (3, "s", "B", "changed", 1, 2), (3, "t", "X", "unchanged", 0, 2), (4, "s", "A", "changed", 2, 2)]
    assert keyed.KEEP_DAYS >= 56 + 14
    assert any("rocksdb" in str(p).lower() or p.suffix == ".zip" or p.suffix == ".changelog" for p in tmp_path.rglob("checkpoint/state/**/*"))


class Held:
    """A state value in memory, and how often it was called."""

    def __init__(self):
        self.value, self.calls = None, 0

    def getValueState(self, *_):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value


class At:
    def __init__(self, day):
        self.day = day

    def getCurrentProcessingTimeInMs(self):
        return self.day * 86_400_000


def test_a_bucket_is_one_call_and_forgets_signal_by_signal():
    """The calls do not grow with the signals, and a signal goes when its own time is over, not its bucket's."""
    from pyspark.sql import Row
    held, memory = Held(), keyed.SignalMemory(10)
    memory.init(held)

    def tell(day, *rows):
        given = [Row(signal=dict(signal_id=i, content_hash=h, event_date=e, notice_id=None, _seen=day)) for i, h, e in rows]
        out = memory.handleInputRows((0,), iter(given), At(day))
        return {r["signal"]["signal_id"]: (r["signal"]["content_hash"], r["status"], r["first_seen"], r["change_count"]) for r in out}

    many = [(str(i), "A", None) for i in range(1000)]
    day = dt.date(2026, 8, 1)
    assert tell(1, *many, (None, None, None)) == {str(i): ("A", "new", 1, 0) for i in range(1000)} | {None: (None, "new", 1, 0)}
    assert tell(9, ("7", "A", day), ("7", "B", day), ("7", "C", None), (None, None, None), ("new", "A", None)) == {
        "7": ("B", "changed", 1, 1), None: (None, "unchanged", 1, 0), "new": ("A", "new", 9, 0)}
    assert tell(12, ("7", "A", None), ("8", "A", None)) == {"7": ("A", "changed", 1, 2), "8": ("A", "new", 12, 0)}
    assert held.calls == 6 and sorted(map(str, held.value[0])) == ["7", "8", "None", "new"]


def test_state_has_a_row_per_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "BUCKETS", 3)
    rows = [(f"s{i}", "A", None, str(i)) for i in range(60)]
    for n, part in enumerate((rows, [(i, "B" if k % 2 else "A", None, None) for k, (i, *_) in enumerate(rows[:40])]), 1):
        deliver(spark, tmp_path, n, part)
    told = {(r.seen_at.day, r.signal_id): (r.status, r.change_count, r.first_seen_at.day) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert told == {(2, f"s{i}"): ("new", 0, 2) for i in range(60)} | {
        (3, f"s{i}"): ("changed", 1, 2) if i % 2 else ("unchanged", 0, 2) for i in range(40)}
    state = spark.read.format("statestore").option("stateVarName", "known").load(f"{tmp_path}/checkpoint").select("key.bucket", "value.*")
    assert {r.bucket for r in state.collect()} <= {0, 1, 2} and state.selectExpr("sum(size(value.signal_id))").first()[0] == 60


def signal(i, source, day, content="h"):
    filled = {"source": source, "external_id": str(i), "signal_type": "zuschlag_gewonnen", "event_date": day, "notice_id": str(i), "is_buyer_side": False, "cpv": []}
    return (*[filled.get(c) for c in SIGNAL_COLUMNS], "c", 0.5, False, f"id{i}", content)


def test_late_rows_of_a_stream_are_in_one_place_once(spark, tmp_path):
    from lotwise.schemas import RESOLVED_EXTRA, SIGNAL
    kinds = f"{SIGNAL}, {RESOLVED_EXTRA}, signal_id string, content_hash string"
    state, name = SignalState(spark, f"{tmp_path}/state"), f"{tmp_path}/checkpoint"

    def put(n, rows, at):
        spark.createDataFrame(rows, kinds).write.parquet(f"{tmp_path}/in/delivery-{n}")
        stream = spark.readStream.schema(spark.createDataFrame([], kinds).schema).parquet(f"{tmp_path}/in/delivery-*")
        late.stream_with_late_bucket(stream, state, name, at).awaitTermination()

    put(1, [signal(1, "ted", dt.date(2026, 8, 20)), signal(2, "ted", dt.date(2026, 1, 1)), signal(3, "ted", None)], AT)
    put(2, [signal(4, "ted", dt.date(2026, 8, 10)), signal(5, "ted", dt.date(2026, 8, 20)), signal(6, "new", dt.date(2026, 8, 10))], AT + dt.timedelta(days=7))
    like = spark.createDataFrame([], kinds)
    aside = lambda: sorted(r.signal_id for r in late.late_rows(spark, state, name, like).collect())
    kept = lambda: sorted(r.signal_id for r in state.current().collect())
    # the first batch is judged by the look-back of eight weeks, the second by the first one's day less 14 days
    assert aside() == ["id2", "id4"] and kept() == ["id1", "id3", "id5", "id6"]
    checkpoint = tmp_path / "checkpoint"
    for part in ("commits", "offsets"):  # as if the second batch's end had not been written down
        for p in (checkpoint / part).iterdir():
            if p.name.strip(".").startswith("1") and part == "commits":
                p.rename(tmp_path / f"{part}-{p.name.strip('.')}")
    put(3, [signal(7, "ted", dt.date(2026, 8, 30))], AT + dt.timedelta(days=8))
    assert aside() == ["id2", "id4"] and kept() == ["id1", "id3", "id5", "id6", "id7"]
    assert late.late_rows(spark, state, "another", like).count() == 0


def rows_of(n, content="h", start=0):
    import hashlib
    return [(hashlib.sha256(str(i).encode()).hexdigest()[:32], content, dt.date(2026, 8, 1), str(i)) for i in range(start, start + n)]


def test_a_run_reads_its_buckets_and_leaves_the_state_in_place(spark, tmp_path):
    state = BucketedState(spark, f"{tmp_path}/state", buckets=4, prefix=1, fold_every=3)
    assert state.run(spark.createDataFrame(rows_of(200), NARROW), AT) == 1
    some = [r for r in rows_of(200, "other") if r[0].startswith("a")]
    incoming = spark.createDataFrame(some, NARROW)
    plan = state.with_status(incoming, 2, AT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan  # the incoming rows; none on the state's side
    scan = next(line for line in plan.split("\n") if "FileScan parquet" in line and "lotwise_state" in line)
    assert "prefix" in scan and "Bucketed: true" in scan and "PartitionFilters" in scan
    files = state.known(["a"]).inputFiles()
    assert files and all("prefix=a" in f for f in files)
    assert state.run(incoming, AT) == 2
    assert {(r.status, r.change_count) for r in state.delta(2).collect()} == {("changed", 1)} and state.delta(2).count() == len(some)


def test_folding_and_dead_runs_change_nothing(spark, tmp_path):
    state = BucketedState(spark, f"{tmp_path}/state", buckets=2, prefix=1, fold_every=2)
    for n in range(1, 5):
        assert state.run(spark.createDataFrame(rows_of(30, f"h{n // 2}", 5 * n), NARROW), AT + dt.timedelta(days=n)) == n
        assert len(state.commits()) <= 3
    applied = state.with_status(spark.createDataFrame(rows_of(10, "lost"), NARROW), 5, AT)
    state._put(applied, "5-dead")  # rows written, run not committed
    again = BucketedState(spark, f"{tmp_path}/state", buckets=2, prefix=1, fold_every=2)
    got = {r.signal_id: (r.content_hash, r.first_seen_run, r.last_seen_run, r.change_count) for r in again.known().collect()}
    ids = [r[0] for r in rows_of(60)]
    assert len(got) == 45 and got[ids[5]] == ("h0", 1, 1, 0) and got[ids[10]] == ("h1", 1, 2, 1) and got[ids[49]] == ("h2", 4, 4, 0)
    assert got[ids[20]] == ("h2", 1, 4, 2)


def test_only_wanted_months_are_read(spark, tmp_path):
    scans.write_packages(spark, SF, f"{tmp_path}/corpus")
    docs = notices.read_documents(spark, f"{tmp_path}/corpus").filter(F.col("pub_month").isin(["1997-03"]))
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*pub_month[^\]]*= 1997-03", plan), plan
    assert all("pub_month=1997-03" in r.path for r in docs.select("path").collect())
    shapes = {r.v[:1] + str("releases" in r.v) for r in docs.select(F.col("value").alias("v")).collect()}
    assert "{True" in shapes and any(s.startswith("[") for s in shapes)


def test_parsed_deadlines_of_odd_documents(spark):
    one = "<cac:TenderSubmissionDeadlinePeriod><{p}EndDate{a}>{d}</{p}EndDate>{t}</cac:TenderSubmissionDeadlinePeriod>"
    lot = "<cac:ProcurementProjectLot><cac:TenderingProcess>{}</cac:TenderingProcess></cac:ProcurementProjectLot>"
    head = '<N xmlns="u" xmlns:cac="a" xmlns:cbc="b" xmlns:q="b">'

    def doc(*parts):
        return head + "".join(parts) + "</N>"
    docs = [("two", doc(lot.format(one.format(p="q:", a="", d="2026-11-02Z", t="")), lot.format(one.format(p="cbc:", a=' x="1"', d=" 2026-10-20+02:00 ", t="<cbc:EndTime>12:00:00.000+01:00</cbc:EndTime>")))),
            ("own", doc(f"<cac:TenderingProcess>{one.format(p='', a='', d='2026-01-05', t='')}</cac:TenderingProcess>", lot.format(""))),
            ("none", doc(lot.format(""))), ("bad day", doc(lot.format(one.format(p="cbc:", a="", d="soon", t="")))), ("cut", doc(lot)[:-9]), ("empty", ""), ("null", None)]
    got = {r.notice_id: tuple(r)[1:] for r in deadlines.parsed_deadlines(spark.createDataFrame(docs, "notice_id string, xml string")).collect()}
    none, broken = (None, None, None, None, "keine Frist im XML"), (None, None, None, None, "XML nicht lesbar")
    assert got == {"two": (dt.date(2026, 10, 20), "12:00:00", "+01:00", 2, None), "own": (dt.date(2026, 1, 5), None, None, 1, None), "none": none, "bad day": none,
                   "cut": broken, "empty": broken, "null": broken}


@pytest.mark.parametrize("name", ["orders"])
def test_every_release_is_in_one_document(spark, tmp_path, name):
    scans.write_packages(spark, SF, f"{tmp_path}/corpus")
    releases, rejects = notices.read_checked(spark, f"{tmp_path}/corpus")
    assert releases.count() == releases.select("id").distinct().count() == table(spark, SF, name).count() and rejects.count() > 0


def test_counts_are_taken_while_writing(spark, tmp_path):
    from lotwise.sources.counted import RunCounts
    rows = spark.createDataFrame([("a", "new"), ("a", "new"), ("b", "changed"), ("a", "unchanged")], "source string, status string")
    counts = RunCounts(["a", "quiet", "b", "a"])
    counts.watch(rows).write.parquet(f"{tmp_path}/out")
    assert sorted(tuple(r) for r in counts.statistics(spark).collect()) == [("a", 3, 2, 0, 1), ("b", 1, 0, 1, 0), ("quiet", 0, 0, 0, 0)]
    unnamed = RunCounts(["a"])
    unnamed.watch(rows).write.parquet(f"{tmp_path}/again")
    assert unnamed.statistics(spark) is None and RunCounts([]).statistics(spark) is None


@pytest.mark.parametrize("n,kept,cut", [(1, 1, 6), (3, 3, 4), (7, 7, 0), (9, 7, 0)])
def test_a_cut_is_never_silent(spark, tmp_path, n, kept, cut):
    from lotwise.sources.sinks import write_top
    spark.range(7).write.parquet(f"{tmp_path}/in")
    rows = spark.read.parquet(f"{tmp_path}/in")
    record = write_top(rows, f"{tmp_path}/x", [F.desc("id")], n, "x").first()
    assert tuple(record) == ("x", 7, kept, cut)
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/x/rows").collect()) == list(range(7 - kept, 7))
    with pytest.raises(ValueError):
        write_top(rows, f"{tmp_path}/x", [F.desc("id")], 0, "x")
