"""What the sinks write, read back: CSV cells, buckets, cut exports with their record, reruns."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.operators.delta import emitted
from lotwise.plans.registry import query
from lotwise.plans.signals import DELTA, FIRST_END
from lotwise.plans.streams import RUN_AT, as_signals, run_folder
from lotwise.plans.views import table
from lotwise.sources.sinks import write_buckets, write_csv, write_top
from lotwise.sources.state import SignalState


@query("csv_written", """
SELECT CAST(c_custkey AS VARCHAR) AS key, 'K "' || c_name || '", GmbH; x' AS name, CASE WHEN c_custkey % 3 = 0 THEN 'ja' WHEN c_custkey % 3 = 1 THEN 'nein' ELSE '' END AS flag,
  c_mktsegment || ';' || c_custkey AS parts, CASE WHEN c_custkey % 2 = 0 THEN 'Zeile 1' || chr(10) || 'Zeile 2' ELSE '' END AS note FROM customer""")
def csv_written(spark, d):
    """Quotes, separators, line breaks, lists, booleans and missing cells through the CSV sink and back."""
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").select(
        F.array("c_mktsegment", k.cast("string")).alias("parts"), k.alias("key"), F.concat(F.lit('K "'), "c_name", F.lit('", GmbH; x')).alias("name"),
        F.when(k % 3 != 2, k % 3 == 0).alias("flag"), F.when(k % 2 == 0, F.lit("Zeile 1\nZeile 2")).alias("note"))
    out = f"{run_folder(spark, 'csv')}/customers"
    columns = ["key", "name", "flag", "parts", "note"]
    write_csv(rows, out, columns)
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("nullValue", "\0").csv(out)
    return back.select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns])


@query("buckets_written", """
SELECT event_id, CASE WHEN value >= 150 THEN 'buyer_side' WHEN event_type = 'error' THEN 'review' WHEN user_id % 7 = 0 THEN 'unverified' ELSE 'account' END AS bucket FROM events""")
def buckets_written(spark, d):
    """Every event in exactly one bucket folder, read back by folder."""
    bucket = (F.when(F.col("value") >= 150, F.lit("buyer_side")).when(F.col("event_type") == "error", F.lit("review"))
              .when(F.col("user_id") % 7 == 0, F.lit("unverified")).otherwise(F.lit("account")))
    out = f"{run_folder(spark, 'buckets')}/events"
    write_buckets(table(spark, d, "events").select("event_id", bucket.alias("bucket")), out)
    return spark.read.parquet(out).select("event_id", "bucket")


@query("truncated_export", """
WITH n AS (SELECT count(*) AS n FROM orders), t AS (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100)
SELECT 'record' AS kind, NULL::BIGINT AS o_orderkey, n AS total, least(n, 100) AS kept, greatest(n - 100, 0) AS truncated FROM n
UNION ALL SELECT 'row', o_orderkey, NULL, NULL, NULL FROM t""")
def truncated_export(spark, d):
    """The hundred dearest orders as exported, and the record of what was cut."""
    out = f"{run_folder(spark, 'export')}/orders"
    write_top(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), out, [F.desc("o_totalprice"), F.col("o_orderkey")], 100, "orders")
    record = spark.read.parquet(f"{out}/truncation").select(F.lit("record").alias("kind"), F.lit(None).cast("long").alias("o_orderkey"), "total", "kept", "truncated")
    rows = spark.read.parquet(f"{out}/rows").select(F.lit("row").alias("kind"), "o_orderkey")
    return record.unionByName(rows, allowMissingColumns=True)


@query("rerun_emits_nothing", f"""
WITH {DELTA}
SELECT 1::BIGINT AS run, 'new' AS status, count(*) AS n, count(*) AS told FROM old
UNION ALL SELECT 2, 'unchanged', count(*), 0 FROM old""")
def rerun_emits_nothing(spark, d):
    """The same delivery twice: what each run found, and how much of it it put out."""
    state = SignalState(spark, f"{run_folder(spark, 'rerun')}/state")
    delivery = as_signals(table(spark, d, "events").filter(F.col("ts") < F.lit(FIRST_END)))
    runs = [state.run(delivery, RUN_AT) for _ in range(2)]
    out = None
    for run in runs:
        told = emitted(state.delta(run)).select("signal_id", F.lit(1).alias("told"))
        one = (state.delta(run).join(told, "signal_id", "left").groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("told"), F.lit(0)).alias("told"))
               .select(F.lit(run).cast("long").alias("run"), "status", "n", "told"))
        out = one if out is None else out.unionByName(one)
    return out


@query("run_metrics", f"""
WITH {DELTA}, asked AS (SELECT DISTINCT event_type AS source FROM events UNION ALL SELECT 'silent')
SELECT asked.source, count(st.signal_id) AS rows_in, count(*) FILTER (WHERE status = 'new') AS rows_new, count(*) FILTER (WHERE status = 'changed') AS rows_changed,
  count(*) FILTER (WHERE status = 'unchanged') AS rows_unchanged FROM asked LEFT JOIN st ON st.source = asked.source GROUP BY asked.source""")
def run_metrics(spark, d):
    """The second run's line of every source asked, counted while its rows were written."""
    state = SignalState(spark, f"{run_folder(spark, 'metrics')}/state")
    events = table(spark, d, "events")
    asked = [r.event_type for r in events.select("event_type").distinct().collect()]
    for part in (F.col("ts") < F.lit(FIRST_END), F.col("ts") >= F.lit("2024-01-06").cast("timestamp")):
        run = state.run(as_signals(events.filter(part)), RUN_AT, sources=[*asked, "silent"])
    return state.runs().filter(F.col("run_id") == run).select("source", "rows_in", "rows_new", "rows_changed", "rows_unchanged")
