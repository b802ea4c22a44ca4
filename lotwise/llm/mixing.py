"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

1. Targets.  Sources get shares of all words by weight, at most ``epochs`` times their own
   words; the excess goes to the others by weight until none is above (one running sum over
   sources ordered by words per weight gives that level directly).
2. Schedule.  Slot i lies at the i-th golden-ratio point of [0, 1); the cumulative targets
   say whose slot it is.  Ranks of a source's slots are counted in chunks of slots first.
   A source whose share is narrower than the points' spacing gets one slot of its own.
3. Blocks.  A source's documents, shuffled by a hash, form one stream of words that is read
   over and over; its k-th slot takes the k-th of equally long stretches that together hold
   its target.  Offsets in the stream are sums per (source, hash prefix) first, then inside
   a prefix, so no task sees a whole source.
4. Documents meet stretches on (source, stretch-sized cell of the stream), an equality join.

A block is at most ``block_words`` long and shorter in a small corpus, which always gets
about ``least_slots`` slots at least (one word being the shortest block).

Defined results: a null source is a source of its own, last in order; a text without words
takes nothing; equal (source, id, size) rows share their place in the shuffle and differ
only in their stretch of the stream; an empty table gives no rows; a source without words
has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotwise.llm.base import SPACED_WORD, landed, query, sheltered, table

POINTS = 1 << 32
#: 2**32 divided by the golden ratio, odd: the step of the golden-ratio points.
STEP = 2654435769
CHUNK = 4096
PREFIXES = 3  # hex digits of the hash that split a source's stream


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: int = 3, epochs: int = 3) -> DataFrame:
    """sizes (source, size) -> source, nth, weight, source_size, target, all_words; one row per source."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    level = Window.orderBy("ratio", "nth")
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    return (by.withColumn("nth", F.row_number().over(named))
            .withColumn("weight", (F.col("nth") - 1) % weights + 1)
            .withColumn("most", F.col("source_size") * epochs)
            .withColumn("ratio", F.col("most") / F.col("weight"))
            .withColumn("all_words", F.sum("source_size").over(everything))
            .withColumn("left_words", F.col("all_words") - F.coalesce(F.sum("most").over(before), F.lit(0)))
            .withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
            .withColumn("level", F.col("left_words") / F.col("left_weight"))
            .withColumn("level", F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(everything))
            .withColumn("target", F.when((F.col("ratio") <= F.col("level")) | F.col("level").isNull(), F.col("most").cast("double"))
                        .otherwise(F.col("level") * F.col("weight")))
            .select("source", "nth", "weight", "source_size", "target", "all_words"))


def schedule(goal: DataFrame, block_words: int = 1024, least_slots: int = 1 << 17) -> DataFrame:
    """goal: rows of ``targets`` -> slot, nth, k, n_slots: whose turn each slot is, its rank k among the source's."""
    words = goal.agg(F.max("all_words")).first()[0] or 0
    block = min(block_words, max(1, words // least_slots))
    slots = -(-words // block)
    upto = Window.orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    spans = (goal.withColumn("hi", F.sum("target").over(upto)).withColumn("lo", F.col("hi") - F.col("target"))
             .select("nth", "target", *[F.least(F.lit(POINTS), F.floor(F.col(c) / F.lit(float(max(words, 1))) * F.lit(float(POINTS))).cast("long")).alias(c)
                                        for c in ("lo", "hi")]))
    cells = spans.where("hi > lo").withColumn("cell", F.explode(F.expr("sequence(lo div 1048576, (hi - 1) div 1048576)")))
    points = (goal.sparkSession.range(slots).withColumnRenamed("id", "slot")
              .withColumn("x", (F.col("slot") % POINTS) * STEP % POINTS).withColumn("cell", F.expr("x div 1048576")))
    own = points.join(cells, "cell").where("lo <= x AND x < hi").select("slot", "nth")
    lone = (spans.where("target >= 1").join(own.select("nth").distinct(), "nth", "left_anti")
            .select(F.expr(f"lo * {slots} div {POINTS}").cast("long").alias("slot"), "nth"))
    turns = own.unionByName(lone).withColumn("chunk", F.expr(f"slot div {CHUNK}"))
    per = turns.groupBy("nth", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("nth").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    per = (per.withColumn("ahead", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
           .withColumn("n_slots", F.sum("n").over(Window.partitionBy("nth"))).drop("n"))
    inside = Window.partitionBy("nth", "chunk").orderBy("slot")
    return (turns.withColumn("r", F.row_number().over(inside) - 1).join(per, ["nth", "chunk"])
            .select("slot", "nth", (F.col("ahead") + F.col("r")).alias("k"), "n_slots"))


def stream(docs: DataFrame, goal: DataFrame) -> DataFrame:
    """docs (source, doc_id, size) -> one row per document with nth and ``at``, its first word's place in the source's stream."""
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    copies = (docs.groupBy("source", "doc_id", "size").agg(F.count("*").alias("copies"))
              .join(goal.select(F.col("source").alias("_s"), "nth", "source_size", "target"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
              .withColumn("h", key).withColumn("part", F.substring("h", 1, PREFIXES)).withColumn("words", F.col("size") * F.col("copies")))
    earlier = Window.partitionBy("nth").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (copies.groupBy("nth", "part").agg(F.sum("words").alias("w"))
             .withColumn("ahead", F.coalesce(F.sum("w").over(earlier), F.lit(0))).drop("w"))
    inside = Window.partitionBy("nth", "part").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (copies.withColumn("r", F.coalesce(F.sum("words").over(inside), F.lit(0))).join(parts, ["nth", "part"])
            .withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
            .withColumn("at", F.col("ahead") + F.col("r") + (F.col("copy") - 1) * F.col("size"))
            .select("source", "nth", "doc_id", "size", "source_size", "target", "copy", "at"))


def mix(docs: DataFrame, weights: int = 3, epochs: int = 3, block_words: int = 1024, least_slots: int = 1 << 17) -> tuple[DataFrame, DataFrame]:
    """docs (source, doc_id, size) -> the placed documents of ``stream`` and the pieces the schedule takes of them.

    A piece (nth, at, slot, k, from_word, to_word) is a run of words of the document placed
    at (nth, at); reading pieces by slot gives the mixed corpus.  Sizes, targets and slots are
    read by several steps and written once, so texts are read once.
    """
    docs = landed(docs.select("source", "doc_id", "size"), "sizes")
    goal = landed(targets(docs, weights, epochs), "targets")
    turns = landed(schedule(goal, block_words, least_slots), "turns")
    placed = stream(docs, goal)
    cuts = (turns.join(goal.select("nth", "source_size", F.floor("target").cast("long").alias("take")), "nth")
            .withColumn("x", F.expr("CAST(CAST(k AS decimal(20)) * take DIV n_slots AS bigint)"))
            .withColumn("y", F.expr("CAST(CAST(k + 1 AS decimal(20)) * take DIV n_slots AS bigint)")).where("y > x")
            .withColumn("wide", F.expr("take div n_slots + 1"))
            .withColumn("lap", F.explode(F.expr("sequence(x div source_size, (y - 1) div source_size)")))
            .withColumn("x", F.expr("greatest(x - lap * source_size, 0L)"))
            .withColumn("y", F.expr("least(y - lap * source_size, source_size)"))
            .withColumn("cell", F.explode(F.expr("sequence(x div wide, (y - 1) div wide)")))
            .select("nth", "cell", "slot", "k", "x", "y", "wide"))
    width = turns.groupBy("nth").agg(F.max("n_slots").alias("n_slots"))
    spread = (placed.where("size > 0").join(width, "nth").withColumn("wide", F.expr("CAST(floor(target) AS bigint) div n_slots + 1"))
              .select("nth", "at", "size", F.explode(F.expr("sequence(at div wide, (at + size - 1) div wide)")).alias("cell")))
    pieces = (spread.join(cuts, ["nth", "cell"]).withColumn("a", F.greatest("x", "at")).withColumn("b", F.expr("least(y, at + size)"))
              .where("b > a AND a div wide = cell")
              .select("nth", "at", "slot", "k", (F.col("a") - F.col("at")).alias("from_word"), (F.col("b") - F.col("at")).alias("to_word")))
    return placed, pieces


def taken(docs: DataFrame, **how) -> DataFrame:
    """docs (source, doc_id, size) -> the same rows with source_size, target and ``taken``, the words the mix takes of each."""
    placed, pieces = mix(docs, **how)
    sums = pieces.groupBy("nth", "at").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("words"))
    # a text without words shares its place with the next one
    key = F.when(F.col("size") > 0, F.col("at"))
    return (placed.withColumn("at", key).join(sums, ["nth", "at"], "left")
            .select("source", "doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).alias("taken")))


def mixed(docs: DataFrame, **how) -> DataFrame:
    """docs in the proportions of the mix, all columns unchanged: each row as often as the mix takes it, to the nearest whole.

    Of rows that share source, id and size the first by text get the larger numbers.
    """
    rows, inner, names = sheltered(docs)
    source, doc_id, text = (inner[c] for c in ("source", "doc_id", "text"))
    rows = rows.withColumn("_size", words_of(F.col(text)))
    took = taken(rows.select(F.col(source).alias("source"), F.col(doc_id).alias("doc_id"), F.col("_size").alias("size")), **how).where("taken > 0")
    times = took.groupBy("source", "doc_id", "size", F.round(F.col("taken") / F.col("size")).cast("int").alias("times")).agg(F.count("*").alias("n"))
    upto = Window.partitionBy("source", "doc_id", "size").orderBy(F.desc("times")).rowsBetween(Window.unboundedPreceding, 0)
    plan = (times.withColumn("upto", F.sum("n").over(upto)).groupBy("source", "doc_id", "size")
            .agg(F.sort_array(F.collect_list(F.struct("upto", "times"))).alias("_plan"))
            .select(F.col("source").alias("_s"), F.col("doc_id").alias("_d"), F.col("size").alias("_z"), "_plan"))
    rows = rows.withColumn("_nth", F.row_number().over(Window.partitionBy(source, doc_id, "_size").orderBy(text)))
    same = F.col(source).eqNullSafe(F.col("_s")) & F.col(doc_id).eqNullSafe(F.col("_d")) & (F.col("_size") == F.col("_z"))
    return (rows.join(plan, same).withColumn("_times", F.expr("filter(_plan, x -> _nth <= x.upto)[0].times")).where("_times > 0")
            .withColumn("_times", F.explode(F.expr("sequence(1, _times)"))).select(*names))


@query("op4_mixing", """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS nth FROM s),
w AS (SELECT *, (nth - 1) % 3 + 1 AS weight, source_size * 3 AS most, sum(source_size) OVER () AS all_words FROM n),
l AS (SELECT *, most / weight AS ratio,
        (all_words - coalesce(sum(most) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS lv
      FROM w WINDOW b AS (ORDER BY most / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
m AS (SELECT *, max(CASE WHEN ratio > lv THEN lv END) OVER () AS level FROM l),
g AS (SELECT source, nth, source_size, all_words::BIGINT AS all_words,
        CASE WHEN level IS NULL OR ratio <= level THEN most::DOUBLE ELSE level * weight END AS target FROM m),
c AS (SELECT *, sum(target) OVER (ORDER BY nth ROWS UNBOUNDED PRECEDING) AS h,
        least(1024, greatest(1, all_words // 131072)) AS block FROM g),
iv AS (SELECT *, least(4294967296, floor((h - target) / all_words * 4294967296)::BIGINT) AS lo,
        least(4294967296, floor(h / all_words * 4294967296)::BIGINT) AS hi, (all_words + block - 1) // block AS slots FROM c),
p AS (SELECT slot, (slot % 4294967296) * 2654435769 % 4294967296 AS x FROM range((SELECT max(slots) FROM iv)::BIGINT) t(slot)),
t0 AS (SELECT slot, nth FROM p JOIN iv ON lo <= x AND x < hi),
n1 AS (SELECT nth, count(*)::BIGINT AS n FROM t0 GROUP BY nth),
k AS (SELECT iv.*, coalesce(n1.n, CASE WHEN target >= 1 THEN 1 ELSE 0 END) AS n_slots FROM iv LEFT JOIN n1 USING (nth)),
o AS (SELECT d.*, k.nth, k.source_size, k.target, CASE WHEN k.n_slots > 0 THEN floor(k.target)::BIGINT ELSE 0 END AS take,
        coalesce(sum(size) OVER (PARTITION BY k.nth ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
      FROM d JOIN k ON d.source IS NOT DISTINCT FROM k.source)
SELECT doc_id, size, source_size, target,
  CASE WHEN source_size = 0 THEN 0 ELSE (take // source_size) * size
    + greatest(0, least(pos + size, take % source_size) - pos) END::BIGINT AS taken FROM o
""")
def op4_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", words_of(F.col("text")).alias("size"))
    return taken(docs).drop("source")
