"""Consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only.

The ring has 65,536 cells.  Every shard owns ``vnodes`` stops on it; a row belongs to the
first stop at or after the cell of its key.  A shard keeps its own rows, in ring order, up
to its capacity; the rows beyond it walk on clockwise and fill the free places of the
shards whose stops they pass, first come first served.  With ``slack=0`` the capacities
add up to the number of rows, so counts are at most one apart; with more slack fewer rows
leave their home and a changed number of shards moves fewer rows.

Only counts are needed to decide the walk: one row per cell (65,536) and per stop
(shards x vnodes), whatever the input.  The rows themselves are ranked inside their cell, so the
largest group any task sorts is a 65,536th of the input; repeated rows collapse into one
row with a count before they are shuffled and are unfolded after ranking.

Defined results: a null key hashes like any value; rows equal in all columns share a cell and
take consecutive places; an empty table gives no rows; extra columns stay, those named like
an output (shard, slot) or a working column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotwise.llm.base import query, sheltered, table

CELL_BITS = 16
CELLS = 1 << CELL_BITS


def cell_of(*key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*key), 64 - CELL_BITS).cast("int")


def _ring(spark, shards: int, vnodes: int) -> DataFrame:
    """One row per cell: the stop that owns it and the stop's shard."""
    stops = (spark.range(shards * vnodes)
             .select((F.col("id") % shards).cast("int").alias("shard"), F.expr(f"concat(id % {shards}, ':', id div {shards})").alias("name"))
             .select(cell_of("name").alias("at"), F.xxhash64("name").alias("h"), "shard"))
    line = stops.agg(F.sort_array(F.collect_list(F.struct("at", "h", "shard"))).alias("line"))
    owned = line.select("line", F.posexplode("line").alias("stop", "s")).select(
        "stop", "s.shard",
        F.when(F.col("stop") == 0, F.lit(-1)).otherwise(F.expr("line[stop - 1].at")).alias("after"), "s.at",
        F.expr("line[size(line) - 1].at").alias("last"))
    cells = F.expr("concat(IF(at > after, sequence(after + 1, at), array()), "
                   f"IF(stop = 0 AND last < {CELLS - 1}, sequence(last + 1, {CELLS - 1}), array()))")
    return owned.select("stop", "shard", F.explode_outer(cells).alias("cell"))


def _walk(per_stop: DataFrame, shards: int, slack: float) -> DataFrame:
    """per_stop (stop, shard, n) -> one row per stop with what its rows need to find their place.

    ``before``: rows of the shard at earlier stops, ``room``: the shard's capacity,
    ``first``: rank among all walking rows of the stop's first one, ``moves``: the stretches
    [from, to) of walking rows that its own ones fall into, with shard and first slot.
    """
    own = Window.partitionBy("shard").orderBy("stop").rowsBetween(Window.unboundedPreceding, -1)
    line = (per_stop.withColumn("before", F.coalesce(F.sum("n").over(own), F.lit(0)))
            .agg(F.sort_array(F.collect_list(F.struct("stop", "shard", "n", "before"))).alias("line"), F.sum("n").alias("total"))
            .withColumn("all", F.col("total") + F.ceil(F.col("total") * F.lit(float(slack))).cast("long")))
    line = line.withColumn("room", F.expr(f"transform(sequence(0, {shards - 1}), s -> all div {shards} + IF(s < all % {shards}, 1L, 0L))"))
    line = line.withColumn("line", F.expr(
        "transform(line, x -> struct(x.stop AS stop, x.shard AS shard, x.n AS n, x.before AS before, room[x.shard] AS room, "
        "greatest(0L, least(x.n, x.before + x.n - room[x.shard])) AS over))"))
    line = line.withColumn("free", F.expr(
        f"transform(sequence(0, {shards - 1}), s -> greatest(0L, room[s] - aggregate(line, 0L, (a, x) -> a + IF(x.shard = s, x.n, 0L))))"))
    line = line.withColumn("moves", F.expr("""
        aggregate(
          concat(line, transform(line, x -> named_struct('stop', x.stop, 'shard', x.shard, 'n', x.n, 'before', x.before, 'room', x.room, 'over', 0L))),
          struct(0L AS head, 0L AS tail, free AS free,
                 CAST(array() AS array<struct<`from`: bigint, `to`: bigint, shard: int, slot: bigint>>) AS moves),
          (s, x) -> struct(
            s.head + least(s.tail + x.over - s.head, s.free[x.shard]) AS head,
            s.tail + x.over AS tail,
            IF(least(s.tail + x.over - s.head, s.free[x.shard]) > 0,
               transform(s.free, (f, i) -> IF(i = x.shard, f - least(s.tail + x.over - s.head, f), f)), s.free) AS free,
            IF(least(s.tail + x.over - s.head, s.free[x.shard]) > 0,
               concat(s.moves, array(named_struct('from', s.head, 'to', s.head + least(s.tail + x.over - s.head, s.free[x.shard]),
                                                  'shard', x.shard, 'slot', x.room - s.free[x.shard]))), s.moves) AS moves),
          s -> s.moves)"""))
    firsts = line.withColumn("line", F.expr("""
        aggregate(line, struct(0L AS first, CAST(array() AS array<bigint>) AS firsts),
                  (s, x) -> struct(s.first + x.over AS first, concat(s.firsts, array(s.first)) AS firsts),
                  s -> transform(line, (x, i) -> struct(x.stop AS stop, x.shard AS shard, x.n AS n, x.before AS before,
                                                        x.room AS room, x.over AS over, s.firsts[i] AS first)))"""))
    facts = ", ".join(f"x.{c} AS {c}" for c in ("stop", "shard", "before", "room", "first"))
    own = "filter(moves, m -> m.`from` < x.first + x.over AND m.`to` > x.first)"
    return firsts.select(F.explode(F.expr(f"transform(line, x -> struct({facts}, {own} AS moves))")).alias("x")).select("x.*")


def shard(rows: DataFrame, key: list[str], shards: int, vnodes: int = 32, slack: float = 0.0) -> DataFrame:
    """Add ``shard`` (0 to shards-1) and ``slot`` (gapless from 0 in each shard) to every row.

    ``key`` names the columns that place a row on the ring.  All columns must be groupable.
    Columns called ``shard`` or ``slot`` are replaced, all others keep name and values.
    """
    rows, inner, own_names = sheltered(rows.drop("shard", "slot"))
    names = rows.columns
    at = rows.withColumn("_cell", cell_of(*[F.col(inner[k]) for k in key]))
    counts = at.groupBy("_cell").agg(F.count("*").alias("n"))
    cells = (_ring(rows.sparkSession, shards, vnodes).withColumnRenamed("cell", "_cell")
             .join(counts, "_cell", "left").withColumn("n", F.coalesce("n", F.lit(0))))
    stops = _walk(cells.groupBy("stop", "shard").agg(F.sum("n").alias("n")), shards, slack)
    earlier = Window.partitionBy("stop").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    places = (cells.where("n > 0").withColumn("ahead", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
              .select("stop", "_cell", "ahead").join(stops, "stop"))
    copies = at.groupBy(*names, "_cell").agg(F.count("*").alias("_copies"))
    order = Window.partitionBy("_cell").orderBy(*[F.col(f"`{c}`") for c in names]).rowsBetween(Window.unboundedPreceding, 0)
    ranked = (copies.withColumn("_rank", F.sum("_copies").over(order) - F.col("_copies"))
              .join(places, "_cell")
              .withColumn("_rank", F.explode(F.sequence(F.col("_rank"), F.col("_rank") + F.col("_copies") - 1)))
              .withColumn("_rank", F.col("before") + F.col("ahead") + F.col("_rank")))
    walker = "first + _rank - greatest(room, before)"
    return (ranked.withColumn("_move", F.expr(f"IF(_rank < room, NULL, filter(moves, m -> m.`from` <= {walker} AND {walker} < m.`to`)[0])"))
            .select(*own_names, F.expr("IF(_rank < room, shard, _move.shard)").alias("shard"),
                    F.expr(f"IF(_rank < room, _rank, _move.slot + {walker} - _move.`from`)").alias("slot")))


@query("op1_sharding")
def op1_sharding(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    return shard(docs, ["doc_id", "text_crc32"], shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
