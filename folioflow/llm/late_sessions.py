"""Sessions under late events: every version of every session, from cut lifetimes, without replaying batches.

A time is a session's start from the batch it is first seen (its birth) until an event within the gap before it arrives
(its death), and symmetrically for ends. Births and deaths are minima over range windows, so one pass over neighbours
knows all starts and ends of all batches; the session of an event in a batch then runs from the last start to the first
end around it that live in that batch. Starts that never die are carried along the user's time line; those that die are
written out for the batches in which they live. Totals are differences of running sums, less what was still missing.

Scale: a user's time line is cut into tiles of tile_s seconds, each read with the gap around it, so a window holds the
different (time, batch) pairs of one tile whatever share of all rows the user has. What passes from tile to tile is one
row a tile, carried over groups of FAN tiles. A start that dies costs a row for each batch it lives, an event one for
each batch that the user's line has gone past it. Nothing is broadcast or collected.

Defined cases: rows without user, time or batch are no events; repeated rows count as often as they occur; events at one
time are one place; an empty table gives no versions; columns beside the named ones are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

GAP_S = 240
TILE_S = 1200
FAN = 256
_OVER = {"sum": F.sum, "max": F.max, "min": F.min}


def conversation_events(conversations: DataFrame) -> DataFrame:
    """user, s, batch, h of the rows with a turn, by the contract's folds of crc32; rows without conv_id have no user."""
    rows = conversations.where("turn is not null and conv_id is not null").select("conv_id", "turn")
    rows = rows.withColumn("c", F.crc32(F.col("conv_id").cast("string"))).withColumn("h", F.crc32(F.concat_ws(":", "conv_id", "turn")))
    rows = rows.withColumn("s", F.expr("(c div 2) % 7200 + 300 * turn + h % 600")).withColumn("g", F.expr("h div 600"))
    user, batch = F.expr("2 * ((conv_id - pmod(conv_id, 8)) div 8) + c % 2"), F.expr("(s - pmod(s, 1800)) div 1800 + if(g % 3 = 0, g % 4, 0)")
    return rows.select(user.alias("user"), F.col("s"), batch.alias("batch"), F.col("h"))


def _tile(at: str, width: int) -> Column:
    return F.expr(f"({at} - pmod({at}, {width})) div {width}")


def _carried(tiles: DataFrame, keys: list[str], before: dict[str, str], after: dict[str, str]) -> DataFrame:
    """keys, tile and, for each named column, its aggregate over the earlier (before) or later (after) tiles of the keys."""

    def over(df: DataFrame, parts: list[str]) -> DataFrame:
        asc, desc = (Window.partitionBy(*parts).orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in ("tile", F.desc("tile")))
        made = [_OVER[f](c).over(w).alias(f"{c}_x") for cols, w in ((before, asc), (after, desc)) for c, f in cols.items()]
        return df.select("*", *made)

    both = before | after
    group = [_OVER[f](c).alias(c) for c, f in both.items()]
    upper = over(tiles.groupBy(*keys, _tile("tile", FAN).alias("wide")).agg(*group).withColumnRenamed("wide", "tile"), keys)
    upper = upper.select(*keys, F.col("tile").alias("wide"), *(F.col(f"{c}_x").alias(f"{c}_up") for c in both))
    lower = over(tiles.withColumn("wide", _tile("tile", FAN)), [*keys, "wide"]).join(upper, [*keys, "wide"])

    def joined(c: str, f: str) -> Column:
        x, up = F.col(f"{c}_x"), F.col(f"{c}_up")
        return F.coalesce(x, F.lit(0)) + F.coalesce(up, F.lit(0)) if f == "sum" else F.greatest(x, up) if f == "max" else F.least(x, up)

    return lower.select(*keys, "tile", *(joined(c, f).alias(f"{c}_far") for c, f in both.items()))


def _points(events: DataFrame, gap_s: int, width: int) -> DataFrame:
    """A row for each (user, s, b): birth of the time, first arrivals around it, running totals, nearest lasting start and end."""
    points = events.where("user is not null and s is not null and batch is not null").groupBy("user", "s", F.col("batch").alias("b"))
    points = points.agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("h"))
    spread = F.array_distinct(F.array(_tile("s", width), _tile(f"(s - {gap_s})", width), _tile(f"(s + {gap_s})", width)))
    near = points.withColumn("tile", F.explode(spread))
    line = Window.partitionBy("user", "tile").orderBy("s")
    arrival = F.struct("b", "s")
    near = near.select(
        "*",
        F.min("b").over(line.rangeBetween(0, 0)).alias("birth"),
        F.min(arrival).over(line.rangeBetween(-gap_s, -1)).alias("start_killer"),
        F.min(arrival).over(line.rangeBetween(1, gap_s)).alias("end_killer"),
    ).where(F.col("tile") == _tile("s", width))
    below, upto = line.rangeBetween(Window.unboundedPreceding, -1), line.rangeBetween(Window.unboundedPreceding, 0)
    onward = Window.partitionBy("user", "tile").orderBy(F.desc("s")).rangeBetween(Window.unboundedPreceding, 0)
    inner = near.select(
        "*",
        *(F.coalesce(F.sum(c).over(below), F.lit(0)).alias(f"{c}_below") for c in "nh"),
        *(F.sum(c).over(upto).alias(f"{c}_upto") for c in "nh"),
        F.max(F.when(F.col("start_killer").isNull(), F.col("s"))).over(upto).alias("opened"),
        F.min(F.when(F.col("end_killer").isNull(), F.col("s"))).over(onward).alias("closed"),
        F.min("b").over(onward).alias("later"),
    )
    tiles = inner.groupBy("user", "tile").agg(*(F.sum(c).alias(c) for c in "nh"), F.max("opened").alias("opened"), F.min("closed").alias("closed"), F.min("b").alias("later"))
    far = _carried(tiles, ["user"], {"n": "sum", "h": "sum", "opened": "max"}, {"closed": "min", "later": "min"})
    moved = {f"{c}_{p}": F.col(f"{c}_{p}") + F.col(f"{c}_far") for c in "nh" for p in ("below", "upto")}
    moved |= {"opened": F.coalesce("opened", "opened_far"), "closed": F.coalesce("closed", "closed_far"), "later": F.least("later", "later_far")}
    return inner.join(far, ["user", "tile"]).withColumns(moved).drop(*(c for c in far.columns if c.endswith("_far")), "tile")


def _placed(points: DataFrame, width: int) -> DataFrame:
    """Every event in its batch, and in each batch that it was missing in (arrives not null), with the start and end around it."""
    born = F.col("b") == F.col("birth")

    def lives(killer: str, end: bool) -> DataFrame:
        dies = points.where(born & (F.col(f"{killer}.b") > F.col("birth")))
        rows = dies.select("user", F.explode(F.sequence("birth", F.col(f"{killer}.b") - 1)).alias("b"), "s", F.lit(None).cast("long").alias("arrives"))
        return rows.withColumn("kind", F.lit("end" if end else "start"))

    cols = ["user", "b", "s", "arrives", "n", "h", "opened", "closed", "kind"]
    held = points.withColumn("arrives", F.lit(None).cast("long")).withColumn("kind", F.lit("event"))
    missing = points.where("later < b").withColumn("arrives", F.col("b")).withColumn("b", F.explode(F.sequence("later", F.col("b") - 1))).withColumn("kind", F.lit("missing"))
    lanes = held.select(*cols).unionByName(missing.select(*cols))
    for rows in (lives("start_killer", False), lives("end_killer", True)):
        lanes = lanes.unionByName(rows, allowMissingColumns=True)
    lanes = lanes.withColumn("tile", _tile("s", width)).withColumn("start", F.when(F.col("kind") == "start", F.col("s"))).withColumn("end", F.when(F.col("kind") == "end", F.col("s")))
    far = _carried(lanes.groupBy("user", "b", "tile").agg(F.max("start").alias("start"), F.min("end").alias("end")), ["user", "b"], {"start": "max"}, {"end": "min"})
    line = Window.partitionBy("user", "b", "tile")
    upto, onward = (line.orderBy(o).rangeBetween(Window.unboundedPreceding, 0) for o in ("s", F.desc("s")))
    found = lanes.withColumn("start", F.max("start").over(upto)).withColumn("end", F.min("end").over(onward)).where("kind in ('event', 'missing')")
    found = found.join(far, ["user", "b", "tile"])
    return found.select("user", "b", "s", "arrives", "n", "h", F.greatest("start", "start_far", "opened").alias("start"), F.least("end", "end_far", "closed").alias("end"))


def versions(events: DataFrame, gap_s: int = GAP_S, tile_s: int = TILE_S) -> DataFrame:
    """All versions of all sessions of events (user, s, batch, h): user, batch, start_s, end_s, n_events, n_new,
    n_retracted, h_sum, retracted_batch and retracted_start_s. Runs at once and gives a table in the shared folder."""
    spark, width = events.sparkSession, max(tile_s, gap_s)
    points, points_at = common.written(_points(events, gap_s, width), "session-points")
    placed, placed_at = common.written(_placed(points, width), "session-places")
    held = placed.where("arrives is null")
    found = held.groupBy("user", "b", "start", "end").agg(F.sum("n").alias("n_new"))

    absent = placed.where("arrives is not null").select("user", "b", "start", "s", "n", "h", F.struct(F.col("arrives").alias("b"), F.col("s").alias("s")).alias("next"))
    absent = found.select("user", "b", "start", "end").join(absent, ["user", "b", "start"]).where("s <= end").groupBy("user", "b", "start")
    absent = absent.agg(F.sum("n").alias("n_out"), F.sum("h").alias("h_out"), F.min("next").alias("next"))

    times = points.where("b = birth")
    firsts = times.select("user", F.col("s").alias("start"), "n_below", "h_below", "start_killer")
    lasts = times.select("user", F.col("s").alias("end"), "n_upto", "h_upto", "end_killer")
    whole = found.join(firsts, ["user", "start"]).join(lasts, ["user", "end"]).join(absent, ["user", "b", "start"], "left")
    total = [(F.col(f"{c}_upto") - F.col(f"{c}_below") - F.coalesce(f"{c}_out", F.lit(0))).alias(name) for c, name in (("n", "n_events"), ("h", "h_sum"))]
    whole = whole.select("user", "b", "start", "end", "n_new", *total, F.least("start_killer", "end_killer", "next").alias("by"))
    # The event that ends a version lies in the session that retracts it.
    by = held.select("user", F.col("b").alias("retracted_batch"), F.col("s").alias("by_s"), F.col("start").alias("retracted_start_s"))
    whole = whole.withColumn("retracted_batch", F.col("by.b")).withColumn("by_s", F.col("by.s")).join(by, ["user", "retracted_batch", "by_s"], "left")
    whole, whole_at = common.written(whole.drop("by", "by_s"), "session-versions")
    counts = whole.where("retracted_batch is not null").groupBy("user", F.col("retracted_batch").alias("b"), F.col("retracted_start_s").alias("start"))
    done = whole.join(counts.agg(F.count(F.lit(1)).alias("n_retracted")), ["user", "b", "start"], "left")
    names = {"b": "batch", "start": "start_s", "end": "end_s"}
    order = ["user", "b", "start", "end", "n_events", "n_new", "n_retracted", "h_sum", "retracted_batch", "retracted_start_s"]
    done = done.withColumn("n_retracted", F.coalesce("n_retracted", F.lit(0).cast("long"))).select(*(F.col(c).cast("long").alias(names.get(c, c)) for c in order))
    done, _ = common.written(done, "sessions")
    common.remove(spark, points_at, placed_at, whole_at)
    return done


def of_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions(conversation_events(common.table(spark, sf_dir, "conversations")))
