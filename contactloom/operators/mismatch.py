"""Depleted stretches of contigs at two resolutions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contactloom.session import spread, stage

#: Grid points of a tile in which islands meet the track.
TILE_POINTS = 64


def wide_mismatches(track: DataFrame, thresholds: DataFrame, wide: int) -> DataFrame:
    """Runs of grid points below the threshold: ref_id, start, end (after the last bin)."""
    low = track.join(thresholds, "ref_id").where(F.col("score_e5") < F.col("thr_e5"))
    run = F.col("pos") - F.lit(wide) * F.row_number().over(Window.partitionBy("ref_id").orderBy("pos"))
    return low.select("ref_id", "pos", run.alias("run")).groupBy("ref_id", "run").agg(F.min("pos").alias("start"), (F.max("pos") + wide).alias("end")).select("ref_id", "start", "end")


def narrow_mismatches(islands: DataFrame, track: DataFrame, narrow: int) -> DataFrame:
    """Narrow each wide island down to the grid points of its least score.

    Each point of the fine grid closes at most one island, in order, and an
    island's minimum is taken from the last point not after its start to its
    closing point, both included.  A contig without any such point keeps its
    wide islands.  An island and the stretch of its minimum meet the track
    once, tile by tile of the grid: the track's rows are shuffled once, and
    what an island's points are read for again is of the islands' size.
    """
    # small tables that several branches read, and the track, which is read for its ends and for its points
    islands, track = stage(islands, "islands"), stage(track, "track")
    grid = track.groupBy("ref_id").agg(F.min("pos").alias("p0"), F.count(F.lit(1)).alias("g"))
    order = Window.partitionBy("ref_id").orderBy("start")
    k = F.row_number().over(order) - 1
    closing = F.least(F.greatest(F.ceil((F.col("end") - F.col("p0")) / narrow), F.lit(0)), F.col("g"))
    ranked = islands.join(grid, "ref_id").select("ref_id", "start", "end", "p0", "g", k.cast("bigint").alias("k"), closing.alias("f"))
    c = F.col("k") + F.max(F.col("f") - F.col("k")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    ranked = ranked.withColumn("c", c)
    ranked = ranked.withColumn("first", F.coalesce(F.lag("c").over(order) + 1, F.lit(0))).where("first <= g")
    ranked = ranked.withColumn("r", F.least(F.floor((F.col("start") - F.col("p0")) / narrow), F.col("g") - 1))
    seen = F.col("r") >= F.col("first")
    at = lambda j: F.col("p0") + j * narrow
    # without a point before it an island has no stretch
    stretch = [F.when(seen, at(j)).alias(n) for j, n in ((F.col("r"), "a"), (F.least("c", F.col("g") - 1), "b"))]
    ranked = stage(ranked.select("ref_id", "k", "start", "end", *stretch), "ranked")

    tile = lambda pos: F.floor(pos / (narrow * TILE_POINTS))
    tiles = F.sequence(tile(F.least("start", "a")), tile(F.greatest(F.col("end") - 1, "b")))
    pieces = spread(ranked, "ref_id", "k").select(F.col("ref_id").alias("i_ref"), "k", "start", "end", "a", "b", F.explode(tiles).alias("i_tile"))
    counts, picked = F.coalesce(F.col("pos").between(F.col("a"), F.col("b")), F.lit(False)), (F.col("pos") >= F.col("start")) & (F.col("pos") < F.col("end")) & ((F.col("pos") - F.col("start")) % narrow == 0)
    met = track.join(pieces, (F.col("ref_id") == F.col("i_ref")) & (tile(F.col("pos")) == F.col("i_tile")) & (counts | picked))
    met = stage(met.select("ref_id", "k", "pos", "score_e5", counts.alias("counts"), picked.alias("picked")), "points")
    # without a stretch the minimum is 0
    least = met.groupBy("ref_id", "k").agg(F.coalesce(F.min(F.when(F.col("counts"), F.col("score_e5"))), F.lit(0)).alias("least"))
    picks = met.where("picked").join(least, ["ref_id", "k"]).where("score_e5 = least").select("ref_id", "pos")
    picks = stage(picks, "picks")
    run = F.col("pos") - F.lit(narrow) * F.row_number().over(Window.partitionBy("ref_id").orderBy("pos"))
    fine = picks.withColumn("run", run).groupBy("ref_id", "run").agg(F.min("pos").alias("start"), (F.max("pos") + narrow).alias("end")).select("ref_id", "start", "end")
    return fine.unionByName(islands.select("ref_id", "start", "end").join(fine.select("ref_id").distinct(), "ref_id", "left_anti"))
