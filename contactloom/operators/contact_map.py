"""Contact maps within contigs and their depletion scores.

Scores are integers, 100,000 times the value, so sums do not depend on order.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contactloom.functions.text import as_float32, bin_floor, truncated_e5
from contactloom.session import spread, stage

log = logging.getLogger(__name__)


def intra_contacts(alignments: DataFrame, min_mapq: int = 1) -> DataFrame:
    """Contacts inside a contig; both mates of a pair count."""
    inside = (F.col("ref_id") != -1) & (F.col("ref_id") == F.col("next_ref_id")) & (F.col("pos") != -1) & (F.col("next_pos") != -1)
    return alignments.where(inside & (F.col("mapq") >= min_mapq)).select("ref_id", "pos", "next_pos")


def bin_contacts(contacts: DataFrame, size: int) -> DataFrame:
    return contacts.groupBy("ref_id", bin_floor(F.col("pos"), size).alias("bin_s"), bin_floor(F.col("next_pos"), size).alias("bin_e")).agg(F.count(F.lit(1)).alias("cnt"))


def widened(contact_map: DataFrame, size: int) -> DataFrame:
    """The map with wider bins of a multiple of its own."""
    return contact_map.groupBy("ref_id", bin_floor(F.col("bin_s"), size).alias("bin_s"), bin_floor(F.col("bin_e"), size).alias("bin_e")).agg(F.sum("cnt").alias("cnt"))


def saturation_level(contact_map: DataFrame, percent: float = 0.95) -> DataFrame:
    """Quantile of the off-diagonal counts per contig: ref_id, sat_e5.

    The rank is percent * (n + 1), between neighbours it is interpolated.  The
    counts of counts are few, so no contig's cells are sorted.
    """
    histogram = contact_map.where("bin_s <> bin_e").groupBy("ref_id", "cnt").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("ref_id").orderBy("cnt")
    run = histogram.withColumns({"upto": F.sum("n").over(upto), "total": F.sum("n").over(Window.partitionBy("ref_id"))})
    q = as_float32(percent) * (F.col("total") + F.lit(1.0))
    lower = F.floor(q)
    at = lambda rank: F.min(F.when(F.col("upto") >= rank, F.col("cnt")))
    per = run.withColumns({"q": q, "lo": lower}).groupBy("ref_id").agg(F.max("total").alias("total"), F.max("q").alias("q"), F.max("lo").alias("lo"), F.min("cnt").alias("least"), F.max("cnt").alias("most"), at(F.col("lo")).alias("x"), at(F.col("lo") + 1).alias("y"))
    level = F.when(F.col("q") < 1, F.col("least").cast("double")).when(F.col("q") >= F.col("total"), F.col("most").cast("double")).otherwise(F.col("x") + (F.col("q") - F.col("lo")) * (F.col("y") - F.col("x")))
    return per.select("ref_id", truncated_e5(F.when(F.col("total") == 1, F.col("least").cast("double")).otherwise(level)).alias("sat_e5"))


#: Bins of a tile of the running sums over a contig.
TILE_BINS = 4096


def depletion_score(contact_map: DataFrame, saturation: DataFrame, size: int, depletion: int) -> DataFrame:
    """Each cell adds its count, at most the saturation, to every bin strictly between its ends.

    A cell is two events, where its value begins and where it ends; the score
    is their running sum, within tiles and over the sums of tiles.  So at most
    two rows of a cell are shuffled, whatever its length, after those of one
    place have been summed.
    """
    gap = F.col("bin_e") - F.col("bin_s")
    cells = contact_map.where((gap >= 2 * size) & (gap <= depletion)).join(saturation, "ref_id")
    value = F.least(F.col("cnt") * 100000, F.col("sat_e5"))
    event = lambda pos, sign: F.struct(pos.alias("pos"), (value * sign).alias("v"), F.lit(sign).cast("bigint").alias("n"))
    events = cells.select("ref_id", F.explode(F.array(event(F.col("bin_s") + size, 1), event(F.col("bin_e"), -1))).alias("e"))
    events = events.groupBy("ref_id", "e.pos").agg(F.sum("e.v").alias("v"), F.sum("e.n").alias("n")).withColumn("tile", F.floor(F.col("pos") / (size * TILE_BINS)))

    by_tile = Window.partitionBy("ref_id").orderBy("tile")
    earlier = by_tile.rowsBetween(Window.unboundedPreceding, -1)
    tiles = events.groupBy("ref_id", "tile").agg(F.sum("v").alias("v"), F.sum("n").alias("n"), F.min("pos").alias("first"))
    tiles = tiles.select("ref_id", "tile", F.coalesce(F.sum("v").over(earlier), F.lit(0)).alias("v0"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"), F.lead("first").over(by_tile).alias("next"))
    inside = Window.partitionBy("ref_id", "tile").orderBy("pos")
    runs = events.join(tiles, ["ref_id", "tile"]).select("ref_id", "pos", (F.col("v0") + F.sum("v").over(inside)).alias("score_e5"), (F.col("n0") + F.sum("n").over(inside)).alias("cells"), F.coalesce(F.lead("pos").over(inside), F.col("next")).alias("until"))
    # where no cell reaches there is no score
    return runs.where("cells > 0").select("ref_id", F.explode(F.sequence("pos", F.col("until") - size, F.lit(size).cast("bigint"))).alias("pos"), "score_e5")


def crop_track(score: DataFrame, size: int, depletion: int) -> DataFrame:
    """The dense inner grid of every contig; bins without a score have 0.

    If ``depletion`` is no multiple of ``size`` the grid misses all scores, of
    which the log warns.
    """
    if depletion % size:
        log.warning("depletion %d is no multiple of the bin size %d: the track reads 0 everywhere", depletion, size)
    ends = score.groupBy("ref_id").agg((F.min("pos") + depletion - 2 * size).alias("lo"), (F.max("pos") - depletion + 3 * size).alias("hi")).where("lo < hi")
    # a contig is few bytes here and many points
    grid = spread(ends, "ref_id").select("ref_id", F.explode(F.sequence("lo", F.col("hi") - 1, F.lit(size).cast("bigint"))).alias("pos"))
    return grid.join(score, ["ref_id", "pos"], "left").select("ref_id", "pos", F.coalesce("score_e5", F.lit(0)).cast("bigint").alias("score_e5"))


def score_track(contact_map: DataFrame, saturation: DataFrame, size: int, depletion: int) -> DataFrame:
    """``crop_track`` of ``depletion_score``, with one shuffle of the events and none of the points.

    The ends of a contig's grid follow from its cells' ends.  Cells are cut at
    the ends and at the tiles' borders, and each tile has an event of value 0
    at both of its borders.  So the running sum within a tile is the score, and
    every event but a tile's last has another after it up to which it holds.
    """
    if depletion % size:
        return crop_track(depletion_score(contact_map, saturation, size, depletion), size, depletion)
    gap, span = F.col("bin_e") - F.col("bin_s"), size * TILE_BINS
    cells = contact_map.where((gap >= 2 * size) & (gap <= depletion))
    ends = cells.groupBy("ref_id").agg((F.min("bin_s") + depletion - size).alias("lo"), (F.max("bin_e") - depletion + 2 * size).alias("hi")).where("lo < hi")
    # one row per contig: small, so mostly sent to where the cells are
    levels = stage(ends.join(saturation, "ref_id").select("ref_id", "lo", "hi", "sat_e5"), "levels")

    tile = lambda c: F.floor(c / span)
    start, until = F.greatest(F.col("bin_s") + size, "lo"), F.least("bin_e", "hi")
    value = F.least(F.col("cnt") * 100000, F.col("sat_e5"))
    kept = cells.join(levels, "ref_id").select("ref_id", start.alias("start"), until.alias("until"), value.alias("v")).where("start < until")
    empty = levels.select("ref_id", F.col("lo").alias("start"), F.col("hi").alias("until"), F.lit(0).cast("bigint").alias("v"))
    cut = kept.unionByName(empty).select("ref_id", "start", "until", "v", F.explode(F.sequence(tile(F.col("start")), tile(F.col("until") - 1))).alias("tile"))
    event = lambda pos, v: F.struct(pos.cast("bigint").alias("pos"), v.alias("v"))
    both = F.array(event(F.greatest("start", F.col("tile") * span), F.col("v")), event(F.least("until", (F.col("tile") + 1) * span), -F.col("v")))
    events = cut.select("ref_id", "tile", F.explode(both).alias("e")).select("ref_id", "tile", "e.pos", "e.v").repartition("ref_id", "tile")

    inside = Window.partitionBy("ref_id", "tile").orderBy("pos")
    summed = events.groupBy("ref_id", "tile", "pos").agg(F.sum("v").alias("v"))
    runs = summed.select("ref_id", "pos", F.sum("v").over(inside).alias("score_e5"), F.lead("pos").over(inside).alias("until")).where("until is not null")
    return runs.select("ref_id", F.explode(F.sequence("pos", F.col("until") - size, F.lit(size).cast("bigint"))).alias("pos"), F.col("score_e5").cast("bigint").alias("score_e5"))


def threshold_e5(saturation: DataFrame, size: int, depletion: int, sensitive: float = 0.5) -> DataFrame:
    """ref_id, thr_e5: below it a contig is depleted."""
    r = depletion / size
    return saturation.select("ref_id", (as_float32(sensitive) * F.col("sat_e5") * 0.5 * r * (r - 1)).alias("thr_e5"))
