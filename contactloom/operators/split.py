"""Cutting contigs at their mismatches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Bases of a tile of the join of pieces and chunks.
TILE = 1 << 20


def piece_bounds(contigs: DataFrame, mismatches: DataFrame) -> DataFrame:
    """The pieces of contigs (contig_ord, name, length) by their bounds: contig_ord, name, piece_ord, piece_name, from, to.

    Named and cut as by ``split_contigs``.
    """
    order = Window.partitionBy("name").orderBy("start")
    s, e = F.greatest(F.col("start") - 1, F.lit(0)), F.col("end") - 1
    cuts = mismatches.select("name", "start", s.alias("s"), e.alias("e"), F.lag(e, 1, 0).over(order).alias("base"))
    listed = cuts.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("start", "base", "s", "e"))).alias("cuts"))
    rows = contigs.select("contig_ord", "name", "length").join(listed, "name", "left")
    label = lambda a, b: F.concat_ws("_", "name", a.cast("string"), b.cast("string"))
    bounds = lambda n, a, b: F.struct(n.alias("piece_name"), a.cast("bigint").alias("from"), F.least(F.greatest(b, a), F.col("length")).cast("bigint").alias("to"))
    both = F.flatten(F.transform("cuts", lambda c: F.array(bounds(label(c["base"] + 1, c["s"]), c["base"], c["s"]), bounds(label(c["s"] + 1, c["e"]), c["s"], c["e"]))))
    last = F.element_at("cuts", -1)["e"]
    tail = F.filter(F.array(bounds(label(last, F.col("length")), last, F.col("length"))), lambda x: last < F.col("length"))
    pieces = F.when(F.col("cuts").isNull(), F.array(bounds(F.col("name"), F.lit(0), F.col("length")))).otherwise(F.concat(both, tail))
    each = rows.select("contig_ord", "name", F.posexplode(pieces).alias("piece_ord", "p"))
    return each.select("contig_ord", "name", F.col("piece_ord").cast("bigint").alias("piece_ord"), "p.piece_name", "p.from", "p.to")


def split_chunks(contigs: DataFrame, chunks: DataFrame, mismatches: DataFrame) -> DataFrame:
    """Pieces of contigs whose sequence is in chunks (contig_ord, start, seq): name, piece_ord, piece_name, at, seq.

    A row is what a chunk has of a piece, from its base ``at`` on; no row has
    more than a chunk.  Pieces and chunks meet by tile; where Spark broadcasts
    the bounds, as they are few, no sequence is shuffled.
    """
    tile = lambda c: F.floor(c / TILE).cast("bigint")
    pieces = piece_bounds(contigs, mismatches)
    tiled = pieces.where(F.col("from") < F.col("to")).select("*", F.explode(F.sequence(tile(F.col("from")), tile(F.col("to") - 1))).alias("tile"))
    parts = chunks.select("contig_ord", "start", "seq", F.explode(F.sequence(tile(F.col("start")), tile(F.col("start") + F.length("seq") - 1))).alias("tile"))
    skip = F.greatest(F.col("tile") * TILE - F.col("start"), F.lit(0))
    parts = parts.select("contig_ord", "tile", (F.col("start") + skip).alias("start"), F.substring("seq", (skip + 1).cast("int"), ((F.col("tile") + 1) * TILE - F.col("start") - skip).cast("int")).alias("seq"))
    low, high = F.greatest("start", "from"), F.least(F.col("start") + F.length("seq"), F.col("to"))
    cut = parts.join(tiled, ["contig_ord", "tile"]).where(low < high)
    cut = cut.select("name", "piece_ord", "piece_name", (low - F.col("from")).alias("at"), F.substring("seq", (low - F.col("start") + 1).cast("int"), (high - low).cast("int")).alias("seq"))
    none = pieces.where(F.col("from") >= F.col("to")).select("name", "piece_ord", "piece_name", F.lit(0).cast("bigint").alias("at"), F.lit("").alias("seq"))
    return cut.unionByName(none)


def split_contigs(contigs: DataFrame, mismatches: DataFrame) -> DataFrame:
    """Pieces of contigs: name, piece_ord, piece_name, seq.

    ``mismatches`` has name, start, end.  Its cuts are gathered per contig
    first, so that a sequence moves at most once.  A contig without a mismatch
    stays whole under its own name.  With cuts at s = start - 1 and
    e = end - 1 the pieces are named from 1 and end in their last base, but the
    last piece is named by the cut before it.
    """
    order = Window.partitionBy("name").orderBy("start")
    s, e = F.greatest(F.col("start") - 1, F.lit(0)), F.col("end") - 1
    cuts = mismatches.select("name", "start", s.alias("s"), e.alias("e"), F.lag(e, 1, 0).over(order).alias("base"))
    listed = cuts.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("start", "base", "s", "e"))).alias("cuts"))
    joined = contigs.select("name", "seq", F.length("seq").cast("bigint").alias("length")).join(listed, "name", "left")
    label = lambda a, b: F.concat_ws("_", "name", a.cast("string"), b.cast("string"))
    piece = lambda n, a, b: F.struct(n.alias("piece_name"), F.substring(F.col("seq"), (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int")).alias("seq"))
    both = F.flatten(F.transform("cuts", lambda c: F.array(piece(label(c["base"] + 1, c["s"]), c["base"], c["s"]), piece(label(c["s"] + 1, c["e"]), c["s"], c["e"]))))
    last = F.element_at("cuts", -1)["e"]
    tail = F.filter(F.array(piece(label(last, F.col("length")), last, F.col("length"))), lambda x: last < F.col("length"))
    pieces = F.when(F.col("cuts").isNull(), F.array(F.struct(F.col("name").alias("piece_name"), F.col("seq").alias("seq")))).otherwise(F.concat(both, tail))
    return joined.select("name", F.posexplode(pieces).alias("piece_ord", "piece")).select("name", F.col("piece_ord").cast("bigint").alias("piece_ord"), "piece.piece_name", "piece.seq")
