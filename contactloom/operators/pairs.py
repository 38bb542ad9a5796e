"""From alignments to contact counts between contigs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom.operators.ordinals import dense_ordinal
from contactloom.session import stage

#: Bases per tile of the range join; windows reach over a few tiles.
TILE = 1000


def filter_mapq(alignments: DataFrame, min_mapq: int = 40) -> DataFrame:
    return alignments.where(F.col("mapq") >= min_mapq)


def drop_secondary(alignments: DataFrame, mask: int = 256) -> DataFrame:
    """Rows without any flag of the mask."""
    return alignments.where(F.col("flag").bitwiseAND(F.lit(mask)) == 0)


def coordinate_sort(alignments: DataFrame) -> DataFrame:
    """Add ``aln_id``: the place in coordinate order, unmapped rows last.

    Ties are broken by strand, name and mate; rows that tie even then are equal
    in all that any step reads.  The rows are range-partitioned by all of
    these, so neither a reference with many rows nor the unmapped ones meet in
    one task.
    """
    return dense_ordinal(alignments, "aln_id", _coordinate_order())


def coordinate_keys(alignments: DataFrame) -> DataFrame:
    """Add ``aln_id`` as ``coordinate_sort`` orders it, but as a struct that is compared, not a number.

    It serves steps that only compare rows, such as ``pair_mates``: nothing is
    sorted or shuffled, and rows can be filtered first.  A row's own number
    comes last, so that rows which tie are still rows of their own.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in _coordinate_order()]
    return alignments.withColumn("aln_id", F.struct(*[o.alias(f"o{k}") for k, o in enumerate(order)], F.monotonically_increasing_id().alias("row")))


def _coordinate_order() -> list[Column | str]:
    return [_place(), "ref_id", "pos", F.col("flag").bitwiseAND(F.lit(16)), "read_name", "flag", "next_ref_id", "next_pos", "mapq"]


def _place() -> Column:
    """Unmapped or not, reference and position in one number that never falls in coordinate order.

    Spark's sort compares the first key by itself and whole rows only where it
    ties.  Positions from 2**30 on, negative ones and nulls share a number with
    others; the columns after it tell them apart.
    """
    unmapped = F.when(F.col("ref_id") < 0, 1).otherwise(0).cast("bigint")
    ref = F.greatest(F.least(F.coalesce(F.col("ref_id").cast("bigint"), F.lit(-(1 << 31))), F.lit((1 << 31) - 1)), F.lit(-(1 << 31))) + F.lit(1 << 31)
    pos = F.greatest(F.least(F.coalesce(F.col("pos").cast("bigint"), F.lit(-1)), F.lit((1 << 30) - 2)), F.lit(-1)) + 1
    return unmapped * F.lit(1 << 62) + ref * F.lit(1 << 30) + pos


def map_refs_to_nodes(references: DataFrame, nodes: DataFrame) -> DataFrame:
    """ref_id, ref_name, node_id; the first node of a name, null where there is none."""
    first = nodes.groupBy(F.col("name").alias("ref_name")).agg(F.min("node_id").alias("node_id"))
    return references.join(first, "ref_name", "left").select("ref_id", "ref_name", "node_id")


def filter_known_refs(alignments: DataFrame, ref_map: DataFrame) -> DataFrame:
    """Rows whose own and mate's reference is a node; adds node_id and next_node_id."""
    known = ref_map.where(F.col("node_id").isNotNull())
    own = known.select("ref_id", "node_id")
    mate = known.select(F.col("ref_id").alias("next_ref_id"), F.col("node_id").alias("next_node_id"))
    return alignments.join(own, "ref_id").join(mate, "next_ref_id")


def used_references(alignments: DataFrame, ref_map: DataFrame) -> DataFrame:
    """Of the map, the nodes that some alignment or its mate lies on; written, so that Spark knows its size before it joins."""
    used = alignments.select(F.explode(F.array("ref_id", "next_ref_id")).alias("ref_id")).distinct()
    return stage(ref_map.where("node_id is not null").join(used, "ref_id", "left_semi"), "references")


def near_sites(alignments: DataFrame, ref_map: DataFrame, nodes: DataFrame, windows_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``filter_known_refs`` and ``filter_near_site`` of the windows that ``windows_of`` makes of nodes, written once.

    Nodes without an alignment get no windows.  The steps to pairs and back to
    their rows all read what is written.
    """
    used = used_references(alignments, ref_map)
    own = stage(nodes.join(used.select("node_id"), "node_id", "left_semi"), "used-nodes")
    return stage(filter_near_site(filter_known_refs(alignments, used), windows_of(own)), "near")


def covered_tiles(windows: DataFrame) -> DataFrame:
    """The union of each node's windows: w_node, w_tile, ``spans``, disjoint in order, one row per tile."""
    tile = lambda c: F.floor(F.col(c) / TILE)
    each = windows.select("node_id", "win_start", "win_end", F.explode(F.sequence(tile("win_start"), tile("win_end"))).alias("w_tile"))
    clipped = F.struct(F.greatest(F.col("win_start"), F.col("w_tile") * TILE).alias("a"), F.least(F.col("win_end"), F.col("w_tile") * TILE + TILE - 1).alias("b"))
    # equal clippings, above all whole tiles, meet before the shuffle
    spans = each.groupBy(F.col("node_id").alias("w_node"), "w_tile").agg(F.sort_array(F.collect_set(clipped)).alias("s"))
    last = lambda done: F.element_at(done, -1)
    merged = F.aggregate(
        F.slice("s", F.lit(2), F.size("s")),
        F.slice("s", F.lit(1), F.lit(1)),
        lambda done, x: F.when(x["a"] <= last(done)["b"] + 1, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(last(done)["a"].alias("a"), F.greatest(last(done)["b"], x["b"]).alias("b"))))).otherwise(F.concat(done, F.array(x))),
    )
    return spans.select("w_node", "w_tile", merged.alias("spans"))


def filter_near_site(alignments: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows whose position lies in a window of their node.

    A range semi-join by tiles: a position meets the one row of its node and
    tile, which has the union of the windows there.  The tiles are written, so
    that Spark knows their size and sends few of them to the alignments.
    """
    tiles = stage(covered_tiles(windows), "tiles")
    pos = F.col("pos")
    inside = (F.col("node_id") == F.col("w_node")) & (F.floor(pos / TILE) == F.col("w_tile")) & F.exists("spans", lambda x: (pos >= x["a"]) & (pos <= x["b"]))
    return alignments.join(tiles, inside, "left_semi")


def pair_mates(qualified: DataFrame) -> DataFrame:
    """At most one pair per read name: its first row and the first later one that mirrors it.

    The first row per name comes from an aggregation that combines before the
    shuffle, so a name that very many rows share does not meet in one task.
    """
    rows = qualified.select("read_name", "aln_id", "ref_id", "pos", "next_ref_id", "next_pos", "node_id", "next_node_id")
    first = rows.groupBy("read_name").agg(F.min(F.struct("aln_id", "ref_id", "pos", "next_ref_id", "next_pos", "node_id")).alias("f"))
    f = lambda c: F.col(f"f.{c}")
    mirrored = (F.col("aln_id") > f("aln_id")) & (F.col("next_ref_id") == f("ref_id")) & (F.col("ref_id") == f("next_ref_id")) & (F.col("next_pos") == f("pos")) & (F.col("pos") == f("next_pos"))
    later = rows.join(first, "read_name").where(mirrored)
    second = later.groupBy("read_name").agg(F.min(F.struct("aln_id", "node_id")).alias("r"), F.first("f").alias("f"))
    return second.select("read_name", f("aln_id").alias("aln_id_a"), F.col("r.aln_id").alias("aln_id_b"), f("node_id").alias("node_a"), F.col("r.node_id").alias("node_b"))


def count_edges(pairs: DataFrame) -> DataFrame:
    """Contacts per unordered pair of nodes; a node with itself counts as well."""
    return pairs.groupBy(F.least("node_a", "node_b").alias("src"), F.greatest("node_a", "node_b").alias("dst")).agg(F.count(F.lit(1)).alias("contacts"))


def reduced_alignments(alignments: DataFrame, pairs: DataFrame) -> DataFrame:
    """All columns of the rows that are part of a pair; of the alignments those that were paired are enough."""
    ids = pairs.select(F.explode(F.array("aln_id_a", "aln_id_b")).alias("aln_id"))
    return alignments.join(ids, "aln_id", "left_semi")


def filter_summary(alignments: DataFrame, reduced: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row: total and kept alignments, and the number of nodes."""
    part = lambda df, k: df.agg(*[(F.count(F.lit(1)) if n == k else F.lit(0).cast("bigint")).alias(n) for n in ("total_rows", "kept_rows", "n_nodes")])
    each = part(alignments, "total_rows").unionByName(part(reduced, "kept_rows")).unionByName(part(nodes, "n_nodes"))
    return each.agg(*[F.sum(c).alias(c) for c in ("total_rows", "kept_rows", "n_nodes")])
