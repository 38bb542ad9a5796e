"""The three jobs end to end, from files to files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.functions.text import resolve_motif
from contactloom.operators import contact_map as cm
from contactloom.operators import graph, mismatch, pairs, sites, split
from contactloom.session import drop_stages, staged_so_far
from contactloom.sources import sinks
from contactloom.sources.readers import read_bam, read_chunks, read_edges, read_nodes, read_sam


def read_alignments(spark: SparkSession, path: str, columns: tuple[str, ...] | None = None) -> tuple[DataFrame, DataFrame]:
    return read_bam(spark, path, columns) if path.endswith(".bam") else read_sam(spark, path)


def run_filter(spark: SparkSession, fasta: str, alignments: str, enzyme: str, out: str, min_mapq: int = 40, flank: int = 500) -> None:
    """Write ``nodes`` (text), ``edges`` and ``reduced`` (Parquet) under ``out``."""
    earlier = staged_so_far(spark)
    motif = resolve_motif(enzyme)
    found = sites.find_sites_in_chunks(*read_chunks(spark, fasta, keep_empty=False), motif)
    nodes = sites.count_sites(found)
    sinks.write_nodes(nodes, f"{out}/nodes")
    references, rows = read_alignments(spark, alignments)
    # each later step reads this table, whose row numbers are fixed once written
    sinks.write_table(pairs.coordinate_sort(pairs.drop_secondary(rows)), f"{out}/sorted", order_by=["aln_id"])
    rows = spark.read.parquet(f"{out}/sorted")
    near = pairs.near_sites(pairs.filter_mapq(rows, min_mapq), pairs.map_refs_to_nodes(references, nodes), nodes, lambda own: sites.site_windows(found, own, len(motif), flank))
    sinks.write_table(pairs.pair_mates(near), f"{out}/pairs")
    mates = spark.read.parquet(f"{out}/pairs")
    sinks.write_table(pairs.count_edges(mates), f"{out}/edges")
    sinks.write_table(pairs.reduced_alignments(near.select(*rows.columns), mates), f"{out}/reduced", order_by=["aln_id"])
    drop_stages(spark, earlier)


def run_correct(spark: SparkSession, fasta: str, alignments: str, out: str, percent: float = 0.95, sensitive: float = 0.5, min_mapq: int = 1, wide: int = 25000, narrow: int = 1000, depletion: int = 100000) -> None:
    """Write ``mismatches`` (Parquet) and ``corrected`` (FASTA) under ``out``."""
    if wide < 2 * narrow or depletion < 2 * wide:
        raise ValueError("wide >= 2 * narrow and depletion >= 2 * wide are needed")
    earlier = staged_so_far(spark)
    references, rows = read_alignments(spark, alignments, ("flag", "ref_id", "pos", "mapq", "next_ref_id", "next_pos"))
    contacts = cm.intra_contacts(pairs.drop_secondary(rows), min_mapq)
    sinks.write_table(cm.bin_contacts(contacts, narrow), f"{out}/map")
    fine = spark.read.parquet(f"{out}/map")
    # the wide map is a sum of the fine one where bins nest
    if wide % narrow == 0:
        coarse = cm.widened(fine, wide)
    else:
        coarse = cm.bin_contacts(contacts, wide)
    level = cm.saturation_level(coarse, percent)
    track = cm.score_track(coarse, level, wide, depletion)
    islands = mismatch.wide_mismatches(track, cm.threshold_e5(level, wide, depletion, sensitive), wide)
    narrow_track = cm.score_track(fine, cm.saturation_level(fine, percent), narrow, wide)
    named = mismatch.narrow_mismatches(islands, narrow_track, narrow).join(references.select("ref_id", F.col("ref_name").alias("name")), "ref_id")
    sinks.write_table(named, f"{out}/mismatches")
    sinks.write_chunks(split.split_chunks(*read_chunks(spark, fasta), spark.read.parquet(f"{out}/mismatches")), f"{out}/corrected")
    drop_stages(spark, earlier)


def run_partition(spark: SparkSession, nodes: str, edges: str, groups: int, out: str, change_per_node: float = 2.0, seed: int = 806, max_iter: int = 1000) -> None:
    """Write ``graph`` (Pajek), ``coords`` and ``members`` (Parquet) and ``groups`` (text) under ``out``."""
    earlier = staged_so_far(spark)
    table = read_nodes(spark, nodes)
    links = read_edges(spark, edges) if edges.endswith(".edge") else spark.read.parquet(edges)
    weighted = graph.weight_edges(links, table)
    sinks.write_pajek(table, weighted, f"{out}/graph")
    sinks.write_table(graph.force_layout(table, weighted, seed, change_per_node, max_iter), f"{out}/coords")
    members, centers = graph.kmeans_groups(spark.read.parquet(f"{out}/coords"), groups, seed)
    sinks.write_table(members, f"{out}/members")
    sinks.write_table(centers, f"{out}/centers")
    sinks.write_groups(graph.group_contents(members, table), f"{out}/groups")
    drop_stages(spark, earlier)
