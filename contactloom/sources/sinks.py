"""Writers: FASTA, node counts, Pajek graphs, group tables, Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom.functions.text import fixed_15
from contactloom.operators.ordinals import dense_ordinal


def write_fasta(pieces: DataFrame, path: str, name_col: str = "piece_name") -> None:
    """A record per row, sorted by contig name and piece, over as many files as needed."""
    lines = pieces.select("name", "piece_ord", F.concat(F.lit(">"), F.col(name_col), F.lit("\n"), F.col("seq")).alias("value"))
    lines.orderBy("name", "piece_ord").select("value").write.text(path)


def write_chunks(parts: DataFrame, path: str) -> None:
    """Records whose sequence is in rows (name, piece_ord, piece_name, at, seq), a line for each row.

    A record lies in one file; a task writes it row by row.
    """
    rows = parts.repartitionByRange("name", "piece_ord").sortWithinPartitions("name", "piece_ord", "at")
    head = F.when(F.col("at") == 0, F.concat(F.lit(">"), "piece_name", F.lit("\n"))).otherwise("")
    rows.select(F.concat(head, F.col("seq")).alias("value")).write.text(path)


def node_lines(nodes: DataFrame) -> DataFrame:
    head = nodes.agg(F.count(F.lit(1)).cast("string").alias("value")).select(F.lit(0).alias("section"), F.lit(0).cast("bigint").alias("ord"), "value")
    rows = nodes.select(F.lit(1).alias("section"), F.col("node_id").alias("ord"), F.concat_ws("\t", "name", F.col("site_count").cast("string"), F.col("length").cast("string")).alias("value"))
    return head.unionByName(rows)


def write_nodes(nodes: DataFrame, path: str) -> None:
    """The count of nodes, then a line per node in node order."""
    node_lines(nodes).orderBy("section", "ord").select("value").write.text(path)


def pajek_lines(nodes: DataFrame, weighted_edges: DataFrame) -> DataFrame:
    """Lines of a graph file: vertices from 1, then arcs from the larger to the smaller id."""
    one = lambda section, value: nodes.sparkSession.range(1).select(F.lit(section).alias("section"), F.lit(0).cast("bigint").alias("ord"), F.lit(value).alias("value"))
    head = nodes.agg(F.concat(F.lit("*Vertices "), F.count(F.lit(1)).cast("string")).alias("value")).select(F.lit(0).alias("section"), F.lit(0).cast("bigint").alias("ord"), "value")
    vertices = nodes.select(F.lit(1).alias("section"), F.col("node_id").alias("ord"), F.format_string('%d "%s"', F.col("node_id") + 1, F.col("name")).alias("value"))
    arcs = dense_ordinal(weighted_edges, "ord", [F.col("src"), F.col("dst")])
    arcs = arcs.select(F.lit(3).alias("section"), "ord", F.concat_ws(" ", (F.col("dst") + 1).cast("string"), (F.col("src") + 1).cast("string"), fixed_15(F.col("weight"))).alias("value"))
    return head.unionByName(vertices).unionByName(one(2, "*arcs")).unionByName(arcs)


def write_pajek(nodes: DataFrame, weighted_edges: DataFrame, path: str) -> None:
    pajek_lines(nodes, weighted_edges).orderBy("section", "ord").select("value").write.text(path)


def write_groups(contents: DataFrame, path: str) -> None:
    """A folder per group, named by the number of groups and the group's from 1."""
    k = contents.select("group_id").distinct().agg(F.count(F.lit(1)).alias("k"))
    rows = contents.join(F.broadcast(k)).select(F.format_string("%dg%d", "k", F.col("group_id") + 1).alias("group_label"), F.col("name").alias("#Contig"), F.col("site_count").alias("RECounts"), F.col("length").alias("Length"))
    rows.write.partitionBy("group_label").option("header", True).option("sep", "\t").option("comment", "\u0001").csv(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, order_by: list[str] | None = None) -> None:
    """Parquet; ordered tables are range-partitioned, so files follow each other."""
    if order_by:
        df = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
