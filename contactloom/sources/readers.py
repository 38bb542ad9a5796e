"""Readers of line formats: SAM, node counts, layout coordinates; FASTA, BAM and edge records have modules of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contactloom.sources.bam import read_bam
from contactloom.sources.edges import read_edges
from contactloom.sources.fasta import read_chunks, read_fasta

__all__ = ["read_bam", "read_chunks", "read_coords", "read_edges", "read_fasta", "read_nodes", "read_sam"]


def _located(rows: DataFrame) -> DataFrame:
    """Where a text row lies: file and block, and its place in the partition."""
    return rows.select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_no"))


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """Number rows in the order of files, blocks and lines; only one row per block is moved.

    A block's rows are consecutive within a partition, also after filters, as
    their places are taken last.
    """
    placed = rows.withColumn("_at", F.monotonically_increasing_id())
    before = Window.orderBy("_file1", "_block1").rowsBetween(Window.unboundedPreceding, -1)
    blocks = placed.groupBy(F.col("_file").alias("_file1"), F.col("_block").alias("_block1")).agg(F.min("_at").alias("_least"), F.count(F.lit(1)).alias("_n"))
    blocks = blocks.select("_file1", "_block1", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_least")).alias("_shift"))
    joined = placed.join(blocks, (F.col("_file") == F.col("_file1")) & (F.col("_block") == F.col("_block1")))
    return joined.withColumn(name, F.col("_at") + F.col("_shift"))


def read_sam(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """References and alignments of SAM text; positions from 0, absent ones -1."""
    rows = _located(spark.read.text(path))
    tags = F.split("value", "\t")
    tag = lambda key: F.get(F.transform(F.filter(tags, lambda x: x.startswith(key)), lambda x: F.substring(x, 4, 1 << 30)), F.lit(0))
    header = rows.where(F.col("value").startswith("@SQ\t")).select("_file", "_block", tag("SN:").alias("ref_name"), tag("LN:").cast("bigint").alias("ref_length"))
    references = _numbered(header, "ref_id").select(F.col("ref_id").cast("int").alias("ref_id"), "ref_name", "ref_length")
    at = lambda k: F.get(tags, F.lit(k))
    body = rows.where(~F.col("value").startswith("@") & (F.col("value") != ""))
    fields = body.select(
        at(0).alias("read_name"), at(1).cast("int").alias("flag"), at(2).alias("_ref"), (at(3).cast("bigint") - 1).alias("pos"), at(4).cast("int").alias("mapq"),
        F.when(at(6) == "=", at(2)).otherwise(at(6)).alias("_next"), (at(7).cast("bigint") - 1).alias("next_pos"), at(8).cast("int").alias("tlen"), at(5).alias("cigar"), at(9).alias("seq"), at(10).alias("qual"),
    )
    own, mate = (references.select(F.col("ref_name").alias(n), F.col("ref_id").alias(i)) for n, i in (("_ref", "ref_id"), ("_next", "next_ref_id")))
    joined = fields.join(own, "_ref", "left").join(mate, "_next", "left")
    absent = lambda c: F.coalesce(c, F.lit(-1)).alias(c)
    return references, joined.select("read_name", "flag", absent("ref_id"), "pos", "mapq", absent("next_ref_id"), "next_pos", "tlen", "cigar", "seq", "qual")


# -------------------------------------------------------------- small formats
def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The node table back from its text: a count line, then name, sites and length."""
    rows = _located(spark.read.text(path))
    parts = F.split("value", "\t")
    body = rows.where(F.size(parts) == 3)
    return _numbered(body, "node_id").select("node_id", F.get(parts, F.lit(0)).alias("name"), F.get(parts, F.lit(1)).cast("bigint").alias("site_count"), F.get(parts, F.lit(2)).cast("bigint").alias("length"))


def read_coords(spark: SparkSession, path: str) -> DataFrame:
    """Layout coordinates: id (from 1), x, y with a header row."""
    rows = spark.read.csv(path, sep="\t", header=True, schema="id bigint, x double, y double")
    return rows.select((F.col("id") - 1).alias("node_id"), "x", "y")
