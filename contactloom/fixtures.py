"""Test tables seen as contigs, alignments, mates, sequences and coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.session import spread

#: Each text runs in Spark and in DuckDB over the views of the test tables.
CONTIGS = "select doc_id as contig_ord, concat('doc', doc_id) as name, text as seq, cast(length(text) as bigint) as length from documents"

ALIGNMENTS = """
select read_name, flag, ref_id, pos, mapq, next_ref_id, next_pos from (
  select read_name, flag, ra as ref_id, pa as pos, mapq, rb as next_ref_id, pb as next_pos, u from (
    select concat('r', l_orderkey * 8 + l_linenumber) as read_name, case when l_partkey % 13 = 0 then 256 else 0 end as flag, cast(l_quantity as int) as mapq,
           (l_partkey + l_suppkey) % 11 as u, cast(l_partkey % 50 as int) as ra, cast(round(l_extendedprice * 100) as bigint) % 2500 as pa,
           cast(case when (l_partkey + l_suppkey) % 11 = 1 then -1 when l_suppkey % 4 = 0 then l_partkey % 50 else l_suppkey % 50 end as int) as rb,
           case when (l_partkey + l_suppkey) % 11 = 1 then -1 else cast(floor(cast(round(l_extendedprice * 100) as bigint) / 7) as bigint) % 2500 end as pb
    from lineitem) forward
  union all
  select read_name, flag + 16 as flag, rb as ref_id, pb as pos, mapq, ra as next_ref_id, pa as next_pos, u from (
    select concat('r', l_orderkey * 8 + l_linenumber) as read_name, case when l_partkey % 13 = 0 then 256 else 0 end as flag, cast(l_quantity as int) as mapq,
           (l_partkey + l_suppkey) % 11 as u, cast(l_partkey % 50 as int) as ra, cast(round(l_extendedprice * 100) as bigint) % 2500 as pa,
           cast(case when (l_partkey + l_suppkey) % 11 = 1 then -1 when l_suppkey % 4 = 0 then l_partkey % 50 else l_suppkey % 50 end as int) as rb,
           case when (l_partkey + l_suppkey) % 11 = 1 then -1 else cast(floor(cast(round(l_extendedprice * 100) as bigint) / 7) as bigint) % 2500 end as pb
    from lineitem) backward where u <> 0) both_ways
"""

MATES = """
select ref_id, p as pos, mapq, ref_id as next_ref_id, p + dist as next_pos from (
  select cast(l_suppkey as int) as ref_id, cast(floor(cast(round(l_extendedprice * 100) as bigint) / 100) as bigint) as p, cast(l_quantity as int) as mapq,
         case when (l_partkey * l_partkey * 37 + l_orderkey * l_orderkey) % 100 < 60 then (l_partkey * l_partkey * 37 + l_orderkey * l_orderkey) % 100 * 40
              else ((l_partkey * l_partkey * 37 + l_orderkey * l_orderkey) % 100 - 50) * 200 end as dist from lineitem) forward
union all
select ref_id, p + dist as pos, mapq, ref_id as next_ref_id, p as next_pos from (
  select cast(l_suppkey as int) as ref_id, cast(floor(cast(round(l_extendedprice * 100) as bigint) / 100) as bigint) as p, cast(l_quantity as int) as mapq,
         case when (l_partkey * l_partkey * 37 + l_orderkey * l_orderkey) % 100 < 60 then (l_partkey * l_partkey * 37 + l_orderkey * l_orderkey) % 100 * 40
              else ((l_partkey * l_partkey * 37 + l_orderkey * l_orderkey) % 100 - 50) * 200 end as dist from lineitem) backward
"""

SEQUENCES = """
select ref_id, concat('ctg', ref_id) as name, substr(repeat('ACGATCTTGA', 12000), cast(1 + ref_id % 10 as int), cast(115000 + ref_id % 1000 as int)) as seq
from (select distinct cast(l_suppkey as int) as ref_id from lineitem) contig
"""


def _of(spark: SparkSession, text: str, table: str, rows: DataFrame) -> DataFrame:
    """Run an adapter's text with its table bound to these rows."""
    return spark.sql(" ".join(text.replace(f"from {table}", "from {t}").split()), t=rows)


def _view(spark: SparkSession, sf_dir: str, text: str, table: str) -> DataFrame:
    """Run an adapter's text with its table bound to this folder's file."""
    return _of(spark, text, table, spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, CONTIGS, "documents")


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every contig is a reference whose id is its number."""
    return contigs(spark, sf_dir).select(F.col("contig_ord").cast("int").alias("ref_id"), F.col("name").alias("ref_name"), F.col("length").alias("ref_length"))


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, ALIGNMENTS, "lineitem")


def mates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, MATES, "lineitem")


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids are few bytes and become long sequences, so Spark, which goes by the ids' size, would make all of them in a few tasks."""
    ids = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_suppkey").cast("int").alias("l_suppkey")).distinct()
    return _of(spark, SEQUENCES, "lineitem", spread(ids, "l_suppkey"))


def coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda k: F.element_at("embedding", k).cast("double")
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("node_id"), at(1).alias("x"), at(2).alias("y"))


def centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten groups: the mean place of the vectors whose ids end in the same digit."""
    c = coordinates(spark, sf_dir)
    mean = lambda k: (F.sum((F.col(k) * 1000000).cast("bigint")) / F.count(F.lit(1)) / 1000000.0).alias(k)
    return c.groupBy((F.col("node_id") % 10).cast("int").alias("group_id")).agg(mean("x"), mean("y"))
