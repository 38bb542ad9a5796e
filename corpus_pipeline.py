"""A training corpus from raw documents: judge, remove copies, redact, pack.

Every stage keeps the columns of its input whatever they are called: a row
travels as one struct beside a key of its id and text, so no helper column can
meet one of the table's.  Rows are told apart by id and a hash of the text;
null ids and ids that several texts share are no special case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.exact_dedup import exact_dedup
from contactloom.llm.near_dedup import near_duplicates
from contactloom.llm.packing import pack, token_pieces
from contactloom.llm.pii import personal_data, redacted
from contactloom.llm.quality_classifier import classify_quality
from contactloom.llm.queries import tokenizer_path
from contactloom.llm.tables import col, stage
from contactloom.session import drop_stages, ship_package, staged_so_far


def _keyed(docs: DataFrame, *more: str) -> DataFrame:
    """``d``, the whole row; ``i``, its id; ``h``, 128 bits of its text's hash; and ``more`` columns that a stage reads."""
    row = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("d"))
    return row.select("d", F.col("d.doc_id").alias("i"), F.md5(F.coalesce("d.text", F.lit("")).cast("binary")).alias("h"), *[F.col(f"d.{c}").alias(c) for c in more])


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["i"].eqNullSafe(b["i"]) & (a["h"] == b["h"])


def _staying(rows: DataFrame, kept: DataFrame, once: bool = False) -> DataFrame:
    """The rows whose (i, h) is in ``kept``; with ``once`` one of those that repeat both."""
    kept = kept.select("i", "h").distinct()
    out = rows.select("d", "i", "h").join(kept, _same(rows, kept), "left_semi")
    if once:
        counts = rows.groupBy("i", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if counts.limit(1).count():
            counts = counts.select("i", "h")
            single, many = out.join(counts, _same(out, counts), "left_anti"), out.join(counts, _same(out, counts), "left_semi")
            out = single.unionByName(many.groupBy("i", "h").agg(F.first("d").alias("d")))
    return out.select("d.*")


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps; rows with the same id and text share a verdict.

    Null texts are judged as empty, null ids as rows of their own; without
    usable labels everything stays; an empty table stays empty.  Texts may have
    any length, and other columns any name.
    """
    ship_package(spark)
    rows = _keyed(docs, "text", "source", "lang")
    verdict = classify_quality(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"), id_col="i", carry=("h",))
    return _staying(rows, verdict.where("kept"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id, null ids last; of rows that repeat id and text one.

    A null text equals an empty one; an empty table stays empty.  Texts may have
    any length, and other columns any name.
    """
    ship_package(spark)
    rows = _keyed(docs, "text")
    return _staying(rows, exact_dedup(rows, "i", carry=("h",)).where("kept"), once=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the row with the least id, null ids last; of rows that repeat id and text one.

    Rows are numbered, so that a group is found by its rows, whatever their
    ids; texts without words, null ones too, are in no group and stay.  An empty
    table stays empty, texts may have any length, and other columns any name.
    """
    ship_package(spark)
    numbered = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("d")).withColumn("r", F.monotonically_increasing_id())
    rows = stage(numbered, "numbered")
    group = near_duplicates(rows.select("r", F.col("d.text").alias("text")), "r")
    named = group.where("n_shingles > 0").join(rows.select("r", F.col("d.doc_id").alias("i")), "r")
    best = named.groupBy("component_id").agg(F.min(F.struct(F.col("i").isNull().alias("none"), "i", "r")).alias("best")).select("best.r")
    stays = best.unionByName(group.where("n_shingles = 0").select("r"))
    return rows.join(stays, "r", "left_semi").select("d.*")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; ``n_chars`` follows where the text changed.

    Every row stays, repeated ones and those with null ids or texts too; a null
    text stays null, and an empty table empty.  Texts of any length are read
    whole; other columns may have any name.
    """
    ship_package(spark)
    out = personal_data(_keyed(docs, "text"), "i", carry=("d",))
    new = out.select("d", "spans", redacted(F.col("d.text"), F.col("spans")).alias("new"))
    changed = F.size("spans") > 0
    value = {"text": F.col("new"), "n_chars": F.when(changed, F.length("new").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("d.n_chars")) if "n_chars" in docs.columns else None}
    return new.select(*[value[c].alias(c) if c in value else F.col("d")[c].alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenize and pack every document: a row per piece, as operator 1 returns.

    Null and empty texts are the piece of the end id alone; null and repeated
    ids give pieces of their own; equal lengths are interchangeable, so ties
    need no rule; an empty table packs into nothing.  A text of any length is cut
    into pieces; other columns may have any name.
    """
    ship_package(spark)
    return pack(token_pieces(docs, tokenizer_path("word_bpe_49k.json")))


STAGES = [
    ("quality classifier", judge_quality),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("personal data", redact),
    ("packing", pack_sequences),
]

#: A trained tagger and a tokenizer have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; what a stage has left behind goes when its result is written."""
    docs, earlier = spark.read.parquet(f"{sf_dir}/documents.parquet"), staged_so_far(spark)
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, name.replace(" ", "-"))
            drop_stages(spark, earlier, keep=1)
    return docs
