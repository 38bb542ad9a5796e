"""The queries of this subpackage: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contactloom.llm.packing import pack, token_pieces

    return pack(token_pieces(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json")))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contactloom.llm.sentencepiece_codec import sentencepiece_round_trip

    out = sentencepiece_round_trip(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return out.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contactloom.llm.quality_rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contactloom.llm.exact_dedup import exact_dedup

    docs = table(spark, sf_dir, "documents").withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    return exact_dedup(docs, carry=("text_sha256",))


def op5_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contactloom.llm.chat_windows import chat_windows, read_loss, read_turns

    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(says).alias("text"))
    out = chat_windows(turns.unionByName(more))
    turns = F.slice(read_turns(F.col("formatted")), F.col("n_repeated") + 1, F.size(read_turns(F.col("formatted"))))
    read = out.select("conv_id", F.struct("window_start", turns.alias("turns"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).alias("w"), F.length("formatted").cast("bigint").alias("chars"))
    per = read.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("w"), F.sum("chars").alias("formatted_chars"))
    per = per.select("conv_id", F.flatten(F.transform("w", lambda x: x["turns"])).alias("turns"), F.array_join(F.flatten(F.transform("w", lambda x: x["loss"])), "").alias("loss"), "formatted_chars")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return per.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contactloom.llm.licences import licence_notices

    out = licence_notices(table(spark, sf_dir, "documents"))
    part = lambda f: F.transform("matches", f)
    return out.select(
        "doc_id",
        F.size(F.array_distinct(part(lambda m: m["line"]))).cast("bigint").alias("n_licence_lines"),
        F.array_join(F.array_sort(F.array_distinct(part(lambda m: m["licence"]))), ",").alias("licences"),
        F.coalesce(F.array_max(part(lambda m: m["permille"])), F.lit(0)).cast("bigint").alias("best_permille"),
        F.array_join(F.array_distinct(part(lambda m: m["line"].cast("string"))), ",").alias("lines"),
    )


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contactloom.llm.quality_classifier import classify_quality

    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contactloom.llm.pii import personal_data

    out = personal_data(table(spark, sf_dir, "documents"))
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    number = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    counts = [number(kind) for kind in ("email", "ip", "card", "phone")]
    return out.select("doc_id", *counts, F.sha2(listed("base_spans"), 256).alias("base_sha256"), listed("spans").alias("spans"), F.size("spans").cast("bigint").alias("n_spans"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contactloom.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contactloom.llm.repeats import remove_repeats

    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"), "n_shared")


def op11_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contactloom.llm.mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contactloom.llm.hard_negatives import mine_negatives

    return mine_negatives(table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contactloom.llm.merkle import leaf_of, manifest

    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    # the sum is a decimal, so the largest value has one too
    found = leaf_of(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars").cast("decimal(20,0)") + 1, F.col("text"))
    out = manifest(table(spark, sf_dir, "documents"), F.when(changed, found))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", F.size("steps").cast("bigint").alias("n_steps"), "folded_root", "verified")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_best_fit_packing": op1_best_fit_packing,
        "op2_sentencepiece": op2_sentencepiece,
        "op3_quality_rules": op3_quality_rules,
        "op4_exact_dedup": op4_exact_dedup,
        "op5_chat_windows": op5_chat_windows,
        "op6_licence_scan": op6_licence_scan,
        "op7_minhash_near_dedup": op7_minhash_near_dedup,
        "op8_suffix_array_dedup": op8_suffix_array_dedup,
        "op9_quality_classifier": op9_quality_classifier,
        "op10_personal_data": op10_personal_data,
        "op11_mix_sources": op11_mix_sources,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


def oracle_sql() -> dict[str, str]:
    from contactloom.llm.sql import oracle_sql

    return oracle_sql()
