"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, hamming, katz, near_dedup, packing, pii, quality, secrets, suffix_dedup, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.scan(table(spark, sf_dir, "documents")))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.select(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), hamming.sign_code("embedding").alias("code"))
    return hamming.top_k(codes, codes.where("id % 50 = 0"))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_packing": op2_packing,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_quality": op4_quality,
    "op5_hamming_top_k": op5_hamming_top_k,
    "op6_toxicity": op6_toxicity,
    "op7_secret_scan": op7_secret_scan,
    "op8_near_dedup": op8_near_dedup,
    "op9_katz": op9_katz,
    "op10_personal_data": op10_personal_data,
}
ORACLE_SQL: dict[str, str] = {
    "op3_suffix_dedup": suffix_dedup.ORACLE,
    "op5_hamming_top_k": hamming.ORACLE,
    "op7_secret_scan": secrets.oracle(),
    "op8_near_dedup": near_dedup.ORACLE,
}
