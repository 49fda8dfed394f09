"""The corpus pipeline: documents in, packed training sequences out, each stage on all its predecessor kept.

Every stage but the last returns the columns of documents; `run` applies them in order to the documents of a folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import decontaminate, near_dedup, packing, quality, secrets
from pairloom.llm.queries import table, tokenizer_path


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs but the rows whose doc_id stands in gone; rows with a null doc_id stay."""
    return docs.join(gone.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose probability of reaching the first good grade is under one half."""
    model = quality.fit(docs, quality.graded(table(spark, sf_dir, "labels")))
    return quality.keep_good(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies (five-word shingles, similarity 0.8)."""
    return near_dedup.keep_one(docs, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item."""
    return _without(docs, decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; n_chars follows the text, all other columns stay."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    new = secrets.redact(secrets.scan(docs, keep=tuple(rest)))
    if "n_chars" in rest:
        new = new.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return new.select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens, with their ids."""
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]
#: SQL cannot express the classifier, the latent search and the tokens: the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(lambda docs, stage: stage[1](spark, docs, sf_dir), STAGES, table(spark, sf_dir, "documents"))
