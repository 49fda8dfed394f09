"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, most: int, learn: str = "true") -> DataFrame:
    """doc_id, text, target of at most `most` labelled documents, chosen by a hash of doc_id: one row a doc_id.

    `learn` is SQL over doc_id that says which labels may be seen. Labels with a null id or target are not used; of
    several labels of a document the greatest counts, of several texts the one with the least hash (a null text counts as empty).
    The chosen labels are at most `most` rows of two numbers, so they are broadcast to the scan of the texts; only the
    texts chosen are shuffled, to leave one of each document.
    """
    chosen = labels.where(f"doc_id is not null and {target} is not null and ({learn})").groupBy("doc_id").agg(F.max(target).cast("int").alias("target"))
    chosen = chosen.orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(most)
    found = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "target").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("doc_id", "text", "target")
