"""Run logs: last record wins, merges of runs, conservative verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last record of each key in the order given (which must be total)."""
    rest = [c for c in log.columns if c not in keys]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, "r.*")


def first(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in log.columns if c not in keys]
    return log.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, "r.*")


def failed(log: DataFrame, keys: list[str], order: list[str], ok: Column) -> DataFrame:
    """Keys whose last record did not succeed."""
    return latest(log.withColumn("_ok", ok), keys, order).where(~F.col("_ok")).select(*keys)


def merge_runs(log: DataFrame, keys: list[str], order: list[str], ok: Column) -> DataFrame:
    """The last record of each key, but no later error displaces an earlier success."""
    return latest(log.withColumn("_ok", ok), keys, ["_ok", *order]).drop("_ok")


def union_runs(rows: DataFrame) -> DataFrame:
    """custom_id, norm_a <= norm_b, name_a, excerpts, seen_in, one confidence per run: full outer union of runs by key.

    rows: run, ordinal, custom_id, norm_a, norm_b, name_a, name_b, excerpts (array), confidence. Rows with an empty side go.
    """
    swap = F.col("norm_a") > F.col("norm_b")
    sides = {f"{k}_{x}": F.when(swap, F.col(f"{k}_{y}")).otherwise(F.col(f"{k}_{x}")) for k in ("norm", "name") for x, y in (("a", "b"), ("b", "a"))}
    rows = rows.where("norm_a <> '' and norm_b <> ''").withColumns(sides)
    key = ["custom_id", "norm_a", "norm_b"]
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "excerpts"))), lambda x: x["excerpts"])
    return rows.groupBy(*key).agg(
        F.min_by("name_a", "ordinal").alias("name_a"), F.min_by("name_b", "ordinal").alias("name_b"), F.array_distinct(F.flatten(ordered)).alias("excerpts"),
        F.array_join(F.sort_array(F.collect_set("run")), "+").alias("seen_in"), F.map_from_entries(F.collect_set(F.struct("run", "confidence"))).alias("confidence"),
    )


def usable() -> Column:
    """The gate of a verdict: grounded, mapped rightly, no interaction, full-length pair."""
    return F.expr("grounded and mapping = 'correct' and relationship = 'non_interaction' and qualifier = 'full_length_pair'")


def dedup_verdicts(rows: DataFrame, keys: list[str], gate: str, order: list[str]) -> DataFrame:
    """One verdict a key: the first, unless it is usable and a later one is not; then that one. n_dropped counts the rest."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(gate, *order)).alias("r"), (F.count("*") - 1).alias("n_dropped")).select(*keys, "r.*", "n_dropped")


def collect_usable(rows: DataFrame) -> DataFrame:
    """pair, n_for, n_against, papers: papers that judge a pair usable or not."""
    return rows.groupBy("pair").agg(
        F.count_distinct(F.when(F.col("usable"), F.col("paper"))).alias("n_for"), F.count_distinct(F.when(~F.col("usable"), F.col("paper"))).alias("n_against"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("usable"), F.col("paper")))), ",").alias("papers"),
    ).where("n_for > 0")
