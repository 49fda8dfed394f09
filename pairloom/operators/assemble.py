"""Assembly of labelled sources: unions with provenance, conflicts, ordered drop reasons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_labels(sources: dict[str, DataFrame]) -> DataFrame:
    """target, partner, sources: edges of all sources, each with the sorted, comma-joined labels of those that have it."""
    parts = [df.select("target", "partner", F.lit(label).alias("label")) for label, df in sources.items()]
    return reduce(DataFrame.unionByName, parts).groupBy("target", "partner").agg(F.array_join(F.sort_array(F.collect_set("label")), ",").alias("sources"))


def _keyed(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(F.least(a, b).alias("_lo"), F.greatest(a, b).alias("_hi")).distinct()


def without_conflicts(negatives: DataFrame, positives: DataFrame, a: str = "target", b: str = "partner") -> DataFrame:
    """Negative edges whose unordered pair is no positive one."""
    keyed = negatives.withColumns({"_lo": F.least(a, b), "_hi": F.greatest(a, b)})
    return keyed.join(_keyed(positives, a, b), ["_lo", "_hi"], "left_anti").drop("_lo", "_hi")


def assemble(positives: dict[str, DataFrame], negatives: DataFrame) -> DataFrame:
    """target, partner, type, sources: positives of all sources and the negatives that contradict none; no self pairs."""
    pos = union_labels(positives)
    neg = without_conflicts(negatives.select("target", "partner").distinct(), pos)
    both = pos.withColumn("type", F.lit("positive")).unionByName(neg.withColumns({"type": F.lit("negative"), "sources": F.lit("")}))
    return both.where("target <> partner").select("target", "partner", "type", "sources")


def assemble_flags(rows: DataFrame, positives: dict[str, str], negative: str, a: str = "acc_a", b: str = "acc_b") -> DataFrame:
    """As `assemble`, from one table of which each source is a condition (SQL): one scan and one aggregation of the unordered pairs."""
    flags = [F.bool_or(F.expr(condition)).alias(f"_{label}") for label, condition in positives.items()]
    pairs = rows.where(f"{a} <> {b}").groupBy(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).agg(*flags, F.bool_or(F.expr(negative)).alias("neg"))
    sources = F.concat_ws(",", *(F.when(F.col(f"_{label}"), label) for label in sorted(positives)))
    typed = pairs.select("lo", "hi", sources.alias("sources"), F.when(sources != "", "positive").when(F.col("neg"), "negative").alias("type")).where("type is not null")
    ends = F.explode(F.array(F.struct(F.col("lo").alias("target"), F.col("hi").alias("partner")), F.struct(F.col("hi").alias("target"), F.col("lo").alias("partner"))))
    return typed.select(ends.alias("e"), "type", "sources").select("e.target", "e.partner", "type", "sources")


def kept(df: DataFrame, column: str = "drop_reason") -> DataFrame:
    """The rows without a drop reason."""
    return df.where(F.col(column) == "")


def membership(df: DataFrame, listed: DataFrame, flag: str, a: str = "acc_a", b: str = "acc_b") -> DataFrame:
    """Adds a boolean column: whether the exact two-column pair is listed."""
    keys = listed.select(F.col(a), F.col(b), F.lit(True).alias(flag)).distinct()
    return df.join(keys, [a, b], "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def first_reason(df: DataFrame, reasons: dict[str, str], column: str = "drop_reason") -> DataFrame:
    """Adds the first reason (in the mapping's order) whose SQL condition is true, or an empty string; rows stay."""
    out = None
    for reason, condition in reasons.items():
        test = F.expr(condition)
        out = F.when(test, reason) if out is None else out.when(test, reason)
    return df.withColumn(column, out.otherwise("") if out is not None else F.lit(""))


def removed_counts(before: DataFrame, after: DataFrame, by: list[str]) -> DataFrame:
    """Rows before, after and removed, for each value of `by`."""
    counts = before.groupBy(*by).agg(F.count("*").alias("n_before")).join(after.groupBy(*by).agg(F.count("*").alias("n_after")), by, "left")
    return counts.select(*by, "n_before", F.coalesce("n_after", F.lit(0).cast("long")).alias("n_after"), (F.col("n_before") - F.coalesce("n_after", F.lit(0))).alias("n_removed"))
