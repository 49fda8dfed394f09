"""Counts and distributions that reports print."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    """column, n, share of all rows; the total is one row that is sent to the counts."""
    counts = rows.groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total)).select(column, "n", (F.col("n") / F.col("total")).alias("share"))


def medians(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """by, n_pairs, median_length: rows and the exact median of a value of each group."""
    return rows.groupBy(*by).agg(F.count("*").alias("n_pairs"), F.percentile(value, 0.5).alias("median_length"))


def exact_copies(rows: DataFrame, key: str, text: str) -> DataFrame:
    """key (the least), n, members (sorted): texts that stand in several rows; equal texts meet by their sha256."""
    groups = rows.where(F.col(text).isNotNull()).groupBy(F.sha2(text, 256).alias("_h")).agg(F.min(key).alias(key), F.count("*").alias("n"), F.sort_array(F.collect_list(key)).alias("members"))
    return groups.where("n > 1").drop("_h")


def window_of(time: Column | str, months: int = 3) -> Column:
    """(first, last): the inclusive calendar window of `months` months, aligned to the year, that a time lies in."""
    month = F.trunc(F.col(time) if isinstance(time, str) else time, "month")
    first = F.add_months(month, -F.pmod(F.month(month) - 1, F.lit(months)))
    return F.struct(first.alias("first"), F.date_sub(F.add_months(first, months), 1).alias("last"))


def windows(start: str, end: str, months: int = 12) -> Column:
    """All inclusive windows from start to end (dates), aligned to the year; the outer ones are cut to the dates."""
    low, high = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    firsts = F.sequence(window_of(low, months)["first"], high, F.make_ym_interval(F.lit(0), F.lit(months)))
    return F.transform(firsts, lambda x: F.struct(F.greatest(x, low).alias("first"), F.least(F.date_sub(F.add_months(x, months), 1), high).alias("last")))
