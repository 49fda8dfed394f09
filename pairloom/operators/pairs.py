"""Pair tables: quality filters, canonical order, de-duplication, directed edges, degrees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import not_nan, pair_key


def quality_filter(df: DataFrame, equal: dict | None = None, at_most: dict | None = None, at_least: dict | None = None) -> DataFrame:
    """Rows that meet every bound; a null or NaN meets none."""
    for c, v in (equal or {}).items():
        df = df.where(F.col(c) == F.lit(v))
    for bounds, test in ((at_most, lambda c, v: c <= v), (at_least, lambda c, v: c >= v)):
        for c, v in (bounds or {}).items():
            kind = dict(df.dtypes)[c]
            df = df.where(test(not_nan(c) if kind in ("double", "float") else F.col(c), F.lit(v)))
    return df


def parse_pair_ids(df: DataFrame, c: str = "id") -> DataFrame:
    """acc_a and acc_b of ids like entry__chain_acc--entry__chain_acc; rows without both, or with UNDEFINED, go."""
    sides = F.split(c, "--", 2)
    side = lambda i: F.substring_index(F.try_element_at(sides, F.lit(i)), "_", -1)
    out = df.withColumn("acc_a", side(1)).withColumn("acc_b", side(2))
    bad = lambda x: F.col(x).isNull() | F.col(x).isin("", "UNDEFINED")
    return out.where(~bad("acc_a") & ~bad("acc_b"))


def canonical(df: DataFrame, a: str = "acc_a", b: str = "acc_b", carried: dict[str, str] | None = None) -> DataFrame:
    """a <= b in every row; the columns in `carried` (a-side name -> b-side name) change sides with them."""
    swap = F.col(a) > F.col(b)
    sides = {a: b, **(carried or {})}
    new = {x: F.when(swap, F.col(y)).otherwise(F.col(x)) for x, y in sides.items()} | {y: F.when(swap, F.col(x)).otherwise(F.col(y)) for x, y in sides.items()}
    return df.select(*(new[c].alias(c) if c in new else F.col(c) for c in df.columns))


def dedup(df: DataFrame, a: str = "acc_a", b: str = "acc_b") -> DataFrame:
    """Distinct unordered pairs without self pairs."""
    return df.where(F.col(a) != F.col(b)).select(F.least(a, b).alias(a), F.greatest(a, b).alias(b)).distinct()


def dedup_sources(df: DataFrame, source: str, a: str = "acc_a", b: str = "acc_b") -> DataFrame:
    """Distinct unordered pairs with the sorted set of their sources, joined by commas."""
    pairs = df.select(F.least(a, b).alias(a), F.greatest(a, b).alias(b), source)
    return pairs.groupBy(a, b).agg(F.array_join(F.sort_array(F.collect_set(source)), ",").alias("sources"))


def drop_listed(df: DataFrame, listed: list[str], a: str = "acc_a", b: str = "acc_b") -> DataFrame:
    return df.where(~(F.col(a).isin(listed) | F.col(b).isin(listed)))


def directed(df: DataFrame, a: str = "acc_a", b: str = "acc_b") -> DataFrame:
    """target, partner: both directions of every pair, distinct."""
    ends = F.explode(F.array(F.struct(F.col(a).alias("target"), F.col(b).alias("partner")), F.struct(F.col(b).alias("target"), F.col(a).alias("partner"))))
    return df.select(ends.alias("e")).select("e.target", "e.partner").distinct()


def degree(df: DataFrame, a: str = "acc_a", b: str = "acc_b") -> DataFrame:
    """acc, degree: rows in which each end occurs (a self pair counts twice)."""
    return df.select(F.explode(F.array(a, b)).alias("acc")).groupBy("acc").agg(F.count("*").alias("degree"))


def min_partners(edges: DataFrame, least: int) -> DataFrame:
    """The directed edges of targets with at least `least` distinct partners."""
    keep = edges.groupBy("target").agg(F.count_distinct("partner").alias("n")).where(F.col("n") >= least).select("target")
    return edges.join(keep, "target", "left_semi")


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each key in a total order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= k).drop("_n")


def with_key(df: DataFrame, a: str = "acc_a", b: str = "acc_b") -> DataFrame:
    return df.withColumn("pair", pair_key(a, b))


def repeated(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
