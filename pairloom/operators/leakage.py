"""Leakage flags: three-valued, one relational plan instead of row-wise overlays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_flag(pairs: DataFrame, sources: DataFrame, dates: DataFrame, cutoff: str) -> DataFrame:
    """Adds date_leaked: null without a source, true if any source is undated or dated up to the cutoff, else false.

    sources: acc_a, acc_b, entry; dates: entry, release_date.
    """
    hit = F.col("release_date").isNull() | (F.col("release_date") <= F.lit(cutoff).cast("timestamp"))
    flags = sources.where("entry is not null").join(dates, "entry", "left").groupBy("acc_a", "acc_b").agg(F.bool_or(hit).alias("date_leaked"))
    return pairs.join(flags, ["acc_a", "acc_b"], "left")


def source_index(pairs: DataFrame) -> DataFrame:
    """acc_a, acc_b, entries: the sorted distinct entries of each pair."""
    return pairs.groupBy("acc_a", "acc_b").agg(F.sort_array(F.collect_set("entry")).alias("entries"))


def last_codes(pairs: DataFrame, ordinal: str) -> DataFrame:
    """acc_a, acc_b, entry: the codes of each pair's last row, split on commas."""
    last = pairs.groupBy("acc_a", "acc_b").agg(F.max_by("codes", ordinal).alias("codes"))
    return last.select("acc_a", "acc_b", F.explode(F.split("codes", ",")).alias("entry")).distinct()


def cluster_min_date(rows: DataFrame, cluster: str = "cluster", date: str = "release_date") -> DataFrame:
    """The earliest date of each cluster; null clusters and dates do not count."""
    return rows.where(F.col(cluster).isNotNull() & F.col(date).isNotNull()).groupBy(cluster).agg(F.min(date).alias("min_release_date"))


def cluster_flag(pairs: DataFrame, members: DataFrame, first_dates: DataFrame, cutoff: str, absent: bool | None) -> DataFrame:
    """Adds homolog_leaked: whether a cluster of the pair has a member dated up to the cutoff; `absent` where it has none."""
    hit = F.col("min_release_date") <= F.lit(cutoff).cast("timestamp")
    flags = members.select("acc_a", "acc_b", "cluster").distinct().join(first_dates, "cluster").groupBy("acc_a", "acc_b").agg(F.bool_or(hit).alias("homolog_leaked"))
    out = pairs.join(flags, ["acc_a", "acc_b"], "left")
    return out if absent is None else out.withColumn("homolog_leaked", F.coalesce("homolog_leaked", F.lit(absent)))


def any_true(*flags: str) -> Column:
    """True if any is true, else false if any is false, else null (not SQL's OR, where null beats false)."""
    cols = [F.col(f) for f in flags]
    true, false = F.coalesce(cols[0], F.lit(False)), F.coalesce(~cols[0], F.lit(False))
    for c in cols[1:]:
        true, false = true | F.coalesce(c, F.lit(False)), false | F.coalesce(~c, F.lit(False))
    return F.when(true, True).when(false, False)


def clean(kind: str = "type", date: str = "date_leaked", homolog: str = "homolog_leaked") -> Column:
    """Positives need both flags false; negatives a false date flag and a homolog flag that is not true."""
    positive = F.coalesce(~F.col(date), F.lit(False)) & F.coalesce(~F.col(homolog), F.lit(False))
    negative = F.coalesce(~F.col(date), F.lit(False)) & ~F.coalesce(F.col(homolog), F.lit(False))
    return F.when(F.col(kind) == "positive", positive).otherwise(negative)


def leaked(kind: str = "type", date: str = "date_leaked", homolog: str = "homolog_leaked") -> Column:
    """Either flag true for positives; for negatives the date flag true."""
    return F.when(F.col(kind) == "positive", F.coalesce(F.col(date), F.lit(False)) | F.coalesce(F.col(homolog), F.lit(False))).otherwise(F.coalesce(F.col(date), F.lit(False)))


def copresence(pairs: DataFrame, chains: DataFrame, dates: DataFrame | None = None, cutoff: str | None = None) -> DataFrame:
    """acc_a, acc_b, n_entries, first_entry: entries that hold both sides (up to the cutoff if dates are given)."""
    a, b = chains.select(F.col("acc").alias("acc_a"), "entry").distinct(), chains.select(F.col("acc").alias("acc_b"), "entry").distinct()
    both = pairs.select("acc_a", "acc_b").distinct().join(a, "acc_a").join(b, ["acc_b", "entry"])
    if dates is not None:
        both = both.join(dates.where(F.col("release_date") <= F.lit(cutoff).cast("timestamp")), "entry", "left_semi")
    return both.groupBy("acc_a", "acc_b").agg(F.count("*").alias("n_entries"), F.min("entry").alias("first_entry"))


def overlay(kind: str, date: str, verdict: str) -> Column:
    """A negative's date flag takes a co-presence verdict: null takes it, false rises to it, true stays."""
    return F.when((F.col(kind) == "negative") & F.col(verdict).isNotNull(), F.coalesce(F.col(date), F.lit(False)) | F.col(verdict)).otherwise(F.col(date))


def two_sided_homologs(pairs: DataFrame, index: DataFrame) -> DataFrame:
    """acc_a, acc_b, homolog_entry: pairs for which one entry holds homologs of both sides that are not one same accession.

    index: acc, entry, matches (array of matched accessions). The least such entry is returned.
    """
    a = index.select(F.col("acc").alias("acc_a"), "entry", F.col("matches").alias("ma"))
    b = index.select(F.col("acc").alias("acc_b"), "entry", F.col("matches").alias("mb"))
    both = pairs.select("acc_a", "acc_b").distinct().join(a, "acc_a").join(b, ["acc_b", "entry"])
    return both.where(F.size(F.array_union("ma", "mb")) > 1).groupBy("acc_a", "acc_b").agg(F.min("entry").alias("homolog_entry"))


def homolog_index(hits: DataFrame, chains: DataFrame, identity: float = 0.40, coverage: float = 0.5) -> DataFrame:
    """acc, entry, matches: entries reached by hits above the identity (strictly) and with both coverages."""
    good = hits.where((F.col("fident") > identity) & (F.col("qcov") >= coverage) & (F.col("tcov") >= coverage))
    return good.join(chains.withColumnRenamed("acc", "target"), "target").groupBy(F.col("query").alias("acc"), "entry").agg(F.sort_array(F.collect_set("target")).alias("matches"))


def uncovered(pairs: DataFrame, judged: DataFrame) -> DataFrame:
    """Pairs without a verdict: must be empty before flags are published."""
    return pairs.join(judged, ["acc_a", "acc_b"], "left_anti")
