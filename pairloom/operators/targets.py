"""Target selection: partner counts, floors, views and metadata with preferred sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def partner_counts(edges: DataFrame) -> DataFrame:
    """target, n_pos, n_neg: distinct partners by type; positives count for both ends, negatives for the target."""
    pos = edges.where("type = 'positive'").select(F.explode(F.array(F.struct(F.col("target").alias("t"), F.col("partner").alias("p")), F.struct(F.col("partner").alias("t"), F.col("target").alias("p")))).alias("e"), F.lit(1).alias("k")).select("e.t", "e.p", "k")
    neg = edges.where("type = 'negative'").select(F.col("target").alias("t"), F.col("partner").alias("p"), F.lit(0).alias("k"))
    both = pos.unionByName(neg).distinct()
    return both.groupBy(F.col("t").alias("target")).agg(F.count(F.when(F.col("k") == 1, 1)).alias("n_pos"), F.count(F.when(F.col("k") == 0, 1)).alias("n_neg"))


def floors(counts: DataFrame, least_pos: int = 2, least_neg: int = 20) -> DataFrame:
    return counts.where((F.col("n_pos") >= least_pos) & (F.col("n_neg") >= least_neg))


def pair_metadata(rows: DataFrame, scale: float = 1.0) -> DataFrame:
    """acc_a, acc_b, min_chains, max_area, example: per unordered pair; the example is the first row's entry, nulls count 0."""
    pairs = rows.withColumns({"a": F.least("acc_a", "acc_b"), "b": F.greatest("acc_a", "acc_b")})
    return pairs.groupBy(F.col("a").alias("acc_a"), F.col("b").alias("acc_b")).agg(
        F.coalesce(F.min("chains"), F.lit(0)).cast("long").alias("min_chains"),
        F.floor(F.coalesce(F.max(F.col("area") / F.lit(scale)), F.lit(0.0))).cast("long").alias("max_area"),
        F.min_by("entry", "ordinal").alias("example"),
    )


def preferred(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of `first`, and those of `second` whose keys it lacks."""
    return first.unionByName(second.join(first.select(*keys).distinct(), keys, "left_anti"))


def view(edges: DataFrame, targets: DataFrame, metadata: DataFrame) -> DataFrame:
    """target, n_pos, n_neg and the range of its positive pairs' metadata; the example comes from the least partner that has any."""
    pos = edges.where("type = 'positive'").join(targets.select("target"), "target", "left_semi").withColumns({"acc_a": F.least("target", "partner"), "acc_b": F.greatest("target", "partner")})
    ranges = pos.join(metadata, ["acc_a", "acc_b"]).groupBy("target").agg(F.min("min_chains").alias("min_chains"), F.max("min_chains").alias("max_chains"), F.min("max_area").alias("min_area"), F.max("max_area").alias("max_area"), F.min_by("example", "partner").alias("example"))
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("min_chains", "max_chains", "min_area", "max_area")]
    return targets.join(ranges, "target", "left").select("target", "n_pos", "n_neg", *zero, F.coalesce("example", F.lit("")).alias("example"))


def pair_subset(edges: DataFrame, targets: DataFrame, genes: DataFrame, keep: str = "clean") -> DataFrame:
    """Kept edges of the targets, with the gene names of both ends (empty if unknown)."""
    g = lambda end: genes.select(F.col("acc").alias(end), F.col("gene").alias(f"{end}_gene"))
    kept = edges.where(keep).join(targets.select("target"), "target", "left_semi")
    out = kept.join(g("target"), "target", "left").join(g("partner"), "partner", "left")
    return out.select("target", F.coalesce("target_gene", F.lit("")).alias("target_gene"), "partner", F.coalesce("partner_gene", F.lit("")).alias("partner_gene"), "type")


def gene_lookup(rows: DataFrame) -> DataFrame:
    """acc, gene: the first usable name, of the target column before the partner column; rows: ordinal, target(_gene), partner(_gene)."""
    named = rows.select("ordinal", F.lit(0).alias("side"), F.col("target").alias("acc"), F.col("target_gene").alias("gene")).unionByName(rows.select("ordinal", F.lit(1).alias("side"), F.col("partner").alias("acc"), F.col("partner_gene").alias("gene")))
    return named.where("gene is not null and gene not in ('', '?')").groupBy("acc").agg(F.min_by("gene", F.struct("side", "ordinal")).alias("gene"))


def coverage_ratio(observed: DataFrame, least: float) -> DataFrame:
    """acc, coverage: share of the distinct observed positions whose value reaches `least`."""
    good = F.count_distinct(F.when(F.col("value") >= least, F.col("position")))
    return observed.groupBy("acc").agg((good / F.count_distinct("position")).alias("coverage"))


def partner_means(edges: DataFrame, values: DataFrame) -> DataFrame:
    """target, mean_pos, mean_neg of the partners' values; null and NaN values do not count."""
    v = values.select(F.col("acc").alias("partner"), F.when(~F.isnan("value"), F.col("value")).alias("value"))
    return edges.join(v, "partner", "left").groupBy("target").agg(F.avg(F.when(F.col("type") == "positive", F.col("value"))).alias("mean_pos"), F.avg(F.when(F.col("type") == "negative", F.col("value"))).alias("mean_neg"))
