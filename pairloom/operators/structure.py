"""Structure aggregates: who is near whom, and which pairs never touch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import not_nan


def heterocomplexes(chains: DataFrame, more_than: int = 2) -> DataFrame:
    """entry, n_acc: entries with more than `more_than` distinct accessions."""
    return chains.groupBy("entry").agg(F.count_distinct("acc").alias("n_acc")).where(F.col("n_acc") > more_than)


def _gap(least: bool) -> Column:
    """The square of the least (or greatest) distance that points of two boxes, lo..hi of a and of b, can have."""
    sides = ((F.col(f"lo_{c}a") - F.col(f"hi_{c}b"), F.col(f"lo_{c}b") - F.col(f"hi_{c}a")) for c in "xyz")
    along = [F.greatest(F.lit(0.0), p, q) if least else F.greatest(-p, -q) for p, q in sides]
    return sum((d * d for d in along), F.lit(0.0))


def min_distances(points: DataFrame, few: int = 64) -> DataFrame:
    """entry, chain_a, chain_b, distance: the least distance of any two points of two chains of an entry.

    points: entry, chain, x, y, z; further columns are ignored, and so are rows with a null or NaN among the five. Two chains of at most
    `few` points each: their points meet. Where one has more, points are first summed up as boxes: the whole of a small chain, and
    the cells of a grid over a large one, about n^(2/3) for n points, which balances pairs of boxes with pairs of points. The nearest points
    can only lie in boxes whose least distance is within the chain pair's best greatest distance, so only points of such
    boxes meet. Nothing is gathered: boxes and points go through map-side combined minima.
    """
    points = points.select("entry", "chain", *(not_nan(F.col(c).cast("double")).alias(c) for c in "xyz")).dropna()
    extents = points.groupBy("entry", "chain").agg(F.count("*").alias("n"), *(f(c).alias(f"{name}_{c}") for name, f in (("lo", F.min), ("hi", F.max)) for c in "xyz"))
    large = extents.where(F.col("n") > few).withColumn("k", F.ceil(F.pow("n", F.lit(2 / 9))))
    place = lambda c: F.coalesce(F.least(F.col("k") - 1, F.floor(F.try_divide((F.col(c) - F.col(f"lo_{c}")) * F.col("k"), F.col(f"hi_{c}") - F.col(f"lo_{c}")))), F.lit(0))
    boxed = points.join(large, ["entry", "chain"], "left").select("entry", "chain", *"xyz", F.col("n").isNotNull().alias("many"), F.struct(*(place(c).alias(c) for c in "xyz")).alias("cell"))
    boxes = boxed.groupBy("entry", "chain", "many", "cell").agg(*(f(c).alias(f"{name}_{c}") for name, f in (("lo", F.min), ("hi", F.max)) for c in "xyz"))
    side = lambda rows, x: rows.drop("many").select("entry", *(F.col(c).alias(f"{c}_{x}" if c in ("chain", "cell") else f"{c}{x}") for c in rows.columns if c not in ("entry", "many")))
    meet = lambda a, b, on: side(a, "a").join(side(b, "b"), on).where("chain_a < chain_b")
    chains, cells = ["entry", "chain_a", "chain_b"], ["cell_a", "cell_b"]
    pairs = meet(boxes.where("many"), boxes, "entry").unionByName(meet(boxes.where("not many"), boxes.where("many"), "entry")).select(*chains, *cells, _gap(True).alias("least"), _gap(False).alias("greatest"))
    open_ = pairs.join(pairs.groupBy(chains).agg(F.min("greatest").alias("within")), chains).where("least <= within").select(*chains, *cells)
    near = open_.join(side(boxed, "a"), ["entry", "chain_a", "cell_a"]).join(side(boxed, "b"), ["entry", "chain_b", "cell_b"])
    direct = meet(boxed.where("not many"), boxed.where("not many"), "entry")
    square = sum(((F.col(f"{c}a") - F.col(f"{c}b")) * (F.col(f"{c}a") - F.col(f"{c}b")) for c in "xyz"), F.lit(0.0))
    return direct.select(*chains, square.alias("square")).unionByName(near.select(*chains, square.alias("square"))).groupBy(chains).agg(F.sqrt(F.min("square")).alias("distance"))


def _ends(distances: DataFrame) -> DataFrame:
    """Two rows for each distance: chain and other, either way."""
    ends = F.explode(F.array(F.struct(F.col("chain_a").alias("chain"), F.col("chain_b").alias("other")), F.struct(F.col("chain_b").alias("chain"), F.col("chain_a").alias("other"))))
    return distances.select("entry", "chain_a", "chain_b", "distance", ends.alias("e")).select("entry", "chain_a", "chain_b", "distance", "e.chain", "e.other")


def nearest(distances: DataFrame) -> DataFrame:
    """entry, chain, other: each chain's nearest other chain, ties by name."""
    return _ends(distances).groupBy("entry", "chain").agg(F.min_by("other", F.struct("distance", "other")).alias("other"))


def never_interacting(distances: DataFrame, chains: DataFrame, far: float = 8.0) -> DataFrame:
    """acc_a, acc_b: protein pairs all of whose chain pairs are farther than `far` and not each other's nearest."""
    first = F.min(F.struct("distance", "other")).over(Window.partitionBy("entry", "chain"))
    judged = _ends(distances).withColumn("near", F.col("other") == first["other"]).groupBy("entry", "chain_a", "chain_b").agg(F.min("distance").alias("distance"), F.bool_or("near").alias("near"))
    apart = judged.select("entry", "chain_a", "chain_b", ((F.col("distance") > far) & ~F.col("near")).alias("apart"))
    ca, cb = chains.select("entry", F.col("chain").alias("chain_a"), F.col("acc").alias("pa")), chains.select("entry", F.col("chain").alias("chain_b"), F.col("acc").alias("pb"))
    pairs = apart.join(ca, ["entry", "chain_a"]).join(cb, ["entry", "chain_b"]).where("pa <> pb")
    return pairs.groupBy(F.least("pa", "pb").alias("acc_a"), F.greatest("pa", "pb").alias("acc_b")).agg(F.bool_and("apart").alias("apart")).where("apart").select("acc_a", "acc_b")
