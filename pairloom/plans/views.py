"""Views that let the pair operators run on the star-schema tables, for Spark and (as SQL) for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import pairs as P

CUTOFF = "1998-04-01 00:00:00"

IFACE = """iface as (select a.l_orderkey as entry, o_orderdate as release_date, 'P' || a.l_partkey as acc_a, 'P' || b.l_partkey as acc_b,
    least(a.l_extendedprice, b.l_extendedprice) as area, least(a.l_quantity, b.l_quantity) as contacts, greatest(a.l_discount, b.l_discount) as resolution,
    a.l_linestatus as label, a.l_returnflag as fa, b.l_returnflag as fb, a.l_linenumber as chains, a.l_orderkey * 100 + a.l_linenumber * 10 + b.l_linenumber as ordinal
    from lineitem a join lineitem b on a.l_orderkey = b.l_orderkey and a.l_linenumber < b.l_linenumber join orders on o_orderkey = a.l_orderkey)"""
CONDITIONS = {"pos_a": "fa = 'A' and fb = 'A'", "pos_b": "fa = 'R' or fb = 'R'", "neg": "fa = 'N' and fb = 'N'"}


def pairs_sql(name: str) -> str:
    return f"{name} as (select distinct least(acc_a, acc_b) as acc_a, greatest(acc_a, acc_b) as acc_b from iface where acc_a <> acc_b and ({CONDITIONS[name]}))"


def edges_sql(name: str) -> str:
    return f"{name}_e as (select acc_a as target, acc_b as partner from {name} union select acc_b, acc_a from {name})"


POS = "pos as (select target, partner, string_agg(label, ',' order by label) as sources from (select target, partner, 'a' as label from pos_a_e union all select target, partner, 'b' from pos_b_e) group by target, partner)"
EDGES = "edges as (select target, partner, 'positive' as type, sources from pos union all select target, partner, 'negative', '' from neg_e n where not exists (select 1 from pos p where p.target = n.target and p.partner = n.partner))"
ASSEMBLED = [IFACE, *(f(n) for n in CONDITIONS for f in (pairs_sql, edges_sql)), POS, EDGES]


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def iface(spark: SparkSession, d: str) -> DataFrame:
    """Interface rows: two lines of one order, their parts as the two proteins."""
    keep = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_discount", "l_linestatus", "l_returnflag"]
    lines = table(spark, d, "lineitem").select(*keep)
    a, b = lines.alias("a"), lines.alias("b")
    both = a.join(b, F.expr("a.l_orderkey = b.l_orderkey and a.l_linenumber < b.l_linenumber"))
    both = both.join(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), F.expr("o_orderkey = a.l_orderkey"))
    return both.selectExpr(
        "a.l_orderkey as entry", "o_orderdate as release_date", "'P' || a.l_partkey as acc_a", "'P' || b.l_partkey as acc_b",
        "least(a.l_extendedprice, b.l_extendedprice) as area", "least(a.l_quantity, b.l_quantity) as contacts", "greatest(a.l_discount, b.l_discount) as resolution",
        "a.l_linestatus as label", "a.l_returnflag as fa", "b.l_returnflag as fb", "a.l_linenumber as chains", "a.l_orderkey * 100 + a.l_linenumber * 10 + b.l_linenumber as ordinal",
    )


def pair_set(spark: SparkSession, d: str, name: str) -> DataFrame:
    return P.dedup(iface(spark, d).where(CONDITIONS[name]))


def edge_set(spark: SparkSession, d: str, name: str) -> DataFrame:
    return P.directed(pair_set(spark, d, name))


def assembled(spark: SparkSession, d: str) -> DataFrame:
    from ..operators import assemble

    return assemble.assemble_flags(iface(spark, d), {"a": CONDITIONS["pos_a"], "b": CONDITIONS["pos_b"]}, CONDITIONS["neg"])


#: Entries and dates: orders in process count as undated.
DATES = "dates as (select o_orderkey as entry, case when o_orderstatus = 'P' then null else o_orderdate end as release_date from orders)"


def dates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("entry"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("release_date"))


#: Chains: each line of an order is a chain of an entry.
CHAINS = "chains as (select distinct l_orderkey as entry, l_linenumber as chain, 'P' || l_partkey as acc from lineitem)"


def chains(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").selectExpr("l_orderkey as entry", "l_linenumber as chain", "'P' || l_partkey as acc").distinct()


FEATURES = "features as (select 'L' || label as protein, vec_id as residue, feature - 1 as feature, round(cast(v as double), 6) as magnitude from (select label, vec_id, unnest(embedding) as v, unnest(range(1, len(embedding) + 1)) as feature from embeddings) where v > 0.15)"


def features(spark: SparkSession, d: str) -> DataFrame:
    """Sparse residue features: vector components above 0.15."""
    long = table(spark, d, "embeddings").select(F.concat(F.lit("L"), "label").alias("protein"), F.col("vec_id").alias("residue"), F.posexplode("embedding").alias("feature", "v"))
    kind = long.schema["v"].dataType  # the bound in the component's own type, as in SQL: the float nearest to 0.15 is above the double
    return long.where(F.col("v") > F.lit(0.15).cast(kind)).select("protein", "residue", F.col("feature").cast("long").alias("feature"), F.round(F.col("v").cast("double"), 6).alias("magnitude"))


LOG = "log as (select event_id, user_id, event_type, ts, value, event_id % 7 <> 0 as ok, case when event_id % 2 = 0 then 'x' else 'y' end as run from events)"


def log(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").selectExpr("event_id", "user_id", "event_type", "ts", "value", "event_id % 7 <> 0 as ok", "case when event_id % 2 = 0 then 'x' else 'y' end as run")


BLOCKS = r"blocks as (select doc_id, i - 1 as block_index, b[i] as text from (select doc_id, string_split(text, chr(10)) as b, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from documents where text is not null))"
