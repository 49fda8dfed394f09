"""The registered queries: each applies one operator to whole tables, with the oracle's SQL beside it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as E
from ..operators import assemble as A
from ..operators import leakage as L
from ..operators import logs as G
from ..operators import matching as M
from ..operators import pairs as P
from ..operators import reports
from ..operators import scoring as N
from ..operators import structure as S
from ..operators import targets as T
from ..operators import texts as X
from . import views as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, using: list[str] | None = None, recursive: bool = False):
    """Registers a query under its function's name; sql runs on the views in `using`."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = (f"with {'recursive ' if recursive else ''}{', '.join(using)} " if using else "") + sql
        return f

    return register


FILTER_A = {"equal": {"label": "F"}, "at_most": {"resolution": 0.05}, "at_least": {"area": 20000.0, "contacts": 4.0}}
FILTER_A_SQL = "label = 'F' and resolution <= 0.05 and area >= 20000 and contacts >= 4"


# pair


@query(f"select entry, acc_a, acc_b, round(area, 4) as area, contacts, resolution from iface where {FILTER_A_SQL}", [V.IFACE])
def pair_quality_filter_a(spark, d):
    return P.quality_filter(V.iface(spark, d), **FILTER_A).select("entry", "acc_a", "acc_b", F.round("area", 4).alias("area"), "contacts", "resolution")


@query("select entry, acc_a, acc_b from iface where chains = 1 and resolution <= 0.04 and area >= 10000 and contacts >= 4", [V.IFACE])
def pair_quality_filter_b(spark, d):
    return P.quality_filter(V.iface(spark, d), {"chains": 1}, {"resolution": 0.04}, {"area": 10000.0, "contacts": 4.0}).select("entry", "acc_a", "acc_b")


@query("select l_orderkey as entry, l_linenumber as chain, 'P' || l_partkey as acc_a, 'S' || l_suppkey as acc_b from lineitem where l_returnflag <> 'N'")
def pair_parse_ids(spark, d):
    ids = V.table(spark, d, "lineitem").selectExpr("l_orderkey as entry", "l_linenumber as chain", "l_orderkey || '__' || l_linenumber || '_P' || l_partkey || '--' || l_orderkey || '__' || l_linenumber || '_' || if(l_returnflag = 'N', 'UNDEFINED', 'S' || l_suppkey) as id")
    return P.parse_pair_ids(ids).drop("id")


@query("select distinct least(acc_a, acc_b) as acc_a, greatest(acc_a, acc_b) as acc_b from iface where acc_a <> acc_b", [V.IFACE])
def pair_dedup(spark, d):
    return P.dedup(V.iface(spark, d))


@query("select a as acc_a, b as acc_b, string_agg(label, ',' order by label) as sources from (select distinct least(acc_a, acc_b) as a, greatest(acc_a, acc_b) as b, fa as label from iface) group by a, b", [V.IFACE])
def pair_dedup_sources(spark, d):
    return P.dedup_sources(V.iface(spark, d), "fa")


LISTED = ["P1", "P7", "P19", "P55", "P100", "P101", "P133", "P150"]


@query(f"select acc_a, acc_b from pos_b where acc_a not in {tuple(LISTED)} and acc_b not in {tuple(LISTED)}", [V.IFACE, V.pairs_sql("pos_b")])
def pair_tag_blocklist(spark, d):
    return P.drop_listed(V.pair_set(spark, d, "pos_b"), LISTED)


@query("select target, partner from pos_b_e", [V.IFACE, V.pairs_sql("pos_b"), V.edges_sql("pos_b")])
def pair_directed(spark, d):
    return V.edge_set(spark, d, "pos_b")


GOOD = f"good as (select distinct least(acc_a, acc_b) as acc_a, greatest(acc_a, acc_b) as acc_b from iface where acc_a <> acc_b and {FILTER_A_SQL})"


@query("select acc, count(*) as degree from (select acc_a as acc from good union all select acc_b from good) group by acc", [V.IFACE, GOOD])
def pair_directed_degree(spark, d):
    """Quality filter, canonical de-duplication and degree: the flagship plan."""
    return P.degree(P.dedup(P.quality_filter(V.iface(spark, d), **FILTER_A)))


@query("select acc, count(*) as degree from (select acc_a as acc from iface union all select acc_b from iface) group by acc", [V.IFACE])
def pair_degree(spark, d):
    return P.degree(V.iface(spark, d))


@query("select target, partner from pos_a_e where target in (select target from pos_a_e group by target having count(distinct partner) >= 8)", [V.IFACE, V.pairs_sql("pos_a"), V.edges_sql("pos_a")])
def pair_min_partners(spark, d):
    return P.min_partners(V.edge_set(spark, d, "pos_a"), 8)


@query("select acc_a || '|' || acc_b as pair, acc_a, acc_b from pos_a", [V.IFACE, V.pairs_sql("pos_a")])
def pair_key_string(spark, d):
    return P.with_key(V.pair_set(spark, d, "pos_a"))


@query("select case when acc_a > acc_b then acc_b else acc_a end as acc_a, case when acc_a > acc_b then acc_a else acc_b end as acc_b, case when acc_a > acc_b then fb else fa end as fa, case when acc_a > acc_b then fa else fb end as fb, ordinal from iface", [V.IFACE])
def pair_canonical_sides(spark, d):
    return P.canonical(V.iface(spark, d).select("acc_a", "acc_b", "fa", "fb", "ordinal"), carried={"fa": "fb"})


@query("select acc_a, acc_b, count(*) as n from iface group by acc_a, acc_b having count(*) > 1", [V.IFACE])
def pair_repeated(spark, d):
    return P.repeated(V.iface(spark, d), "acc_a", "acc_b")


# assemble


@query("select target, partner, sources from pos", V.ASSEMBLED)
def assemble_union_labels(spark, d):
    return A.union_labels({"a": V.edge_set(spark, d, "pos_a"), "b": V.edge_set(spark, d, "pos_b")})


@query("select target, partner from neg_e n where not exists (select 1 from pos_b_e p where p.target = n.target and p.partner = n.partner)", V.ASSEMBLED)
def assemble_conflict_antijoin(spark, d):
    return A.without_conflicts(V.edge_set(spark, d, "neg"), V.edge_set(spark, d, "pos_b"))


@query("select target, partner, type, sources from edges where target <> partner", V.ASSEMBLED)
def assemble_full(spark, d):
    return V.assembled(spark, d)


@query("select acc_a, acc_b, ordinal, case when acc_a = acc_b then 'self_pair' when contacts < 10 then 'few_contacts' when resolution > 0.08 then 'resolution' when fa <> fb then 'contradicted' else '' end as drop_reason from iface", [V.IFACE])
def assemble_drop_reasons(spark, d):
    reasons = {"self_pair": "acc_a = acc_b", "few_contacts": "contacts < 10", "resolution": "resolution > 0.08", "contradicted": "fa <> fb"}
    return A.first_reason(V.iface(spark, d), reasons).select("acc_a", "acc_b", "ordinal", "drop_reason")


@query("select acc_a, acc_b, (acc_a, acc_b) in (select (acc_a, acc_b) from pos_b) as known from neg", [V.IFACE, V.pairs_sql("neg"), V.pairs_sql("pos_b")])
def assemble_membership_flag(spark, d):
    return A.membership(V.pair_set(spark, d, "neg"), V.pair_set(spark, d, "pos_b"), "known")


@query(f"select label, count(*) as n_before, count(*) filter ({FILTER_A_SQL}) as n_after, count(*) - count(*) filter ({FILTER_A_SQL}) as n_removed from iface group by label", [V.IFACE])
def assemble_removed_counts(spark, d):
    rows = V.iface(spark, d)
    return A.removed_counts(rows, P.quality_filter(rows, **FILTER_A), ["label"])


# leak

SOURCES = "src as (select least(acc_a, acc_b) as acc_a, greatest(acc_a, acc_b) as acc_b, entry from iface where contacts >= 10)"
DATE_FLAG = f"dflag as (select acc_a, acc_b, bool_or(release_date is null or release_date <= timestamp '{V.CUTOFF}') as date_leaked from src left join dates using (entry) group by acc_a, acc_b)"


def _sources(spark, d):
    return V.iface(spark, d).where("contacts >= 10").select(F.least("acc_a", "acc_b").alias("acc_a"), F.greatest("acc_a", "acc_b").alias("acc_b"), "entry")


def _dated(spark, d):
    return L.date_flag(V.pair_set(spark, d, "pos_b"), _sources(spark, d), V.dates(spark, d), V.CUTOFF)


@query("select acc_a, acc_b, date_leaked from pos_b left join dflag using (acc_a, acc_b)", [V.IFACE, V.pairs_sql("pos_b"), V.DATES, SOURCES, DATE_FLAG])
def leak_date_flag(spark, d):
    return _dated(spark, d)


@query("select acc_a, acc_b, string_agg(cast(entry as varchar), ',' order by entry) as entries from (select distinct * from src) group by acc_a, acc_b", [V.IFACE, SOURCES])
def leak_source_index(spark, d):
    return L.source_index(_sources(spark, d)).withColumn("entries", F.array_join("entries", ","))


MEMBERS = "members as (select least(acc_a, acc_b) as acc_a, greatest(acc_a, acc_b) as acc_b, release_date, least(pa.p_brand, pb.p_brand) || '_' || greatest(pa.p_brand, pb.p_brand) || '_' || cast(pa.p_size as varchar) as raw from iface join part pa on 'P' || pa.p_partkey = acc_a join part pb on 'P' || pb.p_partkey = acc_b)"
CLUSTERED = "clustered as (select acc_a, acc_b, release_date, regexp_replace(raw, '_[^_]*$', '') as cluster from members)"
FIRST_DATES = "firsts as (select cluster, min(release_date) as min_release_date from clustered group by cluster)"
QUALITY = "hflag as (select acc_a, acc_b, bool_or(min_release_date <= timestamp '1995-01-20 00:00:00') as homolog_leaked from (select distinct acc_a, acc_b, cluster from clustered) join firsts using (cluster) group by acc_a, acc_b)"
EARLY = "1995-01-20 00:00:00"


def _clustered(spark, d):
    part = V.table(spark, d, "part").selectExpr("'P' || p_partkey as acc", "p_brand", "p_size")
    a, b = (part.select(F.col("acc").alias(f"acc_{x}"), F.col("p_brand").alias(f"brand_{x}"), F.col("p_size").alias(f"size_{x}")) for x in "ab")
    rows = V.iface(spark, d).join(a, "acc_a").join(b, "acc_b")
    raw = F.concat_ws("_", F.least("brand_a", "brand_b"), F.greatest("brand_a", "brand_b"), F.col("size_a").cast("string"))
    return rows.select(F.least("acc_a", "acc_b").alias("acc_a"), F.greatest("acc_a", "acc_b").alias("acc_b"), "release_date", raw.alias("raw")).withColumn("cluster", E.cluster_without_mode("raw"))


@query("select cluster, min_release_date from firsts", [V.IFACE, MEMBERS, CLUSTERED, FIRST_DATES])
def leak_cluster_min_date(spark, d):
    return L.cluster_min_date(_clustered(spark, d))


@query("select acc_a, acc_b, coalesce(homolog_leaked, false) as homolog_leaked from pos_a left join hflag using (acc_a, acc_b)", [V.IFACE, V.pairs_sql("pos_a"), MEMBERS, CLUSTERED, FIRST_DATES, QUALITY])
def leak_homolog_a(spark, d):
    rows = _clustered(spark, d)
    return L.cluster_flag(V.pair_set(spark, d, "pos_a"), rows, L.cluster_min_date(rows), EARLY, False)


def _homologs(spark, d):
    rows = _clustered(spark, d)
    return L.cluster_flag(V.pair_set(spark, d, "pos_b"), rows, L.cluster_min_date(rows), EARLY, None)



@query("select acc_a, acc_b, homolog_leaked from pos_b left join hflag using (acc_a, acc_b)", [V.IFACE, V.pairs_sql("pos_b"), MEMBERS, CLUSTERED, FIRST_DATES, QUALITY])
def leak_homolog_b(spark, d):
    return _homologs(spark, d)


FLAGS = [V.IFACE, V.pairs_sql("pos_b"), V.DATES, SOURCES, DATE_FLAG, MEMBERS, CLUSTERED, FIRST_DATES, QUALITY, "flagged as (select acc_a, acc_b, date_leaked, homolog_leaked, case when length(acc_b) % 2 = 0 then 'positive' else 'negative' end as type from pos_b left join dflag using (acc_a, acc_b) left join hflag using (acc_a, acc_b))"]


def _flagged(spark, d):
    return _dated(spark, d).join(_homologs(spark, d), ["acc_a", "acc_b"]).withColumn("type", F.expr("if(length(acc_b) % 2 = 0, 'positive', 'negative')"))


@query("select acc_a, acc_b, case when coalesce(date_leaked, false) or coalesce(homolog_leaked, false) then true when date_leaked is null and homolog_leaked is null then null else false end as leaked from flagged", FLAGS)
def leak_combine(spark, d):
    return _flagged(spark, d).select("acc_a", "acc_b", L.any_true("date_leaked", "homolog_leaked").alias("leaked"))


@query("select acc_a, acc_b, type, case when type = 'positive' then coalesce(date_leaked = false, false) and coalesce(homolog_leaked = false, false) else coalesce(date_leaked = false, false) and coalesce(homolog_leaked <> true, true) end as clean from flagged", FLAGS)
def leak_clean_masks(spark, d):
    return _flagged(spark, d).select("acc_a", "acc_b", "type", L.clean().alias("clean"))


@query("select acc_a, acc_b, type, case when type = 'positive' then coalesce(date_leaked, false) or coalesce(homolog_leaked, false) else coalesce(date_leaked, false) end as leaked from flagged", FLAGS)
def leak_leaked_masks(spark, d):
    return _flagged(spark, d).select("acc_a", "acc_b", "type", L.leaked().alias("leaked"))


CO = f"co as (select n.acc_a, n.acc_b, count(*) as n_entries, min(a.entry) as first_entry from neg n join (select distinct acc, entry from chains) a on a.acc = n.acc_a join (select distinct acc, entry from chains) b on b.acc = n.acc_b and b.entry = a.entry join dates t on t.entry = a.entry where t.release_date <= timestamp '{V.CUTOFF}' group by n.acc_a, n.acc_b)"


def _copresent(spark, d):
    return L.copresence(V.pair_set(spark, d, "neg"), V.chains(spark, d), V.dates(spark, d), V.CUTOFF)


@query("select * from co", [V.IFACE, V.pairs_sql("neg"), V.CHAINS, V.DATES, CO])
def leak_copresence(spark, d):
    return _copresent(spark, d)


@query("select acc_a, acc_b, case when n_entries is null then date_leaked when length(acc_a) % 2 = 0 then true else date_leaked end as date_leaked from neg left join co using (acc_a, acc_b) left join dflag using (acc_a, acc_b)", [V.IFACE, V.pairs_sql("neg"), V.CHAINS, V.DATES, CO, SOURCES, DATE_FLAG])
def leak_copresence_overlay(spark, d):
    dated = L.date_flag(V.pair_set(spark, d, "neg"), _sources(spark, d), V.dates(spark, d), V.CUTOFF)
    rows = dated.join(_copresent(spark, d), ["acc_a", "acc_b"], "left")
    rows = rows.select("acc_a", "acc_b", F.expr("if(length(acc_a) % 2 = 0, 'negative', 'positive')").alias("type"), F.col("date_leaked").alias("date"), F.when(F.col("n_entries").isNotNull(), True).alias("verdict"))
    return rows.select("acc_a", "acc_b", L.overlay("type", "date", "verdict").alias("date_leaked"))


HITS = "hits as (select 'P' || p_partkey as query, 'P' || (p_partkey % 97 + 1) as target, p_size / 50.0 as fident, (p_partkey % 11) / 10.0 as qcov, (p_partkey % 7 + 4) / 10.0 as tcov from part union all select 'P' || p_partkey, 'P' || p_partkey, 1.0, 1.0, 1.0 from part)"
INDEX = "idx as (select query as acc, entry, list_sort(list(distinct h.target)) as m from hits h join chains c on c.acc = h.target where fident > 0.40 and qcov >= 0.5 and tcov >= 0.5 group by query, entry)"


def _homolog_index(spark, d):
    part = V.table(spark, d, "part")
    near = part.selectExpr("'P' || p_partkey as query", "'P' || (p_partkey % 97 + 1) as target", "cast(p_size / 50.0D as double) as fident", "(p_partkey % 11) / 10.0D as qcov", "(p_partkey % 7 + 4) / 10.0D as tcov")
    self = part.selectExpr("'P' || p_partkey as query", "'P' || p_partkey as target", "1.0D as fident", "1.0D as qcov", "1.0D as tcov")
    return L.homolog_index(near.unionByName(self), V.chains(spark, d).select("acc", "entry").distinct())


@query("select n.acc_a, n.acc_b, min(a.entry) as homolog_entry from neg n join idx a on a.acc = n.acc_a join idx b on b.acc = n.acc_b and b.entry = a.entry where len(list_distinct(list_concat(a.m, b.m))) > 1 group by n.acc_a, n.acc_b", [V.IFACE, V.pairs_sql("neg"), V.CHAINS, HITS, INDEX])
def leak_two_sided_homolog(spark, d):
    return L.two_sided_homologs(V.pair_set(spark, d, "neg"), _homolog_index(spark, d))


@query("select acc_a, acc_b from neg where not exists (select 1 from co where co.acc_a = neg.acc_a and co.acc_b = neg.acc_b)", [V.IFACE, V.pairs_sql("neg"), V.CHAINS, V.DATES, CO])
def leak_coverage_gap(spark, d):
    return L.uncovered(V.pair_set(spark, d, "neg"), _copresent(spark, d))


# target

COUNTS = "counts as (select t as target, count(*) filter (k = 1) as n_pos, count(*) filter (k = 0) as n_neg from (select target as t, partner as p, 1 as k from edges where type = 'positive' union select partner, target, 1 from edges where type = 'positive' union select target, partner, 0 from edges where type = 'negative') group by t)"
FLOORS = "chosen as (select * from counts where n_pos >= 40 and n_neg >= 8)"
META = "meta as (select least(acc_a, acc_b) as acc_a, greatest(acc_a, acc_b) as acc_b, cast(coalesce(min(chains), 0) as bigint) as min_chains, cast(floor(coalesce(max(area / 0.481), 0)) as bigint) as max_area, arg_min(entry, ordinal) as example from iface where contacts >= 25 group by all)"
GENES = "genes as (select 'P' || p_partkey as acc, p_name as gene from part where p_partkey % 5 <> 0)"


def _chosen(spark, d):
    return T.floors(T.partner_counts(V.assembled(spark, d)), 40, 8)


def _meta(spark, d):
    return T.pair_metadata(V.iface(spark, d).where("contacts >= 25"), 0.481)


def _genes(spark, d):
    return V.table(spark, d, "part").where("p_partkey % 5 <> 0").selectExpr("'P' || p_partkey as acc", "p_name as gene")


@query("select * from counts", [*V.ASSEMBLED, COUNTS])
def target_partners(spark, d):
    return T.partner_counts(V.assembled(spark, d))


@query("select * from chosen", [*V.ASSEMBLED, COUNTS, FLOORS])
def target_floors(spark, d):
    return _chosen(spark, d)


@query(
    """select c.target, n_pos, n_neg, coalesce(min(min_chains), 0) as min_chains, coalesce(max(min_chains), 0) as max_chains, coalesce(min(max_area), 0) as min_area, coalesce(max(max_area), 0) as max_area,
    coalesce(cast(arg_min(example, partner) as varchar), '') as example from chosen c left join (select target, partner, m.* from edges join meta m on m.acc_a = least(target, partner) and m.acc_b = greatest(target, partner) where type = 'positive') e on e.target = c.target group by c.target, n_pos, n_neg""",
    [*V.ASSEMBLED, COUNTS, FLOORS, META],
)
def target_view(spark, d):
    return T.view(V.assembled(spark, d), _chosen(spark, d), _meta(spark, d).withColumn("example", F.col("example").cast("string")))


@query("select e.target, coalesce(a.gene, '') as target_gene, partner, coalesce(b.gene, '') as partner_gene, type from edges e left join genes a on a.acc = e.target left join genes b on b.acc = e.partner where e.sources <> 'a' and e.target in (select target from chosen)", [*V.ASSEMBLED, COUNTS, FLOORS, GENES])
def target_pair_subset(spark, d):
    return T.pair_subset(V.assembled(spark, d), _chosen(spark, d), _genes(spark, d), "sources <> 'a'")


@query("select acc_a, acc_b, min_chains, max_area, cast(example as varchar) as example from meta", [V.IFACE, META.replace("/ 0.481", "")])
def target_pair_metadata_a(spark, d):
    return T.pair_metadata(V.iface(spark, d).where("contacts >= 25")).withColumn("example", F.col("example").cast("string"))


@query("select acc_a, acc_b, min_chains, max_area, cast(example as varchar) as example from meta", [V.IFACE, META])
def target_pair_metadata_b(spark, d):
    return _meta(spark, d).withColumn("example", F.col("example").cast("string"))


FILL = [V.IFACE, META.replace("meta as", "one as").replace("contacts >= 25", "contacts >= 40"), META]


@query("select acc_a, acc_b, max_area from one union all select acc_a, acc_b, max_area from meta where (acc_a, acc_b) not in (select (acc_a, acc_b) from one)", FILL)
def target_preferred_fill(spark, d):
    one = T.pair_metadata(V.iface(spark, d).where("contacts >= 40"), 0.481)
    return T.preferred(one, _meta(spark, d), ["acc_a", "acc_b"]).select("acc_a", "acc_b", "max_area")


@query(
    "select acc, arg_min(gene, (side, ordinal)) as gene from (select ordinal, 0 as side, acc_a as acc, case when ordinal % 3 = 0 then '?' else fa || entry end as gene from iface union all select ordinal, 1, acc_b, case when ordinal % 4 = 0 then '' else fb || entry end from iface) where gene not in ('', '?') group by acc",
    [V.IFACE],
)
def target_gene_lookup(spark, d):
    return T.gene_lookup(V.iface(spark, d).selectExpr("ordinal", "acc_a as target", "if(ordinal % 3 = 0, '?', fa || entry) as target_gene", "acc_b as partner", "if(ordinal % 4 = 0, '', fb || entry) as partner_gene"))


@query("select 'P' || l_partkey as acc, round(count(distinct case when l_quantity >= 25 then l_orderkey end) / count(distinct l_orderkey), 9) as coverage from lineitem group by 1")
def target_coverage_ratio(spark, d):
    rows = V.table(spark, d, "lineitem").selectExpr("'P' || l_partkey as acc", "l_orderkey as position", "l_quantity as value")
    return T.coverage_ratio(rows, 25).withColumn("coverage", F.round("coverage", 9))


@query("select target, round(avg(p_retailprice) filter (type = 'positive'), 4) as mean_pos, round(avg(p_retailprice) filter (type = 'negative'), 4) as mean_neg from edges left join part on 'P' || p_partkey = partner group by target", V.ASSEMBLED)
def target_partner_means(spark, d):
    values = V.table(spark, d, "part").selectExpr("'P' || p_partkey as acc", "p_retailprice as value")
    return T.partner_means(V.assembled(spark, d), values).select("target", F.round("mean_pos", 4).alias("mean_pos"), F.round("mean_neg", 4).alias("mean_neg"))


# struct

POINTS = "points as (select l_orderkey as entry, l_linenumber as chain, l_quantity as x, l_extendedprice / 1000 as y, l_discount * 100 as z from lineitem)"
DISTANCES = "dist as (select a.entry, a.chain as chain_a, b.chain as chain_b, sqrt(min((a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) + (a.z-b.z)*(a.z-b.z))) as distance from points a join points b on a.entry = b.entry and a.chain < b.chain group by all)"
NEAREST = "near as (select entry, chain, arg_min(other, (distance, other)) as other from (select entry, chain_a as chain, chain_b as other, distance from dist union all select entry, chain_b, chain_a, distance from dist) group by entry, chain)"


def _distances(spark, d):
    return S.min_distances(V.table(spark, d, "lineitem").selectExpr("l_orderkey as entry", "l_linenumber as chain", "l_quantity as x", "l_extendedprice / 1000 as y", "l_discount * 100 as z"))


@query("select entry, count(distinct acc) as n_acc from chains group by entry having count(distinct acc) > 2", [V.CHAINS])
def struct_heterocomplex(spark, d):
    return S.heterocomplexes(V.chains(spark, d))


@query("select entry, chain_a, chain_b, round(distance, 6) as distance from dist", [POINTS, DISTANCES])
def struct_min_distance(spark, d):
    return _distances(spark, d).withColumn("distance", F.round("distance", 6))


@query("select entry, chain, other from near", [POINTS, DISTANCES, NEAREST])
def struct_nearest(spark, d):
    return S.nearest(_distances(spark, d))


@query(
    """select acc_a, acc_b from (select least(ca.acc, cb.acc) as acc_a, greatest(ca.acc, cb.acc) as acc_b, bool_and(distance > 8 and na.other <> d.chain_b and nb.other <> d.chain_a) as apart
    from dist d join near na on na.entry = d.entry and na.chain = d.chain_a join near nb on nb.entry = d.entry and nb.chain = d.chain_b
    join chains ca on ca.entry = d.entry and ca.chain = d.chain_a join chains cb on cb.entry = d.entry and cb.chain = d.chain_b where ca.acc <> cb.acc group by 1, 2) where apart""",
    [POINTS, DISTANCES, NEAREST, V.CHAINS],
)
def struct_noninteracting_all(spark, d):
    return S.never_interacting(_distances(spark, d), V.chains(spark, d))


# score

FSET = "fs as (select distinct residue, feature from features)"
NPMI = """npmi as (select feature_i, feature_j, c as count, case when c < n then ln(c / n * n * n / (ci * cj)) / -ln(c / n) else 1.0 end as npmi from
    (select a.feature as feature_i, b.feature as feature_j, cast(count(*) as double) as c from fs a join fs b on a.residue = b.residue and a.feature < b.feature group by all)
    join (select feature as feature_i, cast(count(*) as double) as ci from fs group by 1) using (feature_i) join (select feature as feature_j, cast(count(*) as double) as cj from fs group by 1) using (feature_j), (select cast(count(distinct residue) as double) as n from fs))"""
SYM = "sym as (select fa, fb, sum(npmi) as npmi from (select feature_i as fa, feature_j as fb, npmi from npmi where npmi > 0 union all select feature_j, feature_i, npmi from npmi where npmi > 0 and feature_i <> feature_j) group by all)"
TOP = "top as (select * from features qualify row_number() over (partition by protein, residue order by magnitude desc, feature) <= 3)"
PAIR_LIST = "pl as (select a.n_name || '-' || b.n_name as pair_id, 'L' || a.n_nationkey as id_a, 'L' || b.n_nationkey as id_b from nation a join nation b on a.n_regionkey = b.n_regionkey and a.n_nationkey < b.n_nationkey)"
RES = "res as (select pair_id, a.residue as ra, b.residue as rb, max(npmi) as value from pl join top a on a.protein = id_a join sym on fa = a.feature join top b on b.protein = id_b and b.feature = fb group by all)"
SCORED = """scored as (select pair_id, id_a, id_b, na, nb, nsel, total, npos from (select pl.*, a.n as na, b.n as nb, least(a.n * b.n, greatest(1, least(70, cast(floor(0.25::double * least(a.n, b.n)) as bigint)))) as nsel from pl
    left join (select protein, count(distinct residue) as n from top group by 1) a on a.protein = id_a left join (select protein, count(distinct residue) as n from top group by 1) b on b.protein = id_b) z
    left join lateral (select sum(value) as total, count(*) filter (value > 0) as npos from (select value, row_number() over (order by value desc) as r from res where res.pair_id = z.pair_id) where r <= nsel) on true)"""


def _set(spark, d):
    return V.features(spark, d).select("residue", "feature").distinct()


def _associations(spark, d):
    return N.symmetric(N.association_table(_set(spark, d)))


def _pair_list(spark, d):
    n = V.table(spark, d, "nation")
    a, b = n.select(F.col("n_nationkey").alias("ka"), F.col("n_name").alias("na"), "n_regionkey"), n.select(F.col("n_nationkey").alias("kb"), F.col("n_name").alias("nb"), "n_regionkey")
    return a.join(b, "n_regionkey").where("ka < kb").selectExpr("na || '-' || nb as pair_id", "'L' || ka as id_a", "'L' || kb as id_b")


@query("select feature_i, feature_j, cast(count as bigint) as count, round(npmi, 6) as npmi from npmi where npmi > 0", [V.FEATURES, FSET, NPMI])
def score_npmi_table(spark, d):
    return N.association_table(_set(spark, d)).withColumn("npmi", F.round("npmi", 6))


@query("select fa, fb, round(npmi, 6) as npmi from sym", [V.FEATURES, FSET, NPMI, SYM])
def score_symmetrise(spark, d):
    return _associations(spark, d).withColumn("npmi", F.round("npmi", 6))


@query("select protein, residue, feature, magnitude from top", [V.FEATURES, TOP])
def score_topk_features(spark, d):
    return N.top_features(V.features(spark, d))


@query("select pair_id, ra, rb, round(value, 6) as value from res", [V.FEATURES, FSET, NPMI, SYM, TOP, PAIR_LIST, RES])
def score_residue_max(spark, d):
    return N.residue_scores(_pair_list(spark, d), N.top_features(V.features(spark, d)), _associations(spark, d)).withColumn("value", F.round("value", 6))


SCORE = [V.FEATURES, FSET, NPMI, SYM, TOP, PAIR_LIST, RES, SCORED]


def _scored(spark, d):
    return N.score_pairs(_pair_list(spark, d), N.top_features(V.features(spark, d)), _associations(spark, d))


@query("select pair_id, id_a, id_b, round(coalesce(total, 0) / nsel, 6) as score, na as n_active_a, nb as n_active_b, nsel as n_selected, coalesce(npos, 0) as n_positive from scored where na is not null and nb is not null", SCORE)
def score_pairs(spark, d):
    return _scored(spark, d).where("status = 'ok'").withColumn("score", F.round("score", 6)).drop("status")


@query("select pair_id, case when na is null then 'missing_features_a' when nb is null then 'missing_features_b' else 'ok' end as status from scored", SCORE)
def score_missing_status(spark, d):
    return _scored(spark, d).select("pair_id", "status")


@query("select feature_i as fa, feature_j as fb from npmi where npmi > 0 and count > 3 union select feature_j, feature_i from npmi where npmi > 0 and count > 3", [V.FEATURES, FSET, NPMI])
def score_min_count(spark, d):
    return N.symmetric(N.association_table(_set(spark, d)), 3).select("fa", "fb")


@query("select residue, feature, round(magnitude * idf / mx, 6) as magnitude from features join (select feature, max(magnitude) as mx, ln(500.0::double / count(*)) as idf from features group by feature) using (feature) where magnitude * idf / mx > 0.5", [V.FEATURES])
def score_active_features(spark, d):
    rows = V.features(spark, d)
    stats = rows.groupBy("feature").agg(F.max("magnitude").alias("max"), F.log(F.lit(500.0) / F.count("*")).alias("idf"))
    return N.active(rows.withColumnRenamed("magnitude", "raw"), stats).select("residue", "feature", F.round("magnitude", 6).alias("magnitude"))


# log

KEYS, ORDER = ["user_id", "event_type"], ["ts", "event_id"]
LAST = "select user_id, event_type, arg_max(event_id, {order}) as event_id, arg_max(ok, {order}) as ok from log group by user_id, event_type"


@query(LAST.format(order="(ts, event_id)"), [V.LOG])
def log_latest(spark, d):
    return G.latest(V.log(spark, d), KEYS, ORDER).select(*KEYS, "event_id", "ok")


@query("select user_id, event_type, arg_min(event_id, (ts, event_id)) as event_id from log group by user_id, event_type", [V.LOG])
def log_first(spark, d):
    return G.first(V.log(spark, d), KEYS, ORDER).select(*KEYS, "event_id")


@query(f"select user_id, event_type from ({LAST.format(order='(ts, event_id)')}) where not ok", [V.LOG])
def log_failed(spark, d):
    return G.failed(V.log(spark, d), KEYS, ORDER, F.col("ok"))


@query(LAST.format(order="(ok, ts, event_id)"), [V.LOG])
def log_merge_runs(spark, d):
    return G.merge_runs(V.log(spark, d), KEYS, ORDER, F.col("ok")).select(*KEYS, "event_id", "ok")


@query(
    """select u as custom_id, least(a, b) as norm_a, greatest(a, b) as norm_b, string_agg(distinct run, '+' order by run) as seen_in, count(distinct event_type) as n_excerpts, max(value) filter (run = 'x') as conf_x
    from (select user_id as u, 'n' || (event_id % 5) as a, 'n' || (event_id % 3) as b, * from log) group by all""",
    [V.LOG],
)
def log_run_union(spark, d):
    rows = V.log(spark, d).selectExpr("run", "event_id as ordinal", "user_id as custom_id", "'n' || (event_id % 5) as norm_a", "'n' || (event_id % 3) as norm_b", "'N' || event_id as name_a", "'M' || event_id as name_b", "array(event_type) as excerpts", "value as confidence")
    once = rows.groupBy("run", "custom_id", F.least("norm_a", "norm_b").alias("norm_a"), F.greatest("norm_a", "norm_b").alias("norm_b")).agg(
        F.min("ordinal").alias("ordinal"), F.min_by("name_a", "ordinal").alias("name_a"), F.min_by("name_b", "ordinal").alias("name_b"), F.array_distinct(F.flatten(F.collect_list("excerpts"))).alias("excerpts"), F.max("confidence").alias("confidence"))
    out = G.union_runs(once)
    return out.select("custom_id", "norm_a", "norm_b", "seen_in", F.size("excerpts").cast("long").alias("n_excerpts"), F.try_element_at("confidence", F.lit("x")).alias("conf_x"))


VERDICTS = "v as (select *, value > 50 and event_type <> 'view' as usable from log)"


def _verdicts(spark, d):
    return V.log(spark, d).withColumn("usable", F.expr("value > 50 and event_type <> 'view'"))


@query("select user_id, event_type, arg_min(event_id, (usable, ts, event_id)) as event_id, arg_min(usable, (usable, ts, event_id)) as usable, count(*) - 1 as n_dropped from v group by user_id, event_type", [V.LOG, VERDICTS])
def log_verdict_dedup(spark, d):
    return G.dedup_verdicts(_verdicts(spark, d), KEYS, "usable", ORDER).select(*KEYS, "event_id", "usable", "n_dropped")


@query("select event_type || '|' || (event_id % 40) as pair, count(distinct user_id) filter (usable) as n_for, count(distinct user_id) filter (not usable) as n_against, string_agg(distinct cast(user_id as varchar), ',' order by cast(user_id as varchar)) filter (usable) as papers from v group by 1 having n_for > 0", [V.LOG, VERDICTS])
def log_collect_usable(spark, d):
    return G.collect_usable(_verdicts(spark, d).selectExpr("event_type || '|' || (event_id % 40) as pair", "cast(user_id as string) as paper", "usable"))


# text

CUE = "(idiot|password|AKIA|License|licensed)"
CUED = f"cued as (select *, regexp_matches(text, '{CUE}') as cue from blocks)"


def _blocks(spark, d):
    return X.blocks(V.table(spark, d, "documents").select("doc_id", "text"))


@query("select doc_id, cast(block_index as int) as block_index, text from blocks", [V.BLOCKS])
def text_blocks(spark, d):
    return _blocks(spark, d)


@query("select conv_id, string_agg(text, chr(10) || chr(10) order by turn, text) as text from conversations group by conv_id")
def text_ordered_concat(spark, d):
    return X.ordered_concat(V.table(spark, d, "conversations").select("conv_id", "turn", "text"), "conv_id", "turn")


@query("select doc_id, cast(block_index as int) as block_index from cued where cue", [V.BLOCKS, CUED])
def text_cue_blocks(spark, d):
    return X.with_cue(_blocks(spark, d), CUE).where("cue").select("doc_id", "block_index")


@query("select distinct a.doc_id, cast(a.block_index as int) as block_index from cued a join cued b on a.doc_id = b.doc_id and abs(a.block_index - b.block_index) <= 1 and b.cue", [V.BLOCKS, CUED])
def text_cue_window(spark, d):
    return X.cue_window(X.with_cue(_blocks(spark, d), CUE), "doc_id", "block_index").select("doc_id", "block_index")


@query("select doc_id, cast(block_index as int) as block_index, substring(text, 1, cast(800 - prior as int)) as text from (select *, coalesce(sum(length(text)) over (partition by doc_id order by block_index rows between unbounded preceding and 1 preceding), 0) as prior from blocks) where prior < 800", [V.BLOCKS])
def text_running_budget(spark, d):
    return X.running_budget(_blocks(spark, d), "doc_id", "block_index", 800)


@query("select term, count(*) as n from (select t[i] as term from tk, unnest(range(1, len(t) + 1)) as r(i) union all select t[i] || ' ' || t[i + 1] from tk, unnest(range(1, len(t))) as r(i)) where term in ('the and', 'the', 'of the', 'thou', 'idiot the') group by term", ["tk as (select list_transform(regexp_extract_all(text, '([A-Za-z][A-Za-z0-9.''-]*)', 1), lambda x: lower(x)) as t from documents where text is not null)"])
def text_bigram_terms(spark, d):
    terms = spark.createDataFrame([(t,) for t in ("the and", "the", "of the", "thou", "idiot the")], "term string")
    return X.grams(V.table(spark, d, "documents").where("text is not null").select("doc_id", "text"), "doc_id").join(F.broadcast(terms), "term").groupBy("term").agg(F.count("*").alias("n"))


@query("select d.doc_id, b.item_id from (select doc_id, lower(regexp_replace(trim(text), '[ \\t\\n\\v\\f\\r]+', ' ', 'g')) as text from documents) d join (select item_id, lower(regexp_replace(trim(text), '[ \\t\\n\\v\\f\\r]+', ' ', 'g')) as text from benchmark) b on contains(d.text, b.text)")
def text_grounded(spark, d):
    return X.containing(V.table(spark, d, "documents").select("doc_id", "text"), V.table(spark, d, "benchmark").select("item_id", F.col("text").alias("excerpt")), "doc_id", "item_id")


@query("select p_partkey, regexp_replace(lower(trim(p_name)), '[^a-z0-9]', '', 'g') as name_key from part")
def text_name_normalise(spark, d):
    return V.table(spark, d, "part").select("p_partkey", E.name_key("p_name").alias("name_key"))


INDEX_NAMES = "ix as (select distinct 'P' || p_partkey as acc, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') as k from part)"


@query("select name, case when n = 0 then 'unresolved' when n = 1 then 'determined' when n > 50 then 'too_wide' else 'identity_pick' end as outcome, n as n_candidates, case when n = 1 then least else '' end as accession from (select m.name, count(distinct acc) as n, min(acc) as least from (select distinct p_name as name from part union select distinct p_brand from part) m left join ix on k = regexp_replace(lower(m.name), '[^a-z0-9]', '', 'g') group by m.name)", [INDEX_NAMES])
def text_candidates(spark, d):
    part = V.table(spark, d, "part")
    index = X.name_index(part.selectExpr("'P' || p_partkey as acc", "p_name as name"))
    return X.resolve(part.selectExpr("p_name as name").unionByName(part.selectExpr("p_brand as name")), index)


# match

LENGTHS = "lens as (select 'P' || p_partkey as acc, cast(p_size * 20 as bigint) as length from part where p_partkey % 9 <> 0)"
SIZED = "sized as (select e.*, a.length + b.length as combined from edges e left join lens a on a.acc = target left join lens b on b.acc = partner)"


def _sized(spark, d):
    lengths = V.table(spark, d, "part").where("p_partkey % 9 <> 0").selectExpr("'P' || p_partkey as acc", "cast(p_size * 20 as bigint) as length")
    return M.combined_length(V.assembled(spark, d), lengths, "target", "partner")


@query("select target, partner, type, combined from sized", [*V.ASSEMBLED, LENGTHS, SIZED])
def match_combined_length(spark, d):
    return _sized(spark, d).select("target", "partner", "type", "combined")


@query("select target, partner, type from sized where combined <= 1420", [*V.ASSEMBLED, LENGTHS, SIZED])
def match_cap(spark, d):
    return M.within_cap(_sized(spark, d), 1420).select("target", "partner", "type")


@query()
def match_partners_1d(spark, d):
    rows = M.within_cap(_sized(spark, d), 1420).withColumn("size", F.col("combined").cast("double"))
    return M.match_partners(rows.where("sources = 'a'").select("target", "partner", "size"), rows.where("sources = 'b'").select("target", "partner", "size"))


SIDES = """sides as (select target, list_sort(list(combined) filter (sources = 'a')) as a, list_sort(list(combined) filter (sources = 'b')) as b from sized where combined <= 1420 and sources in ('a', 'b') group by target
    having count(*) filter (sources = 'a') > 0 and count(*) filter (sources = 'b') > 0)"""
LADDER = """ladder as (select target, 0 as i, case when len(a) <= len(b) then a else b end as s, case when len(a) <= len(b) then b else a end as l, list_transform(range(0, greatest(len(a), len(b)) + 1), lambda j: 0.0::double) as f from sides
    union all select target, i + 1, s, l, list_transform(range(0, len(l) + 1), lambda j: case when j = 0 then 1e18::double else list_min(list_transform(range(1, j + 1), lambda t: f[t] + abs(s[i + 1] - l[t]))) end) from ladder where i < len(s))"""


@query("select target, cast(i as bigint) as n_matched, f[len(l) + 1] as cost from ladder where i = len(s)", [*V.ASSEMBLED, LENGTHS, SIZED, SIDES, LADDER], recursive=True)
def match_partners_cost(spark, d):
    """The least total difference of each target's matching; the SQL finds it by dynamic programming over sorted sizes."""
    return match_partners_1d(spark, d).groupBy("target").agg(F.count("*").alias("n_matched"), F.sum("difference").alias("cost"))


@query()
def match_global_assignment(spark, d):
    """All targets that clear their arm's floor of target_floors: 8 negatives as reference, 40 positives as candidate."""
    of = lambda kind: F.when(F.col("type") == kind, F.col("combined"))
    sides = {"r": ("negative", 8), "c": ("positive", 40)}
    counted = [f(of(kind)).alias(f"{name}_{s}") for s, (kind, _) in sides.items() for name, f in (("size", lambda x: F.percentile(x, 0.5)), ("n", F.count))]
    arms = _sized(spark, d).where("combined is not null").groupBy("target").agg(*counted)  # both arms at once: the assembled pairs are made once
    arm = lambda s, least: F.when(F.col(f"n_{s}") >= least, F.struct(F.col(f"size_{s}").alias("size"), F.col(f"n_{s}").alias("n"))).alias(s)
    return M.assign_arms(arms.select("target", *(arm(s, least) for s, (_, least) in sides.items())))


ARMS = "arms as (select target, count(*) filter (type = 'negative') >= 8 as r, count(*) filter (type = 'positive') >= 40 as c from sized where combined is not null group by target)"


@query(
    """select 'paired' as mode, target as candidate, count(*) as n from arms where r and c group by target union all
    select 'substituted', '', least(count(*) filter (r and not c), count(*) filter (c and not r)) as n from arms having n > 0""",
    [*V.ASSEMBLED, LENGTHS, SIZED, ARMS],
)
def match_global_modes(spark, d):
    """Which targets the global assignment pairs with themselves, and how many get a substitute of their own."""
    found = match_global_assignment(spark, d)
    paired = F.col("mode") == "paired"
    return found.groupBy("mode", F.when(paired & (F.col("reference") == F.col("candidate")), F.col("candidate")).otherwise("").alias("candidate")).agg(F.count_distinct("candidate").alias("n"))


@query("select target, type, count(*) as n_pairs, round(median(combined), 4) as median_length from sized group by target, type", [*V.ASSEMBLED, LENGTHS, SIZED])
def match_report(spark, d):
    return reports.medians(_sized(spark, d), ["target", "type"], "combined").withColumn("median_length", F.round("median_length", 4))


@query("select round(max(abs(ca / na - cb / nb)), 9) as d, cast(max(na) as bigint) as n_first, cast(max(nb) as bigint) as n_second from (select sum(a) over (order by combined) as ca, sum(b) over (order by combined) as cb, sum(a) over () as na, sum(b) over () as nb from (select combined, cast(count(*) filter (type = 'positive') as double) as a, cast(count(*) filter (type <> 'positive') as double) as b from sized where combined is not null group by combined))", [*V.ASSEMBLED, LENGTHS, SIZED])
def match_ks(spark, d):
    return M.ks_distance(_sized(spark, d), "combined", "type = 'positive'").withColumn("d", F.round("d", 9))


@query("select type, count(*) as n, round(avg(combined), 4) as mean, round(median(combined), 4) as median, min(combined) as least, max(combined) as greatest from (select distinct type, least(target, partner) as a, greatest(target, partner) as b, combined from sized) group by type", [*V.ASSEMBLED, LENGTHS, SIZED])
def match_arm_summary(spark, d):
    return M.arm_summary(_sized(spark, d), ["type"], "combined").withColumns({c: F.round(c, 4) for c in ("mean", "median")})


@query(
    """select 'over_cap' as rule, count(*) as n from sized where sources = 'a' and coalesce(combined > 1420, true) union all
    select 'shared', count(*) from sized s where sources = 'a' and exists (select 1 from sized o where o.sources = 'b' and o.target = s.target and o.partner = s.partner) union all
    select 'under_floor', count(*) from (select target from sized where sources = 'a' group by target having count(*) filter (type = 'positive') < 2 or count(*) filter (type = 'negative') < 0)""",
    [*V.ASSEMBLED, LENGTHS, SIZED],
)
def match_assertions(spark, d):
    rows = _sized(spark, d)
    return M.arm_violations(rows.where("sources = 'a'"), rows.where("sources = 'b'").select("target", "partner"), 1420, 2, 0)


# misc


@query("select date_trunc('quarter', ts)::date as window_start, (date_trunc('quarter', ts) + interval 3 month - interval 1 day)::date as window_end, count(*) as n from events group by 1, 2")
def misc_calendar_windows(spark, d):
    return V.table(spark, d, "events").withColumn("w", reports.window_of("ts")).groupBy(F.col("w.first").alias("window_start"), F.col("w.last").alias("window_end")).agg(F.count("*").alias("n"))


@query("select event_type, count(*) as n, round(count(*) / sum(count(*)) over (), 9) as share from events group by event_type")
def misc_value_counts(spark, d):
    return reports.value_counts(V.table(spark, d, "events"), "event_type").withColumn("share", F.round("share", 9))


@query("select conv_id, turn, substring(sha1(cast(conv_id as varchar) || chr(0) || text), 1, 10) as id from conversations where text is not null")
def misc_stable_ids(spark, d):
    return V.table(spark, d, "conversations").where("text is not null").select("conv_id", "turn", E.stable_id(F.col("conv_id").cast("string"), "text").alias("id"))


@query("select min(doc_id) as doc_id, count(*) as n, string_agg(cast(doc_id as varchar), ',' order by doc_id) as members from documents where text is not null group by text having count(*) > 1")
def misc_exact_text_collapse(spark, d):
    return reports.exact_copies(V.table(spark, d, "documents"), "doc_id", "text").withColumn("members", F.array_join("members", ","))


@query("select acc_a, acc_b, ordinal, round(area, 4) as area from (select *, row_number() over (partition by acc_a, acc_b order by area desc, ordinal) as r from (select least(acc_a, acc_b) as acc_a, greatest(acc_a, acc_b) as acc_b, area, ordinal from iface)) where r <= 1", [V.IFACE])
def misc_topk_per_pair(spark, d):
    rows = V.iface(spark, d).select(F.least("acc_a", "acc_b").alias("acc_a"), F.greatest("acc_a", "acc_b").alias("acc_b"), "area", "ordinal")
    return P.top_k(rows, ["acc_a", "acc_b"], [F.col("area").desc_nulls_last(), F.col("ordinal")], 1).withColumn("area", F.round("area", 4))


from . import literature  # noqa: E402  (registers beside the queries above)

QUERIES |= literature.QUERIES
ORACLE_SQL |= literature.ORACLE_SQL
