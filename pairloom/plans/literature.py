"""Queries of the literature half: names, papers, chains, verdicts. Registered beside those of `catalogue`."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as E
from ..functions import cues, names
from ..operators import assemble as A
from ..operators import chains as C
from ..operators import matching as M
from ..operators import papers as R
from ..operators import reports
from ..operators import texts as X
from ..sources import sinks
from . import views as V

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, using: list[str] | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = (f"with {', '.join(using)} " if using else "") + sql
        return f

    return register


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


# chains

SEVERAL = "several as (select l_orderkey as entry, l_linenumber % 3 as chain, l_linenumber * 1000000000::bigint + l_partkey as ordinal, 'P' || l_partkey as acc from lineitem)"
UNIQUE = "uniq as (select entry, chain, min(acc) as acc from several group by entry, chain having count(distinct acc) = 1)"


def _several(spark, d):
    return V.table(spark, d, "lineitem").selectExpr("l_orderkey as entry", "l_linenumber % 3 as chain", "l_linenumber * 1000000000L + l_partkey as ordinal", "'P' || l_partkey as acc")


@query("select entry, chain, acc from uniq", [SEVERAL, UNIQUE])
def chain_unique(spark, d):
    return C.unique_accession(_several(spark, d))


@query("select entry, chain, arg_max(acc, ordinal) as acc from several group by entry, chain", [SEVERAL])
def chain_last(spark, d):
    return C.last_accession(_several(spark, d))


@query("select a.entry, a.chain as chain_a, b.chain as chain_b, a.acc as acc_a, b.acc as acc_b from uniq a join uniq b on a.entry = b.entry and a.chain = 0 and b.chain = 1 and a.acc <> b.acc", [SEVERAL, UNIQUE])
def chain_pairs(spark, d):
    rows = _several(spark, d)
    pairs = rows.select("entry", F.lit(0).alias("chain_a"), F.lit(1).alias("chain_b")).distinct()
    return C.mapped_pairs(pairs, C.unique_accession(rows)).select("entry", "chain_a", "chain_b", "acc_a", "acc_b")


@query("select distinct 'P' || p_partkey as query, u.entry, u.chain, u.acc from part join uniq u on cast(substring(u.acc, 2) as bigint) % 97 = p_partkey % 97 where p_size / 50.0 > 0.9", [SEVERAL, UNIQUE])
def chain_hits(spark, d):
    chains = C.unique_accession(_several(spark, d))
    hits = V.table(spark, d, "part").where("p_size / 50.0 > 0.9").selectExpr("'P' || p_partkey as query", "'R' || p_partkey % 97 as target")
    return C.hits_to_chains(hits, chains.selectExpr("'R' || cast(substring(acc, 2) as bigint) % 97 as representative", "entry", "chain"), chains)


@query("select acc, string_agg(distinct entry, ',' order by entry) as entries from several group by acc", [SEVERAL])
def chain_sources(spark, d):
    return C.sources_of(_several(spark, d)).withColumn("entries", F.array_join("entries", ","))


@query("select distinct least(acc_a, acc_b) as acc_a, greatest(acc_a, acc_b) as acc_b from iface where contacts >= 45", [V.IFACE])
def pair_any_row(spark, d):
    return C.any_row(V.iface(spark, d), "contacts >= 45")


@query("select acc_a, acc_b, ordinal from iface where contacts >= 10 and fa = fb", [V.IFACE])
def assemble_kept(spark, d):
    return A.kept(A.first_reason(V.iface(spark, d), {"few_contacts": "contacts < 10", "contradicted": "fa <> fb"})).select("acc_a", "acc_b", "ordinal")


@query("select acc_a, acc_b, ordinal from iface where contains(fa || label, 'AF')", [V.IFACE])
def pair_label_contains(spark, d):
    return V.iface(spark, d).where(F.contains(F.concat("fa", "label"), F.lit("AF"))).select("acc_a", "acc_b", "ordinal")


# papers


@query("select o_custkey as paper, arg_min(o_orderstatus, o_orderkey) as status, string_agg(distinct o_orderpriority, ';' order by o_orderpriority) as matched_queries, cast(count(distinct o_orderpriority) as int) as n_queries from orders group by o_custkey")
def paper_sweep(spark, d):
    rows = V.table(spark, d, "orders").selectExpr("o_custkey as paper", "o_orderpriority as query", "o_orderkey as ordinal", "o_orderstatus as status")
    return R.sweep(rows, "paper", "query", "ordinal")


PAPERS = """papers as (select case when o_custkey % 3 = 0 then '' else 'PMC' || o_custkey end as pmcid, case when o_custkey % 7 = 0 then ' ' else cast(o_custkey as varchar) end as pmid,
    case when o_orderstatus = 'P' then 'Retracted Publication' else 'Article' end as pub_types, o_orderkey % 10 <> 0 as has_abstract, o_orderpriority || ';' || o_orderstatus as matched_queries, o_orderkey as ordinal from orders),
    good as (select *, case when trim(pmcid) <> '' then trim(pmcid) else trim(pmid) end as paper_id from papers where has_abstract and pub_types = 'Article' and trim(pmcid) || trim(pmid) <> '')"""


@query("select paper_id, arg_min(pmid, ordinal) as pmid, string_agg(distinct q, ';' order by q) as matched_queries, cast(count(distinct q) as int) as n_queries from (select paper_id, pmid, ordinal, unnest(string_split(matched_queries, ';')) as q from good) group by paper_id", [PAPERS])
def paper_usable(spark, d):
    rows = V.table(spark, d, "orders").selectExpr(
        "case when o_custkey % 3 = 0 then '' else 'PMC' || o_custkey end as pmcid", "case when o_custkey % 7 = 0 then ' ' else cast(o_custkey as string) end as pmid",
        "case when o_orderstatus = 'P' then 'Retracted Publication' else 'Article' end as pub_types", "o_orderkey % 10 <> 0 as has_abstract", "o_orderpriority || ';' || o_orderstatus as matched_queries", "o_orderkey as ordinal",
    )
    return R.usable_papers(rows, "ordinal").select("paper_id", "pmid", "matched_queries", "n_queries")


@query("select conv_id, turn, role from conversations where role <> 'system' and role in ('user', 'system')")
def paper_level(spark, d):
    return R.at_level(V.table(spark, d, "conversations"), ["user", "system"], ["system"], "role").select("conv_id", "turn", "role")


SIDES = """listed as (select user_id as paper_id, event_id as pair, event_id as o, side, case when side = 0 then event_type else 'n' || (event_id % 5) end as name, e from
    (select *, unnest([0, 1]) as side from events), lateral (select unnest(['x' || (event_id % 4), event_type]) as e)),
    firsts as (select paper_id, name, e, min(o * 100 + side * 10 + case when e like 'x%' then 0 else 1 end) as place from listed group by all)"""


@query("select paper_id, name, n_pairs, first_pair, excerpts from (select paper_id, name, count(distinct (pair, side)) as n_pairs, min(pair) as first_pair from listed group by all) join (select paper_id, name, string_agg(e, ',' order by place) as excerpts from firsts group by all) using (paper_id, name)", [SIDES])
def paper_sides(spark, d):
    rows = V.table(spark, d, "events").selectExpr("user_id as paper_id", "event_id as pair", "event_id as ordinal", "event_type as name_a", "'n' || (event_id % 5) as name_b", "array('x' || (event_id % 4), event_type) as excerpts")
    return R.sides(rows).withColumn("excerpts", F.array_join("excerpts", ","))


@query("select doc_id as paper_id, n, first_type, least(length(text), 2000) + case when length(text) > 2000 then 6 else 0 end as n_text from documents join (select user_id as doc_id, cast(count(*) as int) as n, arg_min(event_type, event_id) as first_type from events group by user_id) using (doc_id) where trim(text) <> ''")
def paper_packets(spark, d):
    pairs = V.table(spark, d, "events").selectExpr("user_id as paper_id", "event_id as ordinal", "event_type")
    out = R.packets(pairs, V.table(spark, d, "documents").selectExpr("doc_id as paper_id", "text"), 2000)
    return out.select("paper_id", F.size("pairs").alias("n"), F.col("pairs")[0]["event_type"].alias("first_type"), F.char_length("text").cast("long").alias("n_text"))


@query("select event_type as model, round(sum((event_id % 1000 + 1.25 * (event_id % 10) + 0.1 * (event_id % 100)) * 3 / 1e6 + event_id % 50 * 15 / 1e6), 6) as cost from events where event_type <> 'view' group by event_type")
def paper_cost(spark, d):
    usage = V.table(spark, d, "events").selectExpr("event_type as model", "event_id % 1000 as input_tokens", "event_id % 10 as cache_creation_input_tokens", "event_id % 100 as cache_read_input_tokens", "event_id % 50 as output_tokens")
    rates = usage.where("model <> 'view'").select("model", F.lit(3.0).alias("input_rate"), F.lit(15.0).alias("output_rate")).distinct()
    return R.cost(usage, rates).where("cost is not null").groupBy("model").agg(F.round(F.sum("cost"), 6).alias("cost"))


@query("select conv_id, string_agg(i || '. ' || role, chr(10) order by i) as text from (select conv_id, role, row_number() over (partition by conv_id order by turn, role) as i from conversations) group by conv_id")
def paper_numbered_list(spark, d):
    roles = V.table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("r"))
    return roles.select("conv_id", R.numbered(F.transform("r", lambda x: x["role"])).alias("text"))


VERDICTS = "verdicts as (select event_id as paper_id, 'p' || (event_id % 3) as pair, case when event_id % 4 = 0 then 'ungrounded' else 'judged' end as curation_outcome from events where event_id % 2 = 0)"


@query(
    "select p.paper_id, p.pair, case when a = b then 'self_pair' when curation_outcome is not null then curation_outcome when p.paper_id % 5 <> 0 then 'no_answer' else 'not_judged' end as outcome from (select event_id as paper_id, 'p' || (event_id % 3) as pair, event_id % 7 as a, event_id % 6 as b from events) p left join verdicts v on v.paper_id = p.paper_id and v.pair = p.pair",
    [VERDICTS],
)
def paper_verdicts(spark, d):
    events = V.table(spark, d, "events")
    pairs = events.selectExpr("event_id as paper_id", "'p' || (event_id % 3) as pair", "cast(event_id % 7 as string) as accession_a", "cast(event_id % 6 as string) as accession_b")
    verdicts = events.where("event_id % 2 = 0").selectExpr("event_id as paper_id", "'p' || (event_id % 3) as pair", "if(event_id % 4 = 0, 'ungrounded', 'judged') as curation_outcome")
    return R.apply_verdicts(pairs, R.unique_by(verdicts, ["paper_id", "pair"]), events.where("event_id % 5 <> 0").selectExpr("event_id as paper_id")).select("paper_id", "pair", "outcome")


@query("select doc_id as paper_id, case when doc_id % 3 = 0 then false when text is null then false else true end as grounded, case when doc_id % 3 <> 0 and text is not null then 'judged' else 'ungrounded' end as curation_outcome from documents where regexp_full_match(text, '[A-Za-z0-9 .,;:!?'']+') and length(trim(text)) > 60")
def paper_grounded(spark, d):
    docs = V.table(spark, d, "documents").where("text rlike '^[A-Za-z0-9 .,;:!?\\']+$' and length(trim(text)) > 60").selectExpr("doc_id as paper_id", "text")
    verdicts = docs.selectExpr("paper_id", "if(paper_id % 3 = 0, 'a sentence that no document holds at all', upper(substring(trim(text), 6, 50))) as evidence_sentence", "'non_interaction' as relationship")
    return R.ground_verdicts(verdicts, docs).select("paper_id", "grounded", "curation_outcome")


@query("select p_partkey as paper_id, case when p_size % 3 = 0 and p_size % 4 <> 3 then 'model_picked' when p_size % 3 = 2 then 'determined_by_name' else 'identity_pick' end as outcome, case when p_size % 3 = 0 and p_size % 4 <> 3 then 'A' || (p_size % 4) when p_size % 3 = 2 then 'A0' else '' end as accession from part where p_size % 3 <> 1")
def paper_picks(spark, d):
    part = V.table(spark, d, "part").where("p_size % 3 <> 1")
    rows = part.selectExpr("p_partkey as paper_id", "p_name as name", "if(p_size % 3 = 2, 'determined_by_name', 'identity_pick') as outcome", "if(p_size % 3 = 2, 'A0', '') as accession", "array('A0', 'A1', 'A2') as candidates")
    picks = part.selectExpr("p_partkey as paper_id", "p_name as name", "'A' || (p_size % 4) as picked")
    return R.apply_picks(rows, picks).select("paper_id", "outcome", "accession")


# names

WRITTEN = ["p_name", "p_name || ' (1-214)'", "'GST-' || p_name", "'p27T187A'", "'S100A9'", "p_brand || ' T294A'", "p_name || ' mutant'", "'VPS33B'", "p_name || ' residues 4-19'", "'Δ' || p_name"]
_CASE = "case p_partkey % 10 " + " ".join(f"when {i} then {x}" for i, x in enumerate(WRITTEN)) + " end"
_RE2 = [p.replace("(?<=[0-9a-z])", "[0-9a-z]") for p in names.CONSTRUCT]


@query(f"select p_partkey, name, {' or '.join(f'regexp_matches(name, {chr(39)}{_quoted(p)}{chr(39)})' for p in _RE2)} or regexp_matches(name, '(^|[\\s‐-―-])[A-Z]\\d{{2,}}[A-Z]([\\s‐-―-]|$)') as construct from (select p_partkey, {_CASE} as name from part)")
def name_construct(spark, d):
    return V.table(spark, d, "part").selectExpr("p_partkey", f"{_CASE} as name").withColumn("construct", names.is_construct("name"))


@query("select p_partkey, regexp_replace(lower(name), '[^a-z0-9]', '', 'g') in ('gst', 'brand13') or regexp_matches(name, '^[A-Z][a-z]?\\d*[+-]+$') as reagent from (select p_partkey, case p_partkey % 4 when 0 then 'GST' when 1 then 'Ca2+' when 2 then p_brand else p_name end as name from part)")
def name_reagent(spark, d):
    rows = V.table(spark, d, "part").selectExpr("p_partkey", "case p_partkey % 4 when 0 then 'GST' when 1 then 'Ca2+' when 2 then p_brand else p_name end as name")
    return rows.select("p_partkey", names.is_reagent("name", ["gst", "brand13"]).alias("reagent"))


@query(
    r"select p_partkey, trim(split_part(o, ' (', 1)) as scientific, array_to_string(list_filter(list_transform(regexp_extract_all(o, '\(([^()]+)\)', 1), lambda x: trim(x)), lambda x: x <> '' and not regexp_matches(x, '(?i)\b(strain|isolate|serotype|subsp|var)\b') and len(regexp_split_to_array(x, '\s+')) <= 2), ',') as commons from (select p_partkey, p_name || ' (' || p_brand || ') (strain ' || p_size || ') (one two three) ( ' || p_type || ')' as o from part)"
)
def name_organism(spark, d):
    rows = V.table(spark, d, "part").selectExpr("p_partkey", "p_name || ' (' || p_brand || ') (strain ' || p_size || ') (one two three) ( ' || p_type || ')' as o")
    return rows.withColumn("s", names.organism_parts("o")).select("p_partkey", "s.scientific", F.array_join("s.commons", ",").alias("commons"))


PREFIXED = "case p_partkey % 6 when 0 then 'hRAB' || p_size when 1 then 'AtCGL' || p_size when 2 then 'Rab' || p_size || 'p' when 3 then 'ZzABC' when 4 then 'hR' else p_name end"


@query(f"select p_partkey, case when regexp_matches(n, '^.{{2,}}[A-Za-z0-9]p$') then 'yeast_p_suffix' when regexp_matches(n, '^At[A-Z0-9].{{2,}}$') then 'two_letter' when regexp_matches(n, '^h[A-Z].{{2,}}$') then 'one_letter' end as rule, case when regexp_matches(n, '^.{{2,}}[A-Za-z0-9]p$') then substring(n, 1, length(n) - 1) when regexp_matches(n, '^At[A-Z0-9].{{2,}}$') then substring(n, 3) when regexp_matches(n, '^h[A-Z].{{2,}}$') then substring(n, 2) end as rest from (select p_partkey, {PREFIXED} as n from part)")
def name_species_prefix(spark, d):
    taxa = lambda *pairs: F.create_map(*(F.lit(x) if isinstance(x, str) else F.array(F.lit(x)) for p in pairs for x in p))
    found = names.species_prefix("n", taxa(("at", 3702), ("sc", 4932)), taxa(("h", 9606), ("y", 4932)))
    return V.table(spark, d, "part").selectExpr("p_partkey", f"{PREFIXED} as n").withColumn("s", found).select("p_partkey", "s.rule", "s.rest")


OUTCOMES = list(names.STATUS)
_STATUS_SQL = lambda c: f"case when {c} < 3 then 0 when {c} < 5 then 1 else 2 end"


@query(f"select p_partkey, ['resolved', 'needs_model_pick', 'needs_curation'][1 + greatest({_STATUS_SQL('p_partkey % 7')}, {_STATUS_SQL('p_size % 7')})] as status from part")
def name_status(spark, d):
    outcome = lambda c: F.get(F.array(*map(F.lit, OUTCOMES)), F.expr(f"cast({c} % 7 as int)"))
    rows = V.table(spark, d, "part").withColumns({"a": outcome("p_partkey"), "b": outcome("p_size")})
    return rows.select("p_partkey", names.pair_status("a", "b").alias("status"))


CARDS = "cards as (select 'P' || p_partkey as acc, regexp_replace(lower(p_brand), '[^a-z0-9]', '', 'g') as k, case when p_size % 5 = 0 then '' else 'S' || (p_size % 2) end as stem, p_partkey % 2 = 0 as is_viral from part where p_retailprice > 1000)"
SETTLED = "case when n = 0 then 'unresolved' when n = 1 then '{0}' when n > 50 then 'too_wide' when g = 1 then 'species_pick' else 'identity_pick' end as outcome, n as n_candidates, g as n_groups, case when n = 1 then least else '' end as accession, coalesce(v, false) as viral"
AGGREGATED = "count(distinct acc) as n, count(distinct case when stem = '' then acc else stem || '|' end) as g, min(acc) as least, bool_and(is_viral) as v"


def _cards(spark, d):
    part = V.table(spark, d, "part").where("p_retailprice > 1000")
    cards = part.selectExpr("'P' || p_partkey as acc", "if(p_size % 5 = 0, '', 'S' || (p_size % 2)) as stem", "p_partkey % 2 = 0 as is_viral")
    return X.name_index(part.selectExpr("'P' || p_partkey as acc", "p_brand as name")), cards


def _mentions(spark, d):
    part = V.table(spark, d, "part")
    return part.selectExpr("p_brand as name").unionByName(part.selectExpr("p_type as name")).distinct()


NAMED = f"named as (select m.name, {AGGREGATED} from (select distinct p_brand as name from part union select distinct p_type from part) m left join cards on k = regexp_replace(lower(m.name), '[^a-z0-9]', '', 'g') group by m.name)"


@query(f"select name, {SETTLED.format('determined_by_name')} from named", [CARDS, NAMED])
def name_resolve(spark, d):
    return R.resolve_sides(_mentions(spark, d), *_cards(spark, d)).drop("candidates")


@query("select distinct l_orderkey as paper_id from lineitem join part on p_partkey = l_partkey join named on name in (p_brand, p_type) where n <> 1", [CARDS, NAMED])
def name_wanted_papers(spark, d):
    lines = V.table(spark, d, "lineitem").select("l_orderkey", "l_partkey").join(V.table(spark, d, "part"), F.expr("p_partkey = l_partkey"))
    return R.wanted_papers(lines.selectExpr("l_orderkey as paper_id", "p_brand as name_a", "p_type as name_b"), R.resolve_sides(_mentions(spark, d), *_cards(spark, d)))


TEXT_EVIDENCE = """sides as (select distinct l_suppkey as paper_id, p_brand as name from lineitem join part on p_partkey = l_partkey),
    evidence as (select s_suppkey as paper_id, cast(null as varchar) as name, 2 as p, cast(s_nationkey as bigint) as taxon from supplier union all select s_suppkey, 'Brand#11', 0, 3 from supplier union all select s_suppkey, 'Brand#22', 1, 99 from supplier),
    cands as (select paper_id, name, acc, stem, is_viral, cast(substring(acc, 2) as bigint) % 25 as taxon from sides left join cards on k = regexp_replace(lower(name), '[^a-z0-9]', '', 'g')),
    hits as (select c.*, e.p from cands c join evidence e on e.paper_id = c.paper_id and e.taxon = c.taxon and (e.name is null or e.name = c.name)),
    best as (select paper_id, name, min(p) as best from hits group by all),
    kept as (select distinct paper_id, name, acc, stem, is_viral, best from cands left join best using (paper_id, name) where best is null or (paper_id, name, acc, best) in (select (paper_id, name, acc, p) from hits))"""


@query(f"select paper_id, name, {SETTLED.format('determined_by_text')}, case when best is null then '' else ['definition', 'prefix', 'paper_scan'][best + 1] end as species_source from (select paper_id, name, best, {AGGREGATED} from kept group by all)", [CARDS, TEXT_EVIDENCE])
def name_resolve_with_text(spark, d):
    index, cards = _cards(spark, d)
    lines = V.table(spark, d, "lineitem").select("l_suppkey", "l_partkey").join(V.table(spark, d, "part").select("p_partkey", "p_brand"), F.expr("p_partkey = l_partkey"))
    sides = lines.selectExpr("l_suppkey as paper_id", "p_brand as name").distinct()
    supplier = V.table(spark, d, "supplier")
    parts = [("cast(null as string)", "'paper_scan'", "cast(s_nationkey as long)"), ("'Brand#11'", "'definition'", "3L"), ("'Brand#22'", "'prefix'", "99L")]
    evidence = None
    for name, source, taxon in parts:
        one = supplier.selectExpr("s_suppkey as paper_id", f"{name} as name", f"{source} as source", f"{taxon} as taxon")
        evidence = one if evidence is None else evidence.unionByName(one)
    taxa = cards.selectExpr("acc", "cast(substring(acc, 2) as bigint) % 25 as taxon")
    return R.resolve_with_text(sides, R.resolve_sides(_mentions(spark, d), index, cards), evidence, taxa, cards).drop("candidates")


@query("select p_partkey, regexp_extract(s, '^([OPQ][0-9][A-Z0-9]{3}[0-9]|[A-NR-Z][0-9](?:[A-Z][A-Z0-9]{2}[0-9]){1,2})([^A-Z0-9]|$)', 1) as acc from (select p_partkey, case p_partkey % 4 when 0 then 'P' || (10000 + p_partkey) || '-2' when 1 then 'A0A' || (p_partkey % 10) || 'AB' || 'C1' when 2 then 'Q9' || p_partkey else lower(p_name) end as s from part)")
def name_accession(spark, d):
    return V.table(spark, d, "part").selectExpr("p_partkey", "case p_partkey % 4 when 0 then 'P' || (10000 + p_partkey) || '-2' when 1 then 'A0A' || (p_partkey % 10) || 'AB' || 'C1' when 2 then 'Q9' || p_partkey else lower(p_name) end as s").select("p_partkey", E.accession("s").alias("acc"))


@query()
def name_splits(spark, d):
    """Names of 'main (first (inner)) (EC ..)' fields; checked in the tests against worked examples."""
    rows = V.table(spark, d, "part").selectExpr("p_partkey", "p_name || ' (' || p_brand || ' (inner)) (EC 1.2.3.' || p_size || ')' as field")
    return rows.select("p_partkey", F.posexplode(names.names_of("field")).alias("position", "name"))


@query()
def text_sentences(spark, d):
    docs = V.table(spark, d, "documents").where("text is not null")
    return docs.select("doc_id", F.posexplode(cues.sentences("text")).alias("position", "sentence"))


@query()
def text_cue_families(spark, d):
    return V.table(spark, d, "documents").select("doc_id", F.array_join(cues.cue_families("text"), ",").alias("families"))


@query()
def text_definitions(spark, d):
    rows = V.table(spark, d, "documents").select("doc_id", F.explode(names.definitions_of(F.coalesce("text", F.lit("")))).alias("x"))
    return rows.select("doc_id", "x.short", F.posexplode(names.variants_of("x.long_form")).alias("position", "long_form"))


@query()
def request_chunks(spark, d):
    """Greedy chunks of whole documents; checked in the tests against a plain loop."""
    rows = V.table(spark, d, "documents").select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).alias("size"))
    return sinks.chunked_requests(rows, "doc_id", "size", 200_000, 500, 8)


# the rest


@query("select 'P' || p_partkey as acc, coalesce(case when p_partkey % 3 = 0 then p_size end, case when p_partkey % 4 = 0 then 1000 + p_size end) as length, case when p_partkey % 3 = 0 then 0 when p_partkey % 4 = 0 then 1 end as source from part")
def match_lengths(spark, d):
    part = V.table(spark, d, "part")
    return M.resolved_lengths(part.selectExpr("'P' || p_partkey as acc"), part.where("p_partkey % 3 = 0").selectExpr("'P' || p_partkey as acc", "p_size as length"), part.where("p_partkey % 4 = 0").selectExpr("'P' || p_partkey as acc", "1000 + p_size as length"))


@query("select distinct target from edges e where type = 'positive' and not exists (select 1 from edges n where n.type = 'negative' and n.target = e.target)", V.ASSEMBLED)
def match_outside(spark, d):
    edges = V.assembled(spark, d)
    return M.outside(edges.where("type = 'positive'"), edges.where("type = 'negative'").select("target").distinct(), ["target"])


@query("select o_orderkey, round(o_totalprice, 2) as price from orders order by o_totalprice desc, o_orderkey limit 25")
def misc_head(spark, d):
    rows = V.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return X.head(rows, [F.desc("o_totalprice"), "o_orderkey"], 25).select("o_orderkey", F.round("o_totalprice", 2).alias("price"))


@query("select conv_id, turn, n, sum(n) over (partition by conv_id order by turn, text rows unbounded preceding) - n as first, sum(n) over (partition by conv_id order by turn, text rows unbounded preceding) as last from (select conv_id, turn, text, length(text) as n from conversations where text is not null)")
def misc_offsets(spark, d):
    rows = V.table(spark, d, "conversations").where("text is not null").select("conv_id", F.struct("turn", "text").alias("at"), "turn", F.char_length("text").cast("long").alias("n"))
    return R.running_offsets(rows, "conv_id", "at", "n").select("conv_id", "turn", "n", "first", "last")


@query("select greatest(m, date '1995-02-10') as first, least((m + interval 6 month - interval 1 day)::date, date '1997-11-03') as last from (select unnest(range(date '1995-01-01', date '1997-11-04', interval 6 month))::date as m)")
def misc_windows(spark, d):
    return V.table(spark, d, "region").limit(1).select(F.explode(reports.windows("1995-02-10", "1997-11-03", 6)).alias("w")).select("w.first", "w.last")


SECTION_TITLES = "case p_partkey % 9 when 0 then '2.1 Results and Discussion' when 1 then 'IV. Materials & Methods' when 2 then 'Resulting text' when 3 then 'CONCLUDING REMARKS' when 4 then '3) Background' when 5 then 'Acknowledgements' when 6 then 'Supporting information' when 7 then 'Author contributions' else p_type end"


@query(f"select p_partkey as n, case when p_size = 1 then 'introduction' when p_size = 2 then 'excluded' else case p_partkey % 9 when 0 then 'results_and_discussion' when 1 then 'methods' when 3 then 'conclusion' when 4 then 'introduction' when 5 then 'excluded' when 6 then 'supplementary' when 7 then 'excluded' else 'other' end end as section from part")
def text_sections(spark, d):
    rows = V.table(spark, d, "part").selectExpr("p_partkey as n", f"{SECTION_TITLES} as title", "case p_size when 1 then ' Intro ' when 2 then 'ack' when 3 then 'unknown' end as kind")
    return X.section_kind(rows, "title", "kind").select("n", "section")
