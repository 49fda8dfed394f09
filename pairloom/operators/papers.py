"""Papers, their packets for a reader, and what comes back: sweeps, filters, picks, verdicts, resolution with text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import name_key
from ..functions.names import folded, unescaped

#: Relationships of a verdict that claims nothing, so that it has nothing to quote.
NO_CLAIM = ("not_addressed", "unclear")


def paper_id(pmcid: str, pmid: str) -> Column:
    """The first identifier that is not blank; empty if both are."""
    return F.coalesce(F.nullif(F.trim(pmcid), F.lit("")), F.nullif(F.trim(pmid), F.lit("")), F.lit(""))


def sweep(records: DataFrame, key: str, query: str, order: str) -> DataFrame:
    """One row a key: the first record's columns, and matched_queries and n_queries of all its records."""
    rest = [c for c in records.columns if c not in (key, query, order)]
    out = records.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("r"), F.sort_array(F.collect_set(query)).alias("q"))
    return out.select(key, "r.*", F.array_join("q", ";").alias("matched_queries"), F.size("q").alias("n_queries"))


def usable_papers(papers: DataFrame, order: str, markers: tuple[str, ...] = ("retract", "withdraw")) -> DataFrame:
    """Papers with an abstract and an identifier that are not withdrawn, one row a paper_id.

    papers: pmcid, pmid, pub_types, has_abstract, matched_queries (parts joined by ;) and more. Of rows that share a paper_id the first one in
    `order` stays, with the sorted union of their queries.
    """
    kinds = F.lower(F.coalesce("pub_types", F.lit("")))
    good = papers.where(F.coalesce("has_abstract", F.lit(False))).withColumn("paper_id", paper_id("pmcid", "pmid")).where("paper_id <> ''")
    for marker in markers:
        good = good.where(~F.contains(kinds, F.lit(marker)))
    rest = [c for c in papers.columns if c not in ("matched_queries", "n_queries")]
    queries = F.sort_array(F.array_distinct(F.flatten(F.collect_list(F.split("matched_queries", ";")))))
    out = good.groupBy("paper_id").agg(F.min_by(F.struct(*rest), order).alias("r"), queries.alias("q"))
    return out.select("paper_id", "r.*", F.array_join("q", ";").alias("matched_queries"), F.size("q").alias("n_queries"))


def at_level(blocks: DataFrame, keep: list[str] | None = None, drop: list[str] | None = None, section: str = "section") -> DataFrame:
    """The blocks of an input level: those of the sections to keep (all if none are named) without those to drop."""
    out = blocks if keep is None else blocks.where(F.col(section).isin(keep))
    return out.where(~F.coalesce(F.col(section).isin(drop), F.lit(False))) if drop else out


def sides(pairs: DataFrame, order: str = "ordinal") -> DataFrame:
    """paper_id, name, n_pairs, first_pair, excerpts: both sides of all pairs, one row a paper and name; excerpts once each, in order.

    pairs: paper_id, pair, name_a, name_b, excerpts (array), and the order.
    """
    both = pairs.select("paper_id", "pair", "excerpts", F.col(order).alias("o"), F.posexplode(F.array("name_a", "name_b")).alias("side", "name"))
    listed = F.array_sort(F.collect_list(F.struct("o", "side", "excerpts")))
    return both.groupBy("paper_id", "name").agg(F.count("*").alias("n_pairs"), F.min_by("pair", F.struct("o", "side")).alias("first_pair"), F.array_distinct(F.flatten(F.transform(listed, lambda x: x["excerpts"]))).alias("excerpts"))


def packets(pairs: DataFrame, texts: DataFrame, most: int = 150_000, note: str = "\n[cut]") -> DataFrame:
    """paper_id, pairs (array, in order), text: one packet a paper whose text is not empty; a longer text is cut to `most` characters and says so.

    pairs: paper_id, ordinal, and the columns of the items; texts: paper_id, text.
    """
    items = [c for c in pairs.columns if c not in ("paper_id", "ordinal")]
    listed = pairs.groupBy("paper_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", *items))).alias("x")).select("paper_id", F.transform("x", lambda x: F.struct(*(x[c].alias(c) for c in items))).alias("pairs"))
    cut = F.when(F.char_length("text") > most, F.concat(F.substring("text", 1, most), F.lit(note))).otherwise(F.col("text"))
    return listed.join(texts.where("trim(text) <> ''").select("paper_id", cut.alias("text")), "paper_id")


def numbered(items: Column | str) -> Column:
    """The items as lines '1. item', '2. item'."""
    items = F.col(items) if isinstance(items, str) else items
    return F.array_join(F.transform(items, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")


def cost(usage: DataFrame, rates: DataFrame, write: float = 1.25, read: float = 0.10) -> DataFrame:
    """Adds cost: tokens by the rates (model, input_rate, output_rate: a million tokens); writing and reading the cache weigh as given. Unknown models give null."""
    tokens = lambda c: F.coalesce(F.col(c), F.lit(0))
    billed = tokens("input_tokens") + tokens("cache_creation_input_tokens") * write + tokens("cache_read_input_tokens") * read
    return usage.join(F.broadcast(rates), "model", "left").withColumn("cost", (billed * F.col("input_rate") + tokens("output_tokens") * F.col("output_rate")) / 1e6).drop("input_rate", "output_rate")


def ground_verdicts(verdicts: DataFrame, texts: DataFrame, no_claim: tuple[str, ...] = NO_CLAIM, key: str = "paper_id") -> DataFrame:
    r"""Adds grounded and curation_outcome: whether the quoted sentence, with \uXXXX written out, stands in the folded text that was shown.

    A verdict without a claim may quote nothing. A paper without a text grounds no quotation.
    """
    shown = texts.select(key, folded("text").alias("_text"))
    quote = F.coalesce(unescaped("evidence_sentence"), F.lit(""))
    out = verdicts.withColumn("_quote", quote).join(shown, key, "left").withColumn("_folded", folded("_quote"))
    stands = F.coalesce(F.contains("_text", "_folded"), F.lit(False)) & (F.coalesce("_text", F.lit("")) != "")
    silent = (F.trim("_quote") == "") & F.coalesce(F.col("relationship").isin(list(no_claim)), F.lit(False))
    out = out.withColumn("grounded", silent | stands)
    return out.withColumn("curation_outcome", F.when(F.col("grounded"), "judged").otherwise("ungrounded")).drop("_quote", "_text", "_folded")


def unique_by(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows, or an error that names some keys that occur twice."""
    if twice := rows.groupBy(*keys).count().where("count > 1").limit(3).collect():
        raise ValueError(f"repeated keys: {[tuple(r[k] for k in keys) for r in twice]}")
    return rows


def apply_verdicts(pairs: DataFrame, verdicts: DataFrame, asked: DataFrame) -> DataFrame:
    """Pairs with their verdict and outcome: self_pair, judged (or what the verdict says), no_answer for an asked paper, else not_judged.

    Verdicts must be unique by paper_id and pair (see `unique_by`); asked: paper_id.
    """
    keys = ["paper_id", "pair"]
    rest = [c for c in verdicts.columns if c not in keys]
    joined = pairs.join(verdicts, keys, "left").join(asked.select("paper_id", F.lit(True).alias("_asked")).distinct(), "paper_id", "left")
    outcome = F.when(F.col("accession_a") == F.col("accession_b"), "self_pair").when(F.col("curation_outcome").isNotNull(), F.col("curation_outcome")).when(F.col("_asked"), "no_answer").otherwise("not_judged")
    return joined.withColumn("outcome", outcome).select(*pairs.columns, *rest, "outcome")


def apply_picks(rows: DataFrame, picks: DataFrame) -> DataFrame:
    """rows (paper_id, name, outcome, accession, candidates) with answered picks: only sides that wait for one, and only picks among their candidates."""
    waiting = F.col("outcome").isin("species_pick", "identity_pick")
    joined = rows.join(picks.select("paper_id", "name", "picked"), ["paper_id", "name"], "left")
    taken = waiting & F.coalesce(F.array_contains("candidates", F.col("picked")), F.lit(False))
    return joined.withColumns({"accession": F.when(taken, F.col("picked")).otherwise(F.col("accession")), "outcome": F.when(taken, "model_picked").otherwise(F.col("outcome"))}).select(*rows.columns)


def resolve_sides(mentions: DataFrame, index: DataFrame, cards: DataFrame, too_wide: int = 50) -> DataFrame:
    """name, outcome, n_candidates, n_groups, accession, viral, candidates of each distinct written name, by name alone.

    index: name_key, acc; cards: acc, stem (empty or null: a group of its own), is_viral. Groups are the stems among a name's candidates.
    """
    keyed = mentions.select("name").distinct().withColumn("name_key", name_key("name"))
    carded = index.join(cards, "acc")
    return _classified(keyed.join(carded, "name_key", "left"), ["name"], "determined_by_name", too_wide)


def _classified(rows: DataFrame, by: list[str], settled: str, too_wide: int) -> DataFrame:
    stem = F.coalesce(F.nullif(F.col("stem"), F.lit("")), F.concat(F.lit("\u0000"), "acc"))
    found = rows.groupBy(*by).agg(F.sort_array(F.collect_set("acc")).alias("candidates"), F.count_distinct(stem).alias("n_groups"), F.coalesce(F.bool_and("is_viral"), F.lit(False)).alias("viral"))
    n = F.size("candidates")
    outcome = F.when(n == 0, "unresolved").when(n == 1, settled).when(n > too_wide, "too_wide").when(F.col("n_groups") == 1, "species_pick").otherwise("identity_pick")
    return found.select(*by, outcome.alias("outcome"), n.cast("long").alias("n_candidates"), "n_groups", F.when(n == 1, F.get("candidates", F.lit(0))).otherwise("").alias("accession"), "viral", "candidates")


def wanted_papers(pairs: DataFrame, resolved: DataFrame) -> DataFrame:
    """paper_id: the papers of names that do not have exactly one candidate, whose text is worth a scan."""
    open_ = resolved.where("n_candidates <> 1").select("name")
    return pairs.select("paper_id", F.explode(F.array("name_a", "name_b")).alias("name")).join(open_, "name", "left_semi").select("paper_id").distinct()


def resolve_with_text(sides_: DataFrame, resolved: DataFrame, evidence: DataFrame, taxa: DataFrame, cards: DataFrame, too_wide: int = 50) -> DataFrame:
    """paper_id, name, outcome, n_candidates, n_groups, accession, viral, candidates, species_source: names narrowed by what their paper says.

    sides_: paper_id, name; evidence: paper_id, name (null: the whole paper), source, taxon; taxa: acc, taxon. Sources are tried strongest first
    (definition, prefix, paper_scan); the first that leaves a candidate is taken, and without one the candidates stay as they were.
    """
    place = F.create_map(*(F.lit(x) for i, s in enumerate(("definition", "prefix", "paper_scan")) for x in (s, i)))
    rows = sides_.select("paper_id", "name").distinct().join(resolved.select("name", F.explode_outer("candidates").alias("acc")), "name").join(taxa, "acc", "left")
    own = evidence.where("name is not null").select("paper_id", "name", "taxon", place[F.col("source")].alias("p"))
    all_ = evidence.where("name is null").select("paper_id", "taxon", place[F.col("source")].alias("p"))
    by_own = rows.join(own, ["paper_id", "name", "taxon"]).select("paper_id", "name", "acc", "p")
    by_all = rows.join(all_, ["paper_id", "taxon"]).select("paper_id", "name", "acc", "p")
    hits = by_own.unionByName(by_all).groupBy("paper_id", "name", "acc").agg(F.collect_set("p").alias("ps"))
    best = by_own.unionByName(by_all).groupBy("paper_id", "name").agg(F.min("p").alias("best"))
    marked = rows.join(hits, ["paper_id", "name", "acc"], "left").join(best, ["paper_id", "name"], "left")
    kept = marked.where("best is null or array_contains(ps, best)").join(cards, "acc", "left")
    source = F.coalesce(F.get(F.array(F.lit("definition"), F.lit("prefix"), F.lit("paper_scan")), F.col("best")), F.lit("")).alias("species_source")
    return _classified(kept.withColumn("species_source", source), ["paper_id", "name", "species_source"], "determined_by_text", too_wide)


def same_source(stated: dict, current: dict) -> None:
    """An error if answers were made for another table than the one they are about to be joined to."""
    if differing := sorted(k for k in {*stated, *current} if stated.get(k) != current.get(k)):
        raise ValueError(f"answers belong to another source: {', '.join(differing)}")


def running_offsets(rows: DataFrame, key: str, order: str, size: str) -> DataFrame:
    """Adds first and last: where each row's `size` elements stand among those of its key."""
    end = F.sum(size).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumns({"last": end, "first": end - F.col(size)})
