"""Documents as section-tagged blocks: cues, windows, budgets, grounding, names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import name_key, surface_forms, tokens


def blocks(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, block_index, text: the lines of each text."""
    return docs.where(F.col(text).isNotNull()).select(key, F.posexplode(F.split(text, "\n")).alias("block_index", "text"))


def ordered_concat(rows: DataFrame, key: str, index: str, text: str = "text", sep: str = "\n\n") -> DataFrame:
    """One text a key, its blocks in order of the index."""
    parts = F.array_sort(F.collect_list(F.struct(index, text)))
    return rows.groupBy(key).agg(F.array_join(F.transform(parts, lambda x: x[text]), sep).alias("text"))


def with_cue(rows: DataFrame, pattern: str, text: str = "text") -> DataFrame:
    return rows.withColumn("cue", F.coalesce(F.col(text).rlike(pattern), F.lit(False)))


def cue_window(rows: DataFrame, key: str, index: str, radius: int = 1) -> DataFrame:
    """The blocks within `radius` positions of a block with a cue."""
    near = F.max("cue").over(Window.partitionBy(key).orderBy(index).rowsBetween(-radius, radius))
    return rows.withColumn("_near", near).where("_near").drop("_near")


def running_budget(rows: DataFrame, key: str, index: str, most: int, text: str = "text") -> DataFrame:
    """Blocks until `most` characters of a key are used; the last one is cut."""
    before = F.coalesce(F.sum(F.char_length(text)).over(Window.partitionBy(key).orderBy(index).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("_before", before).where(F.col("_before") < most).withColumn(text, F.expr(f"substring({text}, 1, cast({most} - _before as int))")).drop("_before")


def grams(rows: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, position, term: the lower-cased tokens and pairs of neighbours."""
    listed = rows.select(key, tokens(text).alias("t"))
    words = listed.select(key, F.posexplode(F.expr("transform(t, (x, i) -> named_struct('one', lower(x), 'two', lower(x) || ' ' || lower(try_element_at(t, i + 2))))")).alias("position", "g"))
    return words.select(key, "position", F.explode(F.filter(F.array("g.one", "g.two"), lambda x: x.isNotNull())).alias("term"))


def _fold(c: str) -> Column:
    return F.lower(F.regexp_replace(F.trim(c), r"\s+", " "))


def grounded(excerpts: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """Adds grounded: whether the folded excerpt stands in the folded text of the same key."""
    texts = docs.select(key, _fold("text").alias("_folded"))
    return excerpts.join(texts, key, "left").withColumn("grounded", F.coalesce(F.contains("_folded", _fold("excerpt")), F.lit(False))).drop("_folded")


def containing(docs: DataFrame, excerpts: DataFrame, key: str, item: str, block: int = 10_000) -> DataFrame:
    """key, item: every document with every excerpt that stands in its folded text.

    The excerpts are the query set: they are sent to all tasks in blocks of about `block` rows, each a pass over the documents.
    """
    texts, items = docs.select(key, _fold("text").alias("_folded")), excerpts.select(item, _fold("excerpt").alias("_excerpt"))
    blocks_ = max(1, -(-items.count() // block))
    out = [texts.join(F.broadcast(items.where(F.pmod(F.xxhash64(item), F.lit(blocks_)) == k)), F.contains("_folded", "_excerpt")).select(key, item) for k in range(blocks_)]
    return reduce(DataFrame.unionByName, out)


def name_index(names: DataFrame) -> DataFrame:
    """name_key, acc: surface forms of at least two characters that are no bare numbers."""
    return names.select("acc", F.explode(surface_forms("name")).alias("name_key")).where("length(name_key) >= 2 and not name_key rlike '^[0-9]+$'").distinct()


def resolve(mentions: DataFrame, index: DataFrame, too_wide: int = 50) -> DataFrame:
    """name, outcome, n_candidates, accession of each distinct written name: unresolved, determined, identity_pick or too_wide."""
    keyed = mentions.select("name").distinct().withColumn("name_key", name_key("name"))
    found = keyed.join(index, "name_key", "left").groupBy("name").agg(F.count_distinct("acc").alias("n_candidates"), F.min("acc").alias("least"))
    n = F.col("n_candidates")
    outcome = F.when(n == 0, "unresolved").when(n == 1, "determined").when(n > too_wide, "too_wide").otherwise("identity_pick")
    return found.select("name", outcome.alias("outcome"), "n_candidates", F.when(n == 1, F.col("least")).otherwise("").alias("accession"))


#: Kinds by section type, and by title (upper case, without its number), first match wins.
SECTION_TYPES = {
    "results": "results", "discussion": "discussion", "intro": "introduction", "introduction": "introduction", "background": "introduction", "methods": "methods",
    "materials|methods": "methods", "materials-methods": "methods", "conclusions": "conclusion", "conclusion": "conclusion", "supplementary-material": "supplementary",
    "ref-list": "excluded", "ack": "excluded", "fn-group": "excluded", "contrib-info": "excluded", "coi-statement": "excluded", "abbreviations": "excluded", "associated-data": "supplementary",
}
SECTIONS = (
    ("excluded", r"^(REFERENCES?|SELECTED\s+REFERENCES|BIBLIOGRAPHY|ACKNOWLEDG(E)?MENTS?|AUTHORS?[\u2019']?\s+(CONTRIBUTIONS?|INFORMATION)|CONTRIBUTOR\s+INFORMATION|COMPETING\s+INTERESTS?|CONFLICTS?\s+OF\s+INTEREST|DISCLOSURES?|ABBREVIATIONS?|LIST\s+OF\s+ABBREVIATIONS|FOOTNOTES?|FUNDING|PRE-?PUBLICATION\s+HISTORY|AVAILABILITY|ETHICS|CONSENT|AUTHOR\s+SUMMARY)\b"),
    ("results_and_discussion", r"^RESULTS?\s*(AND|&|/)\s*DISCUSSION"),
    ("results_and_discussion", r"^DISCUSSION\s*(AND|&|/)\s*RESULTS?"),
    ("methods", r"^(MATERIALS?\s*(AND|&)?\s*METHODS?|METHODS?|EXPERIMENTAL\s*(PROCEDURES?|SECTION|METHODS?)?|PATIENTS?\s*AND\s*METHODS?|METHODOLOGY|MATERIALS?)\b"),
    ("results", r"^RESULTS?\b"),
    ("discussion", r"^DISCUSSION\b"),
    ("conclusion", r"^(CONCLUSIONS?|SUMMARY|CONCLUDING)\b"),
    ("introduction", r"^(INTRODUCTION|BACKGROUND)\b"),
    ("supplementary", r"^(SUPPLEMENTARY|SUPPLEMENTAL|SUPPORTING|ASSOCIATED\s+DATA|ADDITIONAL\s+(DATA|FILE))"),
)


def section_kind(rows: DataFrame, title: str, kind: str | None = None) -> DataFrame:
    """Adds section: what the section type (the column `kind`, if given) settles, else the kind of the title without its number, or other."""
    bare = F.regexp_replace(F.upper(F.trim(F.col(title))), r"^\s*([0-9]+(\.[0-9]+)*|[IVXLC]+)[.)]?\s+", "")
    by_title = F
    for name, pattern in SECTIONS:
        by_title = by_title.when(bare.rlike(pattern), name)
    out = by_title.otherwise("other")
    if kind:
        types = F.create_map(*(F.lit(x) for pair in SECTION_TYPES.items() for x in pair))
        out = F.coalesce(F.try_element_at(types, F.lower(F.trim(F.col(kind)))), out)
    return rows.withColumn("section", out)


def head(rows: DataFrame, order: list, n: int) -> DataFrame:
    """The first n rows in a total order: each task keeps its own n, and only those meet."""
    return rows.orderBy(*order).limit(n)
