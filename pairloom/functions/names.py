"""Written protein and organism names: splits, tests, prefixes, abbreviations. Regular expressions run in the JVM; three parsers run in Arrow batches."""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import name_key

#: What marks a construct rather than a protein.
DASH = "[-‐-―]"
CONSTRUCT = (
    "[Δ∆]",
    r"(?i)\b(mutant|mutants|mutation|truncation|truncated|deletion|deleted)\b",
    rf"\(\s*\d+\s*{DASH}\s*\d+\s*\)",
    rf"(?i)\b(residues?|aa|amino\s+acids?)\b\s*\d+\s*{DASH}\s*\d+|\b\d+\s*{DASH}\s*\d+\s*(residues?|aa|amino\s+acids?)\b",
    r"(?<=[0-9a-z])[A-Z]\d{2,}[A-Z]\b",
    r"(?i)^\s*(GST|MBP|His\d*|\d*x?His|HA|FLAG|Myc|V5|Strep|GFP|YFP|RFP|mCherry)\s*[-‐-―_\s]",
)
#: Outcomes of a side, from settled to open.
STATUS = {
    "determined_by_name": "resolved", "determined_by_text": "resolved", "model_picked": "resolved", "species_pick": "needs_model_pick",
    "identity_pick": "needs_model_pick", "unresolved": "needs_curation", "too_wide": "needs_curation",
}
STATUS_ORDER = ("resolved", "needs_model_pick", "needs_curation")
#: A definition's leading words that qualify a protein, and trailing ones that generalise it.
LEADING = """p phospho phosphorylated ac acetyl acetylated ub ubiquitin ubiquitinated me methyl methylated sumoylated cleaved active inactive soluble
recombinant purified endogenous exogenous total full fulllength wt wildtype human mouse rat murine bovine yeast nuclear cytosolic mature pro pre anti e coli
escherichia saccharomyces cerevisiae drosophila arabidopsis thaliana oryza sativa the a an its type isoform form protein putative novel plant bacterial viral
fungal truncated tagged labeled labelled nucleotide free monomeric""".split()
TRAILING = """protein proteins peptide polypeptide subunit isoform chain antigen enzyme gene mrna construct fusion domain receptor channel kinase complex homolog
homologue orthologue ortholog protease transporter factor""".split()


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_construct(name: Column | str) -> Column:
    """Whether a written name marks a construct; to be used behind a resolution gate, as real names look the same."""
    name = _col(name)
    alone = F.exists(F.split(name, "[\\s‐-―-]+"), lambda token: token.rlike(r"^[A-Z]\d{2,}[A-Z]$"))
    return F.coalesce(alone | F.greatest(*(name.rlike(p) for p in CONSTRUCT)), F.lit(False))


def is_reagent(name: Column | str, reagents: list[str]) -> Column:
    """Whether the whole key is one of `reagents` (keys), or the name is a bare ion."""
    return F.coalesce(name_key(name).isin(reagents) | F.trim(_col(name)).rlike(r"^[A-Z][a-z]?\d*[+-]+$"), F.lit(False))


def organism_parts(organism: Column | str) -> Column:
    """(scientific, commons): the name before the first ' (', and names of one or two words in parentheses that are no strain."""
    organism = _col(organism)
    inside = F.transform(F.regexp_extract_all(organism, F.lit(r"\(([^()]+)\)"), F.lit(1)), lambda x: F.trim(x))
    usable = F.filter(inside, lambda x: (x != "") & ~x.rlike(r"(?i)\b(strain|isolate|serotype|subsp|var)\b") & (F.size(F.split(x, r"\s+")) <= 2))
    return F.struct(F.trim(F.substring_index(organism, " (", 1)).alias("scientific"), usable.alias("commons"))


def species_prefix(name: Column | str, codes: Column, letters: Column) -> Column:
    """(rule, rest, taxa) or null: a yeast p behind the name, a two-letter code, or one letter before it; the rest has three characters at least.

    codes, letters: maps from a lower-case code, or a letter, to an array of taxa.
    """
    name = F.trim(_col(name))

    def rule(kind: str, pattern: str, rest: int, taxa) -> Column:
        left = F.regexp_extract(name, pattern, rest)
        found = taxa(F.regexp_extract(name, pattern, 1))
        return F.when((F.char_length(left) >= 3) & (F.size(F.coalesce(found, F.array())) > 0), F.struct(F.lit(kind).alias("rule"), left.alias("rest"), found.alias("taxa")))

    return F.coalesce(
        rule("yeast_p_suffix", "^(.*[A-Za-z0-9])p$", 1, lambda _: F.try_element_at(letters, F.lit("y"))),
        rule("two_letter", "^([A-Z][a-z])([A-Z0-9].*)$", 2, lambda x: F.try_element_at(codes, F.lower(x))),
        rule("one_letter", "^([a-z])([A-Z].*)$", 2, lambda x: F.try_element_at(letters, x)),
    )


def pair_status(outcome_a: str, outcome_b: str) -> Column:
    """The status of the side that needs more."""
    place = F.create_map(*(F.lit(x) for outcome, s in STATUS.items() for x in (outcome, STATUS_ORDER.index(s))))
    return F.get(F.array(*map(F.lit, STATUS_ORDER)), F.greatest(F.element_at(place, F.col(outcome_a)), F.element_at(place, F.col(outcome_b))))


def split_names(text: str | None) -> list[str]:
    """The name outside parentheses, then the content of each outermost pair; enzyme numbers and empty names go."""
    text = text or ""
    pieces, outside, depth, begin = [], [], 0, 0
    for i, c in enumerate(text):
        if c == "(":
            if not depth:
                outside.append(text[begin:i])
                begin = i + 1
            depth += 1
        elif c == ")" and depth:
            depth -= 1
            if not depth:
                pieces.append(text[begin:i])
                begin = i + 1
    if not depth:
        outside.append(text[begin:])
    names = [x.strip() for x in ("".join(outside), *pieces)]
    return [x for x in names if x and not re.fullmatch(r"EC \d+\.[\d\-]+\.[\d\-]+\.[\d\-]+", x)]


def fold(text: str | None) -> str | None:
    """Text as it is compared for grounding: entities read, NFKC, dashes and signs of approximation folded, one space, casefold."""
    if text is None:
        return None
    text = unicodedata.normalize("NFKC", html.unescape(text))
    text = re.sub("[−‐-―]", "-", text)
    return " ".join(re.sub("[≈∼≃≅≉]", "~", text).replace("×", "x").split()).casefold()


def unescape(text: str | None) -> str | None:
    r"""Literal \uXXXX written out as the character."""
    return None if text is None else re.sub(r"\\+u([0-9a-fA-F]{4})", lambda m: chr(int(m.group(1), 16)), text)


def long_form(window: str, short: str) -> str | None:
    """The shortest stretch at the window's end that holds the letters of `short` in order, the first of them at a word's start."""
    letters = [c.casefold() for c in short if c.isalnum()]
    at = len(window)
    for k in range(len(letters) - 1, -1, -1):
        at -= 1
        while at >= 0 and not (window[at].casefold() == letters[k] and (k or not at or not window[at - 1].isalnum())):
            at -= 1
        if at < 0:
            return None
    found = window[at:].strip()
    words = len(found.split())
    if not words or words > min(len(letters) + 5, 2 * len(letters)) or found.count(")") > found.count("("):
        return None
    return found


def definitions(text: str | None, window: int = 200) -> list[tuple[str, str]]:
    """(abbreviation, long form) that a block states: an abbreviation of 2 to 10 characters in parentheses behind its long form."""
    out = []
    for m in re.finditer(r"\(([^()]{2,30})\)", text or ""):
        short = m.group(1).strip()
        if 2 <= len(short) <= 10 and len(short.split()) <= 2 and short[0].isalnum() and any(c.isalpha() for c in short):
            form = long_form(text[max(0, m.start() - window) : m.start()], short)
            if form and form.casefold() != short.casefold():
                out.append((short, form))
    return out


def variants(form: str, key=None) -> list[str]:
    """Readings of a long form that a name index may hold: without an abbreviated species, leading qualifiers, then trailing nouns; longest first."""
    key = key or (lambda w: re.sub("[^a-z0-9]", "", w.casefold()))
    bare = re.sub(r"^[A-Z]\.\s*[a-z]+\s+", "", form).strip()
    out, w = [form, bare], bare.split()
    while len(w) > 1 and key(w[0]) in LEADING:
        w = w[1:]
        out.append(" ".join(w))
    while len(w) > 1 and key(w[-1]) in TRAILING:
        w = w[:-1]
        out.append(" ".join(w))
    return [x for x in dict.fromkeys(out) if x.strip()]


def _mapped(c: Column | str, f, kind: str) -> Column:
    """f over Arrow batches of a string column; made when called, as workers import this module without a session."""

    def run(values: pd.Series) -> pd.Series:
        return values.map(f)

    return F.pandas_udf(run, kind)(_col(c))


def names_of(field: Column | str) -> Column:
    """`split_names` of a column."""
    return _mapped(field, split_names, "array<string>")


def folded(text: Column | str) -> Column:
    """`fold` of a column; null stays null."""
    return _mapped(text, fold, "string")


def unescaped(text: Column | str) -> Column:
    """`unescape` of a column; null stays null."""
    return _mapped(text, unescape, "string")


def definitions_of(text: Column | str) -> Column:
    """`definitions` of a column, as (short, long_form)."""
    return _mapped(text, lambda t: [{"short": s, "long_form": f} for s, f in definitions(t)], "array<struct<short: string, long_form: string>>")


def variants_of(form: Column | str) -> Column:
    """`variants` of a column of long forms."""
    return _mapped(form, lambda t: variants(t) if t else [], "array<string>")
