"""Sentences and the cues of a negative statement in them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Abbreviations whose full stop ends no sentence.
ABBREVIATIONS = (
    "et al", "e.g", "i.e", "cf", "ca", "approx", "vs", "viz",
    "Fig", "Figs", "fig", "figs", "Eq", "Ch", "Ref", "ref", "No", "no",
    "Dr", "Prof", "Mr", "Ms", "St", "Inc", "Co", "Ltd",
    "pp", "vol", "Vol", "min", "sec", "hr", "wt", "temp",
)
_SHORT = rf"\b(?:{'|'.join(a.replace('.', '[.]') for a in ABBREVIATIONS)})"
#: A single capital is an initial unless a lower-case word stands before it ("the knockout of X. The band").
_INITIAL = r"(?<![a-z] )\b[A-Z]"
_BREAK = rf"(?<=[.!?])(?<!{_SHORT}[.])(?<!{_INITIAL}[.])\s+(?=[A-Z0-9])"
_INNER = rf"(?<=[0-9])[.](?=[0-9])|(?<={_SHORT})[.]|(?<=\be)[.](?=g[.])|(?<=\bi)[.](?=e[.])|(?<={_INITIAL})[.]"
_VERB = r"\b(?:interact|bind|bound|binding|associat)\w*"

#: Five families of patterns; a wildcard that excludes full stops cannot leave its sentence.
FAMILIES = {
    "explicit_no_interaction": (
        r"\b(?:did|do|does|was|were|is|are|could|can)\s*n[o']?t\s+(?:\w+\s+){0,3}?(?:interact|bind|bound|associate|co-?immunoprecipitate|co-?precipitate|co-?localis|co-?localiz|complex)\w*",
        r"\bno\s+(?:detectable|significant|appreciable|apparent|specific|measurable|direct|physical)?\s*(?:interaction|binding|association|complex\s+formation)\b",
        r"\b(?:absence|lack)\s+of\s+(?:any\s+)?(?:detectable\s+|significant\s+|direct\s+)?(?:interaction|binding|association|complex)\b",
        r"\bnot\s+(?:a\s+)?(?:direct\s+)?(?:interactor|binding\s+partner|substrate|target)\b",
    ),
    "failed_assay": (
        r"\bfail(?:ed|s|ure)?\s+to\s+(?:\w+\s+){0,2}?(?:interact|bind|associate|co-?immunoprecipitate|co-?precipitate|detect|pull\s*down|immunoprecipitate)\w*",
        r"\b(?:unable|inability)\s+to\s+(?:\w+\s+){0,2}?(?:interact|bind|associate|detect)\w*",
        r"\bwas\s+not\s+(?:co-?)?(?:immunoprecipitated|precipitated|detected|pulled\s+down|recovered|retained)\b",
    ),
    "negative_result": (
        r"\b(?:negative|no)\s+(?:result|signal|band|reaction)s?\b",
        r"\b(?:undetectable|not\s+detected|below\s+(?:the\s+)?detection)\b",
        r"\b(?:did\s+not|does\s+not|failed\s+to)\s+(?:\w+\s+){0,3}?(?:show|display|exhibit|yield|produce)\s+(?:any\s+)?(?:interaction|binding|association|signal)\b",
    ),
    "elliptical_exclusion": (
        r"\b(?:interact|bind|bound|binding|associat|precipitat|complex)\w*[^.]{0,120}?\b(?:but|and|although|whereas|though)\s+not\b",
        rf"{_VERB}[^.]{{0,120}}?\bnot\s+(?:with|to)?\s*(?-i:[A-Z][A-Za-z0-9-]{{1,14}})(?:\s*,\s*(?-i:[A-Z][A-Za-z0-9-]{{1,14}}))*(?:\s*,?\s*(?:or|nor|and)\s+(?-i:[A-Z][A-Za-z0-9-]{{1,14}}))",
        r"\b(?:specific(?:ally)?|selectiv(?:e|ely))\s+(?:\w+\s+){0,3}?(?:interact|bind|bound|binding|associat)\w*[^.]{0,80}?\bnot\b",
    ),
    "contrast_negative": (
        r"\b(?:whereas|while|but|however|in\s+contrast)\b[^.]{0,80}?\b(?:no|not|neither)\b[^.]{0,40}?\b(?:interact|bind|bound|associat)\w*",
        r"\bneither\b[^.]{0,60}?\bnor\b[^.]{0,60}?\b(?:interact|bind|bound|associat)\w*",
    ),
}


def sentences(c: Column | str) -> Column:
    """The sentences of a text: cut behind . ! ? at white space before a capital or digit, unless the stop ends an abbreviation or an initial.

    One expression with look-behind finds the cuts, so the text itself is never rewritten. A null text gives null.
    """
    return F.filter(F.transform(F.split(c, _BREAK), lambda s: F.trim(s)), lambda s: s != "")


def has_cue(c: Column | str, families: dict[str, tuple[str, ...]] = FAMILIES) -> Column:
    """Whether some sentence matches some pattern; full stops inside a sentence (decimals, abbreviations) don't end a wildcard."""
    one = "(?i)" + "|".join(f"(?:{p})" for patterns in families.values() for p in patterns)
    inside = lambda s: F.regexp_replace(s, _INNER, "\u0000")
    return F.coalesce(F.exists(sentences(c), lambda s: inside(s).rlike(one)), F.lit(False))


def cue_families(c: Column | str) -> Column:
    """The names of the families that some sentence matches."""
    return F.filter(F.array(*(F.when(has_cue(c, {name: patterns}), F.lit(name)) for name, patterns in FAMILIES.items())), lambda x: x.isNotNull())
