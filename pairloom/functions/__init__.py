"""Column functions: pure expressions that stay inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def not_nan(c: Column | str) -> Column:
    """NaN becomes null, as Spark sorts NaN above every number and lower bounds would pass it."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c)


def lower_of(a: str, b: str) -> Column:
    return F.least(F.col(a), F.col(b))


def pair_key(a: str, b: str, sep: str = "|") -> Column:
    """One string for an unordered pair."""
    return F.concat(F.least(a, b), F.lit(sep), F.greatest(a, b))


#: Fixed value: the published form of a protein accession.
ACCESSION = "[OPQ][0-9][A-Z0-9]{3}[0-9]|[A-NR-Z][0-9](?:[A-Z][A-Z0-9]{2}[0-9]){1,2}"


def accession(c: str) -> Column:
    """The leading protein accession of six or ten characters, empty if there is none."""
    return F.regexp_extract(c, rf"^({ACCESSION})(?![A-Z0-9])", 1)


def cluster_without_mode(c: str) -> Column:
    """A cluster id without its last underscore part; empty and 'nan' are null."""
    return F.nullif(F.nullif(F.regexp_replace(c, "_[^_]*$", ""), F.lit("")), F.lit("nan"))


def is_unclustered(c: str) -> Column:
    return F.col(c).rlike(r"(^|_)-1(_|$)")


def file_name(c: str) -> Column:
    return F.substring_index(c, "/", -1)


#: Greek letters and their names.
GREEK = {
    "α": "alpha", "β": "beta", "γ": "gamma", "δ": "delta", "ε": "epsilon", "ζ": "zeta", "η": "eta", "θ": "theta",
    "ι": "iota", "κ": "kappa", "λ": "lambda", "μ": "mu", "ν": "nu", "ξ": "xi", "ο": "omicron", "π": "pi",
    "ρ": "rho", "σ": "sigma", "τ": "tau", "υ": "upsilon", "φ": "phi", "χ": "chi", "ψ": "psi", "ω": "omega",
}


#: What full case folding writes with several letters (Java's upper case does so too, but not for all).
FOLDED = {"ß": "ss", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st", "ſ": "s"}


def name_key(c: Column | str) -> Column:
    """A written name as a key: trimmed, case folded, Greek letters spelled, only a-z and 0-9 kept.

    Folding is lower case of upper case, with final sigma as sigma; of what case folding
    writes with several letters, sharp s and the ligatures have any in a-z.
    """
    out = F.lower(F.upper(F.trim(F.col(c) if isinstance(c, str) else c)))
    for sign, letters in {**FOLDED, "ς": "σ"}.items():
        out = F.replace(out, F.lit(sign), F.lit(letters))
    for letter, word in GREEK.items():
        out = F.replace(out, F.lit(letter), F.lit(word))
    return F.regexp_replace(out, "[^a-z0-9]", "")


def surface_forms(c: str) -> Column:
    """The distinct non-empty keys of a name and of each of its parts between slashes."""
    parts = F.concat(F.array(F.col(c)), F.split(c, "/"))
    return F.array_distinct(F.filter(F.transform(parts, name_key), lambda x: x != ""))


def tokens(c: str) -> Column:
    return F.regexp_extract_all(c, F.lit(r"([A-Za-z][A-Za-z0-9.'-]*)"), F.lit(1))


def selected_count(n_a: str, n_b: str, rho: float = 0.25, most: int = 70) -> Column:
    """How many of n_a * n_b values are averaged: at least one, at most `most`; rho in double arithmetic."""
    smaller = F.least(n_a, n_b).cast("double") * F.lit(rho).cast("double")
    return F.greatest(F.lit(1).cast("long"), F.least(F.lit(most).cast("long"), F.floor(smaller)))


def stable_id(*parts: Column | str, length: int = 10) -> Column:
    """The first hex digits of the sha1 of the parts joined by NUL."""
    return F.substring(F.sha1(F.concat_ws("\u0000", *parts)), 1, length)


def safe_date(c: str) -> Column:
    """yyyy-mm-dd of anything that parses as a time, else null (no error under ANSI)."""
    return F.date_format(F.expr(f"try_to_timestamp({c})"), "yyyy-MM-dd")
