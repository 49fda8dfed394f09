"""Personal data: base patterns, and further spans chosen by candidate gradient boosting.

High-recall generators propose overlapping spans (spelled-out addresses, numbers of people and accounts,
telephone numbers without a country code, dates of birth). Boosted trees score each from its format
and the words around it, an isotonic map makes the score a probability, and a threshold for each kind, set for a
precision on held-out rows, selects what is added. Overlaps among the added go to the more probable span; base spans stay.

The trees learn from `training_size` rows made from seeded templates (formats of either class in either
context, with noise), as no table labels spans; the sample's size is a parameter and does not depend on the data.
"""

from __future__ import annotations

import functools
import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import batch, chunks
from .boosting import BoostedTrees, Isotonic, threshold_for

BASE = ("email", "ip", "card", "phone")
ADDED = ("spelled_email", "national_id", "account", "local_phone", "birth_date")
_LOCAL = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match can only begin where a run of digits does, and a run is never given back: linear in the text.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of the address pattern, in linear time: each lies around an @."""
    out, at, floor = [], text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            out.append((start, m.end()))
            floor = m.end()
            at = text.find("@", floor)
        else:
            floor = at + 1
            at = text.find("@", floor)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [("email", a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(_at_most_255(p) for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


def _at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


#: A spelled-out address around its sign: the local part is read backwards from the sign, the rest forwards.
_SIGN = re.compile(r"\[at\]|\(at\)| at ")
_DOMAIN_SPELLED = re.compile(r" ?[A-Za-z0-9-]{1,63}(?: ?(?:\[dot\]|\(dot\)| dot |\.) ?[A-Za-z0-9-]{2,63}){1,4}")
_GENERATORS = {
    "national_id": re.compile(r"(?<![0-9])[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}(?![0-9])|(?<![0-9])[0-9]{9,11}(?![0-9])"),
    "account": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "local_phone": re.compile(r"(?<![0-9+])\(?[0-9]{2,4}\)?[ ./-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])"),
    "birth_date": re.compile(r"(?<![0-9])(?:[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{4})(?![0-9])"),
}
_CONTEXT = {
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell"),
    "id": ("ssn", "social", "passport", "national", "taxpayer", "identity"),
    "bank": ("iban", "account", "bank", "bic", "transfer"),
    "birth": ("born", "birth", "dob", "birthday"),
    "mail": ("email", "mail", "contact", "write", "reach"),
    "other": ("version", "license", "invoice", "order", "page", "isbn", "article", "release", "published", "updated", "model", "part", "item", "sku", "meeting"),
}


def spelled_emails(text: str) -> list[tuple[int, int]]:
    """Local part of at most 64 characters, a sign for @, and names with a dot (spelled or not) between them."""
    out, floor = [], 0
    for sign in _SIGN.finditer(text):
        end = sign.start()
        if end > floor and text[end - 1] == " ":
            end -= 1
        start = end
        while start > max(floor, end - 64) and text[start - 1] in _LOCAL:
            start -= 1
        if start < end and (m := _DOMAIN_SPELLED.match(text, sign.end())):
            out.append((start, m.end()))
            floor = m.end()
    return out


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Spans that may be personal data; they may overlap one another and base spans."""
    out = [("spelled_email", a, b) for a, b in spelled_emails(text)]
    if _DIGIT.search(text):
        for kind, pattern in _GENERATORS.items():
            out += [(kind, *m.span()) for m in pattern.finditer(text)]
    return out


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    span, before = text[start:end], text[max(0, start - 48) : start].lower()
    near = before[-20:]
    digits = "".join(c for c in span if "0" <= c <= "9")
    groups = re.findall("[0-9]+", span)
    letters = sum(c.isalpha() for c in span)
    years = [int(g) for g in groups if len(g) == 4]
    iban = 0.0
    if kind == "account" and len(tight := span.replace(" ", "")) >= 15:
        iban = float(int("".join(str(int(c, 36)) for c in tight[4:] + tight[:4])) % 97 == 1)
    row = [
        float(ADDED.index(kind)), float(len(span)), float(len(digits)), float(len(groups)), float(letters),
        float(bool(digits) and luhn(digits)), iban, float(any(1900 <= y <= 2015 for y in years)),
        float(span.count("-")), float(span.count(" ")), float(span.count("/") + span.count(".")), float("(" in span or "[" in span),
        float(digits[:3] not in ("", "000", "666") and digits[:1] != "9"), float(len(set(digits))),
        float(bool(re.search(r"\.(?:com|org|net|edu|io|de|fr|es|example)$", span.replace(" dot ", ".").replace("[dot]", ".").replace("(dot)", ".")))),
    ]
    for words in _CONTEXT.values():
        row.append(float(any(w in before for w in words)))
        row.append(float(any(w in near for w in words)))
    return row


def training_rows(size: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Features, labels and kinds of seeded template texts; positives carry an identifying format and mostly its context."""
    r = random.Random(seed)
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    w = lambda: "".join(r.choice("aeinorstlhdcu") for _ in range(r.randint(2, 8)))

    def iban() -> str:
        body = d(18)
        check = 98 - int("".join(str(int(c, 36)) for c in body + "DE00")) % 97
        return f"DE{check:02d}{body}"

    date = lambda y: r.choice((f"{y}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}", f"{r.randint(1, 28)}/{r.randint(1, 12)}/{y}", f"{r.randint(1, 28):02d}.{r.randint(1, 12):02d}.{y}"))
    own = {"spelled_email": "mail", "national_id": "id", "account": "bank", "local_phone": "phone", "birth_date": "birth"}
    x, y, kinds = [], [], []
    while len(y) < size:
        kind, good = r.choice(ADDED), r.random() < 0.5
        context = own[kind] if good and r.random() < 0.9 else "other" if r.random() < 0.6 else ""
        if kind == "spelled_email":
            a, b = r.choice(((" [at] ", " [dot] "), ("[at]", "[dot]"), (" at ", " dot "), ("(at)", "(dot)"), (" at ", "."), ("(at)", ".")))
            span = f"{w()}.{w()}{a}{w()}{b}{r.choice(('com', 'org', 'net', 'de'))}" if good else r.choice((f"{w()} at {w()} dot {w()}", f"{w()} at {w()}.{w().title()}", f"{w()} at {d(2)}.{d(2)}"))
        elif kind == "national_id":
            span = f"{r.randint(100, 665)}-{r.randint(10, 99)}-{r.randint(1000, 9999)}" if good else r.choice((d(9), d(10), d(11), f"{d(3)} {d(2)} {d(4)}"))
        elif kind == "account":
            span = iban() if good else f"{r.choice('ABCDEFG')}{r.choice('XYZ')}{d(2)} {d(4)} {d(4)}" + (f" {d(4)}" if r.random() < 0.5 else "")
            if good and r.random() < 0.5:
                span = " ".join(span[i : i + 4] for i in range(0, len(span), 4))
        elif kind == "local_phone":
            span = r.choice((f"({r.randint(201, 989)}) {r.randint(201, 999)}-{d(4)}", f"{r.randint(201, 989)}-{r.randint(201, 999)}-{d(4)}", f"0{d(3)} {d(3)} {d(4)}")) if good else f"{d(r.randint(2, 4))}{r.choice('./- ')}{d(r.randint(3, 4))}{r.choice('.- ')}{d(r.randint(3, 4))}"
        else:
            span = date(r.randint(1930, 2012)) if good else date(r.randint(1990, 2030))
        lead = " ".join(w() for _ in range(r.randint(0, 5)))
        if context:
            lead += f" {r.choice(_CONTEXT[context])}{r.choice((':', ' is', '', ' no.'))}"
        text = f"{lead} {span} {w()}"
        spot = [(k, a, b) for k, a, b in candidates(text) if k == kind]
        if spot:
            x.append(features(text, *spot[0]))
            y.append(float(good))
            kinds.append(kind)
    return np.array(x), np.array(y), kinds


@functools.lru_cache(maxsize=2)
def train(training_size: int = 6000, precision: float = 0.97, seed: int = 7):
    """(trees, calibration, threshold by kind), fitted on two thirds of the rows and calibrated on the last third."""
    x, y, kinds = training_rows(training_size, seed)
    cut = len(y) * 2 // 3
    trees = BoostedTrees().fit(x[:cut], y[:cut])
    raw = trees.raw(x[cut:])
    calibration = Isotonic().fit(raw, y[cut:])
    p, kinds = calibration(raw), np.array(kinds[cut:])
    return trees, calibration, {k: max(0.5, threshold_for(precision, p[kinds == k], y[cut:][kinds == k])) for k in ADDED}


def _write(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_ROW = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in BASE), ("base_sha256", pa.string()), ("spans", pa.string()), ("redacted", pa.string())])


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", redact: bool = False, training_size: int = 6000, precision: float = 0.97) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (and the redacted text if asked), one row per row.

    Positions are code points with exclusive ends; spans are ordered by kind as listed in BASE and ADDED, then start. A null
    or empty text has no spans. Rows that share a doc_id, or have a null one, are treated each on its own. Other columns are
    ignored. There is no shuffle, and a task holds about one MB of text at a time.
    """
    trees, calibration, thresholds = train(training_size, precision)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches):
            texts = [t or "" for t in piece.column(1).to_pylist()]
            bases = [base_spans(t) for t in texts]
            spots = [(i, c) for i, t in enumerate(texts) for c in candidates(t)]
            added: dict[int, list] = {}
            if spots:
                p = calibration(trees.raw(np.array([features(texts[i], *c) for i, c in spots])))
                for q, (i, c) in sorted(zip(p.tolist(), spots), key=lambda z: (z[1][0], -z[0], z[1][1][1:], z[1][1][0])):
                    if q >= thresholds[c[0]] and all(c[2] <= a or b <= c[1] for _, a, b in (*bases[i], *added.get(i, ()))):
                        added.setdefault(i, []).append(c)
            rows = []
            for i, (text, base) in enumerate(zip(texts, bases)):
                more = sorted(added.get(i, ()), key=lambda s: (ADDED.index(s[0]), s[1]))
                counts = [sum(k == kind for k, _, _ in base) for kind in BASE]
                rows.append((*counts, hashlib.sha256(_write(base).encode()).hexdigest(), _write([*base, *more]), _redacted(text, [*base, *more]) if redact else None))
            yield batch(_ROW, piece.column(0), *map(list, zip(*rows)))

    kinds = ", ".join(f"n_{k} long" for k in BASE)
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id long, {kinds}, base_sha256 string, spans string, redacted string")
    return out if redact else out.drop("redacted")


def _redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if b > at:
            out += [text[at : max(at, a)], f"[{kind}]" if a >= at else ""]
            at = b
    return "".join([*out, text[at:]])
