"""Markup to section-tagged blocks: one Arrow-batched pass with the standard library's parser."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

from ..operators.texts import SECTION_TYPES, SECTIONS

SKIPPED = {"script", "style", "nav", "footer", "header", "aside", "noscript"}
TITLES = {"h1", "h2", "h3", "h4", "h5", "h6", "title"}
BLOCKS = {"p", "li", "td", "th", "pre", "blockquote", "figcaption", "caption", "dd", "dt", "div", "section", "article", "abstract", "sec"}


class _Blocks(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[tuple[str, str, str]] = []
        self.section, self.kind, self.held, self.skipped = "", "p", [], 0

    def flush(self) -> None:
        text = " ".join("".join(self.held).split())
        self.held = []
        if text and self.kind in TITLES:
            self.section = text
        if text:
            self.out.append((self.section, self.kind, text))

    def handle_starttag(self, tag, attrs):
        if tag in SKIPPED:
            self.flush()
            self.skipped += 1
        elif tag in TITLES or tag in BLOCKS:
            self.flush()
            self.kind = tag if tag in TITLES else "p"
        elif tag == "br":
            self.held.append(" ")

    def handle_endtag(self, tag):
        if tag in SKIPPED:
            self.skipped = max(0, self.skipped - 1)
        elif tag in TITLES or tag in BLOCKS:
            self.flush()
            self.kind = "p"

    def handle_data(self, data):
        if not self.skipped:
            self.held.append(data)


def parse(markup: str | None) -> list[tuple[str, str, str]]:
    """(section title, kind, text) of the visible blocks, in order."""
    parser = _Blocks()
    parser.feed(markup or "")
    parser.close()
    parser.flush()
    return parser.out


def blocks(pages: DataFrame, key: str = "page_id", markup: str = "html") -> DataFrame:
    """key, block_index, section_title, block_type, text of every page; pages without visible text give no rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(k, i, *b) for k, m in zip(frame[key], frame[markup]) for i, b in enumerate(parse(m))]
            yield pd.DataFrame(rows, columns=[key, "block_index", "section_title", "block_type", "text"])

    kind = dict(pages.dtypes)[key]
    return pages.select(key, markup).mapInPandas(run, f"{key} {kind}, block_index int, section_title string, block_type string, text string")


#: Elements that are no part of the paragraph around them, and containers without evidence.
ASIDE = {"fig", "table-wrap", "table", "graphic", "media"}
EXCLUDED = {"ref-list", "ack", "fn-group", "glossary", "bio", "author-notes", "notes"}
CAPTIONS = {"fig": "figure_caption", "table-wrap": "table_caption"}


def section_of(title: str, kind: str | None) -> str:
    """What `texts.section_kind` gives, for one title."""
    if settled := SECTION_TYPES.get((kind or "").strip().lower()):
        return settled
    bare = re.sub(r"^\s*([0-9]+(\.[0-9]+)*|[IVXLC]+)[.)]?\s+", "", title.strip().upper())
    return next((name for name, pattern in SECTIONS if re.match(pattern, bare)), "other")


def _tag(node: ET.Element) -> str:
    return node.tag.rpartition("}")[2] if isinstance(node.tag, str) else ""


def _text(node: ET.Element) -> str:
    """The visible text of an element without figures and tables inside it, one space between words."""

    def parts(x):
        yield x.text or ""
        for child in x:
            if _tag(child) not in ASIDE and _tag(child):
                yield from parts(child)
            yield child.tail or ""

    return " ".join("".join(parts(node)).split())


def jats(xml: str | None) -> list[tuple[str, str, str, str, str]]:
    """(section path, section title, section, block type, text) of an article: its abstract, then body and back.

    A section whose title says nothing takes its parent's section; excluded sections and containers are left out. Captions are
    blocks of their own. Markup that cannot be read gives no blocks.
    """
    out: list[tuple[str, str, str, str, str]] = []

    def walk(node: ET.Element, path: tuple[str, ...], title: str, section: str) -> None:
        for child in node:
            tag = _tag(child)
            if tag in EXCLUDED:
                continue
            if tag == "sec":
                heading = next((_text(x) for x in child if _tag(x) == "title"), "")
                own = section_of(heading, child.get("sec-type"))
                if own != "excluded":
                    walk(child, (*path, heading) if heading else path, heading or title, section if own == "other" else own)
            elif tag in CAPTIONS:
                pieces = [_text(x) for x in child if _tag(x) in ("label", "caption")]
                if text := " ".join(x for x in pieces if x):
                    out.append((" > ".join(path), title, section, CAPTIONS[tag], text))
            elif tag == "p":
                if text := _text(child):
                    out.append((" > ".join(path), title, section, "paragraph", text))
                walk(child, path, title, section)  # figures that are declared inside a paragraph
            elif tag != "title":
                walk(child, path, title, section)

    try:
        root = ET.fromstring(xml or "")
    except ET.ParseError:
        return out
    for wanted in ("abstract", "body", "back"):
        for node in root.iter():
            if _tag(node) == wanted:
                first = len(out)
                walk(node, (), "", "abstract" if wanted == "abstract" else "other")
                if wanted == "abstract" and len(out) == first and (text := _text(node)):
                    out.append(("", "", "abstract", "paragraph", text))
    return out


def article_blocks(articles: DataFrame, key: str = "paper_id", xml: str = "xml") -> DataFrame:
    """key, block_index, section_path, section_title, canonical_section, block_type, text of every article that can be read."""
    columns = [key, "block_index", "section_path", "section_title", "canonical_section", "block_type", "text"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([(k, i, *b) for k, x in zip(frame[key], frame[xml]) for i, b in enumerate(jats(x))], columns=columns)

    kind = dict(articles.dtypes)[key]
    return articles.select(key, xml).mapInPandas(run, f"{key} {kind}, block_index int, " + ", ".join(f"{c} string" for c in columns[2:]))


def residue_map(xml: str | None) -> list[tuple[str, int, str, str, int]]:
    """(chain, residue number, insertion code, accession, position) of a residue mapping; residues that are not observed are left out."""
    out = []
    try:
        root = ET.fromstring(xml or "")
    except ET.ParseError:
        return out
    for residue in (x for x in root.iter() if _tag(x) == "residue"):
        refs = {x.get("dbSource"): x for x in residue if _tag(x) == "crossRefDb"}
        a, b = refs.get("PDB"), refs.get("UniProt")
        if a is None or b is None or "null" in (a.get("dbResNum"), b.get("dbResNum")):
            continue
        if (m := re.fullmatch(r"(-?\d+)([A-Za-z]?)", a.get("dbResNum", ""))) and b.get("dbResNum", "").isdigit():
            out.append((a.get("dbChainId", ""), int(m.group(1)), m.group(2), b.get("dbAccessionId", ""), int(b.get("dbResNum"))))
    return out


def residue_maps(entries: DataFrame, key: str = "entry", xml: str = "xml") -> DataFrame:
    """key, chain, residue, icode, acc, position of every mapping."""
    columns = [key, "chain", "residue", "icode", "acc", "position"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([(k, *r) for k, x in zip(frame[key], frame[xml]) for r in residue_map(x)], columns=columns)

    kind = dict(entries.dtypes)[key]
    return entries.select(key, xml).mapInPandas(run, f"{key} {kind}, chain string, residue int, icode string, acc string, position int")
