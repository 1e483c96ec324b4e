"""Full texts in structured formats: JATS, HTML and TEI read into one struct per document by the standard library's parsers.

A document that does not parse gives empty fields, never an error, so one bad file does not end a job.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ASSET = T.StructType().add("id", T.StringType()).add("text", T.StringType()).add("href", T.StringType())
ARTICLE = T.StructType().add("text", T.StringType()).add("figures", T.ArrayType(_ASSET)).add("tables", T.ArrayType(_ASSET))
STRUCTURE = T.StructType().add("title", T.StringType()).add("sections", T.ArrayType(T.StringType())).add("references", T.ArrayType(T.StringType()))
#: Most characters of a caption and of a table's text.
CAPTION, TABLE = 600, 4000
_DOI = re.compile(r"10\.\d{4,9}/[^\s\"<>]+")


def _tree(xml: str | None) -> ElementTree.Element | None:
    """The tree without namespaces; None for what is no XML. Entities are not resolved from outside."""
    if not xml:
        return None
    try:
        root = ElementTree.fromstring(re.sub(r"<!DOCTYPE[^>\[]*(?:\[.*?\])?\s*>", "", xml, flags=re.S))
    except (ElementTree.ParseError, ValueError):
        return None
    for node in root.iter():
        node.tag = node.tag.rpartition("}")[2] if isinstance(node.tag, str) else ""
        node.attrib = {k.rpartition("}")[2]: v for k, v in node.attrib.items()}
    return root


def _words(node: ElementTree.Element | None) -> str:
    return "" if node is None else " ".join(" ".join(node.itertext()).split())


def jats_article(xml: str | None) -> dict:
    """Body text with headings (`## x`), figures and table-wraps of a JATS article.

    Paragraphs inside captions are the figure's, not the text's. The text of a figure is its label and caption, of a table its label,
    caption and content; both are numbered in document order (f1, t1).
    """
    root = _tree(xml)
    out = {"text": "", "figures": [], "tables": []}
    if root is None:
        return out
    blocks: list[str] = []

    def walk(node: ElementTree.Element) -> None:
        for kid in node:
            if kid.tag in ("title", "p") and not (kid.tag == "p" and node.tag in ("caption", "table-wrap", "fig")) and (words := _words(kid)):
                blocks.append(f"## {words}" if kid.tag == "title" else words)
            walk(kid)

    body = root if root.tag == "body" else root.find(".//body")
    if body is not None:
        walk(body)
    head = lambda x: f"{_words(x.find('label'))} {_words(x.find('caption'))}".strip()
    for n, fig in enumerate(root.iter("fig"), 1):
        graphic = fig.find(".//graphic")
        out["figures"].append({"id": f"f{n}", "text": head(fig)[:CAPTION], "href": None if graphic is None else graphic.attrib.get("href")})
    for n, wrap in enumerate(root.iter("table-wrap"), 1):
        out["tables"].append({"id": f"t{n}", "text": f"{head(wrap)}\n{_words(wrap.find('.//table'))}".strip()[:TABLE], "href": None})
    return out | {"text": "\n\n".join(blocks)}


class _Page(HTMLParser):
    """Collects blocks of text, figures and tables of a page; scripts, navigation, headers and footers are left out."""

    _OUT = {"script", "style", "nav", "footer", "aside", "form", "noscript", "template", "head"}
    _BLOCKS = {"p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "div", "section", "article", "td", "th", "dd", "dt", "br"}
    _VOID = {"br", "img", "hr", "meta", "link", "input", "source", "col", "wbr"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[str] = []
        self.held: list[str] = []
        self.level = ""
        self.skip = self.in_table = 0
        self.figures: list[dict] = []
        self.tables: list[list[list[str]]] = []
        self.figure: dict | None = None
        self.in_caption = False
        self.cell: list[str] | None = None

    def flush(self) -> None:
        words = " ".join("".join(self.held).split())
        if words and not self.in_table:
            self.blocks.append(f"## {words}" if self.level else words)
        self.held = []

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if tag in self._OUT:
            self.skip += 1
        if self.skip:
            return
        if tag == "figure":
            self.flush()
            self.figure = {"src": "", "alt": "", "caption": [], "told": False}
        elif tag == "img" and self.figure is not None and not self.figure["src"]:
            self.figure["src"] = attrs.get("src") or attrs.get("data-src") or ""
            self.figure["alt"] = attrs.get("alt") or ""
        elif tag == "figcaption" and self.figure is not None:
            self.in_caption = self.figure["told"] = True
        elif tag == "table":
            self.flush()
            self.in_table += 1
            self.tables.append([])
        elif tag == "tr" and self.in_table:
            self.tables[-1].append([])
        elif tag in ("td", "th") and self.in_table:
            if not self.tables[-1]:
                self.tables[-1].append([])
            self.cell = []
        elif tag in self._BLOCKS:
            self.flush()
            if tag[0] == "h" and len(tag) == 2:
                self.level = tag

    def handle_endtag(self, tag):
        if tag in self._OUT:
            self.skip = max(0, self.skip - 1)
            return
        if self.skip:
            return
        if tag == "figcaption":
            self.in_caption = False
        elif tag == "figure" and self.figure is not None:
            caption = " ".join("".join(self.figure["caption"]).split()) if self.figure["told"] else self.figure["alt"].strip()
            if self.figure["src"] or caption:
                self.figures.append({"id": f"f{len(self.figures) + 1}", "text": caption[:CAPTION], "href": self.figure["src"] or None})
            self.figure = None
        elif tag in ("td", "th") and self.cell is not None:
            self.tables[-1][-1].append(" ".join("".join(self.cell).split()))
            self.cell = None
        elif tag == "table":
            self.in_table = max(0, self.in_table - 1)
        elif tag in self._BLOCKS:
            self.flush()
            if tag == self.level:
                self.level = ""

    def handle_data(self, data):
        if self.skip:
            return
        if self.in_caption and self.figure is not None:
            self.figure["caption"].append(data)
        elif self.cell is not None:
            self.cell.append(data)
        elif not self.in_table:
            self.held.append(data)


def html_article(html: str | None) -> dict:
    """Text of a page with headings (`## x`), its figures (caption, else alternative text) and tables (`a | b` a row, empty rows dropped)."""
    page = _Page()
    page.feed(html or "")
    page.close()
    page.flush()
    tables = ["\n".join(" | ".join(r) for r in rows if any(r)) for rows in page.tables]
    return {"text": "\n\n".join(page.blocks), "figures": page.figures, "tables": [{"id": f"t{n}", "text": t[:TABLE], "href": None} for n, t in enumerate(filter(None, tables), 1)]}


def tei_structure(tei: str | None) -> dict:
    """Title, headings of the body in reading order, and cited DOIs once each in order of first citation."""
    root = _tree(tei)
    if root is None:
        return {"title": "", "sections": [], "references": []}
    title = next((_words(t) for s in root.iter("titleStmt") for t in s.findall("title")), "")
    body = next(root.iter("body"), None)
    heads = [] if body is None else [h for d in body.iter("div") if (h := _words(d.find("head")))]
    cited = []
    for entry in root.iter("biblStruct"):
        found = (m for i in entry.iter("idno") if i.attrib.get("type", "").upper() == "DOI" and (m := _DOI.search(_words(i))))
        if m := next(found, None):
            cited.append(m[0].rstrip(".)"))
    return {"title": title, "sections": heads, "references": list(dict.fromkeys(cited))}


def _reader(read: Callable, schema: T.StructType) -> Callable[[Column], Column]:
    def column(source: Column) -> Column:
        @F.pandas_udf(schema)
        def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for texts in parts:
                yield pd.DataFrame([read(t) for t in texts], columns=schema.names)

        return run(source)

    return column


#: Columns: a document's source text to its struct.
jats = _reader(jats_article, ARTICLE)
html = _reader(html_article, ARTICLE)
tei = _reader(tei_structure, STRUCTURE)


def page_envelope(items: Column, total: Column, page: int, size: int) -> Column:
    """A page of an ordered array of results: items, page, total and whether more follow."""
    return F.struct(F.slice(items, (page - 1) * size + 1, size).alias("items"), F.lit(page).alias("page"), total.alias("total"), (total > page * size).alias("has_more"))
