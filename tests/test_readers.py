"""Full-text readers and connector mappings on hand-made documents."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from assayloom.sources import connectors, fulltext

JATS = """<article xmlns:xlink="http://www.w3.org/1999/xlink"><front><article-title>T</article-title></front><body><sec><title>Methods</title><p>One <italic>two</italic>
 three.</p><fig id="a"><label>Fig. 1</label><caption><title>Cap title</title><p>Curve of x.</p></caption><graphic xlink:href="a.png"/></fig><p>After.</p></sec>
<table-wrap><label>Table 1</label><caption><p>Values</p></caption><table><tr><td>a</td><td>1</td></tr></table></table-wrap></body></article>"""
HTML = """<html><head><title>no</title></head><body><nav>menu</nav><h2>Aim</h2><p>First &amp; second<br>line</p><figure><img data-src="f.png" alt="alt text"></figure>
<figure><img src="g.png"><figcaption>Spectrum <b>of</b> y</figcaption></figure><figure></figure><table><tr><th>a</th><th>b</th></tr><tr><td></td><td></td></tr><tr><td>1</td><td>2</td></tr></table><script>x()</script></body>"""
TEI = """<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><titleStmt><title>The  title</title></titleStmt></teiHeader><text><body><div><head>Intro</head><p>x</p></div><div><p>no head</p></div><div><head>End</head></div></body>
<back><biblStruct><idno type="DOI">10.1234/a.1.</idno></biblStruct><biblStruct><idno type="doi">10.1234/b</idno><idno type="DOI">10.1234/c</idno></biblStruct><biblStruct><idno type="DOI">10.1234/a.1</idno></biblStruct></back></text></TEI>"""


def test_jats():
    got = fulltext.jats_article(JATS)
    assert got["text"] == "## Methods\n\nOne two three.\n\n## Cap title\n\nAfter."
    assert got["figures"] == [{"id": "f1", "text": "Fig. 1 Cap title Curve of x.", "href": "a.png"}] and got["tables"][0]["text"] == "Table 1 Values\na 1"
    assert fulltext.jats_article("<a>") == fulltext.jats_article(None) == {"text": "", "figures": [], "tables": []}


def test_html():
    got = fulltext.html_article(HTML)
    assert got["text"] == "## Aim\n\nFirst & second\n\nline"
    assert [(f["text"], f["href"]) for f in got["figures"]] == [("alt text", "f.png"), ("Spectrum of y", "g.png")] and got["tables"][0]["text"] == "a | b\n1 | 2"
    assert fulltext.html_article("<p>open <td>x")["text"] and fulltext.html_article(None)["text"] == ""


def test_tei():
    assert fulltext.tei_structure(TEI) == {"title": "The title", "sections": ["Intro", "End"], "references": ["10.1234/a.1", "10.1234/b"]}
    assert fulltext.tei_structure("nonsense")["sections"] == []


def test_readers_as_columns(spark):
    df = spark.createDataFrame([(JATS, HTML, TEI), (None, None, None)], "j string, h string, t string")
    got = df.select(fulltext.jats(F.col("j")).alias("j"), fulltext.html(F.col("h")).alias("h"), fulltext.tei(F.col("t")).alias("t")).collect()
    assert got[0]["j"]["figures"][0]["href"] == "a.png" and len(got[0]["h"]["figures"]) == 2 and got[0]["t"]["title"] == "The title" and got[1]["j"]["text"] == ""


PAYLOADS = [
    ("openalex", {"id": "https://openalex.org/W1", "doi": "https://doi.org/10.1234/A", "title": "T", "publication_year": 2020, "authorships": [{"author": {"display_name": f"A{i}"}} for i in range(12)], "abstract_inverted_index": {"world": [1, 3], "hello": [0], "again": [2]}, "open_access": {"is_oa": True, "oa_url": "u"}, "primary_location": {"source": {"display_name": "J"}}, "cited_by_count": 4}),
    ("semantic_scholar", {"paperId": "s1", "externalIds": {"DOI": "10.1234/b", "ArXiv": "2101.1"}, "authors": [{"name": "B"}, {"name": None}], "year": 2019, "venue": "V", "citationCount": None, "isOpenAccess": None, "openAccessPdf": {"url": "p"}}),
    ("europepmc", {"doi": "10.1234/c", "pmid": "7", "title": "C", "authorList": {"author": [{"fullName": "C D"}, {"firstName": "E", "lastName": "F"}]}, "pubYear": "2018", "isOpenAccess": "Y"}),
    ("crossref", {"DOI": "10.1234/d", "title": ["D"], "author": [{"given": "G", "family": "H"}, {"family": "I"}], "issued": {"date-parts": [[2017, 5]]}, "container-title": ["K"], "abstract": "<jats:p>text</jats:p>", "is-referenced-by-count": 3}),
    ("pubmed", {"uid": "9", "title": "E", "authors": [{"name": "L M"}], "pubdate": "2016 Jan", "source": "S", "articleids": [{"idtype": "pii", "value": "x"}, {"idtype": "doi", "value": "10.1234/e"}]}),
    ("core", {"doi": None, "title": "F", "authors": [{"name": "N"}], "yearPublished": 2015, "publisher": "P", "downloadUrl": "d"}),
    ("google_scholar", {"title": "G", "publication_info": {"summary": "O Pe, Q Ru… - Journal of X, 2014 - site.org"}, "resources": [{"file_format": "HTML", "link": "h"}, {"file_format": "pdf", "link": "q"}], "inline_links": {"cited_by": {"total": 6}}}),
    ("google_patents", {"title": "H", "inventor": "S T, U V", "assignee": "W", "publication_number": "US1", "grant_date": "2013-02-01", "pdf": "r"}),
]
ATOM = '<entry xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom"><id>http://arxiv.org/abs/2001.5v1</id><title>I\nJ</title><published>2012-01-01</published><author><name>X Y</name></author><author><name>Z</name></author><summary> s\nt </summary><link title="pdf" href="z"/></entry>'


def test_connectors(spark):
    rows = [(s, json.dumps(p)) for s, p in PAYLOADS] + [("arxiv", ATOM), ("unknown", "{}"), ("openalex", "no json"), ("core", None)]
    got = connectors.map_payloads(spark.createDataFrame(rows, "source string, payload string")).collect()
    by = {r["source"]: r for r in got[:10]}
    a = by["openalex"]
    assert (a["doi"], a["openalex_id"], len(a["authors"]), a["abstract"], a["pdf_url"], a["citation_count"]) == ("10.1234/A", "W1", 10, "hello world again world", "u", 4)
    assert (by["semantic_scholar"]["title"], by["semantic_scholar"]["authors"], by["semantic_scholar"]["citation_count"], by["semantic_scholar"]["is_open_access"]) == ("Untitled", ["B"], 0, False)
    assert (by["europepmc"]["authors"], by["europepmc"]["year"], by["europepmc"]["is_open_access"]) == (["C D", "E F"], 2018, True)
    assert (by["crossref"]["authors"], by["crossref"]["year"], by["crossref"]["abstract"], by["crossref"]["journal"]) == (["G H", "I"], 2017, "text", "K")
    assert (by["pubmed"]["doi"], by["pubmed"]["year"], by["pubmed"]["pmid"]) == ("10.1234/e", 2016, "9") and by["core"]["is_open_access"] and by["core"]["pdf_url"] == "d"
    g = by["google_scholar"]
    assert (g["authors"], g["journal"], g["year"], g["pdf_url"], g["is_open_access"]) == (["O Pe", "Q Ru"], "Journal of X", 2014, "q", True)
    assert (by["google_patents"]["journal"], by["google_patents"]["year"], by["google_patents"]["authors"]) == ("Patent US1 · W", 2013, ["S T", "U V"])
    x = by["arxiv"]
    assert (x["arxiv_id"], x["title"], x["authors"], x["year"], x["abstract"], x["pdf_url"]) == ("2001.5v1", "I J", ["X Y", "Z"], 2012, "s t", "z")
    assert got[9]["title"] == "Untitled" and got[10]["doi"] is None and len(got) == 12 and dict(connectors.source_status({"core"})) | {} and not dict(connectors.source_status())["core"]
