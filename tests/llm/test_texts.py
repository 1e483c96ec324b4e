"""Markup, surviving records, copies, organisms and unit looks."""

from __future__ import annotations

import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assayloom.llm import canonical, copies, glyphs, markup, survivor


@pytest.mark.parametrize(
    "text",
    ["p < 0.01 and n > 5", "R&D costs were $3 and $61.", "Values with * differ (* p < 0.05).", "sample_1 and sample_2", "The a|b ratio [sic]; Section 2 -- Methods.", "a < b < c; <LOD", "{x, y} and <A, B>", r"C:\runs\set1", "2*k of [A]/[B]", "line\nbreak", "", "[3H]-labelled {110} ~71 #9 & 10"],
)
def test_plain_signs_are_no_markup(text):
    assert markup.clean(text) == (text, 0)


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("<p>a <i>b</i></p>", "a b"), ("&lt;p&gt;a&lt;/p&gt;", "a"), ("&amp;lt;i&amp;gt;a&amp;lt;/i&amp;gt;", "a"), ("a&nbsp;b &#181;M", "a b µM"), ("## Aim\nx", "## Aim\n\nx"), ("Aim\n====\nx", "## Aim\n\nx"),
        ("== Aim ==\nx", "## Aim\n\nx"), (r"\section*{Aim} x", "## Aim\nx"), ("<sec><title>Aim</title><p>x</p></sec>", "## Aim\n\nx"), ("<ul><li>a</li><li>b</li></ul>", "- a\n- b"), ("\\begin{itemize}\n\\item a\n\\item b\n\\end{itemize}", "- a\n- b"),
        ("x:\n\n1. a\n2. b", "x:\n\n1. a\n2. b"), ("x\n\n```\nf(1)  2\n```", "x\n\n```\nf(1)  2\n```"), ("the `run 1`", "the `run 1`"), (r"IC $\mathrm{IC}_{50}$ of", r"IC $\mathrm{IC}_{50}$ of"), (r"\[ E = \frac{a}{b} \] x", r"$E = \frac{a}{b}$ x"),
        ("'''a''' ''b'' [[c|d]] {{cite|1}}", "a b d"), ("**a** _b c_ [d](http://e.f)", "a b c d"), ("| a | b |\n|---|---|\n| 1 | 2 |", "a | b\n1 | 2"), ("> a quote", "a quote"), (r"x~\cite{r1} \textit{y} {\it z}", "x y z"), ("a<ref name=r4/>", "a"), ("< p >a", "a"),
    ],
)
def test_clean(raw, want):
    text, marks = markup.clean(raw)
    assert marks > 0 and text.strip() == want.strip()


@given(st.text(max_size=200))
def test_clean_never_fails(s):
    markup.clean(s)


@given(st.lists(st.sampled_from(["<p>", "</p>", "**", "_", "`", "{{", "[[", "\\item ", "$", "\n# ", "<li>", "x", " ", "&lt;", "''"]), max_size=40))
def test_broken_markup_never_fails(parts):
    markup.clean("".join(parts))


def test_tree_matching():
    t = lambda s: markup._tree(markup.parse(s)[0])
    a, b = t("<div><h3>A</h3><p>one text</p><p>two text</p></div>"), t("<div><h3>A</h3><p>one text</p></div>")
    size, pairs = markup.tree_match(a, b)
    assert size == 4 and pairs == [(0, 0)]
    markup.merge(a, b)
    assert a[1] == 2 and a[3][0][3][1][:3] == ["p", 2, {"one text": 2, "two text": 1}]
    assert markup.tree_match(t("<p>x</p>"), t("<ul><li>x</li></ul>")) == (1, [])


def test_wrapper_is_removed_and_content_stays(spark):
    rows = [(i, "h", f"<div><span>Site banner</span><h3>Aim</h3><p>text {i}</p></div>") for i in range(60)] + [(100, None, None), (101, "h", ""), (102, None, "plain")]
    df = spark.createDataFrame(rows, "id int, host string, body string")
    got = {r["id"]: r["clean"] for r in markup.clean_markup(df, "body", "host").collect()}
    assert len(got) == len(rows) and got[7]["text"].split() == ["##", "Aim", "text", "7"]
    assert got[100]["text"] is None and got[100]["marks"] is None and tuple(got[101]) == ("", 0) and tuple(got[102]) == ("plain", 0)
    assert markup.clean_markup(df.limit(0), "body", "host").count() == 0


@pytest.mark.parametrize(("text", "whole"), [("A was done. B fell.", True), ("A was done. B fe", False), ("A was done. B…", False), ("A was done [...]", False), ("No abstract available.", False), ("n/a", False), (None, False), ("<p>A was done.</p>", True), ("A was done. © 2020 X. All rights reserved.", True), ("A was do Keywords: a; b.", False), ("A was done.\n\n```\nf(1)\n```", True)])
def test_complete_abstracts(text, whole):
    assert survivor.is_complete(survivor.core_text(text)) is whole


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=12))
def test_dominance_layers(points):
    level = survivor.layers(points)
    rest, k = list(range(len(points))), 0
    while rest:
        front = [i for i in rest if not any(survivor.dominates(points[j], points[i]) for j in rest)]
        assert all(level[i] == k for i in front)
        rest = [i for i in rest if i not in front]
        k += 1


PAPERS = "paper_row long, source string, doi string, abstract string, citation_count int, pdf_url string, retrieved_at timestamp_ntz"


def test_survivors(spark):
    from datetime import datetime

    at = lambda d: datetime(2024, 1, d)
    full = "One two three four five six seven eight. Nine ten eleven twelve thirteen fourteen fifteen sixteen."
    rows = [
        (5, "crossref", "10.1000/A", full[:60], 3, "https://x.example/a.pdf", at(1)), (6, "pubmed", "https://doi.example.org/10.1000/a.", f"<p>{full}</p>", 0, "https://x.example/a.pdf.html", at(3)),
        (7, "openalex", "doi:10.1000%2FA", full, -1, "http://x.example/b.PDF?x=1", at(2)), (8, "crossref", "10.1000/b", None, None, None, at(1)), (9, "openalex", "10.1000/B;", "n/a", 9, "/c.pdf", None), (10, "core", None, full, 1, None, at(1)), (11, "core", "", full, 1, None, at(1)),
    ]
    got = {r["group_row"]: (r["abstract_row"], r["pdf_row"], r["citation_row"]) for r in survivor.found(spark.createDataFrame(rows, PAPERS)).collect()}
    assert got == {5: (6, 7, 5), 8: (0, 0, 9)}
    assert survivor.found(spark.createDataFrame([], PAPERS)).count() == 0


def test_merkle_ignores_order_and_format():
    a = copies.merkle({"compound_id": "13-a", "x": {"B": "Table 1.", "c": [1, 2]}, "target_value": "1,5 – 2"}, {"targetvalue"})
    b = copies.merkle({"target-value": "1.5-2", " X": {"c": [1, 2], "b": "TABLE-1"}, "Compound_Id": "13 A"}, {"targetvalue"})
    assert a == b
    assert copies.merkle({"target_value": "15"}, {"targetvalue"}) != copies.merkle({"target_value": "1.5"}, {"targetvalue"})
    assert copies.merkle({"a": [1, 2]}) != copies.merkle({"a": [2, 1]}) and copies.merkle({"a": None}) != copies.merkle({"a": ""})


def test_copies_against_brute_force(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice(["13a", "13-A", "13 a.", "12", None, ""]), rng.choice(["1.5", "1,5", "15", "> 15", ">15", None]), rng.choice(["C", "c"])) for i in range(1, 120)]
    df = spark.createDataFrame(rows, "id long, cid string, val string, smi string")
    got = {(r["keep_id"], r["dup_id"]) for r in copies.duplicates(df, "id", *copies.flat_tree(df, ["cid", "val", "smi"], ("val",), ("smi",))).collect()}
    groups: dict = {}
    for i, c, v, s in rows:
        groups.setdefault((None if c is None else copies.leaf_text(c, False), None if v is None else copies.leaf_text(v, True), s), []).append(i)
    assert got == {(g[0], x) for g in groups.values() for x in g[1:]}
    folded = copies.fold_copies(df, "id", *copies.flat_tree(df, ["cid", "val", "smi"], ("val",), ("smi",)))
    assert sorted((r["id"], r["keep_id"], r["copies"]) for r in folded.collect()) == sorted((x, g[0], len(g)) for g in groups.values() for x in g)


def test_shared_digests_are_told_apart(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "b"), (5, "c")], "id long, w string")
    got = {(r["keep_id"], r["dup_id"]) for r in copies.duplicates(df, "id", F.lit(7).cast("long"), F.col("w")).collect()}
    assert got == {(1, 3), (2, 4)}


def test_skyline_differs_from_a_maximum_per_field(spark):
    # row 1 is fuller, row 2 newer with a link, row 3 newest but bare: the base is the fullest undominated record, its gaps are filled
    rows = [
        (1, "crossref", "10.1234/a", "Whole text here.", 5, None, None, "T one", ["A"], None, "J", "2024-01-01"),
        (2, "pubmed", "10.1234/a", None, None, "https://x.org/a.pdf", None, "T two", ["A"], 2020, None, "2024-02-01"),
        (3, "core", "10.1234/a", None, None, None, None, "T three", None, None, None, "2024-03-01"),
        (4, "core", "10.1234/b", None, None, None, None, None, None, None, None, None), (5, None, "10.1234/b", None, -1, None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "paper_row long, source string, doi string, abstract string, citation_count int, pdf_url string, extra string, title string, authors array<string>, year int, journal string, at string")
    got = {r["group_row"]: r for r in survivor.records(df.withColumn("retrieved_at", F.col("at").cast("timestamp_ntz"))).collect()}
    a = got[1]
    assert (a["base_row"], a["title"], a["title_source"], a["year"], a["year_source"], a["pdf_url_source"], a["abstract_source"]) == (1, "T one", "crossref", 2020, "pubmed", "pubmed", "crossref")
    assert a["skyline"] == 3 and got[4]["title"] is None and got[4]["copies"] == 2
    cells = [{"words": w, "pdf_ok": p, "count_ok": c, "has": h, "trust": t, "first_row": i, "last_row": i, "last_at": i} for i, (w, p, c, h, t) in enumerate([(9, 1, 1, 3, 2), (9, 0, 1, 3, 2), (0, 1, 0, 15, 1)], 1)]
    kept, level = survivor.skyline(cells)
    assert [level[i] for i, c in enumerate(kept) if c["first_row"] == 2] == [0] and survivor.choose(cells)[:4] == (1, 3, 2, 3)


def test_a_spelling_of_two_entries_names_none_in_trees_and_shards(spark):
    entries = spark.createDataFrame([("e coli", 1), ("e coli", 2), ("escherichia coli", 1), ("entamoeba coli", 2), ("b cereus", 3)], "spelling string, entry long")
    df = spark.createDataFrame([("E. coli",), ("Escherichia coli",), ("entamoeba coli",), ("E coly",), ("Esch. coli",), ("B. cereus",), ("",), (None,)], "v string")
    tree, *sharded = ({r["v"]: r["entry_id"] for r in canonical.map_to_list(df, "v", entries, broadcast_entries=bound, shards=n).collect()} for bound, n in ((100, 1), (0, 1), (0, 2), (0, 5)))
    assert tree["E. coli"] == -1 and tree["Escherichia coli"] == 1 and tree["B. cereus"] == 3 and all(s == tree for s in sharded)


REF = [(1, "Escherichia coli", ["colon bacillus"]), (2, "Staphylococcus aureus", ["MRSA"]), (3, "Staphylococcus epidermidis", []), (4, "Mus musculus", ["mouse"]), (5, "Enterobacter cloacae", [])]
TYPED = {
    "E. coli": 1, "ESCHERICHIA COLI": 1, "Escherichiacoli": 1, "Esch. coli": 1, "coli, Escherichia": 1, "E. Escherichia coli NRQ 123": 1, "Escherichia coli (strain K12": 1, "E. coli (colon bacillus)": 1, "eschercihia cli": 1,
    "Staph. aureus": 2, "mrsa": 2, "S aureus - clinical isolate": 2, "Staphylococcus_epidermidis": 3, "mice": 4, "murine": -1, "Mm": 4, "Ec": -1, "Staphylococcus sp.": -1, "Candida auris": -1, "Staphylococcus haemolyticus": -1, "": -1, "​": -1, "x" * 30000: -1,
}


@pytest.mark.parametrize("bound", [100_000, 0])
def test_organisms_broadcast_and_sharded(spark, bound):
    ref = spark.createDataFrame(REF, "organism_id long, canonical_name string, other_names array<string>")
    df = spark.createDataFrame([*((t,) for t in TYPED), (None,), ("E. coli",)], "v string")
    got = canonical.map_to_list(df, "v", canonical.organism_entries(ref), "organism_id", broadcast_entries=bound, shards=3).collect()
    assert len(got) == len(TYPED) + 2
    assert {r["v"]: r["organism_id"] for r in got} == {**TYPED, None: None}


def test_unit_looks(spark):
    units = spark.createDataFrame([(1, "nM"), (2, "nm"), (3, "µg/mL"), (4, "mM")], "unit_id long, unit_text string")
    assay = spark.createDataFrame([(1, "ոM"), (2, " nM "), (3, "μg/mL"), (4, "ｍM"), (5, None), (6, ""), (7, "µg/mL​"), (8, "furlong"), (9, "nM\u00a0")], "row_id long, target_units string")
    curated = spark.createDataFrame([(1, "nⅿ")], "rec_no long, unit_raw string")
    got = {(r["tbl"], r["row_id"], r["unit_id"]) for r in glyphs.found(assay, curated, units).collect()}
    assert got == {("assay_rows", 1, 1), ("assay_rows", 3, 3), ("assay_rows", 4, 4), ("assay_rows", 7, 3), ("assay_rows", 9, 1), ("curated_records", 1, 2)}
