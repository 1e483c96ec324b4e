"""Matching of papers: field forms, exact comparison, skip-gram, components, the whole operator."""

from __future__ import annotations

import random

import numpy as np
import pytest

from assayloom.llm.bibkeys import edits, same_word, surname, surnames, title_key
from assayloom.llm.compare import Record, authors_agree, compare, words_agree
from assayloom.llm import walks as vectors
from assayloom.llm.match import components, match_papers, match_works, is_preprint
from assayloom.llm.walks import Embedder, companions, graph, skipgram, walks

SCHEMA = "paper_row long, source string, doi string, title string, authors array<string>, year int"


@pytest.mark.parametrize(
    ("author", "want"),
    [("Petrik Müard", "muard"), ("Müard, Petrik A.", "muard"), ("Müard PA", "muard"), ("Müard P.", "muard"), ("P. A. Müard", "muard"), ("PA Müard", "muard"), ("MÜARD Petrik", "muard"), ("Petrik MÜARD", "muard"), ("et al.", None), ("…", None), ("", None)],
)
def test_surname(author, want):
    assert surname(author) == want


def test_titles():
    assert title_key("Green <i>study</i> of 4-allyl-indole: an open set") == ("", "green study of 4 allyl indole", "an open set", False)
    assert title_key("Correction to: Green study")[0] == "c" and title_key("Reply on: Green study")[0] == "r" and title_key("Green study. Part 2")[0] == "2"
    assert title_key("Green study of ...")[3] and title_key(None) == ("", "", "", False)
    assert title_key("beta-lactamase optimization")[1] == title_key("β-lactamase optimisation")[1]
    assert surnames(None) == []


def test_words():
    assert edits("abcd", "abdc") == 1 and same_word("synthesis", "synthseis") and not same_word("4", "5")
    often = {"thiazole": 500, "triazole": 500, "of": 9000, "off": 20, "phenyl": 400, "study": 900, "salts": 300}
    assert words_agree("study of phenyl", "study off phenyl", often)[0]
    assert not words_agree("thiazole salts", "triazole salts", often)[0]
    assert not words_agree("4 phenyl", "5 phenyl", often)[0]
    assert words_agree("study of phenyl", "studyof phenyl", often)[0]
    assert words_agree("study of phe", "study of phenyl salts", often, prefix=True)[0]


def rec(main, kind="", sub="", cut=False, authors=("a",), year=2020, doi=None, preprint=False):
    return Record(kind, main, sub, cut, tuple(authors), year, doi, preprint)


def test_compare():
    t = "green structural study of 4 allyl indole salts"
    assert compare(rec(t), rec(t), {})[0] > 0.9
    assert compare(rec(t), rec(t, kind="2"), {})[1] == "kind" and compare(rec(t), rec(t, year=2024), {})[1] == "year"
    assert compare(rec(t), rec(t, authors=("z",)), {})[1] == "authors"
    assert compare(rec(t, doi="10.1/a.11111111"), rec(t, doi="10.1/a.22222222"), {})[1] == "doi"
    assert compare(rec(t, doi="10.1/a.11111111"), rec(t, doi="10.2/22222222", preprint=True), {})[0] > 0
    assert compare(rec(t, doi="10.1/a.111"), rec(t, doi="10.1/a.11111111"), {})[0] > 0
    assert compare(rec(t), rec("green structural study of 4 al", cut=True), {})[0] > 0
    assert compare(rec(t, sub="one"), rec(t, sub="another thing"), {})[0] == 0
    assert compare(rec(""), rec(""), {})[0] == 0
    assert authors_agree((), ("a",)) is None and authors_agree(("a", "b"), ("b",)) == 1.0


def test_skipgram_brings_companions_together():
    rng = np.random.default_rng(0)
    walked = np.concatenate([rng.choice([0, 1, 2], (200, 8)), rng.choice([3, 4, 5], (200, 8))])
    tokens = ["quince", "plum", "vexed", "dogma", "sphinx", "jackal"]
    v = skipgram(walked, tokens, rate=0.2, epochs=20)
    x = [np.sum([v[g] for g in vectors.grams(t)], axis=0) for t in tokens]
    x = [y / np.linalg.norm(y) for y in x]
    raw = [np.sum([vectors.untrained(g) for g in vectors.grams(t)], axis=0) for t in tokens]
    raw = [y / np.linalg.norm(y) for y in raw]
    assert x[0] @ x[1] > raw[0] @ raw[1] and x[0] @ x[1] > x[0] @ x[4]
    assert skipgram(np.full((0, 8), -1), []) == {} and companions(np.array([[0, 1, -1]]), 2, 2).tolist() == [[0, 1], [1, 0]]


def test_walks_pass_through_every_attribute():
    records = [rec("alpha", authors=("muard",), year=2001, doi="10.1/a"), rec("beta", authors=("muard",), year=2002), rec("gamma", authors=(), year=2002), rec("delta", authors=(), year=None, doi="10.1/a"), rec("", authors=(), year=None)]
    g = graph(records)
    got = walks(g, np.random.default_rng(1), per_record=40)
    assert {g.tokens[t] for t in set(got[got >= 0])} == {"alpha", "beta", "gamma", "delta", "muard", "year 2001", "year 2002", "doi 10.1/a"}
    assert (got[4] == -1).all() and (got[:4] >= 0).all() and len(walks(graph([]), np.random.default_rng(1))) == 0


def test_views_of_equal_stretches_are_equal():
    e = Embedder({}, {}, 1.0)
    mains = ["one two three four five six seven eight nine ten eleven", "one two three four five six seven eight nine twelve", "one", ""]
    got = e.views(mains, [("muard", "kelrud"), ("muard",), (), ()])
    assert got["title"][0].tolist() == [0, 1, 2] and got["second"][0].tolist() == [0]
    assert (got["head"][1][0] == got["head"][1][1]).all() and (got["lead"][1][0] == got["lead"][1][1]).all()
    assert e.cosines(["a b", ""], ["a b", "c"]).round(6).tolist() == [1.0, 0.0] and len(e.cosines([], [])) == 0


def test_zero_vectors_find_nothing_but_copies(spark, monkeypatch):
    df = spark.createDataFrame(papers(), SCHEMA)
    monkeypatch.setattr("assayloom.llm.match.skipgram", lambda walked, tokens: {g: np.zeros(vectors.DIM, np.float32) for t in tokens for g in vectors.grams(t)})
    assert match_papers(df).count() == 4  # rows equal in every compared field


def test_preprint_servers_name_no_journal(spark):
    rows = [("10.5/a", False)] * 6 + [("10.6/b", True)] * 6 + [("10.7/c", False)] + [(None, False)]
    df = spark.createDataFrame(rows, "doi string, named boolean")
    assert [r[0] for r in df.filter(is_preprint(df)).select("doi").distinct().collect()] == ["10.5/a"]


def test_components_against_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 540)]
    edges = [(min(e), max(e)) for e in edges if e[0] != e[1]]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    got = {r["c"]: r["work"] for r in components(spark.createDataFrame([(a, b, 0.9) for a, b in edges], "a long, b long, confidence double")).collect()}
    assert got == {x: find(x) for e in edges for x in e}


def papers():
    base = "Rational structural study of {} derivatives active against {}: an open data set"
    rows, n = [], 0
    for k, (c, o) in enumerate([("4-allyl-indole", "Escherichia coli"), ("5-bromo-thiazole", "Candida albicans"), ("2,6-difuryl-quinoline", "Bacillus cereus"), ("N-tosyl-pyrazole", "Proteus vulgaris")]):
        title = base.format(c, o)
        for source, t, a in [("crossref", title, ["Petrik Müard", f"Ivo Kel{k}rud"]), ("pubmed", title.upper(), ["Muard P", f"Kel{k}rud I"]), ("core", title.replace("derivatives", ["dervatives", "derivtaives", "derivativse", "drivatives"][k]), ["Müard, Petrik", f"Kel{k}rud, Ivo"])]:
            n += 1
            rows.append((n, source, f"10.9/x.{k:08d}" if source == "crossref" else None, t, a, 2020 + k))
    return rows


def test_match_papers(spark):
    rows = papers()
    rows += [(100, "arxiv", None, "Correction to: " + rows[0][3], rows[0][4], 2020), (101, "arxiv", None, None, None, None), (102, "arxiv", "", "", [], None)]
    rows += [(103, "crossref", rows[0][2], rows[0][3], rows[0][4], 2020)]  # a repeat with the same DOI
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as confidence")
    got = {(r["paper_row_a"], r["paper_row_b"]) for r in match_papers(df.drop("confidence")).collect()}
    want = {(a, b) for k in range(4) for a in range(3 * k + 1, 3 * k + 4) for b in range(a + 1, 3 * k + 4)} | {(2, 103), (3, 103)}
    assert got == want
    works = {r["paper_row"]: (r["work_row"], r["n_rows"]) for r in match_works(df.drop("confidence")).collect()}
    assert works[2] == (1, 4) and works[103] == (1, 4) and works[100] == (100, 1) and works[101] == (None, None)


def test_match_nothing(spark):
    assert match_papers(spark.createDataFrame([], SCHEMA)).count() == 0 and match_works(spark.createDataFrame([], SCHEMA)).count() == 0
