"""Candidates and works of the paper matching against brute force: reach of the views, crowded buckets, mixed components."""

from __future__ import annotations

import random

import pytest

from assayloom.llm import match
from assayloom.llm.compare import authors_agree

BUCKET = "key long, sign int, c long, doi long, about int, who0 long, who1 long, ends long"


def test_reach(spark):
    rows = spark.createDataFrame([(1, 0, 1, 0, 0, 0, 0, 0), (1, (1 << match.REACH) - 1, 2, 0, 0, 0, 0, 0), (1, -1, 3, 0, 0, 0, 0, 0)], BUCKET)
    assert {tuple(r) for r in match.candidates(rows).collect()} == {(1, 2)}


def test_the_author_filter_drops_no_agreeing_pair(spark):
    lists = [(), ("muard",), ("muarx",), ("xuard",), ("zelk",), ("muard", "kelrud"), ("kelrud", "ostiman", "brem"), ("kelrux", "ostiman"), ("a", "b", "c"), ("lamholt",) * 9]
    rows = []
    for c, names in enumerate(lists):
        masks = [m - (1 << 64) if m >> 63 else m for m in match._masks(names)]
        rows.append((1, 0, c, 0, min(len(names), 2) << 22, *masks))
    got = {tuple(r) for r in match.candidates(spark.createDataFrame(rows, BUCKET)).collect()}
    want = {(i, j) for i, x in enumerate(lists) for j, y in enumerate(lists) if i < j and authors_agree(x, y) in (None, *[k / 10 for k in range(5, 11)], 2 / 3)}
    assert want <= got and len(got) < len(lists) * (len(lists) - 1) / 2


def test_every_view_has_a_table_and_longer_keys_have_more():
    assert set(match.tables(match.BITS)) == set(match.VIEWS) and len(match.tables(match.BITS + 5)) == len(match.VIEWS) + 5 and len(match.tables(1)) == len(match.VIEWS)


@pytest.mark.parametrize("known", [match.KNOWN_CROWDS, 0])
def test_crowded_buckets_lose_no_pair(spark, monkeypatch, known):
    monkeypatch.setattr(match, "CROWD", 20)
    monkeypatch.setattr(match, "KNOWN_CROWDS", known)
    rng = random.Random(3)
    sign = lambda: sum(1 << b for b in rng.sample(range(31), 8))
    rows = [(key, sign(), c, 0, 0, 0, 0, 0) for c, key in enumerate([7] * 150 + [8] * 15 + [9] * 45)]
    got = [tuple(r) for r in match.candidates(spark.createDataFrame(rows, BUCKET)).collect()]
    want = {(a[2], b[2]) for a in rows for b in rows if a[2] < b[2] and a[0] == b[0] and (a[1] ^ b[1]).bit_count() <= match.REACH}
    assert len(want) > 1000 and set(got) == want and len(got) == len(want)


def test_mixed_component_is_cut_at_its_weakest_link(spark):
    # x-y match, y and z share a DOI that is not of the form of the tables, a false link joins them to another work
    classes = spark.createDataFrame([(1, None, False), (2, "10.1/j.a-7", False), (3, "10.1/j.a-7", False), (4, "10.1/j.b-9", False), (5, None, False), (6, "10.2/1", True), (7, "10.1/j.b", False)], "c long, doi string, preprint boolean")
    found = spark.createDataFrame([(1, 2, 0.9), (1, 5, 0.6), (4, 5, 0.8), (4, 6, 0.95), (5, 7, 0.7)], "a long, b long, confidence double")
    carried = spark.createDataFrame([(3, 2, 1.0)], "a long, b long, confidence double")
    got = {r["c"]: (r["work"], r["weakest"]) for r in match.parted(found, carried, classes).collect()}
    assert got == {1: (1, 0.9), 2: (1, 0.9), 3: (1, 0.9), 4: (4, 0.7), 5: (4, 0.7), 6: (4, 0.7), 7: (4, 0.7)}


def test_split_work_keeps_a_component_without_conflict():
    got = match.split_work([(1, 2, 0.6, False, "10.1/x.12", None), (2, 3, 0.9, False, None, "10.1/x.1234")])
    assert {w for _, w, _ in got} == {1} and {x for *_, x in got} == {0.6} and match.split_work([]) == []
