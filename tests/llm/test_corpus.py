"""Subjects, packing and mixing."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from assayloom.llm import mixing, packing, subjects

WORDS = {1: "agar broth culture plating colony inhibition", 2: "magnet coil remanence annealing coercivity domain", 3: "statute court licence appeal patent clause"}


def corpus(n=240, seed=1):
    rng = random.Random(seed)
    docs, labels, truth = [], [], {}
    for d in range(n):
        main = rng.choice([1, 2, 3])
        second = rng.choice([0, 0, *(s for s in WORDS if s != main)])
        picks = [main] * 6 + ([second] * 4 if second else [])
        sents = [f"The {' '.join(rng.sample(WORDS[s].split(), 4))} changed by {rng.randint(1, 9)}." for s in picks] + ["The numbers are rounded here."] * 2
        rng.shuffle(sents)
        docs.append((d, " ".join(sents), "s", "en"))
        truth[d] = {main, second} - {0}
        if d % 2:
            labels += [(d, s, "a") for s in truth[d]]
    return docs, labels, truth


def test_subjects(spark):
    docs, labels, truth = corpus()
    docs += [(1000, "", "s", "en"), (1001, None, None, None), (1002, "The numbers are rounded here.", "s", None), (1003, docs[0][1], "s", "en")]
    got: dict = {}
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string")
    for r in subjects.assign_subjects(df, spark.createDataFrame(labels, "doc_id long, subject_id int, annotator string"), spark.createDataFrame([(1,), (2,), (3,)], "subject_id int")).collect():
        got.setdefault(r["doc_id"], set()).add(r["subject_id"])
    assert sum(got.get(d) == t for d, t in truth.items()) >= 0.97 * len(truth)
    assert not {1000, 1001, 1002} & set(got) and got[1003] == got[0]


def test_subjects_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "Some text here.", "s")], "doc_id long, text string, source string")
    labels, ids = spark.createDataFrame([], "doc_id long, subject_id int"), spark.createDataFrame([(1,), (2,)], "subject_id int")
    assert subjects.assign_subjects(docs, labels, ids).count() == 0
    assert subjects.assign_subjects(docs.limit(0), labels, ids).count() == 0


def test_sentences_join_broken_lines():
    assert subjects.sentences("The agar was\nplated on me-\ndium. Next one was not\n\nHeading here") == ["The agar was plated on medium.", "Next one was not", "Heading here"]


def test_beam_finds_the_best_combination():
    rng = np.random.default_rng(0)
    k, f = 4, 3
    chain = [rng.standard_normal(f + j) for j in range(k)]
    x = rng.standard_normal((20, k, f))
    allowed = rng.random((20, k)) < 0.8

    def logp(i, y):
        total = 0.0
        for j, w in enumerate(chain):
            z = x[i, j] @ w[:f] + y[:j] @ w[f:]
            total += -np.logaddexp(0, -z if y[j] else z)
        return total

    got = subjects.beam(chain, x, allowed, width=16)
    for i in range(20):
        combos = [np.array([(c >> j) & 1 for j in range(k)], float) for c in range(16)]
        best = max((y for y in combos if not (y.astype(bool) & ~allowed[i]).any()), key=lambda y: logp(i, y))
        assert (got[i] == best.astype(bool)).all()


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(1, 511), max_size=200), st.data())
def test_pack_keeps_limits(sizes, data):
    t = np.array(sizes, dtype=np.int64)
    loss = np.array([data.draw(st.integers(0, s)) for s in sizes], dtype=np.int64)
    most = (512, 8, 400)
    loss = np.minimum(loss, 400)
    box = packing.pack(t, loss, most)
    assert len(box) == len(t) and (box >= 0).all()
    for b in set(box.tolist()):
        on = box == b
        assert t[on].sum() <= 512 and on.sum() <= 8 and loss[on].sum() <= 400


def test_pack_leaves_little_room():
    rng = np.random.default_rng(2)
    t = np.minimum(rng.lognormal(5, 1, 5000).astype(int) + 1, 2047)
    box = packing.pack(t, t - 1, packing.limits(2048))
    assert t.sum() / ((box.max() + 1) * 2048) > 0.98


@pytest.mark.parametrize("block", [20_000, 7])
def test_pack_documents(spark, block):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice(["agar", "magnet", "solvent"]) for _ in range(rng.choice([1, 5, 40, 300, 2000])))) for i in range(60)] + [(100, ""), (101, None), (102, docs_text := "one"), (103, docs_text)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as total")
    specs = spark.createDataFrame([(1, 64), (2, 512)], "spec_id int, capacity_tokens int")
    got = packing.pack_documents(df, specs, block=block).collect()
    from assayloom.llm.tokens import encoding

    size = {i: len(encoding().encode_ordinary(t or "")) for i, t in docs}
    for spec, cap in ((1, 64), (2, 512)):
        rows = [r for r in got if r["spec_id"] == spec]
        fill, parts = {}, {}
        for r in rows:
            parts.setdefault(r["doc_id"], []).append((r["start_token"], r["n_tokens"]))
            if r["container_id"] is not None:
                fill[r["container_id"]] = fill.get(r["container_id"], 0) + r["n_tokens"]
        assert max(fill.values()) <= cap and set(parts) == set(size)
        for d, p in parts.items():
            assert sum(n for _, n in p) == size[d] and (len(p) == 1 or size[d] > cap)
            assert [s for s, _ in sorted(p)] == [k * cap for k in range(len(p))]


def test_rake_meets_sources_and_caps():
    tokens = np.array([100.0, 300, 50, 50])
    source, lang = np.array([0, 0, 1, 1]), np.array([0, 1, 0, 1])
    w, size = mixing.rake(tokens, [(lang, np.array([0.5, 0.5]))], np.array([2.0, 2, 4, 4]), source, np.array([0.5, 0.5]))
    held = np.bincount(source, weights=w * tokens)
    assert np.allclose(held, size / 2) and size == 800 and (w <= np.array([2, 2, 4, 4]) + 1e-9).all()
    w, size = mixing.rake(tokens, [], np.ones(4), source, np.array([0.0, 0.0]))
    assert size == 0 and not w.any()


def test_rake_meets_all_margins_where_scaling_does_not():
    rng = np.random.default_rng(1)
    source, lang, topic = (x.ravel() for x in np.meshgrid(range(5), range(4), range(12), indexing="ij"))
    tokens = rng.lognormal(8, 1.5, len(source)).round()
    share, cap = np.array([0.3, 0.1, 0.25, 0.2, 0.15]), np.array([1, 4, 2, 3, 2.0])[source]
    margins = [(g, np.bincount(g, weights=tokens) / tokens.sum()) for g in (lang, topic)]
    got = lambda w, g: np.bincount(g, weights=w * tokens) / (w * tokens).sum()
    plain, _ = mixing.rake(tokens, [], cap, source, share)
    w, _ = mixing.rake(tokens, margins, cap, source, share)
    assert all(np.abs(got(w, g) - goal).max() < 1e-3 for g, goal in [*margins, (source, share)]) and (w <= cap + 1e-9).all()
    assert all(np.abs(got(plain, g) - goal).max() > 1e-2 for g, goal in margins) and np.abs(w - plain).max() > 0.1


def test_given_language_shares_are_reached(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(i, rng.choice("ab"), "en" if rng.random() < 0.8 else "de", "word " * rng.randint(1, 9)) for i in range(2000)], "doc_id long, source string, lang string, text string")
    targets = spark.createDataFrame([(1, "a", 0.5, 4), (1, "b", 0.5, 4)], "mix_id int, source string, target_share double, max_repeats int")
    drawn = mixing.mix_sources(df, targets, langs={"en": 0.6, "de": 0.4}, room=0.5).join(df.select("doc_id", "lang"), "doc_id")
    tokens = {r[0]: r[1] for r in drawn.groupBy("lang").agg(F.sum(F.col("tokens") * F.col("copies"))).collect()}
    assert abs(tokens["de"] / sum(tokens.values()) - 0.4) < 0.01


def test_loss_limit_binds(spark):
    df = spark.createDataFrame([(i, ("ask me now " * 20 + "\n\n" if i % 2 else "") + "answer given " * 40) for i in range(200)], "doc_id long, text string")
    specs = spark.createDataFrame([(1, 400)], "spec_id int, capacity_tokens int")
    full = {}
    for share in (1.0, 0.6):
        got = packing.pack_documents(df, specs, loss_share=share).groupBy("container_id").agg(F.sum("n_tokens").alias("n"), F.sum("n_loss").alias("loss"), F.count("*").alias("k")).collect()
        assert all(r["n"] <= 400 and r["loss"] <= 400 * share for r in got) and sum(r["k"] for r in got) == 200
        full[share] = max(r["loss"] for r in got)
    assert full[1.0] > 240 >= full[0.6]


def test_short_texts_fill_containers(spark):
    df = spark.createDataFrame([(i, "agar") for i in range(1000)] + [(2000, "agar " * 30)], "doc_id long, text string")
    specs = spark.createDataFrame([(1, 64), (2, 512)], "spec_id int, capacity_tokens int")
    for r in packing.fill_report(df, specs).collect():
        assert r["containers"] == r["least_containers"] and r["tokens"] >= 1030
    held = packing.pack_documents(df, specs, segment_share=0.25).groupBy("spec_id", "container_id").count().groupBy("spec_id").agg(F.max("count")).collect()
    assert {tuple(r) for r in held} == {(1, 16), (2, 128)}


def test_mix_sources(spark):
    rng = random.Random(4)
    docs = [(i, rng.choice(["a", "a", "a", "b", "c"]), rng.choice(["en", "de", None]), "word " * rng.randint(1, 60)) for i in range(600)] + [(1000, None, "en", "x"), (1001, "a", "en", ""), (1002, "a", "en", None)]
    df = spark.createDataFrame(docs, "doc_id long, source string, lang string, text string")
    targets = spark.createDataFrame([(1, "a", 0.5, 1), (1, "b", 0.3, 5), (1, "c", 0.2, 5), (2, "b", 0.5, 2), (2, "zzz", 0.5, 2)], "mix_id int, source string, target_share double, max_repeats int")
    topics = spark.createDataFrame([(i, i % 3 + 1) for i in range(0, 600, 2)], "doc_id long, subject_id int")
    drawn = mixing.mix_sources(df, targets, topics, block=50).cache()
    got = {(r["mix_id"], r["source"]): r for r in mixing.shares(drawn, targets).collect()}
    for s, share in (("a", 0.5), ("b", 0.3), ("c", 0.2)):
        assert abs(got[1, s]["reached_share"] - share) < 0.01 and got[1, s]["most_copies"] <= got[1, s]["max_repeats"]
    assert got[2, "b"]["reached_share"] == 1.0 and got[2, "zzz"]["tokens"] == 0
    assert drawn.filter("doc_id >= 1000").count() == 0
    assert mixing.mix_sources(df.limit(0), targets).count() == 0
