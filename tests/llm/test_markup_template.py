"""Template slots are told by their whole text, and only that text is removed."""

from __future__ import annotations

from assayloom.llm import markup


def _cleaned(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").selectExpr("id", "t", "'h' as host")
    return {r["id"]: r["clean"]["text"] for r in markup.clean_markup(df, "t", "host").collect()}


def test_texts_that_differ_behind_a_long_beginning_stay(spark):
    notice = "This abstract is made available under the terms of the publisher. " * 4
    got = _cleaned(spark, [f"<p>{notice}Result {i} is new.</p><div>All rights reserved</div>" for i in range(60)])
    assert all(f"Result {i} is new." in got[i] and "All rights" not in got[i] for i in range(60))


def test_a_page_keeps_its_own_text_in_a_template_slot(spark):
    got = _cleaned(spark, [f"<p>Result {i}</p><div>{'Own text' if i == 7 else 'All rights reserved'}</div>" for i in range(60)])
    assert "Own text" in got[7] and not any("All rights" in t for t in got.values())


def test_notices_of_a_host_go_and_formulas_stay(spark):
    rows = [(i, "h" if i % 2 else "other", f"<p>Finding {i} holds. The fit is $E_{{{i}}}$ throughout.</p> Published by Open Press. All rights reserved.") for i in range(120)]
    df = spark.createDataFrame(rows, "id long, host string, t string")
    got = {r["id"]: r["clean"]["text"] for r in markup.clean_markup(df, "t", "host").collect()}
    alone = {i: markup.clean(t)[0] for i, _, t in rows}
    assert all("Open Press" in alone[i] and got[i] == f"Finding {i} holds. The fit is $E_{{{i}}}$ throughout." for i in alone)
    few = {r["id"]: r["clean"]["text"] for r in markup.clean_markup(df.limit(20), "t", "host").collect()}
    assert all("Open Press" in t for t in few.values())  # too few pages to tell template from content


def test_wrappers_do_not_depend_on_how_rows_are_spread(spark):
    rows = [(i, "h", f"<div>Own text {i}.</div><p>Shared notice.</p>" if i % 3 else f"<ul><li>item {i}</li></ul><p>Shared notice.</p>") for i in range(150)]
    df = spark.createDataFrame(rows, "id long, host string, t string")
    one, many = ({r["id"]: r["clean"] for r in markup.clean_markup(df.repartition(n), "t", "host").collect()} for n in (1, 7))
    assert one == many and not any("Shared" in c["text"] for c in one.values())


def test_deep_nesting_and_the_hint_cover_all_markup():
    assert markup.clean("<div>" * 5000 + "x" + "</div>" * 5000)[0] == "x"
    for text in ("&amp;", "<b>x", "# x", "> x", "- x", "1. x", "a\n===", "| a |", "```", "**x", "_x_", "''x", "[[x", "{{x", "](x", "\\item", "\\(x", "$$", "$x_1$"):
        assert markup._HINT.search(text), text


def test_a_notice_among_many_sentences_is_counted_in_full(spark):
    own = lambda i: " ".join(f"Sentence {j} of page {i} is its own." for j in range(200))
    pages = [f"<p>{own(i)}{' Notice of the press.' if i % 2 else ''}{' Rare notice here.' if 0 < i < 30 else ''}</p>" for i in range(60)]
    got = _cleaned(spark, pages)
    assert not any("Notice of the press." in t for t in got.values()) and all(own(i) in got[i] for i in got)  # on 30 pages
    assert sum("Rare notice here." in t for t in got.values()) == 29


def test_a_sentence_that_a_page_repeats_counts_once(spark):
    got = _cleaned(spark, [f"<p>Result {i} is new.</p>" + "<p><i>Result:</i></p><div><p>As stated before.</p></div>" * 2 * (i < 20) for i in range(60)])
    assert all(got[i].count("As stated before.") == 2 for i in range(20))


def test_counts_do_not_depend_on_the_order_of_siblings(spark):
    rows = [(i, "h", "".join([f"<div>Own text {i}.</div>", "<p>Shared notice.</p>", "<pre>x</pre>"][k] for k in ((0, 1, 2), (1, 2, 0), (2, 0, 1))[i % 3])) for i in range(33)]
    df = spark.createDataFrame(rows, "id long, host string, t string")
    got = [r["clean"]["text"] for n in (1, 5) for r in markup.clean_markup(df.repartition(n), "t", "host").collect()]
    assert len(got) == 66 and not any("Shared" in t for t in got)


def test_a_label_within_a_sentence_stays(spark):
    got = _cleaned(spark, [f"<b>Background:</b> Result {i} is new. See <a>the data</a>. <i>All rights reserved.</i>" for i in range(60)])
    assert all(got[i] == f"Background: Result {i} is new. See the data." for i in got)
