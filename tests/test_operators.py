"""Operators on small tables, several against brute force."""

from __future__ import annotations

import json
import random
from collections import Counter

from pyspark.sql import functions as F

from assayloom.functions import identity
from assayloom.operators import curate, extract, fuzzy, graph, joins, order, pools, quantities, retrieve, routing, score, standardise
from assayloom.sources import readers, writers
from assayloom.streaming import windows

RECORD = "rec_no long, source_pdf string, source_type string, extractor string, evidence string, name_raw string, name_std string, smiles_raw string, smiles_canonical string, inchikey string, pubchem_cid string, cas string, formula string, mw double, target_raw string, organism_raw string, property string, value_raw string, unit_raw string, value_std double, unit_std string, value_op string, validation string, validation_detail string, review_reason string, is_primary boolean, conflict_flag boolean, needs_review boolean, dup_group string, conflict_group string, extracted_at string"


def record(i, **kw):
    base = dict.fromkeys(c.split()[0] for c in RECORD.split(", "))
    return tuple((base | {"rec_no": i, "source_pdf": "p", "validation": "passed", "property": "MIC", "unit_std": "nM", "extracted_at": "t"} | kw).values())


def test_number_is_dense_and_ordered(spark):
    keys = random.Random(1).sample(range(10**6), 500)
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(7)
    got = {r["k"]: r["number"] for r in order.number(df, "k").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys), 1)}


def test_running_number_over_cells(spark):
    rows = [(random.Random(i).choice("ab"), i) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, i long").repartition(5)
    got = {(r["g"], r["i"]): r["n"] for r in order.running_number(df, ["g"], "i", "n", step=50).collect()}
    for g in "ab":
        assert [got[g, i] for x, i in rows if x == g] == list(range(sum(x == g for x, _ in rows)))


def test_keep_first_equals_greedy(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["", None, "d1", "D2 ", "d3"]), rng.choice(["", "A b.", "a  b", "c", None])) for i in range(200)]
    got = sorted(r[0] for r in retrieve.keep_first_two_phase(spark.createDataFrame(rows, "paper_row long, doi string, title string")).collect())
    seen, mid = set(), []
    for i, d, t in rows:
        k = (d or "").strip().lower()
        if not k or k not in seen:
            seen.add(k)
            mid.append((i, t))
    titles, want = set(), []
    for i, t in mid:
        k = " ".join((t or "").lower().split()).replace(".", "")
        if not k or k not in titles:
            titles.add(k)
            want.append(i)
    assert got == want


def test_multiset_equals_loop(spark):
    rng = random.Random(3)
    gold = [(a, rng.choice(["1", "2", None]), rng.choice("xy")) for a in "pq" for _ in range(20)]
    pred = [(a, rng.choice(["1", "2", "NOT_DETECTED", None]), rng.choice("xyz")) for a in "p" for _ in range(15)]
    mk = lambda rows: spark.createDataFrame(rows, "pdf string, u string, v string")
    got = {(r["article"], r["field"]): (r["tp"], r["fp"], r["fn"]) for r in score.multiset_counts(mk(gold), mk(pred), "pdf", ["u", "v"]).collect()}
    for a in "pq":
        for k, f in enumerate(("u", "v"), 1):
            g = Counter(r[k] or "nan" for r in gold if r[0] == a)
            p = Counter(r[k] or "NOT_DETECTED" for r in pred if r[0] == a)
            tp = sum((g & p).values())
            assert got[a, f] == (tp, sum(p.values()) - tp, sum(g.values()) - tp)


def test_duplicates_and_conflicts(spark):
    rows = [
        record(1, inchikey="A", value_std=1.0), record(2, inchikey="A", value_std=1.0, validation="failed"), record(3, inchikey="A", value_std=5.0, value_raw="5"), record(4, inchikey="A", value_std=5.00001, value_raw="5.0"),
        record(5, name_std="x", value_std=1.0), record(6, cas="c", property=None), record(7, cas="c", property=None, name_raw="n"), record(8, name_std="X", value_std=9.0), record(9, inchikey="", value_std=None),
    ]
    df = spark.createDataFrame(rows, RECORD)
    got = {r["dup_group"]: (r["n"], r["dup_level"], r["primary_rec"]) for r in curate.duplicate_groups(df).collect()}
    assert got == {"dup_001": (2, 1, 1), "dup_002": (2, 4, 3), "dup_003": (2, 2, 6)}
    assert sorted(r[0] for r in curate.primary_view(df).collect()) == [1, 3, 5, 6, 8, 9]
    clash = {r["eid"]: (r["conflict_group"], r["n"]) for r in curate.value_conflicts(df).collect()}
    assert clash == {"ik:A": ("conf_001", 4), "nm:x": ("conf_002", 2)}


def test_curation_of_an_empty_table(spark):
    df = spark.createDataFrame([], RECORD)
    assert curate.duplicate_groups(df).count() == 0 and curate.value_conflicts(df).count() == 0 and curate.issue_counts(df).count() == 0
    assert curate.report_counts(df).collect()[0]["records"] == 0


def test_entity_never_failed(spark):
    df = spark.createDataFrame([record(1, inchikey="A", validation="failed", cas=None), record(2, inchikey="A", validation="failed", cas="c2"), record(3, inchikey="B", validation="passed")], RECORD)
    got = {r["eid"]: (r["validation"], r["cas"]) for r in curate.collapse_entities(df).collect()}
    assert got == {"ik:A": ("unverified", "c2"), "ik:B": ("passed", None)}


def test_chunks_overlap(spark):
    text = "\n\n".join(f"{'x' * 90} {i}" for i in range(10))
    chunks = spark.createDataFrame([(text,)], "t string").select(extract.chunked(F.col("t"), 300, 50)).first()[0]
    assert len(chunks) > 3 and all(b.startswith(a[-50:].strip()) or a[-50:].strip()[:20] in b for a, b in zip(chunks, chunks[1:]))


def test_focus_lines_marks_gaps(spark):
    body = "\n".join(["a", "b", "c", "hit", "d", "e", "f", "g", "h", "i", "hit", "j"])
    got = [(r["pos"], r["gap"]) for r in extract.focus_lines(spark.createDataFrame([(1, body)], "k int, t string"), "k", "t", "hit", 1, 1).orderBy("pos").collect()]
    assert got == [(2, 1), (3, 0), (4, 0), (9, 1), (10, 0), (11, 0)]


def test_inverted_index_round_trip(spark):
    docs = [(1, "b a b c"), (2, "x")]
    index = extract.inverted_index(spark.createDataFrame(docs, "k int, t string"), "k", "t")
    assert sorted((r["k"], r["text"]) for r in extract.rebuilt(index, "k").collect()) == docs


def test_markdown_table(spark):
    md = "text\n| id | MIC |\n|:--|--|\n| 3a | 5 |\n| 3b | |\n"
    got = [(r["row"], r["header"], r["value"]) for r in extract.markdown_cells(spark.createDataFrame([(1, md), (2, "no table"), (3, None)], "k int, t string"), "k", "t").orderBy("row", "header").collect()]
    assert got == [(0, "MIC", "5"), (0, "id", "3a"), (1, "MIC", ""), (1, "id", "3b")]


def test_figure_context_and_caption(spark):
    blocks = spark.createDataFrame([(1, 1, 0.0, 10.0, 0.0, 5.0, "above"), (1, 2, 0.0, 10.0, 30.0, 40.0, "below"), (1, 3, 50.0, 60.0, 30.0, 40.0, "aside"), (1, 4, 0.0, 10.0, 900.0, 910.0, "far")], "page int, block_id int, x0 double, x1 double, y0 double, y1 double, text string")
    figs = spark.createDataFrame([(1, "F1", 2.0, 8.0, 10.0, 25.0)], "page int, fig_id string, x0 double, x1 double, y0 double, y1 double")
    assert extract.figure_context(blocks, figs).collect()[0]["context"] == "above below"
    caps = spark.createDataFrame([(1, 27.0, "Fig 1"), (1, 400.0, "Fig 2")], "page int, y0 double, caption string")
    assert extract.nearest_caption(figs, caps).collect()[0]["caption"] == "Fig 1"


def test_joins_in_time_against_loops(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["view", "error", "click", "purchase"]), rng.randint(1, 3), rng.randint(0, 20000)) for i in range(150)]
    df = spark.createDataFrame(rows, "event_id long, event_type string, user_id long, s long").withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz")).drop("s")
    got = {r[0]: r[1] for r in joins.overlapping(df, "view", "error", 600).collect()}
    want = Counter(a[2] for a in rows for b in rows if a[1] == "view" and b[1] == "error" and a[2] == b[2] and abs(a[3] - b[3]) <= 600)
    assert got == dict(want)
    near = {r["event_id"]: r["gap_s"] for r in joins.nearest_in_time(df, "view", "error").collect()}
    assert near == {a[0]: min(abs(a[3] - b[3]) for b in rows if b[1] == "error" and b[2] == a[2]) for a in rows if a[1] == "view" and any(b[1] == "error" and b[2] == a[2] for b in rows)}
    prev = {r["event_id"]: r["left_id"] for r in joins.last_before(df, "click", "purchase", 3600).collect()}
    for p in (r for r in rows if r[1] == "purchase"):
        c = [b for b in rows if b[1] == "click" and b[2] == p[2] and b[3] <= p[3]]
        last = max(c, key=lambda b: (b[3], b[0]), default=None)
        assert prev.get(p[0]) == (last[0] if last and p[3] - last[3] <= 3600 else None)


def test_pool_is_taken_in_turn(spark):
    rows = spark.createDataFrame([("p", i) for i in range(5)], "pdf string, row_id long")
    pool = spark.createDataFrame([("p", "A"), ("p", "B"), ("p", "B")], "pdf string, smiles string")
    assert [r["smiles"] for r in joins.cycle_pool(rows, pool, ["pdf"], "row_id", "smiles").orderBy("row_id").collect()] == list("ABABA")


def test_reconcile(spark):
    rows = [("a", "decimer", "X"), ("a", "vision", "X"), ("b", "decimer", "X"), ("b", "vision", "Y"), ("c", "vision", None), ("d", "vision", "X"), ("e", "decimer", "X"), ("e", "other", "X"), ("e", "molscribe", "Y"), ("f", "other", "")]
    got = {r["item"]: tuple(r)[1:] for r in routing.reconcile(spark.createDataFrame(rows, "item string, engine string, v string"), "item", "engine", "v").collect()}
    assert got == {"a": ("ok", "X", 0.95, []), "b": ("disagree", "Y", 0.3, ["X"]), "c": ("failed", None, 0.0, []), "d": ("review", "X", 0.6, []), "e": ("disagree", "Y", 0.3, ["X"]), "f": ("failed", None, 0.0, [])}


def test_issues_as_the_fixed_values_give_them(spark):
    rows = [("Unparseable SMILES", "malformed smiles", None), (None, "unit missing; weak activity", True), (None, "suspicious range", False), ("name did not resolve", None, None), (None, "unit assumed", None)]
    got = {r["issue"]: r["n"] for r in curate.issue_counts(spark.createDataFrame(rows, "validation_detail string, review_reason string, conflict_flag boolean")).collect()}
    assert got == {"malformed SMILES": 1, "missing unit": 2, "weak/inactive value (>1 mM)": 1, "conflicting value": 1, "value reported as range": 1, "suspicious range (descending/too wide)": 1, "unresolved compound name": 1}


def test_name_clusters_join_records_without_identifiers(spark):
    cols = "rec_no long, inchikey string, pubchem_cid string, cas string, smiles_canonical string, name_std string, name_raw string, property string, value_std double, unit_std string, validation string, extracted_at string, " + ", ".join(f"{c} string" for c in ("source_pdf", "source_type", "smiles_raw", "value_raw", "unit_raw", "target_raw"))
    rows = [(i, None, None, None, None, n, n, "MIC", 5.0, "nM", None, "t", *[None] * 6) for i, n in enumerate(["4-allyl indole", "4-allyl-indole", "other thing"], 1)]
    df = spark.createDataFrame(rows, cols)
    leaders = spark.createDataFrame([("4-allyl indole", "4-allyl indole"), ("4-allyl-indole", "4-allyl indole"), ("other thing", "other thing")], "name string, leader string")
    assert curate.duplicate_groups(df).count() == 0
    assert [tuple(r) for r in curate.duplicate_groups(df, leaders).collect()] == [("dup_001", 2, 4, 1, 1)]


def test_roles_and_captions(spark):
    df = spark.createDataFrame([(" Substrate",), ("starting material",), ("reaction medium",), ("inhibitor",)], "r string")
    assert [r[0] for r in df.select(graph.canonical_role(F.col("r"))).collect()] == ["reactant", "reactant", "reaction_medium", None]
    caps = [("Dose-response of x",), ("FTIR spectra",), ("SEM of y: a sem image",), ("Synthesis route",), ("Proposed pathway",), ("Yield over time",), ("The design",), ("nothing",), (None,)]
    got = [r[0] for r in spark.createDataFrame(caps, "c string").select(retrieve.data_relevance(F.col("c"))).collect()]
    assert got == ["binding_curve", "spectrum", "micrograph", "structure", "mechanism", "performance_plot", "workflow", None, None]


def test_figures_by_number_class_words_and_paper(spark):
    caps = spark.createDataFrame([(1, "p", "Fig. 2 Binding isotherm of agar"), (2, "q", "Figure 3. Yield of agar"), (3, "p", "Agar gel"), (4, "p", "Unrelated")], "id long, paper string, caption string")
    got = lambda q, **k: [(r["id"], r["score"]) for r in retrieve.route_figures(caps, q, "id", "caption", **k).collect()]
    assert got("What does Figure 3 show about agar?") == [(2, 106), (1, 6), (3, 4)]
    assert got("Which isotherm of agar is shown?", paper="paper", top_paper="p") == [(1, 38), (3, 7), (2, 6)]
    assert got("What about agar?") == []


def test_chunks_by_hand(spark):
    texts = [("a" * 10 + "\n\n" + "b" * 10 + "\n \n" + "c" * 10,), ("x" * 50,), ("",), (None,), ("one\n\n\n two ",), ("  \n\n ",)]
    got = [r[0] for r in spark.createDataFrame(texts, "t string").select(extract.chunked(F.col("t"), 25, 4)).collect()]
    assert got == [["a" * 10 + "\n\n" + "b" * 10, "bbbb\n\n" + "c" * 10], ["x" * 50], [], [], ["one\n\ntwo"], []]
    assert spark.createDataFrame([(" ab\n\ncd",)], "t string").select(extract.chunked(F.col("t"), 3, 0)).first()[0] == ["ab", "cd"]


def test_measures_by_hand(spark):
    text = "Compound 4a had an IC₅₀ of 5.2 µM. Its solubility in water is 3 mg/mL and logP = -1.5; (7b) MIC: 3-5 µM, mp 120-122 °C, 85% yield; yield of 90 %."
    got = [(r["kind"], r["property"], r["value"], r["unit"], r["compound"]) for r in extract.measures_in_text(spark.createDataFrame([(1, text), (2, None), (3, "nothing")], "id long, t string"), "id", "t").orderBy("kind", "position").collect()]
    assert got == [("affinity", "IC50", "5.2", "µM", "4a"), ("affinity", "MIC", "3-5", "µM", "7b"), ("logp", "logP", "-1.5", None, "4a"), ("melting_point", "melting_point", "120-122", "°C", "7b"), ("solubility", "solubility", "3", "mg/mL", "4a"), ("yield", "yield", "85", "%", "7b"), ("yield", "yield", "90", "%", "7b")]


def test_table_measures_by_hand(spark):
    md = "| Entry | IC50 (nM) | note |\n|---|---|---|\n| 3a | 12 | x |\n| - | 5 | x |\n| 3b | n/d | x |\n| 3c |"
    got = [tuple(r)[1:] for r in extract.table_measures(spark.createDataFrame([("t1", md), ("t2", "no table"), ("t3", None)], "k string, b string"), "k", "b").collect()]
    assert got == [(0, "3a", "IC50", "conc", "nM", "12", "[t1] IC50 (nM) = 12")]
    figs = spark.createDataFrame([("p", "figure", "b", "two"), ("p", "figure", "a", "one"), ("p", "table", "a", " "), ("q", "table", "a", "t")], "paper string, kind string, asset_id string, t string")
    assert sorted(tuple(r) for r in extract.asset_chunks(figs, "paper", "kind", "t").collect()) == [("p", "p:f_0", "one"), ("p", "p:f_1", "two"), ("q", "q:t_0", "t")]


def test_standardised_records_by_hand(spark):
    cases = [
        ("IC50", "5", "µM", None), ("IC50", "5", None, "old"), ("MIC", "> 3", "mg/L", None), ("MIC", "2-4", "µM", None), ("mp", "100", "°F", None), ("yield", "50", "x", None), ("logP", "1.5", None, None),
        ("IC50", "abc", "nM", None), ("IC50", "< 2e6", "nM", None), ("strange", "7", "u", None), (None, None, None, None), ("Ki", "9-3", "nM", None), ("Kd", "1", "nM", None), ("MW", "1.2", "kDa", None),
    ]
    df = spark.createDataFrame([(i, *c, "binding assay", None) for i, c in enumerate(cases)], "id int, property string, value_raw string, unit_raw string, review_reason string, assay_type_raw string, organism_raw string")
    got = [(r["property"], r["value_std"], r["unit_std"], r["conversion_note"], r["value_op"], r["value_min"], r["value_max"], r["review_reason"]) for r in standardise.standardise_records(df).orderBy("id").collect()]
    assert got[0] == ("IC50", 5000.0, "nM", "1 µM = 1000 nM", None, None, None, None)
    assert got[1] == ("IC50", 5.0, "nM", "unit missing → assumed nM", None, None, None, "old; value note: unit assumed")
    assert got[2] == ("MIC", None, "nM", None, ">", None, None, "unit standardisation: invalid unit: mg/L")
    assert got[3] == ("MIC", 3000.0, "nM", "1 µM = 1000 nM", None, 2000.0, 4000.0, "value note: range")
    assert got[4][:4] == ("melting_point", 37.777778, "degC", "°F → degC") and got[5][:4] == ("yield", 50.0, "%", "already canonical")
    assert got[6][:4] == ("logP", 1.5, None, "no canonical unit for family") and got[7][7] == "unit standardisation: unparseable value"
    assert got[8] == ("IC50", 2000000.0, "nM", "already canonical", "<", None, 2000000.0, "value note: comparator <; weak IC50: 2e+06 nM (> 1 mM, likely inactive)")
    assert got[9][7] == "unstandardised: unrecognised property 'strange'" and got[10][1:7] == (None,) * 6 and got[11][7] == "unit standardisation: suspicious range"
    assert got[12][7] is None and got[13][:4] == ("MW", 1200.0, "g/mol", "1 kDa = 1000 g/mol")


def test_assembled_rows(spark):
    fields = ", ".join(f"{c} string" for c in standardise.FIELDS)
    rows = spark.createDataFrame([("p", 1, "*4a*", "MIC", "=", "5,0", "nM", " E.  coli "), ("p", 2, "4a", "MIC", "=", "5.0", "nM", "E. coli"), ("p", 3, "(5)", None, None, "nan", "", None), ("p", 4, "6", None, None, None, None, None), ("q", 5, None, None, None, None, None, None)], f"pdf string, row_id long, compound_id string, {fields}")
    given = spark.createDataFrame([("p", "4a", "C"), ("p", "9", None)], "pdf string, compound_id string, smiles string")
    pool = spark.createDataFrame([("p", "N"), ("p", "O")], "pdf string, smiles string")
    got = sorted(tuple(r)[:5] for r in standardise.assemble(rows, given, pool).collect())
    n = standardise.NOT_DETECTED
    assert got == [("p", "4a", "C", "MIC", "="), ("p", "5", "N", n, n), ("p", "6", "O", n, n), ("q", n, n, n, n)]
    assert {r["target_value"] for r in standardise.assemble(rows, given, pool).collect()} == {"5", n}


def test_mentions_are_whole_tokens(spark):
    names = spark.createDataFrame([("p", "DNA"), ("p", "rat")], "paper string, name string")
    caps = spark.createDataFrame([("p", "a DNA strand"), ("p", "rates of DNAse")], "paper string, caption string")
    assert [(r["name"], r["caption"]) for r in graph.mentions(names, caps, "paper", "name", "caption").collect()] == [("DNA", "a DNA strand")]


def test_quantities_with_nulls_and_extra_columns(spark):
    df = spark.createDataFrame([(1, "5", "µM"), (2, None, "nM"), (3, "5", None), (4, "x" * 20000, "nM")], "id long, v string, u string").withColumn("quantity", F.lit(0))
    got = {r["id"]: r["quantity"] for r in quantities.convert_quantities(df, "v", "u").collect()}
    assert got[1]["value_int"] == 5_000_000 and all(got[i]["unit_std"] is None for i in (2, 3, 4))


def test_recorded_source_pushes_filters(spark, tmp_path):
    for name, years in (("crossref", [2019, 2021, None]), ("arxiv", [2020])):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(json.dumps({"title": f"{name} {y}", "year": y, "authors": ["A"]}) for y in years))
    readers.register(spark)
    df = spark.read.format("recorded_papers").option("path", str(tmp_path)).load()
    assert df.count() == 4
    got = df.filter("source = 'crossref' and year >= 2020").select("title").collect()
    assert [r[0] for r in got] == ["crossref 2021"]


def test_text_tables_and_files(spark, tmp_path):
    (tmp_path / "t.csv").write_text("pdf,target_value\na,125\nb,6,25\n")
    assert [r[0] for r in readers.text_table(spark, str(tmp_path / "t.csv"), ["target_value", "missing"]).collect()][0] == "125"
    (tmp_path / "a.pdf").write_bytes(b"%PDF" + b"0" * 2000)
    (tmp_path / "b.PDF").write_bytes(b"<html" + b"0" * 2000)
    (tmp_path / "c.pdf").write_bytes(b"%PDF")
    got = {r["name"]: (r["status"], r["reason"]) for r in readers.pdf_files(spark, str(tmp_path)).collect()}
    assert got == {"a.pdf": ("ok", ""), "b.PDF": ("bad", "no PDF header"), "c.pdf": ("bad", "too small")}


def test_full_text_ladder(spark):
    rows = [("a", "landing_html", "x" * 300), ("a", "jats", "y" * 300), ("a", "oa_pdf", "short"), ("b", "oa_pdf", "short"), ("b", "abstract", "floor"), ("c", "jats", "")]
    got = {r["paper_id"]: r["level"] for r in readers.full_text(spark.createDataFrame(rows, "paper_id string, route string, text string")).collect()}
    assert got == {"a": "jats", "b": "abstract", "c": "none"}


def test_append_is_resumable(spark, tmp_path):
    mk = lambda ids: spark.createDataFrame([(i,) for i in ids], "id long")
    assert writers.append_new(mk([1, 2]), str(tmp_path / "out"), "id") == 2
    assert writers.append_new(mk([2, 3]), str(tmp_path / "out"), "id") == 1
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_report_text(spark):
    assert "- records: 1" in writers.markdown_report(spark.createDataFrame([record(1, inchikey="A")], RECORD))


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i, f"2024-01-01 0{i % 5}:1{i % 6}:00", i % 3, "view") for i in range(40)]
    df = spark.createDataFrame(rows, "event_id long, t string, user_id long, event_type string").withColumn("ts", F.to_timestamp("t")).drop("t")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    windows.run_once(windows.tumbling(windows.stream(spark, str(tmp_path / "in")), late="1 day"), "tumbled", str(tmp_path / "cp"), "complete")
    key = lambda d: sorted((str(r[0]), r[1], r[2]) for r in d.collect())
    assert key(spark.table("tumbled")) == key(windows.tumbling(df))
    assert sum(r["n"] for r in windows.sessions(df).collect()) == 40


def test_weighted_ratio():
    assert fuzzy.weighted_ratio("aspirin", "aspirin") == 100 and fuzzy.weighted_ratio("", "a") == 0
    assert fuzzy.weighted_ratio("acid acetic", "acetic acid") == 95 and abs(fuzzy.ratio("abcd", "abxd") - 75) < 1e-9
    assert fuzzy.weighted_ratio("abc", "zzabczz") == 90


def test_name_clusters(spark):
    rows = [(1, "7-benzyloxy-thiazole 3c"), (2, "7-benzyloxy-thiazole 3d"), (3, "indole"), (4, None), (5, "INDOLE"), (6, "indoles")]
    df = spark.createDataFrame(rows, "rec_no long, name_std string")
    got = {r["name_std"]: r["leader"] for r in fuzzy.cluster_names(df, "rec_no", "name_std").collect()}
    assert got == {"7-benzyloxy-thiazole 3c": "7-benzyloxy-thiazole 3c", "7-benzyloxy-thiazole 3d": "7-benzyloxy-thiazole 3c", "indole": "indole", "indoles": "indoles"}
    exact = {r["name_std"]: r["leader"] for r in fuzzy.cluster_names(df, "rec_no", "name_std", exact=True).collect()}
    assert exact["indoles"] == "indole"


def test_names_and_keys_by_hand(spark):
    names = [("7b (levofloxacin)",), ("15a-levorphanol",), ("compound 3",), ("12",), ("ligand",), (None,), ("Aspirin (acetyl salicylic acid), ",)]
    got = [r[0] for r in spark.createDataFrame(names, "n string").select(identity.name_candidates(F.col("n"))).collect()]
    assert got == [["7b (levofloxacin)", "levofloxacin", "(levofloxacin)"], ["15a-levorphanol", "levorphanol"], [], [], [], [], ["Aspirin (acetyl salicylic acid)", "acetyl salicylic acid", "Aspirin"]]
    rows = [("entity", "drug", None, None, "x", "cas:1"), ("relation", None, " A ", "B", "x", None), ("measurement", None, None, None, " MIC", None)]
    df = spark.createDataFrame(rows, "kind string, type string, subject string, object string, value string, eid string")
    fields = {"type": F.col("type"), "subject": F.col("subject"), "relation": F.lit("Binds"), "object": F.col("object"), "unit": F.lit("nM")}
    assert [r[0] for r in df.select(identity.record_key(F.col("kind"), fields, F.col("value"), F.col("eid"))).collect()] == [["entity", "drug", "cas:1"], ["relation", "a", "binds", "b"], ["measurement", "mic", "nM"]]
    assert spark.range(1).select(identity.domain(F.lit(" Co_crystals "))).first()[0] == "cocrystals"


def test_pools_by_hand(spark):
    pool = spark.createDataFrame([("p", "m", "B", 2), ("p", "m", "A", 1), ("p", "m", "B", 3), ("p", "d", "A", 1), ("q", "d", "", 1)], "paper string, engine string, smiles string, at int")
    assert {r["paper"]: r["engines"] for r in pools.converge(pool, "paper", "engine", "smiles", "at").collect()} == {"p": {"m": ["A", "B"], "d": ["A"]}}
    refs = spark.createDataFrame([(["10.1/A", "10.2/b", None], "10.1/a"), (["x"], None), (None, "y")], "r array<string>, own string")
    assert [r[0] for r in refs.select(pools.without_self(F.col("r"), F.col("own"))).collect()] == [["10.2/b", None], ["x"], None]
    entities = spark.createDataFrame([(1, "AAA-B-N"), (2, None), (3, "CCC-D-N"), (4, "EEE")], "entity int, inchikey string")
    names = spark.createDataFrame([(1, 1, "Aspirin"), (1, 2, "ASA"), (2, 1, "ASA"), (3, 1, "aspirin"), (4, 1, "nothing")], "entity int, ord int, name string")
    lookup = spark.createDataFrame([("nist", "aspirin", "AAA-X-N"), ("pubchem", "asa", "AAA-B-N")], "source string, name string, inchikey string")
    got = {r["entity"]: (r["source"], r["found"], r["status"]) for r in pools.enrich(entities, names, lookup, ("pubchem", "nist")).collect()}
    assert got == {1: ("pubchem", "AAA-B-N", "passed"), 2: ("pubchem", "AAA-B-N", "unverified"), 3: ("nist", "AAA-X-N", "mismatch")}
    gold = spark.createDataFrame([("p", "5", "a"), ("p", "6", "b"), ("q", "1", "c")], "pdf string, v string, o string")
    pred = spark.createDataFrame([("p", "base", "5", "a"), ("p", "new", "5", "a"), ("p", "new", "6", "b"), ("q", "new", "2", "c")], "pdf string, variant string, v string, o string")
    assert {(r["variant"], r["article"]): r["f1_e6"] for r in pools.ablation(gold, pred, "pdf", "variant", ["v", "o"], ["base", "new"]).collect()} == {("base", "p"): 666667, ("base", "q"): 0, ("new", "p"): 1000000, ("new", "q"): 500000}
