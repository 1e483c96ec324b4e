"""Scalar functions, against values worked out by hand."""

from __future__ import annotations

from fractions import Fraction

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assayloom.functions import numeric, text
from assayloom.functions.bktree import BKTree, Pattern
from assayloom.functions.glyphs import consistent, folded
from assayloom.functions.units import parse_number, parse_unit, to_common
from assayloom.operators.quantities import standardise


@pytest.mark.parametrize(
    ("raw", "want"),
    [("µM", "μM"), ("​mg/L ", "mg/L"), ("ｍＬ", "mL"), ("mⅬ", "mL"), ("Å", "Å"), ("Å", "Å"), ("Å", "Å"), ("µg⁄mL", "μg/mL"), ("ոM", "nM"), ("℃", "°C"), ("", ""), ("​", ""), ("a\t\n b", "a b")],
)
def test_consistent(raw, want):
    assert consistent(raw) == want


def test_consistent_keeps_case_and_nulls():
    assert consistent("nM") != consistent("nm") and folded("nM") == folded("NM")
    assert consistent(None) is None and folded(None) is None


@given(st.text(max_size=40))
def test_consistent_is_idempotent(s):
    assert consistent(consistent(s)) == consistent(s)


@pytest.mark.parametrize(
    ("unit", "kind", "one"),
    [
        ("nM", "nM", 1), ("µmol/L", "nM", 1000), ("10-6 M", "nM", 1000), ("×10⁻⁹ M", "nM", 1), ("mol dm-3", "nM", 10**9), ("micromol/litre", "nM", 1000), ("pmol/mL", "nM", 1),
        ("µg/mL", "g/L", Fraction(1, 1000)), ("µgmL⁻¹", "g/L", Fraction(1, 1000)), ("mg per mL", "g/L", 1), ("g/100 mL", "g/L", 10), ("kg/m3", "g/L", 1), ("micrograms per millilitre", "g/L", Fraction(1, 1000)),
        ("kDa", "g/mol", 1000), ("g mol-1", "g/mol", 1), ("‰", "%", Fraction(1, 10)), ("fraction", "%", 100), ("per cent", "%", 1), ("deg. Celsius", "degC", 1),
    ],
)
def test_units(unit, kind, one):
    assert to_common(Fraction(1), parse_unit(unit)) == (kind, one)


def test_temperatures_have_offsets():
    assert to_common(Fraction("273.15"), parse_unit("K"))[1] == 0
    assert to_common(Fraction(212), parse_unit("degrees F"))[1] == 100


@pytest.mark.parametrize("unit", ["nm", "mg/kg", "IU/mL", "CFU/mL", "µg/disc", "µmol/g", "mm", "Å"])
def test_other_units_are_no_kind(unit):
    assert parse_unit(unit) is not None and to_common(Fraction(1), parse_unit(unit)) is None


@pytest.mark.parametrize("unit", [None, "", "NOT_DETECTED", "?", "x" * 500])
def test_no_units(unit):
    assert parse_unit(unit) is None


@pytest.mark.parametrize(
    ("raw", "value", "rest"),
    [("12.5", "12.5", ""), ("0,04", "0.04", ""), ("≤ 5", "5", ""), ("12 ± 3 nM", "12", "nM"), ("20-30", "25", ""), ("-6.0 – -4.0 °C", "-5", "°C"), ("2 560", "2560", ""), ("4.53 × 10^-4", "0.000453", ""), ("2000 × 10-6 M", "0.002", "M"), ("1.63E-6", "0.00000163", ""), ("5 to 7mg/L", "6", "mg/L")],
)
def test_numbers(raw, value, rest):
    assert parse_number(raw) == (Fraction(value), rest)


@pytest.mark.parametrize("raw", [None, "", "n.d.", "-", "inactive", "nan", "NOT_DETECTED"])
def test_no_numbers(raw):
    assert parse_number(raw) is None


def test_standardise_looks_for_the_unit():
    assert standardise("5", "µM", None, None) == ("nM", 5_000_000)
    assert standardise("5 mg/L", None, None, None) == ("g/L", 5_000_000)
    assert standardise("5", None, "MIC [mg/L]", None) == ("g/L", 5_000_000)
    assert standardise("5", "", "mp, K", None) == ("degC", -268150)
    assert standardise("5", None, "MIC", "x had MIC 5 nM; y gave 12 mg/L") == ("nM", 5000)
    assert standardise("5", None, "MIC", "units: values in µM; MIC") == ("nM", 5_000_000)
    assert standardise("5", None, "MIC", "x had MIC 5; y gave 12 mg/L") is None
    assert standardise("5", "mm", "MIC [mg/L]", None) is None
    assert standardise("n.d.", "nM", None, None) is None


@given(st.text("abcdé ", max_size=12), st.text("abcdé ", max_size=12))
def test_edit_distance(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y)))
        prev = row
    assert Pattern(a).distance(b) == prev[-1]


@given(st.lists(st.text("abc", min_size=1, max_size=6), max_size=30), st.text("abc", max_size=6), st.integers(0, 3))
def test_bktree_finds_every_entry(words, query, limit):
    p = Pattern(query)
    assert BKTree(words).search(query, limit) == sorted((p.distance(w), w) for w in set(words) if p.distance(w) <= limit)


def values(spark, rows, schema, **cols):
    df = spark.createDataFrame(rows, schema)
    return [r.asDict() for r in df.select(*[c.alias(k) for k, c in cols.items()]).collect()]


def test_text_keys(spark):
    got = values(spark, [("  A  Study—of\tX. ",), (None,), ("",)], "t string", k=text.title_norm(F.col("t")))
    assert [r["k"] for r in got] == ["a studyof x ".strip(), "", ""]
    got = values(spark, [("*(3a)* ",), ("12",)], "c string", k=text.compound_key(F.col("c")))
    assert [r["k"] for r in got] == ["3a", "12"]
    got = values(spark, [("MIC (mg/L)",), ("mp, K",), ("IC50",)], "h string", n=text.split_property_unit(F.col("h"))[0], u=text.split_property_unit(F.col("h"))[1])
    assert [(r["n"], r["u"]) for r in got] == [("MIC", "mg/L"), ("mp", "K"), ("IC50", "")]
    got = values(spark, [("E. coli, ATCC 25922",), ("S. aureus",), ("MRSA",), ("  ",)], "o string", a=text.split_strain(F.col("o"))[0], b=text.split_strain(F.col("o"))[1])
    assert [(r["a"], r["b"]) for r in got] == [("E. coli", "ATCC 25922"), ("S. aureus", None), ("MRSA", "MRSA"), (None, None)]


def test_micro_and_numbers(spark):
    got = values(spark, [("μM",), ("µM",)], "u string", a=text.micro_norm(F.col("u")), b=text.micro_norm(F.col("u"), text.MU))
    assert all(r["a"] == "µM" and r["b"] == "μM" for r in got)
    got = values(spark, [("0,056",), ("125.0",), ("125",), (">5",), (None,)], "v string", n=numeric.number_norm(F.col("v")))
    assert [r["n"] for r in got] == ["0.056", "125", "125", ">5", None]


def test_property_order_and_substring(spark):
    got = values(spark, [("IC₅₀ value",), ("dynamic",), ("M.I.C.",), ("compound",), ("logP",), (None,)], "p string", a=numeric.property_of(F.col("p"))[0], b=numeric.property_of(F.col("p"))[1])
    assert [(r["a"], r["b"]) for r in got] == [("IC50", "conc"), ("MIC", "conc"), ("MIC", "conc"), ("melting_point", "temp"), ("logP", "dimensionless"), (None, "unknown")]


def test_parse_value_ranges(spark):
    rows = [("20-30",), ("258-61",), ("1-1001",), ("12 ± 3",), (">= 5",), ("0,056",), ("n.d.",), (None,)]
    got = values(spark, rows, "v string", v=numeric.parse_value(F.col("v")))
    assert [(r["v"]["central"], r["v"]["op"], r["v"]["is_range"]) for r in got] == [(25.0, None, True), (None, None, True), (None, None, True), (12.0, None, False), (5.0, ">=", False), (56.0, None, False), (None, None, False), (None, None, False)]


def test_citation_score(spark):
    got = values(spark, [("openalex", 5), ("openalex", 50), ("openalex", 10**6), ("x", -1), ("pubmed", None)], "s string, n int", c=numeric.citation_score(F.col("s"), F.col("n")))
    assert [round(r["c"], 6) for r in got] == [0.5, 0.9, 1.0, 0.0, 0.0]


def test_disagreement(spark):
    rows = [(1.0, 2.0, "nM"), (1.0, 2.1, "nM"), (10.0, 15.0, "degC"), (10.0, 15.1, "degC"), (0.0, 1.0, "nM"), (1.0, 11.0, "%")]
    got = values(spark, rows, "lo double, hi double, u string", d=numeric.values_disagree(F.col("lo"), F.col("hi"), F.col("u")))
    assert [r["d"] for r in got] == [False, True, False, True, True, False]


def test_rules_as_the_fixed_values_give_them(spark):
    names = [("a/b: c*?.pdf",), ("  ..  ",), ("x" * 200,), ("a\tb\n\nc",), ("Report.PDF",), (None,)]
    got = [r["f"] for r in values(spark, names, "t string", f=text.safe_filename(F.col("t")))]
    assert got == ["a_b__c_.pdf", "unknown.pdf", "x" * 180 + ".pdf", "a_b_c.pdf", "Report.PDF", None]
    kinds = [r["k"] for r in values(spark, [("pMIC",), (" mic90",), ("MBC",), (" ",), (None,)], "t string", k=text.target_type(F.col("t")))]
    assert kinds == ["pMIC", "MIC", "MBC", None, None]
    ops = [r["o"] for r in values(spark, [("≥", "< 5"), (None, "≤5"), ("=", "5"), ("<>", "")], "a string, b string", o=text.relation_of(F.col("a"), F.col("b")))]
    assert ops == [">", "<", "=", ">"]
    assert [r["p"] for r in values(spark, [("A b.PDF",), ("c.pdf.pdf",)], "t string", p=text.pdf_name(F.col("t")))] == ["a b", "c.pdf"]


def test_printed_numbers(spark):
    raw = ["12.50", "<= 0,05", "1234567", "0.0000123", "100", "abc", " ", None, "≈1e-3", "0", "-2.5", "999999.5", "1000000"]
    got = [r["v"] for r in values(spark, [(x,) for x in raw], "t string", v=numeric.clean_value(F.col("t")))]
    assert got == ["12.5", "0.05", "1.23457e+06", "1.23e-05", "100", "abc", None, None, "0.001", "0", "-2.5", "1e+06", "1e+06"]
