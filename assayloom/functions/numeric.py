"""Numeric expressions: values with comparators and ranges, property families, plausibility, scores and vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Property spellings with canonical label and unit family, in matching order; canonical unit per family.
PROPERTIES = [
    ("ic50", "IC50", "conc"), ("ec50", "EC50", "conc"), ("ce50", "EC50", "conc"), ("ki", "Ki", "conc"), ("kd", "Kd", "conc"), ("km", "Km", "conc"), ("mic", "MIC", "conc"),
    ("gi50", "GI50", "conc"), ("ld50", "LD50", "conc"), ("solubility", "solubility", "massconc"), ("logp", "logP", "dimensionless"), ("logd", "logD", "dimensionless"),
    ("clogp", "clogP", "dimensionless"), ("mw", "MW", "mw"), ("molecularweight", "MW", "mw"), ("molweight", "MW", "mw"), ("yield", "yield", "pct"), ("purity", "purity", "pct"),
    ("ee", "ee", "pct"), ("meltingpoint", "melting_point", "temp"), ("mp", "melting_point", "temp"), ("boilingpoint", "boiling_point", "temp"), ("bp", "boiling_point", "temp"),
    ("temperature", "temperature", "temp"),
]
FAMILY_UNIT = {"conc": "nM", "massconc": "g/L", "temp": "degC", "mw": "g/mol", "pct": "%"}
# Citation percentiles (p50, p90, p99) by source, and the default.
CITATIONS = {
    "openalex": (5, 50, 500), "europepmc": (2, 20, 200), "semantic_scholar": (3, 35, 350), "crossref": (5, 50, 500), "arxiv": (3, 30, 300), "pubmed": (4, 40, 400), "core": (2, 20, 200),
    "google_scholar": (8, 80, 800), "google_patents": (3, 30, 300),
}
CITATIONS_ELSE = (5, 50, 500)
# Plausible concentrations in nM (least, weak above, most); range ratio that is trusted.
LEAST_NM, WEAK_NM, MOST_NM, WIDEST = 1e-4, 1e6, 1e9, 1000.0
_NUM = r"[-+]?\d*\.?\d+(?:[eE][-+]?\d+)?"


def property_key(name: Column) -> Column:
    """A property name with subscripts folded, in lower case, without blanks, hyphens, underscores and dots."""
    return F.regexp_replace(F.lower(F.translate(name, "₀₁₂₃₄₅₆₇₈₉", "0123456789")), r"[ \-_.]", "")


def property_of(name: Column) -> tuple[Column, Column]:
    """(canonical label, family): by exact key, else the first key contained in it; unknown names stay, family "unknown"."""
    key = property_key(name)
    pick = lambda i: F.coalesce(*[F.when(key == p[0], F.lit(p[i])) for p in PROPERTIES], *[F.when(F.contains(key, F.lit(p[0])), F.lit(p[i])) for p in PROPERTIES])
    return F.coalesce(pick(1), F.trim(name)), F.coalesce(pick(2), F.lit("unknown"))


def parse_value(raw: Column) -> Column:
    """STRUCT<central, op, is_range, lo, hi> of a value cell.

    Commas are dropped, dashes unified; a spread keeps its first number; a range gives its middle unless it descends or spans
    more than a thousandfold, where the number is null and the range flag stays.
    """
    s = F.replace(F.translate(F.trim(raw), "–—", "--"), F.lit(","), F.lit(""))
    op = F.nullif(F.regexp_extract(s, r"^\s*(>=|<=|>|<|≥|≤|~)", 1), F.lit(""))
    first = F.regexp_extract(s, f"({_NUM})", 1).try_cast("double")
    a = F.regexp_extract(s, r"(\d*\.?\d+)\s*-\s*(\d*\.?\d+)", 1).try_cast("double")
    b = F.regexp_extract(s, r"(\d*\.?\d+)\s*-\s*(\d*\.?\d+)", 2).try_cast("double")
    spread = F.contains(s, F.lit("±"))
    ranged = a.isNotNull() & ~spread & first.isNotNull()
    trusted = ranged & (b >= a) & ((a <= 0) | (b / F.when(a > 0, a) <= WIDEST))
    central = F.when(first.isNull(), None).when(~ranged, first).when(trusted, (a + b) / 2)
    return F.struct(central.alias("central"), op.alias("op"), F.coalesce(ranged, F.lit(False)).alias("is_range"), F.when(trusted, a).alias("lo"), F.when(trusted, b).alias("hi"))


def plausibility(value_nm: Column, family: Column) -> Column:
    """Review class of a concentration: not positive, above 1 M, below 0.1 pM, weak above 1 mM; null where plausible."""
    return F.when(family != "conc", None).when(value_nm <= 0, "not positive").when(value_nm > MOST_NM, "above 1 M").when(value_nm < LEAST_NM, "below 0.1 pM").when(value_nm > WEAK_NM, "weak")


def number_norm(text: Column) -> Column:
    """A number with decimal point and without a trailing ".0"; other texts stay as they are."""
    point = F.replace(F.trim(text), F.lit(","), F.lit("."))
    return F.when(point.rlike(r"^-?\d+(\.\d+)?$"), F.regexp_replace(point, r"\.0+$", "")).otherwise(text)


def citation_score(source: Column, count: Column) -> Column:
    """Citations on the 0 to 1 scale of their source's percentiles; 0 for null and negative counts."""

    def scale(p50: int, p90: int, p99: int) -> Column:
        n = count.cast("double")
        return (
            F.when(count.isNull() | (count <= 0), 0.0)
            .when(count <= p50, n / p50 * 0.5)
            .when(count <= p90, 0.5 + (n - p50) / (p90 - p50) * 0.4)
            .otherwise(0.9 + F.least(F.lit(0.1), (n - p90) / (p99 - p90) * 0.1))
        )

    out = scale(*CITATIONS_ELSE)
    for name, stats in CITATIONS.items():
        out = F.when(source == name, scale(*stats)).otherwise(out)
    return out


def relevance(source: Column, count: Column, year: Column, title: Column, abstract: Column, is_open: Column, query: str, now: int) -> Column:
    """10 citation score + 0.5 a year after now - 5 + 5 title hit + 3 abstract hit + 2 open access."""
    low = query.lower()
    hit = lambda c: F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(low))
    recent = F.when(year >= now - 5, (year - (now - 5)) * 0.5).otherwise(0.0)
    return citation_score(source, count) * 10 + recent + F.when(hit(title), 5.0).otherwise(0.0) + F.when(hit(abstract), 3.0).otherwise(0.0) + F.when(is_open, 2.0).otherwise(0.0)


def values_disagree(lo: Column, hi: Column, unit: Column) -> Column:
    """Whether values of one thing conflict: 5 degrees, 10 percent points, otherwise a factor of two or a value that is not positive."""
    return F.when(unit == "degC", hi - lo > 5.0).when(unit == "%", hi - lo > 10.0).otherwise((lo <= 0) | (hi / F.when(lo > 0, lo) > 2.0))


def value_bucket(value: Column) -> Column:
    """A value in steps of 0.0001, halves up."""
    return F.floor(value * 10000 + 0.5).cast("long")


def unit_vector(v: Column) -> Column:
    """A vector scaled to length one."""
    d = F.transform(v, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(d, F.lit(0.0), lambda acc, x: acc + x * x)) + 1e-8
    return F.transform(d, lambda x: x / norm)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def six_digits(number: Column) -> Column:
    """A number with six significant digits and no trailing zeros, in powers of ten beyond 0.0001 and a million."""
    told = F.format_string("%.5e", number)
    power = F.regexp_extract(told, r"e([-+]\d+)$", 1).try_cast("int")
    digits = F.regexp_replace(F.regexp_extract(told, r"^([-\d.]+)e", 1), r"\.?0+$", "")
    plain = F.regexp_replace(F.regexp_replace(told.try_cast("decimal(38,12)").cast("string"), r"0+$", ""), r"\.$", "")
    long = F.concat(digits, F.when(power < 0, "e-").otherwise("e+"), F.lpad(F.abs(power).cast("string"), 2, "0"))
    return F.when(number == 0, "0").when((power >= -4) & (power < 6), plain).otherwise(long)


def clean_value(text: Column) -> Column:
    """A value without comparators, a comma as decimal mark; numbers with six significant digits, other texts as they are, blank null."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), ",", "."), r"^[<>=~≤≥≈]+", ""))
    number = F.when(bare.rlike(r"^[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?$"), bare.try_cast("double"))
    return F.coalesce(six_digits(number), F.nullif(bare, F.lit("")))
