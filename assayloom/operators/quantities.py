"""Quantities in different units brought to one common unit per kind."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.functions.glyphs import consistent
from assayloom.functions.units import parse_number, parse_unit, to_common

_HEADER = re.compile(r"(?:\(([^()]*)\)|\[([^\[\]]*)\])\s*$|(?:,|/)\s+(.+)$|,(\S.*)$")
_DECLARED = re.compile(r"\bunits?\s*[:=]?\s*(?:values?\s+)?(?:are\s+)?(?:given\s+)?in\s+([^;,()]+)|\b(?:values?|results?)\s+(?:are\s+)?(?:given\s+|expressed\s+)?in\s+([^;,()]+)", re.I)
_CLAUSE = re.compile(r"[;,(]|\s(?:while|whereas|and|against|for|in|at|versus|vs)\s|\.\s|\.$")
#: Value times this, rounded, is `value_int`.
FACTOR = {"g/L": 10**9}


def _unit_in_header(header: str | None):
    if not header:
        return None
    m = _HEADER.search(header)
    return parse_unit(next(g for g in m.groups() if g is not None)) if m else None


def _unit_in_evidence(evidence: str | None, value: str):
    """The unit behind this very value in a sentence, else the unit the text declares for all its values."""
    if not evidence:
        return None
    v = value.strip()
    at = evidence.find(v)
    while v and at >= 0:
        end = at + len(v)
        if (at == 0 or not (evidence[at - 1].isdigit() or evidence[at - 1] in ".,")) and not evidence[end : end + 1].isdigit():
            stop = _CLAUSE.search(evidence, end)
            unit = parse_unit(evidence[end : stop.start() if stop else len(evidence)])
            if unit:
                return unit
        at = evidence.find(v, at + 1)
    m = _DECLARED.search(evidence)
    return parse_unit(m[1] or m[2]) if m else None


def standardise(value: str | None, unit: str | None, header: str | None, evidence: str | None) -> tuple[str, int] | None:
    """(common unit, scaled integer) of one row; None where no number or no unit of a known kind is stated.

    The unit is taken from where it stands closest to the number: behind it, in the unit column, in the column header, in the
    sentence. A unit of another kind stated there ends the search.
    """
    number = parse_number(value)
    if number is None:
        return None
    rest = number[1]
    stated = None
    if rest:
        stated = parse_unit(rest)
        if stated is None:
            return None if re.match(r"[\d.,]", rest) else _fallback(number[0], unit, header, evidence, value)
    return _scaled(number[0], stated) if stated else _fallback(number[0], unit, header, evidence, value)


def _scaled(number, unit) -> tuple[str, int] | None:
    common = to_common(number, unit)
    return common and (common[0], round(common[1] * FACTOR.get(common[0], 1000)))


def _fallback(number, unit, header, evidence, value):
    stated = parse_unit(unit) if unit and consistent(unit) else None
    stated = stated or _unit_in_header(header) or _unit_in_evidence(evidence, value)
    return _scaled(number, stated) if stated else None


@F.pandas_udf(T.StructType().add("unit_std", T.StringType()).add("value_int", T.LongType()))
def _standardise(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for value, unit, header, evidence in parts:
        out = [standardise(*row) if row[0] is not None else None for row in zip(value, unit, header, evidence)]
        out = [x if x and abs(x[1]) < 2**63 else (None, None) for x in out]
        yield pd.DataFrame({"unit_std": [x[0] for x in out], "value_int": pd.array([x[1] for x in out], dtype="Int64")})


def convert_quantities(df: DataFrame, value: str, unit: str, header: Column | None = None, evidence: Column | None = None, into: str = "quantity") -> DataFrame:
    """Adds the struct column `into` (unit_std, value_int) to rows whose text `value` states a number.

    The unit may stand in `value`, in `unit`, in brackets of `header` or in the sentence `evidence`; which of them states it
    decides, never the property. Kinds and common units: nM, g/L, degC, g/mol, %. Rows without a number or of another kind
    get nulls; null, empty and very long texts are legal anywhere; other columns pass through untouched. One narrow Arrow
    pass: no shuffle, and each distinct unit text is parsed once per worker.
    """
    text = lambda c: F.lit(None).cast("string") if c is None else c
    return df.withColumn(into, _standardise(F.col(value), F.col(unit), text(header), text(evidence)))


def found(assay: DataFrame, curated: DataFrame) -> DataFrame:
    """Rows of both tables with a number and a unit of the five kinds: tbl, row_id, unit_std, value_int."""
    a = assay.select(F.lit("assay_rows").alias("tbl"), "row_id", F.col("target_value").alias("v"), F.col("target_units").alias("u"), F.col("target_type").alias("h"), F.lit(None).cast("string").alias("e"))
    c = curated.filter("value_std is null").select(F.lit("curated_records").alias("tbl"), F.col("rec_no").alias("row_id"), F.col("value_raw").alias("v"), F.col("unit_raw").alias("u"), F.col("property").alias("h"), F.col("evidence").alias("e"))
    rows = a.unionByName(c).filter(F.col("v").rlike("[0-9\\uff10-\\uff19]"))
    return convert_quantities(rows, "v", "u", F.col("h"), F.col("e")).filter("quantity.unit_std is not null").select("tbl", "row_id", "quantity.unit_std", "quantity.value_int")
