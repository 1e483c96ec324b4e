"""Records brought to canonical properties and units beside their raw text, and predictions assembled from extracted rows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.functions import numeric, text
from assayloom.functions.units import COMMON, parse_unit
from assayloom.operators.joins import cycle_pool
from assayloom.session import per_distinct

NOT_DETECTED = "NOT_DETECTED"
_SCALE = T.StructType().add("common", T.StringType()).add("factor", T.DoubleType()).add("offset", T.DoubleType())


def unit_scale(unit: str | None) -> tuple:
    """(common unit of its kind, factor, offset): a value times factor plus offset is in the common unit; nulls for other texts."""
    parsed = parse_unit(unit)
    kind = COMMON.get(parsed[2]) if parsed else None
    if kind is None:
        return (None, None, None)
    common, scale, offset = kind
    return (common, float(parsed[0] / scale), float((parsed[1] - offset) / scale))


@F.pandas_udf(_SCALE)
def _scales(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for units in parts:
        yield pd.DataFrame([x or (None, None, None) for x in per_distinct(units, unit_scale)], columns=_SCALE.names)


def standardise_records(records: DataFrame) -> DataFrame:
    """Adds to records (or replaces) property, value_std, unit_std, conversion_note, value_op, value_min, value_max, assay_type_std,
    organism_std and review_reason; raw columns stay.

    The property's family decides the unit: a missing unit is taken for the canonical one and said so, a unit of another kind makes
    the value null. Ranges give bounds, comparators one. Properties without a canonical unit pass their value through. Reasons for
    review are appended in a fixed order behind those that are there. Only unit texts leave the JVM, each distinct one once a batch.
    """
    label, family = numeric.property_of(F.col("property"))
    units = F.create_map(*[F.lit(x) for pair in numeric.FAMILY_UNIT.items() for x in pair])
    df = records.withColumn("__v", numeric.parse_value(F.col("value_raw"))).withColumn("__family", family).withColumn("__label", label)
    df = df.withColumn("__canon", F.try_element_at(units, F.col("__family"))).withColumn("__u", F.nullif(F.trim(F.coalesce("unit_raw", F.lit(""))), F.lit(""))).withColumn("__s", _scales("unit_raw"))
    central, canon, unit = F.col("__v.central"), F.col("__canon"), F.col("__u")
    same = F.col("__s.common") == canon
    to = lambda x: F.when((F.col("__family") == "pct") | canon.isNull() | unit.isNull(), x).when(same, x * F.col("__s.factor") + F.col("__s.offset"))
    stated = F.col("value_raw").isNotNull() | F.col("unit_raw").isNotNull()
    value = F.when(stated, F.round(to(central), 6))
    plain = F.coalesce(unit == canon, F.lit(False)) | (F.col("__family") == "pct")
    converted = F.when(canon == "degC", F.concat(unit, F.lit(" → degC"))).otherwise(F.concat(F.lit("1 "), unit, F.lit(" = "), numeric.six_digits(F.col("__s.factor")), F.lit(" "), canon))
    note = (
        F.when(~stated | central.isNull(), None)
        .when(canon.isNull(), "no canonical unit for family")
        .when(plain, "already canonical")
        .when(unit.isNull(), F.concat(F.lit("unit missing → assumed "), canon))
        .when(same, converted)
    )
    failed = (
        F.when(canon.isNull(), F.when(central.isNull(), "passthrough"))
        .when(central.isNull(), F.when(F.col("__v.is_range"), "suspicious range").otherwise("unparseable value"))
        .when((F.col("__family") != "pct") & unit.isNotNull() & ~F.coalesce(same, F.lit(False)), F.concat(F.lit("invalid unit: "), unit))
    )
    told = (
        F.when(canon.isNull() | central.isNull() | failed.isNotNull() | (F.col("__family") == "pct"), None)
        .when(unit.isNull(), "unit assumed")
        .when(F.col("__v.is_range"), "range")
        .when(F.col("__v.op").isNotNull(), F.concat(F.lit("comparator "), F.col("__v.op")))
    )
    kind = numeric.plausibility(value, F.col("__family"))
    size = F.concat(F.col("__label"), F.lit(": "), numeric.six_digits(value), F.lit(" nM "))
    odd = (
        F.when(kind == "weak", F.concat(F.lit("weak "), size, F.lit("(> 1 mM, likely inactive)")))
        .when(kind == "not positive", F.concat(F.lit("implausible "), size, F.lit("(<= 0)")))
        .when(kind == "above 1 M", F.concat(F.lit("implausible "), size, F.lit("(> 1 M, likely unit/parse error)")))
        .when(kind == "below 0.1 pM", F.concat(F.lit("implausible "), size, F.lit("(< 0.1 pM)")))
    )
    unknown = F.when((F.col("__family") == "unknown") & value.isNotNull(), F.concat(F.lit("unstandardised: unrecognised property '"), F.coalesce("__label", F.lit("")), F.lit("'")))
    reasons = [F.nullif("review_reason", F.lit("")), F.when(stated, F.concat(F.lit("unit standardisation: "), failed)), F.when(stated, F.concat(F.lit("value note: "), told)), odd, unknown]
    low, high = F.col("__v.op").isin(">", ">="), F.col("__v.op").isin("<", "<=")
    bound = lambda end, mark: F.when(F.col("__v.is_range") & F.col("__v.lo").isNotNull(), F.round(to(F.col(f"__v.{end}")), 6)).when(mark, value)
    out = {
        "property": F.col("__label"),
        "value_std": value,
        "unit_std": F.when(stated, F.coalesce(canon, unit)),
        "conversion_note": note,
        "value_op": F.when(stated, F.col("__v.op")),
        "value_min": bound("lo", low),
        "value_max": bound("hi", high),
        "assay_type_std": text.assay_type(F.col("assay_type_raw")),
        "organism_std": text.organism_rule(F.col("organism_raw")),
        "review_reason": F.nullif(F.concat_ws("; ", *reasons), F.lit("")),
    }
    return df.withColumns(out).drop("__v", "__family", "__label", "__canon", "__u", "__s")


#: Fields of an assembled prediction, beside the paper.
FIELDS = ("target_type", "target_relation", "target_value", "target_units", "bacteria")


def assemble(rows: DataFrame, assigned: DataFrame, pool: DataFrame, paper: str = "pdf", order: str = "row_id") -> DataFrame:
    """Predicted rows: `paper`, compound_id, smiles and `FIELDS`, exact repeats once.

    rows: `paper`, `order` (unique), compound_id and `FIELDS`; assigned: `paper`, compound_id, smiles; pool: `paper`, smiles. A row
    takes the structure assigned to its compound (the least of several); rows without one take their paper's pool in turn. Numbers
    get their normal form, white space is squeezed, and what is missing is "NOT_DETECTED".
    """
    key = text.compound_key(F.col("compound_id"))
    known = assigned.filter("smiles is not null").groupBy(paper, key.alias("__cid")).agg(F.min("smiles").alias("__given"))
    keyed = rows.withColumn("__cid", key).join(known, [paper, "__cid"], "left")
    loose = cycle_pool(keyed.filter("__given is null").select(paper, order), pool.filter("smiles is not null").select(paper, "smiles"), [paper], order, "smiles")
    placed = keyed.join(loose.select(order, F.col("smiles").alias("__taken")), order, "left")
    filled = lambda c: F.when(c.isNull() | c.isin("", "nan", "None"), NOT_DETECTED).otherwise(c)
    made = [filled(text.squeeze(numeric.number_norm(F.col(c)) if c == "target_value" else F.col(c))).alias(c) for c in FIELDS]
    return placed.select(paper, filled(F.col("__cid")).alias("compound_id"), filled(F.coalesce("__given", "__taken")).alias("smiles"), *made).distinct()


def source_precedence(readings: DataFrame, keys: list[str], source: str, value: str, order: tuple[str, ...]) -> DataFrame:
    """`keys`, `source`, `value`: of several sources' values the first source's in `order` that has one; ties by the least value."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col(source))
    rank = F.struct(F.when(place == 0, len(order) + 1).otherwise(place).alias("p"), F.col(source).alias("s"), F.col(value).alias("v"))
    best = readings.filter(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(*keys).agg(F.min(rank).alias("b"))
    return best.select(*keys, F.col("b.s").alias(source), F.col("b.v").alias(value))
