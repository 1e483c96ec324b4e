"""Text that looks like an entry of a list but consists of other characters, brought to the form of the list."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.functions.glyphs import consistent, folded
from assayloom.session import per_distinct


@F.pandas_udf(T.StringType())
def consistent_form(texts: pd.Series) -> pd.Series:
    """NFKC, mapped white space, no ignorable characters, look-alike letters resolved; letter case kept."""
    return pd.Series(per_distinct(texts, consistent), dtype=object)


@F.pandas_udf(T.StringType())
def folded_form(texts: pd.Series) -> pd.Series:
    """The consistent form under full case folding."""
    return pd.Series(per_distinct(texts, folded), dtype=object)


def unify_glyphs(df: DataFrame, text: str, reference: DataFrame, ref_text: str, ref_id: str, into: str = "ref_id") -> DataFrame:
    """Adds `into`: the id of the reference text that `text` looks the same as; null where it looks like none.

    Comparison is by the folded form, confirmed by the consistent form, since letter case tells units apart (nM and nm). Of
    several reference texts of one consistent form the smallest id counts. Null, empty and invisible-only texts get null.
    The reference side of the join is one row per consistent form; Spark broadcasts it only if its size allows.
    """
    ref = reference.select(consistent_form(ref_text).alias("__look"), F.col(ref_id).alias("__id")).filter("__look <> ''").groupBy("__look").agg(F.min("__id").alias("__id"))
    ref = ref.withColumn("__fold", folded_form("__look"))
    looked = df.withColumn("__seen", consistent_form(text)).withColumn("__sfold", folded_form("__seen"))
    joined = looked.join(ref, (F.col("__sfold") == F.col("__fold")) & (F.col("__seen") == F.col("__look")), "left")
    return joined.withColumn(into, F.col("__id")).drop("__seen", "__sfold", "__look", "__fold", "__id")


def found(assay: DataFrame, curated: DataFrame, units: DataFrame) -> DataFrame:
    """Rows whose unit looks like a `unit_text` but has other, additional or invisible characters: tbl, row_id, unit_id."""
    a = assay.select(F.lit("assay_rows").alias("tbl"), "row_id", F.col("target_units").alias("u"))
    c = curated.select(F.lit("curated_records").alias("tbl"), F.col("rec_no").alias("row_id"), F.col("unit_raw").alias("u"))
    plain = units.select(F.col("unit_text").alias("__plain"))
    odd = a.unionByName(c).filter("u is not null").join(plain, F.trim("u") == F.col("__plain"), "left_anti")
    return unify_glyphs(odd, "u", units, "unit_text", "unit_id", "unit_id").filter("unit_id is not null").drop("u")
