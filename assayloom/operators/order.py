"""Numbering and first-wins choices in a stated order, without a single-task window over everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayloom.session import cut


def number(df: DataFrame, order: str, into: str = "number") -> DataFrame:
    """Numbers 1, 2, ... in the order of a unique column: range partitions are numbered apart and shifted by their predecessors."""
    parts = cut(df.repartitionByRange(F.col(order)).withColumn("__part", F.spark_partition_id()))
    counts = parts.groupBy("__part").agg(F.count("*").alias("__n"))
    before = counts.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))  # one row per partition
    within = parts.withColumn("__k", F.row_number().over(Window.partitionBy("__part").orderBy(order)))
    return within.join(before, "__part").withColumn(into, F.col("__k") + F.col("__before")).drop("__part", "__k", "__before")


def running_number(df: DataFrame, keys: list[str], order: str, into: str = "number", step: int = 100_000) -> DataFrame:
    """0, 1, ... within each key in the order of a unique integer column; a hot key is cut into ranges of `step` order values."""
    cells = df.withColumn("__cell", F.floor(F.col(order) / step))
    counts = cells.groupBy(*keys, "__cell").agg(F.count("*").alias("__n"))
    before = counts.select(*keys, "__cell", F.coalesce(F.sum("__n").over(Window.partitionBy(*keys).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    within = cells.withColumn("__k", F.row_number().over(Window.partitionBy(*keys, "__cell").orderBy(order)))
    joined = within.join(before, [*keys, "__cell"])
    return joined.withColumn(into, (F.col("__k") - 1 + F.col("__before")).cast("long")).drop("__cell", "__k", "__before")


def keep_first(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row of each non-empty key; rows with an empty or null key all stay. Combined before the shuffle."""
    keyed = df.withColumn("__key", key)
    has = F.coalesce(F.col("__key"), F.lit("")) != ""
    first = keyed.filter(has).groupBy("__key").agg(F.min(order).alias("__first"))
    kept = keyed.filter(has).join(first, "__key").filter(F.col(order) == F.col("__first")).drop("__first")
    return kept.unionByName(keyed.filter(~has)).drop("__key")


def first_by(value: Column, order: Column) -> Column:
    """First non-null value in an order, as an aggregate."""
    return F.min_by(value, F.when(value.isNotNull(), order))


def top_k(df: DataFrame, score: Column, order: str, k: int, skip: int = 0) -> DataFrame:
    """Rows `skip`+1 to `skip`+k by falling score, ties by order, with their `rank`; only the page reaches one task."""
    page = df.withColumn("__score", score).orderBy(F.col("__score").desc(), F.col(order)).limit(skip + k)
    ranked = page.withColumn("rank", F.row_number().over(Window.orderBy(F.col("__score").desc(), F.col(order))))
    return ranked.filter(F.col("rank") > skip).drop("__score")
