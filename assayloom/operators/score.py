"""Scores of predicted tables against annotated ones, and agreement of scorers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.when(b > 0, a / b).otherwise(0.0)


def multiset_counts(gold: DataFrame, pred: DataFrame, article: str, columns: list[str], missing_gold: str = "nan", missing_pred: str = "NOT_DETECTED") -> DataFrame:
    """article, field, tp, fp, fn with multiset semantics: a value counts as often as it stands on both sides.

    Missing gold prints as `missing_gold`, missing predictions as `missing_pred`, which never match. Only articles of the gold
    table are scored; one without predictions has none right.
    """

    def long(df: DataFrame, missing: str, n: str) -> DataFrame:
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(F.replace(F.col(c), F.lit(","), F.lit(".")), F.lit(missing)).alias("value")) for c in columns]))
        return df.select(F.col(article).alias("article"), cells.alias("x")).groupBy("article", "x.field", "x.value").agg(F.count("*").alias(n))

    g, p = long(gold, missing_gold, "g"), long(pred.join(gold.select(article).distinct(), article, "left_semi"), missing_pred, "p")
    both = g.join(p, ["article", "field", "value"], "full").fillna(0, ["g", "p"])
    tp = F.sum(F.least("g", "p"))
    return both.groupBy("article", "field").agg(tp.alias("tp"), (F.sum("p") - tp).alias("fp"), (F.sum("g") - tp).alias("fn"))


def macro_f1(counts: DataFrame) -> DataFrame:
    """field, articles, f1_e6: F1 per article and field, averaged over articles (in millionths)."""
    f1 = ratio(2.0 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return counts.groupBy("field").agg(F.count("*").alias("articles"), F.floor(F.avg(f1) * 1e6 + 0.5).cast("long").alias("f1_e6"))


def keyset_prf(gold: DataFrame, pred: DataFrame, kind: str, key: list[str], order: str) -> DataFrame:
    """kind, tp, fp, fn by key sets: the first prediction of a gold key is right, every further one and every other key is wrong."""
    g = gold.select(kind, *key).distinct()
    firsts = pred.groupBy(kind, *key).agg(F.count("*").alias("n"))
    joined = firsts.join(g.withColumn("is_gold", F.lit(1)), [kind, *key], "full")
    hit = F.col("n").isNotNull() & F.col("is_gold").isNotNull()
    return joined.groupBy(kind).agg(
        F.count_if(hit).alias("tp"),
        F.sum(F.when(hit, F.col("n") - 1).otherwise(F.coalesce("n", F.lit(0)))).cast("long").alias("fp"),
        F.count_if(F.col("n").isNull()).alias("fn"),
    )


def level_rollup(df: DataFrame, level: str, score: str, sentinel: int = -1) -> DataFrame:
    """level, n, total over scores other than the sentinel, per level and in all."""
    real = F.when(F.col(score) != sentinel, F.col(score))
    return df.rollup(level).agg(F.count(real).alias("n"), F.sum(real).cast("long").alias("total"), F.grouping(level).cast("int").alias("is_total"))


def scorer_agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """n, mean_a, mean_b, mean absolute difference and correlation of two scorers, in ten-thousandths."""
    rows = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b"))
    e4 = lambda c: F.floor(c * 1e4 + 0.5).cast("long")
    return rows.agg(F.count("*").alias("n"), e4(F.avg("a")).alias("mean_a"), e4(F.avg("b")).alias("mean_b"), e4(F.avg(F.abs(F.col("a") - F.col("b")))).alias("mean_diff"), e4(F.corr("a", "b")).alias("corr"))
