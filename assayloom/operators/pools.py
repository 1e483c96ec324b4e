"""Pools of structures, tables worth reading, samples per level, download lists and enrichment from lookup tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayloom.functions import text
from assayloom.operators.score import multiset_counts

ACCESS_COLUMNS = ("access", "is_oa", "oa_status")
# Weights of a table's cells, the least score and the number of tables that are read.
POWERS = ("1", "2", "4", "8", "16", "32", "64", "128", "256", "512", "1024", "0.5", "0.25", "0.125", "0.06", "0.03")
ORGANISMS = r"(?i)(?:aureus|coli|aeruginosa|subtilis|pneumoniae|faecalis|typhimurium|typhi|epidermidis|Klebsiella|Salmonella|Staphylococcus|Escherichia|Pseudomonas|Bacillus|Enterococcus|MRSA|MSSA)"
LEAST, TABLES = 3.0, 6


def open_rows(df: DataFrame) -> DataFrame:
    """Rows of open access by the first access column the table has; an error where it has none."""
    column = next((c for c in ACCESS_COLUMNS if c in df.columns), None)
    if column is None:
        raise ValueError(f"none of the columns {', '.join(ACCESS_COLUMNS)}")
    return df.filter(text.is_open(F.col(column)))


def ordered_union(parts: list[DataFrame], keys: list[str], value: str, order: str) -> DataFrame:
    """`keys`, `value`, source (number of the table, from 0), `order`: every value of a key once, from the first table that has it.

    Within a table the first by `order` counts. Null and empty values are none.
    """
    one = [p.select(*keys, value, F.lit(n).alias("source"), order) for n, p in enumerate(parts)]
    every = one[0]
    for p in one[1:]:
        every = every.unionByName(p)
    first = every.filter(F.coalesce(F.col(value), F.lit("")) != "").groupBy(*keys, value).agg(F.min(F.struct("source", order)).alias("f"))
    return first.select(*keys, value, "f.source", F.col(f"f.{order}").alias(order))


def converge(pool: DataFrame, paper: str, engine: str, value: str, order: str) -> DataFrame:
    """`paper`, engines: a map from engine to its distinct values in order of first appearance. A converged pool converges to itself.

    A paper's pool is short by nature; it is combined before the shuffle.
    """
    first = pool.filter(F.coalesce(F.col(value), F.lit("")) != "").groupBy(paper, engine, value).agg(F.min(order).alias("at"))
    lists = first.groupBy(paper, engine).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", value))), lambda x: x[value]).alias("values"))
    return lists.groupBy(paper).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(engine, "values")))).alias("engines"))


def table_scores(cells: DataFrame, keys: list[str], value: str) -> DataFrame:
    """`keys`, score: 1 for a cell that is a power of two, 1.5 for one that begins with a comparator, 2 for each organism named."""
    cell = F.trim(F.coalesce(value, F.lit("")))
    organisms = F.size(F.regexp_extract_all(cell, F.lit(ORGANISMS), F.lit(0)))
    points = F.when(cell.isin(*POWERS), 1.0).otherwise(0.0) + F.when(F.substring(cell, 1, 1).isin(">", "<", "≥", "≤"), 1.5).otherwise(0.0) + organisms * 2.0
    return cells.groupBy(*keys).agg(F.sum(points).alias("score"))


def best_tables(scores: DataFrame, paper: str, table: str) -> DataFrame:
    """The `TABLES` tables of each paper that score best, `LEAST` at least: paper, table, score, rank; ties by table."""
    w = Window.partitionBy(paper).orderBy(F.col("score").desc(), table)
    return scores.filter(F.col("score") >= LEAST).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= TABLES)


def per_level(df: DataFrame, level: str, order: str, n: int) -> DataFrame:
    """The first n rows of each level by a unique column; Spark keeps n rows of a level per partition before the shuffle."""
    kept = df.select(level, order)
    first = kept.withColumn("__r", F.row_number().over(Window.partitionBy(level).orderBy(order))).filter(F.col("__r") <= n).drop("__r")
    return df.join(first, [level, order], "left_semi")


def manual_downloads(downloads: DataFrame, checks: DataFrame, key: str) -> DataFrame:
    """`key`, reason: files to be fetched by hand, those whose download failed or was skipped, else those found missing or bad."""
    failed = downloads.filter(F.col("status").isin("failed", "skipped")).select(key, F.concat(F.lit("download "), "status").alias("reason"), F.lit(0).alias("p"))
    bad = checks.filter(F.col("status").isin("missing", "bad")).select(key, F.concat(F.lit("file "), "status").alias("reason"), F.lit(1).alias("p"))
    return failed.unionByName(bad).groupBy(key).agg(F.min(F.struct("p", "reason"))["reason"].alias("reason"))


def without_self(references: Column, own: Column) -> Column:
    """An array of cited DOIs without the paper's own, compared by letters and digits."""
    canon = lambda x: F.regexp_replace(F.lower(x), "[^a-z0-9]", "")
    return F.filter(references, lambda r: F.coalesce(canon(r) != canon(own), F.lit(True)))


def backfill(records: DataFrame, meta: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Records whose missing `columns` are filled from the row of `meta` with the same keys (the least value of several)."""
    known = meta.groupBy(*keys).agg(*[F.min(c).alias(f"__{c}") for c in columns])
    return records.join(known, keys, "left").withColumns({c: F.coalesce(c, f"__{c}") for c in columns}).drop(*[f"__{c}" for c in columns])


def enrich(entities: DataFrame, names: DataFrame, lookup: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """`entity`, source, found, status: the first source's first hit for any of an entity's names, checked by structure.

    entities: entity, inchikey; names: entity, ord, name; lookup: source, name (lower case), inchikey. A hit whose first InChIKey block
    differs from the entity's is "mismatch" and not trusted, one of an entity without a key is "unverified", the others "passed".
    """
    place = F.array_position(F.array(*map(F.lit, order)), F.col("source"))
    hits = names.select("entity", "ord", F.lower("name").alias("name")).join(lookup.withColumnRenamed("inchikey", "hit"), "name").filter(place > 0)
    best = hits.groupBy("entity", "source").agg(F.min(F.struct("ord", "hit"))["hit"].alias("hit"))
    block = lambda c: F.upper(F.split_part(F.coalesce(c, F.lit("")), F.lit("-"), F.lit(1)))
    judged = best.join(entities, "entity").withColumn("status", F.when((block("inchikey") != "") & (block("hit") != "") & (block("inchikey") != block("hit")), "mismatch").when(block("inchikey") == "", "unverified").otherwise("passed"))
    rank = F.struct((F.col("status") == "mismatch").alias("bad"), place.alias("p"), "source", "hit", "status")
    return judged.groupBy("entity").agg(F.min(rank).alias("b")).select("entity", "b.source", F.col("b.hit").alias("found"), "b.status")


def ablation(gold: DataFrame, predictions: DataFrame, article: str, variant: str, columns: list[str], variants: list[str]) -> DataFrame:
    """variant, article, f1_e6: mean F1 over `columns` for each variant of the predictions, in millionths. `variants` is a short list."""
    out = None
    for v in variants:
        counts = multiset_counts(gold, predictions.filter(F.col(variant) == v), article, columns)
        f1 = F.when(2 * F.col("tp") + F.col("fp") + F.col("fn") > 0, 2.0 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))).otherwise(0.0)
        one = counts.groupBy("article").agg(F.floor(F.avg(f1) * 1e6 + 0.5).cast("long").alias("f1_e6")).select(F.lit(v).alias("variant"), "article", "f1_e6")
        out = one if out is None else out.unionByName(one)
    return out
