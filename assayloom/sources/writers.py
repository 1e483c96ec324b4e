"""Writers: primary and full tables, one file group per node table, vectors, resumable appends, the processing report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom.operators import curate


def records_csv(records: DataFrame, folder: str) -> None:
    """All records and the primary view as CSV."""
    records.write.mode("overwrite").option("header", True).csv(f"{folder}/all")
    records.filter("is_primary is distinct from false").write.mode("overwrite").option("header", True).csv(f"{folder}/primary")


def store_jsonl(folder: str, **groups: DataFrame) -> None:
    """One JSON-lines folder per node or edge table."""
    for name, df in groups.items():
        df.write.mode("overwrite").json(f"{folder}/{name}")


def vectors(chunks: DataFrame, folder: str) -> None:
    """Chunks with their vectors as Parquet."""
    chunks.write.mode("overwrite").parquet(folder)


def pairs(rows: DataFrame, folder: str, domain: str = "domain", stem: str = "stem") -> None:
    """Rows partitioned by domain and paper."""
    rows.repartition(domain, stem).write.mode("overwrite").partitionBy(domain, stem).option("header", True).csv(folder)


def append_new(rows: DataFrame, folder: str, key: str) -> int:
    """Appends the rows whose key the folder does not hold yet; returns their number. A rerun after a failure adds only the rest."""
    spark = rows.sparkSession
    try:
        done = spark.read.parquet(folder).select(key).distinct()
        rows = rows.join(done, key, "left_anti")
    except Exception as e:  # noqa: BLE001 - the folder is not there yet
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
    before = spark.read.parquet(folder).count() if "done" in locals() else 0
    rows.write.mode("append").parquet(folder)
    return spark.read.parquet(folder).count() - before


def prediction_schema(records: DataFrame) -> DataFrame:
    """Records in the shape of a prediction table, missing cells as NOT_DETECTED, without repeats."""
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("NOT_DETECTED"))
    return records.select(cell("name_raw").alias("compound_id"), cell("smiles_canonical").alias("smiles"), cell("property").alias("target_type"), cell("value_op").alias("target_relation"), cell("value_raw").alias("target_value"), cell("unit_raw").alias("target_units"), cell("organism_raw").alias("bacteria"), F.col("source_pdf").alias("pdf")).distinct()


def markdown_report(records: DataFrame) -> str:
    """The processing report as Markdown, from three small aggregates."""
    totals = curate.report_counts(records).collect()[0].asDict()
    issues = curate.issue_counts(records).orderBy(F.col("n").desc(), "issue").collect()
    states = records.groupBy("validation").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "validation").collect()
    lines = ["# Processing report", "", *[f"- {k}: {v}" for k, v in totals.items()], "", "## Validation", "", *[f"- {r['validation']}: {r['n']}" for r in states], "", "## Issues", "", *[f"- {r['issue']}: {r['n']}" for r in issues]]
    return "\n".join(lines) + "\n"
