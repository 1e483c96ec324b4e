"""Readers: tables of texts, JSON pools, PDF files, and recorded answers of outside services."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThanOrEqual, InputPartition, LessThanOrEqual


def text_table(spark: SparkSession, path: str, columns: list[str], sep: str = ",") -> DataFrame:
    """A CSV or TSV file with every column read as text, so that `125` stays `125`; named columns absent from the file are null."""
    raw = spark.read.option("header", True).option("sep", sep).option("inferSchema", False).option("multiLine", True).option("escape", '"').csv(path)
    return raw.select(*[F.col(f"`{c}`").cast("string").alias(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in columns])


def json_pool(spark: SparkSession, path: str, field: str) -> DataFrame:
    """Values of a field in JSON arrays of objects or plain texts, one file per paper: paper, value."""
    raw = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1).alias("paper"), "value")
    objects = F.from_json("value", f"array<struct<{field}: string>>")
    plain = F.from_json("value", "array<string>")
    return raw.select("paper", F.explode(F.coalesce(F.when(F.exists(objects, lambda x: x[field].isNotNull()), F.transform(objects, lambda x: x[field])), plain)).alias("value"))


def pdf_files(spark: SparkSession, folder: str, least_bytes: int = 1024) -> DataFrame:
    """PDF files of a folder with their check: name, size, status (ok, bad), reason. Only the first bytes of a file are looked at."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{pdf,PDF}").load(folder)
    magic = F.substring(F.col("content"), 1, 4) == F.lit("%PDF").cast("binary")
    reason = F.when(F.col("length") < least_bytes, "too small").when(~magic, "no PDF header").otherwise("")
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("length").alias("size"), F.when(reason == "", "ok").otherwise("bad").alias("status"), reason.alias("reason")).orderBy("name")


# ---- recorded literature answers as a data source ------------------------------------------------------------------------
PAPER = "source string, doi string, title string, authors array<string>, year int, journal string, abstract string, citation_count int, is_open_access boolean, pdf_url string"


class RecordedPapers(DataSource):
    """Recorded answers of literature services: a folder of `<service>.jsonl`, one paper object a line.

    Filters on source and year reach the reader: files of other services are not opened, years out of range not parsed into rows.
    """

    @classmethod
    def name(cls) -> str:
        return "recorded_papers"

    def schema(self) -> str:
        return PAPER

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _RecordedReader(self.options["path"], schema)


class _RecordedReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType):
        self.path, self.schema = path, schema
        self.source: str | None = None
        self.years = [-(10**9), 10**9]

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("source",):
                self.source = f.value
            elif isinstance(f, GreaterThanOrEqual) and f.attribute == ("year",):
                self.years[0] = max(self.years[0], f.value)
            elif isinstance(f, LessThanOrEqual) and f.attribute == ("year",):
                self.years[1] = min(self.years[1], f.value)
            else:
                yield f

    def partitions(self):
        files = sorted(Path(self.path).glob("*.jsonl"))
        return [InputPartition(str(f)) for f in files if self.source in (None, f.stem)]

    def read(self, partition):
        names = [f.name for f in self.schema.fields]
        bounded = self.years != [-(10**9), 10**9]
        with open(partition.value, encoding="utf8") as f:
            for line in f:
                paper = json.loads(line) if line.strip() else None
                if paper is None or (bounded and not self.years[0] <= (paper.get("year") if paper.get("year") is not None else 10**10) <= self.years[1]):
                    continue
                yield tuple(Path(partition.value).stem if n == "source" else paper.get(n) for n in names)


def register(spark: SparkSession) -> None:
    """Makes `spark.read.format("recorded_papers")` known; the setting lets filters reach Python readers."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RecordedPapers)


def full_text(candidates: DataFrame, least: int = 200) -> DataFrame:
    """One text per paper from candidates (paper_id, route, text): the best route that gave enough text, else the abstract, else none."""
    # Routes from best to worst.
    routes = ["oa_pdf", "jats", "landing_pdf", "given_pdf", "landing_html", "abstract"]
    rank = F.array_position(F.array(*map(F.lit, routes)), F.col("route"))
    usable = candidates.filter((rank > 0) & ((F.length("text") >= least) | (F.col("route") == "abstract")) & (F.length("text") > 0))
    best = usable.groupBy("paper_id").agg(F.min(F.struct(rank.alias("rank"), "route", "text")).alias("b"))
    return candidates.select("paper_id").distinct().join(best, "paper_id", "left").select("paper_id", F.coalesce("b.route", F.lit("none")).alias("level"), F.col("b.text").alias("text"))
