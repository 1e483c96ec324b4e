"""One surviving record per group of duplicates, chosen field by field on the skyline of completeness, recency and trust."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.llm.markup import clean

# Texts that providers put in place of an abstract, and notices they append to one.
_PLACEHOLDER = re.compile(
    r"^(?:\(?(?:no|without) (?:abstract|summary)\b.*|(?:the )?abstract (?:is )?(?:not|un)\s?available.*|n/?a\.?|none|null|nan|-+|please (?:refer|see)\b.*|see (?:the )?full text.*|not (?:available|provided)\.?|abstract)$",
    re.I | re.S,
)
_NOTICE = re.compile(
    r"\s*(?:(?:©|\(c\)\s|copyright\b)[^\n]*$|all rights reserved\.?$|published by [^.\n]*\.$|keywords?\s*:[^\n]*$|(?:this article is )?(?:licensed|distributed) under [^\n]*$|for permissions[^\n]*$|(?:received|accepted)\s*:?\s*\d[^\n]*$)",
    re.I,
)
_APPENDIX = re.compile(r"\s*(?:```\n.*?\n```|`[^`\n]*`|\$[^$\n]*\$|(?:^|\n)[^|\n]+ \| [^\n]*(?:\n[^\n]*\|[^\n]*)*|(?:\n\S+(?: ± \S+)?){3,}|\[[^\]\n]*\]\([^)\n]*\))\s*$", re.S)
#: A sentence that only points to a link, in the marks it is written with.
_POINTER = re.compile(r"\s*\bsee (?:also )?(?:\[[^\]\n]*\]\([^)\n]*\)|<a\b[^>]*>[^<]*</a>|\\href\{[^{}]*\}\{[^{}]*\}|\[https?://\S+ [^\]\n]*\])\.?\s*$", re.I)
_CUT = re.compile(r"(?:\.\.\.|…|\[\s*(?:\.\.\.|…)\s*\]|\(no\.|\bFig\.|\be\.g\.|\bi\.e\.)$")
_END = re.compile(r"[.!?][\"'’”)\]]*$")


def core_text(abstract: str | None) -> str:
    """The abstract's own words: markup, appended notices and appended objects removed; empty for placeholders."""
    if abstract is None:
        return ""
    text = re.sub(r"</?[A-Za-z:-]*$", "", clean(_POINTER.sub("", abstract))[0]).strip()
    while True:
        shorter = _APPENDIX.sub("", _NOTICE.sub("", text)).strip()
        if shorter == text:
            break
        text = shorter
    return "" if _PLACEHOLDER.match(text) else text


def is_complete(core: str) -> bool:
    """Whether a core text ends as a sentence does, not where a provider cut it."""
    return bool(core) and not _CUT.search(core) and bool(_END.search(core))


def word_count(core: str) -> int:
    """Words of a core text without headings and formulas."""
    return len(re.sub(r"^## .*$|\$[^$\n]*\$|`[^`\n]*`", " ", core, flags=re.M).split())


@F.pandas_udf(T.IntegerType())
def abstract_words(abstracts: pd.Series) -> pd.Series:
    """Words of an abstract that ends as a sentence does; 0 for none, placeholders and texts cut short."""

    def count(a):
        core = core_text(a)
        return word_count(core) if is_complete(core) else 0

    return abstracts.map(count).astype("int32")


def doi_key(doi: Column) -> Column:
    """A DOI in one form: resolver and label prefixes, letter case, percent encoding and closing marks removed; null where none."""
    text = F.regexp_replace(F.lower(F.translate(doi, "\t\n\r ", "    ")), "%2f", "/")
    return F.nullif(F.regexp_replace(F.regexp_extract(text, r"(10\.[0-9]{4,9}/\S+)", 1), r"[.,;:)\]>\"'}]+$", ""), F.lit(""))


def is_pdf_address(url: Column) -> Column:
    """Whether a text is a well-formed absolute web address whose path is a PDF file."""
    return F.coalesce(F.trim(url).rlike(r"(?i)^https?://[a-z0-9](?:[a-z0-9.-]*[a-z0-9])?(?::\d+)?/[^\s?#]*[^\s?#/]\.pdf(?:\?[^\s#]*)?(?:#\S*)?$"), F.lit(False))


#: Words by which the longest abstract of a group may exceed a complete one: a short sentence appended with a formula or link.
SLACK = 7
#: Trust of the sources, best last; sources not listed have none.
TRUST = ("google_scholar", "google_patents", "core", "arxiv", "semantic_scholar", "openalex", "europepmc", "pubmed", "crossref")


def dominates(a: tuple, b: tuple) -> bool:
    """Pareto dominance: nowhere worse and somewhere better."""
    return a != b and all(x >= y for x, y in zip(a, b))


def layers(points: list[tuple]) -> list[int]:
    """The dominance layer of each point, 0 for the skyline; points that dominate others come first in lexicographic order."""
    order = sorted(range(len(points)), key=lambda i: points[i], reverse=True)
    out, best = [0] * len(points), {}
    for i in order:
        p = points[i]
        level = 0
        while any(dominates(q, p) for q in best.get(level, ())):
            level += 1
        out[i] = level
        best.setdefault(level, []).append(p)
    return out


def skyline(cells: list[dict]) -> tuple[list[dict], list[int]]:
    """(cells of one group, one for each combination of what is filled and trust; the dominance layer of each).

    A cell is better in a dimension by having the complete abstract, a PDF link, a known count or one more of the other fields,
    by being retrieved later, by more trust, and by standing earlier. So the best row for any one field is never dominated.
    """
    most = max(c["words"] for c in cells)
    merged: dict[tuple, dict] = {}
    for c in cells:
        whole = int(c["words"] > 0 and c["words"] >= most - SLACK)
        key = (whole, c["pdf_ok"], c["count_ok"], c["has"], c["trust"])
        seen = merged.get(key)
        if seen is None:
            merged[key] = {**c, "whole": whole}
            continue
        seen["first_row"] = min(seen["first_row"], c["first_row"])
        if (c["last_at"], -c["last_row"]) > (seen["last_at"], -seen["last_row"]):
            seen["last_at"], seen["last_row"] = c["last_at"], c["last_row"]
    out = list(merged.values())
    bits = range(len(FILLED))
    return out, layers([(c["whole"], c["pdf_ok"], c["count_ok"], *(c["has"] >> k & 1 for k in bits), c["last_at"], c["trust"], -c["first_row"]) for c in out])


def policy(cell: dict) -> tuple:
    """What decides between undominated records: completeness, then recency, then trust, then the earlier row."""
    return (cell["whole"] + cell["pdf_ok"] + cell["count_ok"] + cell["has"].bit_count(), cell["last_at"], cell["trust"], -cell["last_row"])


def choose(cells: list[dict]) -> tuple[int, int, int, int, list[int], int]:
    """(abstract row, pdf row, count row, base row, rows that fill the other fields, records on the skyline) of one group's cells.

    Only undominated cells compete: the earliest row with the complete abstract, the last retrieved rows with a PDF link and with
    a known count, and by the policy the base row. A field of `FILLED` that the base lacks is filled from the best cell of the
    first layer that has it; 0 where no row qualifies.
    """
    cells, level = skyline(cells)
    top = [c for c, n in zip(cells, level) if n == 0]
    base = max(top, key=policy)

    def latest(flag: str) -> int:
        return max(((c["last_at"], c["trust"], -c["last_row"]) for c in top if c[flag]), default=(0, 0, 0))[2] * -1

    fills = []
    for k in range(len(FILLED)):
        if base["has"] >> k & 1:
            fills.append(base["last_row"])
            continue
        holders = [(-n, policy(c), c["last_row"]) for c, n in zip(cells, level) if c["has"] >> k & 1]
        fills.append(max(holders)[2] if holders else 0)
    return (min((c["first_row"] for c in top if c["whole"]), default=0), latest("pdf_ok"), latest("count_ok"), base["last_row"], fills, len(top))


#: Fields of a record besides abstract, link and count, taken from the base record or filled from the next layers.
FILLED = ("title", "authors", "year", "journal")
_CHOICE = T.StructType().add("abstract_row", T.LongType()).add("pdf_row", T.LongType()).add("citation_row", T.LongType()).add("base_row", T.LongType()).add("fills", T.ArrayType(T.LongType())).add("skyline", T.IntegerType())


@F.pandas_udf(_CHOICE)
def _choose(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for groups in parts:
        yield pd.DataFrame([choose(list(g)) for g in groups], columns=_CHOICE.names)


def survivors(papers: DataFrame) -> DataFrame:
    """Per DOI of two or more rows: group_row, copies, abstract_row, pdf_row, citation_row, base_row, fills, skyline.

    Rows are first combined into cells of equal completeness and trust, of which only the first and the last retrieved row can
    matter; so what a group brings into one task is bounded by the number of cells, not by its rows, and is combined before the
    shuffle. Counts that are null, negative or from a source that never shows more than 0 are unknown. Rows without a DOI form
    no group. Of rows retrieved at the same moment the smaller counts. Columns of `FILLED` may be missing.
    """
    shows = papers.groupBy(F.col("source").alias("shown_by")).agg((F.max("citation_count") > 0).alias("shows"))
    trust = F.coalesce(F.array_position(F.array(*map(F.lit, TRUST)), F.col("source")), F.lit(0)).cast("int")
    flags = [F.when(F.size(f) > 0 if f == "authors" else F.col(f).isNotNull(), 1 << k).otherwise(0) for k, f in enumerate(FILLED) if f in papers.columns]
    has = sum(flags[1:], flags[0]) if flags else F.lit(0)
    rows = papers.select("paper_row", "source", "abstract", "citation_count", "retrieved_at", doi_key(F.col("doi")).alias("doi"), is_pdf_address(F.col("pdf_url")).cast("int").alias("pdf_ok"), has.cast("int").alias("has")).filter("doi is not null")
    many = rows.groupBy("doi").agg(F.count("*").alias("copies"), F.min("paper_row").alias("group_row")).filter("copies > 1")
    members = rows.join(many.select("doi"), "doi", "left_semi").join(shows, F.col("source").eqNullSafe(F.col("shown_by")), "left")
    known = (F.col("citation_count") >= 0) & F.col("shows")
    seen = F.struct(F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast(retrieved_at as timestamp_ntz))").alias("at"), (-F.col("paper_row")).alias("minus"))
    cells = (
        members.withColumn("words", F.when(F.col("abstract").isNotNull(), abstract_words("abstract")).otherwise(0))
        .withColumn("count_ok", F.coalesce(known, F.lit(False)).cast("int"))
        .groupBy("doi", "words", "pdf_ok", "count_ok", "has", trust.alias("trust"))
        .agg(F.min("paper_row").alias("first_row"), F.max(seen).alias("seen"))
        .select("doi", F.struct("words", "pdf_ok", "count_ok", "has", "trust", "first_row", F.coalesce(-F.col("seen.minus"), F.lit(0).cast("long")).alias("last_row"), F.coalesce("seen.at", F.lit(0).cast("long")).alias("last_at")).alias("cell"))
    )
    chosen = cells.groupBy("doi").agg(F.collect_list("cell").alias("cells")).select("doi", _choose("cells").alias("c"))
    return chosen.join(many, "doi").select("group_row", "copies", "c.*")


def found(papers: DataFrame) -> DataFrame:
    """Groups of rows with the same DOI: group_row, abstract_row, pdf_row, citation_row."""
    return survivors(papers).select("group_row", "abstract_row", "pdf_row", "citation_row")


def records(papers: DataFrame) -> DataFrame:
    """The surviving record of each group: group_row, copies, base_row, skyline, and every field with the source it is taken from.

    Chosen rows are looked up by one join: each (group, row, field) meets the papers table once.
    """
    chosen = survivors(papers)
    fields = [("abstract", "abstract_row"), ("pdf_url", "pdf_row"), ("citation_count", "citation_row"), *((f, f"fills[{k}]") for k, f in enumerate(FILLED) if f in papers.columns)]
    wanted = chosen.select("group_row", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.expr(at).alias("row")) for f, at in fields])).alias("w")).select("group_row", "w.*").filter("row > 0")
    values = papers.select(F.col("paper_row").alias("row"), "source", *[f for f, _ in fields])
    got = wanted.join(values, "row").groupBy("group_row").agg(*[F.first(F.when(F.col("field") == f, F.struct(F.col(f).alias("v"), F.col("source").alias("s"))), ignorenulls=True).alias(f"__{f}") for f, _ in fields])
    out = chosen.join(got, "group_row", "left")
    return out.select("group_row", "copies", "base_row", "skyline", *[x for f, _ in fields for x in (F.col(f"__{f}.v").alias(f), F.col(f"__{f}.s").alias(f"{f}_source"))])
