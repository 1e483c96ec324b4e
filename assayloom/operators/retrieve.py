"""Multi-source retrieval: keep-first, ranking, coverage, vector search, votes and figure routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayloom.functions import numeric, text
from assayloom.operators.order import keep_first, top_k


def keep_first_two_phase(papers: DataFrame) -> DataFrame:
    """Rows that survive keep-first by DOI and then, among these, keep-first by normalised title; empty keys pass."""
    one = keep_first(papers.select("paper_row", "doi", "title"), text.doi_plain(F.col("doi")), "paper_row")
    return keep_first(one, text.title_norm(F.col("title")), "paper_row").select("paper_row")


def ranked_page(papers: DataFrame, query: str, now: int, size: int, skip: int) -> DataFrame:
    """A page of papers by relevance: rank, paper_row, score in thousandths; ties by row."""
    score = numeric.relevance(F.col("source"), F.col("citation_count"), F.col("year"), F.col("title"), F.col("abstract"), F.coalesce("is_open_access", F.lit(False)), query, now)
    milli = papers.select("paper_row", F.floor(score * 1000 + 0.5).cast("long").alias("score_milli"))
    return top_k(milli, F.col("score_milli"), "paper_row", size, skip).select(F.col("rank").cast("long").alias("rank"), "paper_row", "score_milli")


def coverage(papers: DataFrame) -> DataFrame:
    """source, with_doi, unique_only: distinct DOIs of each source and those no other source has."""
    pairs = papers.select("source", text.doi_plain(F.col("doi")).alias("doi")).filter("doi is not null").distinct()
    holders = pairs.groupBy("doi").agg(F.count("*").alias("n"), F.min("source").alias("only"))
    alone = holders.filter("n = 1").groupBy(F.col("only").alias("source")).agg(F.count("*").alias("unique_only"))
    return pairs.groupBy("source").agg(F.count("*").alias("with_doi")).join(alone, "source", "left").fillna(0, ["unique_only"])


def nearest(vectors: DataFrame, query: list[float], k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k nearest rows by cosine to one query vector: rank and key; the scan is narrow and only k rows meet."""
    unit = numeric.unit_vector(F.array(*[F.lit(float(x)) for x in query]))
    sim = numeric.dot(numeric.unit_vector(F.col(vector)), unit)
    return top_k(vectors.select(key, sim.alias("sim")), F.floor(F.col("sim") * 1e6 + 0.5), key, k).select(F.col("rank").cast("long").alias("rank"), key)


def majority_vote(votes: DataFrame, item: str, value: str, order: str) -> DataFrame:
    """item, winner, votes, total: the most frequent value, ties by first appearance."""
    per = votes.groupBy(item, value).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    best = per.groupBy(item).agg(F.min(F.struct((-F.col("n")).alias("minus"), "first", F.col(value).alias("value"))).alias("b"), F.sum("n").alias("total"))
    return best.select(item, F.col("b.value").alias("winner"), (-F.col("b.minus")).alias("votes"), "total")


# Figure classes by what a caption contains, in order; words a routing term never is; classes worth a little more.
RELEVANCE = [
    ("binding_curve", ("binding", "affinity", "dissociation constant", " kd ", "isotherm", "titration", "dose-response", "dose response", "ic50", "ec50", "saturation curve", "adsorption isotherm")),
    ("spectrum", ("spectra", "spectrum", "spectroscop", " nmr", "ftir", " ir ", "uv-vis", "uv–vis", "raman", " xrd", " xps", "diffraction", "fluorescence", "absorption spectr", "mass spec")),
    ("micrograph", (" sem", " tem", " afm", " stm", "micrograph", "microscopy", "microscope")),
    ("structure", ("chemical structure", "molecular structure", "skeletal", "crystal structure", "scheme", "synthesi", "reaction ")),
    ("mechanism", ("mechanism", "pathway", "catalytic cycle", "proposed")),
    ("performance_plot", ("performance", "efficiency", "yield", "conversion", "selectivity", "rejection", "flux", "capacity", "cycling", "retention", "stability", "as a function of", "versus", " vs ", "over time")),
    ("workflow", ("schematic", "design", "setup", "apparatus", "illustration", "overview", "workflow", "fabrication", "process")),
]
STOP = (
    "the", "a", "an", "of", "in", "on", "for", "to", "and", "or", "is", "are", "was", "were", "what", "which", "how", "does", "do", "with", "by", "at", "as", "from", "that", "this", "these", "those",
    "its", "their", "between", "based", "figure", "fig", "scheme", "panel", "image", "value", "values", "shown", "using", "used", "into", "than", "then", "also", "can", "be", "it", "effect",
)
CURVES = ("performance_plot", "binding_curve", "spectrum")
FIGURE_NUMBER = r"(?i)\bfig(?:ure)?\.?\s*(\d+)"
ASKED_NUMBER = r"(?i)\b(?:fig(?:ure)?|scheme)\.?\s*(\d+)"
FIGURE_WORD = r"(?i)\b(fig(?:ure)?|scheme|panel|image|micrograph|spectrum|spectra|curve|plot|graph|shown|depicted|inset|photograph|diagram|illustrat)\b"


def data_relevance(caption: Column) -> Column:
    """Class of a caption: the first of which it contains a keyword; null where it contains none."""
    low = F.lower(caption)
    holds = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(low, w))
    return F.coalesce(*[F.when(holds(words), F.lit(k)) for k, words in RELEVANCE])


def terms(caption: Column) -> Column:
    """Distinct words of three letters or more that are no stop words."""
    return F.array_except(F.array_distinct(F.regexp_extract_all(F.lower(caption), F.lit(r"([a-z][a-z0-9-]{2,})"), F.lit(1))), F.array(*map(F.lit, STOP)))


def route_figures(captions: DataFrame, question: str, key: str, caption: str, k: int = 3, paper: str | None = None, top_paper=None) -> DataFrame:
    """The k captions that fit a question best: rank, key, score.

    100 for a figure number the question names, 25 for the question's class, 4 per shared word up to 20; captions without any are
    out. 3 more in the paper that ranks first (`paper` names the column), 2 more for plots, curves and spectra. A question that
    names no number, no class and no figure word routes nothing.
    """
    q = F.lit(question)
    refs = F.regexp_extract_all(q, F.lit(ASKED_NUMBER), F.lit(1))
    kind, kind_q = data_relevance(F.col(caption)), data_relevance(q)
    asked = (F.size(refs) > 0) | kind_q.isNotNull() | q.rlike(FIGURE_WORD)
    number = F.nullif(F.regexp_extract(caption, FIGURE_NUMBER, 1), F.lit(""))
    base = F.when(F.array_contains(refs, number), 100).otherwise(0) + F.when(kind == kind_q, 25).otherwise(0)
    base = base + F.least(F.size(F.array_intersect(terms(F.col(caption)), terms(q))) * 4, F.lit(20))
    more = F.when(kind.isin(*CURVES), 2).otherwise(0)
    if paper is not None:
        more = more + F.when(F.col(paper) == F.lit(top_paper), 3).otherwise(0)
    scored = captions.select(key, F.when(asked & (base > 0), base + more).cast("long").alias("score")).filter("score is not null")
    return top_k(scored, F.col("score"), key, k).select(F.col("rank").cast("long").alias("rank"), key, "score")
