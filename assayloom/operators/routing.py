"""Routing of documents to strategies, confidence of recognised text, and reconciliation of recognition engines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters a page below which it counts as scanned, hits of systematic names above which names decide, confidence to escalate.
SCANNED, NAMES, SURE = 100, 15, 0.92
# Fixed value: what marks a systematic name.
SYSTEMATIC = r"(?i)\b(?:\d-|\(\d?[RS]\)|oxo|yl\)?methyl|carboxamide|carbamate|sulfonyl|benzo\[d\]imidazol|oxazolidin|tetrahydro|dihydro|pyrazol)"
# Engines from the most trusted on.
ENGINES = ("molscribe", "vision", "decimer")


def page_class(chars: Column, pages: Column) -> Column:
    """"scanned" below 100 characters a page, "digital" otherwise."""
    return F.when(chars / F.greatest(pages, F.lit(1)) < SCANNED, "scanned").otherwise("digital")


def strategy(body: Column, kind: Column) -> Column:
    """How structures are read: from names where systematic names abound, else from images; scanned pages are read again first."""
    hits = F.size(F.regexp_extract_all(body, F.lit(SYSTEMATIC), F.lit(0)))
    return F.when(hits >= NAMES, F.when(kind == "scanned", "reingest").otherwise("names")).otherwise("images")


def page_confidence(lines: DataFrame, doc: str, confidence: str) -> DataFrame:
    """Mean and least line confidence and the number of doubtful lines by document; documents without any get 0."""
    c = F.col(confidence)
    return lines.groupBy(doc).agg(F.coalesce(F.avg(c), F.lit(0.0)).alias("mean_confidence"), F.coalesce(F.min(c), F.lit(0.0)).alias("least_confidence"), F.count_if(c < SURE).alias("doubtful"))


def reconcile(readings: DataFrame, item: str, engine: str, value: str, order: tuple[str, ...] = ENGINES) -> DataFrame:
    """What several engines read for an item: `item`, status, `value`, confidence, alternatives.

    Two or more engines that agree are ok (0.95), a single reading needs review (0.6), any difference is a disagreement (0.3)
    whatever the majority, none is failed (0). The value and the alternatives go by the order of engines, others by name behind
    them. Null and empty readings are none; of several readings of one engine the least counts.
    """
    place = F.coalesce(F.array_position(F.array(*map(F.lit, order)), F.col(engine)), F.lit(0))
    rank = F.struct(F.when(place == 0, len(order) + 1).otherwise(place).alias("p"), F.col(engine).alias("e"))
    per = readings.groupBy(item, engine).agg(F.min(F.nullif(value, F.lit(""))).alias("__v"))
    found = F.sort_array(F.collect_list(F.when(F.col("__v").isNotNull(), F.struct(rank.alias("r"), F.col("__v").alias("v")))))
    seen = per.groupBy(item).agg(F.transform(found, lambda x: x["v"]).alias("vs"))
    kinds = F.size(F.array_distinct("vs"))
    status = F.when(kinds == 0, "failed").when(kinds > 1, "disagree").when(F.size("vs") > 1, "ok").otherwise("review")
    sure = F.when(kinds == 0, 0.0).when(kinds > 1, 0.3).when(F.size("vs") > 1, 0.95).otherwise(0.6)
    first = F.get("vs", F.lit(0))
    return seen.select(item, status.alias("status"), first.alias(value), sure.alias("confidence"), F.filter(F.array_distinct("vs"), lambda x: x != F.get("vs", F.lit(0))).alias("alternatives"))
