"""Curation of observation records: duplicates, conflicts, categories and the processing report. Nothing is deleted, only tagged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom.functions import numeric, text
from assayloom.operators.order import number

# Rank of validation states for the primary row (best first) and for entities (higher wins).
PRIMARY_RANK = {"passed": 0, "unverified": 1, "failed": 2}
ENTITY_RANK = {"failed": 0, "unverified": 1, "conflict": 2, "passed": 3}
OBSERVATION = ("source_pdf", "source_type", "name_raw", "smiles_raw", "value_raw", "unit_raw", "target_raw")


def _rank(column: str, ranks: dict[str, int], other: int):
    out = F.lit(other)
    for k, v in ranks.items():
        out = F.when(F.col(column) == k, v).otherwise(out)
    return out


def _grouped(records: DataFrame, leaders: DataFrame | None = None):
    eid = text.entity_id(F.col("inchikey"), F.col("pubchem_cid"), F.col("cas"))
    if leaders is not None:
        named = leaders.select(F.col("name").alias("__name"), F.concat(F.lit("nm:"), F.lower("leader")).alias("__leader"))
        records = records.join(named, F.coalesce("name_std", "name_raw") == F.col("__name"), "left")
        eid = F.coalesce(eid, F.col("__leader"))
    keyed = records.withColumn("eid", eid).filter("eid is not null").withColumn("bucket", numeric.value_bucket(F.col("value_std")))
    ids = sum(F.col(c).isNotNull().cast("int") for c in ("inchikey", "pubchem_cid", "cas", "smiles_canonical"))
    best = F.struct(_rank("validation", PRIMARY_RANK, 3).alias("v"), (-ids).alias("i"), F.col("extracted_at").alias("t"), F.col("rec_no").alias("rec_no"))
    same = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in OBSERVATION])
    keys = ["eid", F.coalesce("property", F.lit("")).alias("prop"), F.coalesce("bucket", F.lit(-(2**62))).alias("bucket"), F.coalesce("unit_std", F.lit("")).alias("unit")]
    keyed = keyed.select("rec_no", *keys, best.alias("best"), same.alias("obs"))
    # least and greatest observation digest tell whether all are one, with partial aggregation and no distinct set
    groups = keyed.groupBy("eid", "prop", "bucket", "unit").agg(
        F.count("*").alias("n"), F.min("rec_no").alias("first_rec"), F.min("best")["rec_no"].alias("primary_rec"), (F.min("obs") == F.max("obs")).alias("one_obs")
    )
    return keyed, groups


def duplicate_groups(records: DataFrame, leaders: DataFrame | None = None) -> DataFrame:
    """Groups of two or more records of one entity, property, value (to 0.0001) and unit.

    dup_group (numbered by first appearance), n, dup_level (1 verbatim, 4 same value, 2 without a property), primary_rec (best
    validation, most identifiers, earliest). Records without an identifier are told apart by the leader of their name's cluster
    in `leaders` (name, leader); without that table they form no group.
    """
    _, groups = _grouped(records, leaders)
    many = groups.filter("n > 1").withColumn("dup_level", F.when(F.col("one_obs"), 1).when(F.col("prop") != "", 4).otherwise(2))
    return number(many, "first_rec").select(F.format_string("dup_%03d", "number").alias("dup_group"), "n", "dup_level", "first_rec", "primary_rec")


def primary_view(records: DataFrame) -> DataFrame:
    """rec_no of the records that remain when every duplicate group is represented by its primary row."""
    keyed, groups = _grouped(records)
    anchored = groups.select(F.col("primary_rec").alias("rec_no"))
    loose = records.filter(text.entity_id(F.col("inchikey"), F.col("pubchem_cid"), F.col("cas")).isNull()).select("rec_no")
    return anchored.unionByName(loose)


def value_conflicts(records: DataFrame) -> DataFrame:
    """Primary values of one entity, property and unit that disagree: conflict_group, eid, property, unit_std, n, lo, hi."""
    eid = text.entity_id(F.col("inchikey"), F.col("pubchem_cid"), F.col("cas"), F.col("name_std"))
    rows = records.filter("is_primary is distinct from false and property <> '' and value_std is not null").withColumn("eid", eid).filter("eid is not null")
    groups = rows.groupBy("eid", "property", "unit_std").agg(F.count("*").alias("n"), F.min("value_std").alias("lo"), F.max("value_std").alias("hi"), F.min("rec_no").alias("first_rec"))
    clashing = groups.filter((F.col("n") > 1) & numeric.values_disagree(F.col("lo"), F.col("hi"), F.coalesce("unit_std", F.lit(""))))
    return number(clashing, "first_rec").select(F.format_string("conf_%03d", "number").alias("conflict_group"), "eid", "property", "unit_std", "n", "lo", "hi")


# Issues by the text that reveals them, and where it stands.
ISSUES = [
    ("malformed SMILES", "validation_detail", "unparseable smiles"),
    ("malformed SMILES", "review_reason", "malformed smiles"),
    ("unresolved compound name", "review_reason", "unresolved name"),
    ("unresolved compound name", "validation_detail", "name did not resolve"),
    ("missing unit", "review_reason", "unit missing"),
    ("missing unit", "review_reason", "unit assumed"),
    ("invalid unit", "review_reason", "invalid unit"),
    ("unparseable value", "review_reason", "unparseable value"),
    ("value reported as range", "review_reason", "range"),
    ("implausible value (out of range)", "review_reason", "implausible"),
    ("weak/inactive value (>1 mM)", "review_reason", "weak "),
    ("suspicious range (descending/too wide)", "review_reason", "suspicious range"),
]
CLASH = "conflicting value"


def issue_counts(records: DataFrame) -> DataFrame:
    """issue, n: records by issue; a record may have several, each counted once. A flagged conflict is an issue of its own."""
    hits = [F.when(F.contains(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit(t)), F.lit(i)) for i, c, t in ISSUES]
    hits.append(F.when(F.col("conflict_flag"), F.lit(CLASH)))
    return records.select(F.explode(F.array_distinct(F.array_compact(F.array(*hits)))).alias("issue")).groupBy("issue").agg(F.count("*").alias("n"))


def report_counts(records: DataFrame) -> DataFrame:
    """One row of totals: records, primaries, removed, in need of review, distinct compounds."""
    compound = F.coalesce(F.nullif("inchikey", F.lit("")), F.concat(F.lit("cid:"), F.nullif("pubchem_cid", F.lit(""))), F.concat(F.lit("cas:"), F.nullif("cas", F.lit(""))), F.concat(F.lit("nm:"), F.lower(F.nullif("name_std", F.lit("")))))
    return records.agg(
        F.count("*").alias("records"),
        F.count_if(F.expr("is_primary is distinct from false")).alias("primaries"),
        F.count_if(F.expr("is_primary is not distinct from false")).alias("removed"),
        F.count_if(F.col("needs_review")).alias("needs_review"),
        F.count_distinct(compound).alias("compounds"),
        F.count_distinct(F.nullif("dup_group", F.lit(""))).alias("dup_groups"),
        F.count_distinct(F.nullif("conflict_group", F.lit(""))).alias("conflict_groups"),
    )


def grouped_counts(records: DataFrame) -> DataFrame:
    """Counts by validation, by source type, by extractor family and in all, in one pass of grouping sets."""
    v = records.select("validation", "source_type", F.split_part(F.coalesce("extractor", F.lit("?")), F.lit(":"), F.lit(1)).alias("family"))
    sets = v.groupingSets([[F.col("validation")], [F.col("source_type")], [F.col("family")], []], F.col("validation"), F.col("source_type"), F.col("family"))
    return sets.agg(F.count("*").alias("n"), F.grouping_id().cast("int").alias("level"))


def collapse_entities(records: DataFrame) -> DataFrame:
    """One row per entity: first non-null name, CAS and formula by record order, greatest mass, best validation, provenance count.

    Validation starts from "unverified", so "failed" never wins.
    """
    eid = text.entity_id(F.col("inchikey"), F.col("pubchem_cid"), F.col("cas"), F.col("name_std"))
    rank = F.greatest(_rank("validation", ENTITY_RANK, 1), F.lit(1))
    first = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct("rec_no", c)))[c].alias(c)
    rows = records.withColumn("eid", eid).filter("eid is not null")
    out = rows.groupBy("eid").agg(first("name_std"), first("cas"), first("formula"), F.max("mw").alias("mw"), F.max(rank).alias("r"), F.count("*").alias("provenance"))
    names = F.create_map(*[x for k, v in ENTITY_RANK.items() for x in (F.lit(v), F.lit(k))])
    return out.select("eid", "name_std", "cas", "formula", "mw", F.element_at(names, F.col("r")).alias("validation"), "provenance")


def attach_structures(records: DataFrame) -> DataFrame:
    """Structures attached by label: records without one take the first structure their paper gives the same label.

    rec_no, label, smiles for every record that found one.
    """
    labelled = records.withColumn("label", text.label_token(F.col("name_raw"))).filter("label is not null and source_pdf is not null")
    first = labelled.filter("smiles_raw is not null").groupBy("source_pdf", "label").agg(F.min(F.struct("rec_no", "smiles_raw"))["smiles_raw"].alias("smiles"))
    return labelled.filter("smiles_raw is null").join(first, ["source_pdf", "label"]).select("rec_no", "label", "smiles")


def multi_structure_names(records: DataFrame) -> DataFrame:
    """Names that stand for more than one structure in a paper: source_pdf, name_std, n_smiles."""
    pairs = records.filter("name_std is not null and smiles_raw is not null").select("source_pdf", "name_std", "smiles_raw").distinct()
    return pairs.groupBy("source_pdf", "name_std").agg(F.count("*").alias("n_smiles")).filter("n_smiles > 1")


def review_flags(records: DataFrame) -> DataFrame:
    """Review reasons joined in a fixed order for records that have any: rec_no, reasons."""
    has = lambda c, r: F.when(c, F.lit(r))
    reasons = F.array_compact(
        F.array(
            has(F.col("value_raw").isNull() | F.col("value_raw").isin("nan", "n.d.", "-", "NOT_DETECTED"), "no value"),
            has(F.col("unit_raw").isNull(), "no unit"),
            has(F.col("inchikey").isNull() & F.col("pubchem_cid").isNull() & F.col("cas").isNull(), "no identifier"),
            has(F.col("conflict_flag"), "conflict"),
        )
    )
    return records.select("rec_no", F.concat_ws("; ", reasons).alias("reasons")).filter("reasons <> ''")
