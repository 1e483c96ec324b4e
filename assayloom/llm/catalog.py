"""Driver queries of the operators in this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom.llm import canonical, copies, glyphs, markup, match, mixing, packing, subjects, survivor
from assayloom.session import table

Query = Callable[[SparkSession, str], DataFrame]


def _over(fn: Callable[..., DataFrame], *names: str) -> Query:
    return lambda spark, sf_dir: fn(*(table(spark, sf_dir, n) for n in names))


_DOI = """nullif(regexp_replace(regexp_extract(replace(lower(translate(doi, chr(9) || chr(10) || chr(13) || ' ', '    ')), '%2f', '/'), '(10\\.[0-9]{4,9}/\\S+)', 1), '[.,;:)\\]>"''}]+$', ''), '')"""
_PDF = r"regexp_matches(trim(pdf_url), '(?i)^https?://[a-z0-9](?:[a-z0-9.-]*[a-z0-9])?(?::\d+)?/[^\s?#]*[^\s?#/]\.pdf(?:\?[^\s#]*)?(?:#\S*)?$')"
_TRUST = "coalesce(list_position([" + ", ".join(f"'{s}'" for s in survivor.TRUST) + "], source), 0)"
_LAST = f"order by retrieved_at desc, {_TRUST} desc, paper_row"
_FIELDS = ("smiles", "doi", "title", "publisher", "year", "access", "compound_id", "target_type", "target_relation", "target_value", "target_units", "bacteria", "bacteria_unified", "page_target", "origin_target", "page_scaffold", "origin_scaffold", "pdf")


def _leaf_sql(field: str) -> str:
    if field in copies.EXACT:
        return f"coalesce(regexp_replace({field}, '[\\s\\p{{Z}}]+', '', 'g'), chr(2))"
    kept = f"lower({field})"
    for _ in range(2):  # a digit may stand between two marks
        kept = f"regexp_replace({kept}, '([0-9])[.,]([0-9])', '\\1' || chr(57344) || '\\2', 'g')"
    kept = f"translate({kept}, '%‰', chr(57345) || chr(57346))"
    if field in copies.SIGNED:
        kept = f"translate({kept}, '-–—−‐‑‒', repeat(chr(57347), 7))"
    return f"coalesce(regexp_replace({kept}, '[\\s\\p{{Z}}\\p{{P}}]', '', 'g'), chr(2))"


def _p4_links(papers: DataFrame) -> DataFrame:
    """The part of p4_found that SQL can express: link and count rows of each group."""
    return survivor.survivors(papers).select("group_row", "copies", "pdf_row", "citation_row")


def _p5_assay(assay: DataFrame) -> DataFrame:
    """The part of p5_found that SQL can express: copies among the assay rows."""
    return copies.duplicates(assay, "row_id", *copies.assay_tree(assay))


def _p8_whole(documents: DataFrame, specs: DataFrame) -> DataFrame:
    """What any packing must keep: every document placed, no container over its capacity, each text in one piece unless it is longer."""
    packed = packing.pack_documents(documents, specs)
    size = packed.groupBy("spec_id", "doc_id").agg(F.sum("n_tokens").alias("size"), F.count("*").alias("pieces"))
    cap = specs.select(F.col("spec_id").cast("long").alias("spec_id"), "capacity_tokens")
    over = packed.filter("container_id is not null").groupBy("spec_id", "container_id").agg(F.sum("n_tokens").alias("n")).join(cap, "spec_id").groupBy("spec_id").agg(F.count_if(F.col("n") > F.col("capacity_tokens")).alias("overfull"))
    whole = size.join(cap, "spec_id").groupBy("spec_id").agg(F.count("*").alias("n_docs"), F.count_if((F.col("pieces") > 1) & (F.col("size") <= F.col("capacity_tokens"))).alias("parted"))
    return whole.join(over, "spec_id")


def queries() -> dict[str, Query]:
    return {
        "p1_found": _over(match.found, "papers"),
        "p1_matches": _over(match.match_works, "papers"),
        "p2_found": _over(markup.found, "papers"),
        "p2_cleaned": _over(markup.cleaned, "papers"),
        "p3_found": _over(canonical.found, "assay_rows", "curated_records", "organism_ref"),
        "p4_found": _over(survivor.found, "papers"),
        "p4_records": _over(survivor.records, "papers"),
        "p5_found": _over(copies.found, "assay_rows", "llm_rows"),
        "p4_links": _over(_p4_links, "papers"),
        "p5_assay": _over(_p5_assay, "assay_rows"),
        "p5_measurements": _over(copies.measurements, "assay_rows", "llm_rows"),
        "p6_found": _over(glyphs.found, "assay_rows", "curated_records", "unit_ref"),
        "p8_packed": _over(packing.pack_documents, "documents", "pack_specs"),
        "p8_fill": _over(packing.fill_report, "documents", "pack_specs"),
        "p9_drawn": _over(mixing.mixed, "documents", "mix_targets", "subject_labels", "subject_ref"),
        "p8_whole": _over(_p8_whole, "documents", "pack_specs"),
        "p9_shares": _over(mixing.report, "documents", "mix_targets", "subject_labels", "subject_ref"),
        "p10_found": _over(subjects.assign_subjects, "documents", "subject_labels", "subject_ref"),
        "p10_composition": _over(subjects.composition, "documents", "subject_labels", "subject_ref"),
    }


def oracle_sql() -> dict[str, str]:
    whole = ", ".join(_leaf_sql(f) for f in _FIELDS)
    return {
        "p4_links": f"""with p as (select *, {_DOI} d from papers), s as (select source, max(citation_count) > 0 shows from papers group by 1), g as (select d, count(*) copies, min(paper_row) group_row from p where d is not null group by 1 having count(*) > 1),
            u as (select d, arg_min(paper_row, r) pdf_row from (select d, paper_row, row_number() over (partition by d {_LAST}) r from p where d is not null and {_PDF}) group by 1),
            c as (select d, arg_min(paper_row, r) citation_row from (select d, paper_row, row_number() over (partition by d {_LAST}) r from p join s using (source) where d is not null and citation_count >= 0 and shows) group by 1)
            select group_row, copies, coalesce(pdf_row, 0) pdf_row, coalesce(citation_row, 0) citation_row from g left join u using (d) left join c using (d)""",
        "p5_assay": f"select keep_id, row_id dup_id from (select row_id, min(row_id) over (partition by w) keep_id from (select row_id, concat_ws(chr(1), {whole}) w from assay_rows)) where row_id <> keep_id",
        "p8_whole": "select spec_id::bigint spec_id, (select count(*) from documents) n_docs, 0::bigint parted, 0::bigint overfull from pack_specs",
    }
