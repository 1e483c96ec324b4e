"""Driver queries of the core operators, each with the SQL that DuckDB runs on the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom.functions import identity, numeric, text
from assayloom.operators import curate, extract, fuzzy, graph, joins, order, pools, quantities, retrieve, routing, score, standardise
from assayloom.session import table
from assayloom.sources import connectors, fulltext
from assayloom.streaming import windows

Query = Callable[[SparkSession, str], DataFrame]
#: The year against which recency is measured.
NOW = 2026
_ENTRIES: dict[str, tuple[Query, str | None]] = {}


def query(name: str, sql: str | None = None):
    """Registers a query under its name, with its SQL twin where SQL can express it."""

    def add(fn: Callable) -> Callable:
        _ENTRIES[name] = (lambda spark, d: fn(lambda t: table(spark, d, t)), sql)
        return fn

    return add


def queries() -> dict[str, Query]:
    return {k: v[0] for k, v in _ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in _ENTRIES.items() if v[1]}


# ---- SQL fragments -----------------------------------------------------------------------------------------------------
_ID = "coalesce('ik:' || nullif(inchikey, ''), 'cid:' || nullif(pubchem_cid, ''), 'cas:' || nullif(cas, ''))"
_ID_NAME = "coalesce('ik:' || nullif(inchikey, ''), 'cid:' || nullif(pubchem_cid, ''), 'cas:' || nullif(cas, ''), 'nm:' || lower(nullif(name_std, '')))"
_DOI = r"nullif(regexp_replace(lower(trim(doi)), '^https?://(dx\.)?doi\.[a-z.]+/', ''), '')"
_TITLE = r"regexp_replace(regexp_replace(lower(trim(coalesce(title, ''))), '\s+', ' ', 'g'), '[^\p{L}\p{N}_\s]', '', 'g')"
_SECONDS = "date_diff('second', TIMESTAMP '1970-01-01 00:00:00', date_trunc('second', ts))"


def _case(rules, column: str, low: str) -> str:
    return "case " + " ".join(f"when contains({low}, '{k}') then '{v}'" for k, v in rules) + f" else {column} end"


@query("p7_found")
def _p7(t):
    return quantities.found(t("assay_rows"), t("curated_records"))


# ---- curation ----------------------------------------------------------------------------------------------------------
@query(
    "value_conflicts",
    f"""with g as (select {_ID_NAME} eid, property, unit_std, count(*) n, min(value_std) lo, max(value_std) hi, min(rec_no) f from curated_records
      where is_primary is distinct from false and property <> '' and value_std is not null and {_ID_NAME} is not null group by 1, 2, 3),
    c as (select * from g where n > 1 and case when unit_std = 'degC' then hi - lo > 5 when unit_std = '%' then hi - lo > 10 else lo <= 0 or hi / lo > 2 end)
    select 'conf_' || case when r < 1000 then lpad(r::varchar, 3, '0') else r::varchar end conflict_group, eid, property, unit_std, n, lo, hi from (select *, row_number() over (order by f) r from c)""",
)
def _conflicts(t):
    return curate.value_conflicts(t("curated_records"))


_DUP = f"""k as (select rec_no, {_ID} eid, coalesce(property, '') prop, coalesce(floor(value_std * 10000 + 0.5)::bigint, -4611686018427387904) bucket, coalesce(unit_std, '') unit,
      case validation when 'passed' then 0 when 'unverified' then 1 when 'failed' then 2 else 3 end v,
      -((inchikey is not null)::int + (pubchem_cid is not null)::int + (cas is not null)::int + (smiles_canonical is not null)::int) i, extracted_at,
      concat_ws('|', coalesce(source_pdf, '~'), coalesce(source_type, '~'), coalesce(name_raw, '~'), coalesce(smiles_raw, '~'), coalesce(value_raw, '~'), coalesce(unit_raw, '~'), coalesce(target_raw, '~')) obs
      from curated_records where {_ID} is not null),
    g as (select eid, prop, bucket, unit, count(*) n, min(rec_no) first_rec, arg_min(rec_no, (v, i, extracted_at, rec_no)) primary_rec, count(distinct obs) one from k group by 1, 2, 3, 4)"""


@query(
    "dup_groups",
    f"""with {_DUP} select 'dup_' || case when r < 1000 then lpad(r::varchar, 3, '0') else r::varchar end dup_group, n, case when one = 1 then 1 when prop <> '' then 4 else 2 end dup_level, first_rec, primary_rec
    from (select *, row_number() over (order by first_rec) r from g where n > 1)""",
)
def _dups(t):
    return curate.duplicate_groups(t("curated_records"))


@query("primary_view", f"with {_DUP} select primary_rec rec_no from g union all select rec_no from curated_records where {_ID} is null")
def _primary(t):
    return curate.primary_view(t("curated_records"))


@query(
    "issue_counts",
    "select issue, count(*) n from (select distinct rec_no, issue from ("
    + " union all ".join(f"select rec_no, '{i}' issue from curated_records where contains(lower({c}), '{x}')" for i, c, x in curate.ISSUES)
    + f" union all select rec_no, '{curate.CLASH}' from curated_records where conflict_flag)) group by 1",
)
def _issues(t):
    return curate.issue_counts(t("curated_records"))


@query(
    "record_report",
    """select count(*) records, count(*) filter (is_primary is distinct from false) primaries, count(*) filter (is_primary = false) removed, count(*) filter (needs_review) needs_review,
    count(distinct coalesce(nullif(inchikey, ''), 'cid:' || nullif(pubchem_cid, ''), 'cas:' || nullif(cas, ''), 'nm:' || lower(nullif(name_std, '')))) compounds, count(distinct nullif(dup_group, '')) dup_groups, count(distinct nullif(conflict_group, '')) conflict_groups from curated_records""",
)
def _report(t):
    return curate.report_counts(t("curated_records"))


@query(
    "report_grouping_sets",
    """select validation, source_type, split_part(coalesce(extractor, '?'), ':', 1) family, count(*) n, grouping(validation, source_type, split_part(coalesce(extractor, '?'), ':', 1))::int as level
    from curated_records group by grouping sets ((validation), (source_type), (split_part(coalesce(extractor, '?'), ':', 1)), ())""",
)
def _grouped(t):
    return curate.grouped_counts(t("curated_records"))


@query(
    "entity_collapse",
    f"""select {_ID_NAME} eid, arg_min(name_std, rec_no) filter (name_std is not null) name_std, arg_min(cas, rec_no) filter (cas is not null) cas, arg_min(formula, rec_no) filter (formula is not null) formula, max(mw) mw,
    case max(greatest(case validation when 'failed' then 0 when 'unverified' then 1 when 'conflict' then 2 when 'passed' then 3 else 1 end, 1)) when 3 then 'passed' when 2 then 'conflict' else 'unverified' end validation, count(*) provenance
    from curated_records where {_ID_NAME} is not null group by 1""",
)
def _collapse(t):
    return curate.collapse_entities(t("curated_records"))


_LABEL = r"coalesce(nullif(regexp_extract(name_raw, '\((\d{1,3}[a-z]?)\)', 1), ''), nullif(regexp_extract(name_raw, '(?:^|\s)(\d{1,3}[a-z]?)$', 1), ''))"


@query(
    "label_attach",
    f"""with l as (select rec_no, source_pdf, smiles_raw, {_LABEL} label from curated_records where source_pdf is not null),
    f as (select source_pdf, label, arg_min(smiles_raw, rec_no) smiles from l where label is not null and smiles_raw is not null group by 1, 2)
    select rec_no, label, smiles from l join f using (source_pdf, label) where smiles_raw is null""",
)
def _labels(t):
    return curate.attach_structures(t("curated_records"))


@query("distinct_flag", "select source_pdf, name_std, count(distinct smiles_raw) n_smiles from curated_records where name_std is not null and smiles_raw is not null group by 1, 2 having count(distinct smiles_raw) > 1")
def _distinct(t):
    return curate.multi_structure_names(t("curated_records"))


@query(
    "review_flags",
    """select * from (select rec_no, concat_ws('; ', case when value_raw is null or value_raw in ('nan', 'n.d.', '-', 'NOT_DETECTED') then 'no value' end, case when unit_raw is null then 'no unit' end,
    case when inchikey is null and pubchem_cid is null and cas is null then 'no identifier' end, case when conflict_flag then 'conflict' end) reasons from curated_records) where reasons <> ''""",
)
def _flags(t):
    return curate.review_flags(t("curated_records"))


@query("record_hash", "select rec_no, 'r_' || substr(sha1(coalesce(source_pdf, 'None') || '|' || coalesce(source_page::varchar, 'None') || '|' || coalesce(name_raw, 'None') || '|' || coalesce(value_raw, 'None')), 1, 12) rid from curated_records")
def _hash(t):
    return t("curated_records").select("rec_no", text.record_hash(F.col("source_pdf"), F.col("source_page"), F.col("name_raw"), F.col("value_raw")).alias("rid"))


@query("name_clusters")
def _names(t):
    loose = t("curated_records").filter("inchikey is null and pubchem_cid is null and cas is null")
    return fuzzy.cluster_names(loose.withColumn("name", F.coalesce("name_std", "name_raw")), "rec_no", "name", exact=True)


@query("dup_groups_named")
def _dups_named(t):
    records = t("curated_records")
    loose = records.filter("inchikey is null and pubchem_cid is null and cas is null").withColumn("name", F.coalesce("name_std", "name_raw"))
    return curate.duplicate_groups(records, fuzzy.cluster_names(loose, "rec_no", "name", exact=True))


@query("assay_vocabulary")
def _vocabulary(t):
    rows = t("curated_records").filter("assay_type_raw is not null").groupBy("assay_type_raw").agg(F.count("*").alias("n"))
    known = text.assay_type(F.col("assay_type_raw"))
    return rows.select("assay_type_raw", F.coalesce(known, fuzzy.nearest_word(F.col("assay_type_raw"), sorted({v for _, v in text.ASSAY_RULES}))).alias("assay"), "n")


# ---- scoring -----------------------------------------------------------------------------------------------------------
_FIELDS = ["compound_id", "target_type", "target_relation", "target_value", "target_units", "bacteria"]


def _predictions(t):
    parsed = F.from_json("payload", "struct<" + ", ".join(f"{c}: string" for c in _FIELDS) + ">")
    return t("llm_rows").select("pdf", "raw_id", parsed.alias("p")).select("pdf", "raw_id", "p.*")


@query("multiset_f1")
def _multiset(t):
    # order priorities of open orders scored against those of fulfilled ones, by nation of the customer
    o = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").cast("string").alias("article"), "o_orderstatus", "o_orderpriority", F.col("c_mktsegment").alias("segment"), F.date_format("o_orderdate", "yyyy").alias("year"))
    cols = ["o_orderpriority", "segment", "year"]
    return score.macro_f1(score.multiset_counts(o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus = 'O'"), "article", cols))


_ENTRIES["multiset_f1"] = (
    _ENTRIES["multiset_f1"][0],
    """with o as (select c_nationkey::varchar article, o_orderstatus, o_orderpriority, c_mktsegment segment, strftime(o_orderdate, '%Y') as yr from orders join customer on o_custkey = c_custkey),
    l as (select article, o_orderstatus s, 'o_orderpriority' field, o_orderpriority v from o union all select article, o_orderstatus, 'segment', segment from o union all select article, o_orderstatus, 'year', yr from o),
    g as (select article, field, v, count(*) n from l where s = 'F' group by 1, 2, 3), p as (select article, field, v, count(*) n from l where s = 'O' and article in (select article from o where o_orderstatus = 'F') group by 1, 2, 3),
    b as (select coalesce(g.article, p.article) article, coalesce(g.field, p.field) field, coalesce(g.n, 0) g, coalesce(p.n, 0) p from g full join p on g.article = p.article and g.field = p.field and g.v = p.v),
    c as (select article, field, sum(least(g, p)) tp, sum(p) - sum(least(g, p)) fp, sum(g) - sum(least(g, p)) fn from b group by 1, 2)
    select field, count(*) articles, floor(avg(case when 2 * tp + fp + fn > 0 then 2.0 * tp / (2 * tp + fp + fn) else 0 end) * 1e6 + 0.5)::bigint f1_e6 from c group by 1""",
)


@query(
    "extraction_f1_counts",
    "with p0 as (select pdf, " + ", ".join(f"payload ->> '$.{c}' {c}" for c in _FIELDS) + " from llm_rows), "
    + "g as (select article, field, v, count(*) n from (" + " union all ".join(f"select pdf article, '{c}' field, coalesce(replace({c}, ',', '.'), 'nan') v from assay_rows" for c in _FIELDS) + ") group by 1, 2, 3), "
    + "p as (select article, field, v, count(*) n from (" + " union all ".join(f"select pdf article, '{c}' field, coalesce(replace({c}, ',', '.'), 'NOT_DETECTED') v from p0 where pdf in (select pdf from assay_rows)" for c in _FIELDS) + ") group by 1, 2, 3), "
    + "b as (select coalesce(g.article, p.article) article, coalesce(g.field, p.field) field, coalesce(g.n, 0) gn, coalesce(p.n, 0) pn from g full join p on g.article = p.article and g.field = p.field and g.v = p.v) "
    + "select article, field, sum(least(gn, pn))::bigint tp, (sum(pn) - sum(least(gn, pn)))::bigint fp, (sum(gn) - sum(least(gn, pn)))::bigint fn from b group by 1, 2",
)
def _extraction(t):
    return score.multiset_counts(t("assay_rows").select("pdf", *_FIELDS), _predictions(t), "pdf", _FIELDS)


@query(
    "keyset_prf",
    """with p0 as (select payload ->> '$.target_type' kind, pdf, payload ->> '$.compound_id' cid from llm_rows), p as (select kind, pdf, cid, count(*) n from p0 where kind is not null and cid is not null group by 1, 2, 3),
    g as (select distinct target_type kind, pdf, compound_id cid from assay_rows where pdf is not null and compound_id is not null and target_type is not null),
    j as (select coalesce(p.kind, g.kind) kind, p.n, g.kind is not null gold from p full join g on p.kind = g.kind and p.pdf = g.pdf and p.cid = g.cid)
    select kind, count(*) filter (n is not null and gold) tp, sum(case when n is not null and gold then n - 1 else coalesce(n, 0) end)::bigint fp, count(*) filter (n is null) fn from j group by 1""",
)
def _keyset(t):
    gold = t("assay_rows").select(F.col("target_type").alias("kind"), "pdf", F.col("compound_id").alias("cid")).dropna()
    pred = _predictions(t).select(F.col("target_type").alias("kind"), "pdf", F.col("compound_id").alias("cid"), "raw_id").dropna(subset=["kind", "pdf", "cid"])
    return score.keyset_prf(gold, pred, "kind", ["pdf", "cid"], "raw_id")


@query("level_rollup", "select source, count(*) filter (citation_count <> -1) n, (sum(citation_count) filter (citation_count <> -1))::bigint total, grouping(source)::int is_total from papers group by rollup (source)")
def _rollup(t):
    return score.level_rollup(t("papers"), "source", "citation_count")


@query(
    "scorer_agreement",
    """select count(*) n, floor(avg(a) * 1e4 + 0.5)::bigint mean_a, floor(avg(b) * 1e4 + 0.5)::bigint mean_b, floor(avg(abs(a - b)) * 1e4 + 0.5)::bigint mean_diff, floor(corr(a, b) * 1e4 + 0.5)::bigint corr
    from (select l_quantity a, l_extendedprice b from lineitem where l_quantity is not null and l_extendedprice is not null)""",
)
def _agreement(t):
    return score.scorer_agreement(t("lineitem"), "l_quantity", "l_extendedprice")


# ---- retrieval ---------------------------------------------------------------------------------------------------------
@query(
    "keep_first_two_phase",
    f"""with k as (select paper_row, {_DOI} d, {_TITLE} x from papers), one as (select * from k where d is null or paper_row in (select min(paper_row) from k where d is not null group by d))
    select paper_row from one where x = '' or paper_row in (select min(paper_row) from one where x <> '' group by x)""",
)
def _keep(t):
    return retrieve.keep_first_two_phase(t("papers"))


def _citation_sql() -> str:
    def scale(a: int, b: int, c: int) -> str:
        n = "citation_count::double"
        return f"case when citation_count is null or citation_count <= 0 then 0.0 when citation_count <= {a} then {n} / {a} * 0.5 when citation_count <= {b} then 0.5 + ({n} - {a}) / {b - a} * 0.4 else 0.9 + least(0.1, ({n} - {b}) / {c - b} * 0.1) end"

    return "case source " + " ".join(f"when '{s}' then {scale(*v)}" for s, v in numeric.CITATIONS.items()) + f" else {scale(*numeric.CITATIONS_ELSE)} end"


@query(
    "rank_and_page",
    f"""with s as (select paper_row, floor((({_citation_sql()})::double * 10 + case when year >= {NOW - 5} then (year - {NOW - 5}) * 0.5 else 0 end + case when contains(lower(coalesce(title, '')), 'quinoline') then 5 else 0 end
      + case when contains(lower(coalesce(abstract, '')), 'quinoline') then 3 else 0 end + case when is_open_access then 2 else 0 end) * 1000 + 0.5)::bigint score_milli from papers)
    select rank, paper_row, score_milli from (select row_number() over (order by score_milli desc, paper_row) rank, * from s) where rank > 50 and rank <= 75""",
)
def _rank(t):
    return retrieve.ranked_page(t("papers"), "quinoline", NOW, 25, 50)


@query(
    "coverage_venn",
    f"""with p as (select distinct source, {_DOI} d from papers where {_DOI} is not null), h as (select d, count(*) n, min(source) s from p group by 1)
    select p.source, count(*) with_doi, count(*) filter (h.n = 1) unique_only from p join h using (d) group by 1""",
)
def _coverage(t):
    return retrieve.coverage(t("papers"))


@query("topk_cosine")
def _topk(t):
    v = t("embeddings")
    q = v.filter("vec_id = 0").select("embedding").collect()
    return retrieve.nearest(v, q[0][0] if q else [0.0], 8)


_ENTRIES["topk_cosine"] = (
    _ENTRIES["topk_cosine"][0],
    """with q as (select embedding e from embeddings where vec_id = 0), s as (select vec_id, list_dot_product(embedding::double[], e::double[]) / ((sqrt(list_dot_product(embedding::double[], embedding::double[])) + 1e-8) * (sqrt(list_dot_product(e::double[], e::double[])) + 1e-8)) x from embeddings, q)
    select rank, vec_id from (select row_number() over (order by floor(x * 1e6 + 0.5) desc, vec_id) rank, vec_id from s) where rank <= 8""",
)


@query("majority_vote", "with p as (select l_suppkey, l_returnflag v, count(*) n, min(l_orderkey * 10 + l_linenumber) f from lineitem group by 1, 2) select l_suppkey, arg_min(v, (-n, f)) winner, max(n) votes, sum(n)::bigint total from p group by 1")
def _vote(t):
    rows = t("lineitem").select("l_suppkey", F.col("l_returnflag").alias("v"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("o"))
    return retrieve.majority_vote(rows, "l_suppkey", "v", "o")


@query("figure_route")
def _figures(t):
    return retrieve.route_figures(t("papers").filter("title is not null"), "Which scheme shows the synthesis of quinoline dimers and their dose response?", "paper_row", "title", 10)


# ---- joins -------------------------------------------------------------------------------------------------------------
@query(
    "resolve_refs",
    """with m as (select lower(canonical_name) k, min(organism_id) i from organism_ref group by 1), o as (select lower(x) k, min(organism_id) i from (select organism_id, unnest(other_names) x from organism_ref) group by 1)
    select coalesce(m.i, o.i, -1) organism_id, count(*) n from (select lower(regexp_replace(organism_raw, '^\\s+|\\s+$', '', 'g')) k from curated_records where organism_raw is not null) r left join m using (k) left join o on o.k = r.k group by 1""",
)
def _refs(t):
    got = joins.resolve_references(t("curated_records").filter("organism_raw is not null").select("organism_raw"), "organism_raw", t("organism_ref"), "organism_id", "canonical_name", "other_names")
    return got.groupBy(F.coalesce("organism_id", F.lit(-1).cast("long")).alias("organism_id")).agg(F.count("*").alias("n"))


@query(
    "asof_label",
    f"""with w as (select event_id, event_type, ts, last_value(case when event_type = 'click' then event_id end ignore nulls) over o pid, last_value(case when event_type = 'click' then epoch(date_trunc('second', ts)) end ignore nulls) over o pts
      from events where event_type in ('click', 'purchase') window o as (partition by user_id order by ts, case when event_type = 'click' then 0 else 1 end, event_id rows unbounded preceding))
    select event_id, pid left_id from w where event_type = 'purchase' and epoch(date_trunc('second', ts)) - pts <= 21600""",
)
def _asof(t):
    return joins.last_before(t("events"), "click", "purchase", 6 * 3600)


@query("range_local", f"with e as (select user_id, event_type, {_SECONDS} s from events) select a.user_id, count(*) pairs from e a join e b on a.user_id = b.user_id and abs(a.s - b.s) <= 1800 where a.event_type = 'view' and b.event_type = 'error' group by 1")
def _range(t):
    return joins.overlapping(t("events"), "view", "error", 1800)


@query("nearest_match", f"with e as (select user_id, event_id, event_type, {_SECONDS} s from events) select a.event_id, min(abs(a.s - b.s)) gap_s from e a join e b on a.user_id = b.user_id where a.event_type = 'view' and b.event_type = 'error' group by 1")
def _nearest(t):
    return joins.nearest_in_time(t("events"), "view", "error")


@query("quote_grounding", "select rec_no, (instr(evidence, value_raw) - 1)::bigint char_start, (instr(evidence, value_raw) - 1 + length(value_raw))::bigint char_end from curated_records where value_raw <> '' and instr(evidence, value_raw) > 0")
def _quotes(t):
    return joins.ground_quotes(t("curated_records"), "rec_no", "evidence", "value_raw")


@query(
    "pool_cycle",
    """with r as (select row_id, pdf, row_number() over (partition by pdf order by row_id) - 1 j from assay_rows where smiles = 'NOT_DETECTED' and pdf is not null),
    p as (select pdf, smiles, row_number() over (partition by pdf order by smiles) - 1 slot, count(*) over (partition by pdf) n from (select distinct pdf, smiles from assay_rows where smiles <> 'NOT_DETECTED' and pdf is not null))
    select row_id, p.smiles from r join p on r.pdf = p.pdf and r.j % p.n = p.slot""",
)
def _cycle(t):
    a = t("assay_rows").filter("pdf is not null")
    return joins.cycle_pool(a.filter("smiles = 'NOT_DETECTED'").select("row_id", "pdf"), a.filter("smiles <> 'NOT_DETECTED'").select("pdf", "smiles"), ["pdf"], "row_id", "smiles").select("row_id", "smiles")


_KEY = "regexp_replace(replace(lower({0}), '.pdf', ''), '[^a-z0-9]', '', 'g')"


@query("file_match", f"select m.pdf, case when {_KEY.format('m.pdf')} in (select {_KEY.format('pdf')} from assay_rows where pdf is not null) then 1 else 0 end matched from manifest m where m.pdf is not null")
def _files(t):
    return joins.match_files(t("manifest").filter("pdf is not null").select("pdf"), t("assay_rows"), "pdf", "pdf")


@query("skip_done_anti", "select doc_id from documents where doc_id not in (select doc_id from subject_labels where doc_id is not null)")
def _anti(t):
    return t("documents").select("doc_id").join(t("subject_labels").select("doc_id"), "doc_id", "left_anti")


@query("semi_in_corpus", r"select distinct pdf from (select pdf, unnest(string_split_regex(doi, '[;,\s]+')) d from manifest) where contains(d, '10.') and d in (select doi from assay_rows)")
def _semi(t):
    cells = t("manifest").select("pdf", F.explode(text.dois_of(F.col("doi"))).alias("doi"))
    return cells.join(t("assay_rows").select("doi"), "doi", "left_semi").select("pdf").distinct()


@query(
    "set_ops",
    """select 'both' op, count(*) n from (select c_nationkey from customer intersect select s_nationkey from supplier) union all select 'only_customers', count(*) from (select c_nationkey from customer except select s_nationkey from supplier)
    union all select 'either', count(*) from (select c_nationkey from customer union select s_nationkey from supplier) union all select 'rows', (select count(*) from customer) + (select count(*) from supplier)""",
)
def _sets(t):
    c, s = t("customer").select(F.col("c_nationkey").alias("k")), t("supplier").select(F.col("s_nationkey").alias("k"))
    return graph.store_stats(both=c.intersect(s), only_customers=c.subtract(s), either=c.union(s).distinct(), rows=c.unionByName(s)).withColumnRenamed("node_group", "op")


@query("dataset_projection", "with f as (select l_partkey, arg_min(l_suppkey, l_orderkey * 10 + l_linenumber) r from lineitem group by 1) select l_orderkey * 10 + l_linenumber m_id, p_name as name, f.r as role, l_quantity as value from lineitem l left join part on p_partkey = l_partkey left join f on f.l_partkey = l.l_partkey")
def _dataset(t):
    m = t("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("m_id"), F.col("l_partkey").alias("e_id"), F.col("l_quantity").alias("value"), "l_suppkey")
    e = t("part").select(F.col("p_partkey").alias("e_id"), F.col("p_name").alias("name"))
    return graph.dataset_projection(m.drop("l_suppkey"), e, m.select("e_id", F.col("m_id").alias("ord"), F.col("l_suppkey").alias("role"))).select("m_id", "name", "role", "value")


@query("citation_edges", "select paper_row, (i - 1)::bigint as position, authors[i] author from (select paper_row, authors, unnest(range(1, len(authors) + 1)) i from papers)")
def _edges(t):
    return graph.author_edges(t("papers"))


@query("store_stats", "select 'papers' node_group, count(*) n from papers union all select 'measurements', count(*) from assay_rows union all select 'entities', count(*) from organism_ref union all select 'assets', count(*) from documents")
def _stats(t):
    return graph.store_stats(papers=t("papers"), measurements=t("assay_rows"), entities=t("organism_ref"), assets=t("documents"))


@query("mentions")
def _mentions(t):
    names = t("organism_ref").select(F.lit(0).alias("paper_id"), F.col("canonical_name").alias("name"))
    captions = t("papers").filter("title is not null").select(F.lit(0).alias("paper_id"), F.col("title").alias("caption"), "paper_row")
    hits = graph.mentions(names, captions, "paper_id", "name", "caption")
    return hits.groupBy("name").agg(F.count("*").alias("captions"))


_ENTRIES["mentions"] = (_ENTRIES["mentions"][0], r"select canonical_name as name, count(distinct title) captions from organism_ref, papers where regexp_matches(title, '(?i)(^|[^A-Za-z0-9])' || canonical_name || '($|[^A-Za-z0-9])') group by 1")


# ---- scalar functions --------------------------------------------------------------------------------------------------
@query("title_norm", f"select paper_row, {_TITLE} k from papers")
def _title(t):
    return t("papers").select("paper_row", text.title_norm(F.col("title")).alias("k"))


@query("doi_key", f"select paper_row, {_DOI} plain, regexp_replace(lower(doi), '[^a-z0-9]', '', 'g') k from papers")
def _doi(t):
    return t("papers").select("paper_row", text.doi_plain(F.col("doi")).alias("plain"), text.alnum_key(F.col("doi")).alias("k"))


@query(
    "safe_filename",
    r"""select paper_row, case when ends_with(lower(n), '.pdf') then n else n || '.pdf' end f from (select paper_row, case when c is null then null when c = '' then 'unknown' else c end n from
    (select paper_row, substr(trim(regexp_replace(regexp_replace(regexp_replace(title, '^\s+|\s+$', '', 'g'), '[\\/:*?"<>|\n\r\t]+', '_', 'g'), '\s+', '_', 'g'), '._ '), 1, 180) c from papers))""",
)
def _safe(t):
    return t("papers").select("paper_row", text.safe_filename(F.col("title")).alias("f"))


@query("micro_norm", "select row_id, translate(target_units, 'µμ', 'µµ') u from assay_rows")
def _micro(t):
    return t("assay_rows").select("row_id", text.micro_norm(F.col("target_units")).alias("u"))


@query("oa_flag", "select access, coalesce(lower(trim(access)) in ('1', '1.0', 'true', 'yes', 'y', 'open', 'oa', 'gold', 'green', 'hybrid', 'bronze'), false) is_oa, count(*) n from assay_rows group by 1, 2")
def _oa(t):
    return t("assay_rows").groupBy("access", text.is_open(F.col("access")).alias("is_oa")).agg(F.count("*").alias("n"))


_PKEY = "regexp_replace(lower(translate(property, '₀₁₂₃₄₅₆₇₈₉', '0123456789')), '[ \\-_.]', '', 'g')"


def _property_sql(i: int, other: str) -> str:
    exact = " ".join(f"when {_PKEY} = '{p[0]}' then '{p[i]}'" for p in numeric.PROPERTIES)
    part = " ".join(f"when contains({_PKEY}, '{p[0]}') then '{p[i]}'" for p in numeric.PROPERTIES)
    return f"case when property is null then null else case {exact} {part} else {other} end end" if i == 1 else f"case {exact} {part} else {other} end"


@query("property_norm", f"select property, {_property_sql(1, 'trim(property)')} label, {_property_sql(2, repr('unknown'))} family, count(*) n from curated_records group by 1, 2, 3")
def _property(t):
    label, family = numeric.property_of(F.col("property"))
    return t("curated_records").groupBy("property", label.alias("label"), family.alias("family")).agg(F.count("*").alias("n"))


_S = "replace(translate(trim(value_raw), '–—', '--'), ',', '')"
_N1 = r"try_cast(regexp_extract(s, '([-+]?\d*\.?\d+(?:[eE][-+]?\d+)?)', 1) as double)"


@query(
    "parse_value",
    f"""with r as (select rec_no, {_S} s from curated_records where value_raw is not null),
    n as (select rec_no, s, nullif(regexp_extract(s, '^\\s*(>=|<=|>|<|≥|≤|~)', 1), '') op, {_N1} f, try_cast(regexp_extract(s, '(\\d*\\.?\\d+)\\s*-\\s*(\\d*\\.?\\d+)', 1) as double) a, try_cast(regexp_extract(s, '(\\d*\\.?\\d+)\\s*-\\s*(\\d*\\.?\\d+)', 2) as double) b from r),
    m as (select *, coalesce(a is not null and not contains(s, '±') and f is not null, false) rg from n), q as (select *, rg and b >= a and (a <= 0 or b / a <= 1000) ok from m)
    select rec_no, case when f is null then null when not rg then f when ok then (a + b) / 2 end central, op, rg is_range, case when ok then a end lo, case when ok then b end hi from q""",
)
def _parse(t):
    return t("curated_records").filter("value_raw is not null").select("rec_no", numeric.parse_value(F.col("value_raw")).alias("v")).select("rec_no", "v.*")


@query("plausibility", "select case when value_std <= 0 then 'not positive' when value_std > 1e9 then 'above 1 M' when value_std < 1e-4 then 'below 0.1 pM' when value_std > 1e6 then 'weak' end note, count(*) n from curated_records where unit_std = 'nM' and value_std is not null group by 1")
def _plausible(t):
    rows = t("curated_records").filter("unit_std = 'nM' and value_std is not null")
    return rows.groupBy(numeric.plausibility(F.col("value_std"), F.lit("conc")).alias("note")).agg(F.count("*").alias("n"))


@query("number_norm", r"select row_id, case when regexp_full_match(replace(trim(target_value), ',', '.'), '-?\d+(\.\d+)?') then regexp_replace(replace(trim(target_value), ',', '.'), '\.0+$', '') else target_value end v from assay_rows")
def _number(t):
    return t("assay_rows").select("row_id", numeric.number_norm(F.col("target_value")).alias("v"))


@query(
    "categories",
    f"select rec_no, {_case(text.ASSAY_RULES, 'null', 'lower(trim(assay_type_raw))')} assay, {_case(text.ORGANISM_RULES, 'null', 'lower(trim(organism_raw))')} organism from curated_records where assay_type_raw is not null or organism_raw is not null",
)
def _categories(t):
    return t("curated_records").filter("assay_type_raw is not null or organism_raw is not null").select("rec_no", text.assay_type(F.col("assay_type_raw")).alias("assay"), text.organism_rule(F.col("organism_raw")).alias("organism"))


_CLEAN = "trim(regexp_replace(replace(trim(target_value), ',', '.'), '^[<>=~≤≥≈]+', ''))"
_PDF = "case when ends_with(lower(pdf), '.pdf') then substr(lower(pdf), 1, length(pdf) - 4) else lower(pdf) end"


@query(
    "prediction_fields",
    rf"""select row_id, trim(trim(trim(compound_id), '*'), '()') cid, case when lower(trim(target_type)) = 'pmic' then 'pMIC' when contains(lower(target_type), 'mic') then 'MIC' else nullif(trim(target_type), '') end kind,
    case when regexp_matches(coalesce(target_relation, ''), '[>≥]') then '>' when regexp_matches(coalesce(target_relation, ''), '[<≤]') then '<' when regexp_matches(coalesce(target_value, ''), '[>≥]') then '>' when regexp_matches(coalesce(target_value, ''), '[<≤]') then '<' else '=' end relation,
    {_PDF} pdf, case when regexp_full_match({_CLEAN}, '[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?') then printf('%g', cast({_CLEAN} as double)) else nullif({_CLEAN}, '') end v from assay_rows""",
)
def _fields(t):
    cols = [text.compound_key(F.col("compound_id")).alias("cid"), text.target_type(F.col("target_type")).alias("kind"), text.relation_of(F.col("target_relation"), F.col("target_value")).alias("relation")]
    return t("assay_rows").select("row_id", *cols, text.pdf_name(F.col("pdf")).alias("pdf"), numeric.clean_value(F.col("target_value")).alias("v"))


_COLLECTIONS = r"(?i)\b(ATCC|ATTC|NCTC|NCIMB|DSM|MTCC|KCTC|CCM|CIP|NRRL|MRSA|VRE|H37Rv|PAO1|O157)\b"


@query(
    "strain_split",
    rf"""select rec_no, case when f <> '' and trim(substr(o, 1, length(o) - length(f)), ' ,;') <> '' then trim(substr(o, 1, length(o) - length(f)), ' ,;') else o end organism, nullif(f, '') strain
    from (select rec_no, o, coalesce(regexp_extract(o, '{_COLLECTIONS}(?s:.*)'), '') f from (select rec_no, nullif(regexp_replace(organism_raw, '^\s+|\s+$', '', 'g'), '') o from curated_records where organism_raw is not null))""",
)
def _strains(t):
    organism, strain = text.split_strain(F.col("organism_raw"))
    return t("curated_records").filter("organism_raw is not null").select("rec_no", organism.alias("organism"), strain.alias("strain"))


def _relevance_sql(column: str) -> str:
    return "case " + " ".join(f"when list_bool_or([contains(lower({column}), k) for k in [{', '.join(repr(w) for w in words)}]]) then '{kind}'" for kind, words in retrieve.RELEVANCE) + " end"


@query("caption_class", f"select kind, count(*) n from (select {_relevance_sql('title')} kind from papers) group by 1")
def _relevance(t):
    return t("papers").groupBy(retrieve.data_relevance(F.col("title")).alias("kind")).agg(F.count("*").alias("n"))


_HEAD = r"regexp_extract(property, '^(.*?)\s*[(\[]([^()\[\]]*)[)\]]\s*$', {0})"
_COMMA = r"regexp_extract(property, '^(.*),\s*([^,]+)$', {0})"


@query(
    "header_units",
    f"""select property, trim(case when {_HEAD.format(2)} <> '' then {_HEAD.format(1)} when {_COMMA.format(2)} <> '' then {_COMMA.format(1)} else property end) name, trim(case when {_HEAD.format(2)} <> '' then {_HEAD.format(2)} when {_COMMA.format(2)} <> '' then {_COMMA.format(2)} else '' end) unit, count(*) n
    from curated_records where property is not null group by 1, 2, 3""",
)
def _headers(t):
    name, unit = text.split_property_unit(F.col("property"))
    return t("curated_records").filter("property is not null").groupBy("property", name.alias("name"), unit.alias("unit")).agg(F.count("*").alias("n"))


# ---- extraction --------------------------------------------------------------------------------------------------------
@query(
    "focus_lines",
    r"""with l as (select doc_id, unnest(string_split(text, chr(10))) line, generate_subscripts(string_split(text, chr(10)), 1) - 1 pos from documents where text is not null),
    w as (select doc_id, pos, max(regexp_matches(line, 'magnet|solvent')::int) over (partition by doc_id order by pos rows between 2 preceding and 2 following) near from l), k as (select doc_id, pos from w where near = 1)
    select doc_id, pos::bigint pos, case when pos - lag(pos, 1, -2) over (partition by doc_id order by pos) > 1 then 1 else 0 end gap from k""",
)
def _focus(t):
    return extract.focus_lines(t("documents").filter("text is not null"), "doc_id", "text", "magnet|solvent", 2, 2)


@query("inverted_index", "select paper_row, word, count(*) n, min(pos)::bigint first_pos from (select paper_row, unnest(string_split(title, ' ')) word, generate_subscripts(string_split(title, ' '), 1) - 1 pos from papers where title is not null) where word <> '' group by 1, 2")
def _inverted(t):
    index = extract.inverted_index(t("papers").filter("title is not null").select("paper_row", "title"), "paper_row", "title")
    return index.select("paper_row", "word", F.size("positions").cast("long").alias("n"), F.element_at("positions", 1).cast("long").alias("first_pos"))


@query("markdown_unpivot", "select p_partkey, 0 as row, h header, v as value from (select p_partkey, unnest(['brand', 'size']) h, unnest([p_brand, p_size::varchar]) v from part)")
def _markdown(t):
    made = t("part").select("p_partkey", F.concat(F.lit("| brand | size |\n|---|---|\n| "), "p_brand", F.lit(" | "), F.col("p_size").cast("string"), F.lit(" |")).alias("md"))
    return extract.markdown_cells(made, "p_partkey", "md")


@query("html_fields", "select paper_row, pdf_url url from papers where pdf_url <> '' and not contains(pdf_url, '\"')")
def _html(t):
    pages = t("papers").filter("pdf_url <> '' and not contains(pdf_url, '\"')").select("paper_row", F.concat(F.lit('<html><head><meta name="citation_title" content="x"><meta name="citation_pdf_url" content="'), "pdf_url", F.lit('"></head></html>')).alias("html"))
    return pages.select("paper_row", text.citation_pdf_url(F.col("html")).alias("url")).filter("url is not null")


@query("table_measures", "select p_partkey, 0 as row, p_name compound, 'IC50' property, 'conc' family, 'nM' unit, p_size::varchar v from part where trim(p_name) not in ('', '-', '—', 'n/a', 'NA') union all select p_partkey, 0, p_name, 'yield', 'pct', '%', p_retailprice::decimal(12, 2)::varchar from part")
def _tables(t):
    md = F.concat(F.lit("| No | Compound | brand | IC50 (nM) | Yield, % |\n|---|---|---|---|---|\n| 1 | "), "p_name", F.lit(" | "), "p_brand", F.lit(" | "), F.col("p_size").cast("string"), F.lit(" | "), F.col("p_retailprice").cast("decimal(12,2)").cast("string"), F.lit(" |\n| 2 | - | x | 5 | 6 |"))
    return extract.table_measures(t("part").select("p_partkey", md.alias("md")), "p_partkey", "md").select("p_partkey", "row", "compound", "property", "family", "unit", F.col("value").alias("v"))


def _xml(column: str):
    out = F.regexp_replace(F.coalesce(column, F.lit("")), r"[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]", "")
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(sign), F.lit(entity))
    return out


_SQUEEZED = r"trim(regexp_replace({0}, '[\s\p{{Z}}]+', ' ', 'g'))"
_ASCII = "title is not null and regexp_full_match(title, '[ -~]*')"


@query("jats_fields", f"select paper_row, '## ' || {_SQUEEZED.format('title')} || chr(10) || chr(10) || 'Body of ' || {_SQUEEZED.format('title')} body, 'Fig. 1 ' || {_SQUEEZED.format('title')} caption from papers where {_ASCII} and trim(title) <> ''")
def _jats(t):
    rows = t("papers").filter("title is not null and title rlike '^[ -~]*$' and trim(title) <> ''")
    x = _xml("title")
    doc = F.concat(F.lit("<article><body><sec><title>"), x, F.lit("</title><p>Body of <italic>"), x, F.lit("</italic></p><fig><label>Fig. 1</label><caption><p>"), x, F.lit("</p></caption></fig></sec></body></article>"))
    got = rows.select("paper_row", fulltext.jats(doc).alias("j"))
    return got.select("paper_row", F.col("j.text").alias("body"), F.get("j.figures", F.lit(0))["text"].alias("caption"))


@query("html_blocks", f"select paper_row, '## ' || {_SQUEEZED.format('title')} || chr(10) || chr(10) || 'See ' || {_SQUEEZED.format('title')} body, 'source | ' || source tbl from papers where {_ASCII} and trim(title) <> '' and source is not null")
def _html_blocks(t):
    x = _xml("title")
    rows = t("papers").filter("title is not null and title rlike '^[ -~]*$' and trim(title) <> '' and source is not null")
    page = F.concat(F.lit("<html><body><nav>menu</nav><h1>"), x, F.lit("</h1><p>See <b>"), x, F.lit("</b></p><table><tr><td></td></tr><tr><th>source</th><td>"), "source", F.lit("</td></tr></table></body></html>"))
    got = rows.select("paper_row", fulltext.html(page).alias("h"))
    return got.select("paper_row", F.col("h.text").alias("body"), F.get("h.tables", F.lit(0))["text"].alias("tbl"))


@query("tei_refs", "select pdf, count(distinct k)::int n_refs, min(k) least from (select pdf, regexp_extract(doi, '10\\.\\d{4,9}/[^\\s\"<>]+') k from assay_rows where pdf is not null) where k <> '' and not ends_with(k, '.') and not ends_with(k, ')') group by 1")
def _tei(t):
    dois = t("assay_rows").filter("pdf is not null").select("pdf", F.regexp_extract("doi", r'10\.\d{4,9}/[^\s"<>]+', 0).alias("k")).filter("k <> '' and not endswith(k, '.') and not endswith(k, ')')")
    entries = F.concat_ws("", F.collect_list(F.concat(F.lit('<biblStruct><idno type="doi">'), _xml("k"), F.lit("</idno></biblStruct>"))))
    # a paper's rows repeat few DOIs; distinct ones make its document, so its size is bounded by them
    doc = dois.distinct().groupBy("pdf").agg(F.concat(F.lit('<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><body/><back>'), entries, F.lit("</back></text></TEI>")).alias("doc"))
    refs = doc.select("pdf", fulltext.tei(F.col("doc"))["references"].alias("r"))
    return refs.select("pdf", F.size("r").alias("n_refs"), F.array_min("r").alias("least"))


@query("connector_map", "select paper_row, source, doi, title, coalesce(year, 0) y, coalesce(citation_count, 0) cites from papers where source in ('openalex', 'semantic_scholar', 'core') and title is not null and title <> '' and coalesce(doi, '') not like '%https://doi.org/%' and coalesce(doi, 'x') <> ''")
def _connectors(t):
    rows = t("papers").filter("source in ('openalex', 'semantic_scholar', 'core') and title is not null and title <> '' and coalesce(doi, '') not like '%https://doi.org/%' and coalesce(doi, 'x') <> ''")
    openalex = F.to_json(F.struct(F.col("doi"), F.col("title"), F.col("year").alias("publication_year"), F.col("citation_count").alias("cited_by_count")))
    scholar = F.to_json(F.struct(F.struct(F.col("doi").alias("DOI")).alias("externalIds"), F.col("title"), F.col("year"), F.col("citation_count").alias("citationCount")))
    core = F.to_json(F.struct(F.col("doi"), F.col("title"), F.col("year").alias("yearPublished"), F.col("citation_count").alias("citationCount")))
    answers = rows.select("paper_row", "source", F.when(F.col("source") == "openalex", openalex).when(F.col("source") == "core", core).otherwise(scholar).alias("payload"))
    return connectors.map_payloads(answers).select("paper_row", "source", "doi", "title", F.coalesce("year", F.lit(0)).alias("y"), F.col("citation_count").alias("cites"))


@query("chunk_overlap")
def _chunks(t):
    return extract.chunk_texts(t("documents").filter("text is not null"), "doc_id", "text")


@query("text_measures")
def _measures(t):
    return extract.measures_in_text(t("papers").filter("abstract is not null"), "paper_row", "abstract")


# ---- routing and manifests ---------------------------------------------------------------------------------------------
_HITS = f"len(regexp_extract_all(text, '{routing.SYSTEMATIC}'))"
_PAGE = "case when length(text) / greatest(coalesce(n_pages, 1), 1) < 100 then 'scanned' else 'digital' end"


@query("standardised")
def _standardised(t):
    raw = t("curated_records")
    cols = ["rec_no", "property", "value_std", "unit_std", "conversion_note", "value_op", "value_min", "value_max", "assay_type_std", "organism_std", "review_reason"]
    return standardise.standardise_records(raw).select(*cols)


@query("standardised_issues")
def _standardised_issues(t):
    return curate.issue_counts(standardise.standardise_records(t("curated_records")))


_SQ = "trim(regexp_replace({0}, '[\\s\\p{{Z}}]+', ' ', 'g'))"
_FILL = "case when {0} is null or {0} in ('', 'nan', 'None') then 'NOT_DETECTED' else {0} end"
_NUM = r"case when regexp_full_match(replace(trim(target_value), ',', '.'), '-?\d+(\.\d+)?') then regexp_replace(replace(trim(target_value), ',', '.'), '\.0+$', '') else target_value end"


@query(
    "assembled",
    rf"""with r as (select pdf, row_id, trim(trim(trim(compound_id), '*'), '()') cid, nullif(smiles, 'NOT_DETECTED') smiles, {', '.join(f"{_SQ.format(_NUM if c == 'target_value' else c)} {c}" for c in standardise.FIELDS)} from assay_rows),
    k as (select pdf, cid, min(smiles) g from r where smiles is not null group by 1, 2), l as (select r.*, g from r left join k using (pdf, cid)), u as (select *, row_number() over (partition by pdf order by row_id) - 1 j from l where g is null),
    p as (select pdf, smiles, row_number() over (partition by pdf order by smiles) - 1 slot, count(*) over (partition by pdf) n from (select distinct pdf, smiles from r where smiles is not null)),
    f as (select u.row_id, p.smiles from u join p on u.pdf = p.pdf and u.j % p.n = p.slot)
    select distinct l.pdf, {_FILL.format('cid')} compound_id, coalesce(g, f.smiles, 'NOT_DETECTED') smiles, {', '.join(f"{_FILL.format(c)} {c}" for c in standardise.FIELDS)} from l left join f using (row_id)""",
)
def _assembled(t):
    rows = t("assay_rows").withColumn("smiles", F.nullif("smiles", F.lit("NOT_DETECTED")))
    return standardise.assemble(rows.select("pdf", "row_id", "compound_id", *standardise.FIELDS), rows.select("pdf", "compound_id", "smiles"), rows.select("pdf", "smiles"))


@query("source_precedence", "select doi, arg_min(source, coalesce(list_position(['crossref', 'pubmed', 'europepmc', 'openalex'], source), 99)::bigint * 1000000000 + paper_row) source from papers where doi is not null and title <> '' group by 1")
def _precedence(t):
    # one value per source, the earliest row's
    rows = t("papers").filter("doi is not null and title <> '' and source is not null").groupBy("doi", "source").agg(F.min("paper_row").alias("paper_row"))
    padded = rows.withColumn("at", F.lpad(F.col("paper_row").cast("string"), 12, "0"))
    known = ("crossref", "pubmed", "europepmc", "openalex")
    named = padded.withColumn("rank_source", F.when(F.col("source").isin(*known), F.col("source")).otherwise(F.lit("other")))
    best = standardise.source_precedence(named.groupBy("doi", "rank_source").agg(F.min("at").alias("at")), ["doi"], "rank_source", "at", known)
    return best.join(padded.select("doi", "at", "source"), ["doi", "at"]).select("doi", "source")


@query("open_rows", "select pdf, doi from manifest where coalesce(lower(trim(access)) in ('1', '1.0', 'true', 'yes', 'y', 'open', 'oa', 'gold', 'green', 'hybrid', 'bronze'), false)")
def _open(t):
    return pools.open_rows(t("manifest")).select("pdf", "doi")


@query("name_candidates")
def _candidates(t):
    rows = t("curated_records").filter("name_raw is not null").select("rec_no", identity.name_candidates(F.col("name_raw")).alias("c"))
    return rows.select("rec_no", F.posexplode("c")).select("rec_no", F.col("pos").cast("long").alias("pos"), F.col("col").alias("candidate"))


@query("structural_captions", f"select paper_row from papers where title is not null and list_bool_or([contains(lower(title), k) for k in [{', '.join(repr(k) for k in identity.STRUCTURAL)}]])")
def _structural(t):
    return t("papers").filter(F.col("title").isNotNull() & identity.is_structural(F.col("title"))).select("paper_row")


_STRIPPED = r"regexp_replace(doi, '^\s+|\s+$', '', 'g')"


@query("graph_ids", rf"""select paper_row, case when {_STRIPPED} = '' then '' else 'https://doi.org/' || {_STRIPPED} end url, case when regexp_matches({_STRIPPED}, '(?i)^(doi|arxiv|pmid|corpusid|mag):') then {_STRIPPED} when contains({_STRIPPED}, '/') and not starts_with({_STRIPPED}, 'http') then 'DOI:' || {_STRIPPED} else {_STRIPPED} end sid from papers where doi is not null""")
def _graph_ids(t):
    return t("papers").filter("doi is not null").select("paper_row", identity.doi_url(F.col("doi")).alias("url"), identity.graph_id(F.col("doi")).alias("sid"))


@query("scheme_ids", "select rec_no, coalesce('inchikey:' || lower(nullif(inchikey, '')), 'smiles:' || lower(nullif(smiles_canonical, '')), 'pubchem_cid:' || lower(nullif(pubchem_cid, '')), 'cas:' || lower(nullif(cas, '')), lower(regexp_replace(coalesce(name_std, ''), '^\\s+|\\s+$', '', 'g'))) eid from curated_records")
def _schemes(t):
    ids = {"cas": F.col("cas"), "inchikey": F.col("inchikey"), "smiles": F.col("smiles_canonical"), "pubchem_cid": F.col("pubchem_cid")}
    return t("curated_records").select("rec_no", identity.scheme_id(ids, F.col("name_std")).alias("eid"))


@query("ordered_union", """with e as (select pdf, smiles, 0 s, row_id o from assay_rows where bacteria_unified is not null and smiles <> 'NOT_DETECTED' and smiles <> '' union all select pdf, smiles, 1, row_id from assay_rows where smiles <> 'NOT_DETECTED' and smiles <> '')
    select pdf, smiles, min(s)::int source, arg_min(o, s * 1000000000000::bigint + o) row_id from e group by 1, 2""")
def _ordered(t):
    rows = t("assay_rows").filter("smiles <> 'NOT_DETECTED'")
    return pools.ordered_union([rows.filter("bacteria_unified is not null"), rows], ["pdf"], "smiles", "row_id")


@query("table_scores", f"""with c as (select pdf, page_target, trim(coalesce(x, '')) x from (select pdf, page_target, unnest([target_value, bacteria]) x from assay_rows where pdf is not null and page_target is not null)),
    s as (select pdf, page_target, sum(case when x in ({', '.join(repr(p) for p in pools.POWERS)}) then 1.0 else 0 end + case when x[1] in ('>', '<', '≥', '≤') then 1.5 else 0 end + 2.0 * len(regexp_extract_all(x, '{pools.ORGANISMS}')))::double score from c group by 1, 2)
    select pdf, page_target, score, rank from (select *, row_number() over (partition by pdf order by score desc, page_target)::int rank from s where score >= 3) where rank <= 6""")
def _table_scores(t):
    cells = t("assay_rows").filter("pdf is not null and page_target is not null").select("pdf", "page_target", F.explode(F.array("target_value", "bacteria")).alias("x"))
    return pools.best_tables(pools.table_scores(cells, ["pdf", "page_target"], "x"), "pdf", "page_target").select("pdf", "page_target", "score", "rank")


@query("per_level", "select c_custkey, c_mktsegment from (select *, row_number() over (partition by c_mktsegment order by c_custkey) r from customer) where r <= 5")
def _per_level(t):
    return pools.per_level(t("customer"), "c_mktsegment", "c_custkey", 5).select("c_custkey", "c_mktsegment")


@query("manual_downloads", "select o_orderkey, min(reason) reason from (select o_orderkey, 'download failed' reason from orders where o_orderstatus = 'F' union all select o_orderkey, 'file bad' from orders where o_orderpriority = '1-URGENT') group by 1")
def _manual(t):
    orders = t("orders")
    done = orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "failed").otherwise("ok").alias("status"))
    checked = orders.select("o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT", "bad").otherwise("ok").alias("status"))
    return pools.manual_downloads(done, checked, "o_orderkey")


@query("backfill", "select r.row_id, coalesce(r.title, m.title) title from assay_rows r left join (select pdf, min(title) title from manifest where pdf is not null group by 1) m using (pdf)")
def _backfill(t):
    return pools.backfill(t("assay_rows").select("row_id", "pdf", "title"), t("manifest").select("pdf", "title"), ["pdf"], ["title"]).select("row_id", "title")


@query("strategy_route", f"select doc_id, {_PAGE} kind, case when {_HITS} >= 15 then case when {_PAGE} = 'scanned' then 'reingest' else 'names' end else 'images' end strategy from documents where text is not null")
def _strategy(t):
    kind = routing.page_class(F.length("text"), F.coalesce("n_pages", F.lit(1)))
    return t("documents").filter("text is not null").select("doc_id", kind.alias("kind"), routing.strategy(F.col("text"), kind).alias("strategy"))


@query(
    "engine_reconcile",
    """with r as (select pdf || '|' || coalesce(payload ->> '$.compound_id', '') || '|' || coalesce(payload ->> '$.target_type', '') item, engine, payload ->> '$.target_value' v from llm_rows),
    e as (select item, engine, min(nullif(v, '')) v from r where item is not null group by 1, 2), b as (select item, count(v) n, count(distinct v) k, arg_min(v, coalesce(engine, '')) filter (v is not null) fv from e group by 1)
    select item, case when k = 0 then 'failed' when k > 1 then 'disagree' when n > 1 then 'ok' else 'review' end status, fv v, case when k = 0 then 0.0 when k > 1 then 0.3 when n > 1 then 0.95 else 0.6 end::double confidence from b""",
)
def _reconcile(t):
    p = _predictions(t)
    item = F.concat_ws("|", "pdf", F.coalesce("compound_id", F.lit("")), F.coalesce("target_type", F.lit("")))
    readings = t("llm_rows").select("raw_id", "engine").join(p, "raw_id").filter("pdf is not null").select(item.alias("item"), F.coalesce("engine", F.lit("")).alias("engine"), F.col("target_value").alias("v"))
    return routing.reconcile(readings, "item", "engine", "v").select("item", "status", "v", "confidence")


@query("manifest_summary", "select count(*) n_rows, count(*) filter (coalesce(lower(trim(access)) in ('1', '1.0', 'true', 'yes', 'y', 'open', 'oa', 'gold', 'green', 'hybrid', 'bronze'), false)) oa_rows, count(distinct pdf) n_pdf, count(distinct doi) n_doi from assay_rows")
def _summary(t):
    return t("assay_rows").agg(F.count("*").alias("n_rows"), F.count_if(text.is_open(F.col("access"))).alias("oa_rows"), F.count_distinct("pdf").alias("n_pdf"), F.count_distinct("doi").alias("n_doi"))


@query("pair_index", "select pdf, arg_min(doi, row_id) filter (doi is not null) doi, count(*) n_rows, count(distinct compound_id) compounds from assay_rows where pdf is not null group by 1")
def _pairs(t):
    return t("assay_rows").filter("pdf is not null").groupBy("pdf").agg(order.first_by(F.col("doi"), F.col("row_id")).alias("doi"), F.count("*").alias("n_rows"), F.count_distinct("compound_id").alias("compounds"))


@query("manifest_unique", "select pdf, doi, title, year from (select *, row_number() over (partition by pdf, doi order by title nulls last, year nulls last) r from manifest) where r = 1")
def _unique(t):
    m = t("manifest")
    key = F.struct(F.col("title").isNull().alias("a"), "title", F.col("year").isNull().alias("b"), "year")
    return m.groupBy("pdf", "doi").agg(F.min(key).alias("k")).select("pdf", "doi", "k.title", "k.year")


@query("status_pivot", "select o_orderpriority, count(*) filter (o_orderstatus = 'F') f, count(*) filter (o_orderstatus = 'O') o, count(*) filter (o_orderstatus = 'P') p from orders group by 1")
def _pivot(t):
    out = t("orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count().fillna(0)
    return out.select("o_orderpriority", F.col("F").alias("f"), F.col("O").alias("o"), F.col("P").alias("p"))


# ---- extension: event windows (batch twin of the stream) ---------------------------------------------------------------
@query("event_windows", "select strftime(time_bucket(interval '1 hour', ts), '%Y-%m-%d %H:%M:%S') window_start, event_type, count(*) n from events group by 1, 2")
def _windows(t):
    return windows.tumbling(t("events")).select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n")
