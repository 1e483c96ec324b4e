"""Recorded answers of literature services mapped to one shape of paper, by declared schemas and SQL expressions inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of a mapped paper.
COLUMNS = {
    "doi": "string", "title": "string", "authors": "array<string>", "year": "int", "journal": "string", "abstract": "string", "citation_count": "int", "is_open_access": "boolean",
    "pdf_url": "string", "openalex_id": "string", "pmid": "string", "pmcid": "string", "arxiv_id": "string", "semantic_scholar_id": "string",
}
#: Authors that are kept, as the services' lists may be of any length.
AUTHORS = 10
_NAMES = f"filter(slice(transform(coalesce({{0}}, array()), a -> {{1}}), 1, {AUTHORS}), n -> n <> '')"
_SUMMARY_NAMES = _NAMES.format("split(get(split(p.publication_info.summary, ' - '), 0), ',')", "trim(replace(a, '…', ''))")
_YEAR = "try_cast(regexp_extract({0}, '^([0-9]{{4}})', 1) as int)"
_TEXT = "nullif(trim(xpath_string({0}, '//*[local-name()=\"{1}\"]')), '')"


def inverted_text(index: str) -> str:
    """SQL: the text of a map from words to their positions; of words at one position the later in order wins."""
    pairs = f"flatten(transform(map_entries({index}), e -> transform(e.value, p -> struct(p as at, e.key as word))))"
    kept = f"array_sort(map_values(aggregate(array_sort({pairs}), cast(map() as map<int, struct<at: int, word: string>>), (m, x) -> map_concat(map_filter(m, (k, v) -> k <> x.at), map(x.at, x)))))"
    return f"nullif(array_join(transform({kept}, x -> x.word), ' '), '')"


# Where each service states a field. `p` is the parsed payload, `raw` the text of an XML one; fields not named are null.
_SERVICES: dict[str, tuple[str | None, dict[str, str]]] = {
    "openalex": (
        "id string, doi string, title string, publication_year int, authorships array<struct<author: struct<display_name: string>>>, abstract_inverted_index map<string, array<int>>, open_access struct<is_oa: boolean, oa_url: string>, primary_location struct<source: struct<display_name: string>>, cited_by_count int",
        {
            "doi": "nullif(replace(p.doi, 'https://doi.org/', ''), '')", "openalex_id": "replace(coalesce(p.id, ''), 'https://openalex.org/', '')", "title": "p.title", "authors": _NAMES.format("p.authorships", "a.author.display_name"),
            "year": "p.publication_year", "journal": "p.primary_location.source.display_name", "abstract": inverted_text("p.abstract_inverted_index"), "citation_count": "coalesce(p.cited_by_count, 0)",
            "is_open_access": "coalesce(p.open_access.is_oa, false)", "pdf_url": "if(p.open_access.is_oa, p.open_access.oa_url, null)",
        },
    ),
    "semantic_scholar": (
        "paperId string, externalIds struct<DOI: string, PubMed: string, ArXiv: string>, title string, authors array<struct<name: string>>, year int, venue string, abstract string, citationCount int, isOpenAccess boolean, openAccessPdf struct<url: string>",
        {
            "semantic_scholar_id": "p.paperId", "doi": "p.externalIds.DOI", "pmid": "p.externalIds.PubMed", "arxiv_id": "p.externalIds.ArXiv", "title": "p.title", "authors": _NAMES.format("p.authors", "a.name"), "year": "p.year",
            "journal": "p.venue", "abstract": "p.abstract", "citation_count": "coalesce(p.citationCount, 0)", "is_open_access": "coalesce(p.isOpenAccess, false)", "pdf_url": "p.openAccessPdf.url",
        },
    ),
    "europepmc": (
        "doi string, pmid string, pmcid string, title string, authorList struct<author: array<struct<fullName: string, firstName: string, lastName: string>>>, pubYear string, journalTitle string, abstractText string, citedByCount int, isOpenAccess string",
        {
            "doi": "p.doi", "pmid": "p.pmid", "pmcid": "p.pmcid", "title": "p.title", "authors": _NAMES.format("p.authorList.author", "coalesce(nullif(a.fullName, ''), trim(concat_ws(' ', a.firstName, a.lastName)))"),
            "year": "try_cast(p.pubYear as int)", "journal": "p.journalTitle", "abstract": "p.abstractText", "citation_count": "coalesce(p.citedByCount, 0)", "is_open_access": "p.isOpenAccess <=> 'Y'",
        },
    ),
    "crossref": (
        "DOI string, title array<string>, author array<struct<given: string, family: string>>, issued struct<`date-parts`: array<array<int>>>, `container-title` array<string>, abstract string, `is-referenced-by-count` int",
        {
            "doi": "p.DOI", "title": "get(p.title, 0)", "authors": _NAMES.format("p.author", "concat_ws(' ', nullif(a.given, ''), nullif(a.family, ''))"), "year": "get(get(p.issued.`date-parts`, 0), 0)",
            "journal": "get(p.`container-title`, 0)", "abstract": "trim(regexp_replace(p.abstract, '<[^>]+>', ''))", "citation_count": "coalesce(p.`is-referenced-by-count`, 0)", "is_open_access": "false",
        },
    ),
    "pubmed": (
        "uid string, title string, authors array<struct<name: string>>, pubdate string, source string, articleids array<struct<idtype: string, value: string>>",
        {
            "pmid": "p.uid", "doi": "element_at(filter(coalesce(p.articleids, array()), i -> i.idtype = 'doi').value, -1)", "title": "p.title", "authors": _NAMES.format("p.authors", "a.name"), "year": _YEAR.format("p.pubdate"),
            "journal": "p.source", "is_open_access": "false",
        },
    ),
    "core": (
        "doi string, title string, authors array<struct<name: string>>, yearPublished int, publisher string, abstract string, citationCount int, downloadUrl string",
        {
            "doi": "p.doi", "title": "p.title", "authors": _NAMES.format("p.authors", "a.name"), "year": "p.yearPublished", "journal": "p.publisher", "abstract": "p.abstract", "citation_count": "coalesce(p.citationCount, 0)",
            "is_open_access": "true", "pdf_url": "p.downloadUrl",
        },
    ),
    "google_scholar": (
        "title string, snippet string, publication_info struct<summary: string, authors: array<struct<name: string>>>, resources array<struct<file_format: string, link: string>>, inline_links struct<cited_by: struct<total: int>>",
        {
            "title": "p.title", "abstract": "p.snippet", "citation_count": "coalesce(p.inline_links.cited_by.total, 0)",
            "authors": f"if(size(coalesce(p.publication_info.authors, array())) > 0, {_NAMES.format('p.publication_info.authors', 'a.name')}, {_SUMMARY_NAMES})",
            "year": "try_cast(nullif(regexp_extract(p.publication_info.summary, '((?:19|20)[0-9]{2})', 1), '') as int)",
            "journal": "nullif(trim(regexp_replace(get(split(p.publication_info.summary, ' - '), 1), ',?\\\\s*(?:19|20)[0-9]{2}.*$', '')), '')",
            "pdf_url": "get(filter(coalesce(p.resources, array()), r -> upper(r.file_format) = 'PDF' or lower(r.link) like '%.pdf').link, 0)",
            "is_open_access": "exists(coalesce(p.resources, array()), r -> upper(r.file_format) = 'PDF' or lower(r.link) like '%.pdf')",
        },
    ),
    "google_patents": (
        "title string, snippet string, inventor string, assignee string, publication_number string, publication_date string, grant_date string, filing_date string, priority_date string, pdf string",
        {
            "title": "p.title", "abstract": "p.snippet", "authors": _NAMES.format("split(p.inventor, ',')", "trim(a)"),
            "year": "coalesce(" + ", ".join(_YEAR.format(f"p.{d}_date") for d in ("publication", "grant", "filing", "priority")) + ")",
            "journal": "coalesce(nullif(concat_ws(' · ', nullif(concat('Patent ', trim(coalesce(p.publication_number, ''))), 'Patent '), nullif(p.assignee, '')), ''), 'Patent')", "citation_count": "0", "is_open_access": "true", "pdf_url": "p.pdf",
        },
    ),
    "arxiv": (
        None,
        {
            "arxiv_id": "regexp_extract(" + _TEXT.format("raw", "id") + ", '([^/]+)$', 1)", "doi": _TEXT.format("raw", "doi"), "title": "replace(" + _TEXT.format("raw", "title") + ", '\\n', ' ')", "abstract": "trim(replace(" + _TEXT.format("raw", "summary") + ", '\\n', ' '))",
            "authors": _NAMES.format("xpath(raw, '//*[local-name()=\"author\"]/*[local-name()=\"name\"]/text()')", "trim(a)"), "year": _YEAR.format(_TEXT.format("raw", "published")), "journal": "'arXiv'", "is_open_access": "true",
            "pdf_url": "coalesce(nullif(xpath_string(raw, '//*[local-name()=\"link\"][@title=\"pdf\" or @type=\"application/pdf\"]/@href'), ''), 'https://arxiv.org/pdf/' || regexp_extract(" + _TEXT.format("raw", "id") + ", '([^/]+)$', 1))",
        },
    ),
}
#: Services with a mapping, and whether they need a key.
REGISTRY = {name: name in ("core", "google_scholar", "google_patents") for name in _SERVICES}


def source_status(keys: set[str] = frozenset()) -> list[tuple[str, bool]]:
    """(service, ready): whether a service can be asked with the keys that are there."""
    return [(name, not needs or name in keys) for name, needs in REGISTRY.items()]


def map_payloads(answers: DataFrame, source: str = "source", payload: str = "payload") -> DataFrame:
    """Adds the columns of `COLUMNS` to recorded answers, one paper a row; payloads of unknown services or that do not parse give nulls
    and the title "Untitled".

    One scan: a payload is parsed by the schema of its own service only. Other columns pass through, except those named like a column of a paper.
    """
    keep = [c for c in answers.columns if c not in COLUMNS and c != payload]
    out = answers.select(*keep, F.col(payload).alias("raw"))
    out = out.select("*", *[F.when(F.col(source) == s, F.from_json("raw", schema)).alias(f"p_{s}") for s, (schema, _) in _SERVICES.items() if schema])
    columns = []
    for c, t in COLUMNS.items():
        chain = None
        for s, (schema, fields) in _SERVICES.items():
            if c in fields:
                value = F.expr(f"cast({re.sub(r'\bp\.', f'p_{s}.', fields[c]) if schema else fields[c]} as {t})")
                known = (F.col(source) == s) & (F.col(f"p_{s}").isNotNull() if schema else F.col("raw").startswith("<"))
                chain = F.when(known, value) if chain is None else chain.when(known, value)
        columns.append(F.coalesce(F.nullif(chain, F.lit("")), F.lit("Untitled")).alias(c) if c == "title" else chain.alias(c))
    return out.select(*keep, *columns)
