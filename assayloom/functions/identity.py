"""Identities and names: what makes two records one, and which texts may name a compound."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayloom.functions.text import strip

# Identifier schemes from the most telling on; stop words and labels that name no compound; captions of structures.
SCHEMES = ("inchikey", "inchi", "smiles", "pubchem_cid", "chembl", "uniprot", "pdb_id", "ensembl", "hgnc", "ncbi_gene", "cas", "taxon")
NAME_STOP = ("compound", "compd", "cmpd", "cpd", "entry", "table", "ligand", "analog", "analogue", "derivative", "control", "vehicle", "reference", "standard", "title", "scheme", "figure", "example", "inhibitor", "agonist", "antagonist")
LABEL = r"(?i)^(?:compound|cmpd|cpd|entry)?\s*\d{1,4}[a-z]?$|^[A-Za-z]\d{0,3}$"
STRUCTURAL = ("structure", "compound", "scheme", "synthesi", "molecul", "derivativ", "skeletal", "analog", "inhibitor", "scaffold", "reaction")
DOMAIN_ALIASES = {
    "benzymidazole": "benzimidazole", "benzimidazoles": "benzimidazole", "oxazolidinones": "oxazolidinone", "nanozyme": "nanozymes", "co-crystals": "cocrystals", "cocrystal": "cocrystals",
    "complex": "complexes", "magnetic": "nanomag", "nanomagnetic": "nanomag", "cytotoxicity": "cytotox", "sel-tox": "seltox", "eye-drops": "eyedrops",
}
DOMAINS = ("benzimidazole", "oxazolidinone", "cocrystals", "complexes", "nanozymes", "nanomag", "cytotox", "seltox", "synergy", "eyedrops", "all")


def norm(text: Column) -> Column:
    """Lower case without white space at the ends; null is empty."""
    return F.lower(strip(F.coalesce(text, F.lit(""))))


def scheme_id(identifiers: dict[str, Column], name: Column) -> Column:
    """`scheme:id` of the first scheme that has an identifier, in lower case; else the normalised name."""
    told = [F.when(F.coalesce(identifiers[s], F.lit("")) != "", F.concat(F.lit(f"{s}:"), F.lower(identifiers[s]))) for s in SCHEMES if s in identifiers]
    return F.coalesce(*told, norm(name))


def record_key(kind: Column, fields: dict[str, Column], value: Column, entity: Column) -> Column:
    """The identity of a record by its kind, as an array of texts (null where a part is missing).

    Entities go by type and `entity`, relations by subject, relation and object, claims by subject, predicate, object and polarity,
    methods by name and functional, everything else by metric (else `value`) and unit.
    """
    get = lambda n: fields.get(n, F.lit(None).cast("string"))
    of = lambda *parts: F.array(kind, *[p.cast("string") for p in parts])
    return (
        F.when(kind == "entity", of(F.coalesce(get("type"), F.lit("")), entity))
        .when(kind == "relation", of(norm(get("subject")), norm(get("relation")), norm(get("object"))))
        .when(kind == "claim", of(norm(get("subject")), norm(get("predicate")), norm(get("object")), get("polarity")))
        .when(kind == "method", of(norm(get("name")), norm(get("functional"))))
        .otherwise(of(norm(F.coalesce(F.nullif(get("metric"), F.lit("")), value)), get("unit")))
    )


def is_label(name: Column) -> Column:
    """Whether a text only labels a compound: two characters or fewer, or a number with at most a letter."""
    bare = strip(F.coalesce(name, F.lit("")))
    return (F.length(bare) <= 2) | bare.rlike(LABEL)


def name_candidates(name: Column) -> Column:
    """Texts under which a compound cell may be looked up, in order and once each.

    The cell itself, the name in its brackets, the cell without brackets, and what follows a leading code; labels, numbers and stop
    words are left out. Null and blank cells have none.
    """
    bare = strip(F.coalesce(name, F.lit("")))
    inside = F.regexp_extract(bare, r"\(([^)]{3,})\)", 1)
    without = strip(F.regexp_replace(bare, r"(?U)\s*\([^)]*\)", ""))
    behind = F.regexp_extract(bare, r"(?U)^[0-9]{1,4}[a-z]?[\s\-]+(.{3,})$", 1)
    tried = F.transform(F.array(bare, inside, without, behind), lambda x: F.btrim(x, F.lit(" ,;:")))
    good = lambda x: (F.length(x) >= 3) & ~is_label(x) & ~x.rlike(r"^\d+$") & ~F.lower(x).isin(*NAME_STOP)
    return F.filter(F.array_distinct(tried), good)


def is_structural(caption: Column) -> Column:
    """Whether a caption is of a figure that may show structures."""
    low = F.lower(F.coalesce(caption, F.lit("")))
    return F.exists(F.array(*map(F.lit, STRUCTURAL)), lambda w: F.contains(low, w))


def domain(name: Column) -> Column:
    """The short name of a domain given under any of its aliases; an unknown one is an error."""
    known = F.create_map(*[F.lit(x) for pair in DOMAIN_ALIASES.items() for x in pair])
    d = F.replace(norm(name), F.lit("_"), F.lit("-"))
    short = F.coalesce(F.try_element_at(known, d), d)
    return F.when(short.isin(*DOMAINS), short).otherwise(F.raise_error(F.concat(F.lit("unknown domain "), F.coalesce(name, F.lit("null")))))


def doi_url(doi: Column) -> Column:
    """The resolver address of a DOI, empty for an empty one."""
    bare = strip(doi)
    return F.when(bare == "", "").otherwise(F.concat(F.lit("https://doi.org/"), bare))


def graph_id(text: Column) -> Column:
    """A citation graph's paper id: prefixed ids stay, what looks like a DOI gets its prefix."""
    bare = strip(text)
    prefixed = bare.rlike("(?i)^(doi|arxiv|pmid|corpusid|mag):")
    return F.when(~prefixed & F.contains(bare, F.lit("/")) & ~bare.startswith("http"), F.concat(F.lit("DOI:"), bare)).otherwise(bare)
