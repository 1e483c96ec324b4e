"""Text expressions: keys, labels, categories and clean-up. Column in, Column out; null in, null out unless stated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of "open access", columns tried in order, keyword classes, assay and organism rules (order matters).
OPEN = ("1", "1.0", "true", "yes", "y", "open", "oa", "gold", "green", "hybrid", "bronze")
ACCESS_COLUMNS = ("access", "is_oa", "oa_status")
ASSAY_RULES = [
    ("inhibit", "inhibition"), ("ic50", "inhibition"), ("bind", "binding"), ("antagon", "antagonism"), ("agon", "agonism"), ("cytotox", "cytotoxicity"), ("viabilit", "cytotoxicity"),
    ("mtt", "cytotoxicity"), ("antibacter", "antimicrobial"), ("antimicrob", "antimicrobial"), ("mic", "antimicrobial"), ("antiviral", "antiviral"), ("enzym", "enzymatic"),
]
ORGANISM_RULES = [
    ("escherichia", "Escherichia coli"), ("e. coli", "Escherichia coli"), ("e.coli", "Escherichia coli"), ("homo sapiens", "Homo sapiens"), ("human", "Homo sapiens"),
    ("staphylococcus", "Staphylococcus aureus"), ("s. aureus", "Staphylococcus aureus"), ("pseudomonas", "Pseudomonas aeruginosa"), ("mus musculus", "Mus musculus"), ("mouse", "Mus musculus"),
    ("murine", "Mus musculus"), ("rattus", "Rattus norvegicus"), ("rat", "Rattus norvegicus"), ("saccharomyces", "Saccharomyces cerevisiae"), ("yeast", "Saccharomyces cerevisiae"),
]
#: Micro sign and Greek mu; a domain writes one of them.
MICRO, MU = "µ", "μ"


def title_norm(title: Column) -> Column:
    """Lower case, outer blanks off, white space collapsed, then signs removed; empty for null."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(F.coalesce(title, F.lit("")))), r"\s+", " "), r"[^\p{L}\p{N}_\s]", "")


def strip_lower(text: Column) -> Column:
    """Lower case without white space at the ends."""
    return F.lower(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""))


def alnum_key(text: Column) -> Column:
    """Lower-case letters and digits only."""
    return F.regexp_replace(F.lower(text), "[^a-z0-9]", "")


def file_key(name: Column) -> Column:
    """`alnum_key` with ".pdf" removed first."""
    return F.regexp_replace(F.replace(F.lower(name), F.lit(".pdf"), F.lit("")), "[^a-z0-9]", "")


def doi_plain(doi: Column) -> Column:
    """Lower-case DOI without resolver prefix and blanks; null where empty."""
    return F.nullif(F.regexp_replace(F.lower(F.trim(doi)), r"^https?://(dx\.)?doi\.[a-z.]+/", ""), F.lit(""))


def dois_of(cell: Column) -> Column:
    """DOIs of a cell that may hold several, split on commas, semicolons and white space."""
    parts = F.split(cell, r"[;,\s]+")
    bare = F.transform(parts, lambda x: F.regexp_replace(x, r"^https?://(dx\.)?doi\.[a-z.]+/", ""))
    return F.filter(bare, lambda x: F.contains(x, F.lit("10.")))


def compound_key(label: Column) -> Column:
    """A compound id without blanks, stars and outer brackets, in this order."""
    return F.btrim(F.btrim(F.trim(label), F.lit("*")), F.lit("()"))


def squeeze(text: Column) -> Column:
    """Runs of white space to one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def micro_norm(text: Column, to: str = MICRO) -> Column:
    """Both micro characters to the one a domain writes."""
    return F.translate(text, MICRO + MU, to + to)


def safe_filename(text: Column, suffix: str = ".pdf", most: int = 180) -> Column:
    """A file name: runs of illegal signs and of blanks to one "_", outer "._ " off, at most `most` characters, with suffix.

    What leaves nothing is "unknown"; a suffix that is there already, in any case, is not repeated.
    """
    clean = F.regexp_replace(F.regexp_replace(strip(text), r"[\\/:*?\"<>|\n\r\t]+", "_"), r"(?U)\s+", "_")
    name = F.substring(F.btrim(clean, F.lit("._ ")), 1, most)
    name = F.when(name == "", "unknown").otherwise(name)
    return F.when(F.lower(name).endswith(suffix.lower()), name).otherwise(F.concat(name, F.lit(suffix)))


def is_open(value: Column) -> Column:
    """Whether an access value means open access; false for null."""
    return F.coalesce(F.lower(F.trim(value)).isin(*OPEN), F.lit(False))


def first_rule(text: Column, rules: list[tuple[str, str]]) -> Column:
    """The value of the first rule whose text is contained; null where none is."""
    low = F.lower(F.trim(text))
    return F.coalesce(*[F.when(F.contains(low, F.lit(k)), F.lit(v)) for k, v in rules])


def assay_type(text: Column) -> Column:
    return first_rule(text, ASSAY_RULES)


def organism_rule(text: Column) -> Column:
    return first_rule(text, ORGANISM_RULES)


def strip(text: Column) -> Column:
    """Without white space at the ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def target_type(text: Column) -> Column:
    """pMIC where that is all, MIC where it is contained; other texts stay, blank ones are null."""
    name = F.nullif(strip(text), F.lit(""))
    return F.when(F.lower(name) == "pmic", "pMIC").when(F.contains(F.lower(name), F.lit("mic")), "MIC").otherwise(name)


def relation_of(*sources: Column) -> Column:
    """">" or "<" of the first source that has one or its "or equal" form, ">" before "<"; "=" otherwise."""
    signs = [F.when(F.coalesce(s, F.lit("")).rlike("[>≥]"), ">").when(F.coalesce(s, F.lit("")).rlike("[<≤]"), "<") for s in sources]
    return F.coalesce(*signs, F.lit("="))


def pdf_name(text: Column) -> Column:
    """A file's name in lower case without its ending."""
    low = F.lower(text)
    return F.when(low.endswith(".pdf"), F.substring(low, F.lit(1), F.length(low) - 4)).otherwise(low)


# Culture collections and strains after which an organism's strain begins.
STRAIN = r"(?i)\b(ATCC|ATTC|NCTC|NCIMB|DSM|MTCC|KCTC|CCM|CIP|NRRL|MRSA|VRE|H37Rv|PAO1|O157)\b"


def split_strain(text: Column) -> tuple[Column, Column]:
    """(organism, strain) split at the first strain word; strain is null where there is none, an organism is never empty."""
    text = F.nullif(strip(text), F.lit(""))
    at = F.regexp_instr(text, F.lit(STRAIN))
    before = F.btrim(F.substring(text, F.lit(1), at - 1), F.lit(" ,;"))
    return F.when((at > 0) & (before != ""), before).otherwise(text), F.when(at > 0, strip(F.substring(text, at, F.length(text))))


def split_property_unit(header: Column) -> tuple[Column, Column]:
    """(property, unit) of a column header: a bracketed or comma-separated ending is its unit."""
    bracket = F.regexp_extract(header, r"^(.*?)\s*[(\[]([^()\[\]]*)[)\]]\s*$", 2)
    comma = F.regexp_extract(header, r"^(.*),\s*([^,]+)$", 2)
    unit = F.when(bracket != "", bracket).when(comma != "", comma).otherwise("")
    name = F.when(bracket != "", F.regexp_extract(header, r"^(.*?)\s*[(\[]([^()\[\]]*)[)\]]\s*$", 1)).when(comma != "", F.regexp_extract(header, r"^(.*),\s*([^,]+)$", 1)).otherwise(header)
    return F.trim(name), F.trim(unit)


def label_token(name: Column) -> Column:
    """A compound label: the bracketed one first, else a bare one at the end; null where none."""
    inner = F.regexp_extract(name, r"\((\d{1,3}[a-z]?)\)", 1)
    return F.coalesce(F.nullif(inner, F.lit("")), F.nullif(F.regexp_extract(name, r"(?:^|\s)(\d{1,3}[a-z]?)$", 1), F.lit("")))


def figure_number(caption: Column) -> Column:
    return F.nullif(F.regexp_extract(caption, r"(?i)\bfig(?:ure)?\.?\s*(\d+)", 1), F.lit("")).cast("int")


def inchikey_skeleton(key: Column) -> Column:
    return F.upper(F.split_part(key, F.lit("-"), F.lit(1)))


def entity_id(inchikey: Column, cid: Column, cas: Column, name: Column | None = None) -> Column:
    """Identity of a compound: structure key, then database ids, then (if given) the exact lower-case name."""
    full = lambda c: F.nullif(c, F.lit(""))
    parts = [F.concat(F.lit("ik:"), full(inchikey)), F.concat(F.lit("cid:"), full(cid)), F.concat(F.lit("cas:"), full(cas))]
    if name is not None:
        parts.append(F.concat(F.lit("nm:"), F.lower(full(name))))
    return F.coalesce(*parts)


def record_hash(*fields: Column) -> Column:
    """A record id: "r_" and the first 12 digits of the sha1 of the fields joined by "|", null printing as None."""
    return F.concat(F.lit("r_"), F.substring(F.sha1(F.concat_ws("|", *[F.coalesce(f.cast("string"), F.lit("None")) for f in fields])), 1, 12))


def doc_type(path: Column) -> Column:
    """Document type by file extension."""
    ext = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    return F.when(ext == "pdf", "pdf").when(ext.isin("png", "jpg", "jpeg", "tif", "tiff"), "image").when(ext.isin("htm", "html"), "html").when(ext == "xml", "xml").otherwise("unknown")


def strip_fences(text: Column) -> Column:
    """A model's JSON without code fences and talk: from the first brace to the last; null where none."""
    return F.nullif(F.regexp_extract(text, r"(?s)(\{.*\})", 1), F.lit(""))


def citation_pdf_url(html: Column) -> Column:
    """The PDF address a landing page names in its meta tags; null where none."""
    return F.nullif(F.regexp_extract(html, r"(?i)<meta[^>]+name=[\"']citation_pdf_url[\"'][^>]+content=[\"']([^\"']+)", 1), F.lit(""))


def abstract_from_index(words: Column, positions: Column) -> Column:
    """Text of an inverted index given as aligned arrays; words ordered by position."""
    return F.array_join(F.transform(F.array_sort(F.arrays_zip(positions, words)), lambda x: x[1]), " ")
