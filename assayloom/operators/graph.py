"""Records as a graph: nodes, edges and their projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Role names by alias.
ROLES = {
    "reactant": "reactant", "substrate": "reactant", "starting material": "reactant", "product": "product", "reagent": "reagent", "catalyst": "catalyst", "solvent": "solvent",
    "reaction medium": "reaction_medium", "medium": "reaction_medium", "ligand": "ligand", "target": "target", "analyte": "analyte", "property": "property",
}


def canonical_role(role):
    """A role under its canonical name; null for unknown roles."""
    known = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.try_element_at(known, F.lower(F.regexp_replace(role, r"(?U)^\s+|\s+$", "")))


def author_edges(papers: DataFrame) -> DataFrame:
    """Edges paper to author in order: paper_row, position, author."""
    return papers.select("paper_row", F.posexplode("authors")).select("paper_row", F.col("pos").cast("long").alias("position"), F.col("col").alias("author"))


def dataset_projection(measurements: DataFrame, entities: DataFrame, roles: DataFrame) -> DataFrame:
    """Measurements with their entity and the entity's first role; measurements: m_id, e_id, value; entities: e_id, name; roles: e_id, ord, role."""
    first = roles.groupBy("e_id").agg(F.min(F.struct("ord", "role"))["role"].alias("role"))
    return measurements.join(entities, "e_id", "left").join(first, "e_id", "left")


def store_stats(**groups: DataFrame) -> DataFrame:
    """(group, n): rows of every node and edge table."""
    parts = [df.agg(F.lit(name).alias("node_group"), F.count("*").alias("n")) for name, df in groups.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def mentions(names: DataFrame, captions: DataFrame, paper: str, name: str, caption: str) -> DataFrame:
    """Names that stand as whole tokens in captions of their paper; an inverted index on the name's first token avoids all pairs."""
    token = lambda c: F.lower(F.regexp_extract(c, r"([A-Za-z0-9]+)", 1))
    n = names.select(paper, F.col(name).alias("n")).distinct().withColumn("t", token(F.col("n"))).filter("t <> ''")
    c = captions.select(paper, F.col(caption).alias("c")).withColumn("t", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("c"), F.lit(r"([a-z0-9]+)"), F.lit(1)))))
    quoted = F.concat(F.lit(r"(?i)(?<![A-Za-z0-9])\Q"), "n", F.lit(r"\E(?![A-Za-z0-9])"))
    return c.join(n, [paper, "t"]).filter(F.regexp_like(F.col("c"), quoted)).select(paper, F.col("n").alias(name), F.col("c").alias(caption)).distinct()
