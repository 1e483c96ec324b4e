"""Names clustered without loss against the sequential form."""

from __future__ import annotations

import random

from assayloom.operators import fuzzy
from assayloom.plans import catalog


def test_exact_clusters_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(fuzzy, "BLOCK", 30)
    rng = random.Random(5)
    parts = [["4-furyl", "4-allyl", "5-allyl", "n-benzyl", "a"], ["1h-quinazoline", "1h-quinoline", "1h-thiazole", "1h-triazole", "indole"], ["3c", "3d", "salt of zinc", "", "3c  3c"]]
    names = list(dict.fromkeys([" ".join(rng.sample([p for q in parts for p in [rng.choice(q)]], 3)).strip() for _ in range(150)] + ["", "a", "\tindole", "indoles"]))
    df = spark.createDataFrame(list(enumerate(names)), "rec_no long, name string")
    got = {r["name"]: r["leader"] for r in fuzzy.cluster_names(df, "rec_no", "name", exact=True).collect()}
    assert got == {n: names[i] for n, i in zip(names, fuzzy.leaders(names))}
    assert len(set(got.values())) < len(got)


def test_bounds_miss_no_similar_name():
    rng = random.Random(9)
    words = ["acid", "acetic", "zinc", "salt", "of", "a", "thiazole", "triazole", "3-methylbenzothiazole", "é"]
    names = sorted({"".join(rng.choice([" ", "  ", "-"]) + w for w in rng.choices(words, k=rng.randrange(1, 6))).strip(rng.choice([" ", "x"])) for _ in range(250)})
    shapes = fuzzy.Shapes(names)
    for i, n in enumerate(names):
        may = set(shapes.may(shapes, i, fuzzy.SAME).tolist())
        assert {j for j, m in enumerate(names) if fuzzy.weighted_ratio(n, m) >= fuzzy.SAME} <= may


def test_query_merges_names_of_different_longest_words(spark, tmp_path):
    rows = [(1, "4-furyl-1h-quinazoline", None, None, None, None), (2, "4-furyl-1h-quinoline", None, None, None, None)]
    spark.createDataFrame(rows, "rec_no long, name_std string, name_raw string, inchikey string, pubchem_cid long, cas string").write.parquet(str(tmp_path / "curated_records.parquet"))
    assert {r["leader"] for r in catalog.queries()["name_clusters"](spark, str(tmp_path)).collect()} == {"4-furyl-1h-quinazoline"}
