"""Queries of this subpackage that SQL can express equal their twins on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from assayloom.llm import catalog

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables are not here")


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_twin(spark, name):
    got = catalog.queries()[name](spark, str(DATA)).toPandas()
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    want = con.execute(catalog.oracle_sql()[name]).df()
    rows = lambda df: sorted(map(tuple, df[sorted(df.columns)].itertuples(index=False, name=None)))
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)
