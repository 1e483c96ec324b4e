"""Every core query runs on the smallest tables and equals its SQL twin."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from assayloom.plans import catalog

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables are not here")


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted(tuple("" if v is None or v != v else repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r) for r in df.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, name):
    got = catalog.queries()[name](spark, str(DATA)).toPandas()
    sql = catalog.oracle_sql().get(name)
    if not sql:
        return
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    want = con.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
