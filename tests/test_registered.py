"""Every registered query against its DuckDB oracle on the smallest supplied tables."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _rows(pdf):
    import pandas as pd
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(None if (not isinstance(x, str) and x is not None and pd.isna(x)) else _norm(x)
                               for x in rec) for rec in pdf[cols].itertuples(index=False)), key=repr)


def test_every_query_has_an_oracle():
    from transitlab.plans.queries import ROWS_ONLY
    own = {k for k in E.queries() if not k.startswith("op") and k != "pipeline"}
    assert own - set(ROWS_ONLY) == {k for k in E.oracle_sql() if k in own}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "avg_delay" in df.columns


@pytest.mark.parametrize("name", sorted(k for k in E.oracle_sql() if not k.startswith("op") and k != "pipeline"))
def test_query_matches_oracle(spark, duck, name):
    got = _rows(E.queries()[name](spark, SF).toPandas())
    want = _rows(duck.execute(E.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert got[1] == want[1]
