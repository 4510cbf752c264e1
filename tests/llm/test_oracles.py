"""The registered queries that have SQL, against DuckDB on the smallest supplied tables."""
import duckdb
import pytest

from transitlab.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = registry.QUERIES[name](spark, SF)
    got = sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)
    rel = con.execute(registry.ORACLE[name])
    names = [d[0] for d in rel.description]
    order = [names.index(c) for c in sorted(names)]
    assert sorted(names) == sorted(df.columns)
    assert got == sorted((tuple(r[i] for i in order) for r in rel.fetchall()), key=repr)
