import duckdb
import pytest

from tariffa.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_gives_the_same_rows(spark, name):
    db = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = db.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    want = sorted(map(str, found.fetchall()))
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(str(tuple(r[c] for c in columns)) for r in df.collect()) == want
