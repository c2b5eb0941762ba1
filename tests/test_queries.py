import math
import os

import duckdb
import pytest

from tariffa.plans import audit, cases, catalog, more, owners, reference, upkeep  # noqa: F401

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6f}"
    return v if v is None else str(v)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, db, name):
    df = catalog.QUERIES[name](spark, SF)
    got = df.collect()
    if name in catalog.ORACLE_SQL:
        rel = db.execute(catalog.ORACLE_SQL[name])
        columns = [d[0] for d in rel.description]
        assert sorted(columns) == sorted(df.columns)
        want = rel.fetchall()
        order = sorted(columns)
        a = [tuple(plain(r[c]) for c in order) for r in got]
        b = [tuple(plain(dict(zip(columns, r, strict=True))[c]) for c in order) for r in want]
        assert sorted(map(str, a)) == sorted(map(str, b))
