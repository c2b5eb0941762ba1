"""Queries over tables that the test data doesn't have: halves, ties, repeated points, many rows of a key."""

import datetime
import tracemalloc

import duckdb
import numpy as np
import pytest

from tariffa.operators import inference, store
from tariffa.plans import audit, catalog, more, reference  # noqa: F401
from tariffa.sources import downloads, records


def against_sql(spark, folder, name, tables):
    """The query's rows and those of its SQL. tables: rows and columns by name."""
    db = duckdb.connect()
    for table, (rows, ddl) in tables.items():
        path = f"{folder}/{table}.parquet"
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(path)
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/*.parquet'")
    df = catalog.QUERIES[name](spark, str(folder))
    want = db.execute(catalog.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    return sorted(map(str, (tuple(r[c] for c in columns) for r in df.collect()))), sorted(map(str, want.fetchall()))


def test_halves_go_to_the_even_number(spark, tmp_path):
    at = datetime.datetime(2024, 1, 1)
    rows = [(1, at, 1, 8.0), (2, at, 1, 8.5), (3, at, 2, 7.5), (4, at, 2, 9.5), (5, at, 3, 0.5), (6, at, None, 1.0)]
    got, want = against_sql(spark, tmp_path, "download_provenance", {"events": (rows, "event_id long, ts timestamp, user_id long, value double")})
    assert got == want and len(got) == 3


@pytest.mark.parametrize("order", [1, -1])
def test_provenance_of_equal_downloads_does_not_hang_on_their_order(spark, order):
    rows = [("d", "2019", f"u{i}", "s", "2024-01-01") for i in range(6)][::order]
    assert downloads.provenance(spark.createDataFrame(rows, "dataset string, release string, source_url string, sha256 string, downloaded_at string").coalesce(1)).first().source_url == "u5"


def test_wild_bootstrap_of_many_clusters_is_bounded_in_memory():
    rng = np.random.default_rng(5)
    cluster = np.repeat(np.arange(4000), 5)
    x = np.stack([np.ones(20_000), rng.integers(0, 2, 20_000)], 1).astype(float)
    y = rng.normal(size=20_000) + rng.normal(size=4000)[cluster] + 0.02 * x[:, 1]
    tracemalloc.start()
    try:
        p = inference.wild_bootstrap(y, x, 1, cluster, 1000)
        assert tracemalloc.get_traced_memory()[1] < 60e6
    finally:
        tracemalloc.stop()
    # the draws one by one, over all rows
    weights, left = inference.WEBB[np.random.default_rng(inference.SEED).integers(0, 6, (4000, 1000))], y - y.mean()
    t = lambda b, se, _: abs(b[1] / se[1])
    observed = t(*inference.cluster_ols(y, x, cluster))
    assert p == np.mean([t(*inference.cluster_ols(y.mean() + left * w[cluster], x, cluster)) >= observed - 1e-12 for w in weights.T])
    assert inference.wild_bootstraps(y, x, [1], cluster, 1000, held=3000) == [p]


NATIONS = ([(1, "A", 0), (2, "B", 0), (3, "C", 1), (4, "D", None), (5, "E", 0)], "n_nationkey int, n_name string, n_regionkey int")


def test_blocks_of_odd_keys(spark, tmp_path):
    customers = [(1, 1), (2, 1), (2, 2), (-3, 1), (4, 2), (5, 3), (6, 4), (7, None), (None, 1), (8, 9), (9, 5)]
    suppliers = [(6, 1), (7, 1), (-8, 1), (None, 2), (11, 4), (12, None), (6, 1)]
    got, want = against_sql(spark, tmp_path, "blocked_match", {"nation": NATIONS, "customer": (customers, "c_custkey long, c_nationkey int"), "supplier": (suppliers, "s_suppkey long, s_nationkey int")})
    assert got == want and {r[-2] for r in got} == {"0", "1", "2"}


def test_blocks_make_no_pairs_but_their_own(spark, tmp_path):
    spark.createDataFrame(*NATIONS).write.parquet(f"{tmp_path}/nation.parquet")
    spark.range(300_000).selectExpr("if(id = 0, 0, 5 * id + 1) AS c_custkey", "if(id = 0, 1, 2) AS c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    # 6e9 pairs in the region, and one supplier that all but one customer are nearest to
    spark.range(20_000).selectExpr("if(id = 0, 1, 5 * id) AS s_suppkey", "if(id = 0, 2, 1) AS s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    got = catalog.QUERIES["blocked_match"](spark, str(tmp_path)).groupBy("block").count().collect()
    assert [tuple(r) for r in got] == [(0, 299_999 + 19_999)]


@pytest.mark.parametrize("name", ["local_difference_by_payer", "implied_difference"])
def test_differences_of_odd_rows(spark, tmp_path, name):
    customers = [(k, k % 4) for k in range(0, 900, 3)] + [(3, 3), (3, 3), (400, None), (None, 1)]
    suppliers = [(k, k % 3, k * 37 % 100 / 4) for k in range(0, 800, 2)] + [(2, 2, None), (8, 2, 1.0), (8, 2, 1.0), (5, None, 7.0)]
    got, want = against_sql(spark, tmp_path, name, {"customer": (customers, "c_custkey long, c_nationkey int"), "supplier": (suppliers, "s_suppkey long, s_nationkey int, s_acctbal double")})
    assert got == want and len(got) > 5


def test_differences_at_one_point(spark, tmp_path):
    # 2.4e9 pairs within reach, at one point
    spark.range(60_000).selectExpr("id * 391 AS c_custkey", "1 AS c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(40_000).selectExpr("id * 391 AS s_suppkey", "1 AS s_nationkey", "cast(id AS double) AS s_acctbal").write.parquet(f"{tmp_path}/supplier.parquet")
    got = catalog.QUERIES["local_difference_by_payer"](spark, str(tmp_path)).groupBy("payer_type", "n_hospitals", "difference", "level").count().collect()
    assert sorted(map(tuple, got)) == [("commercial", 13_334, 19_999.5, "local", 60_000), ("medicaid", 13_333, 19_999.0, "local", 60_000), ("self_pay", 13_333, 20_000.0, "local", 60_000)]
    total = {r.payer_type: r.n_counties for r in catalog.QUERIES["implied_difference"](spark, str(tmp_path)).where("bound = 'low'").collect()}
    assert total == {"commercial": 60_000, "medicaid": 60_000}


def test_pairs_within_a_radius_of_repeated_points(spark, tmp_path):
    # 20,000 keys on is the same point
    keys = "id % 4 * 20000 + id div 4 % 3 * 5000 + if(id < 12, id, 0)"
    spark.range(3000).selectExpr("20000 * id AS s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(100_000).selectExpr("20000 * id AS c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    near = catalog.QUERIES["radius_join"](spark, str(tmp_path))
    assert [tuple(r) for r in near.groupBy("miles").count().collect()] == [(0.0, 300_000_000)]
    (tmp_path / "few").mkdir()
    rows = [(r[0],) for r in spark.range(40).selectExpr(keys).collect()] + [(None,), (0,), (0,)]
    got, want = against_sql(spark, tmp_path / "few", "radius_join", {"supplier": (rows, "s_suppkey long"), "customer": (rows[::-1] + [(80_000,)], "c_custkey long")})
    assert got == want and len(got) > 40


def test_prices_of_all_kinds_share_one_shuffle(spark):
    rows = [("u1", "TX", "c", "x", "p", 10.0, 5.0, 20.0, 1), ("u1", "TX", "c", "x", "q", 30.0, 5.0, 20.0, 1), ("u1", "TX", "c", "self_pay_cash", "p", 8.0, 7.0, None, 2), ("u2", "TX", "c", None, "p", 9.0, 0.5, 40.0, 1), ("u3", None, "c", "x", "p", 1.0, 5.0, 20.0, 1)]
    got = store.geographic_medians(spark.createDataFrame(rows, "unit string, state string, code string, kind string, plan string, rate double, cash double, gross double, line int"), "rate", "unit", "state", ["code"], "kind", ["plan"], "cash", "gross", ["line"])
    # a paid price that bears the name of cash prices stays a value of its own
    assert {(r.kind, r.median_price, r.n_hospitals, r.n_rates) for r in got.where("state = 'TX'").collect()} == {("x", 20.0, 1, 2), ("self_pay_cash", 7.0, 2, 3), ("gross_charge", 30.0, 2, 2)}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = catalog.QUERIES["three_stage_median"](spark, "/root/testdata/sf0.001")
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("FileScan") == 6 and "ReusedExchange" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_files_that_are_not_cut_take_one_scan(spark, tmp_path, monkeypatch):
    for i in range(3):
        (tmp_path / f"{i}.csv").write_bytes(b'a,"b\nc"\nd,caf\xe9\x81\n')
    (tmp_path / "big.csv").write_bytes(b'x,"' + b"line\n" * 2000 + b'"\ny,z\n')
    seen, plain = [], records._starts
    monkeypatch.setattr(records, "_starts", lambda lines: seen.append(plain(lines)) or seen[-1])
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for c in before:
            spark.conf.set(c, "1k")
        got = sorted((r.path[-5], r.cells, r.stray) for r in records.records(spark, str(tmp_path)).collect())
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert {p[-7:] for p, _ in seen[0]} == {"big.csv"} and len(seen[0]) > 3
    assert got == sorted([x for i in "012" for x in ((i, ["a", "b\nc"], 0), (i, ["d", "café�"], 2))] + [("g", ["x", "line\n" * 2000], 0), ("g", ["y", "z"], 0)])
