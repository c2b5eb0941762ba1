import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tariffa import schema as sc
from tariffa.functions import numbers as nu
from tariffa.functions import rules
from tariffa.functions import text as tx
from tariffa.operators import checks, inference, matching, reshape, store
from tariffa.operators import economics as eco
from tariffa.operators import joins as jo
from tariffa.operators import windows as win
from tariffa.plans import catalog
from tariffa.sources import web
from tariffa.streaming import resume


def values(spark, f, *xs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x string")
    return [r.y for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_url_key_gives_the_parent_too(spark, tmp_path):
    urls = ["https://www.Apps.Vendor.com:8080/a.csv?x=1", "http://host.org/", "files.a.b.co.uk/get.php?id=1#f", "http://localhost/x"]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    rows = catalog.QUERIES["url_key"](spark, str(tmp_path)).orderBy("page_id").collect()
    assert [r.parent for r in rows] == ["vendor.com", "host.org", "co.uk", ""]
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    found = db.execute(catalog.ORACLE_SQL["url_key"])
    assert [d[0] for d in found.description] == ["page_id", "url_key", "site", "parent"]
    assert [r[3] for r in sorted(found.fetchall())] == ["vendor.com", "host.org", "co.uk", ""]


def test_codes(spark):
    assert values(spark, tx.apr_drg_code, "560-1", "5601", "560.1", "560 1", "APR-DRG 560-1", "560 SOI 1", "60-1", "05601", "5609", "40", None) == ["560-1"] * 6 + ["060-1", "05601", "5609", "040", None]
    assert values(spark, tx.drg_code, "0742", "742.0", "7", "74200", " 742\t", "A1") == ["742", "742", "007", "74200", "742", "A1"]
    assert values(spark, tx.ccn, "10001", "010001", "01000111", "1000101", "010001.0", "06S01101", "01014F", "", None) == ["010001"] * 5 + ["06S011", "01014F", None, None]
    assert values(spark, tx.parent_ccn, "01S001", "01T001", "010001", "04Z304", "33R123", "45W200", "45Y025", "050W12") == ["010001", "010001", "010001", "041304", "331123", "452200", "453025", "050W12"]
    assert values(spark, tx.url_key, "HTTPS://www.Host.org/A/b.csv?sig=1#x", "http://host.org/", "host.org/get.php?id=1") == ["host.org/A/b.csv", "host.org", "host.org/get.php?id=1"]
    assert values(spark, tx.zip_key, "1 Main St, Austin, TX 78701-1234", "78701 Elm") == ["78701", None]
    assert values(spark, lambda x: F.array_join(tx.name_tokens(x), " "), "The St. Mary's Medical Center of Austin") == ["st marys austin"]
    assert values(spark, nu.mrf_date, "1/2/26", "2026-01-02", "20260102", "01-02-2026", "1/2/1850", "spring") == ["2026-01-02"] * 4 + ["1/2/1850", "spring"]
    assert values(spark, lambda x: rules.payer_type(x, F.lit(None)), "Humana Medicare Advantage", "Medigap", " ", None, "odd") == ["medicare_advantage", "medicare", "unknown", "unknown", "other"]
    assert values(spark, rules.explicit_type, "Humana TRICARE", "aetna ppo", "medicare", None) == ["tricare_va", None, "medicare", None]
    assert values(spark, rules.labelled_type, " Managed  Medicaid", "Odd One", None) == ["medicaid", "unmapped: odd one", None]
    table = spark.createDataFrame([(2, "other", "b"), (1, "medicare", "a")], "priority int, payer_type string, pattern string")
    assert rules.rules_of(table) == (("medicare", "a"), ("other", "b"))
    with pytest.raises(ValueError):
        rules.rules_of(table.withColumn("payer_type", F.lit("x")))
    fit = spark.createDataFrame([("CPT", "procedure"), (None, "procedure"), (None, "apr_drg"), ("DRG", "apr_drg"), ("apr drg", "apr_drg"), ("drg", "ms_drg"), ("HCPCS/CPT", "procedure"), ("CDM", "procedure")], "k string, f string")
    assert [r[0] for r in fit.select(tx.code_type_fit(F.col("k"), F.col("f"))).collect()] == ["verified", "unverified", "incompatible", "incompatible", "verified", "unverified", "verified", "incompatible"]


def test_conform(spark):
    df = spark.createDataFrame([("a", "x12", 1)], "concept string, gross string, other int")
    out = sc.conform(df)
    assert out.columns == list(sc.PRICE_COLUMNS) and out.first().gross is None and out.first().concept == "a"
    assert sc.public_names(["Facility ID", "City/Town", "city/town", "%"]) == ["facility_id", "citytown", "citytown_2", "x"]
    assert sc.pick_relation({"a": ["x"], "b": ["x", "y"]}, ["a", "b"], ["y"]) == "b"
    with pytest.raises(ValueError, match="a lacks z"):
        sc.pick_relation({"a": ["x"]}, ["a"], ["z"])


def test_radius_equals_all_pairs(spark):
    rng = random.Random(1)
    a = [(i, rng.uniform(25, 70), rng.uniform(-150, -70)) for i in range(300)]
    b = [(i, x + rng.uniform(-1, 1), y + rng.uniform(-1, 1)) for i, x, y in a if x < 69]
    got = jo.within_radius(spark.createDataFrame(a, "i int, lat double, lon double"), spark.createDataFrame(b, "j int, lat2 double, lon2 double"), 30).collect()

    def miles(x, y):
        (p, q), (r, s) = [tuple(map(math.radians, z[1:])) for z in (x, y)]
        h = math.sin((r - p) / 2) ** 2 + math.cos(p) * math.cos(r) * math.sin((s - q) / 2) ** 2
        return 2 * 3958.8 * math.asin(min(1, math.sqrt(h)))

    assert {(r.i, r.j) for r in got} == {(x[0], y[0]) for x in a for y in b if miles(x, y) <= 30}


def test_nearest_value(spark):
    rng = random.Random(2)
    own = [(i, rng.choice("ab"), rng.choice([None, float(rng.randrange(50))])) for i in range(60)]
    other = [(rng.choice("ac"), float(rng.randrange(50))) for _ in range(40)]
    got = jo.nearest_value(spark.createDataFrame(own, "i int, k string, v double"), spark.createDataFrame(other, "k string, w double"), ["k"], "i", "v", "w").collect()
    want = {i: min((abs(v - w) for q, w in other if q == k), default=None) if v is not None else None for i, k, v in own}
    assert {r.i: r.gap for r in got} == want and len(got) == 60


def test_windows(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "x string")
    assert {r.x: r.id for r in win.surrogate_keys(df, ["x"], "id").collect()} == {"a": 1, "b": 2, "c": 3, None: 4}
    lone = win.with_margin(spark.createDataFrame([("p", 1, 0.9), ("p", 2, 0.5), ("q", 1, 0.4)], "k string, j int, s double"), ["k"], "s", ["j"])
    assert {r.k: round(r.margin, 6) for r in lone.collect()} == {"p": 0.4, "q": 0.4}
    assert [r.turn for r in win.interleaved(spark.createDataFrame([("h", 1), ("h", 2), ("g", 3)], "h string, i int"), "h", [F.col("i")]).collect()] == [1, 1, 2]
    assert reshape.wide_headers(["standard_charge|P|Q|negotiated_dollar", "count|P|Q", "description"]) == {("P", "Q"): {"negotiated_dollar": "standard_charge|P|Q|negotiated_dollar", "count": "count|P|Q"}}


def test_store_and_checks(spark, tmp_path):
    rng = random.Random(3)
    rows = []
    for f in range(6):
        for c in ("111", "222"):
            for p in ("Own Medicare", "Blue Cross PPO", None):
                gross = 1000.0 + 10 * rng.random()
                rows.append((f"{f:064x}", f"u{f}", "H", "TX", "k" + c, c, "outpatient", "facility", gross, 500.0, p, None if p is None else "", None if p is None else 300.0 + rng.random(), "fee schedule", "d"))
    prices = spark.createDataFrame(rows, "mrf_file_id string, mrf_url string, hospital_name string, license_state string, concept string, code string, setting string, billing_class string, gross double, discounted_cash double, payer_name string, plan_name string, negotiated_dollar double, methodology string, description string")
    prices = sc.conform(prices)
    cross = spark.createDataFrame([(f"{f:064x}", f"01000{f}", "npi", 0.9, f == 5, f == 4) for f in range(6)], "mrf_file_id string, ccn string, ccn_match_method string, ccn_match_score double, ccn_ambiguous boolean, ccn_conflict boolean")
    roster = spark.createDataFrame([(f"01000{f}", "TX") for f in range(6)], "ccn string, state string")
    s = store.build(prices, cross, roster)
    assert s.fact.count() == 36 and s.bridge.count() == 5 and s.dim_payer.count() == 2
    units = {r.unit_id for r in s.hospital_rates().select("unit_id").distinct().collect()}
    assert units == {"010000", "010001", "010002", "010003", "file:5", "file:6"}
    report = checks.run(spark, [("keys", "keys", lambda: checks.fact_keys(s)), ("dims", "keys", lambda: checks.dim_keys(s)), ("bridge", "keys", lambda: checks.bridge(s)), ("rows", "load", lambda: checks.row_counts(s, prices)), ("ids", "load", lambda: checks.file_ids(s)), ("rates", "rates", lambda: checks.plausibility(s)), ("gross", "rates", lambda: checks.files_above_gross(s)), ("broken", "x", lambda: 1 / 0)])
    status = {r.check_id: r.status for r in report.collect()}
    assert status.pop("broken") == "fail" and set(status.values()) == {"pass"}
    assert checks.markdown(report).splitlines()[2].startswith("| broken |")
    store.write(s, str(tmp_path / "db"))
    assert spark.read.parquet(str(tmp_path / "db/fact")).count() == 36
    rates = s.hospital_rates()
    medians = store.geographic_medians(rates.where("plausible"), "case_dollar", "unit_id", "state", ["concept", "code"], "payer_type", ["payer_id"], "discounted_cash", "gross", ["description"])
    cells = {(r.state, r.code, r.payer_type): r for r in medians.collect()}
    assert cells["US", "111", "self_pay_cash"].median_price == 500 and cells["TX", "111", "medicare"].n_hospitals == 6 and len(cells) == 16
    assert checks.ordered({"a": 1, "b": 2, "c": None}, ["a", "c", "b"], "o", True)[0][3] == "pass"
    assert checks.saved_medians(medians, medians.limit(15), ["state", "code", "payer_type"], "median_price")[0][3] == "fail"


def test_matching(spark):
    roster = spark.createDataFrame([("010001", "Mercy Regional Hospital", "100 Main Street", "Austin", "TX", "78701"), ("010002", "Mercy Valley Clinic", "200 Oak Ave", "Austin", "TX", "78702"), ("010003", "Lakeside Memorial", "5 Lake Rd", "Waco", "TX", "76701"), ("020001", "Mercy Regional Hospital", "9 Elm St", "Tulsa", "OK", "74101")], "ccn string, name string, address string, city string, state string, zip string")
    fac = spark.createDataFrame(
        [("a", "http://x.org/a.csv", "Mercy", None, None, None, "TX", None, None), ("b", None, "Mercy Regional", None, "100 Main St, Austin, TX 78701", "Austin", "TX", None, None), ("c", None, "Lakeside Memorial Hospital", None, "5 Lake Road Waco TX 76701", "Waco", "TX", None, "1234567890"), ("d", None, "Nowhere Place", None, None, None, "TX", None, None), ("e", "http://x.org/a.csv", "Mercy", None, None, None, "TX", None, "1234567890")],
        "facility_key string, mrf_url string, name string, location_name string, address string, city string, state string, license string, type_2_npi string",
    )
    urls = spark.createDataFrame([("x.org/a.csv", "010002")], "url_key string, ccn string")
    npis = spark.createDataFrame([("1234567890", "010003")], "npi string, ccn string")
    licenses = spark.createDataFrame([], "license_key string, state string, ccn string")
    got = {r.facility_key: r for r in matching.resolved(fac, matching.profiles(roster), urls, npis, licenses).collect()}
    assert {k: (r.ccn, r.ccn_match_method) for k, r in got.items()} == {"a": ("010002", "mrf_url"), "b": ("010001", "name_address"), "c": ("010003", "npi"), "e": ("010002", "mrf_url")}
    assert got["e"].ccn_conflict and not got["a"].ccn_conflict and not any(r.ccn_ambiguous for r in got.values())
    # its ZIP's one hospital has another name, so a namesake elsewhere in the city doesn't match; without a ZIP it does
    other = spark.createDataFrame([("z", None, "Mercy Regional", None, "9 Elm St, Austin, TX 78702", "Austin", "TX", None, None), ("y", None, "Mercy Regional Hospital", None, None, "Austin", "TX", None, None)], fac.schema)
    away = matching.profiles(roster.where("ccn <> '010002'").unionByName(roster.limit(1).selectExpr("'010009' as ccn", "'Quiet Harbor Institute' as name", "'1 Far Way' as address", "city", "state", "'78702' as zip")))
    assert [(r.facility_key, r.ccn) for r in matching.resolved(other, away, urls.limit(0), npis.limit(0), licenses).collect()] == [("y", "010001")]
    share = {(r.dimension, r.level): r.share for r in matching.coverage(spark.createDataFrame([(r.ccn, False) for r in got.values()], "ccn string, ccn_ambiguous boolean"), roster, ["state"]).collect()}
    assert share == {("all", "all"): 0.75, ("state", "TX"): 1.0, ("state", "OK"): 0.0}


def test_inference(spark):
    assert inference.t_quantile(0.975, 10) == pytest.approx(2.2281389, abs=1e-5) and inference.t_two_sided(2.2281389, 10) == pytest.approx(0.05, abs=1e-6)
    rng = np.random.default_rng(1)
    cluster = np.repeat(np.arange(30), 6)
    treated = (cluster % 2).astype(float)
    y = 1 + 0.5 * treated + rng.normal(size=30)[cluster] * 0.3 + rng.normal(size=180) * 0.2
    x = np.stack([np.ones(180), treated], 1)
    b, se, g = inference.cluster_ols(y, x, cluster)
    assert g == 30 and abs(b[1] - 0.5) < 3 * se[1] and 0.05 < se[1] < 0.25
    assert inference.wild_bootstrap(y, x, 1, cluster, 499) < 0.05 < inference.wild_bootstrap(y, x, 1, cluster, 499, null=float(b[1]) + 0.01)
    low, high = inference.bootstrap_interval(y, x, 1, cluster, 199)
    assert low < b[1] < high
    share = 1 / (1 + np.exp(-(0.3 + 0.8 * treated)))
    coef, _, effect = inference.quasibinomial(share, x, np.ones(180), cluster)
    assert coef == pytest.approx([0.3, 0.8], abs=1e-6) and effect[1] > 0
    rows = [("c1", float(np.exp(v)), "pe" if z else "none", int(k), "s") for v, z, k in zip(y, treated, cluster, strict=True)] + [("c2", 5.0, "none", 1, "s"), ("c2", 6.0, "few", 2, "s")]
    out = {(r.code, r.term): r for r in inference.group_models(spark.createDataFrame(rows, "code string, price double, grp string, cl int, st string"), ["code"], "price", "grp", "none", "cl", ["st"]).collect()}
    assert out["c1", "pe"].estimate == pytest.approx(b[1]) and out["c1", "pe"].std_error == pytest.approx(se[1]) and out["c2", "few"].status == "not estimated"


def test_economics(spark):
    one = spark.range(1)
    get = lambda c: one.select(c.alias("x")).first().x
    f = F.lit
    assert get(eco.net_value(f(100.0), f(0.5), f(10.0), f(50.0), f(400.0))) == pytest.approx(60)
    assert get(eco.breakeven_minutes(f(-1.0), f(0.5), f(50.0), f(400.0))) is None and get(eco.breakeven_minutes(f(1.0), f(0.0), f(50.0), f(400.0))) == math.inf
    days = eco.day_values(spark.createDataFrame([(480.0, 60.0, 10.0, 100.0, 900.0)], "day double, primary double, added double, margin double, displaced double"))
    assert [r.cases for r in days.orderBy("addons").collect()] == [8, 7, 7, 7, 7, 7, 7, 6, 6]
    drawn = eco.draws(spark, [("u", "beta", 0.5, 0.2, 0.8), ("k", "fixed", 2, 2, 2)], 500)
    assert drawn.count() == 500 and abs(drawn.agg(F.avg("u")).first()[0] - 0.5) < 0.05
    assert get(nu.triangular(f(0.5), f(0.0), f(1.0), f(2.0))) == pytest.approx(1.0)


def test_whole_cells_and_draws(spark):
    from tariffa.plans import catalog, more  # noqa: F401

    sf = "/root/testdata/sf0.001"
    flags = {r[0] for r in spark.read.parquet(f"{sf}/lineitem.parquet").select("l_returnflag").distinct().collect()}
    rows = catalog.QUERIES["wild_bootstrap_cell"](spark, sf).where("p_bootstrap is not null and not isnan(p_bootstrap)").collect()
    assert {r.l_returnflag for r in rows} == flags
    assert all(abs(r.p_bootstrap * 9999 - round(r.p_bootstrap * 9999)) < 1e-6 for r in rows)
    assert {r.n for r in catalog.QUERIES["psa_summary"](spark, sf).collect()} == {5000}


def test_web(spark):
    html = '<html><body><a href="/p">Price <b>Transparency</b></a><a href="mailto:x@y">m</a><footer><a href="f.csv">Standard charges</a></footer></body></html>'
    assert web.anchors(html, "http://h.org/a/b") == [("http://h.org/p", "Price Transparency", False), ("http://h.org/a/f.csv", "Standard charges", True)]
    pages = spark.createDataFrame([(1, "http://h.org/", html), (2, None, None)], "page_id long, url string, html string")
    assert [(r.link, r.text) for r in web.price_links(web.links(pages)).collect()] == [("http://h.org/p", "Price Transparency")]
    rules_ = web.robots("User-agent: *\nDisallow: /\n\nUser-agent: own\nDisallow: /a\nAllow: /a/b$\n", "Own bot")
    assert web.path_allowed(rules_, "/a/b") and not web.path_allowed(rules_, "/a/bc") and web.path_allowed(rules_, "/x")
    text = "﻿Location-Name: A\nmrf-url: http://x\nlocation_name: B\ncontact-email: c@d\njunk\n"
    assert [(e["location-name"], e["mrf-url"], e["contact-email"]) for e in web.locations(text)] == [("A", "http://x", None), ("B", None, "c@d")]
    assert web.location_rows(spark.createDataFrame([("k", text)], "k string, t string"), "k", "t").count() == 2
    assert values(spark, lambda x: F.array_join(web.extra_urls(x), " "), '["http://a","http://b"]', "http://a;http://b | x", "http://a,http://b") == ["http://a http://b"] * 3


def test_resume(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    spark.range(5).write.parquet(src)
    double = lambda df: df.withColumn("id", F.col("id") * 2)
    schema = spark.read.parquet(src).schema
    resume.staged(spark, src, schema, out, mark, double, 1)
    spark.range(5, 7).write.mode("append").parquet(src)
    resume.staged(spark, src, schema, out, mark, double, 1)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [0, 2, 4, 6, 8, 10, 12]
    links = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (4, 5)], "from long, to long")
    found = {r.node: (r["round"], r.via) for r in resume.frontier(spark.createDataFrame([(1,)], "node long"), links).collect()}
    assert found == {1: (0, None), 2: (1, 1), 3: (2, 2), 4: (3, 3)}


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).limit(1).count() == 1


def test_best_overlap_equals_all_pairs(spark):
    import random

    rng = random.Random(4)
    rows = [(i, sorted({rng.choice("abcdefgh") for _ in range(rng.randrange(4))})) for i in range(120)] + [(500, ["z"]), (501, ["q", "r"]), (502, ["q"])]
    got = {r.i: (r.match, round(r.score, 9), round(r.margin, 9)) for r in jo.best_overlap(spark.createDataFrame(rows, "i int, tokens array<string>"), "i").collect()}
    want = {}
    for i, a in rows:
        scores = sorted((-len(set(a) & set(b)) / len(set(a) | set(b)), j) for j, b in rows if j != i and set(a) & set(b))
        if scores:
            want[i] = (scores[0][1], round(-scores[0][0], 9), round(-scores[0][0] + (scores[1][0] if len(scores) > 1 else 0), 9))
    assert got == want
