import pytest
from pyspark.sql import functions as F

from tariffa.operators import births, ownership
from tariffa.operators import economics as eco


def test_ownership(spark):
    hospitals = spark.createDataFrame([("1", "Proprietary"), ("2", "Voluntary non-profit - Private"), ("3", "Government - Local"), ("4", "Proprietary")], "ccn string, hospital_ownership string")
    raw = spark.createDataFrame([("e1", " Big   Capital Fund LP", "5", "60", "N"), ("e2", "Person A", "34", "100", "N"), ("e2", "Own Partners", "34", "2", "Y")], "enrollment_id string, owner_name string, role_code string, percent string, pe_flag string")
    ccns = ownership.enrollment_ccns(spark.createDataFrame([("e1", "1"), ("e1", "9"), ("e2", "2")], "enrollment_id string, ccn string"))
    rows = ownership.owners(raw).join(ccns, "enrollment_id")
    members = ownership.system_members(rows, spark.createDataFrame([("S1", "capital fund", 2), ("S0", "big", 1)], "system string, pattern string, rank int"))
    assert [(r.ccn, r.system) for r in members.collect()] == [("1", "S0")]
    none = spark.createDataFrame([], "ccn string, system_id string, classification string, ambiguity string, max_pct double")
    classes = ownership.classified(hospitals, ownership.marked(rows), none, spark.createDataFrame([("4",)], "ccn string"))
    got = {r.ccn: r for r in classes.collect()}
    assert {k: (r.group_pe_strict, r.group_fund_name, r.group_researcher_list, r.group_cms_flag_5pct) for k, r in got.items()} == {
        "1": ("for_profit_non_pe",) * 4, "2": ("cms_pe_flag", "pe", "cms_pe_flag", "nonprofit"), "3": ("government",) * 4, "4": ("for_profit_non_pe", "for_profit_non_pe", "pe", "for_profit_non_pe")}
    assert got["2"].pe_owners == "OWN PARTNERS" and got["1"].pe_owners is None and got["2"].pe_cms_max_pct == 2
    prices = spark.createDataFrame([("1", "c", "commercial", 20.0, "TX"), ("2", "c", "commercial", 10.0, "TX"), ("3", "c", "commercial", 0.0, "OK")], "ccn string, code string, payer_type string, price double, state string")
    frame = ownership.model_frame(prices, classes, spark.createDataFrame([("1", "sys", 120)], "ccn string, health_sys_id string, beds int"))
    by = {r.ccn: r for r in frame.collect()}
    assert (by["1"].cluster, by["1"].bed_band, by["2"].cluster, by["3"].log_price) == ("sys", "100-299", "ccn:2", None)
    states = ownership.within_states(frame.where("price > 0")).where("definition = 'pe_strict'").collect()
    assert [(r.group, r.median_share, r.n_states) for r in states] == []
    listed = ownership.within_states(frame.withColumn("group_pe_strict", F.when(F.col("ccn") == "1", "pe").otherwise(F.col("roster_group")))).where("definition = 'pe_strict'").collect()
    assert [(r.group, r.median_share, r.n_states) for r in listed] == [("pe", 1.0, 1)]
    with pytest.raises(ValueError):
        ownership.checked_systems(hospitals)


def test_births(spark):
    p = spark.createDataFrame([("1", "807", "medicare", 100.0), ("2", "788", "medicare", 300.0), ("2", "807", "medicare", 200.0)], "ccn string, code string, payer_type string, price double")
    s = spark.createDataFrame([("1", "540-1", "medicare", 150.0), ("1", "560-1", "medicare", 999.0), ("1", "560-2", "medicare", 9.0)], "ccn string, code string, payer_type string, price double")
    full = births.with_stand_ins(p, s)
    assert sorted((r.ccn, r.code, r.price, r.stand_in) for r in full.collect()) == [("1", "788", 150.0, True), ("1", "807", 100.0, False), ("2", "788", 300.0, False), ("2", "807", 200.0, False)]
    out = births.summary(births.premium(full), ["payer_type"], "premium").first()
    assert out.median == 1.5 and out.n == 2 and out.low_n
    places = spark.createDataFrame([("a", "c1", 30.0, -90.0, 1000), ("b", "c2", 40.0, -100.0, 500), ("c", "c3", None, None, 10)], "place string, county string, lat double, lon double, births int")
    providers = spark.createDataFrame([("p", "c1", 30.1, -90.1, 2), ("q", "c2", 45.0, -80.0, 3), ("r", "c9", 30.2, -90.0, 1), ("s", "c3", None, None, 4)], "provider string, county2 string, lat2 double, lon2 double, n int")
    got = {r.place: (r.n_providers, r.supply, r.rate) for r in births.supply(places, providers, 30, "births").collect()}
    assert got == {"a": (2, 3, 3.0), "b": (1, 3, 6.0), "c": (1, 4, 400.0)}
    near = spark.createDataFrame([("1", "x", "LA", 30.1, -90.0, 50.0), ("2", "x", "KS", 20.0, -70.0, 70.0), ("2", "y", "KS", 20.0, -70.0, 7.0)], "ccn string, payer_type string, state2 string, lat2 double, lon2 double, difference double")
    local = births.local_difference(spark.createDataFrame([("a", "LA", 30.0, -90.0), ("b", "KS", 40.0, -100.0), ("c", "ND", 47.0, -100.0)], "place string, state string, lat double, lon double"), near, 30)
    assert {(r.place, r.payer_type): (r.difference, r.level, r.n_hospitals) for r in local.collect()} == {
        ("a", "x"): (50.0, "local", 1), ("a", "y"): (None, "none", 0), ("b", "x"): (70.0, "state", 0), ("b", "y"): (7.0, "state", 0), ("c", "x"): (None, "none", 0), ("c", "y"): (None, "none", 0)}
    masked = births.covered_supply(spark.createDataFrame([("a", "LA", 3.0), ("b", "KS", 4.0)], "place string, state string, rate double"), spark.createDataFrame([("KS",)], "state string"), ["rate"])
    assert {r.place: (r.rate, r.covered) for r in masked.collect()} == {"a": (3.0, True), "b": (None, False)}


def test_curves(spark):
    rows = spark.createDataFrame([("x", 100.0)], "k string, m double")
    out = eco.threshold_curves(rows, "minutes", 0, 30, 0.5, {"plain": F.col("m") - 4 * F.col("minutes"), "none": F.lit(None).cast("double")}, ["k"])
    assert out.count() == 61 and out.where("minutes = 25").first().value == pytest.approx(0)
    r = eco.positive_counts(out, ["k"], "value").first()
    assert (r.n, r.n_positive) == (61, 50)


def test_crawl(spark):
    from tariffa.operators import crawl

    a = spark.createDataFrame([("1", "https://www.care.own.org/x", None, 0.8), ("1", "http://facebook.com/x", "care.own.org", 0.8)], "ccn string, url string, more string, s double")
    got = sorted((r.ccn, r.domain, r.seed_source, r.match_score, r.is_variant) for r in crawl.seeds([(a, "list", ["url", "more"])], "s").collect())
    assert got == [("1", "care.own.org", "list", 0.8, False), ("1", "own.org", "list", 0.8, True), ("1", "www.own.org", "list", 0.8, True)]
    ddl = "mrf_file_id string, mrf_url string, last_updated_on string"
    lake = spark.createDataFrame([("l1", "http://h/a.csv", "2026-01-01"), ("l2", "http://h/b.csv", None), ("l3", "http://h/c.csv", "2026-01-01")], ddl)
    own = spark.createDataFrame([("o1", "https://www.h/a.csv?sig=1", "2026-02-01"), ("o2", "h/b.csv", "2026-01-01"), ("o4", "h/d.csv", None)], ddl)
    assert {r.mrf_file_id for r in crawl.superseded(lake, own).collect()} == {"l1", "o2"}
    assert [r.n for r in crawl.size_queue(spark.createDataFrame([(None,), (10,), (5000,), (2000,)], "n int"), "n").collect()][:2] == [2000, 5000]
    blank = crawl.shared_urls_blank(spark.createDataFrame([("f1", "u"), ("f2", "u"), ("f3", "v")], "mrf_file_id string, mrf_url string"))
    assert {r.mrf_file_id: r.mrf_url for r in blank.collect()} == {"f1": None, "f2": None, "f3": "v"}
    texts = spark.createDataFrame([("location-name: A\nmrf-url: b", "text/plain"), ("<html>mrf-url: x", None), ("nothing", None)], "t string, c string")
    assert [r.x for r in texts.select(crawl.looks_like_location_file(F.col("t")).alias("x")).collect()] == [True, False, False]
