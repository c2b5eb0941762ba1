"""Further registered queries: store, benchmarks, supply, models, checks, pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tariffa import schema as sc
from tariffa.functions import rules
from tariffa.functions import text as tx
from tariffa.operators import aggregates as agg
from tariffa.operators import checks, inference, matching
from tariffa.operators import economics as eco
from tariffa.operators import joins as jo
from tariffa.operators import store as st
from tariffa.operators import windows as win
from tariffa.plans.catalog import CHARGES, charges, query, r2, t
from tariffa.sources import web


def price_rows(spark, sf):
    """Lines as a canonical price table."""
    line = t(spark, sf, "lineitem").join(t(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    line = line.join(t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    return sc.conform(line.select(
        F.lit("lake").alias("source"), F.md5(F.col("l_suppkey").cast("string")).alias("mrf_file_id"), F.concat(F.lit("http://host/"), F.col("l_suppkey").cast("string")).alias("mrf_url"),
        F.concat(F.lit("k"), (F.col("l_partkey") % 20).cast("string")).alias("concept"), (F.col("l_partkey") % 20).cast("string").alias("code"), F.lit("TX").alias("license_state"), F.lit("H").alias("hospital_name"),
        F.when(F.col("l_returnflag") == "R", "Inpatient ").otherwise("OUTPATIENT").alias("setting"), F.when(F.col("l_linestatus") == "F", "facility").when(F.col("l_linenumber") < 3, "professional").alias("billing_class"),
        F.col("l_extendedprice").alias("gross"), (F.col("l_extendedprice") * (1 - F.col("l_tax"))).alias("discounted_cash"), F.when(F.col("l_linenumber") % 7 != 0, F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("negotiated_dollar"),
        F.when(F.col("l_linenumber") % 5 != 0, F.col("c_mktsegment")).alias("payer_name"), F.lit("fee schedule").alias("methodology"), F.col("l_linenumber").cast("string").alias("description"),
    ))


def built(spark, sf):
    rows = price_rows(spark, sf)
    roster = t(spark, sf, "supplier").select(F.lpad(F.col("s_suppkey").cast("string"), 6, "0").alias("ccn"))
    cross = t(spark, sf, "supplier").where("s_suppkey % 9 <> 0").select(F.md5(F.col("s_suppkey").cast("string")).alias("mrf_file_id"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0").alias("ccn"), F.lit("npi").alias("ccn_match_method"), F.lit(0.9).alias("ccn_match_score"), F.lit(False).alias("ccn_ambiguous"), (F.col("s_suppkey") % 11 == 0).alias("ccn_conflict"))
    return st.build(rows, cross, roster, outpatient=["k3", "k5"]), rows


@query("""WITH x AS (SELECT l_suppkey, (l_partkey % 20)::VARCHAR AS code, CASE WHEN l_returnflag = 'R' THEN 'inpatient' ELSE 'outpatient' END AS setting,
CASE WHEN l_linestatus = 'F' THEN 'facility' WHEN l_linenumber < 3 THEN 'professional' ELSE 'unknown' END AS billing_class, l_extendedprice AS gross,
CASE WHEN l_linenumber % 7 <> 0 THEN l_extendedprice * (1 - l_discount) END AS rate, CASE WHEN l_linenumber % 5 <> 0 THEN c_mktsegment END AS payer
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey),
f AS (SELECT code, billing_class, l_suppkey, min(gross) AS least FROM x WHERE billing_class IN ('facility', 'professional') AND setting <> 'inpatient' AND gross > 1 GROUP BY ALL),
m AS (SELECT code, billing_class, median(least) AS g, count(*) AS n FROM f GROUP BY ALL),
w AS (SELECT code, max(g) FILTER (WHERE billing_class = 'facility') AS fg, max(n) FILTER (WHERE billing_class = 'facility') AS fn, max(g) FILTER (WHERE billing_class = 'professional') AS pg, max(n) FILTER (WHERE billing_class = 'professional') AS pn FROM m GROUP BY code),
c AS (SELECT code, fg, pg, CASE WHEN fn >= 20 AND pn >= 20 AND fg >= 2.5 * pg THEN sqrt(fg * pg) END AS cut FROM w),
y AS (SELECT x.*, fg, pg, coalesce(billing_class = 'unknown' AND gross > 1 AND cut IS NOT NULL, false) AS inferred, CASE WHEN billing_class IN ('professional', 'facility') THEN billing_class WHEN gross > 1 AND gross < cut THEN 'professional' ELSE 'facility' END AS fee_type,
coalesce(rate > 1 AND rate < 2000000 AND NOT regexp_matches(CAST(TRY_CAST(rate AS DECIMAL(18,2)) AS VARCHAR), '^9{5,}([.](9+|0+))?$'), false) AS plausible FROM x LEFT JOIN c USING (code))
SELECT setting, billing_class, fee_type, inferred, plausible, coalesce(code IN ('3', '5') AND gross > 10 * CASE WHEN fee_type = 'professional' THEN pg ELSE fg END, false) AS case_line, payer IS NULL AS no_payer, count(*)::BIGINT AS n, round(sum(rate) + 1e-7, 0) AS total FROM y GROUP BY ALL""")
def star_schema_facts(spark, sf):
    s, _ = built(spark, sf)
    return s.fact.groupBy("setting", "billing_class", "fee_type", F.col("fee_type_inferred").alias("inferred"), "plausible", "case_line", F.col("payer_id").isNull().alias("no_payer")).agg(F.count("*").alias("n"), F.round(F.sum("negotiated_dollar") + 1e-7, 0).alias("total"))


@query("""SELECT CASE WHEN s_suppkey % 9 = 0 OR s_suppkey % 11 = 0 THEN 'file' ELSE lpad(s_suppkey::VARCHAR, 6, '0') END AS unit, count(*)::BIGINT AS n FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1""")
def hospital_rate_units(spark, sf):
    s, _ = built(spark, sf)
    return s.hospital_rates().groupBy(F.when(F.col("ccn").isNull(), "file").otherwise(F.col("ccn")).alias("unit")).agg(F.count("*").alias("n"))


@query(f"""WITH {CHARGES}, u AS (SELECT l_suppkey, state, median(rate) FILTER (WHERE l_returnflag = 'A') AS a, median(rate) FILTER (WHERE l_returnflag = 'N') AS b FROM charges GROUP BY ALL),
p AS (SELECT state, a / b AS premium FROM u WHERE a IS NOT NULL AND b > 0) SELECT state, round(median(premium) + 1e-9, 4) AS premium, count(*)::BIGINT AS n FROM p GROUP BY state HAVING count(*) >= 2""")
def within_hospital_premium(spark, sf):
    units = agg.median(charges(spark, sf).where("l_returnflag in ('A', 'N')"), ["l_suppkey", "state", "l_returnflag"], "rate", "price")
    both = units.groupBy("l_suppkey", "state").pivot("l_returnflag", ["A", "N"]).agg(F.first("price")).where("A is not null and N > 0")
    out = agg.median(both.withColumn("premium", F.col("A") / F.col("N")), ["state"], "premium", "premium", "n").where("n >= 2")
    return out.withColumn("premium", F.round(F.col("premium") + 1e-9, 4))


@query(f"""WITH {CHARGES}, u AS (SELECT l_suppkey, state, median(rate) AS price FROM charges GROUP BY ALL), s AS (SELECT state, l_suppkey % 7 AS sys, avg(price) AS price, count(*) AS n FROM u GROUP BY ALL)
SELECT state, round(median(price) + 1e-7, 2) AS median, count(*)::BIGINT AS n_systems, sum(n)::BIGINT AS n_units, count(*) < 5 AS low_n FROM s GROUP BY state""")
def system_weighted(spark, sf):
    units = agg.median(charges(spark, sf), ["l_suppkey", "state"], "rate", "price")
    systems = units.groupBy("state", (F.col("l_suppkey") % 7).alias("sys")).agg(F.avg("price").alias("price"), F.count("*").alias("n"))
    level = F.expr("percentile(price, 0.5D)")
    return systems.groupBy("state").agg(r2(level).alias("median"), F.count("*").alias("n_systems"), F.sum("n").alias("n_units"), (F.count("*") < 5).alias("low_n"))


@query("""WITH w AS (SELECT s_suppkey, CASE WHEN s_suppkey % 4 <> 0 THEN 0.8 + (s_suppkey % 50) / 100.0 END AS wi, s_nationkey FROM supplier), r AS (SELECT n_nationkey, 0.9 + n_regionkey / 50.0 AS rural FROM nation)
SELECT s_suppkey, round(1000 * (0.6 * coalesce(wi, rural) + 0.4) + 1e-7, 3)::DOUBLE AS opps, round((4000 * coalesce(wi, rural) + 2000 + 500 * pow(coalesce(wi, rural), 0.6848)) * 1.25 + 1e-7, 3)::DOUBLE AS ipps FROM w JOIN r ON n_nationkey = s_nationkey""")
def wage_benchmarks(spark, sf):
    k = F.col("s_suppkey")
    w = t(spark, sf, "supplier").select("s_suppkey", F.when(k % 4 != 0, 0.8 + (k % 50) / 100.0).alias("wi"), "s_nationkey")
    w = w.join(t(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), (0.9 + F.col("n_regionkey") / 50.0).alias("rural")), "s_nationkey")
    wi, f = F.coalesce("wi", "rural"), F.lit
    return w.select("s_suppkey", r2(eco.wage_adjusted(f(1000.0), wi), 3).alias("opps"), r2(eco.stay_payment(f(1.25), wi, f(4000.0), f(2000.0), f(500.0)), 3).alias("ipps"))


@query("""WITH p AS (SELECT s_suppkey, s_nationkey, 25 + (s_suppkey * 7919 % 2500) / 100.0 AS lat, -120 + (s_suppkey * 104729 % 4000) / 100.0 AS lon, s_acctbal FROM supplier), n AS (SELECT n_nationkey, 25 + (n_nationkey * 97 % 25) AS lat, -120 + (n_nationkey * 61 % 40) AS lon FROM nation),
d AS (SELECT n_nationkey, s_suppkey, s_acctbal FROM n, p WHERE s_nationkey = n_nationkey OR 2 * 3958.8 * asin(least(1, sqrt(pow(sin(radians(p.lat - n.lat) / 2), 2) + cos(radians(n.lat)) * cos(radians(p.lat)) * pow(sin(radians(p.lon - n.lon) / 2), 2)))) <= 150)
SELECT n_nationkey, count(s_suppkey)::BIGINT AS n_supply, round(coalesce(sum(s_acctbal), 0) + 1e-7, 2) AS supply FROM nation LEFT JOIN d USING (n_nationkey) GROUP BY 1""")
def supply_within_radius(spark, sf):
    k = F.col("s_suppkey")
    p = t(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal", (25 + (k * 7919 % 2500) / 100.0).alias("lat2"), (-120 + (k * 104729 % 4000) / 100.0).alias("lon2"))
    j = F.col("n_nationkey")
    n = t(spark, sf, "nation").select("n_nationkey", (25 + (j * 97 % 25)).cast("double").alias("lat"), (-120 + (j * 61 % 40)).cast("double").alias("lon"))
    near = jo.within_radius(n, p, 150).select("n_nationkey", "s_suppkey", "s_acctbal")
    own = p.select(F.col("s_nationkey").alias("n_nationkey"), "s_suppkey", "s_acctbal")
    found = near.unionByName(own).dropDuplicates(["n_nationkey", "s_suppkey"])
    sums = found.groupBy("n_nationkey").agg(F.count("*").alias("n_supply"), F.sum("s_acctbal").alias("supply"))
    out = n.select("n_nationkey").join(sums, "n_nationkey", "left").fillna(0, ["n_supply", "supply"])
    return out.select("n_nationkey", "n_supply", r2("supply"))


@query("""SELECT o_custkey, min(o_orderpriority) AS label, max(o_orderdate)::DATE AS last, count(*)::BIGINT AS n, count(DISTINCT o_orderstatus) > 1 AS mixed,
CASE WHEN count(*) < 10 THEN '<10' WHEN count(*) < 15 THEN '10-14' ELSE '15+' END AS band FROM orders GROUP BY 1""")
def file_dimension(spark, sf):
    out = t(spark, sf, "orders").groupBy("o_custkey").agg(F.min("o_orderpriority").alias("label"), F.to_date(F.max("o_orderdate")).alias("last"), F.count("*").alias("n"), (F.count_distinct("o_orderstatus") > 1).alias("mixed"))
    return out.withColumn("band", rules.banded(F.col("n"), ((10, "<10"), (15, "10-14")), "15+"))


@query("""SELECT c_mktsegment, round(avg(CASE WHEN c_acctbal > 0 THEN 1.0 ELSE 0.0 END) + 1e-9, 6)::DOUBLE AS metric, CASE WHEN avg(CASE WHEN c_acctbal > 0 THEN 1.0 ELSE 0.0 END) >= 0.92 THEN 'pass' WHEN avg(CASE WHEN c_acctbal > 0 THEN 1.0 ELSE 0.0 END) >= 0.90 THEN 'warn' ELSE 'fail' END AS status FROM customer GROUP BY 1""")
def graded_shares(spark, sf):
    s = agg.share(F.col("c_acctbal") > 0)
    return t(spark, sf, "customer").groupBy("c_mktsegment").agg((F.round(s + 1e-9, 6)).alias("metric"), rules.grade(s, 0.92, 0.90).alias("status"))


@query("""WITH i(price_index, year, level) AS (VALUES ('cpi', 2020, 100.0), ('cpi', 2021, 110.0), ('cpi', 2022, 121.0))
SELECT p_partkey, round(p_retailprice * 121.0 / level + 1e-7, 2)::DOUBLE AS value FROM part JOIN i ON year = 2020 + p_partkey % 3""")
def inflated_values(spark, sf):
    index = spark.createDataFrame([("cpi", 2020, 100.0), ("cpi", 2021, 110.0), ("cpi", 2022, 121.0)], "price_index string, year long, level double")
    values = t(spark, sf, "part").select("p_partkey", F.lit("cpi").alias("price_index"), (2020 + F.col("p_partkey") % 3).alias("dollar_year"), F.col("p_retailprice").alias("value"))
    return eco.inflated(values, index, 2022).select("p_partkey", r2("value"))


@query("""WITH q AS (SELECT l_suppkey, l_partkey, l_orderkey, count(*) OVER (PARTITION BY l_suppkey, l_partkey) AS n FROM lineitem) SELECT l_suppkey, l_partkey, min(l_orderkey) AS first_order, max(n)::BIGINT AS n FROM q WHERE n > 1 GROUP BY ALL""")
def repeated_keys(spark, sf):
    g = t(spark, sf, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.min("l_orderkey").alias("first_order"), F.count("*").alias("n"))
    return g.where("n > 1")


@query("""SELECT host, page_id, (row_number() OVER (PARTITION BY host ORDER BY page_id))::INT AS turn FROM (SELECT page_id, regexp_replace(regexp_extract(lower(url), '^[a-z]+://([^/:?#]+)', 1), '^www[0-9]*\\.', '') AS host FROM pages)""".replace("\\\\", "\\"))
def polite_queue(spark, sf):
    return win.interleaved(t(spark, sf, "pages").select(tx.site(F.col("url")).alias("host"), "page_id"), "host", [F.col("page_id")])


@query()
def html_links(spark, sf):
    return web.links(t(spark, sf, "pages"))


@query()
def ols_cluster_cell(spark, sf):
    units = charges(spark, sf).groupBy("l_returnflag", "l_suppkey", "payer", "n_regionkey").agg(F.avg("rate").alias("price"))
    return inference.with_flags(inference.group_models(units, ["l_returnflag"], "price", "payer", "BUILDING", "l_suppkey", ["n_regionkey"]))


@query()
def wild_bootstrap_cell(spark, sf):
    units = charges(spark, sf).groupBy("l_returnflag", "l_suppkey", "payer").agg(F.avg("rate").alias("price"))
    return inference.group_models(units, ["l_returnflag"], "price", "payer", "BUILDING", "l_suppkey", draws=inference.BOOTSTRAPS)


@query()
def validation_report(spark, sf):
    s, rows = built(spark, sf)
    return checks.run(spark, [
        ("fact_keys", "keys", lambda: checks.fact_keys(s)), ("dim_keys", "keys", lambda: checks.dim_keys(s)), ("bridge", "keys", lambda: checks.bridge(s)), ("row_counts", "load", lambda: checks.row_counts(s, rows)),
        ("file_ids", "load", lambda: checks.file_ids(s)), ("plausibility", "rates", lambda: checks.plausibility(s)), ("files_above_gross", "rates", lambda: checks.files_above_gross(s)),
    ])


@query()
def facility_match(spark, sf):
    """Suppliers as a roster, and facilities with abbreviated copies of their names and addresses."""
    k = F.col("s_suppkey")
    name = F.concat(F.col("s_name"), F.lit(" Regional Hospital"))
    address = F.concat((100 + k).cast("string"), F.lit(" Oak Street"))
    roster = t(spark, sf, "supplier").select(F.lpad(k.cast("string"), 6, "0").alias("ccn"), name.alias("name"), address.alias("address"), F.concat(F.lit("City "), (k % 40).cast("string")).alias("city"), F.element_at(F.array(F.lit("TX"), F.lit("OK"), F.lit("NM")), (k % 3 + 1).cast("int")).alias("state"), F.lpad((10000 + k % 500).cast("string"), 5, "0").alias("zip"))
    none = F.lit(None).cast("string")
    facilities = roster.select(F.col("ccn").alias("facility_key"), none.alias("mrf_url"), F.regexp_replace("name", "Hospital", "Hosp").alias("name"), none.alias("location_name"), F.concat_ws(", ", F.regexp_replace("address", "Street", "St"), "city", F.concat_ws(" ", "state", "zip")).alias("address"), "city", "state", none.alias("license"), none.alias("type_2_npi"))
    empty = lambda ddl: spark.createDataFrame([], ddl)
    return matching.resolved(facilities, matching.profiles(roster), empty("url_key string, ccn string"), empty("npi string, ccn string"), empty("license_key string, state string, ccn string"))
