"""Registered queries: labels, downloads, discovery statuses, checks and the frames behind figures."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tariffa.functions import labels
from tariffa.functions import rules as ru
from tariffa.lineage import shared_folder
from tariffa.operators import checks, discovery, robots, shown
from tariffa.operators import ownership as ow
from tariffa.plans.cases import cases
from tariffa.plans.catalog import query, t
from tariffa.plans.reference import S
from tariffa.plans.reference import shown as rounded
from tariffa.sources import downloads, published, records, web

cases("region_cases", labels.region, [("TX", "South"), ("DC", "South"), ("NY", "Northeast"), ("OH", "Midwest"), ("HI", "West"), ("PR", None), ("{W}", None), (None, None)])
cases("state_name_cases", labels.state_name, [("TX", "Texas"), ("DC", "District of Columbia"), ("NH", "New Hampshire"), ("PR", None), ("{W}", None), (None, None)])
cases("fips_cases", labels.fips_state, [("01{b}", "AL"), ("02", "AK"), ("04{b}", "AZ"), ("06{b}", "CA"), ("11{b}", "DC"), ("15", "HI"), ("36{b}", "NY"), ("45", "SC"), ("53{b}", "WA"), ("56", "WY"), ("72{b}", "PR"), ("03{b}", None), (None, None)])
cases("payer_label_cases", labels.payer_label, [("self_pay_cash", "Cash price"), ("medicare_advantage", "Medicare Advantage"), ("{w}", None)])
cases("utc_cases", lambda x: labels.utc_timestamp(x.cast("timestamp")), [("2026-01-02 03:04:0{d}+02:00", "2026-01-02T01:04:0{d}Z"), ("2026-01-0{d} 03:04:05Z", "2026-01-0{d}T03:04:05Z"), (None, None)])
cases("bed_band_cases", lambda x: ru.bed_band(x.try_cast("double")), [("{d}", "<100"), ("0", "<100"), ("99", "<100"), ("100", "100-299"), ("1{d}9", "100-299"), ("299", "100-299"), ("300", "300+"), ("3{b}", "300+"), ("{w}", "unknown"), (None, "unknown")])
cases("roster_group_cases", ow.roster_group, [("Voluntary non-profit - {w}", "nonprofit"), ("Proprietary", "for_profit_non_pe"), ("Physician {d}", "for_profit_non_pe"), ("Government - {W}", "government"), ("Veterans Health Administration", "government"), ("Department of Defense", "government"), ("Tribal", "government"), ("{w}", "unknown"), ("", "unknown"), (None, "unknown")])
cases("extension_cases", downloads.url_extension, [("https://h.org/{w}.csv?x={d}", ".csv"), ("https://h.org/{w}.CSV.gz", ".csv.gz"), ("https://h.org/a.{w}.zip#{d}", ".zip"), ("https://h.org/{w}", ""), (None, None)])
cases("stem_cases", lambda x: F.substring(downloads.file_stem(x), 13, 80), [("https://h.org/a/My%20{w}_standardcharges.csv?x={d}", "_My_{w}_standardcharges"), ("https://h.org/a/{w}.json.gz", "_{w}"), ("https://{w}.org/", "_{w}.org"), ("https://h.org/{w}%zz.csv", "_{w}_zz")])
cases("encode_cases", downloads.encoded_url, [("{e}https://h.org/{w} b[{d}].csv ", "https://h.org/{w}%20b%5B{d}%5D.csv"), ("https://h.org/{w}", "https://h.org/{w}"), (None, None)])
cases("tls_cases", downloads.is_tls_error, [("SSL certificate problem {d}", "true"), ("TLS handshake failed after {b} ms", "true"), ("timed out after {b} ms", "false"), (None, "false")], "BOOLEAN")

_PAGE = "<html><body><a href='/one{k}'>One</a><div class='site-Footer'><nav><a href='two{k}.csv' aria-label='Prices'><img src='x'></a></nav><a href='#top'>Top</a></div><a href='three'>Three</a><section role='contentinfo'><p><a href='four' title='T'> </a></section></p><a href='mailto:x'>m</a><footer><a href='http://o.org/5'>Five <b>{k}</b></a></footer></body></html>"


@query("""SELECT page_id, replace(link, '{k}', page_id::VARCHAR) AS link, replace(text, '{k}', page_id::VARCHAR) AS text, in_footer FROM pages, (VALUES ('https://h{k}.org/one{k}', 'One', false), ('https://h{k}.org/d/two{k}.csv', 'Prices', true), ('https://h{k}.org/d/three', 'Three', false), ('https://h{k}.org/d/four', 'T', true), ('http://o.org/5', 'Five {k}', true)) v(link, text, in_footer) WHERE page_id % 7 <> 0""")
def footer_links(spark, sf):
    k = F.col("page_id").cast("string")
    html = F.when(F.col("page_id") % 7 != 0, F.replace(F.lit(_PAGE), F.lit("{k}"), k))
    return web.links(t(spark, sf, "pages").select("page_id", F.concat(F.lit("https://h"), k, F.lit(".org/d/x.html")).alias("url"), html.alias("html")))


@query("""WITH e AS (SELECT event_id, 'http://h' || (user_id % 40) || '.org/f' || (user_id % 300) || '.csv' AS url, [200, 404, 403, 500, NULL][(event_id % 5)::INT + 1] AS http_status, CASE event_id % 5 WHEN 4 THEN 'SSL certificate problem' END AS error, ts FROM events),
l AS (SELECT url, arg_max(struct_pack(s := http_status, e := error), ts) AS s, count(*) FILTER (error IS NOT NULL) AS tls FROM e GROUP BY 1)
SELECT url, url AS fetch_url FROM l WHERE s.s = 500 OR s.s IS NULL""")
def downloads_to_try(spark, sf):
    k = F.col("event_id")
    url = F.concat(F.lit("http://h"), (F.col("user_id") % 40).cast("string"), F.lit(".org/f"), (F.col("user_id") % 300).cast("string"), F.lit(".csv"))
    rows = t(spark, sf, "events").select(url.alias("url"), F.element_at(F.array(*(F.lit(x).cast("int") for x in (200, 404, 403, 500, None))), (k % 5 + 1).cast("int")).alias("http_status"), F.when(k % 5 == 4, "SSL certificate problem").alias("error"), F.col("ts").alias("retrieved_at"),
                                          F.when(k % 5 != 4, F.encode(F.repeat(F.lit("x"), 2000), "utf-8")).alias("content"), F.lit("csv").alias("kind"))
    return downloads.to_try(rows, downloads.recorded(rows))


@query("""WITH e AS (SELECT event_id, 'f' || (user_id % 20) AS dataset, '20' || (10 + value::INT % 10) AS release, 'u' || (event_id % 7) AS source_url, md5((event_id % 11)::VARCHAR) AS sha256, ts::VARCHAR AS downloaded_at FROM events)
SELECT dataset, release, source_url, sha256, n_versions FROM (SELECT *, count(*) OVER () AS c, row_number() OVER (PARTITION BY dataset ORDER BY release DESC, downloaded_at DESC, sha256 DESC) AS r FROM e) JOIN (SELECT dataset, count(DISTINCT sha256) AS n_versions FROM e GROUP BY 1) USING (dataset) WHERE r = 1""")
def download_provenance(spark, sf):
    k = F.col("event_id")
    rows = t(spark, sf, "events").select(F.concat(F.lit("f"), (F.col("user_id") % 20).cast("string")).alias("dataset"), F.concat(F.lit("20"), (10 + F.rint("value").cast("int") % 10).cast("string")).alias("release"), F.concat(F.lit("u"), (k % 7).cast("string")).alias("source_url"), F.md5((k % 11).cast("string")).alias("sha256"), F.col("ts").cast("string").alias("downloaded_at"))
    return downloads.provenance(rows).drop("downloaded_at")


@query("""SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'not_found' WHEN 1 THEN 'soft_404_html' WHEN 2 THEN 'ok' WHEN 3 THEN 'empty' WHEN 4 THEN 'dns_fail' ELSE 'empty' END AS status,
CASE page_id % 6 WHEN 0 THEN 'HTTP 404' WHEN 1 THEN 'a page instead of a location file' WHEN 3 THEN 'empty body' WHEN 4 THEN 'could not resolve host' WHEN 5 THEN 'no location key' END AS error_message FROM pages""")
def location_file_statuses(spark, sf):
    k = F.col("page_id") % 6
    body = F.when(k == 1, F.col("html")).when(k == 2, F.lit("location-name: A\nmrf-url: http://h/a.csv")).when(k == 5, "plain words").otherwise("")
    rows = t(spark, sf, "pages").select("page_id", F.when(k == 0, 404).when(k == 4, None).otherwise(200).alias("http_status"), F.when(k == 4, " could not  resolve host ").alias("message"), F.when(k == 1, "text/html").otherwise("text/plain").alias("content_type"), body.alias("body"), F.when(k == 2, 1).otherwise(0).alias("n_locations"))
    return discovery.text_statuses(rows).select("page_id", "status", "error_message")


@query("""WITH e AS (SELECT CASE WHEN event_id % 2 = 0 THEN 'www.' ELSE '' END || 's' || (user_id % 50) || '.org' AS domain, 's' || (user_id % 50) || '.org' AS site, CASE event_id % 3 WHEN 0 THEN 'ok' ELSE 'empty' END AS status, max(ts) AS fetched_at FROM events GROUP BY ALL)
SELECT site, domain, status FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY (status <> 'ok')::INT, (domain <> site)::INT, fetched_at DESC) AS r FROM e) WHERE r = 1""")
def apex_first(spark, sf):
    k = F.col("event_id")
    rows = t(spark, sf, "events").groupBy(F.concat(F.when(k % 2 == 0, "www.").otherwise(""), F.lit("s"), (F.col("user_id") % 50).cast("string"), F.lit(".org")).alias("domain"), F.when(k % 3 == 0, "ok").otherwise("empty").alias("status")).agg(F.max("ts").alias("fetched_at"))
    return discovery.preferred(rows).select("site", "domain", "status")


@query("""WITH d AS (SELECT s_suppkey AS domain, CASE WHEN s_suppkey % 11 = 0 THEN 'timeout' ELSE 'ok' END AS robots, s_suppkey % 7 <> 0 AS allowed, CASE WHEN s_suppkey % 5 = 0 THEN 'not_found' ELSE 'ok' END AS home FROM supplier),
l AS (SELECT p_partkey % 90 + 1 AS domain, p_partkey AS place, CASE WHEN p_partkey % 37 = 0 THEN 'file' WHEN p_partkey % 3 = 0 THEN 'price_page_robots_disallowed' WHEN p_partkey % 4 = 0 THEN 'price_page_blocked' WHEN p_partkey % 41 = 0 THEN 'file' ELSE 'no_mrf_link' END AS p, CASE WHEN p_partkey % 37 = 0 THEN 1 WHEN p_partkey % 3 <> 0 AND p_partkey % 4 <> 0 AND p_partkey % 41 = 0 THEN 2 ELSE 0 END AS n FROM part WHERE p_size < 5),
b AS (SELECT domain, sum(n) AS n_files, bool_or(p = 'no_mrf_link') AS none, arg_min(p, place) AS first, count(*) AS n FROM l GROUP BY 1),
s AS (SELECT domain, CASE WHEN robots <> 'ok' THEN robots WHEN NOT allowed THEN 'robots_disallowed' WHEN home <> 'ok' THEN home WHEN n_files > 0 THEN 'ok' WHEN n IS NULL THEN 'no_price_link' WHEN none THEN 'no_mrf_link' ELSE first END AS status, n_files FROM d LEFT JOIN b USING (domain))
SELECT domain, status, CASE WHEN status = 'ok' THEN n_files ELSE 0 END::BIGINT AS n_files FROM s""")
def footer_statuses(spark, sf):
    s, p = F.col("s_suppkey"), F.col("p_partkey")
    domains = t(spark, sf, "supplier").select(s.alias("domain"), F.when(s % 11 == 0, "timeout").otherwise("ok").alias("robots_status"), (s % 7 != 0).alias("home_allowed"), F.when(s % 5 == 0, "not_found").otherwise("ok").alias("home_status"))
    links = t(spark, sf, "part").where("p_size < 5").select((p % 90 + 1).alias("domain"), p.alias("place"), (p % 37 == 0).alias("is_data"), (p % 3 != 0).alias("page_allowed"), F.when(p % 4 == 0, "blocked").otherwise("ok").alias("page_status"), F.when(p % 41 == 0, 2).alias("n_files"))
    return discovery.footer_statuses(domains, links)


@query("""WITH c AS (SELECT c_custkey AS ccn, 'h' || (c_custkey % 60) || '.org/f' || (c_custkey % 9) || '.csv' AS key, 'https://www.h' || (c_custkey % 60) || '.org/f' || (c_custkey % 9) || '.csv?v=' || (c_custkey % 3) AS url FROM customer WHERE c_custkey % 4 <> 0)
SELECT key, min(url) AS url, count(DISTINCT ccn) AS n_ccns FROM c WHERE key NOT IN (SELECT 'h' || (s_suppkey % 60) || '.org/f' || (s_suppkey % 9) || '.csv' FROM supplier WHERE s_suppkey % 2 = 0) GROUP BY 1""")
def gap_urls(spark, sf):
    url = lambda k, head, tail: F.concat(F.lit(head), (k % 60).cast("string"), F.lit(".org/f"), (k % 9).cast("string"), F.lit(".csv"), tail)
    c, s = F.col("c_custkey"), F.col("s_suppkey")
    candidates = t(spark, sf, "customer").select(c.alias("ccn"), url(c, "https://www.h", F.concat(F.lit("?v="), (c % 3).cast("string"))).alias("mrf_url"))
    known = t(spark, sf, "supplier").where("s_suppkey % 2 = 0").select(s.alias("k"), url(s, "http://H", F.lit("")).alias("mrf_url"))
    done = known.where("k % 4 = 0").select(F.col("mrf_url").alias("url"), F.lit("ok").alias("status"))
    return discovery.gap_urls(candidates, known.where("k % 4 <> 0"), done, candidates.where("ccn % 4 = 0"))


@query("""SELECT c_custkey::VARCHAR AS url, CASE WHEN c_custkey % 7 = 0 THEN 'blocked' WHEN c_custkey % 5 = 0 OR c_custkey % 11 = 0 THEN 'failed' WHEN c_custkey % 3 = 0 THEN 'no_target_codes' ELSE 'ok' END AS status, CASE WHEN c_custkey % 11 <> 0 THEN sha256(c_custkey::VARCHAR) END AS mrf_file_id, CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_custkey END AS n_rows,
CASE WHEN c_custkey % 5 = 0 THEN 'odd bytes' WHEN c_custkey % 11 = 0 AND c_custkey % 7 <> 0 THEN 'the file id is no hash' END AS error FROM customer""")
def extraction_statuses(spark, sf):
    k = F.col("c_custkey")
    rows = t(spark, sf, "customer").select(k.cast("string").alias("url"), F.when(k % 7 == 0, 403).otherwise(200).alias("http_status"), F.when(k % 11 == 0, "short").otherwise(F.sha2(k.cast("string"), 256)).alias("mrf_file_id"), F.when(k % 3 != 0, k).alias("n_rows"), F.when(k % 5 == 0, "odd bytes").alias("error"))
    return discovery.extraction_statuses(rows)


@query("""SELECT o_custkey, mode(o_orderpriority ORDER BY o_orderpriority) AS priority FROM (SELECT o_custkey, o_orderpriority FROM orders) GROUP BY 1""".replace("mode(o_orderpriority ORDER BY o_orderpriority)", "arg_max(o_orderpriority, (n, -ascii(o_orderpriority)))").replace("(SELECT o_custkey, o_orderpriority FROM orders)", "(SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL)"))
def most_common_value(spark, sf):
    return t(spark, sf, "orders").groupBy("o_custkey").agg(F.mode("o_orderpriority", deterministic=True).alias("priority"))


_CELLS = """m AS (SELECT coalesce(st, 'US') AS state, code, insurance_type, median(price) AS median_price, count(DISTINCT unit) AS n_hospitals FROM (SELECT unnest([s_nationkey::VARCHAR, NULL]) AS st, l_returnflag AS code, ['commercial', 'medicare', 'self_pay', 'self_pay_cash'][(l_orderkey % 4)::INT + 1] AS insurance_type, l_extendedprice AS price, l_suppkey AS unit FROM lineitem JOIN supplier ON s_suppkey = l_suppkey) GROUP BY ALL)"""


def cells(spark, sf):
    line = t(spark, sf, "lineitem").join(F.broadcast(t(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")), "l_suppkey")
    kinds = F.array(*map(F.lit, ("commercial", "medicare", "self_pay", "self_pay_cash")))
    rows = line.select(F.explode(F.array(F.col("s_nationkey").cast("string"), F.lit("US"))).alias("state"), F.col("l_returnflag").alias("code"), F.element_at(kinds, (F.col("l_orderkey") % 4 + 1).cast("int")).alias("insurance_type"), "l_extendedprice", "l_suppkey")
    return rows.groupBy("state", "code", "insurance_type").agg(F.expr("percentile(l_extendedprice, 0.5D)").alias("median_price"), F.count_distinct("l_suppkey").alias("n_hospitals"))


@query(f"""WITH {_CELLS}, u AS (SELECT * FROM m WHERE state = 'US'), x AS (SELECT code, max(median_price) FILTER (insurance_type = 'self_pay') / max(median_price) FILTER (insurance_type = 'self_pay_cash') AS r, max(median_price) FILTER (insurance_type = 'medicare') AS md FROM u GROUP BY 1)
SELECT check_id, status, {S('metric', 'metric')} FROM (
SELECT 'self_pay' AS check_id, CASE WHEN count(*) FILTER (r < 0.5 OR r > 2) > 0 THEN 'warn' ELSE 'pass' END AS status, (count(*) FILTER (r < 0.5 OR r > 2))::DOUBLE AS metric FROM x
UNION ALL SELECT 'benchmark_A', CASE WHEN md / 30000 BETWEEN 0.5 AND 2 THEN 'pass' ELSE 'warn' END, md / 30000 FROM x WHERE code = 'A' UNION ALL SELECT 'benchmark_N', CASE WHEN md / 3000 BETWEEN 0.5 AND 2 THEN 'pass' ELSE 'warn' END, md / 3000 FROM x WHERE code = 'N' UNION ALL SELECT 'benchmark_Z', 'skip', NULL
UNION ALL SELECT 'states_' || code, CASE WHEN n >= 20 THEN 'pass' ELSE 'warn' END, n FROM (SELECT code, (count(*) FILTER (insurance_type = 'commercial' AND n_hospitals >= 3))::DOUBLE AS n FROM m WHERE state <> 'US' AND code IN ('A', 'R') GROUP BY 1) UNION ALL SELECT 'states_Z', 'skip', NULL
UNION ALL SELECT 'falsification', 'fail', 0.01 UNION ALL SELECT 'exports', 'warn', 1)""")
def median_checks(spark, sf):
    m = cells(spark, sf)
    rates = spark.createDataFrame([("A", 30000.0), ("N", 3000.0)], "code string, payment_rate double")
    models = spark.createDataFrame([("Placebo 2016", 0.01), ("negative control", 0.5), ("main", 0.001)], "model string, p_value double")
    audit = spark.createDataFrame([("a", "required", True, None), ("b", "required", False, None)], "file string, role string, present boolean, problem string")
    report = checks.run(spark, [
        ("self_pay", "plausibility", lambda: checks.self_pay(m, ("A", "N", "R"))), ("benchmark", "benchmark", lambda: checks.outpatient_benchmark(m, rates, ("A", "N", "Z"))),
        ("states", "coverage", lambda: checks.thin_states(m, ("A", "R", "Z"), passes=20)), ("falsification", "models", lambda: checks.falsification(models)), ("exports", "exports", lambda: checks.exports(audit)),
    ])
    return rounded(report.select("check_id", "status", "metric"), "metric")


@query(f"""WITH f AS (SELECT l_suppkey AS file_id, l_returnflag AS code, median(l_extendedprice) AS value, count(*) AS n FROM lineitem GROUP BY ALL), a(hospital, code, expected, file, same) AS (VALUES ('h1', 'A', 1.0, 2, true), ('h2', 'A', 1.0, 5, false), ('h3', 'A', 1.0, NULL, true))
SELECT 'known_' || hospital || '_' || a.code || '_median' AS check_id, CASE WHEN file IS NULL THEN 'fail' WHEN abs(value - 1) <= 0.01 THEN 'pass' WHEN NOT same THEN 'warn' ELSE 'fail' END AS status, {S('abs(value - 1)', 'metric')} FROM a LEFT JOIN f ON f.file_id = a.file AND f.code = a.code
UNION ALL SELECT 'known_h4_R_median', 'pass', 0.0000001""".replace("0.0000001", "round(1e-7, 4)"))
def known_answers(spark, sf):
    stats = t(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("file_id"), F.col("l_returnflag").alias("code")).agg(F.expr("percentile(l_extendedprice, 0.5D)").alias("value"), F.count("*").alias("n_rows"))
    yes = lambda *on: tuple(c in on for c in ("id", "date", "npi", "name", "ccn"))
    rows = [("h1", 1, *yes("npi", "date"), 10), ("h1", 2, *yes("id", "date"), 5), ("h2", 5, *yes("name"), 9), ("h2", 6, *yes("name"), 8), ("h4", 3, *yes("date"), 1)]
    files = spark.createDataFrame(rows, "hospital string, file_id long, id_match boolean, date_match boolean, npi_match boolean, name_match boolean, ccn_match boolean, n_rows long")
    answers = spark.createDataFrame([("h1", "A", 1.0), ("h2", "A", 1.0), ("h3", "A", 1.0)], "hospital string, code string, expected double")
    own = stats.where("file_id = 3 and code = 'R'").select(F.lit("h4").alias("hospital"), "code", F.col("value").alias("expected"))
    found = checks.known_answers(files, stats.withColumn("stat", F.lit("median")), answers.unionByName(own).withColumn("stat", F.lit("median")))
    return rounded(spark.createDataFrame(found, checks.SCHEMA).select("check_id", "status", "metric"), "metric")


@query("""SELECT 'payer_types' AS check_id, 'warn' AS status, round(5 / 6::DOUBLE + 1e-7, 4) AS metric UNION ALL SELECT 'types_current', 'warn', (SELECT count(*) FROM orders WHERE o_custkey % 5 = 2)::DOUBLE""")
def payer_checks(spark, sf):
    named = spark.createDataFrame([("Humana", "Medicare Advantage", "Commercial", 2), ("Aetna", "PPO", "Commercial", 2), ("Ambetter", None, "Medicaid", 1), ("Cigna", None, "Commercial", 1), ("Odd", None, "Some Label", 9)], "payer_name string, plan_name string, label string, n_rows int")
    names, stored = ("Aetna", "Medicare", "Medicaid", "Odd Club", ""), ("commercial", "medicare", "medicare", "other", "unknown")
    k = (F.col("o_custkey") % 5 + 1).cast("int")
    payers = t(spark, sf, "orders").groupBy(F.element_at(F.array(*map(F.lit, names)), k).alias("payer_name"), F.element_at(F.array(*map(F.lit, stored)), k).alias("payer_type")).agg(F.count("*").alias("n_rows")).withColumn("plan_name", F.lit(None).cast("string"))
    report = checks.run(spark, [("payer_types", "payers", lambda: checks.adjudicated(named)), ("types_current", "payers", lambda: checks.types_current(payers, ru.PAYER_RULES))])
    return rounded(report.select("check_id", "status", "metric"), "metric")


_STATE_LIST = "[" + ", ".join(f"'{s}'" for s in labels.STATES) + "]"
_SUMMARY = f"""b AS (SELECT {_STATE_LIST}[(s_suppkey % 51)::INT + 1] AS state, ['commercial', 'medicaid'][(l_orderkey % 2)::INT + 1] AS payer_type, l_extendedprice AS price, l_extendedprice / 20000 AS ratio, l_suppkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_quantity < 20),
s AS (SELECT state, payer_type, median(ratio) AS median_ratio, quantile_cont(ratio, 0.25) AS p25_ratio, quantile_cont(ratio, 0.75) AS p75_ratio, median(price) AS median_price, quantile_cont(price, 0.25) AS p25_price, quantile_cont(price, 0.75) AS p75_price, count(DISTINCT l_suppkey) < 2 AS low_n FROM b GROUP BY ALL)"""


def summary(spark, sf):
    line = t(spark, sf, "lineitem").where("l_quantity < 20")
    place = F.element_at(F.array(*map(F.lit, labels.STATES)), (F.col("l_suppkey") % 51 + 1).cast("int"))
    q = lambda c, p, n: F.expr(f"percentile({c}, {p}D)").alias(n)
    rows = line.select(place.alias("state"), F.when(F.col("l_orderkey") % 2 == 0, "commercial").otherwise("medicaid").alias("payer_type"), F.col("l_extendedprice").alias("price"), (F.col("l_extendedprice") / 20000).alias("ratio"), "l_suppkey")
    quantiles = [q(c, p, f"{n}_{c}") for c in ("ratio", "price") for p, n in ((0.5, "median"), (0.25, "p25"), (0.75, "p75"))]
    return rows.groupBy("state", "payer_type").agg(*quantiles, (F.count_distinct("l_suppkey") < 2).alias("low_n"))


@query(f"WITH {_SUMMARY} SELECT {S('least(0.5, min(median_ratio))', 'low')}, {S('greatest(2.0, max(median_ratio))', 'high')} FROM s WHERE NOT low_n")
def scale_limits(spark, sf):
    return rounded(shown.ratio_limits(summary(spark, sf), ("commercial", "medicaid")), "low", "high")


@query(f"""WITH {_SUMMARY}, l AS (SELECT least(0.5, min(median_ratio)) AS lo, greatest(2.0, max(median_ratio)) AS hi FROM s WHERE NOT low_n) SELECT place::DOUBLE AS place, regexp_replace(place::DOUBLE::VARCHAR, '\\.0$', '') || 'x' AS label FROM l, (VALUES (0.25), (0.5), (0.75), (1.0), (1.5), (2.0), (3.0), (4.0), (6.0), (8.0)) v(place) WHERE place BETWEEN lo AND hi""")
def scale_breaks(spark, sf):
    return shown.ratio_breaks(shown.ratio_limits(summary(spark, sf), ("commercial", "medicaid")))


_NAMES = ", ".join(f"('{k}', '{v}')" for k, v in labels.STATES.items())


@query(f"""WITH {_SUMMARY}, g AS (SELECT a, n, p, l FROM (VALUES {_NAMES}) v(a, n), (VALUES ('commercial', 'Commercial'), ('medicaid', 'Medicaid')) w(p, l))
SELECT n AS state_name, l AS payer, CASE WHEN NOT low_n THEN round(median_ratio + 1e-7, 4) END AS ratio, CASE WHEN low_n IS NULL THEN 'none' WHEN low_n THEN 'suppressed' ELSE 'shown' END AS why FROM g LEFT JOIN s ON state = a AND payer_type = p""")
def map_frame(spark, sf):
    return rounded(shown.map_frame(summary(spark, sf), ("commercial", "medicaid")), "ratio")


@query(f"""WITH {_SUMMARY}, r AS (SELECT *, row_number() OVER (PARTITION BY payer_type ORDER BY median_price, state)::INT AS place FROM s) SELECT payer_type, state, place, place % 2 AS band, {', '.join(S(c, c) for c in ('median_price', 'p25_price', 'p75_price'))}, CASE WHEN low_n THEN 'few' ELSE 'enough' END AS reliability FROM r""")
def rank_frame(spark, sf):
    return rounded(shown.rank_frame(summary(spark, sf), ("commercial", "medicaid")), "median_price", "p25_price", "p75_price")


_REGION_SQL = "CASE " + " ".join(f"WHEN state IN ({', '.join(repr(x) for x in v.split())}) THEN '{k}'" for k, v in labels.REGIONS.items()) + " END"


@query(f"""WITH {_SUMMARY}, r AS (SELECT *, {_REGION_SQL} AS region FROM s), f AS (SELECT state, row_number() OVER (PARTITION BY region ORDER BY median_ratio DESC, state)::INT AS place FROM r WHERE payer_type = 'commercial')
SELECT region, state, place, payer_type, {', '.join(S(f'least(greatest({c}, 0.8), 1.2)', c) for c in ('median_ratio', 'p25_ratio', 'p75_ratio'))}, low_n FROM r LEFT JOIN f USING (state)""")
def region_frame(spark, sf):
    return rounded(shown.region_frame(summary(spark, sf), ("commercial", "medicaid"), (0.8, 1.2)), "median_ratio", "p25_ratio", "p75_ratio")


@query("""SELECT c, n, series, e AS estimate, CASE WHEN NOT x THEN e - 1 END AS ci_low, CASE WHEN NOT x THEN e + 1 END AS ci_high, x AS exploratory, k AS n_clusters FROM (SELECT 'c' || (s_suppkey % 9) AS c, s_suppkey AS n, CASE WHEN s_suppkey % 2 = 0 THEN 'strict' ELSE 'broad' END AS series, s_acctbal AS e, s_suppkey % 4 = 0 AS x, s_suppkey % 10 AS k FROM supplier WHERE s_suppkey % 3 <> 0)""".replace("SELECT c, n, series", "SELECT c AS code, n::VARCHAR AS payer_type, series"))
def forest_frame(spark, sf):
    k = F.col("s_suppkey")
    models = t(spark, sf, "supplier").select(F.concat(F.lit("c"), (k % 9).cast("string")).alias("code"), k.cast("string").alias("payer_type"), F.when(k % 2 == 0, "pe_strict").otherwise("pe_broad").alias("definition"), F.lit("pe").alias("term"), F.col("s_acctbal").alias("estimate"), (F.col("s_acctbal") - 1).alias("ci_low"), (F.col("s_acctbal") + 1).alias("ci_high"), (k % 4 == 0).alias("exploratory"), (k % 3 != 0).alias("payment_comparison"), (k % 10).alias("n_group_clusters"))
    return shown.forest_frame(models, [("pe_strict", "pe", "strict"), ("pe_broad", "pe", "broad"), ("pe_strict", "for_profit_non_pe", "other")])


@query(f"""WITH a AS (SELECT o_orderpriority AS k, o_orderstatus AS s, round(sum(o_totalprice), 2) AS v FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY ALL), b AS (SELECT o_orderpriority AS k, o_orderstatus AS s, round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 2 * o_totalprice END), 2) AS v FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY ALL)
SELECT k, s, a.v AS before, b.v AS after, round(b.v - a.v + 1e-7, 2) AS change, {S('(b.v - a.v) / a.v', 'share')} FROM a FULL JOIN b USING (k, s) WHERE a.v IS DISTINCT FROM b.v""")
def rebuild_impact(spark, sf):
    o = t(spark, sf, "orders").select(F.col("o_orderpriority").alias("k"), F.col("o_orderstatus").alias("s"), "o_totalprice")
    before = o.where("k <> '5-LOW'").groupBy("k", "s").agg(F.round(F.sum("o_totalprice"), 2).alias("v"))
    after = o.where("k <> '1-URGENT'").groupBy("k", "s").agg(F.round(F.sum(F.when(F.col("s") == "F", F.col("o_totalprice")).otherwise(2 * F.col("o_totalprice"))), 2).alias("v"))
    return rounded(shown.impact(before, after, ["k", "s"], "v"), "share").withColumn("change", F.round(F.col("change") + 1e-7, 2))


#: Answers to requests for robots.txt by kind, and whether each of the paths may be read; the last kind has no answer on record.
ROBOTS_PATHS = ("", "/private/x", "/private/open?q=1#z", "/f.zip", "/f.zip?x", "/a")
ROBOTS = (
    (200, None, "User-agent: other\nUser-agent: TariffaBot\nDisallow: /private\n\nUser-agent: *\nDisallow: /\n\nuser-agent: tariffabot # again\r\nAllow: /private/open\nDisallow: /*.zip$\n", (True, False, True, False, True, True)),
    (200, None, "User-agent: *\nDisallow: /private\nDisallow:\nAllow: /\nSitemap: x", (True, False, False, True, True, True)),
    (404, None, "User-agent: *\nDisallow: /", (True, True, True, True, True, True)),
    (503, None, "User-agent: *\nAllow: /", (False, False, False, False, False, False)),
    (None, "could not resolve host", None, (False, False, False, False, False, False)),
    (200, None, "<HTML>User-agent: *\nDisallow: /", (True, True, True, True, True, True)),
    (204, None, "", (True, True, True, True, True, True)),
    (200, None, "Allow: /lost\nUser-agent: *\nDisallow: /a\nAllow: /a\nDisallow: /private*x\n", (True, False, True, True, True, True)),
    (None, None, None, (False, False, False, False, False, False)),
)


@query(f"""SELECT page_id, 'https://H' || (page_id % 90) || '.org' || {[*ROBOTS_PATHS]}[(page_id % 7 % 6)::INT + 1] AS url, {[[*kind[3]] for kind in ROBOTS]}[(page_id % 90 % 9)::INT + 1][(page_id % 7 % 6)::INT + 1] AS allowed,
CASE page_id % 90 % 9 WHEN 4 THEN 'dns_fail' WHEN 8 THEN NULL ELSE 'ok' END AS robots_status FROM pages""")
def robots_by_host(spark, sf):
    k = F.col("page_id")
    kind = F.element_at(F.array(*(F.struct(F.lit(a).cast("int").alias("http_status"), F.lit(b).cast("string").alias("message"), F.lit(c).cast("string").alias("body")) for a, b, c, _ in ROBOTS)), (k % 90 % 9 + 1).cast("int"))
    host = F.concat(F.lit("h"), (k % 90).cast("string"), F.lit(".org"))
    answers = t(spark, sf, "pages").where(k % 90 % 9 != 8).select(host.alias("host"), kind.alias("r")).select("host", "r.*").distinct()
    url = F.concat(F.lit("https://H"), (k % 90).cast("string"), F.lit(".org"), F.element_at(F.array(*map(F.lit, ROBOTS_PATHS)), (k % 7 % 6 + 1).cast("int")))
    asked = t(spark, sf, "pages").select("page_id", url.alias("url"), host.alias("host"))
    return robots.judged(asked, answers, "tariffabot/1.0").join(robots.statuses(answers), "host", "left").select("page_id", "url", "allowed", "robots_status")


@query("""SELECT l_suppkey AS file, count(*) AS n_records, count(*) FILTER (l_partkey % 3 = 0) AS n_broken, sum(l_extendedprice::DECIMAL(18, 2))::DOUBLE AS total, 0::BIGINT AS n_rejects, count(*) FILTER (l_partkey % 3 = 2) AS n_stray FROM lineitem GROUP BY 1""")
def csv_in_splits(spark, sf):
    """Lines written as CSV files with quoted breaks, commas, quotes and stray bytes, and read again as records."""
    k = F.col("l_partkey") % 3
    told = F.when(k == 0, '"say ""x"",\n\nnext,line"').when(k == 1, '"plain, comma"').otherwise("caf")
    rows = t(spark, sf, "lineitem").select(F.col("l_suppkey").alias("file"), F.concat_ws(",", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), told, F.col("l_extendedprice").cast("decimal(18,2)").cast("string")).alias("line"))
    # a byte of Windows-1252 behind the bare word
    value = F.when(F.col("line").contains(",caf,"), F.concat(F.encode(F.substring_index("line", ",caf,", 1), "utf-8"), F.encode(F.lit(",caf"), "utf-8"), F.unhex(F.lit("E9")), F.encode(F.concat(F.lit(","), F.substring_index("line", ",caf,", -1)), "utf-8"))).otherwise(F.encode("line", "utf-8"))
    folder = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    # tasks put their files in place themselves, as the driver would move one after the other
    written = rows.select("file", value.cast("string").alias("value")).repartition("file").sortWithinPartitions("file").write.partitionBy("file")
    written.option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(folder)
    found = records.records(spark, folder).withColumn("file", F.regexp_extract("path", "file=([0-9]+)", 1).cast("long"))
    cell = lambda i: F.get("cells", i)
    return found.groupBy("file").agg(
        F.count("*").alias("n_records"), F.count_if(cell(2) == 'say "x",\n\nnext,line').alias("n_broken"), F.sum(cell(3).cast("decimal(18,2)")).cast("double").alias("total"),
        (F.count("reject") + F.count_if(F.size("cells") != 4)).alias("n_rejects"), F.sum(F.when(cell(2) == "café", F.col("stray")).otherwise(-F.col("stray"))).alias("n_stray"),
    )


@query("""SELECT 'first' AS build, s_nationkey, count(*) AS n, round(sum(l_extendedprice) + 1e-7, 2) AS gross FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_linenumber < 3 GROUP BY 2
UNION ALL SELECT 'current', s_nationkey, count(*), round(sum(l_extendedprice) + 1e-7, 2) FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 2""")
def published_builds(spark, sf):
    """Lines and suppliers published twice, with a build between that its checks refuse: the first and the current one by nation."""
    root = f"{shared_folder(spark)}/store-{uuid.uuid4().hex}"
    lines, units = t(spark, sf, "lineitem").select("l_suppkey", "l_linenumber", "l_extendedprice"), t(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")

    def build(lines, units):
        checks = lambda got: {"units: repeated": published.repeated(got["units"], "l_suppkey"), "lines: unit unknown": published.orphans(got["lines"], got["units"], "l_suppkey")}
        return published.publish(spark, root, {"lines": lines, "units": units}, checks, {"lines": ["l_suppkey"]})

    first = build(lines.where("l_linenumber < 3"), units)
    build(lines, units)
    try:
        build(lines, units.where("l_suppkey % 2 = 0"))  # half of the units are gone, so this one is refused
    except published.Refused:
        pass

    def summed(name, build=None):
        got = published.read(spark, root, build)
        rows = got["lines"].join(got["units"], "l_suppkey").groupBy("s_nationkey").agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice") + 1e-7, 2).alias("gross"))
        return rows.select(F.lit(name).alias("build"), "s_nationkey", "n", "gross")

    return summed("first", first).unionByName(summed("current"))
