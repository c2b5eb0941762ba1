"""Registered queries: a crosswalk brought up to date, exports audited, supply around hospitals from a roster.

A supplier stands for a hospital, a customer for a facility record, for an export whose rows are the customer's orders
or for a ZIP; an order for a person of the roster.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tariffa.operators import births, crosswalk, exports, matching
from tariffa.plans.catalog import query, r2, t
from tariffa.sources import rosters


def _matching_inputs(spark, sf, version: int):
    """Facilities, profiles and the three maps. In the second version some names, addresses, numbers and hospitals differ."""
    s, c = F.col("s_suppkey"), F.col("c_custkey")
    later = version == 2
    ccn = F.lpad(s.cast("string"), 6, "0")
    state = F.element_at(F.array(*map(F.lit, ("TX", "OK", "NM", "CO", "UT"))), (F.col("s_nationkey") % 5 + 1).cast("int"))
    base = t(spark, sf, "supplier").where(s % 37 != 0 if later else s % 41 != 0)  # a few hospitals close, others open
    name = F.concat("s_name", F.when((s % 29 == 0) & F.lit(later), " Womens").otherwise(" Regional"), F.lit(" Hospital"))
    roster = base.select(ccn.alias("ccn"), name.alias("name"), F.concat((100 + s).cast("string"), F.lit(" Oak Street")).alias("address"), F.concat(F.lit("City "), (s % 40).cast("string")).alias("city"), state.alias("state"), F.lpad((10000 + s % 500).cast("string"), 5, "0").alias("zip"))
    url_map = base.where(s % 3 == 0).select(F.concat(F.lit("host"), s.cast("string"), F.lit(".org/f.csv")).alias("url_key"), ccn.alias("ccn"))
    npi_map = base.where(s % 4 == 0).select(F.concat(F.lit("1"), F.lpad(s.cast("string"), 9, "0")).alias("npi"), F.when((s % 31 == 0) & F.lit(later), F.lit("000001")).otherwise(ccn).alias("ccn"))
    license_map = base.where(s % 5 == 0).select(F.concat(s.cast("string"), F.lit("L")).alias("license_key"), F.lit(None).cast("string").alias("state"), ccn.alias("ccn"))
    none = F.lit(None).cast("string")
    target = F.when((c % 17 == 0) & F.lit(later), c % 50 + 3).otherwise(c % 90 + 1)  # some records name another hospital now
    made = t(spark, sf, "customer").where(c % 43 != 0 if later else c % 47 != 0).select(
        c.cast("string").alias("facility_key"), target.alias("__t"),
        F.concat(F.lit("https://www.host"), target.cast("string"), F.lit(".org/f.csv")).alias("mrf_url"), none.alias("name"), none.alias("location_name"), none.alias("address"), none.alias("city"), none.alias("state"),
        F.concat(F.lit("00"), target.cast("string"), F.lit("-l")).alias("license"), F.concat(F.lit("1"), F.lpad(target.cast("string"), 9, "0")).alias("type_2_npi"),
    )
    return made.drop("__t"), matching.profiles(roster), url_map, npi_map, license_map


def _expected(version: int) -> str:
    """SQL of facility, hospital and tier: the tiers by the keys that the inputs are made with."""
    later = version == 2
    target = "CASE WHEN c_custkey % 17 = 0 THEN c_custkey % 50 + 3 ELSE c_custkey % 90 + 1 END" if later else "c_custkey % 90 + 1"
    gone, skipped = (37, 43) if later else (41, 47)
    npi = "CASE WHEN k % 31 = 0 THEN 1 ELSE k END" if later else "k"
    return f"""SELECT facility_key, u, n, CASE WHEN u = n THEN 'mrf_url+npi' WHEN u IS NOT NULL THEN 'mrf_url' WHEN n IS NOT NULL THEN 'npi' WHEN l IS NOT NULL THEN 'license' END AS method, coalesce(u, n, l) AS ccn
FROM (SELECT c_custkey::VARCHAR AS facility_key, CASE WHEN k % 3 = 0 THEN k END AS u, CASE WHEN k % 4 = 0 THEN {npi} END AS n, CASE WHEN k % 5 = 0 AND h THEN k END AS l
FROM (SELECT c_custkey, {target} AS k, k IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % {gone} <> 0) AS h FROM customer WHERE c_custkey % {skipped} <> 0) WHERE h)"""


@query(f"""WITH e AS ({_expected(2)}) SELECT facility_key, lpad(ccn::VARCHAR, 6, '0') AS ccn, method AS ccn_match_method, false AS ccn_ambiguous, coalesce(u <> n, false) AS ccn_conflict FROM e WHERE method IS NOT NULL""")
def crosswalk_by_changes(spark, sf):
    """The second version's matches: what changed since the first is matched, the rest carried over."""
    first = crosswalk.updated(None, *_matching_inputs(spark, sf, 1)).kept()
    return crosswalk.updated(first, *_matching_inputs(spark, sf, 2)).matches.drop("ccn_match_score")


@query(f"""WITH a AS ({_expected(1)}), b AS ({_expected(2)}), x AS (SELECT facility_key, ccn FROM a WHERE method IS NOT NULL), y AS (SELECT facility_key, ccn FROM b WHERE method IS NOT NULL)
SELECT CASE WHEN x.ccn IS NULL THEN 'found' WHEN y.ccn IS NULL THEN 'lost' ELSE 'moved' END AS change, count(*)::BIGINT AS n FROM x FULL JOIN y USING (facility_key) WHERE x.ccn IS DISTINCT FROM y.ccn GROUP BY 1""")
def crosswalk_moves(spark, sf):
    first = crosswalk.updated(None, *_matching_inputs(spark, sf, 1)).kept()
    second = crosswalk.updated(first, *_matching_inputs(spark, sf, 2)).kept()
    return crosswalk.moves(first.matches, second.matches).groupBy("change").agg(F.count("*").alias("n"))


_OTHER_BY = "c_custkey % 13 = 0"


@query(f"""WITH o AS (SELECT o_custkey AS c_custkey, count(*) AS n, count(DISTINCT o_orderkey % 12) AS g FROM orders GROUP BY 1),
f AS (SELECT c_custkey, c_custkey % 10 <> 0 AS present, c_custkey % 23 <> 0 AS parses, c_custkey % 11 <> 0 AS noted, CASE WHEN c_custkey % 2 = 0 THEN 'County' ELSE 'State' END AS place, c_custkey % 5 <> 0 AS has, c_custkey % 7 <> 0 AS filtered,
coalesce(n, 0) AS n, coalesce(g, 0) AS g FROM customer LEFT JOIN o USING (c_custkey)),
p AS (SELECT *, nullif(concat_ws('; ', CASE WHEN NOT noted THEN 'no notes' END,
CASE WHEN noted AND {_OTHER_BY} THEN 'grouped by [' || place || ' of Residence; Year], not [' || CASE WHEN place = 'County' THEN 'County of Residence; Delivery Method' ELSE 'Delivery Method; State of Residence' END || ']' END,
CASE WHEN noted AND c_custkey % 17 = 0 THEN 'years [2023, 2024], not [2022, 2023, 2024]' END,
CASE WHEN noted AND has AND NOT filtered THEN 'filtered, but must hold all births' WHEN noted AND NOT has AND filtered THEN 'filters absent or not complete' END,
CASE WHEN noted AND c_custkey % 19 = 0 THEN 'dataset Natality, 2007-2024, not expanded' END,
CASE WHEN n = 0 THEN 'no rows' END, CASE WHEN place = 'County' AND g < 8 THEN 'only ' || g || ' of County, less than 8' WHEN place = 'State' AND g < 4 THEN 'only ' || g || ' of State, less than 4' END), '') AS wrong FROM f)
SELECT c_custkey AS key, present, CASE WHEN present AND parses THEN n::INT END AS rows, CASE WHEN present AND parses THEN g::INT END AS n_geo, CASE WHEN present AND parses AND noted THEN CASE WHEN c_custkey % 19 = 0 THEN 'Natality, 2007-2024' ELSE 'Natality, 2016-2024 expanded' END END AS dataset,
CASE WHEN NOT present THEN 'missing, ' || CASE WHEN c_custkey % 3 = 0 THEN 'required' ELSE 'check' END WHEN NOT parses THEN 'no column Births' ELSE wrong END AS problem FROM p""")
def export_audit(spark, sf):
    """An export for each customer with the orders as rows; by the key one lacks its notes, is grouped otherwise, has other years and so on."""
    k = F.col("c_custkey")
    rows = t(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.concat(F.lit('\t"Place"\t"'), (F.col("o_orderkey") % 12).cast("string"), F.lit('"\t1\t'), F.col("o_orderkey").cast("string")).alias("row"))
    rows = rows.groupBy("c_custkey").agg(F.array_join(F.array_sort(F.collect_list("row")), "\n").alias("rows"))  # an export's few rows
    place = F.when(k % 2 == 0, "County").otherwise("State")
    line = lambda *parts: F.concat(F.lit('"'), *(p if not isinstance(p, str) else F.lit(p) for p in parts), F.lit('"'))
    head = F.concat(F.lit('"Notes"\t"'), place, F.lit(' of Residence"\t"'), place, F.lit(' of Residence Code"\t"Delivery Method"\t"'), F.when(k % 23 == 0, "Deaths").otherwise("Births"), F.lit('"'))
    filters = F.lit('"Live Birth Order: 1"\n"Plurality: Single"\n"Fetal Presentation: Cephalic"\n"OE Gestational Age Recode 11: 37-38 weeks; 39 weeks; 40 weeks; 41 weeks; 42 weeks or more"')
    notes = F.concat_ws("\n", F.lit('"---"'), line("Dataset: Natality, ", F.when(k % 19 == 0, "2007-2024").otherwise("2016-2024 expanded")), F.when(k % 5 != 0, filters).otherwise('"Plurality: Single"'), line("Year: ", F.when(k % 17 == 0, "2023; 2024").otherwise("2022; 2023; 2024")),
                        line("Group By: ", place, " of Residence; ", F.when(k % 13 == 0, "Year").otherwise("Delivery  Method")), F.lit('"---"'))
    total = F.lit('"Total"\t\t\t\t9')
    named = t(spark, sf, "customer").select("c_custkey").join(rows, "c_custkey", "left")
    text = F.concat_ws("\n", head, "rows", total, F.when(k % 11 != 0, notes))
    content = F.when(k % 2 == 0, F.replace(text, F.lit("\n"), F.lit("\r\n"))).otherwise(text)
    files = named.where(k % 10 != 0).select(F.concat(k.cast("string"), F.lit(".txt")).alias("file"), content.alias("content")).withColumn("sha256", F.sha2("content", 256))
    spec = named.select(k.alias("key"), F.concat(k.cast("string"), F.lit(".txt")).alias("file"), F.when(k % 3 == 0, "required").otherwise("check").alias("role"), F.concat(place, F.lit(" of Residence; Delivery Method")).alias("group_by"), F.lit("2022-2024").alias("years"), (k % 7 != 0).alias("filtered"))
    return exports.audit(files, spec, least={"County": 8, "State": 4}).select("key", "present", "rows", "n_geo", "dataset", "problem")


#: States of made counties, bands of longitude from west to east; the roster covers all but the last. The data has no places.
_STATES = ("48", "35", "08", "40", "49")
_LAT, _LON = "25 + (k * 7919 % 2500) / 100.0", "-120 + (k * 104729 % 4000) / 100.0"
_BAND = "least(floor((lon + 120) * 1.5), 59)"
_COVERED = ("TX", "NM", "CO", "OK")


@query(f"""WITH z AS (SELECT lpad(k::VARCHAR, 5, '0') AS zip, {_LAT} AS lat, {_LON} AS lon, k, bal FROM (SELECT c_custkey AS k, c_acctbal AS bal FROM customer)),
part AS (SELECT zip, {list(_STATES)}[j // 12 + 1] || lpad(j::VARCHAR, 3, '0') AS county, land FROM (SELECT zip, unnest([j, (j + 1) % 60, (j + 2) % 60]) AS j, unnest([k % 5, k % 4, k % 3]) AS land FROM (SELECT *, {_BAND}::INT AS j FROM z))),
zc AS (SELECT zip, first(county ORDER BY land DESC, county) AS county FROM part GROUP BY 1),
c AS (SELECT {list(_STATES)}[j // 12 + 1] || lpad(j::VARCHAR, 3, '0') AS county, 100 * n AS births, lat, lon FROM (SELECT {_BAND}::INT AS j, count(*) AS n, min(lat) AS lat, min(lon) AS lon FROM z GROUP BY 1)),
person AS (SELECT npi, min(zip) AS zip FROM (SELECT o_orderkey - o_orderkey % 2 AS npi, lpad(o_custkey::VARCHAR, 5, '0') AS zip FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderstatus <> 'P' AND o_orderkey % 11 <> 0) GROUP BY 1),
w AS (SELECT lat, lon FROM person JOIN z USING (zip)),
bc AS (SELECT lat, lon FROM z WHERE bal < -900),
un AS (SELECT lat, lon FROM z JOIN zc USING (zip) WHERE county[1:2] = '49'),
h AS (SELECT s_suppkey AS place, zc.county, lat, lon FROM supplier JOIN z ON zip = lpad((s_suppkey * 13 % 150 + 1)::VARCHAR, 5, '0') LEFT JOIN zc USING (zip)),
d(place, kind, county, births, far) AS (SELECT place, kind, x.county, births, 2 * 3958.8 * asin(least(1, sqrt(pow(sin(radians(x.lat - h.lat) / 2), 2) + cos(radians(h.lat)) * cos(radians(x.lat)) * pow(sin(radians(x.lon - h.lon) / 2), 2))))
FROM h, (SELECT 'w' AS kind, NULL AS county, 0 AS births, lat, lon FROM w UNION ALL SELECT 'bc', NULL, 0, lat, lon FROM bc UNION ALL SELECT 'un', NULL, 0, lat, lon FROM un UNION ALL SELECT 'c', county, births, lat, lon FROM c) x),
g AS (SELECT h.place, count(*) FILTER (kind = 'un' AND far <= 60) = 0 AS covered, count(*) FILTER (kind = 'w' AND far <= 60) AS n, count(*) FILTER (kind = 'bc' AND far <= 60) AS n_centers, min(far) FILTER (kind = 'bc') AS nearest, coalesce(sum(births) FILTER (kind = 'c' AND (far <= 60 OR d.county = h.county)), 0)::BIGINT AS births FROM h LEFT JOIN d USING (place) GROUP BY 1)
SELECT place, covered, CASE WHEN covered THEN n END AS n_providers, births, n_centers, round(nearest + 1e-7, 3) AS nearest_center, CASE WHEN births > 0 AND covered THEN round(1000.0 * n / births + 1e-7, 3) END AS providers_per_1k FROM g""")
def roster_supply(spark, sf):
    """Persons of a roster, births and centres around hospitals at their ZIPs' points, counties by the largest share of a ZIP's land."""
    k, o = F.col("k"), F.col("o_orderkey")
    z = t(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("bal")).select("k", "bal", F.lpad(k.cast("string"), 5, "0").alias("zip"), F.expr(_LAT).alias("lat"), F.expr(_LON).alias("lon"))
    county = lambda j: F.concat(F.element_at(F.array(*map(F.lit, _STATES)), F.floor(j / 12).cast("int") + 1), F.lpad(j.cast("string"), 3, "0"))
    gazetteer = z.select(F.concat("zip", F.lit(" ")).alias("GEOID "), F.col("lat").cast("string").alias("INTPTLAT"), F.concat(F.lit(" "), F.col("lon").cast("string")).alias(" INTPTLONG"))
    points = rosters.points(gazetteer)
    j = F.expr(_BAND).cast("int")
    shares = z.select("zip", F.explode(F.array(*(F.struct(county((j + n) % 60).alias("county_fips"), (k % m).alias("land")) for n, m in ((0, 5), (1, 4), (2, 3))))).alias("s")).select("zip", "s.*")
    homes = rosters.county_of_zip(shares)
    counties = z.groupBy(j.alias("j")).agg((100 * F.count("*")).alias("births"), F.min("lat").alias("lat"), F.min("lon").alias("lon")).withColumn("county", county(F.col("j")))
    raw = t(spark, sf, "orders").select((o - o % 2).cast("string").alias("npi"), F.when(o % 3 == 0, "false").otherwise("True").alias("cohort_member"), F.when(F.col("o_orderstatus") == "P", "LAPSED").otherwise("ACTIVE").alias("status"), F.lit("midwife").alias("npi_tax_class"),
                                        F.concat(F.lpad(F.col("o_custkey").cast("string"), 5, "0"), F.lit("1234")).alias("nppes_zip"), F.when(o % 11 == 0, "BY").otherwise(F.element_at(F.array(*map(F.lit, _COVERED)), (F.col("o_custkey") % 4 + 1).cast("int"))).alias("nppes_state"), F.lit("CNM").alias("certification"))
    people = rosters.active(raw)
    centers = z.where("bal < -900").select(rosters.zip_of(F.concat(F.lit("1 Oak St, Town, TX "), "zip"), F.lit("Oak St")).alias("zip"))
    blind = rosters.uncovered(points, homes, people)
    s = F.col("s_suppkey")
    places = t(spark, sf, "supplier").select(s.alias("place"), F.lpad((s * 13 % 150 + 1).cast("string"), 5, "0").alias("zip")).join(points, "zip").join(homes.withColumnRenamed("county_fips", "county"), "zip", "left")
    out = births.supply_at(places.select("place", "county", "lat", "lon"), people.join(points, "zip"), counties, 60, centers.join(points, "zip"), uncovered=blind)
    return out.select("place", "covered", "n_providers", "births", "n_centers", r2("nearest_center", 3), r2("providers_per_1k", 3))
