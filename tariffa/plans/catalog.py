"""Registered queries: the operators over the test tables, and the SQL that gives the same rows.

A supplier stands for a hospital, its nation for a state, an order for a file, a line for a charge, a part's brand for
a code, a market segment for a payer, `l_extendedprice` for the gross price and that less the discount for the rate.
Money is rounded after a nudge of 1e-7, so that ties which interpolation makes fall the same way everywhere.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffa.functions import numbers as nu
from tariffa.functions import rules
from tariffa.functions import text as tx
from tariffa.operators import aggregates as agg
from tariffa.operators import crawl
from tariffa.operators import economics as eco
from tariffa.operators import joins as jo
from tariffa.operators import reshape as rs
from tariffa.operators import store as st
from tariffa.operators import windows as win
from tariffa.sources import web

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def r2(c, places: int = 2):
    return F.round(F.col(c) + 1e-7, places).alias(c) if isinstance(c, str) else F.round(c + 1e-7, places)


def charges(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with their file, payer, hospital, state and code; the dimensions are joined by their keys."""
    line = t(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    orders = t(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    payer = t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("payer"), F.col("c_nationkey").alias("plan"))
    unit = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    state = t(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("state"), "n_regionkey")
    code = t(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("code"))
    # the small tables meet first, so lines are shuffled for orders and for parts only
    out = line.join(orders.join(payer, "o_custkey"), "l_orderkey").join(unit.join(state, "s_nationkey"), "l_suppkey").join(code, "l_partkey")
    return out.withColumns({"gross": F.col("l_extendedprice"), "rate": F.col("l_extendedprice") * (1 - F.col("l_discount")), "cash": F.col("l_extendedprice") * (1 - F.col("l_tax"))})


CHARGES = """charges AS (
  SELECT l.*, c_mktsegment AS payer, c_nationkey AS plan, n_name AS state, n_regionkey, p_brand AS code,
         l_extendedprice AS gross, l_extendedprice * (1 - l_discount) AS rate, l_extendedprice * (1 - l_tax) AS cash
  FROM lineitem l JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN part ON p_partkey = l_partkey)"""


@query(f"""WITH {CHARGES},
a AS (SELECT l_suppkey, state, code, payer, plan, median(rate) AS price FROM charges GROUP BY ALL),
b AS (SELECT l_suppkey, state, code, payer, median(price) AS price, count(*) AS n FROM a GROUP BY ALL),
lines AS (SELECT DISTINCT l_suppkey, state, code, l_partkey, cash FROM charges WHERE cash > 1 AND cash < 2000000),
c AS (SELECT l_suppkey, state, code, 'self_pay_cash' AS payer, median(cash) AS price, count(*) AS n FROM lines GROUP BY ALL),
glines AS (SELECT DISTINCT l_suppkey, state, code, l_partkey, gross FROM charges WHERE gross > 1 AND gross < 5000000),
g AS (SELECT l_suppkey, state, code, 'gross_charge' AS payer, median(gross) AS price, count(*) AS n FROM glines GROUP BY ALL),
u AS (SELECT * FROM b UNION ALL SELECT * FROM c UNION ALL SELECT * FROM g),
w AS (SELECT * FROM u UNION ALL SELECT l_suppkey, 'US', code, payer, price, n FROM u)
SELECT state, code, payer, round(median(price) + 1e-7, 2) AS median_price, round(quantile_cont(price, 0.25) + 1e-7, 2) AS p25,
       round(quantile_cont(price, 0.75) + 1e-7, 2) AS p75, count(*)::BIGINT AS n_hospitals, sum(n)::BIGINT AS n_rates
FROM w GROUP BY ALL""")
def three_stage_median(spark, sf):
    out = st.geographic_medians(charges(spark, sf), "rate", "l_suppkey", "state", ["code"], "payer", ["plan"], "cash", "gross", ["l_partkey"])
    return out.select("state", "code", "payer", r2("median_price"), r2("p25"), r2("p75"), "n_hospitals", "n_rates")


flagship = three_stage_median


@query(f"""WITH {CHARGES}, u AS (SELECT l_suppkey, code, payer, median(rate) AS price FROM charges GROUP BY ALL),
r AS (SELECT a.code, a.payer, a.price / b.price AS ratio FROM u a JOIN u b USING (l_suppkey, code) WHERE b.payer = 'BUILDING' AND b.price > 0 AND a.payer <> 'BUILDING')
SELECT code, payer, round(median(ratio) + 1e-9, 4) AS median_ratio, round(quantile_cont(ratio, 0.25) + 1e-9, 4) AS p25,
       round(quantile_cont(ratio, 0.75) + 1e-9, 4) AS p75, count(*)::BIGINT AS n_units FROM r GROUP BY ALL""")
def unit_to_reference_ratio(spark, sf):
    out = st.reference_ratios(charges(spark, sf), "rate", "l_suppkey", ["code"], "payer", "BUILDING")
    return out.select("code", "payer", *(F.round(F.col(c) + 1e-9, 4).alias(c) for c in ("median_ratio", "p25", "p75")), "n_units")


@query(f"""WITH {CHARGES} SELECT l_suppkey, code, count(*)::BIGINT AS n_rows, count(rate)::BIGINT AS n_rates, count(DISTINCT l_orderkey)::BIGINT AS n_files,
count(DISTINCT payer)::BIGINT AS n_payers, round(min(rate) + 1e-7, 2) AS least, round(max(rate) + 1e-7, 2) AS most,
round(avg(CASE WHEN rate > gross + 0.01 THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS above_gross, bool_and(coalesce(rate > 0, false)) AS all_positive,
bool_or(coalesce(rate > gross + 0.01, false)) AS any_above_gross, round(quantile_cont(rate, 0.25) + 1e-7, 2) AS p25, round(median(rate) + 1e-7, 2) AS median,
round(quantile_cont(rate, 0.75) + 1e-7, 2) AS p75 FROM charges GROUP BY ALL""")
def summary_profile(spark, sf):
    out = st.summary(charges(spark, sf), ["l_suppkey", "code"], "rate", "l_orderkey", "payer", "gross")
    return out.select("l_suppkey", "code", "n_rows", "n_rates", "n_files", "n_payers", r2("least"), r2("most"), F.round("above_gross", 6).alias("above_gross"), "all_positive", "any_above_gross", r2("p25"), r2("median"), r2("p75"))


@query("""WITH p AS (SELECT l_suppkey, l_quantity, count(DISTINCT l_partkey)::BIGINT AS n_codes, count(*)::BIGINT AS n_rows FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_partkey) >= 3)
SELECT * FROM p""")
def pattern_flags_having(spark, sf):
    return agg.equal_rates(t(spark, sf, "lineitem"), ["l_suppkey"], "l_partkey", "l_quantity", 3)


@query("""SELECT l_orderkey, max(l_extendedprice) FILTER (WHERE l_returnflag = 'A') AS a_price, max(l_extendedprice) FILTER (WHERE l_returnflag = 'N') AS n_price,
coalesce(max(l_quantity) FILTER (WHERE l_returnflag = 'A') = max(l_quantity) FILTER (WHERE l_returnflag = 'N'), false) AS same_quantity FROM lineitem GROUP BY l_orderkey""")
def conditional_max_pivot(spark, sf):
    top = lambda c, k: F.max(F.when(F.col("l_returnflag") == k, F.col(c)))
    return t(spark, sf, "lineitem").groupBy("l_orderkey").agg(top("l_extendedprice", "A").alias("a_price"), top("l_extendedprice", "N").alias("n_price"), F.coalesce(top("l_quantity", "A") == top("l_quantity", "N"), F.lit(False)).alias("same_quantity"))


@query("""WITH g AS (SELECT l_partkey, l_linestatus, l_orderkey, min(l_extendedprice) AS least FROM lineitem WHERE l_returnflag <> 'R' AND l_extendedprice > 1 GROUP BY ALL),
m AS (SELECT l_partkey, l_linestatus, median(least) AS typical, count(*) AS n FROM g GROUP BY ALL),
w AS (SELECT l_partkey, max(typical) FILTER (WHERE l_linestatus = 'F') AS facility_gross, max(n) FILTER (WHERE l_linestatus = 'F') AS facility_files,
 max(typical) FILTER (WHERE l_linestatus = 'O') AS professional_gross, max(n) FILTER (WHERE l_linestatus = 'O') AS professional_files FROM m GROUP BY l_partkey)
SELECT l_partkey AS code, round(facility_gross + 1e-7, 2) AS facility_gross, facility_files::BIGINT AS facility_files, round(professional_gross + 1e-7, 2) AS professional_gross,
 professional_files::BIGINT AS professional_files, round(CASE WHEN facility_files >= 2 AND professional_files >= 2 AND facility_gross >= 2.5 * professional_gross
 THEN sqrt(facility_gross * professional_gross) END + 1e-7, 2) AS cutoff, round(10 * facility_gross + 1e-7, 1) AS case_line_from FROM w""")
def threshold_reference(spark, sf):
    lines = t(spark, sf, "lineitem").select(F.col("l_partkey").alias("code"), F.col("l_orderkey").alias("mrf_file_id"), F.when(F.col("l_linestatus") == "F", "facility").otherwise("professional").alias("billing_class"), F.when(F.col("l_returnflag") == "R", "inpatient").otherwise("outpatient").alias("setting"), F.col("l_extendedprice").alias("gross"))
    out = st.typical_gross(lines, files_needed=2)
    return out.select("code", r2("facility_gross"), "facility_files", r2("professional_gross"), "professional_files", r2("cutoff"), r2("case_line_from", 1))


@query("""SELECT o_orderkey, o_custkey, c_mktsegment, n_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0
LEFT JOIN nation ON n_nationkey = c_nationkey""")
def star_fact_left_joins(spark, sf):
    c = t(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    n = t(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return t(spark, sf, "orders").select("o_orderkey", "o_custkey").join(c, "o_custkey", "left").join(n, "c_nationkey", "left").select("o_orderkey", "o_custkey", "c_mktsegment", "n_name")


@query("""WITH a AS (SELECT event_id, nullif(event_type, 'click') AS k, user_id % 7 AS j FROM events), b AS (SELECT nullif(event_type, 'click') AS k, user_id % 7 AS j, count(*)::BIGINT AS n FROM events GROUP BY ALL)
SELECT event_id, a.k, a.j, n FROM a LEFT JOIN b ON a.k IS NOT DISTINCT FROM b.k AND a.j IS NOT DISTINCT FROM b.j""")
def null_safe_key_join(spark, sf):
    a = t(spark, sf, "events").select("event_id", F.nullif("event_type", F.lit("click")).alias("k"), (F.col("user_id") % 7).alias("j"))
    return jo.null_safe(a, a.groupBy("k", "j").agg(F.count("*").alias("n")), ["k", "j"])


@query("""SELECT p_partkey, CASE lower(trim(p_type)) WHEN 'x' THEN 'y' ELSE CASE WHEN lower(trim(split_part(p_type, ' ', 1))) IN ('small', 'large', 'economy') THEN lower(trim(split_part(p_type, ' ', 1))) ELSE 'unknown' END END AS kind FROM part""")
def enum_normalise(spark, sf):
    first = F.split_part(F.col("p_type"), F.lit(" "), F.lit(1))
    return t(spark, sf, "part").select("p_partkey", rules.enum(first, ("small", "large", "economy")).alias("kind"))


@query(r"""SELECT doc_id, CASE WHEN text IS NULL THEN NULL WHEN trim(text) = '' THEN 'unknown' WHEN regexp_matches(lower(text), 'licen[cs]ed? under') THEN 'license'
WHEN regexp_matches(lower(text), 'password|token') THEN 'secret' WHEN regexp_matches(lower(text), '[^ ]+@[^ ]+') THEN 'mail' ELSE 'other' END AS label FROM documents""")
def first_match_classifier(spark, sf):
    own = (("license", "licen[cs]ed? under"), ("secret", "password|token"), ("mail", "[^ ]+@[^ ]+"))
    return t(spark, sf, "documents").select("doc_id", rules.first_match(F.col("text"), own).alias("label"))


PAYERS = ("Aetna Medicare Advantage", "Blue Cross", "Medicaid HMO", "Self-Pay", "TRICARE West", "Workers Comp Fund", "State Exchange", "Medigap Plan G", "Plain Name", "")


@query("""SELECT c_custkey, (['medicare_advantage', 'commercial', 'medicaid', 'self_pay', 'tricare_va', 'workers_comp', 'exchange', 'medicare', 'other', CASE WHEN c_custkey % 3 = 0 THEN 'other' ELSE 'unknown' END])[(c_custkey % 10)::INT + 1] AS payer_type FROM customer""")
def payer_type_rules(spark, sf):
    names = F.array(*map(F.lit, PAYERS))
    payer = F.element_at(names, (F.col("c_custkey") % 10 + 1).cast("int"))
    plan = F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment"))
    return t(spark, sf, "customer").select("c_custkey", rules.payer_type(payer, plan).alias("payer_type"))


@query("""SELECT o_orderkey, coalesce(x > 1 AND x < 2000000 AND NOT regexp_matches(CAST(TRY_CAST(x AS DECIMAL(18,2)) AS VARCHAR), '^9{5,}(\\.(9+|0+))?$'), false) AS plausible
FROM (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 99999.0 WHEN 1 THEN o_totalprice * 10 WHEN 2 THEN NULL WHEN 3 THEN 999999.99 ELSE o_totalprice END AS x FROM orders)""".replace("\\\\", "\\"))
def plausible_flag(spark, sf):
    k = F.col("o_orderkey") % 5
    x = F.when(k == 0, 99999.0).when(k == 1, F.col("o_totalprice") * 10).when(k == 2, F.lit(None)).when(k == 3, 999999.99).otherwise(F.col("o_totalprice"))
    return t(spark, sf, "orders").select("o_orderkey", nu.plausible(x.cast("double")).alias("plausible"))


@query("""WITH a AS (SELECT o_custkey, o_orderstatus, max(o_totalprice) AS price FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL), b AS (SELECT o_custkey, 'F' AS o_orderstatus, min(o_totalprice) AS price FROM orders GROUP BY ALL)
SELECT * FROM a UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.o_custkey = b.o_custkey AND a.o_orderstatus = b.o_orderstatus)""")
def anti_fallback(spark, sf):
    o = t(spark, sf, "orders")
    a = o.where("o_orderstatus <> 'P'").groupBy("o_custkey", "o_orderstatus").agg(F.max("o_totalprice").alias("price"))
    b = o.groupBy("o_custkey").agg(F.min("o_totalprice").alias("price")).withColumn("o_orderstatus", F.lit("F"))
    return jo.with_fallback(a, b.select("o_custkey", "o_orderstatus", "price"), ["o_custkey", "o_orderstatus"])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) >= 12)")
def semi_enough(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return o.join(o.groupBy("o_custkey").count().where("count >= 12"), "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


@query("""SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""")
def not_exists_orphans(spark, sf):
    dear = t(spark, sf, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return t(spark, sf, "customer").select("c_custkey").join(dear, "c_custkey", "left_anti")


@query("""SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def exclusion_list(spark, sf):
    banned = t(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return jo.excluding(t(spark, sf, "orders").select("o_orderkey", "o_custkey"), banned, "o_custkey").select("o_orderkey")


@query("""WITH a AS (SELECT o_custkey AS k, count(*)::BIGINT AS a_n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT o_custkey AS k, count(*)::BIGINT AS b_n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT k, a_n, b_n, coalesce(a_n = b_n, false) AS same FROM a FULL JOIN b USING (k)""")
def full_outer_compare(spark, sf):
    n = lambda s, c: t(spark, sf, "orders").where(F.col("o_orderstatus") == s).groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias(c))
    return n("F", "a_n").join(n("O", "b_n"), "k", "full").select("k", "a_n", "b_n", F.coalesce(F.col("a_n") == F.col("b_n"), F.lit(False)).alias("same"))


@query("""WITH grid AS (SELECT n_name, n_regionkey, s FROM nation, (VALUES ('BUILDING'), ('MACHINERY'), ('NONE')) v(s)),
a AS (SELECT n_name, c_mktsegment AS s, avg(c_acctbal) AS v FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL HAVING count(*) >= 14), b AS (SELECT c_mktsegment AS s, avg(c_acctbal) AS v FROM customer GROUP BY ALL)
SELECT n_name, grid.s AS segment, round(coalesce(a.v, b.v, 100.0) + 1e-7, 2) AS value, CASE WHEN a.v IS NOT NULL THEN 'state' WHEN b.v IS NOT NULL THEN 'national' ELSE 'default' END AS source
FROM grid LEFT JOIN a USING (n_name, s) LEFT JOIN b ON b.s = grid.s""")
def cross_grid_coalesce(spark, sf):
    n = t(spark, sf, "nation").select("n_nationkey", "n_name")
    c = t(spark, sf, "customer").join(n.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey").withColumnRenamed("c_mktsegment", "segment")
    local = c.groupBy("n_name", "segment").agg(F.avg("c_acctbal").alias("value"), F.count("*").alias("n")).where("n >= 14").drop("n")
    wide = c.groupBy("segment").agg(F.avg("c_acctbal").alias("value"))
    grid = n.select("n_name", F.explode(F.array(*map(F.lit, ("BUILDING", "MACHINERY", "NONE")))).alias("segment"))
    out = jo.lookup_chain(grid, [(local, ["n_name", "segment"], "state"), (wide, ["segment"], "national")], F.lit(100.0))
    return out.select("n_name", "segment", r2("value"), "source")


@query("""SELECT DISTINCT c_custkey, s_suppkey FROM customer, supplier WHERE (c_custkey = s_suppkey) OR (right(c_name, 6) = right(s_name, 6)) OR (round(c_acctbal) = round(s_acctbal))""")
def or_condition_candidates(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", F.col("c_custkey").alias("a"), F.right("c_name", F.lit(6)).alias("b"), F.round("c_acctbal").alias("d"))
    s = t(spark, sf, "supplier").select("s_suppkey", F.col("s_suppkey").alias("e"), F.right("s_name", F.lit(6)).alias("f"), F.round("s_acctbal").alias("g"))
    return jo.any_of(c, s, [("a", "e"), ("b", "f"), ("d", "g")], "c_custkey", "s_suppkey")


@query("""WITH a AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O')
SELECT o_orderkey, round(min(abs(a.o_totalprice - b.o_totalprice)) + 1e-7, 2) AS gap FROM a LEFT JOIN b ON a.o_custkey = b.o_custkey GROUP BY o_orderkey""")
def nearest_value_match(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    out = jo.nearest_value(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus = 'O'"), ["o_custkey"], "o_orderkey", "o_totalprice", "o_totalprice")
    return out.select("o_orderkey", r2("gap"))


@query("""WITH p AS (SELECT s_suppkey, 25 + (s_suppkey * 7919 % 2500) / 100.0 AS lat, -120 + (s_suppkey * 104729 % 4000) / 100.0 AS lon FROM supplier),
q AS (SELECT c_custkey, 25 + (c_custkey * 6101 % 2500) / 100.0 AS lat, -120 + (c_custkey * 75577 % 4000) / 100.0 AS lon FROM customer),
d AS (SELECT s_suppkey, c_custkey, 2 * 3958.8 * asin(least(1, sqrt(pow(sin(radians(q.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(q.lat)) * pow(sin(radians(q.lon - p.lon) / 2), 2)))) AS miles FROM p, q)
SELECT s_suppkey, c_custkey, round(miles + 1e-7, 3) AS miles FROM d WHERE miles <= 30""")
def radius_join(spark, sf):
    point = lambda k, a, b, lat, lon: (F.col(k), (25 + (F.col(k) * a % 2500) / 100.0).alias(lat), (-120 + (F.col(k) * b % 4000) / 100.0).alias(lon))
    p = t(spark, sf, "supplier").select(*point("s_suppkey", 7919, 104729, "lat", "lon"))
    q = t(spark, sf, "customer").select(*point("c_custkey", 6101, 75577, "lat2", "lon2"))
    return jo.within_radius(p, q, 30, shown=lambda miles: r2(miles, 3)).select("s_suppkey", "c_custkey", "miles")


@query("""WITH x AS (SELECT p_partkey, w, unnest(w) AS tk FROM (SELECT p_partkey, list_sort(list_distinct(string_split(lower(p_name), ' '))) AS w FROM part)),
y AS (SELECT DISTINCT w, tk FROM x), q AS (SELECT DISTINCT a.w AS aw, b.w AS bw FROM y a JOIN y b USING (tk)),
z AS (SELECT aw, bw, len(list_intersect(aw, bw)) / len(list_distinct(list_concat(aw, bw))) AS score FROM q), k AS (SELECT DISTINCT p_partkey, w FROM x),
f AS (SELECT w, p_partkey, row_number() OVER (PARTITION BY w ORDER BY p_partkey) AS i FROM k), b3 AS (SELECT * FROM f WHERE i <= 3), -- no row needs more than three of a set to find its best two
s AS (SELECT k.p_partkey AS a_key, b3.p_partkey AS b_key, score FROM k JOIN z ON aw = k.w JOIN b3 ON b3.w = bw AND b3.p_partkey <> k.p_partkey),
r AS (SELECT *, lead(score) OVER v AS nxt, row_number() OVER v AS n FROM s WINDOW v AS (PARTITION BY a_key ORDER BY score DESC, b_key))
SELECT a_key, b_key, round(score + 1e-9, 6)::DOUBLE AS score, round(score - coalesce(nxt, 0) + 1e-9, 6)::DOUBLE AS margin FROM r WHERE n = 1""")
def token_jaccard_top1_margin(spark, sf):
    words = t(spark, sf, "part").select("p_partkey", F.array_distinct(F.split(F.lower("p_name"), " ")).alias("tokens"))
    best = jo.best_overlap(words, "p_partkey")
    return best.select(F.col("p_partkey").alias("a_key"), F.col("match").alias("b_key"), F.round(F.col("score") + 1e-9, 6).alias("score"), F.round(F.col("margin") + 1e-9, 6).alias("margin"))


@query("""WITH p AS (SELECT c_custkey, s_suppkey, CASE WHEN c_nationkey = s_nationkey AND c_custkey % 5 = s_suppkey % 5 THEN 0 WHEN c_nationkey = s_nationkey THEN 1 ELSE 2 END AS block
FROM customer JOIN nation a ON a.n_nationkey = c_nationkey JOIN nation b USING (n_regionkey) JOIN supplier ON s_nationkey = b.n_nationkey)
SELECT c_custkey, s_suppkey, block::INT AS block FROM p WHERE block = (SELECT min(block) FROM p q WHERE q.c_custkey = p.c_custkey)""")
def blocked_match(spark, sf):
    n = t(spark, sf, "nation").where("n_regionkey is not null")
    side = lambda table, key, nation, p: t(spark, sf, table).select(key, nation, (F.col(key) % 5).alias(f"{p}_part")).join(n.select(F.col("n_nationkey").alias(nation), F.col("n_regionkey").alias(f"{p}_region")), nation)
    nation, part, region = ("c_nationkey", "s_nationkey"), ("c_part", "s_part"), ("c_region", "s_region")
    tiers = [[nation, part], [nation], [region]]
    return jo.first_block(side("customer", "c_custkey", "c_nationkey", "c"), side("supplier", "s_suppkey", "s_nationkey", "s"), "c_custkey", tiers).select("c_custkey", "s_suppkey", "block")


@query("SELECT (row_number() OVER (ORDER BY c_mktsegment NULLS LAST, c_nationkey NULLS LAST))::INT AS id, c_mktsegment, c_nationkey FROM (SELECT DISTINCT c_mktsegment, c_nationkey FROM customer)")
def dim_keys(spark, sf):
    return win.surrogate_keys(t(spark, sf, "customer").select("c_mktsegment", "c_nationkey").distinct(), ["c_mktsegment", "c_nationkey"], "id")


@query("""WITH g AS (SELECT o_custkey, o_orderstatus, count(*)::BIGINT AS n FROM orders GROUP BY ALL)
SELECT *, (sum(n) OVER (PARTITION BY o_custkey))::BIGINT AS all_n, round(n / sum(n) OVER (PARTITION BY o_custkey), 6)::DOUBLE AS share FROM g""")
def window_over_aggregate(spark, sf):
    n = t(spark, sf, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n"))
    out = win.group_share(n, ["o_custkey"], "n")
    from pyspark.sql import Window

    return out.withColumn("all_n", F.sum("n").over(Window.partitionBy("o_custkey"))).withColumn("share", F.round("share", 6))


@query("""SELECT conv_id, turn, role, (sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING))::BIGINT AS run FROM conversations""")
def running_label(spark, sf):
    return win.run_labels(t(spark, sf, "conversations").select("conv_id", "turn", "role"), ["conv_id"], [F.col("turn")], F.col("role") == "user")


@query("""WITH e AS (SELECT event_id, user_id, CASE WHEN event_id % 3 = 0 THEN value END AS v FROM events)
SELECT event_id, user_id, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING),
first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS v FROM e""")
def fill_downup(spark, sf):
    e = t(spark, sf, "events").select("event_id", "user_id", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("v"))
    return win.filled(e, ["user_id"], [F.col("event_id")], "v")


@query("""SELECT o_custkey, o_orderkey, round(o_totalprice - lag(o_totalprice, 1, 0) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) + 1e-7, 2) AS change FROM orders""")
def lag_drop(spark, sf):
    o = win.changes(t(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.col("o_orderkey")], "o_totalprice")
    return o.select("o_custkey", "o_orderkey", r2("change"))


@query("""SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k <= 2""")
def topk_per_group(spark, sf):
    return win.first_rows(t(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 2)


@query("""WITH q AS (SELECT quantile_cont(c_acctbal, 1/3) AS a, quantile_cont(c_acctbal, 2/3) AS b FROM customer) SELECT c_custkey, (1 + (c_acctbal > a)::INT + (c_acctbal > b)::INT)::INT AS band FROM customer, q""")
def tertile_bands(spark, sf):
    return win.global_bands(t(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", 3).select("c_custkey", "band")


@query("""SELECT l_orderkey, l_linenumber, slot::INT AS slot, code, type FROM (
SELECT l_orderkey, l_linenumber, 1 AS slot, l_partkey::VARCHAR AS code, 'CPT' AS type FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 2, nullif(l_returnflag, 'N'), 'RC' FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 3, l_suppkey::VARCHAR, NULL FROM lineitem) WHERE code IS NOT NULL""")
def code_slot_unpivot(spark, sf):
    slots = [(F.col("l_partkey"), F.lit("CPT")), (F.nullif("l_returnflag", F.lit("N")), F.lit("RC")), (F.col("l_suppkey"), F.lit(None))]
    return rs.code_slots(t(spark, sf, "lineitem"), slots, ["l_orderkey", "l_linenumber"])


@query(f"""WITH {CHARGES}, m AS (SELECT state, payer, median(rate) AS v, count(DISTINCT l_suppkey) AS n FROM charges GROUP BY ALL)
SELECT state, {", ".join(f"round(max(v) FILTER (WHERE payer = '{p}' AND n >= 3) + 1e-7, 2) AS {p.lower()}" for p in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"))} FROM m WHERE n >= 3 GROUP BY state""")
def pivot_headline(spark, sf):
    c = charges(spark, sf)
    n = c.groupBy("state", "payer").agg(F.count_distinct("l_suppkey").alias("n")).where("n >= 3")
    m = agg.median(c, ["state", "payer"], "rate").join(n, ["state", "payer"]).withColumn("payer", F.lower("payer")).withColumn("median", r2("median"))
    return rs.headline(m, ["state"], "payer", ["automobile", "building", "furniture", "household", "machinery"], "median", F.col("state") == "US")


@query("""SELECT l_orderkey, l_linenumber, metric, value FROM (SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem) UNPIVOT (value FOR metric IN (l_discount, l_tax))""")
def metric_unpivot(spark, sf):
    return rs.metrics_long(t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_discount", "l_tax"])


@query("""SELECT event_id, key, value FROM (SELECT event_id, unnest(json_keys(props)) AS key, props FROM events), LATERAL (SELECT json_extract_string(props, '$.' || key) AS value)""")
def explode_json_props(spark, sf):
    props = F.from_json("props", "map<string,string>")
    return t(spark, sf, "events").select("event_id", F.explode(props))


@query(r"""SELECT page_id, regexp_replace(lower(regexp_extract(r, '^[^/?]*', 0)), '^www\.', '') || regexp_replace(CASE WHEN regexp_matches(p, '(?i)\.(csv|json|zip|gz|xlsx?|txt)/?(\?|$)') THEN regexp_replace(p, '\?.*$', '') ELSE p END, '/+$', '') AS url_key,
regexp_replace(lower(regexp_extract(r, '^[^/:?]*', 0)), '^www[0-9]*\.', '') AS site, regexp_extract(regexp_replace(lower(regexp_extract(r, '^[^/:?]*', 0)), '^www[0-9]*\.', ''), '([^.]+\.[^.]+)$', 1) AS parent
FROM (SELECT page_id, r, regexp_replace(r, '^[^/?]*', '') AS p FROM (SELECT page_id, regexp_replace(regexp_replace(url, '#.*$', ''), '(?i)^[a-z][a-z0-9+.-]*://', '') AS r FROM pages))""")
def url_key(spark, sf):
    u = F.col("url")
    return t(spark, sf, "pages").select("page_id", tx.url_key(u).alias("url_key"), tx.site(u).alias("site"), tx.last_labels(u).alias("parent"))


#: Hosts made from a page's number, and what is expected of each: its parent, its variants, whether it is junk.
HOSTS = (
    ("{}.azurewebsites.net", None, "{}.azurewebsites.net", False),
    ("{}.co.uk", None, "{}.co.uk", False),
    ("www.{}.co.uk", "{}.co.uk", "www.{}.co.uk {}.co.uk", False),
    ("www.apps.{}.com", "{}.com", "www.apps.{}.com apps.{}.com {}.com www.{}.com", False),
    ("files.{}.org", "{}.org", "files.{}.org {}.org www.{}.org", False),
    ("{}.org", None, "{}.org www.{}.org", False),
    ("{}.s3.amazonaws.com", None, "{}.s3.amazonaws.com", True),
    ("a.{}.co.us", "{}.co.us", "a.{}.co.us {}.co.us www.{}.co.us", False),
    ("www.google.com", "google.com", "www.google.com google.com", True),
    ("192.0.2.7", "2.7", "192.0.2.7 2.7 www.2.7", True),
    ("localhost", None, "localhost", True),
    ("{}.box.com", None, "{}.box.com", True),
)


def _host_cases(column: int) -> str:
    text = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else "'" + v.replace("{}", "' || h || '") + "'"
    return "CASE page_id % 12 " + " ".join(f"WHEN {i} THEN {text(row[column])}" for i, row in enumerate(HOSTS)) + " END"


@query(f"""WITH p AS (SELECT page_id, 'h' || (page_id % 500) AS h FROM pages)
SELECT page_id, {_host_cases(0)} AS host, {_host_cases(1)} AS parent, array_to_string(list_sort(string_split({_host_cases(2)}, ' ')), ' ') AS variants, {_host_cases(3)} AS junk FROM p""")
def domain_rules(spark, sf):
    """Parents, variants and junk of hosts of every kind, in URLs with schemes, users, ports and paths."""
    k, h = F.col("page_id"), F.concat(F.lit("H"), (F.col("page_id") % 500).cast("string"))
    url = F.concat(F.lit("HTTPS://me@"), F.replace(F.element_at(F.array(*(F.lit(row[0]) for row in HOSTS)), (k % len(HOSTS) + 1).cast("int")), F.lit("{}"), h), F.lit(":8443/a/b.html?c#d"))
    rows = t(spark, sf, "pages").select("page_id", url.alias("u"))
    host = tx.host(F.col("u"))
    return rows.select("page_id", host.alias("host"), tx.parent_domain(F.col("u")).alias("parent"), F.array_join(F.sort_array(tx.domain_variants(F.col("u"))), " ").alias("variants"), crawl.is_junk_host(host).alias("junk"))


@query("""WITH r AS (SELECT event_id, [200, 204, 404, 410, 401, 403, 429, 500, 503, 302, NULL, NULL, NULL, NULL, NULL, NULL][(event_id % 16)::INT + 1] AS status, (event_id % 16)::INT AS k FROM events)
SELECT event_id, ['ok', 'ok', 'not_found', 'not_found', 'blocked', 'blocked', 'http_error', 'http_error', 'http_error', 'http_error', 'timeout', 'timeout', 'dns_fail', 'tls_fail', 'network_error', 'network_error'][k + 1] AS outcome FROM r""")
def request_outcomes(spark, sf):
    """Classes of answers by status and of failures by what they say; a timeout within TLS is a timeout."""
    k = (F.col("event_id") % 16 + 1).cast("int")
    status = F.element_at(F.array(*(F.lit(x).cast("int") for x in (200, 204, 404, 410, 401, 403, 429, 500, 503, 302, *[None] * 6))), k)
    said = ("Connection Timed out", "SSL connection timeout", "getaddrinfo failed", "peer certificate expired", "Connection refused by host", None)
    message = F.element_at(F.array(*(F.lit("Could not resolve host").cast("string"),) * 10, *(F.lit(m).cast("string") for m in said)), k)
    return t(spark, sf, "events").select("event_id", web.outcome(status, message).alias("outcome"))


@query("""WITH p AS (SELECT page_id, 'https://h' || page_id || '.org' AS url, (page_id % 3)::INT AS k FROM pages)
SELECT page_id, url || '/prices' AS link, 'Pricing Transparency' AS text, true AS in_footer FROM p WHERE k = 0 UNION ALL SELECT page_id, url || '/more', 'PriceTransparency', false FROM p WHERE k = 0
UNION ALL SELECT page_id, url || '/list', 'Standard  Charges', false FROM p WHERE k = 1""")
def price_page_links(spark, sf):
    """Links of the better words where a page has them, others only where it has none, repeats and fragments aside."""
    k, u = F.col("page_id") % 3, F.concat(F.lit("https://h"), F.col("page_id").cast("string"), F.lit(".org"))
    link = lambda on, path, text, footer: F.when(on, F.struct(F.concat(u, F.lit(path)).alias("link"), F.lit(text).alias("text"), F.lit(footer).alias("in_footer")))
    every = F.lit(True)
    made = F.array(
        link(k == 0, "/prices#top", "Pricing Transparency", False), link(k == 0, "/prices", "Pricing Transparency", True), link(k == 0, "/more", "PriceTransparency", False), link(k < 2, "/list", "Standard  Charges", False),
        link(every, "/about", "About us", True), link(every, "/transparency", "Our values", True), link(k == 2, "/x", "Standards of charges", False),
    )
    return web.price_links(t(spark, sf, "pages").select("page_id", F.explode(F.array_compact(made)).alias("l")).select("page_id", "l.*"))


@query("""SELECT page_id, [true, true, false, false, true, false, true][(page_id % 7)::INT + 1] AS data_link, [false, true, false, true, true, false, false][(page_id % 7)::INT + 1] AS location_file FROM pages""")
def file_kinds(spark, sf):
    """Links to data files, and bodies that are location files, one of each kind a page."""
    at = lambda *values: F.element_at(F.array(*(v if not isinstance(v, str) else F.lit(v) for v in values)), (F.col("page_id") % 7 + 1).cast("int"))
    u = F.lit("https://h.org")
    link = F.concat(u, at("/a.csv#p", "/x_StandardCharges.JSON.gz?t=1", "/my_standard-charges_list.gz", "/a.csv/page", "/A.ZIP?x=.html", "/csv", "/get_standardcharges.csv.php"))
    body = at("location-name: A", "Location-Name: A\r\n'MRF_URL' : http://h/a.csv", F.concat(F.lit("mrf-url: x\n"), F.col("html"), F.lit("<html>")), "\ufeff\"mrf-url\": x", "a\n  mrf url:\n", "see mrf-url: x", "")
    return t(spark, sf, "pages").select("page_id", web.is_data_link(link).alias("data_link"), crawl.looks_like_location_file(body).alias("location_file"))


@query(r"""WITH s AS (SELECT DISTINCT regexp_extract(lower(url), '^[a-z]+://([^/:?#]+)', 1) AS host FROM pages), b AS (SELECT host, regexp_replace(host, '^www\.', '') AS bare FROM s),
p AS (SELECT host, bare, len(string_split(bare, '.')) AS n, CASE WHEN len(string_split(bare, '.')) > 2 THEN regexp_extract(bare, '([^.]+\.[^.]+)$', 1) END AS parent FROM b)
SELECT host, unnest(list_distinct(list_filter([host, bare, CASE WHEN n = 2 THEN 'www.' || bare END, parent, 'www.' || parent], lambda x: x IS NOT NULL))) AS variant FROM p""")
def host_variants(spark, sf):
    u = F.col("url")
    return t(spark, sf, "pages").select(tx.host(u).alias("host"), F.explode(tx.domain_variants(u)).alias("variant")).distinct()


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 3 THEN '5609' ELSE lpad((p_partkey % 1000)::VARCHAR, 3, '0') || '-' || (p_partkey % 4 + 1) END AS apr,
lpad((p_partkey % 1000)::VARCHAR, 3, '0') AS drg, p_partkey::VARCHAR AS cpt FROM part""")
def code_canonical(spark, sf):
    k = F.col("p_partkey")
    three, sev = F.lpad((k % 1000).cast("string"), 3, "0"), (k % 4 + 1).cast("string")
    raw = F.when(k % 4 == 0, F.concat(F.lit(" "), three, sev)).when(k % 4 == 1, F.concat(three, F.lit("."), sev)).when(k % 4 == 2, F.concat(F.lit("APR-DRG "), three, F.lit(" SOI "), sev)).otherwise(F.lit("5609"))
    return t(spark, sf, "part").select("p_partkey", tx.apr_drg_code(raw).alias("apr"), tx.drg_code(F.concat(F.lit("00"), (k % 1000).cast("string"), F.lit(".0"))).alias("drg"), tx.procedure_code(F.concat(F.lit("\t"), k.cast("string"), F.lit(".00 "))).alias("cpt"))


@query("""SELECT s_suppkey, lpad((10000 + s_suppkey % 80000)::VARCHAR, 6, '0') AS ccn, '010' || lpad((s_suppkey % 1000)::VARCHAR, 3, '0') AS parent FROM supplier""")
def ccn_normalise(spark, sf):
    k = F.col("s_suppkey")
    tail = F.lpad((k % 1000).cast("string"), 3, "0")
    unit = F.concat(F.lit("01"), F.element_at(F.array(F.lit("S"), F.lit("T"), F.lit("U")), (k % 3 + 1).cast("int")), tail)
    fixed = F.concat(F.lit("010"), tail)
    return t(spark, sf, "supplier").select("s_suppkey", tx.ccn(F.concat((10000 + k % 80000).cast("string"), F.lit(".0"))).alias("ccn"), F.when(k % 3 < 2, F.when(tx.is_unit_ccn(unit), tx.parent_ccn(unit))).otherwise(tx.parent_ccn(fixed)).alias("parent"))


@query("""SELECT c_custkey, unnest([(1000000000 + c_custkey)::VARCHAR, (2000000000 + c_custkey)::VARCHAR]) AS npi FROM customer""")
def npi_extract(spark, sf):
    k = F.col("c_custkey")
    text = F.concat(F.lit("NPI "), (1000000000 + k).cast("string"), F.lit("; 12345678901 | "), (2000000000 + k).cast("string"))
    return t(spark, sf, "customer").select("c_custkey", F.explode(tx.npis(text)).alias("npi"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE round(o_totalprice, 2) END AS amount, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def money_and_date_parse(spark, sf):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    amount = F.when(k % 3 == 0, "n/a").when(k % 3 == 1, F.concat(F.lit("$"), F.format_number("o_totalprice", 2))).otherwise(F.concat(F.lit(" "), F.round("o_totalprice", 2).cast("decimal(18,2)").cast("string"), F.lit(" %")))
    day = F.when(k % 4 == 0, F.date_format(d, "M/d/yyyy")).when(k % 4 == 1, F.date_format(d, "yyyyMMdd")).when(k % 4 == 2, F.date_format(d, "MM-dd-yyyy")).otherwise(F.date_format(d, "yyyy-MM-dd"))
    return t(spark, sf, "orders").select("o_orderkey", F.round(nu.money(amount), 2).alias("amount"), nu.mrf_date(day).alias("day"))


@query("""WITH c AS (SELECT l_suppkey, l_returnflag, count(*) AS births, count(*) < 10 AS hidden FROM lineitem GROUP BY ALL),
b AS (SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'A' THEN CASE WHEN hidden THEN 5 ELSE births END ELSE 0 END) / sum(CASE WHEN hidden THEN 5 ELSE births END) AS middle,
sum(CASE WHEN l_returnflag = 'A' THEN CASE WHEN hidden THEN 1 ELSE births END ELSE 0 END) / sum(CASE WHEN hidden THEN CASE WHEN l_returnflag = 'A' THEN 1 ELSE 9 END ELSE births END) AS low,
sum(CASE WHEN l_returnflag = 'A' THEN CASE WHEN hidden THEN 9 ELSE births END ELSE 0 END) / sum(CASE WHEN hidden THEN CASE WHEN l_returnflag = 'A' THEN 9 ELSE 1 END ELSE births END) AS high FROM c GROUP BY l_suppkey)
SELECT l_suppkey, round(middle + 1e-9, 6)::DOUBLE AS middle, round(low + 1e-9, 6)::DOUBLE AS low, round(high + 1e-9, 6)::DOUBLE AS high, round(CASE WHEN high - low <= 0.01 THEN middle END + 1e-9, 6)::DOUBLE AS share FROM b""")
def bounded_share(spark, sf):
    cells = t(spark, sf, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.count("*").alias("births")).withColumn("hidden", F.col("births") < 10)
    out = eco.bounded_share(cells, ["l_suppkey"], F.col("l_returnflag") == "A", "births", "hidden")
    return out.select("l_suppkey", *(F.round(F.col(c) + 1e-9, 6).alias(c) for c in ("middle", "low", "high", "share")))


@query("""WITH r AS (SELECT l_suppkey, l_quantity, l_extendedprice FROM lineitem), x AS (SELECT l_suppkey, rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_suppkey, l_quantity) - 1) / 2 AS a,
rank() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_suppkey, l_extendedprice) - 1) / 2 AS b FROM r)
SELECT l_suppkey, round(corr(a, b) + 1e-9, 6) AS rho, count(*)::BIGINT AS n FROM x GROUP BY l_suppkey""")
def spearman_rank(spark, sf):
    return agg.spearman(t(spark, sf, "lineitem"), ["l_suppkey"], "l_quantity", "l_extendedprice").withColumn("rho", F.round(F.col("rho") + 1e-9, 6))


@query("""WITH g AS (SELECT l_returnflag, l_suppkey, count(*) AS n, sum(ln(l_extendedprice)) AS s, sum(ln(l_extendedprice) * ln(l_extendedprice)) AS q FROM lineitem GROUP BY ALL)
SELECT l_returnflag, round(1 - sum(q - s * s / n) / (sum(q) - sum(s) * sum(s) / sum(n)) + 1e-9, 6) AS r2, sum(n)::BIGINT AS n, count(*)::BIGINT AS n_groups FROM g GROUP BY 1""")
def one_way_r2(spark, sf):
    out = agg.explained_share(t(spark, sf, "lineitem").withColumn("y", F.log("l_extendedprice")), ["l_returnflag"], "l_suppkey", "y")
    return out.withColumn("r2", F.round(F.col("r2") + 1e-9, 6))


@query("""WITH a AS (SELECT l_suppkey, l_quantity, count(*)::BIGINT AS left_n FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL), b AS (SELECT l_suppkey, l_quantity, count(*)::BIGINT AS right_n FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL)
SELECT l_suppkey, l_quantity, coalesce(left_n, 0) AS left_n, coalesce(right_n, 0) AS right_n FROM a FULL JOIN b USING (l_suppkey, l_quantity) WHERE coalesce(left_n, 0) <> coalesce(right_n, 0)""")
def multiset_diff(spark, sf):
    rows = t(spark, sf, "lineitem").select("l_suppkey", "l_quantity", "l_returnflag")
    return jo.multiset_difference(rows.where("l_returnflag = 'A'"), rows.where("l_returnflag = 'R'"), ["l_suppkey", "l_quantity"])


@query("""WITH g AS (SELECT quality, toxic, count(*)::BIGINT AS n, sum(n_chars)::BIGINT AS weight FROM labels JOIN documents USING (doc_id) GROUP BY ALL)
SELECT *, round(weight / sum(weight) OVER (PARTITION BY quality), 6)::DOUBLE AS share FROM g""")
def confusion_matrix(spark, sf):
    both = t(spark, sf, "labels").join(t(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    return agg.confusion(both, "quality", "toxic", F.col("n_chars")).withColumn("share", F.round("share", 6))


@query("""SELECT 'lang' AS dimension, lang AS level, count(*)::BIGINT AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY ALL UNION ALL SELECT 'source', source, count(*)::BIGINT, sum(n_chars)::BIGINT FROM documents GROUP BY ALL""")
def dimension_summary(spark, sf):
    return agg.counted_by(t(spark, sf, "documents"), ["lang", "source"], {"n": F.lit(1), "chars": F.col("n_chars")})


@query("""SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ';' ORDER BY c_mktsegment) AS segments, count(DISTINCT (c_mktsegment, c_nationkey))::BIGINT AS pairs, arg_min(c_custkey, c_acctbal) AS poorest,
round(sum(c_acctbal * c_custkey) / sum(c_custkey) + 1e-7, 2) AS weighted FROM customer GROUP BY 1""")
def group_collapse(spark, sf):
    return t(spark, sf, "customer").groupBy("c_nationkey").agg(agg.joined_names("c_mktsegment").alias("segments"), agg.distinct_pairs("c_mktsegment", "c_nationkey").alias("pairs"), F.min_by("c_custkey", "c_acctbal").alias("poorest"), r2(agg.weighted_mean(F.col("c_acctbal"), F.col("c_custkey"))).alias("weighted"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 40")
def paging_offset(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(40).limit(20)


@query("""SELECT * FROM (SELECT o_custkey, o_orderkey, o_orderstatus FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')) UNION ALL SELECT o_custkey, o_orderkey, 'new' FROM orders WHERE o_orderstatus = 'P'""")
def state_upsert_anti(spark, sf):
    o = t(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return jo.upsert(o, o.where("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("new")), ["o_custkey"])


@query("""SELECT user_id FROM (SELECT user_id, max(ts) AS last, max_by(event_type, (ts, event_id)) AS status FROM events GROUP BY 1) WHERE NOT (status IN ('purchase', 'click') AND (SELECT max(ts) FROM events) - last <= INTERVAL 30 DAY)""")
def stale_keys(spark, sf):
    from tariffa.streaming.resume import stale

    e = t(spark, sf, "events")
    state = e.groupBy("user_id").agg(F.max("ts").alias("last"), F.max_by("event_type", F.struct("ts", "event_id")).alias("status"))
    now = e.agg(F.max("ts")).first()[0]
    return stale(e.select("user_id").distinct(), state, "user_id", "status", "last", ("purchase", "click"), 30, F.lit(now))


@query("""WITH a AS (SELECT p_partkey, p_retailprice / 10 AS margin, (p_size % 10 + 1) / 10.0 AS u, (p_size % 7 + 1)::DOUBLE AS added, 30.0 + p_size AS prim, p_retailprice AS displaced FROM part)
SELECT p_partkey, round(margin - u * (added / prim) * displaced + 1e-7, 3) AS net, round(margin / (u * displaced / prim) + 1e-7, 3) AS minutes, round(margin / (added / prim * displaced) + 1e-7, 3) AS utilisation, round(margin / added / (displaced / prim) + 1e-7, 3) AS ratio FROM a""")
def addon_equations(spark, sf):
    c = F.col
    m, u, a, p, d = c("p_retailprice") / 10, (c("p_size") % 10 + 1) / 10.0, (c("p_size") % 7 + 1).cast("double"), 30.0 + c("p_size"), c("p_retailprice")
    return t(spark, sf, "part").select("p_partkey", r2(eco.net_value(m, u, a, p, d), 3).alias("net"), r2(eco.breakeven_minutes(m, u, p, d), 3).alias("minutes"), r2(eco.breakeven_utilisation(m, a, p, d), 3).alias("utilisation"), r2(eco.minute_ratio(m, a, d, p), 3).alias("ratio"))


@query("""WITH k AS (SELECT p_size, (60 + p_size)::DOUBLE AS prim, 10.0 AS added, floor(480 / (60 + p_size) + 1e-9)::BIGINT AS most FROM (SELECT DISTINCT p_size FROM part)),
a AS (SELECT p_size, prim, added, most, unnest(range(most + 1)) AS addons FROM k), c AS (SELECT *, unnest(range(most + 1)) AS n FROM a)
SELECT p_size, addons::INT AS addons, max(n) FILTER (WHERE n * prim + least(n, addons) * added <= 480 + 1e-9)::INT AS cases FROM c GROUP BY p_size, addons""")
def day_capacity(spark, sf):
    sizes = t(spark, sf, "part").select("p_size").distinct().withColumns({"day": F.lit(480.0), "primary": (60 + F.col("p_size")).cast("double"), "added": F.lit(10.0), "margin": F.lit(100.0), "displaced": F.lit(900.0)})
    return eco.day_values(sizes).select("p_size", "addons", F.col("cases").cast("int").alias("cases"))


@query("""WITH r(parameter, low, high) AS (VALUES ('u', 0.2, 0.9), ('added', 3.0, 15.0)), a AS (SELECT DISTINCT p_size FROM part), s AS (SELECT parameter, 'low' AS side, low AS x FROM r UNION ALL SELECT parameter, 'high', high FROM r)
SELECT p_size, parameter, side, round(100 - (CASE WHEN parameter = 'u' THEN x ELSE 0.5 END) * ((CASE WHEN parameter = 'added' THEN x ELSE 8.0 END) / (30 + p_size)) * 400 + 1e-7, 3)::DOUBLE AS value FROM a, s""")
def tornado(spark, sf):
    base = t(spark, sf, "part").select("p_size").distinct().withColumns({"u": F.lit(0.5), "added": F.lit(8.0)})
    ranges = spark.createDataFrame([("u", 0.2, 0.9), ("added", 3.0, 15.0)], "parameter string, low double, high double")
    out = eco.tornado(base, ranges, ["u", "added"], eco.net_value(F.lit(100.0), F.col("u"), F.col("added"), 30.0 + F.col("p_size"), F.lit(400.0)))
    return out.select("p_size", "parameter", "side", r2("value", 3))


@query()
def psa_summary(spark, sf):
    drawn = eco.draws(spark, [("u", "beta", 0.5, 0.2, 0.8), ("added", "triangular", 8, 3, 15), ("margin", "gamma", 100, 60, 150)])
    rows = t(spark, sf, "part").select("p_size").distinct()
    return eco.simulated(rows, drawn, ["p_size"], eco.net_value(F.col("margin"), F.col("u"), F.col("added"), 30.0 + F.col("p_size"), F.lit(400.0)))
