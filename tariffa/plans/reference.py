"""Registered queries: Medicare references, state and system summaries, local differences, scenarios of add-ons.

A supplier stands for a hospital, its nation for a state, `l_returnflag` for a code and `l_linestatus` for a payer type.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tariffa.operators import births, medicare
from tariffa.operators import scenarios as sc
from tariffa.plans.catalog import query, t

MONEY = 4


def shown(df, *columns: str):
    """The columns rounded after a nudge, so that ties fall the same way everywhere."""
    return df.withColumns({c: F.round(F.col(c) + 1e-7, MONEY) for c in columns})


def S(expression: str, name: str) -> str:
    return f"round({expression} + 1e-7, {MONEY}) AS {name}"


def hospitals(spark, sf):
    return t(spark, sf, "supplier").select(F.col("s_suppkey").alias("ccn"), F.col("s_nationkey").alias("state"))


def prices(spark, sf):
    line = t(spark, sf, "lineitem").select(F.col("l_suppkey").alias("ccn"), F.col("l_returnflag").alias("code"), F.col("l_linestatus").alias("payer_type"), "l_extendedprice")
    return line.groupBy("ccn", "code", "payer_type").agg(F.expr("percentile(l_extendedprice, 0.5D)").alias("price"))


def benchmark(spark, sf):
    own = hospitals(spark, sf).where("ccn % 5 <> 0").select("ccn", (F.lit(0.8) + F.col("ccn") % 9 / 10).alias("wage_index"))
    rural = t(spark, sf, "nation").select(F.col("n_nationkey").alias("state"), (F.lit(0.9) + F.col("n_nationkey") / 100).alias("rural_wage_index"))
    weights = spark.createDataFrame([("A", 0.5), ("N", 0.8), ("R", 1.2)], "code string, weight double")
    amounts = spark.createDataFrame([(30000.0, 11000.0, 27000.0, 14000.0, 1200.0)], "labor_high double, other_high double, labor_low double, other_low double, capital double")
    return medicare.stay_benchmarks(medicare.indexed(hospitals(spark, sf), own, rural), weights, amounts)


def ratios(spark, sf):
    rows = prices(spark, sf).join(benchmark(spark, sf).select("ccn", "state", "code", "medicare"), ["ccn", "code"])
    return rows.withColumn("ratio", F.col("price") / F.col("medicare"))


BENCH = """w AS (SELECT s_suppkey AS ccn, s_nationkey AS state, CASE WHEN s_suppkey % 5 = 0 THEN 0.9::DOUBLE + s_nationkey / 100::DOUBLE ELSE 0.8::DOUBLE + (s_suppkey % 9) / 10::DOUBLE END AS wage_index,
  CASE WHEN s_suppkey % 5 = 0 THEN 'state_rural' ELSE 'ipps_table_2' END AS wage_index_source FROM supplier),
b AS (SELECT ccn, state, code, wage_index, wage_index_source, (CASE WHEN wage_index > 1 THEN 30000 * wage_index + 11000 ELSE 27000 * wage_index + 14000 END + 1200 * pow(wage_index, 0.6848::DOUBLE)) * weight AS medicare
  FROM w, (VALUES ('A', 0.5::DOUBLE), ('N', 0.8::DOUBLE), ('R', 1.2::DOUBLE)) v(code, weight))"""
RATIOS = BENCH + """, p AS (SELECT l_suppkey AS ccn, l_returnflag AS code, l_linestatus AS payer_type, median(l_extendedprice) AS price FROM lineitem GROUP BY ALL),
r AS (SELECT p.*, b.state, b.medicare, price / medicare AS ratio FROM p JOIN b USING (ccn, code))"""
#: Hospitals that a state needs here, so that the smallest tables have both kinds.
LEAST = 3
SUMMARY = RATIOS + f""", s AS (SELECT code, payer_type, state, count(DISTINCT ccn) AS n_hospitals, median(ratio) AS median_ratio, quantile_cont(ratio, 0.25) AS p25_ratio, quantile_cont(ratio, 0.75) AS p75_ratio,
  median(price) AS median_price, quantile_cont(price, 0.25) AS p25_price, quantile_cont(price, 0.75) AS p75_price, median(medicare) AS medicare, count(DISTINCT ccn) < {LEAST} AS low_n FROM r GROUP BY ALL)"""
UNITS = """u AS (SELECT s_suppkey AS ccn, CASE WHEN s_suppkey % 3 = 0 THEN 'ccn:' || s_suppkey ELSE 'sys:' || (s_suppkey % 7) END AS unit FROM supplier)"""
SYSTEMS = SUMMARY + ", " + UNITS + f""", o AS (SELECT code, payer_type, state, unit, median(ratio) AS r, median(price) AS p, count(DISTINCT ccn) AS h FROM r JOIN u USING (ccn) GROUP BY ALL),
y AS (SELECT code, payer_type, state, count(*) AS n_units, sum(h) AS n_hospitals, max(h) / sum(h) AS largest_unit_share, median(r) AS median_ratio, median(p) AS median_price, count(*) < {LEAST} AS low_n FROM o GROUP BY ALL)"""


def units(spark, sf):
    k = F.col("s_suppkey")
    rows = t(spark, sf, "supplier").select(k.alias("ccn"), F.when(k % 3 != 0, (k % 7).cast("string")).alias("health_sys_id"), F.lit(" ").alias("health_sys_name"))
    return medicare.system_units(rows)


@query(f"WITH {BENCH} SELECT ccn, state, code, wage_index_source, {S('wage_index', 'wage_index')}, {S('medicare', 'medicare')} FROM b")
def stay_benchmarks(spark, sf):
    return shown(benchmark(spark, sf), "wage_index", "medicare")


_QUARTILES = ("median_ratio", "p25_ratio", "p75_ratio", "median_price", "p25_price", "p75_price", "medicare")


@query(f"WITH {SUMMARY} SELECT code, payer_type, state, n_hospitals, low_n, {', '.join(S(c, c) for c in _QUARTILES)} FROM s")
def state_ratio_summary(spark, sf):
    return shown(medicare.state_summary(ratios(spark, sf), least=LEAST), *_QUARTILES)


@query(f"""WITH {SUMMARY}, e AS (SELECT * FROM s WHERE NOT low_n AND code = 'N'),
x AS (SELECT payer_type, count(*) AS n_states, {S('quantile_cont(median_price, 0.9) / quantile_cont(median_price, 0.1)', 'p90_p10_price')}, {S('quantile_cont(median_ratio, 0.9) / quantile_cont(median_ratio, 0.1)', 'p90_p10_ratio')}, {S('median(p75_price / p25_price)', 'within_state')} FROM e GROUP BY 1),
k AS (SELECT payer_type, state, ln(price) AS y FROM r WHERE code = 'N' AND (payer_type, state) IN (SELECT payer_type, state FROM e)),
m AS (SELECT *, avg(y) OVER (PARTITION BY payer_type) AS a, avg(y) OVER (PARTITION BY payer_type, state) AS g FROM k)
SELECT x.*, state_r2 FROM x JOIN (SELECT payer_type, {S('1 - sum((y - g) ** 2) / sum((y - a) ** 2)', 'state_r2')} FROM m GROUP BY 1) USING (payer_type)""")
def state_spread(spark, sf):
    own = ratios(spark, sf).where("code = 'N'")
    return shown(medicare.spread(own, medicare.state_summary(own, least=LEAST)), "p90_p10_price", "p90_p10_ratio", "within_state", "state_r2")


@query(f"""WITH {SYSTEMS} SELECT code, payer_type, state, s.n_hospitals, s.low_n AS hospital_low_n, {S('s.median_ratio', 'hospital_ratio')}, {S('s.median_price', 'hospital_price')}, n_units, {S('largest_unit_share', 'largest_unit_share')},
y.low_n AS system_low_n, {S('y.median_ratio', 'system_ratio')}, {S('y.median_price', 'system_price')}, {S('ln(y.median_ratio / s.median_ratio)', 'log_change')} FROM s JOIN y USING (code, payer_type, state)""")
def weighting_compared(spark, sf):
    rows = ratios(spark, sf)
    both = medicare.compared_weighting(medicare.state_summary(rows, least=LEAST), medicare.system_weighted(rows, units(spark, sf), least=LEAST))
    return shown(both, "hospital_ratio", "hospital_price", "largest_unit_share", "system_ratio", "system_price", "log_change")


@query(f"""WITH {SYSTEMS}, c AS (SELECT payer_type, s.median_ratio AS h, y.median_ratio AS v FROM s JOIN y USING (code, payer_type, state) WHERE code = 'N' AND NOT s.low_n),
k AS (SELECT *, (rank() OVER (PARTITION BY payer_type ORDER BY h) + rank() OVER (PARTITION BY payer_type ORDER BY h) + count(*) OVER (PARTITION BY payer_type, h) - 1) / 2 AS a,
  (rank() OVER (PARTITION BY payer_type ORDER BY v) + rank() OVER (PARTITION BY payer_type ORDER BY v) + count(*) OVER (PARTITION BY payer_type, v) - 1) / 2 AS b FROM c)
SELECT payer_type, count(*) AS n_states, {S('quantile_cont(h, 0.9) / quantile_cont(h, 0.1)', 'hospital_spread')}, {S('quantile_cont(v, 0.9) / quantile_cont(v, 0.1)', 'system_spread')}, {S('max(abs(ln(v / h)))', 'largest_change')}, {S('corr(a, b)', 'rho')} FROM k GROUP BY 1""")
def weighting_stats(spark, sf):
    rows = ratios(spark, sf).where("code = 'N'")
    both = medicare.compared_weighting(medicare.state_summary(rows, least=LEAST), medicare.system_weighted(rows, units(spark, sf), least=LEAST))
    return shown(medicare.weighting_stats(both), "hospital_spread", "system_spread", "largest_change", "rho")


@query(f"""WITH {RATIOS}, q AS (SELECT ccn, payer_type, state, max(price) FILTER (code = 'R') AS a, max(price) FILTER (code = 'A') AS b FROM r GROUP BY ALL HAVING a IS NOT NULL AND b IS NOT NULL)
SELECT payer_type, state, count(DISTINCT ccn) AS n_hospitals, {S('median(a / b)', 'median_ratio')}, {S('quantile_cont(a / b, 0.25)', 'p25_ratio')}, {S('quantile_cont(a / b, 0.75)', 'p75_ratio')}, {S('median(a - b)', 'median_dollars')}, {S('avg((a / b > 1)::INT)', 'share_higher')} FROM q GROUP BY ALL""")
def premium_by_state(spark, sf):
    wide = births.premium(ratios(spark, sf), "R", "A").join(hospitals(spark, sf), "ccn").withColumn("dollars", F.col("R") - F.col("A"))
    return shown(medicare.premium_summary(wide, ["payer_type", "state"]), "median_ratio", "p25_ratio", "p75_ratio", "median_dollars", "share_higher")


@query(f"""WITH {RATIOS}, g AS (SELECT s_suppkey AS ccn, unnest(['beds', 'region']) AS dimension, unnest([CASE WHEN s_acctbal < 3000 THEN 'few' WHEN s_acctbal < 9000 THEN 'many' END, (s_nationkey % 5)::VARCHAR]) AS "group" FROM supplier)
SELECT code, payer_type, dimension, "group", count(DISTINCT ccn) AS n_hospitals, {S('median(price)', 'median_price')}, {S('median(ratio)', 'median_ratio')} FROM r JOIN g USING (ccn) WHERE "group" IS NOT NULL GROUP BY ALL""")
def ratios_by_group(spark, sf):
    groups = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("ccn"), F.when(F.col("s_acctbal") < 3000, "few").when(F.col("s_acctbal") < 9000, "many").alias("beds"), (F.col("s_nationkey") % 5).alias("region"))
    return shown(medicare.by_group(ratios(spark, sf), groups, ["beds", "region"]), "median_price", "median_ratio")


_AT = "30 + ({k} % 17) * 0.3 AS {a}, -100 + ({k} % 23) * 0.3 AS {b}"
_NEAR = f"""d AS (SELECT s_suppkey AS ccn, s_nationkey AS state, ['commercial', 'medicaid', 'self_pay'][(s_suppkey % 3)::INT + 1] AS payer_type, s_acctbal AS difference, {_AT.format(k='s_suppkey', a='lat2', b='lon2')} FROM supplier),
c AS (SELECT c_custkey AS place, c_nationkey AS state, {_AT.format(k='c_custkey', a='lat', b='lon')}, 100 + c_custkey % 50 AS births FROM customer),
l AS (SELECT place, payer_type, median(difference) AS local, count(*) AS n FROM c, d WHERE 2 * 3958.8 * asin(least(1, sqrt(pow(sin(radians(lat2 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon) / 2), 2)))) <= 30 GROUP BY ALL),
z AS (SELECT state, payer_type, median(difference) AS statewide FROM d GROUP BY ALL),
f AS (SELECT place, payer_type, coalesce(local, statewide) AS difference, coalesce(n, 0) AS n_hospitals, CASE WHEN local IS NOT NULL THEN 'local' WHEN statewide IS NOT NULL THEN 'state' ELSE 'none' END AS level
  FROM c CROSS JOIN (SELECT DISTINCT payer_type FROM d) LEFT JOIN l USING (place, payer_type) LEFT JOIN z USING (state, payer_type))"""


def _differences(spark, sf):
    at = lambda k, a, b: ((F.lit(30) + k % 17 * 0.3).alias(a), (F.lit(-100) + k % 23 * 0.3).alias(b))
    s, c = F.col("s_suppkey"), F.col("c_custkey")
    kinds = F.array(*map(F.lit, ("commercial", "medicaid", "self_pay")))
    own = t(spark, sf, "supplier").select(s.alias("ccn"), F.element_at(kinds, (s % 3 + 1).cast("int")).alias("payer_type"), F.col("s_nationkey").alias("state2"), *at(s, "lat2", "lon2"), F.col("s_acctbal").alias("difference"))
    places = t(spark, sf, "customer").select(c.alias("place"), F.col("c_nationkey").alias("state"), *at(c, "lat", "lon"))
    return births.local_difference(places, own, 30)


@query(f"WITH {_NEAR} SELECT place, payer_type, {S('difference', 'difference')}, n_hospitals, level FROM f")
def local_difference_by_payer(spark, sf):
    return shown(_differences(spark, sf), "difference")


@query(f"""WITH {_NEAR}, x AS (SELECT place, payer_type, births * CASE payer_type WHEN 'commercial' THEN 0.6 ELSE 0.4 END AS payer_births, difference FROM c JOIN f USING (place) WHERE payer_type IN ('commercial', 'medicaid'))
SELECT payer_type, bound, count(DISTINCT place) AS n_counties, {S('sum(payer_births)', 'payer_births')}, {S('sum(slope / 100 * 1.5 * payer_births)', 'change')}, round(sum(slope / 100 * 1.5 * payer_births * difference) + 1e-7, 2) AS dollars
FROM x, (VALUES ('estimate', -2), ('low', -3), ('high', -1)) b(bound, slope) GROUP BY ALL""")
def implied_difference(spark, sf):
    counties = t(spark, sf, "customer").select(F.col("c_custkey").alias("place"), (100 + F.col("c_custkey") % 50).alias("births"), F.lit(0.6).alias("private"), F.lit(0.4).alias("medicaid"))
    rows = births.implied_difference(counties, _differences(spark, sf), {"estimate": -2, "low": -3, "high": -1}, 1.5, {"commercial": "private", "medicaid": "medicaid"})
    return shown(rows, "payer_births", "change").withColumn("dollars", F.round(F.col("dollars") + 1e-7, 2))


#: Base values of the parameters that the queries use; the high scenario has 1.1 times of each.
PARAMETERS = {
    "pay_frac_A_procedure": 0.5, "pay_frac_A_item": 0.8, "pay_frac_B_procedure": 0.6, "pay_frac_B_item": 0.7, "pay_frac_A_procedure__medicare": 0.1, "pay_frac_B_item__medicaid": 0.2,
    "iud_acquisition_cost_J7298": 90.0, "iud_acquisition_cost_J7297": 80.0, "iud_acquisition_cost_J7300": 85.0, "iud_insertion_supply_cost": 28.0, "combined_emb_anesthesia_drug_increment_cost": 9.0, "coordination_cost": 22.0,
    "emb_pathology_cost": 50.0, "emb_disposable_supply_cost": 28.5, "sleeve_or_slot_minutes": 145.0, "bypass_or_slot_minutes": 190.0, "colonoscopy_slot_minutes": 55.0, "iud_added_minutes_at_surgery": 12.0,
    "combined_emb_added_minutes": 5.0, "utilization_A": 0.5, "utilization_B": 0.7, "contribution_margin_bariatric": 0.3, "contribution_margin_colonoscopy": 0.4, "direct_room_cost_per_minute": 20.0, "anesthesia_cost_per_minute": 3.4,
    "iud_insertion_professional_payment_facility": 60.0, "emb_office_professional_cost_facility": 61.0, "office_iud_insertion_professional_payment": 95.0, "emb_office_professional_cost": 97.0, "office_visit_em_cost": 88.0,
    "avoided_standalone_visits_A": 1.0, "avoided_standalone_visits_B": 2.0, "patient_time_opportunity_cost_per_visit": 43.0, "delay_days_per_displaced_case_A": 30.0, "delay_days_per_displaced_case_B": 20.0,
}
_TYPES = ("commercial", "medicare", "medicaid")


def scenario_rows(spark, sf):
    """Rates of each case variant by nation and insurance type, from orders, lines and balances."""
    o = t(spark, sf, "orders").join(t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    kinds = F.array(*map(F.lit, _TYPES))
    rates = o.groupBy(F.col("c_nationkey").alias("state"), F.element_at(kinds, (F.col("o_orderkey") % 3 + 1).cast("int")).alias("insurance_type")).agg(
        F.round(F.avg("o_totalprice") / 100 + 1e-7, 2).alias("primary_rate"), F.round(F.min("o_totalprice") / 10 + 1e-7, 2).alias("procedure_rate"), F.round(F.max("o_totalprice") / 1000 + 1e-7, 2).alias("item_rate"))
    values = spark.createDataFrame([(s, n, v * k) for s, k in (("base", 1.0), ("high", 1.1)) for n, v in PARAMETERS.items()], "scenario string, parameter string, value double")
    return sc.evaluated(rates.join(F.broadcast(sc.case_table(spark))), values)


_COSTS = "+".join(f"(SELECT v FROM n WHERE p = '{x}')" for x in ("iud_insertion_supply_cost", "combined_emb_anesthesia_drug_increment_cost", "coordination_cost"))
_BIOPSY = "+".join(f"(SELECT v FROM n WHERE p = '{x}')" for x in ("emb_pathology_cost", "emb_disposable_supply_cost", "combined_emb_anesthesia_drug_increment_cost", "coordination_cost"))
_P = lambda name: f"(SELECT v FROM n WHERE p = '{name}')"
SCENARIOS = f"""n AS (SELECT * FROM (VALUES {', '.join(f"('{n}', {v}::DOUBLE)" for n, v in PARAMETERS.items())}) t(p, v)),
rates AS (SELECT c_nationkey AS state, ['commercial', 'medicare', 'medicaid'][(o_orderkey % 3)::INT + 1] AS insurance_type, round(avg(o_totalprice) / 100 + 1e-7, 2) AS primary_rate, round(min(o_totalprice) / 10 + 1e-7, 2) AS procedure_rate,
  round(max(o_totalprice) / 1000 + 1e-7, 2) AS item_rate FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
cases("case", variant, item, slot) AS (VALUES ('A', 'drg621_mirena', 'J7298', 145), ('A', 'drg620_mirena', 'J7298', 145), ('A', 'drg621_liletta', 'J7297', 145), ('A', 'drg621_paragard', 'J7300', 145), ('A', 'sleeve_cpt_mirena', 'J7298', 145),
  ('A', 'bypass_cpt_mirena', 'J7298', 190), ('B', 'diagnostic_45378', '88305', 55), ('B', 'screening_G0121', '88305', 55), ('B', 'screening_high_risk_G0105', '88305', 55)),
v1 AS (SELECT *, CASE "case" WHEN 'A' THEN CASE insurance_type WHEN 'medicare' THEN 0.1 ELSE 0.5 END ELSE 0.6 END * f AS fp, CASE "case" WHEN 'A' THEN 0.8 ELSE CASE insurance_type WHEN 'medicaid' THEN 0.2 ELSE 0.7 END END * f AS fi,
  f * (CASE "case" WHEN 'A' THEN CASE item WHEN 'J7298' THEN 90 WHEN 'J7297' THEN 80 ELSE 85 END + {_COSTS} ELSE {_BIOPSY} END) AS variable_cost, slot * f AS tp, CASE "case" WHEN 'A' THEN 12 ELSE 5 END * f AS dt,
  CASE "case" WHEN 'A' THEN 0.5 ELSE 0.7 END * f AS u, CASE "case" WHEN 'A' THEN 0.3 ELSE 0.4 END * f AS m FROM rates, cases, (VALUES ('base', 1::DOUBLE), ('high', 1.1::DOUBLE)) s(scenario, f)),
v2 AS (SELECT *, fp * procedure_rate + fi * item_rate AS paid, m * primary_rate AS displaced FROM v1),
v3 AS (SELECT *, paid - variable_cost AS margin, procedure_rate + item_rate - variable_cost AS margin_listed, u * dt / tp AS lost FROM v2)"""


@query(f"""WITH {SCENARIOS} SELECT scenario, "case", variant, state, insurance_type, {S('paid', 'paid')}, {S('variable_cost', 'variable_cost')}, {S('lost', 'lost_per_addon')}, {S('margin - lost * displaced', 'net_value')}, {S('margin_listed - lost * displaced', 'net_value_listed')},
{S('margin - dt * 23.4 * f', 'net_value_room')}, {S('CASE WHEN margin > 0 THEN margin / (u * displaced / tp) END', 'breakeven_minutes')}, {S('CASE WHEN margin > 0 THEN margin / (dt / tp * displaced) END', 'breakeven_utilization')}, {S('paid / dt / (primary_rate / tp)', 'minute_ratio')}, margin - lost * displaced > 0 AS worth_it FROM v3""")
def scenario_values(spark, sf):
    keys = ["scenario", "case", "variant", "state", "insurance_type"]
    numbers = ["paid", "variable_cost", "lost_per_addon", "net_value", "net_value_listed", "net_value_room", "breakeven_minutes", "breakeven_utilization", "minute_ratio"]
    return shown(scenario_rows(spark, sf).select(*keys, *numbers, "worth_it"), *numbers)


@query(f"""WITH {SCENARIOS}, w AS (SELECT *, paid + f * CASE "case" WHEN 'A' THEN 60 ELSE 61 END AS combined, f * (CASE "case" WHEN 'A' THEN 95 + CASE item WHEN 'J7298' THEN 90 WHEN 'J7297' THEN 80 ELSE 85 END ELSE 97 + 50 END + 88) AS alone FROM v3)
SELECT scenario, "case", variant, state, insurance_type, {S('combined', 'payer_combined')}, {S('alone', 'payer_alone')}, {S('alone - combined', 'payer_saving')}, {S('''f * f * 43 * CASE "case" WHEN 'A' THEN 1 ELSE 2 END''', 'time_saved')},
{S('100 * lost', 'displaced_per_100')}, {S('''lost * f * CASE "case" WHEN 'A' THEN 30 ELSE 20 END''', 'delay_days')} FROM w""")
def payer_perspectives(spark, sf):
    numbers = ["payer_combined", "payer_alone", "payer_saving", "time_saved", "displaced_per_100", "delay_days"]
    return shown(sc.perspectives(scenario_rows(spark, sf)).select("scenario", "case", "variant", "state", "insurance_type", *numbers), *numbers)


@query(f"""WITH {SCENARIOS} SELECT variant, state, insurance_type, CASE WHEN insurance_type = 'medicare' AND "case" = 'A' THEN NULL ELSE round(margin_listed - lost * displaced + 1e-7, {MONEY}) END AS net_value_listed FROM v3 WHERE scenario = 'base'""")
def coverage_mask(spark, sf):
    status = spark.createDataFrame([("58300", "E1"), ("58100", "T"), ("J7298", "E2"), ("88305", "Q1")], "code string, status_indicator string")
    rows = sc.masked(scenario_rows(spark, sf).where("scenario = 'base'"), sc.without_coverage(status), ["net_value_listed"])
    return shown(rows.select("variant", "state", "insurance_type", "net_value_listed"), "net_value_listed")


@query(f"""WITH {SCENARIOS}, d AS (SELECT variant, state, scenario, 480 AS day, tp, dt, floor(480 / tp + 1e-9)::INT AS most FROM v3 WHERE insurance_type = 'commercial'),
k AS (SELECT *, unnest(range(most + 1)) AS addons FROM d), l AS (SELECT *, (SELECT max(c) FROM range(k.most + 1) r(c) WHERE c * k.tp + least(c, k.addons) * k.dt <= 480 + 1e-9) AS cases FROM k),
q AS (SELECT *, most - cases AS lost, coalesce(lag(most - cases) OVER (PARTITION BY variant, state, scenario ORDER BY addons), 0) AS before FROM l)
SELECT variant, state, scenario, addons::BIGINT AS addons, cases::BIGINT AS cases, lost::BIGINT AS lost, lost > before AS first_lost, (lost - before)::BIGINT AS newly_lost, least(most, floor((480 - most * tp) / dt + 1e-9))::BIGINT AS free_addons FROM q""")
def day_scenarios(spark, sf):
    rows = scenario_rows(spark, sf).where("insurance_type = 'commercial'").select("variant", "state", "scenario", F.lit(480).alias("day"), F.col("primary_minutes").alias("primary"), F.col("added_minutes").alias("added"), "margin", "displaced")
    out = sc.days(rows, ["variant", "state", "scenario"])
    free = sc.free_addons(F.col("day"), F.col("primary"), F.col("added"))
    return out.select("variant", "state", "scenario", *(F.col(c).cast("long").alias(c) for c in ("addons", "cases", "lost")), "first_lost", "newly_lost", free.cast("long").alias("free_addons"))
