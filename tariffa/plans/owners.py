"""Registered queries: ownership of hospitals by several definitions, and a lake from its tables to medians.

A supplier stands for a hospital, customers for owners' enrolments, lines for charge lines.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tariffa.lineage import cut
from tariffa.operators import models
from tariffa.operators import ownership as ow
from tariffa.operators import store as st
from tariffa.plans.catalog import query, t
from tariffa.plans.reference import S, shown
from tariffa.sources import lake

_SYSTEMS = [
    ("S1", "One", "Fund One", "strict", "", "PARTNERS$", "sys 1", "000005; 000007", "000003", "u"), ("S2", "Two", "Family", "ambiguous", "family", "FUND II$", "sys 2; sys 4", "", "", "u"),
    ("S3", "Three", "Creditor", "ambiguous", "creditor", "^CUSTOMER#0000000[1-4]", "", "10009", "", "u"), ("S4", "Four", "Old", "exclude", "", ".*", "", "", "", ""),
]
_KINDS = ("Proprietary", "Voluntary non-profit - Private", "Government - State", "Other")
_TYPES = ("Acute Care Hospitals", "Critical Access Hospitals", "Psychiatric")


def _pick(values, k):
    return F.element_at(F.array(*map(F.lit, values)), (k % len(values) + 1).cast("int"))


def systems(spark):
    rows = [(i, n, o, "fund", c, a, "2020", "held", p, names, inc, exc, url, "press", "2026", "quote") for i, n, o, c, a, p, names, inc, exc, url in _SYSTEMS]
    return ow.checked_systems(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ow.SYSTEM_COLUMNS)))


def roster(spark, sf):
    k = F.col("s_suppkey")
    return t(spark, sf, "supplier").select(F.lpad(k.cast("string"), 6, "0").alias("ccn"), "s_name", F.col("s_nationkey").alias("state"), _pick(_KINDS, k).alias("hospital_ownership"), _pick(_TYPES, F.col("s_nationkey")).alias("hospital_type"),
                                           F.concat(F.lit("sys "), (k % 6).cast("string")).alias("health_sys_name"), F.col("s_name").alias("facility_name")).drop("s_name")


def owner_rows(spark, sf):
    k = F.col("c_custkey")
    tail = F.when(k % 41 == 0, " capital partners").when(k % 53 == 0, "  fund ii").otherwise("")
    raw = t(spark, sf, "customer").select(k.alias("enrollment_id"), F.lpad((k % 97 + 1).cast("string"), 6, "0").alias("ccn"), F.concat("c_name", tail).alias("owner_name"), _pick(("1", "34", "35", "36", "43"), k).alias("role_code"),
                                          F.when(k % 3 != 0, (k % 100).cast("string")).alias("percent"), F.when(k % 29 == 0, "y").otherwise("n").alias("pe_flag"))
    return ow.marked(ow.owners(raw))


def _list(values):
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_FUNDS = "|".join(ow.FUND_NAMES)
BASE = f"""h AS (SELECT lpad(s_suppkey::VARCHAR, 6, '0') AS ccn, s_nationkey AS state, {_list(_KINDS)}[(s_suppkey % 4)::INT + 1] AS hospital_ownership, {_list(_TYPES)}[(s_nationkey % 3)::INT + 1] AS hospital_type, 'sys ' || (s_suppkey % 6) AS health_sys_name, s_name AS facility_name FROM supplier),
o AS (SELECT c_custkey AS enrollment_id, lpad((c_custkey % 97 + 1)::VARCHAR, 6, '0') AS ccn, upper(c_name) || CASE WHEN c_custkey % 41 = 0 THEN ' CAPITAL PARTNERS' WHEN c_custkey % 53 = 0 THEN ' FUND II' ELSE '' END AS owner_name,
  ['01', '34', '35', '36', '43'][(c_custkey % 5)::INT + 1] AS role_code, CASE WHEN c_custkey % 3 <> 0 THEN (c_custkey % 100)::DOUBLE END AS percent, c_custkey % 29 = 0 AS pe_flag FROM customer),
om AS (SELECT *, role_code IN ('01', '34', '35') AS ownership_role, regexp_matches(owner_name, '{_FUNDS}') AS fund_name FROM o),
s(system_id, classification, ambiguity, pattern, names, inc, exc) AS (VALUES {', '.join(f"('{i}', '{c}', '{a}', '{p}', '{n}', '{inc}', '{exc}')" for i, _, _, c, a, p, n, inc, exc, _ in _SYSTEMS)}),
k AS (SELECT * FROM s WHERE classification <> 'exclude'),
mo AS (SELECT system_id, ccn, max(percent) AS max_pct, 'owner_name' AS match_method FROM om JOIN k ON regexp_matches(owner_name, pattern) WHERE ownership_role GROUP BY ALL),
mi AS (SELECT system_id, lpad(trim(c), 6, '0') AS ccn, NULL::DOUBLE AS max_pct, 'include_ccns' AS match_method FROM (SELECT system_id, unnest(string_split(inc, ';')) AS c FROM k) WHERE trim(c) <> ''),
ex AS (SELECT system_id, lpad(trim(c), 6, '0') AS ccn FROM (SELECT system_id, unnest(string_split(exc, ';')) AS c FROM k) WHERE trim(c) <> ''),
li AS (SELECT DISTINCT system_id, ccn FROM (SELECT system_id, trim(unnest(string_split(names, ';'))) AS n FROM k) JOIN h ON health_sys_name = n),
us AS (SELECT *, true AS used FROM (SELECT * FROM mo UNION ALL SELECT * FROM mi WHERE (system_id, ccn) NOT IN (SELECT system_id, ccn FROM mo)) WHERE (system_id, ccn) NOT IN (SELECT system_id, ccn FROM ex)),
m AS (SELECT x.*, (x.system_id, x.ccn) IN (SELECT system_id, ccn FROM li) AS in_linkage FROM (SELECT * FROM us UNION ALL SELECT system_id, ccn, NULL, 'linkage_only', false FROM li WHERE (system_id, ccn) NOT IN (SELECT system_id, ccn FROM us)) x),
a AS (SELECT ccn, system_id, classification, ambiguity, max_pct FROM (SELECT m.*, classification, ambiguity, row_number() OVER (PARTITION BY ccn ORDER BY CASE WHEN classification = 'strict' THEN 1 WHEN ambiguity <> 'creditor' THEN 2 ELSE 3 END, system_id) AS r FROM m JOIN s USING (system_id) WHERE used) WHERE r = 1),
f AS (SELECT ccn, bool_or(pe_flag AND ownership_role) AS pe_cms, max(percent) FILTER (pe_flag AND ownership_role) AS mx, bool_or(pe_flag) AS any_role, bool_or((pe_flag OR fund_name) AND ownership_role) AS fund FROM om GROUP BY 1),
c0 AS (SELECT h.*, CASE h.hospital_ownership WHEN 'Proprietary' THEN 'for_profit_non_pe' WHEN 'Voluntary non-profit - Private' THEN 'nonprofit' WHEN 'Government - State' THEN 'government' ELSE 'unknown' END AS g, coalesce(pe_cms, false) AS pe_cms, mx AS pe_cms_max_pct,
  coalesce(mx >= 5, false) AS five, coalesce(any_role, false) AS any_role, coalesce(fund, false) AS fund, system_id, classification, ambiguity, coalesce(classification = 'strict', false) AS strict, coalesce(classification = 'ambiguous' AND ambiguity = 'creditor', false) AS creditor,
  coalesce(classification = 'ambiguous' AND ambiguity <> 'creditor', false) AS vague, h.ccn IN ('000002', '000004') AS listed FROM h LEFT JOIN f USING (ccn) LEFT JOIN a USING (ccn)),
cl AS (SELECT *, CASE WHEN strict THEN 'pe' WHEN pe_cms THEN 'cms_pe_flag' WHEN creditor THEN 'distressed_fund' ELSE g END AS group_pe_strict, CASE WHEN strict OR vague THEN 'pe' WHEN pe_cms THEN 'cms_pe_flag' WHEN creditor THEN 'distressed_fund' ELSE g END AS group_pe_broad,
  CASE WHEN strict OR vague OR creditor OR pe_cms THEN 'pe' ELSE g END AS group_pe_broad_all, CASE WHEN pe_cms THEN 'pe' ELSE g END AS group_cms_flag, CASE WHEN five THEN 'pe' ELSE g END AS group_cms_flag_5pct, CASE WHEN any_role THEN 'pe' ELSE g END AS group_cms_flag_any_role,
  CASE WHEN fund THEN 'pe' ELSE g END AS group_fund_name, CASE WHEN strict OR listed THEN 'pe' WHEN pe_cms THEN 'cms_pe_flag' WHEN creditor THEN 'distressed_fund' ELSE g END AS group_researcher_list FROM c0)"""


def classes(spark, sf):
    rows, listed = owner_rows(spark, sf), spark.createDataFrame([("000002",), ("000004",)], "ccn string")
    best = ow.assigned(ow.system_map(systems(spark), rows, roster(spark, sf)), systems(spark))
    return ow.classified(roster(spark, sf), rows, best, listed)


_GROUPS = [f"group_{d}" for d in ow.DEFINITIONS]


@query(f"WITH {BASE} SELECT ccn, state, pe_cms, pe_cms_max_pct, system_id, {', '.join(_GROUPS)} FROM cl")
def ownership_classes(spark, sf):
    return classes(spark, sf).select("ccn", "state", "pe_cms", "pe_cms_max_pct", "system_id", *_GROUPS)


@query(f"""WITH {BASE} SELECT definition, dimension, level, "group", count(*) AS n_hospitals FROM (SELECT substring(definition, 7) AS definition, unnest(['hospital_type', 'state']) AS dimension, unnest([hospital_type, state::VARCHAR]) AS level, "group"
FROM (UNPIVOT (SELECT ccn, hospital_type, state, {', '.join(_GROUPS)} FROM cl) ON {', '.join(_GROUPS)} INTO NAME definition VALUE "group")) GROUP BY ALL""")
def ownership_counts(spark, sf):
    return ow.group_counts(classes(spark, sf), ["hospital_type", "state"])


@query(f"WITH {BASE} SELECT system_id, ccn, match_method, max_pct, in_linkage, used FROM m")
def system_map(spark, sf):
    return ow.system_map(systems(spark), owner_rows(spark, sf), roster(spark, sf)).select("system_id", "ccn", "match_method", "max_pct", "in_linkage", "used")


@query(f"""WITH {BASE}, p AS (SELECT ccn FROM h WHERE state % 2 = 0) SELECT s.system_id, s.classification, coalesce(n_ccns, 0) AS n_ccns, coalesce(n_owner_name, 0) AS n_owner_name, coalesce(n_include_ccns, 0) AS n_include_ccns, coalesce(n_roster, 0) AS n_roster, coalesce(n_general, 0) AS n_general,
coalesce(n_assigned, 0) AS n_assigned, coalesce(n_priced, 0) AS n_priced, coalesce(n_in_linkage, 0) AS n_in_linkage, coalesce(n_linkage_only, 0) AS n_linkage_only, coalesce(n_below_50pct, 0) AS n_below_50pct FROM s LEFT JOIN (SELECT system_id, count(*) FILTER (used) AS n_ccns, count(*) FILTER (match_method = 'owner_name') AS n_owner_name, count(*) FILTER (match_method = 'include_ccns') AS n_include_ccns,
count(*) FILTER (used AND ccn IN (SELECT ccn FROM h)) AS n_roster, count(*) FILTER (used AND ccn IN (SELECT ccn FROM h WHERE hospital_type <> 'Psychiatric')) AS n_general, count(*) FILTER (used AND (ccn, system_id) IN (SELECT ccn, system_id FROM a)) AS n_assigned,
count(*) FILTER (used AND ccn IN (SELECT ccn FROM h WHERE hospital_type <> 'Psychiatric') AND ccn IN (SELECT ccn FROM p)) AS n_priced, count(*) FILTER (used AND in_linkage) AS n_in_linkage, count(*) FILTER (match_method = 'linkage_only') AS n_linkage_only, count(*) FILTER (used AND coalesce(max_pct < 50, false)) AS n_below_50pct FROM m GROUP BY 1) USING (system_id)""")
def system_counts(spark, sf):
    mapped = ow.system_map(systems(spark), owner_rows(spark, sf), roster(spark, sf))
    out = ow.system_counts(systems(spark), mapped, ow.assigned(mapped, systems(spark)), roster(spark, sf), roster(spark, sf).where("state % 2 = 0"))
    return out.drop("system_name", "owner", "ambiguity")


@query(f"""WITH {BASE}, x AS (SELECT om.*, CASE WHEN pe_flag THEN 'cms_flag' ELSE 'fund_name' END AS basis, h.facility_name, h.ccn IS NOT NULL AS r, h.state % 2 = 0 AS p FROM om LEFT JOIN h USING (ccn) WHERE pe_flag OR (fund_name AND ownership_role))
SELECT owner_name, basis, count(DISTINCT enrollment_id) AS n_enrollments, count(DISTINCT ccn) AS n_ccns, count(DISTINCT CASE WHEN r THEN ccn END) AS n_roster_ccns, count(DISTINCT CASE WHEN p THEN ccn END) AS n_priced_ccns, string_agg(DISTINCT role_code, ';' ORDER BY role_code) AS roles,
min(percent) AS pct_min, max(percent) AS pct_max, coalesce(array_to_string(list_sort(list(DISTINCT facility_name) FILTER (facility_name IS NOT NULL))[:3], ' | '), '') AS examples FROM x GROUP BY ALL""")
def largest_owners(spark, sf):
    return ow.largest_owners(owner_rows(spark, sf), roster(spark, sf), roster(spark, sf).where("state % 2 = 0"))


_PRICES = BASE + f""", pr AS (SELECT lpad(l_suppkey::VARCHAR, 6, '0') AS ccn, l_returnflag AS code, l_linestatus AS payer_type, median(l_extendedprice) AS price FROM lineitem GROUP BY ALL),
fr AS (SELECT pr.*, cl.* EXCLUDE (ccn) FROM pr JOIN cl USING (ccn)), lo AS (SELECT ccn, code, payer_type, state, price, substring(definition, 7) AS definition, "group" FROM (UNPIVOT (SELECT ccn, code, payer_type, state, price, {', '.join(_GROUPS)} FROM fr) ON {', '.join(_GROUPS)} INTO NAME definition VALUE "group"))"""


def frame(spark, sf):
    prices = t(spark, sf, "lineitem").groupBy(F.lpad(F.col("l_suppkey").cast("string"), 6, "0").alias("ccn"), F.col("l_returnflag").alias("code"), F.col("l_linestatus").alias("payer_type")).agg(F.expr("percentile(l_extendedprice, 0.5D)").alias("price"))
    return prices.join(classes(spark, sf), "ccn")


@query(f"""WITH {_PRICES} SELECT definition, code, payer_type, "group", count(*) AS n_hospitals, count(DISTINCT state) AS n_states, {S('median(price)', 'median_price')}, {S('quantile_cont(price, 0.25)', 'p25')}, {S('quantile_cont(price, 0.75)', 'p75')} FROM lo WHERE "group" <> 'unknown' GROUP BY ALL""")
def ownership_raw(spark, sf):
    return shown(ow.raw_summary(frame(spark, sf)), "median_price", "p25", "p75")


@query(f"""WITH {_PRICES}, ce AS (SELECT definition, code, payer_type, state, "group", median(price) AS m, count(*) AS n FROM lo GROUP BY ALL), b AS (SELECT * FROM ce WHERE "group" = 'nonprofit')
SELECT definition, code, payer_type, ce."group", count(*) AS n_states, sum(ce.n)::BIGINT AS n_group, sum(b.n)::BIGINT AS n_reference, {S('median(ce.m - b.m)', 'median_difference')}, {S('median(ce.m / b.m - 1)', 'median_share')}, {S('avg((ce.m > b.m)::INT)', 'share_states_higher')}
FROM ce JOIN b USING (definition, code, payer_type, state) WHERE ce."group" NOT IN ('unknown', 'nonprofit') GROUP BY ALL""")
def ownership_within_states(spark, sf):
    return shown(ow.within_states(frame(spark, sf)), "median_difference", "median_share", "share_states_higher")


@query(f"""WITH {_PRICES}, b AS (SELECT code, payer_type, state, median(price) AS base FROM fr WHERE group_pe_strict = 'nonprofit' GROUP BY ALL), x AS (SELECT fr.*, price / base AS ratio FROM fr JOIN b USING (code, payer_type, state) WHERE system_id IS NOT NULL)
SELECT system_id, classification, ambiguity, code, payer_type, count(*) AS n_hospitals, count(DISTINCT state) AS n_states, {S('median(ratio) - 1', 'median_share')}, {S('quantile_cont(ratio, 0.25) - 1', 'p25')}, {S('quantile_cont(ratio, 0.75) - 1', 'p75')}, {S('avg((ratio > 1)::INT)', 'share_above')} FROM x GROUP BY ALL""")
def system_ratios(spark, sf):
    return shown(ow.system_ratios(frame(spark, sf)), "median_share", "p25", "p75", "share_above")


@query(f"""WITH {_PRICES}, g AS (SELECT definition, code, payer_type, "group" AS term, avg(price) AS estimate, count(*) AS n_group, count(DISTINCT ccn[5:6]) AS n_group_clusters FROM lo GROUP BY ALL),
x AS (SELECT *, CASE WHEN code = 'A' THEN '58300' ELSE code END AS code2, CASE WHEN payer_type = 'F' THEN 'medicare' ELSE payer_type END AS payer2 FROM g)
SELECT definition, code2 AS code, payer2 AS payer_type, term, n_group, n_group_clusters, max(n_group) FILTER (term = 'pe') OVER w AS n_pe, max(n_group_clusters) FILTER (term = 'pe') OVER w AS n_pe_clusters, n_group_clusters < 5 OR n_group < 10 AS exploratory, NOT (code2 = '58300' AND payer2 = 'medicare') AS payment_comparison,
CASE WHEN code2 = '58300' AND payer2 = 'medicare' THEN 'not a comparison of payments' WHEN n_group_clusters < 5 AND n_group < 10 THEN 'exploratory: fewer than 5 systems and fewer than 10 hospitals' WHEN n_group_clusters < 5 THEN 'exploratory: fewer than 5 systems' WHEN n_group < 10 THEN 'exploratory: fewer than 10 hospitals' END AS note
FROM x WINDOW w AS (PARTITION BY code2, payer2, definition)""")
def model_flags(spark, sf):
    long = ow.by_definition(frame(spark, sf), ["ccn", "code", "payer_type", "price"])
    cells = long.groupBy("definition", "code", "payer_type", F.col("group").alias("term")).agg(F.avg("price").alias("estimate"), F.count("*").alias("n_group"), F.count_distinct(F.substring("ccn", 5, 2)).alias("n_group_clusters"))
    named = cells.withColumns({"code": F.when(F.col("code") == "A", "58300").otherwise(F.col("code")), "payer_type": F.when(F.col("payer_type") == "F", "medicare").otherwise(F.col("payer_type"))})
    return ow.flagged(named).drop("estimate")


def model_rows(spark, sf):
    """The frame by definition, with log prices and a cluster of hospitals."""
    rows = frame(spark, sf).where("price > 0").withColumns({"log_price": F.log("price"), "cluster": F.concat(F.lit("s"), (F.col("ccn").cast("int") % 12).cast("string"))})
    return ow.by_definition(rows, ["ccn", "code", "payer_type", "log_price", "cluster", "hospital_type", "hospital_ownership", "state"])


@query(f"""WITH {_PRICES}, r AS (SELECT definition, code, payer_type, "group" AS g, ln(price) AS y, 's' || (ccn::INT % 12) AS cl FROM lo WHERE price > 0 AND "group" <> 'unknown'),
sz AS (SELECT definition, code, payer_type, g, count(*) AS n_group, count(DISTINCT cl) AS n_group_clusters FROM r GROUP BY ALL),
ft AS (SELECT r.*, n_group FROM r JOIN sz USING (definition, code, payer_type, g) WHERE n_group >= 3 OR g = 'nonprofit'),
ce AS (SELECT definition, code, payer_type, count(*) AS n, count(DISTINCT cl) AS c, count(DISTINCT g) AS k FROM ft GROUP BY ALL HAVING count(*) FILTER (g = 'nonprofit') >= 3 AND count(DISTINCT g) > 1 AND count(DISTINCT cl) >= 3),
me AS (SELECT definition, code, payer_type, g, avg(y) AS m FROM ft GROUP BY ALL),
sc AS (SELECT definition, code, payer_type, g, cl, sum((y - m) / n_group) AS s FROM ft JOIN me USING (definition, code, payer_type, g) GROUP BY ALL),
te AS (SELECT t.definition, t.code, t.payer_type, t.g, t.m - b.m AS estimate FROM me t JOIN me b ON (t.definition, t.code, t.payer_type) = (b.definition, b.code, b.payer_type) AND b.g = 'nonprofit' WHERE t.g <> 'nonprofit'),
va AS (SELECT definition, code, payer_type, g, sum(s * s) AS v FROM (SELECT te.definition, te.code, te.payer_type, te.g, cl, sum(CASE WHEN sc.g = te.g THEN s WHEN sc.g = 'nonprofit' THEN -s ELSE 0 END) AS s FROM te JOIN sc USING (definition, code, payer_type) GROUP BY te.definition, te.code, te.payer_type, te.g, cl) GROUP BY ALL)
SELECT definition, code, payer_type, g AS term, n_group, n_group_clusters, {S('CASE WHEN ce.n IS NOT NULL THEN estimate END', 'estimate')}, {S('sqrt(c / (c - 1) * (n - 1) / (n - k) * v)', 'std_error')}, n, c AS n_clusters
FROM sz LEFT JOIN (te JOIN ce USING (definition, code, payer_type) JOIN va USING (definition, code, payer_type, g)) USING (definition, code, payer_type, g) WHERE g <> 'nonprofit'""")
def group_effects(spark, sf):
    """Effects without covariates, which SQL can tell: differences of mean logarithms with clustered errors."""
    out = models.group_models(model_rows(spark, sf), ["definition", "code", "payer_type"], "log_price", "group", ow.GROUPS, "cluster", draws=0)
    return shown(out, "estimate", "std_error").select("definition", "code", "payer_type", "term", "n_group", "n_group_clusters", "estimate", "std_error", "n", "n_clusters")


#: The terms that are bootstrapped. Fixed values.
SERIES = ({"definition": "pe_strict", "term": "pe"}, {"definition": "pe_broad", "term": "pe"}, {"definition": "pe_strict", "term": "for_profit_non_pe"})


@query()
def ownership_models(spark, sf):
    """Every cell and definition with its covariates, the bootstrap of the listed series with all draws, and the flags that follow from the models."""
    out = models.group_models(model_rows(spark, sf), ["definition", "code", "payer_type"], "log_price", "group", ow.GROUPS, "cluster", ["hospital_type", "hospital_ownership", "state"], SERIES)
    return ow.flagged(out.drop("note"))


def share_rows(spark, sf):
    """Suppliers as counties with their nation as state: lines, those that came back, and a covariate."""
    lines = t(spark, sf, "lineitem").groupBy("l_suppkey", "l_linestatus").agg(F.count("*").alias("births"), F.sum((F.col("l_returnflag") != "A").cast("int")).alias("part"))
    rows = lines.join(t(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey", (F.col("s_acctbal") / 1000).alias("x")), "l_suppkey")
    return rows.withColumn("rate", 100 * F.col("part") / F.col("births"))


@query(f"""WITH r AS (SELECT l_linestatus, s_nationkey, s_acctbal / 1000 AS x, count(*) AS w, 100.0 * count(*) FILTER (l_returnflag <> 'A') / count(*) AS y FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_suppkey, l_linestatus, s_nationkey, s_acctbal),
m AS (SELECT *, x - sum(w * x) OVER s / sum(w) OVER s AS dx, y - sum(w * y) OVER s / sum(w) OVER s AS dy FROM r WINDOW s AS (PARTITION BY l_linestatus, s_nationkey)),
b AS (SELECT l_linestatus, sum(w * dx * dy) / sum(w * dx * dx) AS b, sum(w * dx * dx) AS d, count(*) AS n, count(DISTINCT s_nationkey) AS g FROM m GROUP BY 1),
e AS (SELECT l_linestatus, s_nationkey, sum(w * dx * (dy - b * dx)) AS s, count(*) AS m FROM m JOIN b USING (l_linestatus) GROUP BY ALL), v AS (SELECT l_linestatus, sum(s * s) AS v, count(*) FILTER (m > 1) AS n_identifying FROM e GROUP BY 1)
SELECT l_linestatus, 'x' AS term, {S('b', 'estimate')}, {S('CASE WHEN n > g + 1 THEN sqrt(g / (g - 1) * (n - 1) / (n - g - 1) * v) / d END', 'std_error')}, n, g AS n_clusters, n_identifying FROM b JOIN v USING (l_linestatus) WHERE g > 1 AND n_identifying > 0""")
def weighted_effects(spark, sf):
    """Weighted slopes with fixed effects of states and errors by state, where a state has two rows or more: without one nothing within states tells the slope."""
    out = models.linear_models(share_rows(spark, sf), ["l_linestatus"], "rate", ["x"], "s_nationkey", ["s_nationkey"], "births", draws=0).where("n_identifying > 0")
    return shown(out, "estimate", "std_error").select("l_linestatus", "term", "estimate", "std_error", "n", "n_clusters", "n_identifying")


@query()
def weighted_bootstrap(spark, sf):
    return models.linear_models(share_rows(spark, sf), ["l_linestatus"], "rate", ["x"], "s_nationkey", ["s_nationkey"], "births")


@query()
def share_effects(spark, sf):
    return models.share_models(share_rows(spark, sf), ["l_linestatus"], "part", "births", ["x"], "s_nationkey", ["s_nationkey"])


#: concept, code, family of the lake's targets.
BOOK = [("emb", "58100", "procedure"), ("colonoscopy", "45378", "procedure"), ("screening", "G0121", "procedure"), ("hysterectomy", "742", "ms_drg"), ("birth", "560-1", "apr_drg")]
_PAYERS = ("Aetna PPO", "Medicare", "State Medicaid", "Humana Medicare Advantage", "Odd Club")
_METHODS = ("fee schedule", "case rate", "percent of total billed charges", "per diem", "other")


def lake_tables(spark, sf):
    k, n = F.col("l_partkey"), F.col("l_linenumber")
    line = t(spark, sf, "lineitem").join(t(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority"), "l_orderkey")
    details = line.select(
        F.col("l_suppkey").alias("hospital_id"), F.when(k % 6 == 0, "58100").when(k % 6 == 1, " 45378.0").alias("cpt"), F.when(k % 7 == 0, "g0121").alias("hcpcs"), F.when(k % 9 == 0, "0742").alias("ms_drg"),
        F.when(k % 10 == 0, "5601").when(k % 10 == 1, "742").when(k % 10 == 2, "58100").alias("other_code1"), F.when(k % 4 == 0, "apr drg").when(k % 4 == 1, "DRG").when(k % 4 == 2, "CDM").alias("other_code1_type"),
        _pick(_PAYERS, F.col("o_custkey")).alias("payer_name"), F.col("o_orderpriority").alias("plan_name"), F.when(n % 3 == 0, "inpatient").otherwise("outpatient").alias("setting"),
        F.when(n < 4, "facility").when(n < 6, "professional").alias("billing_class"), (F.col("l_extendedprice") * F.when(n.isin(4, 5), 0.1).otherwise(1.0)).alias("gross_charge"), (F.col("l_extendedprice") * 0.5).alias("discounted_cash"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("standard_charge_dollar"), _pick(_METHODS, k).alias("methodology"), F.col("l_linestatus").alias("description"),
    )
    s = F.col("s_suppkey")
    hospitals = t(spark, sf, "supplier").select(s.alias("hospital_id"), F.col("s_name").alias("hospital_name"), F.concat(F.lit("https://www.files.org/"), (s % 50).cast("string"), F.lit(".csv?x=1")).alias("mrf_url"), F.lit("Not provided").alias("version"), F.col("s_nationkey").cast("string").alias("state"))
    return {"standard_charge_details": details, "hospitals": hospitals}


_PLIST, _MLIST = _list(_PAYERS), _list(_METHODS)
LAKE = f"""d AS (SELECT row_number() OVER () AS rk, l_suppkey, l_partkey, l_linestatus, {_PLIST}[(o_custkey % 5)::INT + 1] AS payer_name, o_orderpriority AS plan_name, CASE WHEN l_linenumber % 3 = 0 THEN 'inpatient' ELSE 'outpatient' END AS setting,
  CASE WHEN l_linenumber < 4 THEN 'facility' WHEN l_linenumber < 6 THEN 'professional' END AS billing_class, l_extendedprice * CASE WHEN l_linenumber IN (4, 5) THEN 0.1::DOUBLE ELSE 1 END AS gross, l_extendedprice * (1 - l_discount) AS dollar, l_extendedprice * 0.5 AS cash, {_MLIST}[(l_partkey % 5)::INT + 1] AS methodology
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
rep AS (SELECT s_suppkey % 50 AS file, min(s_suppkey) AS l_suppkey FROM supplier GROUP BY 1), st AS (SELECT d.*, file FROM d JOIN rep USING (l_suppkey)),
co AS (SELECT rk, '58100' AS code, 'emb' AS concept, 'CPT' AS code_type, true AS type_verified FROM st WHERE l_partkey % 6 = 0 UNION SELECT rk, '45378', 'colonoscopy', 'CPT', true FROM st WHERE l_partkey % 6 = 1 UNION SELECT rk, 'G0121', 'screening', 'HCPCS', true FROM st WHERE l_partkey % 7 = 0
  UNION SELECT rk, '742', 'hysterectomy', 'MS-DRG', true FROM st WHERE l_partkey % 9 = 0 UNION SELECT rk, '560-1', 'birth', 'APR-DRG', true FROM st WHERE l_partkey % 10 = 0 AND l_partkey % 4 = 0
  UNION SELECT rk, '742', 'hysterectomy', CASE WHEN l_partkey % 4 = 1 THEN 'DRG' END, false FROM st WHERE l_partkey % 10 = 1 AND l_partkey % 4 IN (1, 3)
  UNION SELECT rk, '58100', 'emb', CASE WHEN l_partkey % 4 = 3 THEN NULL END, false FROM st WHERE l_partkey % 10 = 2 AND l_partkey % 4 = 3),
ro AS (SELECT st.*, concept, code, code_type, type_verified FROM st JOIN co USING (rk))"""


@query(f"""WITH {LAKE} SELECT md5('files.org/' || file || '.csv') AS mrf_file_id, concept, code, code_type, type_verified, payer_name, count(*) AS n, round(sum(dollar) + 1e-7, 2) AS dollars FROM ro GROUP BY ALL""")
def lake_extract(spark, sf):
    stage = lake.staged(lake.relations(lake_tables(spark, sf)), BOOK)
    rows = lake.extracted(stage, BOOK)
    return rows.groupBy("mrf_file_id", "concept", "code", "code_type", "type_verified", "payer_name").agg(F.count("*").alias("n"), F.round(F.sum("negotiated_dollar") + 1e-7, 2).alias("dollars"))


@query("""SELECT s_suppkey::VARCHAR AS facility_key, 'lake' AS source, 'https://www.files.org/' || (s_suppkey % 50) || '.csv?x=1' AS mrf_url, md5('files.org/' || (s_suppkey % 50) || '.csv') AS mrf_file_id, s_name AS hospital_name, s_nationkey::VARCHAR AS state FROM supplier""")
def lake_facilities(spark, sf):
    return lake.exported_facilities(lake.relations(lake_tables(spark, sf))).select("facility_key", "source", "mrf_url", "mrf_file_id", "hospital_name", "state")


@query("SELECT 'hospitals' AS relation, unnest([0, 1, 2, 3, 4]) AS place, unnest(['hospital_id', 'hospital_name', 'mrf_url', 'version', 'state']) AS \"column\", unnest(['bigint', 'string', 'string', 'string', 'string']) AS data_type")
def lake_columns(spark, sf):
    return lake.introspected(spark, {"hospitals": lake_tables(spark, sf)["hospitals"]})


#: Abbreviations that stand for the nations' numbers.
_STATES = tuple("AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO".split())

# Files may have no hospital (no ccn, one that isn't in the roster, or one in conflict), several of them, matches without a
# score, and a state that only the facilities' labels, their addresses or the licence tell.
_MEDIANS = LAKE + f""", ex AS (SELECT concept, code, billing_class, file, min(gross) AS least FROM ro WHERE billing_class IS NOT NULL AND setting <> 'inpatient' AND gross > 1 GROUP BY ALL),
ty AS (SELECT concept, code, max(m) FILTER (billing_class = 'facility') AS fg, max(n) FILTER (billing_class = 'facility') AS fn, max(m) FILTER (billing_class = 'professional') AS pg, max(n) FILTER (billing_class = 'professional') AS pn FROM (SELECT concept, code, billing_class, median(least) AS m, count(*) AS n FROM ex GROUP BY ALL) GROUP BY ALL),
cu AS (SELECT concept, code, CASE WHEN fn >= 20 AND pn >= 20 AND fg >= 2.5 * pg THEN sqrt(fg * pg) END AS cutoff, 10 * fg AS facility_line, 10 * pg AS professional_line FROM ty),
fe AS (SELECT ro.*, cutoff, facility_line, professional_line, CASE WHEN billing_class = 'professional' THEN 'professional' WHEN billing_class = 'facility' THEN 'facility' WHEN gross > 1 AND gross < cutoff THEN 'professional' ELSE 'facility' END AS fee_type,
  coalesce(billing_class IS NULL AND gross > 1 AND cutoff IS NOT NULL, false) AS inferred, CASE WHEN methodology = 'per diem' AND code = '742' AND dollar < 3 * 9000 THEN dollar * 2.5 ELSE dollar END AS case_dollar,
  CASE payer_name WHEN 'Aetna PPO' THEN 'commercial' WHEN 'Medicare' THEN 'medicare' WHEN 'State Medicaid' THEN 'medicaid' WHEN 'Humana Medicare Advantage' THEN 'medicare_advantage' ELSE 'other' END AS payer_type FROM ro LEFT JOIN cu USING (concept, code)),
fa AS (SELECT *, coalesce(concept IN ('emb', 'colonoscopy', 'screening') AND gross > CASE WHEN fee_type = 'professional' THEN professional_line ELSE facility_line END, false) AS case_line FROM fe),
ok AS (SELECT * FROM fa WHERE NOT (fee_type = 'professional' AND inferred) AND NOT (concept IN ('emb', 'colonoscopy', 'screening') AND (setting = 'inpatient' OR case_line)) AND NOT (concept = 'emb' AND methodology IN ('case rate', 'per diem')) AND NOT (concept = 'birth' AND methodology = 'per diem')),
sup AS (SELECT s_suppkey AS s, s_suppkey % 50 AS file, {_list(_STATES)}[s_nationkey + 1] AS st FROM supplier),
fs AS (SELECT file, st AS file_state FROM sup WHERE s % 13 <> 0 GROUP BY file, st QUALIFY row_number() OVER (PARTITION BY file ORDER BY count(*) DESC, st) = 1),
good AS (SELECT file, s::VARCHAR AS ccn, CASE WHEN s % 11 = 0 THEN ' ' ELSE st END AS hospital_state FROM sup WHERE s % 7 <> 0 AND s % 17 <> 0 AND s % 19 <> 0),
uf AS (SELECT f.file, ccn, coalesce(ccn, 'file:' || f.file) AS unit, coalesce(nullif(trim(hospital_state), ''), file_state, CASE WHEN f.file % 3 = 1 THEN 'TX' END) AS state FROM (SELECT DISTINCT file FROM sup) f LEFT JOIN good USING (file) LEFT JOIN fs USING (file)),
un AS (SELECT ok.*, ccn, unit, state FROM ok JOIN uf USING (file) WHERE state IS NOT NULL),
pl AS (SELECT state, unit, concept, code, fee_type, payer_type, payer_name, plan_name, median(case_dollar) AS m FROM un WHERE dollar > 1 AND dollar < 2000000 GROUP BY ALL),
uu AS (SELECT state, unit, concept, code, fee_type, payer_type, median(m) AS price, count(*) AS n FROM pl GROUP BY ALL
  UNION ALL SELECT state, unit, concept, code, fee_type, 'self_pay_cash', median(cash), count(*) FROM (SELECT DISTINCT state, unit, concept, code, fee_type, l_linestatus, cash FROM un WHERE cash > 1 AND cash < 2000000) GROUP BY ALL
  UNION ALL SELECT state, unit, concept, code, fee_type, 'gross_charge', median(gross), count(*) FROM (SELECT DISTINCT state, unit, concept, code, fee_type, l_linestatus, gross FROM un WHERE gross > 1 AND gross < 5000000) GROUP BY ALL),
le AS (SELECT unnest([state, 'US']) AS state, concept, code, fee_type, payer_type, price, n FROM uu),
me AS (SELECT state, concept, code, fee_type, payer_type, median(price) AS median_price, quantile_cont(price, 0.25) AS p25, quantile_cont(price, 0.75) AS p75, count(*) AS n_hospitals, sum(n)::BIGINT AS n_rates FROM le GROUP BY ALL)"""


def lake_store(spark, sf):
    """The store of the lake's tables by way of the extract."""
    rel = lake.relations(lake_tables(spark, sf))
    prices = cut(lake.extracted(lake.staged(rel, BOOK), BOOK))  # read by each dimension and by the facts
    file = F.regexp_extract("mrf_url", "/([0-9]+)[.]csv", 1).cast("int")
    prices = prices.withColumn("license_state", F.when(file % 3 == 1, "tx"))
    s, label = F.col("facility_key").cast("int"), F.element_at(F.array(*map(F.lit, _STATES)), F.col("state").cast("int") + 1)
    facilities = lake.exported_facilities(rel)
    crosswalk = facilities.select(
        "mrf_file_id", "hospital_name", F.when(s % 7 != 0, F.col("facility_key")).alias("ccn"), F.when(s % 3 == 0, "mrf_url").otherwise("name").alias("ccn_match_method"), F.when(s % 3 != 0, 0.9).alias("ccn_match_score"), (s % 19 == 0).alias("ccn_conflict"), F.lit(None).cast("boolean").alias("ccn_ambiguous"),
        F.when(s % 13 == 0, "n/a").when(s % 5 == 1, F.concat(F.lit(" "), F.lower(label))).when(s % 5 != 0, label).alias("state"), F.when(s % 13 != 0, F.concat(F.lit("1 Main St, Town, "), label, F.lit(" 12345"))).alias("address"),
    )
    hospitals = facilities.where(s % 17 != 0).select(F.col("facility_key").alias("ccn"), F.when(s % 11 == 0, " ").otherwise(label).alias("state"))
    stays = spark.createDataFrame([("742", 2.5, 9000.0), ("560-1", 3.0, 1000.0), ("58100", 4.0, 1000.0)], "code string, gmlos double, medicare_per_day double")
    return st.build(prices, crosswalk, hospitals, stays, outpatient=("emb", "colonoscopy", "screening"), anchors=("58100", "45378"))


def lake_rates(spark, sf):
    """Usable rates by hospital or file."""
    return lake_store(spark, sf).hospital_rates().where(st.usable(("emb", "colonoscopy", "screening"), ("emb",), ("birth",)))


def lake_medians(spark, sf):
    rates = lake_rates(spark, sf).withColumn("paid", F.when(F.col("plausible"), F.col("case_dollar")))
    return st.geographic_medians(rates, "paid", "unit_id", "state", ["concept", "code", "fee_type"], "payer_type", ["payer_name", "plan_name"], "discounted_cash", "gross", ["description"])


@query(f"""WITH {_MEDIANS}
SELECT state, concept, code, fee_type, payer_type, {S('median_price', 'median_price')}, {S('p25', 'p25')}, {S('p75', 'p75')}, n_hospitals, n_rates FROM me""")
def lake_to_medians(spark, sf):
    return shown(lake_medians(spark, sf), "median_price", "p25", "p75")


@query(f"""WITH {_MEDIANS}, h AS (SELECT state, payer_type, CASE code WHEN '45378' THEN 'colonoscopy_45378' ELSE 'emb_58100' END AS procedure, CASE WHEN n_hospitals >= 3 THEN median_price END AS value FROM me WHERE code IN ('45378', '58100') AND fee_type = 'facility' AND payer_type <> 'self_pay')
SELECT state, payer_type, {S("max(value) FILTER (procedure = 'colonoscopy_45378')", 'colonoscopy_45378')}, {S("max(value) FILTER (procedure = 'emb_58100')", 'emb_58100')} FROM h GROUP BY ALL""")
def lake_headline(spark, sf):
    return shown(st.headline(lake_medians(spark, sf)), "colonoscopy_45378", "emb_58100").select("state", "payer_type", "colonoscopy_45378", "emb_58100")


@query(f"""WITH {_MEDIANS}, nm AS (SELECT s_suppkey % 50 AS file, min(s_name) AS hospital_name, count(*) AS n FROM supplier GROUP BY 1), b AS (SELECT file, count(*) AS n_ccns, count(*) FILTER (ccn::INT % 3 <> 0) AS n_scored, bool_or(ccn::INT % 19 = 0) AS conflict FROM (SELECT file, s::VARCHAR AS ccn FROM sup WHERE s % 7 <> 0 AND s % 17 <> 0) GROUP BY 1)
SELECT md5('files.org/' || file || '.csv') AS mrf_file_id, hospital_name, file_state, CASE WHEN file % 3 = 1 THEN 'TX' END AS license_state, c.n_rows, coalesce(n_ccns, 0) AS n_ccns, coalesce(n_scored, 0) AS n_scored, coalesce(conflict, false) AS conflict
FROM (SELECT file, count(*) AS n_rows FROM ro GROUP BY 1) c JOIN nm USING (file) LEFT JOIN fs USING (file) LEFT JOIN b USING (file)""")
def lake_files(spark, sf):
    s = lake_store(spark, sf)
    matched = s.bridge.groupBy("file_id").agg(F.count("*").alias("n_ccns"), F.count("ccn_match_score").alias("n_scored"), F.bool_or("ccn_conflict").alias("conflict"))
    files = s.dim_file.join(matched, "file_id", "left").fillna(0, ["n_ccns", "n_scored"]).fillna(False, ["conflict"])
    return files.select("mrf_file_id", "hospital_name", "file_state", "license_state", "n_rows", "n_ccns", "n_scored", "conflict")


@query(f"""WITH {_MEDIANS} SELECT unit AS ccn, code, payer_type, {S('median(m)', 'price')}, count(*) AS n_contracts, sum(n)::BIGINT AS n_rows FROM (SELECT unit, code, payer_type, payer_name, plan_name, median(case_dollar) AS m, count(*) AS n FROM un WHERE ccn IS NOT NULL AND dollar > 1 AND dollar < 2000000 AND fee_type = 'facility' AND code IN ('58100', '45378', '742') AND payer_type IN ('commercial', 'medicaid') AND file <> 3 GROUP BY ALL) GROUP BY ALL""")
def facility_prices(spark, sf):
    gone = spark.createDataFrame([("files.org/3.csv",)], "u string").select(F.md5("u").alias("mrf_file_id"))
    return shown(ow.facility_prices(lake_rates(spark, sf), ("58100", "45378", "742"), ("commercial", "medicaid"), gone), "price")


@query("""WITH b AS (SELECT p_partkey AS concept, CASE WHEN p_size % 2 = 0 THEN 58000 + p_partkey % 500 ELSE 100 + p_partkey % 900 END::VARCHAR AS code, CASE WHEN p_size % 2 = 0 THEN 'procedure' ELSE 'ms_drg' END AS code_family FROM part),
f AS (SELECT (58000 + o_orderkey % 300)::VARCHAR AS code, min(o_orderpriority) AS status FROM orders WHERE o_orderkey % 4 <> 0 GROUP BY 1)
SELECT concept, b.code, code_family, status, CASE code_family WHEN 'procedure' THEN f.code IS NOT NULL END AS listed FROM b LEFT JOIN f ON b.code = f.code""")
def codebook_check(spark, sf):
    k, procedure = F.col("p_partkey"), F.col("p_size") % 2 == 0
    book = t(spark, sf, "part").select(k.alias("concept"), F.when(procedure, 58000 + k % 500).otherwise(100 + k % 900).cast("string").alias("code"), F.when(procedure, "procedure").otherwise("ms_drg").alias("code_family"))
    o = F.col("o_orderkey")
    schedule = t(spark, sf, "orders").where(o % 4 != 0).select(F.format_string(" %d.0", 58000 + o % 300).alias("code"), F.col("o_orderpriority").alias("status"))
    return lake.codebook_check(book, schedule)
