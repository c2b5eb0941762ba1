"""Ownership of hospitals: classes from owner rows, systems by patterns, model frames and raw comparisons."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariffa.functions import rules
from tariffa.functions import text as tx
from tariffa.operators import aggregates as agg
from tariffa.operators import windows as win
from tariffa.operators.joins import pattern_join

#: Least percentage that counts as a holding. Fixed value.
LEAST_PERCENT = 5.0


def owners(rows: DataFrame) -> DataFrame:
    """Owner rows with padded role codes and squeezed upper-case names. rows: enrollment_id, owner_name, role_code, percent, pe_flag."""
    name = F.upper(F.regexp_replace(F.trim("owner_name"), r"\s+", " "))
    return rows.withColumns({"owner_name": name, "role_code": F.lpad("role_code", 2, "0"), "percent": F.col("percent").try_cast("double"), "pe_flag": F.coalesce(F.upper("pe_flag") == "Y", F.lit(False))})


def enrollment_ccns(enrollments: DataFrame) -> DataFrame:
    """One ccn an enrolment, the first in order."""
    return enrollments.where("ccn is not null").groupBy("enrollment_id").agg(F.min("ccn").alias("ccn"))


#: Owner roles, names that mark a fund, classes of listed systems, ownership groups and definitions. Fixed values.
ROLES = {"direct": ("01", "34"), "indirect": ("35",), "partnership": ("03", "38", "39"), "ownership": ("01", "03", "34", "35", "38", "39")}
FUND_NAMES = (
    "PRIVATE EQUITY", "EQUITY PARTNERS", "CAPITAL PARTNERS", r"\bFUNDS?\b", r"\bAIV\b", "CO-?INVEST",
    "^GENERAL ATLANTIC", "^DAVIDSON KEMPNER", "^DK (LDOI|DISTRESSED|QUINCY)", "^DKLDOI", "^GOLDENTREE", "^GTAM ",
    "^WELSH,? CARSON", "^TPG VII", "^BAIN CAPITAL", "^ONE EQUITY", "^DEERFIELD", "^OAK HC/FT", "^BW CLEARSKY",
)
CLASSES = ("strict", "ambiguous", "exclude")
GROUPS = ("nonprofit", "pe", "cms_pe_flag", "distressed_fund", "for_profit_non_pe", "government")
DEFINITIONS = ("pe_strict", "pe_broad", "pe_broad_all", "cms_flag", "cms_flag_5pct", "cms_flag_any_role", "fund_name", "researcher_list")
SYSTEM_COLUMNS = "system_id system_name owner owner_type classification ambiguity acquired status_2026_07 owner_pattern chsp_name include_ccns exclude_ccns source_url source_publisher source_date source_quote".split()
GENERAL = ("Acute Care Hospitals", "Critical Access Hospitals")


def roster_group(label: Column) -> Column:
    low = F.lower(label)
    return F.when(low.rlike("non-?profit"), "nonprofit").when(low.rlike("^(proprietary|physician)"), "for_profit_non_pe").when(low.rlike("government|veterans|defense|tribal"), "government").otherwise("unknown")


def checked_systems(table: DataFrame) -> DataFrame:
    """The list of systems, blanks for nulls; missing columns, unknown classes, repeated ids and kept systems without a source are errors. A small configuration."""
    if missing := [c for c in SYSTEM_COLUMNS if c not in table.columns]:
        raise ValueError("the systems lack " + ", ".join(missing))
    rows = table.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in SYSTEM_COLUMNS))
    bad = rows.agg(F.count_if(~F.col("classification").isin(*CLASSES)).alias("odd"), (F.count("*") - F.count_distinct("system_id")).alias("twice"), F.count_if((F.col("classification") != "exclude") & (F.col("source_url") == "")).alias("bare")).first()
    if bad.odd or bad.twice or bad.bare:
        raise ValueError(f"systems: {bad.odd} of unknown class, {bad.twice} repeated, {bad.bare} without a source")
    return rows


def marked(owner_rows: DataFrame, funds: Sequence[str] = FUND_NAMES) -> DataFrame:
    """owners' rows with ownership_role and fund_name."""
    role = F.coalesce(F.col("role_code").isin(*ROLES["ownership"]), F.lit(False))
    return owner_rows.withColumns({"ownership_role": role, "fund_name": F.coalesce(F.col("owner_name").rlike("|".join(funds)), F.lit(False))})


def system_map(systems: DataFrame, owner_rows: DataFrame, roster: DataFrame) -> DataFrame:
    """system_id, ccn, match_method, max_pct, in_linkage, used: by owners' names, by listed numbers, and (not used) by the linkage's names alone. owner_rows: marked's with ccn. roster: ccn, health_sys_name."""
    kept = systems.where("classification <> 'exclude'")
    listed = lambda c, name: kept.select("system_id", F.explode(F.split(c, r"\s*;\s*")).alias("c")).where("trim(c) <> ''").select("system_id", (tx.ccn(F.col("c")) if name == "ccn" else F.trim("c")).alias(name)).distinct()
    patterns = F.broadcast(kept.where("owner_pattern <> ''").select("system_id", "owner_pattern"))  # a small list
    own = owner_rows.where("ownership_role").join(patterns, F.regexp_like("owner_name", F.col("owner_pattern")))
    named = own.groupBy("system_id", "ccn").agg(F.max("percent").alias("max_pct")).withColumn("match_method", F.lit("owner_name"))
    manual = listed("include_ccns", "ccn").join(named, ["system_id", "ccn"], "left_anti").select("system_id", "ccn", F.lit(None).cast("double").alias("max_pct"), F.lit("include_ccns").alias("match_method"))
    used = named.unionByName(manual).join(listed("exclude_ccns", "ccn"), ["system_id", "ccn"], "left_anti").withColumn("used", F.lit(True))
    linked = listed("chsp_name", "health_sys_name").join(roster.select("ccn", "health_sys_name"), "health_sys_name").select("system_id", "ccn").distinct()
    rest = linked.join(used, ["system_id", "ccn"], "left_anti").select("system_id", "ccn", F.lit(None).cast("double").alias("max_pct"), F.lit("linkage_only").alias("match_method"), F.lit(False).alias("used"))
    return used.unionByName(rest).join(linked.withColumn("__in", F.lit(True)), ["system_id", "ccn"], "left").withColumn("in_linkage", F.col("__in").isNotNull()).drop("__in")


def assigned(mapped: DataFrame, systems: DataFrame) -> DataFrame:
    """One system for each ccn: strict before ambiguous before creditors, then by id; all of them in system_ids."""
    rank = F.when(F.col("classification") == "strict", 1).when(F.col("ambiguity") != "creditor", 2).otherwise(3)
    rows = mapped.where("used").join(systems.select("system_id", "system_name", "classification", "ambiguity", "owner"), "system_id").withColumn("rank", rank)
    every = F.sort_array(F.collect_list(F.struct("rank", "system_id", "system_name", "classification", "ambiguity", "owner", "max_pct")))  # the few systems of one hospital
    best = rows.groupBy("ccn").agg(every.alias("s"))
    return best.select("ccn", *(F.col("s")[0][c].alias(c) for c in ("system_id", "system_name", "classification", "ambiguity", "owner", "max_pct")), F.array_join(F.transform("s", lambda x: x["system_id"]), ";").alias("system_ids"))


def classified(hospitals: DataFrame, owner_rows: DataFrame, systems: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """The hospitals with flags, largest share, owners' names and a group for each definition. hospitals: ccn, hospital_ownership and others. owner_rows: marked's with ccn. systems: assigned's. listed: ccn that a researcher names."""
    pe, role = F.col("pe_flag"), F.col("ownership_role")
    flags = owner_rows.groupBy("ccn").agg(
        F.bool_or(pe & role).alias("pe_cms"), F.bool_or(pe & F.col("role_code").isin(*ROLES["direct"])).alias("pe_cms_direct"), F.bool_or(pe & F.col("role_code").isin(*ROLES["indirect"])).alias("pe_cms_indirect"),
        F.max(F.when(pe & role, F.col("percent"))).alias("pe_cms_max_pct"), F.bool_or(pe).alias("pe_cms_any_role"), F.bool_or((pe | F.col("fund_name")) & role).alias("pe_fund"),
        F.nullif(agg.joined_names(F.when(pe, F.col("owner_name")), "; "), F.lit("")).alias("pe_owners"), F.nullif(agg.joined_names(F.when(F.col("fund_name") & role & ~pe, F.col("owner_name")), "; "), F.lit("")).alias("fund_owners"),
    )
    by_list = (listed.select("ccn").distinct() if listed is not None else hospitals.select("ccn").limit(0)).withColumn("pe_list", F.lit(True))
    rows = hospitals.withColumn("roster_group", roster_group(F.col("hospital_ownership"))).join(flags, "ccn", "left").join(systems.select("ccn", "system_id", "classification", "ambiguity", "max_pct"), "ccn", "left").join(by_list, "ccn", "left")
    rows = rows.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("pe_cms", "pe_cms_direct", "pe_cms_indirect", "pe_cms_any_role", "pe_fund", "pe_list")})
    rows = rows.withColumn("pe_cms_5pct", F.coalesce(F.col("pe_cms_max_pct") >= LEAST_PERCENT, F.lit(False)))
    strict, ambiguous = (F.col("classification").eqNullSafe(k) for k in ("strict", "ambiguous"))
    creditor = ambiguous & F.col("ambiguity").eqNullSafe("creditor")
    broad = strict | (ambiguous & ~creditor)
    by_system = lambda is_pe: F.when(is_pe, "pe").when(F.col("pe_cms"), "cms_pe_flag").when(creditor, "distressed_fund").otherwise(F.col("roster_group"))
    by_flag = lambda is_pe: F.when(is_pe, "pe").otherwise(F.col("roster_group"))
    groups = {
        "pe_strict": by_system(strict), "pe_broad": by_system(broad), "pe_broad_all": by_flag(broad | creditor | F.col("pe_cms")), "cms_flag": by_flag(F.col("pe_cms")), "cms_flag_5pct": by_flag(F.col("pe_cms_5pct")),
        "cms_flag_any_role": by_flag(F.col("pe_cms_any_role")), "fund_name": by_flag(F.col("pe_fund")), "researcher_list": by_system(strict | F.col("pe_list")),
    }
    return rows.withColumns({f"group_{d}": groups[d] for d in DEFINITIONS})


def by_definition(classes: DataFrame, keep: Sequence[str]) -> DataFrame:
    """keep, definition, group: a row for each definition."""
    return classes.unpivot(list(keep), [f"group_{d}" for d in DEFINITIONS], "definition", "group").withColumn("definition", F.expr("substring(definition, 7)"))


def group_counts(classes: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """definition, dimension, level, group, n_hospitals."""
    long = by_definition(classes.select("ccn", *(F.col(d).cast("string").alias(d) for d in dimensions), *(f"group_{d}" for d in DEFINITIONS)), ["ccn", *dimensions])
    return long.unpivot(["ccn", "definition", "group"], list(dimensions), "dimension", "level").groupBy("definition", "dimension", "level", "group").agg(F.count("*").alias("n_hospitals"))


def system_counts(systems: DataFrame, mapped: DataFrame, best: DataFrame, roster: DataFrame, priced: DataFrame) -> DataFrame:
    """Each system with its hospitals by match method, roster, general type, assignment, prices and linkage. roster: ccn, hospital_type. priced: ccn."""
    flag = lambda df, name: df.select("ccn").distinct().withColumn(name, F.lit(True))
    rows = mapped.join(flag(roster, "r"), "ccn", "left").join(flag(roster.where(F.col("hospital_type").isin(*GENERAL)), "g"), "ccn", "left").join(flag(priced, "p"), "ccn", "left")
    rows = rows.join(best.select("ccn", "system_id", F.lit(True).alias("a")), ["ccn", "system_id"], "left")
    on = lambda *cs: F.count_if(F.coalesce(reduce(lambda x, y: x & y, [F.col("used"), *(F.col(c) for c in cs)]), F.lit(False)))
    method = lambda m: F.count_if(F.col("match_method") == m)
    counts = rows.groupBy("system_id").agg(
        on().alias("n_ccns"), method("owner_name").alias("n_owner_name"), method("include_ccns").alias("n_include_ccns"), on("r").alias("n_roster"), on("g").alias("n_general"), on("a").alias("n_assigned"), on("g", "p").alias("n_priced"),
        on("in_linkage").alias("n_in_linkage"), method("linkage_only").alias("n_linkage_only"), F.count_if(F.col("used") & F.coalesce(F.col("max_pct") < 50, F.lit(False))).alias("n_below_50pct"),
    )
    return systems.select("system_id", "system_name", "owner", "classification", "ambiguity").join(counts, "system_id", "left").fillna(0, [c for c in counts.columns if c != "system_id"])


def largest_owners(owner_rows: DataFrame, roster: DataFrame, priced: DataFrame) -> DataFrame:
    """owner_name, basis (cms_flag or fund_name), enrolments, hospitals, roster and priced ones, roles, shares, up to three examples by name. owner_rows: marked's with ccn. roster: ccn, facility_name."""
    rows = owner_rows.where("pe_flag or (fund_name and ownership_role)").withColumn("basis", F.when(F.col("pe_flag"), "cms_flag").otherwise("fund_name"))
    rows = rows.join(roster.select("ccn", "facility_name", F.lit(True).alias("__r")), "ccn", "left").join(priced.select("ccn").distinct().withColumn("__p", F.lit(True)), "ccn", "left")
    return rows.groupBy("owner_name", "basis").agg(
        F.count_distinct("enrollment_id").alias("n_enrollments"), F.count_distinct("ccn").alias("n_ccns"), F.count_distinct(F.when(F.col("__r"), F.col("ccn"))).alias("n_roster_ccns"), F.count_distinct(F.when(F.col("__p"), F.col("ccn"))).alias("n_priced_ccns"),
        agg.joined_names(F.col("role_code"), ";").alias("roles"), F.min("percent").alias("pct_min"), F.max("percent").alias("pct_max"), agg.joined_names(F.col("facility_name"), " | ", 3).alias("examples"),
    )


def system_members(owner_rows: DataFrame, patterns: DataFrame) -> DataFrame:
    """One system for each ccn: of those whose pattern matches an owner the best by rank, then name. patterns: system, pattern, rank (a small table)."""
    found = pattern_join(owner_rows.select("ccn", "owner_name").distinct(), patterns, "owner_name", "pattern")
    return win.first_rows(found.select("ccn", "system", "rank").distinct(), ["ccn"], [F.col("rank"), F.col("system")])


def model_frame(prices: DataFrame, classes: DataFrame, linkage: DataFrame) -> DataFrame:
    """Prices with the columns of classes, log price, bed band, system flag, and the cluster: the system, or the hospital itself. prices: ccn, code, payer_type, price."""
    joined = prices.join(classes, "ccn").join(linkage.select("ccn", "health_sys_id", "beds"), "ccn", "left")
    return joined.withColumns({"log_price": F.log(F.when(F.col("price") > 0, F.col("price"))), "bed_band": rules.bed_band(F.col("beds")), "in_system": F.col("health_sys_id").isNotNull(), "cluster": F.coalesce("health_sys_id", F.concat(F.lit("ccn:"), F.col("ccn")))})


def facility_prices(rates: DataFrame, codes: Sequence[str], types: Sequence[str], excluded: DataFrame | None = None, cash: str = "self_pay_cash") -> DataFrame:
    """ccn, code, payer_type, price, n_contracts, n_rows: facility fees by contract median, then hospital median; and the median cash price over distinct lines. rates: usable rows of a store's hospital_rates with state and mrf_file_id."""
    rows = rates.where(F.col("ccn").isNotNull() & F.col("state").isNotNull() & F.col("code").isin(*codes) & (F.col("fee_type") == "facility"))
    if excluded is not None:
        rows = rows.join(excluded.select("mrf_file_id").distinct(), "mrf_file_id", "left_anti")
    kinds = [t for t in types if t != cash]
    paid = rows.where(F.col("plausible") & F.col("payer_type").isin(*kinds)).groupBy("ccn", "code", "payer_type", "payer_name", "plan_name").agg(F.expr("percentile(case_dollar, 0.5D)").alias("m"), F.count("*").alias("n"))
    out = paid.groupBy("ccn", "code", "payer_type").agg(F.expr("percentile(m, 0.5D)").alias("price"), F.count("*").alias("n_contracts"), F.sum("n").alias("n_rows"))
    if cash in types:
        lines = rows.where((F.col("discounted_cash") > 1) & (F.col("discounted_cash") < 2_000_000)).select("ccn", "code", "description", "discounted_cash").distinct()
        out = out.unionByName(lines.groupBy("ccn", "code").agg(F.expr("percentile(discounted_cash, 0.5D)").alias("price"), F.count("*").alias("n_contracts"), F.count("*").alias("n_rows")).withColumn("payer_type", F.lit(cash)))
    return out


def _long(frame: DataFrame) -> DataFrame:
    return by_definition(frame, ["ccn", "code", "payer_type", "state", "price"])


def raw_summary(frame: DataFrame) -> DataFrame:
    """By definition, code, payer type and group: hospitals, states, quartiles of prices. frame: ccn, code, payer_type, state, price and classified's groups."""
    rows = _long(frame).where(F.col("group").isin(*GROUPS))
    q = lambda p, n: F.expr(f"percentile(price, {p}D)").alias(n)
    return rows.groupBy("definition", "code", "payer_type", "group").agg(F.count("*").alias("n_hospitals"), F.count_distinct("state").alias("n_states"), q(0.5, "median_price"), q(0.25, "p25"), q(0.75, "p75"))


def within_states(frame: DataFrame, reference: str = GROUPS[0]) -> DataFrame:
    """By definition, code, payer type and group: over the states that have the group and the reference, the median difference and ratio of their medians, and the share of states in which the group is dearer."""
    keys = ["definition", "code", "payer_type"]
    cells = _long(frame).groupBy(*keys, "state", "group").agg(F.expr("percentile(price, 0.5D)").alias("m"), F.count("*").alias("n"))
    base = cells.where(F.col("group") == reference).select(*keys, "state", F.col("m").alias("m0"), F.col("n").alias("n0"))
    both = cells.where(F.col("group").isin(*[g for g in GROUPS if g != reference])).join(base, [*keys, "state"])
    return both.groupBy(*keys, "group").agg(
        F.count("*").alias("n_states"), F.sum("n").alias("n_group"), F.sum("n0").alias("n_reference"), F.expr("percentile(m - m0, 0.5D)").alias("median_difference"),
        F.expr("percentile(m / m0 - 1, 0.5D)").alias("median_share"), F.avg((F.col("m") > F.col("m0")).cast("double")).alias("share_states_higher"),
    )


def system_ratios(frame: DataFrame, group: str = "group_pe_strict", reference: str = GROUPS[0]) -> DataFrame:
    """Each listed system's prices against the reference median of the same state, code and payer type."""
    keys = ["code", "payer_type", "state"]
    base = frame.where(F.col(group) == reference).groupBy(*keys).agg(F.expr("percentile(price, 0.5D)").alias("base"))
    rows = frame.where("system_id is not null").join(base, keys).withColumn("ratio", F.col("price") / F.col("base"))
    q = lambda p, n: (F.expr(f"percentile(ratio, {p}D)") - 1).alias(n)
    return rows.groupBy("system_id", "classification", "ambiguity", "code", "payer_type").agg(F.count("*").alias("n_hospitals"), F.count_distinct("state").alias("n_states"), q(0.5, "median_share"), q(0.25, "p25"), q(0.75, "p75"), F.avg((F.col("ratio") > 1).cast("double")).alias("share_above"))


#: Fewest systems and hospitals of a group whose estimate isn't exploratory; codes that Medicare doesn't pay for. Fixed values.
LEAST_CLUSTERS, LEAST_HOSPITALS, NOT_PAID = 5, 10, ("58300",)


def flagged(models: DataFrame) -> DataFrame:
    """Model rows with whether they are exploratory, a comparison of payments, and why not. models: code, payer_type, definition, term, estimate, n_group, n_group_clusters."""
    few_systems, few = F.col("n_group_clusters") < LEAST_CLUSTERS, F.col("n_group") < LEAST_HOSPITALS
    payment = ~(F.col("code").isin(*NOT_PAID) & F.col("payer_type").isin("medicare", "medicare_advantage"))
    exploratory = F.coalesce(F.col("estimate").isNotNull() & (few_systems | few), F.lit(False))
    why = F.concat_ws(" and ", F.when(few_systems, f"fewer than {LEAST_CLUSTERS} systems"), F.when(few, f"fewer than {LEAST_HOSPITALS} hospitals"))
    note = F.when(~payment, "not a comparison of payments").when(exploratory, F.concat(F.lit("exploratory: "), why))
    by = Window.partitionBy("code", "payer_type", "definition")
    of_pe = lambda c: F.max(F.when(F.col("term") == "pe", F.col(c))).over(by)
    return models.withColumns({"n_pe": of_pe("n_group"), "n_pe_clusters": of_pe("n_group_clusters"), "exploratory": exploratory, "payment_comparison": payment, "note": note})
