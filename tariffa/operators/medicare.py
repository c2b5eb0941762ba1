"""Medicare references and what is measured against them: wage indices, stay payments, ratios, state and system summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffa.functions import text as tx
from tariffa.functions.numbers import money
from tariffa.operators import aggregates as agg
from tariffa.operators import economics as eco

#: Hospitals or systems that a state needs to be shown without a mark.
LEAST_HOSPITALS = 5


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """n, line of a text file in Latin-1; references have a few thousand lines."""
    whole = spark.read.format("binaryFile").load(path).select(F.split(F.decode("content", "ISO-8859-1"), "\r?\n").alias("l"))
    return whole.select(F.posexplode("l").alias("n", "line"))


def drg_weights(spark: SparkSession, path: str) -> DataFrame:
    """code, title, weight, gmlos of the tab-separated weight table: preamble and footnotes go, and rows without a weight; N/A is null."""
    lines = _lines(spark, path)
    head = lines.where(F.col("line").rlike("^MS-DRG\\s*\t")).orderBy("n").first()
    if head is None:
        raise ValueError(f"no MS-DRG header in {path}")
    names = [" ".join(x.split()) for x in head.line.split("\t")]
    cells = lines.where(F.col("n") > head.n).select(F.split("line", "\t").alias("c"))
    of = lambda name: F.trim(F.try_element_at("c", F.lit(names.index(name) + 1)))
    rows = cells.select(of("MS-DRG").alias("code"), of("MS-DRG Title").alias("title"), money(of("Weights - 10% Cap Applied")).alias("weight"), money(of("Geometric mean LOS")).alias("gmlos"))
    return rows.where(F.col("code").rlike("^[0-9]{1,3}$") & F.col("weight").isNotNull()).withColumn("code", F.lpad("code", 3, "0"))


def standard_amounts(spark: SparkSession, path: str) -> DataFrame:
    """One row: labor_high, other_high, labor_low, other_low, capital: the first amounts below the headings of tables 1A, 1B and 1D."""
    lines = _lines(spark, path)
    heads = [lines.where(F.col("line").rlike(f'^"?TABLE {t}')).agg(F.min("n").alias("n")).select(F.lit(t).alias("t"), "n") for t in ("1A", "1B", "1D")]
    starts = heads[0].unionByName(heads[1]).unionByName(heads[2])
    amounts = lines.where(F.col("line").rlike(r"\$[0-9]")).select(F.col("n").alias("m"), F.transform(F.regexp_extract_all("line", F.lit(r"\$[0-9,]+\.[0-9]+"), F.lit(0)), money).alias("a"))
    first = amounts.join(F.broadcast(starts), F.col("m") > F.col("n")).groupBy("t").agg(F.min_by("a", "m").alias("a"))  # three headings
    pick = lambda t, k: F.max(F.when(F.col("t") == t, F.try_element_at("a", F.lit(k))))
    return first.agg(pick("1A", 1).alias("labor_high"), pick("1A", 2).alias("other_high"), pick("1B", 1).alias("labor_low"), pick("1B", 2).alias("other_low"), pick("1D", 1).alias("capital"))


def outpatient_rates(spark: SparkSession, path: str) -> DataFrame:
    """code, short_descriptor, status_indicator, apc, payment_rate of an addendum whose header stands below a preamble; the rows of a code with a payment come first."""
    lines = _lines(spark, path)
    head = lines.where(F.col("line").rlike("(?i)^\"?HCPCS")).orderBy("n").first()
    if head is None:
        raise ValueError(f"no HCPCS header in {path}")
    names = [x.strip().strip('"').lower() for x in head.line.split(",")]
    parsed = lines.where(F.col("n") > head.n).select("n", F.from_csv("line", ", ".join(f"c{i} string" for i in range(len(names)))).alias("c"))
    at = lambda *words: next(i for i, n in enumerate(names) if all(w in n for w in words))
    col = lambda *words: F.trim(F.col(f"c.c{at(*words)}"))
    rows = parsed.select("n", F.upper(col("hcpcs")).alias("code"), col("descriptor").alias("short_descriptor"), F.upper(F.nullif(col("si"), F.lit(""))).alias("status_indicator"), F.nullif(col("apc"), F.lit("")).alias("apc"), money(col("payment")).alias("payment_rate"))
    rows = rows.where(F.col("code").rlike("^[A-Z0-9]{5}$"))
    best = F.min_by(F.struct("short_descriptor", "status_indicator", "apc", "payment_rate"), F.struct(F.col("payment_rate").isNull(), "n"))
    return rows.groupBy("code").agg(best.alias("b")).select("code", "b.*")


def delivery_status(measures: DataFrame, measure: str = "SM_7") -> DataFrame:
    """ccn, score, provides_ld (Yes and No do, Not Applicable doesn't, else unknown), birthing_friendly. measures: Facility ID, Measure ID, Score."""
    score = F.col("Score")
    does = F.when(score.isin("Yes", "No"), True).when(F.startswith(score, F.lit("Not Applicable")), False)
    rows = measures.where(F.col("Measure ID") == measure).select(tx.ccn(F.col("Facility ID")).alias("ccn"), score.alias("score"), does.alias("provides_ld"), (score == "Yes").alias("birthing_friendly"))
    return rows.groupBy("ccn").agg(F.min(F.struct("score", "provides_ld", "birthing_friendly")).alias("b")).select("ccn", "b.*")


def rural_index(table: DataFrame) -> DataFrame:
    """state, rural_wage_index: rows whose area number has two digits. table: cbsa, state, wage_index."""
    rows = table.where(F.length(F.trim("cbsa")) == 2).select(F.trim("state").alias("state"), F.col("wage_index").try_cast("double").alias("w")).where("w is not null")
    return rows.groupBy("state").agg(F.min("w").alias("rural_wage_index"))


def indexed(hospitals: DataFrame, own: DataFrame, rural: DataFrame) -> DataFrame:
    """ccn, state, wage_index, wage_index_source: a hospital's own index, else its state's rural one."""
    rows = hospitals.select("ccn", "state").join(own, "ccn", "left").join(F.broadcast(rural), "state", "left")  # one row a state
    source = F.when(F.col("wage_index").isNull(), "state_rural").otherwise("ipps_table_2")
    return rows.withColumn("wage_index_source", source).withColumn("wage_index", F.coalesce("wage_index", "rural_wage_index")).select("ccn", "state", "wage_index", "wage_index_source")


def stay_benchmarks(places: DataFrame, weights: DataFrame, amounts: DataFrame) -> DataFrame:
    """Each hospital's payment for each code: amounts by whether its index lies above 1. places: indexed's. weights: code, weight (the few under study). amounts: one row."""
    rows = places.join(F.broadcast(amounts)).join(F.broadcast(weights.select("code", "weight")))
    high = F.col("wage_index") > 1
    by_wage = lambda c: F.when(high, F.col(f"{c}_high")).otherwise(F.col(f"{c}_low"))
    payment = eco.stay_payment(F.col("weight"), F.col("wage_index"), by_wage("labor"), by_wage("other"), F.col("capital"))
    return rows.select("ccn", "state", "code", "wage_index", "wage_index_source", payment.alias("medicare"))


def state_summary(ratios: DataFrame, keys: Sequence[str] = ("code", "payer_type", "state"), least: int = LEAST_HOSPITALS) -> DataFrame:
    """Quartiles of ratios and prices by keys, hospitals, and a mark for few of them. ratios: keys, ccn, price, ratio, medicare."""
    q = lambda c, p: F.expr(f"percentile({c}, {p}D)")
    out = ratios.groupBy(*keys).agg(
        F.count_distinct("ccn").alias("n_hospitals"), q("ratio", 0.5).alias("median_ratio"), q("ratio", 0.25).alias("p25_ratio"), q("ratio", 0.75).alias("p75_ratio"),
        q("price", 0.5).alias("median_price"), q("price", 0.25).alias("p25_price"), q("price", 0.75).alias("p75_price"), q("medicare", 0.5).alias("medicare"),
    )
    return out.withColumn("low_n", F.col("n_hospitals") < least)


def spread(ratios: DataFrame, summary: DataFrame, key: str = "payer_type") -> DataFrame:
    """By payer type over states with enough hospitals: p90/p10 of state medians, the middle within-state ratio of quartiles, and the share of variance of log prices that states explain."""
    enough = summary.where("not low_n")
    q = lambda c, p: F.expr(f"percentile({c}, {p}D)")
    between = enough.groupBy(key).agg(
        F.count("*").alias("n_states"), F.try_divide(q("median_price", 0.9), q("median_price", 0.1)).alias("p90_p10_price"), F.try_divide(q("median_ratio", 0.9), q("median_ratio", 0.1)).alias("p90_p10_ratio"),
        F.expr("percentile(try_divide(p75_price, p25_price), 0.5D)").alias("within_state"),
    )
    kept = ratios.join(enough.select(key, "state").distinct(), [key, "state"], "left_semi").withColumn("y", F.log("price"))
    r2 = agg.explained_share(kept, [key], "state", "y").select(key, F.col("r2").alias("state_r2"))
    return between.join(r2, key, "left")


def system_units(hospitals: DataFrame) -> DataFrame:
    """ccn, unit: the system's id or name, else the hospital itself. hospitals: ccn, health_sys_id, health_sys_name."""
    blank = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    system = F.coalesce(blank("health_sys_id"), blank("health_sys_name"))
    rows = hospitals.select("ccn", F.coalesce(F.concat(F.lit("sys:"), system), F.concat(F.lit("ccn:"), "ccn")).alias("unit"))
    return rows.groupBy("ccn").agg(F.min("unit").alias("unit"))


def system_weighted(ratios: DataFrame, units: DataFrame, keys: Sequence[str] = ("code", "payer_type", "state"), least: int = LEAST_HOSPITALS) -> DataFrame:
    """State medians with one vote a system: medians of a system's hospitals in a state, then the median of these."""
    own = ratios.join(units, "ccn").groupBy(*keys, "unit").agg(F.expr("percentile(ratio, 0.5D)").alias("r"), F.expr("percentile(price, 0.5D)").alias("p"), F.count_distinct("ccn").alias("h"))
    out = own.groupBy(*keys).agg(
        F.count("*").alias("n_units"), F.sum("h").alias("n_hospitals"), (F.max("h") / F.sum("h")).alias("largest_unit_share"),
        F.expr("percentile(r, 0.5D)").alias("median_ratio"), F.expr("percentile(p, 0.5D)").alias("median_price"),
    )
    return out.withColumn("low_n", F.col("n_units") < least)


def compared_weighting(by_hospital: DataFrame, by_system: DataFrame, keys: Sequence[str] = ("code", "payer_type", "state")) -> DataFrame:
    """Both weightings side by side, with the log of the change."""
    left = by_hospital.select(*keys, "n_hospitals", F.col("low_n").alias("hospital_low_n"), F.col("median_ratio").alias("hospital_ratio"), F.col("median_price").alias("hospital_price"))
    right = by_system.select(*keys, "n_units", "largest_unit_share", F.col("low_n").alias("system_low_n"), F.col("median_ratio").alias("system_ratio"), F.col("median_price").alias("system_price"))
    return left.join(right, list(keys)).withColumn("log_change", F.log(F.try_divide("system_ratio", "hospital_ratio")))


def weighting_stats(compared: DataFrame, key: str = "payer_type") -> DataFrame:
    """By payer type over states with enough hospitals: states, rank correlation of the two weightings, their spreads."""
    kept = compared.where("not hospital_low_n")
    q = lambda c, p: F.expr(f"percentile({c}, {p}D)")
    spreads = kept.groupBy(key).agg(F.count("*").alias("n_states"), F.try_divide(q("hospital_ratio", 0.9), q("hospital_ratio", 0.1)).alias("hospital_spread"), F.try_divide(q("system_ratio", 0.9), q("system_ratio", 0.1)).alias("system_spread"), F.max(F.abs("log_change")).alias("largest_change"))
    return spreads.join(agg.spearman(kept, [key], "hospital_ratio", "system_ratio").drop("n"), key, "left")


def premium_summary(premiums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hospitals, quartiles of a premium, its median in dollars and the share of hospitals above one. premiums: keys, ccn, premium, dollars."""
    q = lambda c, p: F.expr(f"percentile({c}, {p}D)")
    return premiums.groupBy(*keys).agg(F.count_distinct("ccn").alias("n_hospitals"), q("premium", 0.5).alias("median_ratio"), q("premium", 0.25).alias("p25_ratio"), q("premium", 0.75).alias("p75_ratio"), q("dollars", 0.5).alias("median_dollars"), F.avg((F.col("premium") > 1).cast("double")).alias("share_higher"))


def by_group(ratios: DataFrame, groups: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Median price and ratio by each characteristic of the hospitals. groups: ccn and the dimensions."""
    long = groups.select("ccn", *(F.col(d).cast("string").alias(d) for d in dimensions)).unpivot(["ccn"], list(dimensions), "dimension", "group").where("group is not null")
    return ratios.join(long, "ccn").groupBy("code", "payer_type", "dimension", "group").agg(F.count_distinct("ccn").alias("n_hospitals"), F.expr("percentile(price, 0.5D)").alias("median_price"), F.expr("percentile(ratio, 0.5D)").alias("median_ratio"))
