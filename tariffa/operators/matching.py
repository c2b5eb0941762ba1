"""Entity resolution of facilities to hospitals: tiers of evidence, token scores, margins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tariffa.functions import text as tx
from tariffa.functions.numbers import jaccard, similarity
from tariffa.lineage import cut

#: Least score and lead, and the penalty where only the state agrees and there is no address. Fixed values.
MIN_SCORE, MIN_MARGIN, PENALTY = 0.6, 0.15, 0.15


def profiles(roster: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """ccn, name tokens, street tokens, city, zip, state; a row for each name of a hospital. roster: ccn, name, address, city, state, zip."""
    names = roster.select("ccn", "name")
    if aliases is not None:
        names = names.unionByName(aliases.select("ccn", "name")).distinct()
    place = roster.select("ccn", tx.address_tokens(F.col("address")).alias("r_street"), tx.city(F.col("city")).alias("r_city"), F.upper("state").alias("r_state"), F.coalesce(tx.zip_key(F.col("zip")), tx.zip_key(F.col("address"))).alias("r_zip"))
    return names.select("ccn", tx.name_tokens(F.col("name")).alias("r_tokens")).join(place, "ccn")


def features(facilities: DataFrame) -> DataFrame:
    """facility_key with what the tiers look at. facilities: facility_key, mrf_url, name, location_name, address, city, state, license, type_2_npi."""
    c = F.col
    return facilities.select(
        "facility_key",
        tx.url_key(c("mrf_url")).alias("url_key"),
        tx.npis(c("type_2_npi")).alias("npis"),
        tx.license_key(c("license")).alias("license_key"),
        tx.name_tokens(c("name")).alias("tokens"),
        tx.name_tokens(c("location_name")).alias("more_tokens"),
        tx.address_tokens(c("address")).alias("street"),
        tx.city(c("city")).alias("city"),
        F.upper("state").alias("state"),
        tx.zip_key(c("address")).alias("zip"),
    )


def scored(pairs: DataFrame, named: DataFrame, hospitals: DataFrame) -> DataFrame:
    """facility_key, ccn with name, address and city scores and their mean: the best over a hospital's names. House numbers that differ give an address 0."""
    both = pairs.join(named, "facility_key").join(hospitals, "ccn")
    name = F.greatest(jaccard(F.col("tokens"), F.col("r_tokens")), jaccard(F.col("more_tokens"), F.col("r_tokens")))
    number = lambda a: F.filter(F.col(a), lambda w: w.rlike("^[0-9]+[a-z]?$"))
    differs = (F.size(number("street")) > 0) & (F.size(number("r_street")) > 0) & ~F.arrays_overlap(number("street"), number("r_street"))
    address = F.when((F.size("street") > 0) & (F.size("r_street") > 0), F.when(differs, 0.0).otherwise(F.size(F.array_intersect("street", "r_street")) / F.size("r_street")))
    place = (F.col("city") == F.col("r_city")).cast("double")
    made = both.withColumns({"name_score": name, "address_score": address, "city_score": place})
    made = made.withColumn("score", similarity(F.col("name_score"), F.col("address_score"), F.col("city_score")))
    keep = ["name_score", "address_score", "city_score", "score", "state", "r_state", "city", "r_city", "zip", "r_zip", "tokens", "street"]
    best = F.max_by(F.struct(*keep), F.struct(F.coalesce("score", F.lit(-1.0)), "r_state")).alias("b")
    return made.groupBy("facility_key", "ccn").agg(best).select("facility_key", "ccn", "b.*")


def chosen(candidates: DataFrame, floor: float, margin: float) -> DataFrame:
    """Each facility's best candidate, sure only at the floor and with the margin; else all of them, ambiguous."""
    w = Window.partitionBy("facility_key")
    ranked = candidates.withColumns({
        "__best": F.max(F.coalesce("score", F.lit(0.0))).over(w),
        "__k": F.row_number().over(w.orderBy(F.desc_nulls_last("score"), "ccn")),
        "__n": F.count("*").over(w),
    })
    second = F.max(F.when(F.col("__k") == 2, F.coalesce("score", F.lit(0.0)))).over(w)
    sure = (F.col("__n") == 1) | ((F.col("__best") >= floor) & (F.col("__best") - F.coalesce(second, F.lit(0.0)) >= margin))
    marked = ranked.withColumn("ccn_ambiguous", ~sure)
    return marked.where(F.col("ccn_ambiguous") | (F.col("__k") == 1)).drop("__best", "__k", "__n")


def narrowed(candidates: DataFrame) -> DataFrame:
    """Candidates of the facility's state where there are any, and of those the ones of its city where there are any."""
    w = Window.partitionBy("facility_key")
    for own, theirs in (("state", "r_state"), ("city", "r_city")):
        same = F.coalesce(F.col(own) == F.col(theirs), F.lit(False))
        candidates = candidates.withColumn("__s", same).withColumn("__any", F.max("__s").over(w)).where("__s or not __any").drop("__s", "__any")
    return candidates


def resolved(facilities: DataFrame, hospitals: DataFrame, url_map: DataFrame, npi_map: DataFrame, license_map: DataFrame, min_score: float = MIN_SCORE, min_margin: float = MIN_MARGIN) -> DataFrame:
    """facility_key, ccn, ccn_match_method, ccn_match_score, ccn_ambiguous, ccn_conflict, by the first tier with evidence.

    url_map: url_key, ccn. npi_map: npi, ccn. license_map: license_key, state, ccn. Tiers: URL, NPI, licence, then name
    and address within a ZIP, else a city, else a state. URL and NPI evidence that disagree mark a conflict.
    """
    f = cut(features(facilities))  # steps that several later ones read are kept, which also keeps the plan small
    by_url = f.join(url_map, "url_key").select("facility_key", "ccn").distinct()
    by_npi = f.select("facility_key", F.explode("npis").alias("npi")).join(npi_map, "npi").select("facility_key", "ccn").distinct()
    by_license = f.join(license_map.withColumnRenamed("state", "l_state"), "license_key").where("state is null or state = l_state").select("facility_key", "ccn").distinct()
    agree = by_url.join(by_npi, ["facility_key", "ccn"])
    npi_known = by_npi.select("facility_key").distinct().withColumn("__npi", F.lit(True))
    conflict = by_url.select("facility_key").distinct().join(npi_known, "facility_key").join(agree.select("facility_key").distinct(), "facility_key", "left_anti").select("facility_key", F.lit(True).alias("ccn_conflict"))
    url_tier = by_url.join(agree.select("facility_key").distinct(), "facility_key", "left_anti").withColumn("ccn_match_method", F.lit("mrf_url")).unionByName(agree.withColumn("ccn_match_method", F.lit("mrf_url+npi")))
    done = url_tier.select("facility_key").distinct()
    npi_tier = by_npi.join(done, "facility_key", "left_anti").withColumn("ccn_match_method", F.lit("npi"))
    done = done.unionByName(npi_tier.select("facility_key").distinct())
    license_tier = by_license.join(done, "facility_key", "left_anti").withColumn("ccn_match_method", F.lit("license"))
    evidence = cut(url_tier.unionByName(npi_tier).unionByName(license_tier))
    done = evidence.select("facility_key").distinct()
    # the same evidence may point to several hospitals
    picked = chosen(narrowed(scored(evidence.select("facility_key", "ccn"), f, hospitals)), min_score / 2, min_margin).join(evidence, ["facility_key", "ccn"])
    rest = cut(f.join(done, "facility_key", "left_anti").where((F.size("tokens") >= 2) | (F.size("street") > 0)))
    # the block comes first, from all hospitals of the state: those of the ZIP, else of the city, else all of them
    places = hospitals.select("ccn", "r_zip", "r_city", "r_state").distinct()
    in_state = F.col("state") == F.col("r_state")
    by_zip = cut(rest.join(places, in_state & (F.col("zip") == F.col("r_zip"))).select("facility_key", "ccn").distinct())
    open_ = rest.join(by_zip.select("facility_key").distinct(), "facility_key", "left_anti")
    by_city = cut(open_.join(places, in_state & (F.col("city") == F.col("r_city"))).select("facility_key", "ccn").distinct())
    open_ = open_.join(by_city.select("facility_key").distinct(), "facility_key", "left_anti")
    # in a whole state only pairs that share a word of name or street can score
    words = lambda df, key, cols: df.select(key, F.explode(F.array_union(*cols)).alias("w")).distinct()
    near = words(open_.withColumn("key", F.struct("facility_key", "state")), "key", ("tokens", "street")).join(words(hospitals.withColumn("r_key", F.struct("ccn", "r_state")), "r_key", ("r_tokens", "r_street")), "w").where("key.state = r_key.r_state")
    by_state = near.select("key.facility_key", "r_key.ccn").distinct()
    tiers = [p.withColumn("tier", F.lit(i)) for i, p in enumerate((by_zip, by_city, by_state))]
    pairs = tiers[0].unionByName(tiers[1]).unionByName(tiers[2])
    named = scored(pairs.select("facility_key", "ccn"), rest, hospitals).join(pairs, ["facility_key", "ccn"])
    bare = (F.col("tier") == 2) & (F.size("street") == 0)
    named = named.withColumn("score", F.when(bare, F.col("score") - PENALTY).otherwise(F.col("score"))).drop("tier")
    by_name = chosen(named, min_score, min_margin).where((F.col("score") >= min_score) & ~F.col("ccn_ambiguous")).withColumn("ccn_match_method", F.lit("name_address"))
    out = picked.unionByName(by_name).join(conflict, "facility_key", "left")
    return out.select("facility_key", "ccn", "ccn_match_method", F.col("score").alias("ccn_match_score"), "ccn_ambiguous", F.coalesce("ccn_conflict", F.lit(False)).alias("ccn_conflict"))


def npi_crosswalk(enrollments: DataFrame, more: DataFrame) -> DataFrame:
    """npi, ccn: one row a pair; unit numbers give their hospital's. enrollments: enrollment_id, npi, ccn. more: enrollment_id, npi."""
    owned = enrollments.select("enrollment_id", "npi", tx.parent_ccn(tx.ccn(F.col("ccn"))).alias("ccn"))
    every = owned.select("npi", "ccn").unionByName(more.join(owned.select("enrollment_id", "ccn"), "enrollment_id").select("npi", "ccn"))
    return every.where(F.col("npi").rlike("^[0-9]{10}$") & F.col("ccn").isNotNull()).distinct()


def universe(roster: DataFrame, linkage: DataFrame) -> DataFrame:
    """The roster with systems; a repeated ccn in the roster is an error, in the linkage the first by system counts."""
    twice = roster.groupBy("ccn").count().where("count > 1").limit(5).collect()
    if twice:
        raise ValueError("the roster repeats " + ", ".join(str(r.ccn) for r in twice))
    first = linkage.where("ccn is not null").groupBy("ccn").agg(F.min(F.struct("health_sys_id", "health_sys_name")).alias("s")).select("ccn", "s.*")
    return roster.join(first, "ccn", "left")


def coverage(matches: DataFrame, hospitals: DataFrame, dimensions: list[str]) -> DataFrame:
    """Matched and all hospitals overall and by each dimension."""
    from tariffa.operators.aggregates import counted_by

    sure = matches.where("not ccn_ambiguous").select("ccn").distinct().withColumn("__m", F.lit(1))
    marked = hospitals.join(sure, "ccn", "left").withColumn("all", F.lit("all"))
    out = counted_by(marked, ["all", *dimensions], {"n": F.lit(1), "matched": F.coalesce("__m", F.lit(0))})
    return out.withColumn("share", F.try_divide("matched", "n"))
