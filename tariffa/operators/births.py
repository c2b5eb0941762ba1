"""Childbirth prices, ratios to Medicare, supply of care within a radius, local price differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffa.operators import aggregates as agg
from tariffa.operators.joins import nearest_place, with_fallback, within_radius

#: Delivery groups, and the severity groups that stand in for them. Fixed values.
ANCHORS = ("788", "807")
STAND_INS = {"540-1": "788", "560-1": "807"}
LEAST_SHOWN = 5


def with_stand_ins(prices: DataFrame, severity: DataFrame) -> DataFrame:
    """Prices of the anchors, and where a hospital and payer lack one its stand-in's. Both: ccn, code, payer_type, price."""
    names = F.create_map(*(F.lit(x) for kv in STAND_INS.items() for x in kv))
    extra = severity.withColumn("code", names[F.col("code")]).where("code is not null").withColumn("stand_in", F.lit(True))
    return with_fallback(prices.withColumn("stand_in", F.lit(False)), extra, ["ccn", "code", "payer_type"])


def benchmark_ratios(prices: DataFrame, benchmark: DataFrame, keys: Sequence[str] = ("ccn", "code")) -> DataFrame:
    """Prices over a hospital's Medicare payment."""
    return prices.join(benchmark, list(keys)).where("medicare > 0 and price > 0").withColumn("ratio", F.col("price") / F.col("medicare"))


def premium(prices: DataFrame, top: str = ANCHORS[0], base: str = ANCHORS[1]) -> DataFrame:
    """Within a hospital and payer the price of one group over that of the other."""
    wide = prices.where(F.col("code").isin(top, base)).groupBy("ccn", "payer_type").pivot("code", [top, base]).agg(F.first("price"))
    return wide.where(F.col(top).isNotNull() & (F.col(base) > 0)).withColumn("premium", F.col(top) / F.col(base))


def summary(ratios: DataFrame, keys: Sequence[str], value: str, least: int = LEAST_SHOWN) -> DataFrame:
    """Quantiles by keys, with a flag for cells of few hospitals."""
    out = agg.quantiles(ratios, keys, value, {"p10": 0.1, "p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9}, "n")
    return out.withColumn("low_n", F.col("n") < least)


def supply(places: DataFrame, providers: DataFrame, miles: float, per: str | None = None) -> DataFrame:
    """Providers and their number within a radius of each place or in its own county; per: a count to relate them to. places: place, county, lat, lon. providers: provider, county2, lat2, lon2, n."""
    near = within_radius(places.where("lat is not null and lon is not null"), providers.where("lat2 is not null and lon2 is not null"), miles).select("place", "provider", "n")
    own = places.select("place", F.col("county").alias("county2")).join(providers, "county2").select("place", "provider", "n")
    sums = near.unionByName(own).dropDuplicates(["place", "provider"]).groupBy("place").agg(F.count("*").alias("n_providers"), F.sum("n").alias("supply"))
    out = places.join(sums, "place", "left").fillna(0, ["n_providers", "supply"])
    return out.withColumn("rate", F.try_divide(1000 * F.col("supply"), F.col(per))) if per else out


def local_difference(places: DataFrame, prices: DataFrame, miles: float) -> DataFrame:
    """place, payer_type, difference, n_hospitals, level: for each place and payer type the median difference between two anchors' prices within reach, else that of its state. places: place, state, lat, lon. prices: ccn, payer_type, state2, lat2, lon2, difference."""
    # places at the same points have the same prices within reach, so only distinct points meet, and equal prices of a point once
    spots = places.where("lat is not null and lon is not null").groupBy("place").agg(F.sort_array(F.collect_list(F.struct("lat", "lon"))).alias("__spot"))
    points = spots.select("__spot").distinct().select("__spot", F.explode("__spot").alias("p")).select("__spot", "p.*")
    sums = prices.groupBy("payer_type", "lat2", "lon2", "difference").agg(F.count("*").alias("__n"))
    met = points.select("lat", "lon").distinct(), sums.select("lat2", "lon2").distinct()
    reached = points.join(within_radius(*met, miles), ["lat", "lon"]).join(sums, ["lat2", "lon2"]).groupBy("__spot", "payer_type", "difference").agg(F.sum("__n").alias("__n"))
    near = reached.groupBy("__spot", "payer_type").agg(F.expr("percentile(difference, 0.5D, __n)").alias("local"), F.sum("__n").alias("n_local"))
    near = spots.join(near, "__spot").drop("__spot")
    state = agg.median(prices.withColumnRenamed("state2", "state"), ["state", "payer_type"], "difference", "statewide")
    grid = places.select("place", "state").join(F.broadcast(prices.select("payer_type").distinct()))  # a handful of types
    out = grid.join(near, ["place", "payer_type"], "left").join(state, ["state", "payer_type"], "left")
    level = F.when(F.col("local").isNotNull(), "local").when(F.col("statewide").isNotNull(), "state").otherwise("none")
    return out.select("place", "payer_type", F.coalesce("local", "statewide").alias("difference"), F.coalesce("n_local", F.lit(0)).cast("long").alias("n_hospitals"), level.alias("level"))


def implied_difference(counties: DataFrame, differences: DataFrame, slopes: dict[str, float], contrast: float, shares: dict[str, str]) -> DataFrame:
    """payer_type, bound, n_counties, payer_births, change, dollars: what a change of a rate means at local differences. counties: place, births, and a share for each payer type (shares: type to column). slopes: points of the rate by bound."""
    types = F.array(*(F.struct(F.lit(t).alias("payer_type"), (F.col("births") * F.col(c)).alias("payer_births")) for t, c in shares.items()))
    long = counties.select("place", F.explode(types).alias("t")).select("place", "t.*").join(differences.select("place", "payer_type", "difference"), ["place", "payer_type"])
    bounds = F.explode(F.array(*(F.struct(F.lit(b).alias("bound"), F.lit(float(v)).alias("slope")) for b, v in slopes.items())))
    rows = long.withColumn("b", bounds).withColumn("change", F.col("b.slope") / 100 * contrast * F.col("payer_births"))
    return rows.groupBy("payer_type", F.col("b.bound").alias("bound")).agg(F.count_distinct("place").alias("n_counties"), F.sum("payer_births").alias("payer_births"), F.sum("change").alias("change"), F.sum(F.col("change") * F.col("difference")).alias("dollars"))


def covered_supply(supply: DataFrame, uncovered: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Supply with the columns null at places of states that the roster doesn't cover. uncovered: state."""
    marked = supply.join(uncovered.select("state").distinct().withColumn("__no", F.lit(True)), "state", "left")
    return marked.withColumns({c: F.when(F.col("__no").isNull(), F.col(c)) for c in columns}).withColumn("covered", F.col("__no").isNull()).drop("__no")


def supply_at(places: DataFrame, providers: DataFrame, counties: DataFrame, miles: float, centers: DataFrame | None = None, units: DataFrame | None = None, uncovered: DataFrame | None = None) -> DataFrame:
    """places with covered, n_providers, births, providers_per_1k and, where given, n_centers, nearest_center (miles, at any distance), n_units, units_per_1k.

    places: place (a key), county, lat, lon. providers, centers, units: lat, lon. counties: county, lat, lon, births; one
    counts where it lies within the radius or is the place's own. uncovered: lat, lon of places of which the roster of
    providers knows nothing: with one of them within the radius a place's providers are null, not few.
    """
    located = places.where("lat is not null and lon is not null")
    there = lambda df, *more: df.where("lat is not null and lon is not null").select(F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), *more)

    def counted(df: DataFrame, name: str) -> DataFrame:
        spots = there(df).groupBy("lat2", "lon2").agg(F.count("*").alias("__n"))  # many share a ZIP's point
        return within_radius(located.select("place", "lat", "lon"), spots, miles).groupBy("place").agg(F.sum("__n").alias(name))

    out = places.join(counted(providers, "n_providers"), "place", "left").fillna(0, ["n_providers"])
    known = counties.where("lat is not null and births is not null")
    near = within_radius(located.select("place", "lat", "lon"), there(known, F.col("county").alias("c2"), "births"), miles).select("place", "c2", "births")
    own = places.select("place", F.col("county").alias("c2")).join(known.select(F.col("county").alias("c2"), "births"), "c2").select("place", "c2", "births")
    out = out.join(near.unionByName(own).dropDuplicates(["place", "c2"]).groupBy("place").agg(F.sum("births").alias("births")), "place", "left").fillna(0, ["births"])
    seen = F.lit(True)
    if uncovered is not None:
        spots = there(uncovered).distinct()
        blind = within_radius(located.select("place", "lat", "lon"), spots, miles).select("place").distinct().withColumn("__blind", F.lit(True))
        out, seen = out.join(blind, "place", "left"), F.col("__blind").isNull()
    out = out.withColumn("covered", seen).withColumn("n_providers", F.when(F.col("covered"), F.col("n_providers"))).drop("__blind")
    per = lambda c: F.when(F.col("births") > 0, 1000 * F.col(c) / F.col("births"))
    out = out.withColumn("providers_per_1k", per("n_providers"))
    if centers is not None:
        out = out.join(counted(centers, "n_centers"), "place", "left").fillna(0, ["n_centers"])
        out = out.join(nearest_place(located.select("place", "lat", "lon"), there(centers), "place", miles).withColumnRenamed("miles", "nearest_center"), "place", "left")
    if units is not None:
        out = out.join(counted(units, "n_units"), "place", "left").fillna(0, ["n_units"]).withColumn("units_per_1k", per("n_units"))
    return out
