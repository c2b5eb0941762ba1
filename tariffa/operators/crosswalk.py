"""Facilities matched to hospitals again only where something that decides their match has changed.

A state holds what a match was made from and what came out. The next run compares it with the new facilities and
references and matches again

* facilities that are new or whose features have another hash,
* facilities with a URL, NPI or licence whose rows in the maps came, went or changed,
* facilities with evidence, now or before, for a hospital whose profile came, went or changed,
* facilities in a state in which such a hospital is or was, as names are compared within a state.

No other pair of facility and hospital is looked at by `matching.resolved` in another way than before, so the result
equals that of a full run. Facilities that are gone lose their rows.
"""

from __future__ import annotations

from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffa.lineage import cut
from tariffa.operators import matching
from tariffa.sources import published


@dataclass
class State:
    """What a crosswalk was made from, and the crosswalk."""

    facilities: DataFrame  # facility_key, h
    hospitals: DataFrame  # ccn, r_state, h
    url_map: DataFrame  # url_key, ccn
    npi_map: DataFrame  # npi, ccn
    license_map: DataFrame  # license_key, state, ccn
    matches: DataFrame  # as of matching.resolved

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def kept(self) -> State:
        """The same, computed once and kept in the shared folder; `run` publishes it instead."""
        return State(**{name: cut(df) for name, df in self.tables().items()})


def hashed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys and h, a hash of all rows of the keys in whatever order; a repeated row counts each time."""
    sets = [f.name for f in rows.schema.fields if f.dataType.typeName() == "array"]
    plain = [F.array_sort(c) if c in sets else F.col(c) for c in rows.columns]
    # a null leaves a hash as it was, so its place goes in too
    nulls = F.concat(*(F.when(F.col(c).isNull(), "1").otherwise("0") for c in rows.columns))
    row = F.struct(F.xxhash64(*plain, nulls).alias("a"), F.xxhash64(F.lit("again"), nulls, *plain).alias("b"))
    sums = [F.sum(F.col(f"r.{p}").cast("decimal(38,0)")).cast("string") for p in ("a", "b")]
    return rows.select(*keys, row.alias("r")).groupBy(*keys).agg(F.concat_ws(":", *sums, F.count("*")).alias("h"))


def _differing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of rows that only one side has."""
    sides = old.withColumn("__s", F.lit(1)).unionByName(new.withColumn("__s", F.lit(2)))
    rows = sides.groupBy(*old.columns).agg(F.min("__s").alias("__a"), F.max("__s").alias("__b"))
    return rows.where("__a = __b").select(*keys).distinct()


def stale(old: State, facilities: DataFrame, hospitals: DataFrame, url_map: DataFrame, npi_map: DataFrame, license_map: DataFrame) -> DataFrame:
    """facility_key of the given facilities that have to be matched again, and why: reasons, an array of new, features, evidence, hospital, state."""
    features = matching.features(facilities)
    now, roster = hashed(features, ["facility_key"]), hashed(hospitals, ["ccn", "r_state"])
    was = old.facilities.withColumnRenamed("h", "__h")
    own = now.join(was, "facility_key", "left").where(~F.col("h").eqNullSafe(F.col("__h"))).select("facility_key", F.when(F.col("__h").isNull(), "new").otherwise("features").alias("why"))
    moved = cut(_differing(old.hospitals, roster, ["ccn", "r_state"]))
    ccns = moved.select("ccn").distinct()
    found = [own]
    ways = (
        (features.select("facility_key", "url_key"), "url_key", old.url_map, url_map),
        (features.select("facility_key", F.explode("npis").alias("npi")), "npi", old.npi_map, npi_map),
        (features.select("facility_key", "license_key"), "license_key", old.license_map, license_map),
    )
    for has, key, before, after in ways:
        columns = before.columns
        changed = _differing(before.select(columns), after.select(columns).distinct(), [key]).withColumn("why", F.lit("evidence"))
        held = before.select(key, "ccn").unionByName(after.select(key, "ccn")).join(ccns, "ccn", "left_semi").select(key).distinct().withColumn("why", F.lit("hospital"))
        found += [has.join(k, key).select("facility_key", "why") for k in (changed, held)]
    # a hospital's score is its best over all its profiles, so each state in which it has one counts
    states = old.hospitals.unionByName(roster).join(ccns, "ccn", "left_semi").select(F.col("r_state").alias("state")).where("state is not null").distinct()
    found.append(features.select("facility_key", "state").join(states, "state", "left_semi").select("facility_key", F.lit("state").alias("why")))
    return reduce(DataFrame.unionByName, found).groupBy("facility_key").agg(F.array_sort(F.collect_set("why")).alias("reasons"))


def updated(old: State | None, facilities: DataFrame, hospitals: DataFrame, url_map: DataFrame, npi_map: DataFrame, license_map: DataFrame) -> State:
    """The crosswalk of the facilities: those that are stale against the old state matched, the rest carried over. None: all of them matched.

    Arguments as of `matching.resolved`; facility_key is a key. The old state is only read: keep both where versions are to be compared.
    """
    maps = [m.distinct() for m in (url_map, npi_map, license_map)]
    parts = (hashed(matching.features(facilities), ["facility_key"]), hashed(hospitals, ["ccn", "r_state"]), *maps)
    if old is None:
        return State(*parts, matching.resolved(facilities, hospitals, *maps))
    again = cut(stale(old, facilities, hospitals, *maps).select("facility_key"))
    fresh = matching.resolved(cut(facilities.join(again, "facility_key", "left_semi")), hospitals, *maps)
    kept = old.matches.join(facilities.select("facility_key"), "facility_key", "left_semi").join(again, "facility_key", "left_anti")
    return State(*parts, kept.unionByName(fresh))


def moves(old: DataFrame, new: DataFrame) -> DataFrame:
    """Facilities whose hospitals differ between two crosswalks: facility_key, before and after (sorted ccns, null: none), change (found, lost, moved)."""
    side = lambda m, n: m.groupBy("facility_key").agg(F.array_sort(F.collect_set("ccn")).alias(n))
    both = side(old, "before").join(side(new, "after"), "facility_key", "full").where(~F.col("before").eqNullSafe(F.col("after")))
    return both.withColumn("change", F.when(F.col("before").isNull(), "found").when(F.col("after").isNull(), "lost").otherwise("moved"))


def run(spark: SparkSession, root: str, facilities: DataFrame, hospitals: DataFrame, url_map: DataFrame, npi_map: DataFrame, license_map: DataFrame) -> str:
    """Brings the crosswalk that is published under `root` up to date; the build's id. The first run matches all facilities."""
    old = State(**published.read(spark, root)) if published.builds(spark, root) else None
    new = updated(old, facilities, hospitals, url_map, npi_map, license_map)
    check = lambda found: {"matches: facility unknown": published.orphans(found["matches"], found["facilities"], "facility_key"), "facilities: facility_key repeated": published.repeated(found["facilities"], "facility_key")}
    return published.publish(spark, root, new.tables(), check)
