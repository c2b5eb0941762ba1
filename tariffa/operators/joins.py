"""Join forms: null-safe, fallback, nearest value, radius, alternatives, tokens, blocks, upsert."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariffa.functions.numbers import EARTH_MILES, haversine
from tariffa.lineage import cut


def null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which nulls equal each other; the right side's key columns go. Spark hashes the condition."""
    renamed = right.select(*(F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in right.columns))
    condition = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in on))
    return left.join(renamed, condition, how).drop(*(f"__r_{c}" for c in on))


def with_fallback(main: DataFrame, extra: DataFrame, on: Sequence[str]) -> DataFrame:
    """main, and of extra the rows whose key main lacks."""
    return main.unionByName(extra.join(main.select(*on).distinct(), list(on), "left_anti"), allowMissingColumns=True)


def excluding(df: DataFrame, banned: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't banned; a null key is dropped, as NOT IN does."""
    return df.where(F.col(key).isNotNull()).join(banned.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def nearest_value(own: DataFrame, other: DataFrame, on: Sequence[str], row_id: str, own_value: str, other_value: str, out: str = "gap") -> DataFrame:
    """Each own row with the least absolute difference to a value of the other side with its keys (null: none).

    Both sides first shrink to distinct values of a key. The two sorted streams are merged by windows (last value below,
    first above), so that a key with many rows on both sides makes no pairs.
    """
    keys = list(on)
    a = own.select(*keys, F.col(own_value).alias("__v")).distinct().withColumn("__theirs", F.lit(None).cast("double"))
    b = other.select(*keys, F.col(other_value).alias("__v")).where("__v is not null").distinct().withColumn("__theirs", F.col("__v").cast("double"))
    line = Window.partitionBy(*keys).orderBy("__v", F.col("__theirs").isNull())
    both = a.unionByName(b)
    below = F.last("__theirs", True).over(line.rowsBetween(Window.unboundedPreceding, 0))
    back = Window.partitionBy(*keys).orderBy(F.desc("__v"), F.col("__theirs").isNull())
    above = F.last("__theirs", True).over(back.rowsBetween(Window.unboundedPreceding, 0))
    placed = both.withColumn("__below", below).withColumn("__above", above).where("__theirs is null and __v is not null")
    gaps = placed.select(*keys, F.col("__v"), F.least(F.col("__v") - F.col("__below"), F.col("__above") - F.col("__v")).alias(out))
    return null_safe(own.withColumn("__v", F.col(own_value)), gaps, [*keys, "__v"]).drop("__v")


def within_radius(left: DataFrame, right: DataFrame, miles: float, left_point: tuple[str, str] = ("lat", "lon"), right_point: tuple[str, str] = ("lat2", "lon2"), out: str = "miles", shown: Callable[[Column], Column] | None = None) -> DataFrame:
    """Pairs of points at most so far apart, by an equi-join on cells of space and an exact check.

    Points become places on the unit sphere, cut into cubes as wide as the chord of the distance; right points are copied
    to the cubes around theirs. Poles and the date line are places like any other. Rows without a place match nothing.
    Only distinct points meet there, so rows at the same point take one check; each side's rows are joined to what was found.
    shown: what is made of the distance, once for each pair of points.
    """
    step = 2 * math.sin(min(miles / (2 * EARTH_MILES), math.pi / 2)) * (1 + 1e-9) + 1e-12
    own, ends = ("__x", "__y", "__z"), ("__lat", "__lon", "__lat2", "__lon2")
    spots = lambda df, at, names: df.where(F.col(at[0]).isNotNull() & F.col(at[1]).isNotNull()).select(F.col(at[0]).alias(names[0]), F.col(at[1]).alias(names[1])).distinct()

    def cube(lat: str, lon: str) -> list[Column]:
        y, x = F.radians(lat), F.radians(lon)
        return [F.floor(v / step) for v in (F.cos(y) * F.cos(x), F.cos(y) * F.sin(x), F.sin(y))]

    there = cube(*ends[2:])
    around = [F.struct(*((c + d).alias(n) for c, d, n in zip(there, (i, j, k), own, strict=True))) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]
    dealt = spots(right, right_point, ends[2:]).select(*ends[2:], F.explode(F.array(*around)).alias("__cell")).select(*ends[2:], "__cell.*")
    near = spots(left, left_point, ends[:2]).withColumns(dict(zip(own, cube(*ends[:2]), strict=True))).join(dealt, list(own)).drop(*own)
    near = near.withColumn(out, haversine(*(F.col(p) for p in ends))).where(F.col(out) <= miles)
    if shown:
        near = near.withColumn(out, shown(F.col(out)))
    # dealt anew, as few points would leave all pairs to one task
    found = left.join(near, [F.col(a) == F.col(b) for a, b in zip(left_point, ends[:2], strict=True)]).repartition(4 * left.sparkSession.sparkContext.defaultParallelism)
    pairs = found.join(right, [F.col(a) == F.col(b) for a, b in zip(right_point, ends[2:], strict=True)])
    return pairs.select(*left.columns, *right.columns, out)


def nearest_place(left: DataFrame, right: DataFrame, row_id: str, miles: float, out: str = "miles") -> DataFrame:
    """row_id and the miles to the nearest right point, at any distance; no row without a point on both sides. left: row_id (a key), lat, lon. right: lat2, lon2.

    Radius joins of the rows that have found nothing yet, each over three times the distance of the one before, so a row
    with a near point never meets the far ones. Eight rounds reach round the earth from 10 miles.
    """
    spots = cut(right.where("lat2 is not null and lon2 is not null").select("lat2", "lon2").distinct())
    rest = left.where("lat is not null and lon is not null").select(row_id, "lat", "lon")
    found, ends = [], math.pi * EARTH_MILES
    none = spots.isEmpty()
    while True:
        got = cut(within_radius(rest, spots, miles, out=out).groupBy(row_id).agg(F.min(out).alias(out)))
        found.append(got)
        rest = cut(rest.join(got, row_id, "left_anti"))
        if none or miles > ends or rest.isEmpty():
            return reduce(DataFrame.unionByName, found)
        miles *= 3


def any_of(left: DataFrame, right: DataFrame, conditions: Sequence[tuple[str, str]], left_id: str, right_id: str) -> DataFrame:
    """Distinct pairs that agree in any of the (left, right) columns: a union of equi-joins instead of a nested loop on OR."""
    found = [left.select(left_id, F.col(a).alias("__k")).where("__k is not null").join(right.select(right_id, F.col(b).alias("__k")), "__k").select(left_id, right_id) for a, b in conditions]
    return reduce(DataFrame.unionAll, found).distinct()


def token_overlap(left: DataFrame, right: DataFrame, left_id: str, right_id: str, tokens: str = "tokens") -> DataFrame:
    """Pairs sharing a token, with their Jaccard similarity, through an inverted index. tokens: arrays without repeats."""
    a = left.select(left_id, F.size(tokens).alias("__a"), F.explode(tokens).alias("__t"))
    b = right.select(right_id, F.size(tokens).alias("__b"), F.explode(tokens).alias("__t"))
    # sizes and the number of shared tokens give the similarity, so no arrays are carried along
    pairs = a.join(b, "__t").groupBy(left_id, right_id, "__a", "__b").agg(F.count("*").alias("__n"))
    return pairs.select(left_id, right_id, (F.col("__n") / (F.col("__a") + F.col("__b") - F.col("__n"))).alias("score"))


def best_overlap(rows: DataFrame, row_id: str, tokens: str = "tokens") -> DataFrame:
    """row_id, match, score, margin: for each row the other row with the most similar tokens (ties: the least id) and its lead over the next; rows that share no token with another are left out.

    Rows with equal tokens form a set; only distinct sets meet, so names that very many rows have make no pairs of rows.
    """
    keyed = rows.select(F.col(row_id).alias("__id"), F.sort_array(tokens).alias("__s")).where(F.size("__s") > 0)
    # the two least ids of a set, kept by a group limit before the shuffle
    two = keyed.withColumn("__k", F.row_number().over(Window.partitionBy("__s").orderBy("__id"))).where("__k <= 2").groupBy("__s").agg(F.min("__id").alias("set"), F.max("__id").alias("next"))
    sets = keyed.groupBy("__s").agg(F.count("*").alias("n")).join(two, "__s")
    pairs = token_overlap(sets.select("set", F.col("__s").alias("t")), sets.select(F.col("set").alias("other"), F.col("__s").alias("t")), "set", "other", "t").where("set <> other")
    levels = pairs.join(sets.select(F.col("set").alias("other"), "n"), "other").groupBy("set", "score").agg(F.sum("n").alias("n"), F.min("other").alias("least"))
    ranked = levels.withColumn("__k", F.row_number().over(Window.partitionBy("set").orderBy(F.desc("score")))).where("__k <= 2")
    at = lambda k, c: F.max(F.when(F.col("__k") == k, F.col(c)))
    best = ranked.groupBy("set").agg(at(1, "score").alias("s1"), at(1, "n").alias("n1"), at(1, "least").alias("id1"), at(2, "score").alias("s2"))
    every = keyed.join(sets.join(best, "set", "left"), "__s")
    same = F.col("n") > 1
    second = F.when(same, F.when(F.col("n") > 2, 1.0).otherwise(F.col("s1"))).otherwise(F.when(F.col("n1") > 1, F.col("s1")).otherwise(F.col("s2")))
    out = every.withColumns({
        "match": F.when(same, F.when(F.col("__id") == F.col("set"), F.col("next")).otherwise(F.col("set"))).otherwise(F.col("id1")),
        "score": F.when(same, 1.0).otherwise(F.col("s1")),
        "margin": F.when(same, 1.0).otherwise(F.col("s1")) - F.coalesce(second, F.lit(0.0)),
    }).where("score is not null")
    return out.select(F.col("__id").alias(row_id), "match", "score", "margin")


def best_block(pairs: DataFrame, row_id: str, tiers: Sequence[Column], out: str = "block") -> DataFrame:
    """Of each row's pairs those in the first tier that any of them reaches; pairs in none go."""
    tier = F.coalesce(*(F.when(F.coalesce(t, F.lit(False)), F.lit(i)) for i, t in enumerate(tiers)))
    ranked = pairs.withColumn(out, tier).where(F.col(out).isNotNull())
    return ranked.withColumn("__best", F.min(out).over(Window.partitionBy(row_id))).where(F.col(out) == F.col("__best")).drop("__best")


def first_block(left: DataFrame, right: DataFrame, row_id: str, tiers: Sequence[Sequence[tuple[str, str]]], out: str = "block") -> DataFrame:
    """As best_block, for tiers that are equalities of (left, right) columns, each tier's pairs being pairs of the next one too. Rows without a row_id have no pairs.

    Whether a tier has a row's pair is seen from the distinct keys of the right side, so only the pairs that stay are made.
    """
    fits = lambda tier: [(a, f"__k{j}", F.col(b).alias(f"__k{j}")) for j, (a, b) in enumerate(tier)]
    rows = left.where(F.col(row_id).isNotNull())
    for i, tier in enumerate(tiers):
        keys = right.select(*(k for _, _, k in fits(tier))).distinct().withColumn(f"__t{i}", F.lit(i))
        rows = rows.join(keys, [F.col(a) == F.col(k) for a, k, _ in fits(tier)], "left").drop(*(k for _, k, _ in fits(tier)))
    marks = [f"__t{i}" for i in range(len(tiers))]
    rows = rows.withColumn(out, F.coalesce(*marks)).drop(*marks).where(F.col(out).isNotNull())
    rows = rows.withColumn("__best", F.min(out).over(Window.partitionBy(row_id))).where(F.col(out) == F.col("__best")).drop("__best")
    return reduce(DataFrame.unionByName, (rows.where(F.col(out) == i).join(right, [F.col(a) == F.col(b) for a, b in tier]) for i, tier in enumerate(tiers)))


def first_tier(tiers: Sequence[DataFrame], key: str, out: str = "tier") -> DataFrame:
    """Rows of the first of several candidate tables that has the key."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (t.withColumn(out, F.lit(i)) for i, t in enumerate(tiers)))
    return every.withColumn("__first", F.min(out).over(Window.partitionBy(key))).where(F.col(out) == F.col("__first")).drop("__first")


def lookup_chain(grid: DataFrame, tables: Sequence[tuple[DataFrame, Sequence[str], str]], default: Column, out: str = "value", source: str = "source") -> DataFrame:
    """For each grid row the value of the first table (frame, keys, label) that has one, else the default; and where it came from."""
    names = []
    for i, (table, keys, label) in enumerate(tables):
        column = f"__v{i}"
        names.append((column, label))
        grid = grid.join(table.select(*keys, F.col("value").alias(column)), list(keys), "left")
    value = F.coalesce(*(F.col(c) for c, _ in names), default)
    came = F.when(F.lit(False), "")
    for c, label in names:
        came = came.when(F.col(c).isNotNull(), label)
    return grid.withColumn(out, value).withColumn(source, came.when(default.isNotNull(), "default").otherwise("missing")).drop(*(c for c, _ in names))


def upsert(state: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """The state with all rows of the new batch's keys replaced by the batch."""
    return state.join(new.select(*key).distinct(), list(key), "left_anti").unionByName(new, allowMissingColumns=True)


def multiset_difference(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose number of copies differs, with both numbers; nulls equal each other."""
    left, right = (df.groupBy(*columns).agg(F.count("*").alias(n)) for df, n in ((a, "left_n"), (b, "right_n")))
    joined = null_safe(left, right, columns, "left")
    missing = null_safe(right, left, columns, "left_anti").withColumn("left_n", F.lit(0).cast("long"))
    both = joined.withColumn("right_n", F.coalesce("right_n", F.lit(0))).unionByName(missing)
    return both.where("left_n <> right_n")


def pattern_join(texts: DataFrame, patterns: DataFrame, text: str, pattern: str) -> DataFrame:
    """Texts with each pattern that they match; patterns are a small rule table, which is broadcast."""
    return texts.join(F.broadcast(patterns), F.expr(f"lower(`{text}`) rlike `{pattern}`"))
