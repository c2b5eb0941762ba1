"""Economics of add-on procedures: values, break-evens, day capacity, sensitivity, simulation."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffa.functions.numbers import triangular


def net_value(margin: Column, utilisation: Column, added: Column, primary: Column, displaced: Column) -> Column:
    """What an add-on brings less what its minutes displace: margin - u * (added / primary) * displaced."""
    return margin - utilisation * F.try_divide(added, primary) * displaced


def room_cost_value(margin: Column, added: Column, cost_per_minute: Column) -> Column:
    return margin - added * cost_per_minute


def breakeven(margin: Column, loss_per_unit: Column) -> Column:
    """How much can be lost: null without a margin, infinite without a loss."""
    return F.when(margin <= 0, F.lit(None).cast("double")).when(loss_per_unit <= 0, F.lit(float("inf"))).otherwise(F.try_divide(margin, loss_per_unit))


def breakeven_minutes(margin: Column, utilisation: Column, primary: Column, displaced: Column) -> Column:
    return breakeven(margin, utilisation * F.try_divide(displaced, primary))


def breakeven_utilisation(margin: Column, added: Column, primary: Column, displaced: Column) -> Column:
    return breakeven(margin, F.try_divide(added, primary) * displaced)


def minute_ratio(margin: Column, added: Column, displaced: Column, primary: Column) -> Column:
    """Margin of an added minute over that of a primary minute."""
    return F.try_divide(F.try_divide(margin, added), F.try_divide(displaced, primary))


def cases_per_day(day: Column, primary: Column) -> Column:
    return F.floor(F.try_divide(day, primary) + 1e-9)


def cases_with_addons(day: Column, primary: Column, added: Column, addons: Column) -> Column:
    """Most primary cases that fit a day in which so many of them carry an add-on."""
    most = F.greatest(cases_per_day(day, primary), F.lit(0)).cast("int")
    fits = F.filter(F.sequence(F.lit(0), most), lambda c: c * primary + F.least(c, addons) * added <= day + 1e-9)
    return F.array_max(fits)


def day_values(cases: DataFrame) -> DataFrame:
    """A row for each number of add-ons: primary cases left, whether that number first costs one, and the day's change. cases: day, primary, added, margin, displaced and keys."""
    most = cases_per_day(F.col("day"), F.col("primary")).cast("int")
    rows = cases.withColumn("addons", F.explode(F.sequence(F.lit(0), most)))
    left = cases_with_addons(F.col("day"), F.col("primary"), F.col("added"), F.col("addons"))
    rows = rows.withColumn("cases", left)
    lost = most - F.col("cases")
    return rows.withColumn("day_change", F.least("addons", "cases") * F.col("margin") - lost * F.col("displaced"))


def tornado(base: DataFrame, ranges: DataFrame, parameters: Sequence[str], value: Column) -> DataFrame:
    """The value with one parameter at a time at its low and its high. ranges: parameter, low, high (a small table)."""
    sides = ranges.select("parameter", F.explode(F.array(F.struct(F.lit("low").alias("side"), F.col("low").alias("at")), F.struct(F.lit("high").alias("side"), F.col("high").alias("at")))).alias("s")).select("parameter", "s.*")
    rows = base.join(F.broadcast(sides))
    moved = rows.withColumns({p: F.when(F.col("parameter") == p, F.col("at")).otherwise(F.col(p)) for p in parameters})
    return moved.withColumn("value", value)


def draws(spark: SparkSession, parameters: Sequence[tuple[str, str, float, float, float]], n: int = 5000, seed: int = 20260912) -> DataFrame:
    """draw and a column for each (name, distribution, base, low, high); triangular by its inverse, beta and gamma by moments with a deviation of the range over 3.92."""
    rng = np.random.default_rng(seed)
    columns = {"draw": np.arange(1, n + 1)}
    for name, kind, base, low, high in parameters:
        sd = (high - low) / 3.92
        if kind == "fixed" or sd <= 0:
            columns[name] = np.full(n, float(base))
        elif kind == "triangular":
            columns[name] = rng.triangular(low, base, high, n)
        elif kind == "beta":
            size = base * (1 - base) / sd**2 - 1
            columns[name] = rng.beta(base * size, (1 - base) * size, n) if size > 0 else np.full(n, float(base))
        elif kind == "gamma":
            columns[name] = rng.gamma((base / sd) ** 2, sd**2 / base, n)
        else:
            raise ValueError(f"no distribution {kind}")
    import pandas as pd

    return spark.createDataFrame(pd.DataFrame(columns))


def simulated(rows: DataFrame, drawn: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """Mean, 95 % interval and share above zero of a value over all draws. drawn: a few thousand rows, whose number is a parameter."""
    every = rows.join(F.broadcast(drawn)).withColumn("__v", value)
    return every.groupBy(*keys).agg(F.avg("__v").alias("mean"), F.expr("percentile(__v, 0.025D)").alias("low"), F.expr("percentile(__v, 0.975D)").alias("high"), F.avg((F.col("__v") > 0).cast("double")).alias("positive"), F.count("*").alias("n"))


def threshold_curves(rows: DataFrame, over: str, low: float, high: float, step: float, framings: dict[str, Column], keys: Sequence[str]) -> DataFrame:
    """Values of several framings over a grid of one parameter, in long form; undefined points go. The grid has a fixed number of points."""
    points = round((high - low) / step)
    grid = rows.withColumn("__i", F.explode(F.sequence(F.lit(0), F.lit(points)))).withColumn(over, F.round(F.lit(low) + F.col("__i") * step, 6)).drop("__i")
    long = grid.withColumns(framings).unpivot([*keys, over], list(framings), "framing", "value")
    return long.where("value is not null")


def positive_counts(values: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows, and those with a value above zero, by keys; rows without a value aren't counted."""
    have = values.where(F.col(value).isNotNull())
    return have.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(F.col(value) > 0).alias("n_positive"), F.avg((F.col(value) > 0).cast("double")).alias("share"))


def inflated(values: DataFrame, index: DataFrame, year: int) -> DataFrame:
    """Values in dollars of a year. values: price_index, dollar_year, value. index: price_index, year, level."""
    own = index.select("price_index", F.col("year").alias("dollar_year"), F.col("level").alias("__from"))
    to = index.where(F.col("year") == year).select("price_index", F.col("level").alias("__to"))
    joined = values.join(own, ["price_index", "dollar_year"], "left").join(to, "price_index", "left")
    return joined.withColumn("value", F.col("value") * F.coalesce(F.try_divide("__to", "__from"), F.lit(1.0))).drop("__from", "__to")


def bounded_share(cells: DataFrame, keys: Sequence[str], part: Column, births: str, suppressed: str, widest: float = 0.01) -> DataFrame:
    """A share of counts of which some are suppressed (1 to 9): the middle with 5, bounds with 1 and 9, null where the bounds lie too far apart. One grouped pass."""
    count = lambda inside, outside: F.when(F.col(suppressed), F.when(part, inside).otherwise(outside)).otherwise(F.col(births))
    bound = lambda inside, outside: F.try_divide(F.sum(F.when(part, count(inside, outside)).otherwise(0)), F.sum(count(inside, outside)))
    out = cells.groupBy(*keys).agg(bound(5, 5).alias("middle"), bound(1, 9).alias("low"), bound(9, 1).alias("high"))
    return out.withColumn("share", F.when(F.col("high") - F.col("low") <= widest, F.col("middle")))


def wage_adjusted(rate: Column, index: Column, labor_share: float = 0.6) -> Column:
    return rate * (labor_share * index + (1 - labor_share))


def stay_payment(weight: Column, index: Column, labor: Column, other: Column, capital: Column, exponent: float = 0.6848) -> Column:
    return (labor * index + other + capital * F.pow(index, exponent)) * weight


def triangular_at(u: Column, low: Column, mode: Column, high: Column) -> Column:
    return triangular(u, low, mode, high)
