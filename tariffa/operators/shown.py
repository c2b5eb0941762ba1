"""Frames behind figures: what is drawn, ranked, banded or held back. Drawing itself isn't done here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tariffa.functions import labels

#: Ratios that a colour scale reaches at least, and its breaks. Fixed values.
LOW, HIGH, BREAKS = 0.5, 2.0, (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0, 6.0, 8.0)


def ratio_limits(summary: DataFrame, types: Sequence[str]) -> DataFrame:
    """One row: low and high of a scale that holds every shown median ratio."""
    shown = summary.where(F.col("payer_type").isin(*types) & ~F.col("low_n"))
    return shown.agg(F.least(F.lit(LOW), F.min("median_ratio")).alias("low"), F.greatest(F.lit(HIGH), F.max("median_ratio")).alias("high"))


def ratio_breaks(limits: DataFrame) -> DataFrame:
    """place, label of the breaks within the limits."""
    every = limits.select("low", "high", F.explode(F.array(*map(F.lit, BREAKS))).alias("place")).where("place between low and high")
    return every.select("place", F.concat(F.regexp_replace(F.col("place").cast("string"), r"\.0$", ""), F.lit("x")).alias("label"))


def map_frame(summary: DataFrame, types: Sequence[str]) -> DataFrame:
    """state_name, payer, ratio (null where few hospitals stand behind it), why: shown, suppressed or none; a row for each state of the map and type."""
    grid = summary.select(F.explode(F.array(*map(F.lit, labels.STATES))).alias("state")).distinct().withColumn("payer_type", F.explode(F.array(*map(F.lit, types))))
    rows = grid.join(summary.select("state", "payer_type", "median_ratio", "low_n"), ["state", "payer_type"], "left")
    why = F.when(F.col("median_ratio").isNull(), "none").when(F.col("low_n"), "suppressed").otherwise("shown")
    return rows.select(labels.state_name(F.col("state")).alias("state_name"), labels.payer_label(F.col("payer_type")).alias("payer"), F.when(why == "shown", F.col("median_ratio")).alias("ratio"), why.alias("why"))


def rank_frame(summary: DataFrame, types: Sequence[str]) -> DataFrame:
    """Ranked states of each payer type by median price, with quartiles, reliability and an alternating band; places outside the map go."""
    rows = summary.where(F.col("payer_type").isin(*types) & labels.state_name(F.col("state")).isNotNull())
    place = F.row_number().over(Window.partitionBy("payer_type").orderBy("median_price", "state"))
    return rows.withColumn("place", place).select(
        "payer_type", "state", "place", (F.col("place") % 2).alias("band"), "median_price", "p25_price", "p75_price", F.when(F.col("low_n"), "few").otherwise("enough").alias("reliability"))


def region_frame(summary: DataFrame, types: Sequence[str], limits: tuple[float, float]) -> DataFrame:
    """Ratios of each region's states, squeezed into the limits, in the order of the first type's ratio within the region."""
    squeezed = lambda c: F.least(F.greatest(F.col(c), F.lit(limits[0])), F.lit(limits[1])).alias(c)
    rows = summary.where(F.col("payer_type").isin(*types)).withColumn("region", labels.region(F.col("state"))).where("region is not null")
    first = rows.where(F.col("payer_type") == types[0]).select("state", F.row_number().over(Window.partitionBy("region").orderBy(F.desc("median_ratio"), "state")).alias("place"))
    return rows.join(first, "state", "left").select("region", "state", "place", "payer_type", squeezed("median_ratio"), squeezed("p25_ratio"), squeezed("p75_ratio"), "low_n")


def forest_frame(models: DataFrame, series: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Estimates of the (definition, term, label) series, intervals only where they aren't exploratory, and no rows that don't compare payments. models: flagged's with ci_low, ci_high."""
    names = models.sparkSession.createDataFrame(list(series), "definition string, term string, series string")
    rows = models.where("payment_comparison").join(F.broadcast(names), ["definition", "term"])  # a handful of series
    kept = lambda c: F.when(~F.col("exploratory"), F.col(c)).alias(c)
    return rows.select("code", "payer_type", "series", "estimate", kept("ci_low"), kept("ci_high"), "exploratory", F.col("n_group_clusters").alias("n_clusters"))


def impact(before: DataFrame, after: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, before, after, change, share of change of every metric that either has and that differs."""
    both = before.select(*keys, F.col(value).alias("before")).join(after.select(*keys, F.col(value).alias("after")), list(keys), "full")
    return both.where(~F.col("before").eqNullSafe(F.col("after"))).withColumns({"change": F.col("after") - F.col("before"), "share": F.try_divide(F.col("after") - F.col("before"), F.col("before"))})
