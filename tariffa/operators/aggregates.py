"""Aggregates: exact quantiles, staged medians, agreement, spread, correlation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def quantiles(df: DataFrame, keys: Sequence[str], value: str, levels: dict[str, float], counts: str | None = None) -> DataFrame:
    """Exact interpolated quantiles by group, nulls passed over.

    Equal values of a group are counted before the shuffle of the final step, so its buffers hold distinct values and
    their frequencies only. counts: a column for the number of values.
    """
    sums = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("__v")).agg(F.count("*").alias("__n"))
    found = [F.expr(f"percentile(__v, {q}D, __n)").alias(name) for name, q in levels.items()]
    return sums.groupBy(*keys).agg(*found, *([F.sum("__n").alias(counts)] if counts else []))


def median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median", counts: str | None = None) -> DataFrame:
    return quantiles(df, keys, value, {out: 0.5}, counts)


def staged_medians(df: DataFrame, stages: Sequence[Sequence[str]], value: str, last: dict[str, float], counts: str) -> DataFrame:
    """Medians of medians: by each stage's keys in turn, then the last stage's quantiles and number of units."""
    for keys in stages[:-1]:
        df = median(df, keys, value, value)
    return quantiles(df, stages[-1], value, last, counts)


def share(condition: Column) -> Column:
    """Share of rows that meet a condition, null counting as no."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def joined_names(x: Column | str, sep: str = ";", most: int | None = None) -> Column:
    """Distinct values in order, joined."""
    values = F.array_sort(F.collect_set(x))
    return F.array_join(F.slice(values, 1, most) if most else values, sep)


def weighted_mean(x: Column, w: Column) -> Column:
    return F.try_divide(F.sum(x * w), F.sum(F.when(x.isNotNull(), w)))


def distinct_pairs(*columns: str) -> Column:
    """Distinct rows of columns; a null in one of them still counts."""
    return F.count_distinct(F.struct(*columns))


def confusion(df: DataFrame, truth: str, guess: str, weight: Column | None = None) -> DataFrame:
    """Rows and weights by label pair, with the share of the truth's weight."""
    cells = df.groupBy(truth, guess).agg(F.count("*").alias("n"), F.sum(weight if weight is not None else F.lit(1)).alias("weight"))
    return cells.withColumn("share", F.try_divide(F.col("weight"), F.sum("weight").over(Window.partitionBy(truth))))


def counted_by(df: DataFrame, dimensions: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """The same measures by each of several dimensions, stacked: dimension, level, measures. One pass of grouping sets."""
    view = df.select(*dimensions, *(m.alias(f"__{n}") for n, m in measures.items()))
    sets = ", ".join(f"(`{d}`)" for d in dimensions)
    names = ", ".join(f"sum(`__{n}`) AS `{n}`" for n in measures)
    marks = ", ".join(f"grouping(`{d}`) AS `__g_{d}`" for d in dimensions)
    cols = ", ".join(f"`{d}`" for d in dimensions)
    made = view.sparkSession.sql(f"SELECT {cols}, {marks}, {names} FROM {{view}} GROUP BY GROUPING SETS ({sets})", view=view)
    which = F.coalesce(*(F.when(F.col(f"__g_{d}") == 0, F.lit(d)) for d in dimensions))
    level = F.coalesce(*(F.when(F.col(f"__g_{d}") == 0, F.col(d).cast("string")) for d in dimensions))
    return made.select(which.alias("dimension"), level.alias("level"), *measures)


def explained_share(df: DataFrame, keys: Sequence[str], group: str, value: str) -> DataFrame:
    """Of a value's variance the share between groups (one-way R squared), by keys: two sums, no regression."""
    inner = df.where(F.col(value).isNotNull()).groupBy(*keys, group).agg(F.count("*").alias("n"), F.sum(value).alias("s"), F.sum(F.col(value) * F.col(value)).alias("q"))
    within, total = F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n")), F.sum("q") - F.sum("s") * F.sum("s") / F.sum("n")
    return inner.groupBy(*keys).agg((1 - F.try_divide(within, total)).alias("r2"), F.sum("n").alias("n"), F.count("*").alias("n_groups"))


def average_ranks(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Ranks in which ties share their mean: values are counted first, so the window runs over distinct values."""
    sums = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"))
    below = F.coalesce(F.sum("__n").over(Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = sums.withColumn(out, below + (F.col("__n") + 1) / 2).drop("__n")
    return df.join(ranks, [*keys, value])


def spearman(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Rank correlation by keys, rows with a null passed over."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    ranked = average_ranks(average_ranks(both, keys, x, "__rx"), keys, y, "__ry")
    return ranked.groupBy(*keys).agg(F.corr("__rx", "__ry").alias("rho"), F.count("*").alias("n"))


def equal_rates(df: DataFrame, keys: Sequence[str], code: str, value: str, least: int) -> DataFrame:
    """Keys and values that stand on at least so many codes."""
    return df.groupBy(*keys, value).agg(F.count_distinct(code).alias("n_codes"), F.count("*").alias("n_rows")).where(F.col("n_codes") >= least)
