"""Window forms: surrogate keys, first rows, labels of runs, fills, margins, shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariffa.lineage import cut


def surrogate_keys(dim: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Numbers from 1 in an order with nulls last, for dimensions. Ranges are sorted, kept and counted, so no task sorts them all and places and counts come from the same rows."""
    cols = [F.col(c).asc_nulls_last() for c in order]
    placed = cut(dim.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("__at", F.monotonically_increasing_id()))
    placed = placed.withColumn("__part", F.shiftright("__at", 33))
    sizes = placed.groupBy("__part").agg(F.count("*").alias("__n"))
    # a row for each partition of the sort
    starts = sizes.withColumn("__start", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    place = F.col("__start") + F.col("__at").bitwiseAND((1 << 33) - 1) + 1
    return placed.join(F.broadcast(starts), "__part").withColumn(name, place.cast("int")).drop("__at", "__part", "__start")


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1) -> DataFrame:
    """The first k rows of each key; Spark keeps k rows a task before the shuffle."""
    return df.withColumn("__k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__k") <= k).drop("__k")


def run_labels(df: DataFrame, keys: Sequence[str], order: Sequence[Column], starts: Column, out: str = "run") -> DataFrame:
    """Numbers of runs: each row that starts one raises it."""
    line = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(F.when(starts, 1).otherwise(0)).over(line))


def filled(df: DataFrame, keys: Sequence[str], order: Sequence[Column], column: str) -> DataFrame:
    """Nulls take the last value before them, else the first after."""
    w = Window.partitionBy(*keys).orderBy(*order)
    down = F.last(column, True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    up = F.first(column, True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return df.withColumn(column, F.coalesce(down, up))


def with_margin(df: DataFrame, keys: Sequence[str], score: str, tie: Sequence[str], alone: float = 0.0) -> DataFrame:
    """The best row of each key, with its lead over the runner-up (over `alone` without one)."""
    w = Window.partitionBy(*keys).orderBy(F.desc(score), *tie)
    marked = df.withColumn("__next", F.lead(score).over(w)).withColumn("__k", F.row_number().over(w))
    return marked.where("__k = 1").withColumn("margin", F.col(score) - F.coalesce("__next", F.lit(alone))).drop("__next", "__k")


def group_share(df: DataFrame, keys: Sequence[str], value: str, out: str = "share") -> DataFrame:
    return df.withColumn(out, F.try_divide(F.col(value), F.sum(value).over(Window.partitionBy(*keys))))


def changes(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, out: str = "change", before: float = 0) -> DataFrame:
    return df.withColumn(out, F.col(value) - F.lag(value, 1, before).over(Window.partitionBy(*keys).orderBy(*order)))


def broadcast_value(df: DataFrame, keys: Sequence[str], pick: Column, value: str, out: str) -> DataFrame:
    """A value of the group's picked row on all its rows."""
    return df.withColumn(out, F.max(F.when(pick, F.col(value))).over(Window.partitionBy(*keys)))


def global_bands(df: DataFrame, value: str, bands: int, out: str = "band") -> DataFrame:
    """Bands between global quantiles (interpolated; ties stay together); null stays null.

    Equal values are counted first and the counts cumulated over sorted ranges, so no task holds the column; the few values
    around each cut are fetched.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("__v")).agg(F.count("*").alias("__n"))
    placed = cut(counts.repartitionByRange("__v").sortWithinPartitions("__v").withColumn("__part", F.spark_partition_id()))
    sizes = placed.groupBy("__part").agg(F.sum("__n").alias("__n")).orderBy("__part").collect()  # a row for each range
    total = sum(r["__n"] for r in sizes)
    starts, at = [], 0
    for r in sizes:
        starts += [F.lit(r["__part"]), F.lit(at)]
        at += r["__n"]
    cuts = []
    if total:
        within = F.sum("__n").over(Window.partitionBy("__part").orderBy("__v"))
        ends = placed.withColumn("__end", within + F.create_map(*starts)[F.col("__part")])
        places = [(i * (total - 1)) / bands for i in range(1, bands)]
        wanted = sorted({k for p in places for k in (int(p), min(int(p) + 1, total - 1))})
        # the value at a place: the least whose cumulated count lies above it
        hit = F.exists(F.array(*map(F.lit, wanted)), lambda k: (k < F.col("__end")) & (k >= F.col("__end") - F.col("__n")))
        near = sorted((r["__end"], r["__v"]) for r in ends.where(hit).select("__end", "__v").collect())  # two values a cut at the most
        of = lambda k: next(v for e, v in near if k < e)
        cuts = [of(int(p)) + (p - int(p)) * (of(min(int(p) + 1, total - 1)) - of(int(p))) for p in places]
    band = F.lit(1)
    for c in cuts:
        band = band + F.when(F.col(value) > c, 1).otherwise(0)
    return df.withColumn(out, F.when(F.col(value).isNotNull(), band))


def interleaved(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Rows in rounds, one of each key a round; for polite queues."""
    turn = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("turn", turn).orderBy("turn", *order)
