"""Readers: text CSV, globs by name, pruned prices, public tables, lake files, tab exports."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffa.schema import public_names, require, stacked


def text_csv(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8", nulls: Sequence[str] = ("", "NA"), names: Sequence[str] = ()) -> DataFrame:
    """Every column as text; the null tokens become null. Headers become plain lower-case names."""
    options = dict(sep=sep, encoding=encoding, multiLine=True, escape='"', quote='"')
    # the header is read as a row: as a header Spark would number repeated names
    head = spark.read.csv(path, header=False, **options).first() or ()
    raw = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(head))])
    df = spark.read.csv(path, header=True, enforceSchema=True, schema=raw, **options)
    df = df.toDF(*(names or public_names(h or "" for h in head)))
    for token in nulls:
        df = df.select(*(F.nullif(F.col(f"`{c}`"), F.lit(token)).alias(c) for c in df.columns))
    return df


def as_table(spark: SparkSession, x: DataFrame | str) -> DataFrame:
    """A frame as text columns, or the CSV at a path."""
    if isinstance(x, str):
        return text_csv(spark, x)
    return x.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in x.columns))


def parquet_by_name(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Several globs, united by name; a column that one lacks is null there."""
    return stacked(*(spark.read.option("mergeSchema", True).parquet(p) for p in paths))


def prices(spark: SparkSession, path: str, concepts: Sequence[str] | None = None) -> DataFrame:
    """Partitioned prices; listed concepts prune the partitions."""
    df = spark.read.parquet(path)
    return df.where(F.col("concept").isin(list(concepts))) if concepts is not None else df


def write_prices(df: DataFrame, path: str) -> None:
    """Partitions by concept; Spark balances the tasks that write them."""
    df.hint("rebalance", "concept").write.mode("overwrite").partitionBy("concept").parquet(path)


def write_single_csv(df: DataFrame, path: str) -> None:
    """A small report as one local CSV, put in place at once."""
    import os

    df.toPandas().to_csv(f"{path}.part", index=False)
    os.replace(f"{path}.part", path)


def public_table(spark: SparkSession, path: str, required: Sequence[str], what: str, **options) -> DataFrame:
    return require(text_csv(spark, path, **options), required, what)


def titled_tsv(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """A tab table below one title line."""
    lines = spark.read.text(path).withColumn("__at", F.monotonically_increasing_id())
    head = lines.orderBy("__at").limit(2).collect()
    names = public_names(head[1].value.split("\t"))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    df = spark.read.csv(path, sep="\t", schema=schema, encoding=encoding)
    first = F.col(names[0])
    return df.where(~(first.eqNullSafe(head[0].value.split("\t")[0]) | first.eqNullSafe(head[1].value.split("\t")[0])))


def natality(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """Rows of a tab export (total rows and the notes block off, counts as text) and the lines of its notes."""
    lines = [r.value for r in spark.read.text(path, wholetext=False).collect()]  # an export of a few thousand lines
    cut = next((i for i, x in enumerate(lines) if x.strip().strip('"') == "---"), len(lines))
    rows = [[c.strip('"') for c in x.split("\t")] for x in lines[:cut]]
    names = public_names(rows[0])
    body = [r + [""] * (len(names) - len(r)) for r in rows[1:] if r[0] != "Total" and any(r)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.createDataFrame([tuple(r[: len(names)]) for r in body], schema), [x.strip('"') for x in lines[cut:]]


def births(x):
    """A count with commas; suppressed ones null."""
    return F.regexp_replace(x, ",", "").try_cast("double")


def note_value(notes: Sequence[str], label: str) -> str | None:
    found = (re.match(rf"{re.escape(label)}:\s*(.*)$", n) for n in notes)
    return next((m[1].strip() for m in found if m), None)


def wage_index(df: DataFrame, ccn: str, candidates: Sequence[str], added: str | None = None) -> DataFrame:
    """ccn, wage_index: the first candidate that is there, plus an adjustment; the first row of a ccn by its value."""
    value = F.coalesce(*(F.col(c).try_cast("double") for c in candidates))
    if added:
        value = value + F.coalesce(F.col(added).try_cast("double"), F.lit(0.0))
    return df.select(F.col(ccn).alias("ccn"), value.alias("wage_index")).where("wage_index is not null").groupBy("ccn").agg(F.min("wage_index").alias("wage_index"))


def lake_files(files: DataFrame, deletes: DataFrame, inlined_rows: int) -> list[str] | None:
    """Paths of a lake table's data files, or None where delete files or inlined rows make a full scan through the catalog necessary."""
    if inlined_rows or deletes.limit(1).count():
        return None
    return [r.path for r in files.select("path").orderBy("path").collect()]


def any_rows(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
