"""Sharding along a Hilbert curve.

Language, source and size are quantised to equally filled bins, the bins are a point of a cube, and the documents are
sorted by the point's place on the Hilbert curve (ties by crc of the text, then doc_id): neighbours on the curve are
alike in every dimension, so each shard's file spans a small box that readers can prune. The sorted order is cut into
runs whose row counts differ by one at most (law `rows`). Only narrow rows are sorted; global places come from counts of
the range partitions. Equal texts of one source and language stand next to each other.

Bins are cut where the counts of whole values, cumulated in their order, reach equal shares. A null takes the lowest place of its
dimension; a null text has size 16 and crc 0. Repeated rows each get a slot of their own; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffa.llm.common import checkpointed, table, text_col

SHARDS, BITS = 40, 5


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points (rows) of whole numbers below 2 ** bits, by Gray codes of the transposed bits."""
    x = points.T.astype(np.int64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            on = (x[i] & q) > 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flips = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flips ^= np.where((x[n - 1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= flips
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << 1) | ((x[i] >> b) & 1)
    return place


def ranked(rows: DataFrame, order: list[str], rank: str = "rank") -> DataFrame:
    """rows with their place (from 0) in a total order, and no window over all of them: rows are sorted in ranges, and counts of the ranges give where each begins."""
    parts = rows.repartitionByRange(max(rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *order)
    placed = checkpointed(parts.sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    part, within = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    counts = placed.groupBy(part.alias("__part")).count().collect()  # a row for each partition
    begins, start = {}, 0
    for r in sorted(counts, key=lambda r: r["__part"]):
        begins[r["__part"]] = start
        start += r["count"]
    offsets = F.create_map(*(F.lit(x) for kv in begins.items() for x in kv)) if begins else F.create_map(F.lit(0), F.lit(0))
    return placed.withColumn(rank, offsets[part].cast("long") + within).drop("__at")


def boundaries(rows: DataFrame, column: str, bins: int) -> list:
    """The least value of each bin but the first, for bins as equally filled as ties allow: values are counted, sorted in ranges and their counts cumulated."""
    counts = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    placed = checkpointed(counts.repartitionByRange("v").sortWithinPartitions("v").withColumn("part", F.spark_partition_id()))
    sizes = placed.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()  # a row for each range
    total, starts = 0, []
    for r in sizes:
        starts += [F.lit(r.part), F.lit(total)]
        total += r.n
    if not total:
        return []
    before = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.create_map(*starts)[F.col("part")]
    # a value belongs to the bin in which the middle of its rows falls
    binned = placed.withColumn("bin", F.floor((before + F.col("n") / 2) * bins / total))
    return sorted(r.v for r in binned.groupBy("bin").agg(F.min("v").alias("v")).where("bin > 0").collect())  # one value a bin


def sharded(docs: DataFrame, shards: int = SHARDS, bits: int = BITS, doc_id: str = "doc_id", text: str = "text", labels: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, hilbert."""
    body = text_col(text)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        *(F.col(c).cast("string").alias(f"d{i}") for i, c in enumerate(labels)),
    )
    dims = [f"d{i}" for i in range(len(labels))]
    rows = checkpointed(rows)  # narrow; the texts are read once
    bounds = {d: boundaries(rows, d, 1 << bits) for d in (*dims, "size")}
    # number of boundaries at or below the value; a null has none below it
    coarse = lambda d: F.coalesce(F.size(F.filter(F.array(*map(F.lit, bounds[d])), lambda b: b <= F.col(d))), F.lit(0)) if bounds[d] else F.lit(0)
    bins = [F.when(F.col(d).isNotNull(), coarse(d)).otherwise(0) for d in bounds]

    @F.pandas_udf(T.LongType())
    def place(*cols: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([c.to_numpy() for c in cols], 1), bits))

    curve = rows.select("doc_id", "size", "text_crc32", place(*bins).alias("hilbert"))
    placed = ranked(curve, ["hilbert", "text_crc32", "doc_id"])
    n = rows.count()
    # shard s holds the places from ceil(s n / shards) up to ceil((s + 1) n / shards)
    shard = F.expr(f"cast((rank * {shards}) div {max(n, 1)} as int)")
    begin = F.expr(f"(shard * {n}L + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("rank") - begin).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "hilbert")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, doc_id: str = "doc_id") -> None:
    """The documents as Parquet, a folder for each shard, along the curve within it; doc_id must name one row."""
    placed = sharded(docs, shards, doc_id=doc_id).select("doc_id", "shard", "slot")
    rows = docs.join(placed.withColumnRenamed("doc_id", "__id"), F.col(doc_id) == F.col("__id")).drop("__id")
    rows.repartitionByRange(shards, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op6_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents"))
