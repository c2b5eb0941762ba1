"""Resumable batches: freshness, manifests, and file streams that take up where they stopped."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stale(keys: DataFrame, state: DataFrame, key: str, status: str, at: str, final: Sequence[str], days: int, now: Column | None = None) -> DataFrame:
    """Keys still to do: those without a final status that is at most so many days old."""
    now = F.current_timestamp() if now is None else now
    fresh = state.where(F.col(status).isin(*final) & (F.col(at) >= now - F.make_interval(days=F.lit(days))))
    return keys.join(fresh.select(key), key, "left_anti")


def pending(parts: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """Parts that no finished entry of the manifest names."""
    return parts.join(manifest.select(key), key, "left_anti")


def staged(spark: SparkSession, source: str, schema: T.StructType, out: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], files_per_batch: int = 20) -> None:
    """Runs every file not yet seen through `transform` into Parquet, some files a batch; a stopped run goes on where it was.

    Each batch has a folder of its own that a repeat overwrites, so rows land once.
    """

    def batch(df: DataFrame, number: int) -> None:
        transform(df).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def frontier(seeds: DataFrame, links: DataFrame, rounds: int = 3) -> DataFrame:
    """node, round, via: what is reached from the seeds over links (from, to) in so many rounds, the first round that found it and, but for seeds, the least node of the round before that links to it."""
    found = seeds.select("node", F.lit(0).alias("round"), F.lit(None).cast(links.schema["from"].dataType).alias("via")).distinct()
    edge = found
    for k in range(1, rounds + 1):
        met = links.join(edge.select(F.col("node").alias("from")), "from").groupBy(F.col("to").alias("node")).agg(F.min("from").alias("via"))
        edge = met.join(found, "node", "left_anti").select("node", F.lit(k).alias("round"), "via")
        found = found.unionByName(edge)
    return found
