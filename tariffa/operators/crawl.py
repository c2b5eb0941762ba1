"""Seeds, queues and duplicates of crawled files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariffa.functions import text as tx

#: Hosts at whose root no hospital can put a file, and endings of storage and content networks. Fixed values.
JUNK_HOSTS = (
    "google.com", "www.google.com", "docs.google.com", "drive.google.com", "sites.google.com", "storage.googleapis.com", "dropbox.com", "www.dropbox.com", "dl.dropboxusercontent.com",
    "github.com", "www.github.com", "raw.githubusercontent.com", "s3.amazonaws.com", "cms.gov", "www.cms.gov", "hhs.gov", "www.hhs.gov", "onedrive.live.com", "1drv.ms", "bit.ly", "tinyurl.com",
    "facebook.com", "www.facebook.com", "twitter.com", "x.com", "linkedin.com", "www.linkedin.com", "youtube.com", "www.youtube.com", "instagram.com", "www.instagram.com",
    "box.com", "app.box.com", "archive.org", "web.archive.org", "dolthub.com", "www.dolthub.com",
)
JUNK_ENDINGS = (
    ".blob.core.windows.net", ".core.windows.net", ".cloudfront.net", ".amazonaws.com", ".googleapis.com", ".googleusercontent.com",
    ".sharepoint.com", ".azureedge.net", ".box.com", ".dropboxusercontent.com", ".githubusercontent.com", ".cdn-website.com",
)


def is_junk_host(name: Column) -> Column:
    """No host, an address in numbers, a name without a dot, or a place that holds the files of many."""
    ending = F.exists(F.array(*map(F.lit, JUNK_ENDINGS)), lambda e: name.endswith(e))
    return F.coalesce(name.isin(*JUNK_HOSTS) | ending | name.rlike("^[0-9.]+$") | ~name.contains("."), F.lit(True))


def seeds(tables: Sequence[tuple[DataFrame, str, Sequence[str]]], score: str | None = None) -> DataFrame:
    """ccn, domain, seed_source, match_score, is_variant from (frame with ccn, source, URL columns); a domain of a ccn keeps its best score, its own form before variants."""
    parts = []
    for frame, source, columns in tables:
        long = frame.select("ccn", (F.col(score) if score and score in frame.columns else F.lit(1.0)).cast("double").alias("match_score"), F.explode(F.array_compact(F.array(*(tx.site(F.col(c)) for c in columns)))).alias("site"))
        parts.append(long.where(~is_junk_host(F.col("site"))).withColumn("seed_source", F.lit(source)))
    every = reduce(DataFrame.unionByName, parts)
    wide = every.select("ccn", "seed_source", "match_score", "site", F.explode(tx.domain_variants(F.col("site"))).alias("domain"))
    best = F.min(F.struct((F.col("domain") != F.col("site")).alias("is_variant"), (-F.col("match_score")).alias("s"), "seed_source")).alias("b")
    return wide.groupBy("ccn", "domain").agg(best).select("ccn", "domain", "b.seed_source", (-F.col("b.s")).alias("match_score"), "b.is_variant")


def superseded(lake: DataFrame, own: DataFrame) -> DataFrame:
    """mrf_file_id of the older copy of each file that both sources have, by URL key; without dates the lake's stays. Both: mrf_file_id, mrf_url, last_updated_on (ISO text)."""
    side = lambda df, p: df.select(tx.url_key(F.col("mrf_url")).alias("key"), F.col("mrf_file_id").alias(f"{p}_id"), F.col("last_updated_on").alias(f"{p}_date")).where("key is not null")
    both = side(lake, "lake").join(side(own, "own"), "key")
    newer = F.coalesce(F.col("own_date") > F.col("lake_date"), F.lit(False))
    return both.select(F.when(newer, F.col("lake_id")).otherwise(F.col("own_id")).alias("mrf_file_id")).distinct()


def size_queue(links: DataFrame, size: str, least: int = 1024) -> DataFrame:
    """Links by size, unknown and tiny ones last."""
    return links.orderBy(F.when(F.col(size) >= least, F.col(size)).asc_nulls_last())


def shared_urls_blank(facilities: DataFrame) -> DataFrame:
    """A URL that gives several files can't tell them apart, so it goes."""
    n = F.size(F.collect_set("mrf_file_id").over(Window.partitionBy("mrf_url")))
    return facilities.withColumn("__n", n).withColumn("mrf_url", F.when(F.col("__n") <= 1, F.col("mrf_url"))).drop("__n")


def looks_like_location_file(text: Column) -> Column:
    """A body with the key of a file's URL at the start of a line and no markup; what the server calls it doesn't decide."""
    named = text.rlike(r"""(?i)(^|[\r\n])[\s"'\uFEFF]*mrf[\s_-]*url[\s"']*:""")
    return F.coalesce(named & ~text.rlike("(?i)<html|<!doctype|<body|<head"), F.lit(False))
