"""Statuses of discovery rounds: location files by domain, footer links by home page, extraction by URL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tariffa.functions import text as tx
from tariffa.operators.crawl import looks_like_location_file
from tariffa.sources import web

#: Statuses that an extraction keeps. Fixed values.
EXTRACTED = ("ok", "no_target_codes", "blocked")


def text_statuses(responses: DataFrame) -> DataFrame:
    """responses with status and error_message. responses: domain, http_status, message (of a failed request), content_type, body, n_locations (parsed entries)."""
    http = web.outcome(F.col("http_status"), F.col("message"))
    body = F.coalesce("body", F.lit(""))
    page = F.coalesce(F.lower("content_type").contains("html"), F.lit(False)) | body.rlike("(?i)<html|<!doctype|<body|<head")
    named = looks_like_location_file(body)
    entries = F.coalesce("n_locations", F.lit(0)) > 0
    status = F.when(http != "ok", http).when(F.trim(body) == "", "empty").when(named & entries, "ok").when(named, "empty").when(page, "soft_404_html").otherwise("empty")
    why = (
        F.when(F.col("http_status").isNull(), tx.squished(F.col("message"))).when(http != "ok", F.concat(F.lit("HTTP "), F.col("http_status").cast("string"))).when(F.trim(body) == "", "empty body")
        .when(named & ~entries, "no entry could be parsed").when(~named & page, "a page instead of a location file").when(~named, "no location key")
    )
    return responses.withColumns({"status": status, "error_message": why})


def preferred(rows: DataFrame) -> DataFrame:
    """One row for each site: a good answer before a bad one, the bare domain before the one with www, the later fetch before the earlier. rows: domain, status, fetched_at."""
    bare = F.regexp_replace(F.lower("domain"), "^www[.]", "")
    w = Window.partitionBy("site").orderBy((F.col("status") != "ok").cast("int"), (F.lower("domain") != F.col("site")).cast("int"), F.desc("fetched_at"))
    return rows.withColumn("site", bare).withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k")


def footer_statuses(domains: DataFrame, links: DataFrame) -> DataFrame:
    """domain, status, n_files: what a home page gave. domains: domain, robots_status, home_allowed, home_status. links: domain, link, is_data (names a price file), page_allowed, page_status, n_files (found on the page)."""
    page = F.when(F.col("is_data"), "file").when(~F.col("page_allowed"), "price_page_robots_disallowed").when(F.col("page_status") != "ok", F.concat(F.lit("price_page_"), F.col("page_status"))).when(F.coalesce("n_files", F.lit(0)) > 0, "file").otherwise("no_mrf_link")
    found = F.when(F.col("is_data"), 1).when(page == "file", F.col("n_files")).otherwise(0)
    by = links.withColumn("__p", page).groupBy("domain").agg(F.sum(found).alias("n_files"), F.bool_or(F.col("__p") == "no_mrf_link").alias("none"), F.min_by("__p", "place").alias("first"), F.count("*").alias("n"))
    status = (
        F.when(F.col("robots_status") != "ok", F.col("robots_status")).when(~F.col("home_allowed"), "robots_disallowed").when(F.col("home_status") != "ok", F.col("home_status")).when(F.col("n_files") > 0, "ok")
        .when(F.coalesce("n", F.lit(0)) == 0, "no_price_link").when(F.col("none"), "no_mrf_link").otherwise(F.col("first"))
    )
    return domains.join(by, "domain", "left").select("domain", status.alias("status"), F.when(status == "ok", F.col("n_files")).otherwise(0).cast("long").alias("n_files"))


def gap_urls(candidates: DataFrame, facilities: DataFrame, state: DataFrame, covered: DataFrame) -> DataFrame:
    """URLs worth extracting: of hospitals not covered yet, with a key that no source has extracted; one URL a key. candidates: ccn, mrf_url. facilities: mrf_url. state: url, status. covered: ccn."""
    keys = facilities.select(tx.url_key(F.col("mrf_url")).alias("key")).unionByName(state.where("status = 'ok'").select(tx.url_key(F.col("url")).alias("key"))).where("key is not null").distinct()
    open_ = candidates.join(covered.select("ccn").distinct(), "ccn", "left_anti").withColumn("key", tx.url_key(F.col("mrf_url"))).where("key is not null")
    return open_.join(keys, "key", "left_anti").groupBy("key").agg(F.min("mrf_url").alias("url"), F.count_distinct("ccn").alias("n_ccns"))


def extraction_statuses(results: DataFrame) -> DataFrame:
    """url, status (ok, no_target_codes, blocked, failed), mrf_file_id (64 hex digits, else an error), n_rows. results: url, http_status, mrf_file_id, n_rows, error."""
    good_id = F.coalesce(F.col("mrf_file_id").rlike("^[0-9a-f]{64}$"), F.lit(False))
    status = F.when(F.col("http_status").isin(401, 403), "blocked").when(F.col("error").isNotNull() | ~good_id, "failed").when(F.coalesce("n_rows", F.lit(0)) == 0, "no_target_codes").otherwise("ok")
    error = F.coalesce("error", F.when(~good_id & ~F.col("http_status").isin(401, 403), "the file id is no hash"))
    return results.select("url", status.alias("status"), F.when(good_id, F.col("mrf_file_id")).alias("mrf_file_id"), F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"), error.alias("error"))
