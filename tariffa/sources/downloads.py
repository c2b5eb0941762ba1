"""What a download knows before and after its bytes: names, encodings, provenance, whether to try again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffa.functions import text as tx

#: Endings of price files, and the least bytes of a file that isn't an error page. Fixed values.
_INNER, _OUTER = "csv|json|txt", "csv|json|zip|gz|txt"
LEAST_BYTES = 1024
#: Statuses of a download that stand; others are tried again.
FINAL = ("ok", "not_found", "blocked", "too_small", "html")


def url_extension(url: Column) -> Column:
    """.csv, .json, .csv.gz, .zip … of a URL's path, else empty."""
    return F.regexp_extract(F.lower(F.regexp_replace(url, "[?#].*$", "")), rf"((?:\.(?:{_INNER}))?\.(?:{_OUTER}))$", 1)


def file_stem(url: Column) -> Column:
    """A short name for a URL's file: a hash of the URL, and a readable slice of its base name (many files share theirs)."""
    base = F.regexp_extract(F.regexp_replace(url, "[?#].*$", ""), "([^/]*)/*$", 1)
    plain = F.coalesce(F.try_url_decode(F.replace(base, F.lit("+"), F.lit("%2B"))), base)
    readable = F.substring(F.regexp_replace(F.regexp_replace(plain, rf"(\.({_INNER}))?\.({_OUTER})$", ""), "[^A-Za-z0-9._-]+", "_"), 1, 60)
    return F.concat_ws("_", F.substring(F.md5(url), 1, 12), F.nullif(readable, F.lit("")))


def encoded_url(url: Column) -> Column:
    """Blanks and square brackets percent-encoded."""
    out = tx.stripped(url)
    for raw, code in ((" ", "%20"), ("[", "%5B"), ("]", "%5D")):
        out = F.replace(out, F.lit(raw), F.lit(code))
    return out


def is_tls_error(message: Column) -> Column:
    return F.coalesce(F.lower(message).rlike("ssl|tls|certificate"), F.lit(False))


def http_instead(url: Column) -> Column:
    """The same URL without TLS, for one further try after a TLS error."""
    return F.regexp_replace(url, "(?i)^https://", "http://")


def recorded(fetched: DataFrame) -> DataFrame:
    """A row for each fetched file: url, stem, extension, bytes, sha256, http_status, status, retrieved_at, error. fetched: url, content (binary, null for none), http_status, kind (of the bytes), retrieved_at, error."""
    size = F.octet_length("content")
    status = (
        F.when(F.col("http_status") == 404, "not_found").when(F.col("http_status").isin(401, 403), "blocked").when(F.col("content").isNull() | (F.col("http_status") >= 400), "failed")
        .when(F.col("kind") == "html", "html").when(size < LEAST_BYTES, "too_small").otherwise("ok")
    )
    return fetched.select("url", file_stem(F.col("url")).alias("stem"), url_extension(F.col("url")).alias("extension"), size.cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"), "http_status", status.alias("status"), "retrieved_at", "error")


def to_try(urls: DataFrame, state: DataFrame) -> DataFrame:
    """URLs without a final status, with the URL to try: after a TLS error once without TLS. urls: url. state: url, status, error, retrieved_at; the latest row of a URL counts."""
    last = state.groupBy("url").agg(F.max_by(F.struct("status", "error"), "retrieved_at").alias("s"), F.count_if(is_tls_error(F.col("error"))).alias("tls"))
    rows = urls.select("url").distinct().join(last, "url", "left").where(F.col("s").isNull() | ~F.col("s.status").isin(*FINAL))
    again = F.when((F.col("tls") == 1) & is_tls_error(F.col("s.error")), http_instead(F.col("url"))).otherwise(F.col("url"))
    return rows.select("url", encoded_url(again).alias("fetch_url"))


def provenance(files: DataFrame) -> DataFrame:
    """A row for each public file: its latest release by date, then by hash, then by URL; rows without a dataset go. files: dataset, release, source_url, sha256, downloaded_at."""
    best = F.max_by(F.struct("release", "source_url", "sha256", "downloaded_at"), F.struct("release", "downloaded_at", "sha256", "source_url"))
    return files.where("dataset is not null").groupBy("dataset").agg(best.alias("b"), F.count_distinct("sha256").alias("n_versions")).select("dataset", "b.*", "n_versions")
