"""Rosters that are admitted only as frozen, and the places they are counted at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffa.functions import labels
from tariffa.sources.tables import text_csv

#: Territories beside the states and the capital. Fixed values.
TERRITORIES = ("PR", "VI", "GU", "MP", "AS")


class Changed(ValueError):
    """Files that are not the ones their manifest names."""


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """file, sha256 from `<file>.manifest.json` files, each an object with artifact_sha256."""
    read = spark.read.schema("artifact_sha256 string").json(path, multiLine=True)
    name = F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), r"\.manifest\.json$", "")
    return read.select(name.alias("file"), F.lower("artifact_sha256").alias("sha256"))


def differing(spark: SparkSession, path: str, frozen: DataFrame) -> DataFrame:
    """file, fault (changed, unknown, absent) of the files under a path against a manifest; files are hashed by tasks, one each."""
    there = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.sha2("content", 256).alias("__is"))
    both = there.join(frozen.select("file", F.col("sha256").alias("__must")), "file", "full")
    fault = F.when(F.col("__is").isNull(), "absent").when(F.col("__must").isNull(), "unknown").when(F.col("__is") != F.col("__must"), "changed")
    return both.select("file", fault.alias("fault")).where("fault is not null")


def verified(spark: SparkSession, path: str, frozen: DataFrame, **options) -> DataFrame:
    """A text CSV whose files are those of the manifest, byte for byte; else an error that names up to ten of the others."""
    bad = differing(spark, path, frozen).orderBy("file").limit(10).collect()
    if bad:
        raise Changed("; ".join(f"{r.file}: {r.fault}" for r in bad))
    return text_csv(spark, path, **options)


def active(raw: DataFrame) -> DataFrame:
    """npi, zip, state, certification: one row for each person who practises now, at an address of a state or territory.

    raw: npi, cohort_member, status, npi_tax_class, nppes_zip, nppes_state, certification. Of several rows of an npi the
    least by zip, state and certification counts.
    """
    places = [*labels.STATES, *TERRITORIES]
    now = raw.where((F.upper("cohort_member") == "TRUE") & (F.col("status") == "ACTIVE") & (F.col("npi_tax_class") == "midwife") & F.col("npi").isNotNull())
    rows = now.select("npi", F.struct(F.substring("nppes_zip", 1, 5).alias("zip"), F.col("nppes_state").alias("state"), "certification").alias("r"))
    return rows.where(F.col("r.state").isin(places)).groupBy("npi").agg(F.min("r").alias("r")).select("npi", "r.*")


def zip_of(address: Column, given: Column) -> Column:
    """The ZIP that ends an address, else the given one where it is five digits."""
    return F.coalesce(F.nullif(F.regexp_extract(address, r"\b([0-9]{5})(-[0-9]{4})?\s*$", 1), F.lit("")), F.when(given.rlike("^[0-9]{5}$"), given))


def points(raw: DataFrame) -> DataFrame:
    """zip, lat, lon of a gazetteer with GEOID, INTPTLAT, INTPTLONG, whose names and cells may have blanks around."""
    named = raw.toDF(*(c.strip() for c in raw.columns))
    return named.select(F.trim("GEOID").alias("zip"), F.trim("INTPTLAT").try_cast("double").alias("lat"), F.trim("INTPTLONG").try_cast("double").alias("lon"))


def county_of_zip(parts: DataFrame) -> DataFrame:
    """zip, county_fips: the county with the largest part of a ZIP's land (ties: the least code). parts: zip, county_fips, land."""
    told = parts.where(F.col("zip").isNotNull() & (F.col("zip") != ""))
    order = F.struct((-F.coalesce(F.col("land").cast("double"), F.lit(-1.0))).alias("a"), "county_fips")
    return told.groupBy("zip").agg(F.min_by("county_fips", order).alias("county_fips"))


def uncovered(places: DataFrame, counties: DataFrame, roster: DataFrame) -> DataFrame:
    """zip, state, lat, lon of the places in states in which the roster has nobody. places: zip, lat, lon. counties: zip, county_fips."""
    told = places.join(counties, "zip").withColumn("state", labels.fips_state(F.col("county_fips"))).where("state is not null")
    return told.join(roster.select("state").where("state is not null").distinct(), "state", "left_anti").select("zip", "state", "lat", "lon")


def lacking(roster: DataFrame, strict: bool = False) -> list[str]:
    """States (and the capital) in which the roster has nobody; strict: an error if there are any."""
    has = {r.state for r in roster.select("state").where(F.col("state").isin(list(labels.STATES))).distinct().collect()}  # 51 at most
    gone = sorted(set(labels.STATES) - has)
    if strict and gone:
        raise ValueError("the roster has nobody in " + ", ".join(gone))
    return gone
