"""A lake of parsed price files: its tables, facilities, and the price rows of target codes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffa import schema as sc
from tariffa.functions import text as tx
from tariffa.sources.mrf import prefilter

#: Names that tables and keys may have, the first that fits counts. Fixed names.
DETAILS, HOSPITALS, VERSIONS, IDENTITY = ("current_charge_details", "standard_charge_details"), ("current_hospitals", "hospitals"), ("hospital_versions",), ("hospital_identity",)
KEYS = ("internal_id", "hospital_version_id", "hospital_id")
NEEDED = {"details": ("payer_name", "plan_name", "cpt", "hcpcs", "ms_drg"), "hospitals": ("hospital_name",), "versions": ("internal_id", "run_date", "mrf_url"), "identity": ("internal_id", "npi")}
#: A marker that stands for a missing value.
MISSING = "Not provided"
#: Entries of a codebook, which becomes a literal of the plan.
MOST_CODES = 10_000


def attach(spark: SparkSession, folder: str, names: Iterable[str] = (*DETAILS, *HOSPITALS, *VERSIONS, *IDENTITY)) -> dict[str, DataFrame]:
    """The tables of a lake folder, one subfolder (or .parquet file) of Parquet data each; names that aren't there are left out."""
    found = {}
    for name in names:
        for path in (f"{folder}/{name}", f"{folder}/{name}.parquet"):
            try:
                found[name] = spark.read.parquet(path)
                break
            except AnalysisException:
                continue
    return found


def introspected(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """relation, place, column, data_type of every column."""
    rows = [(name, i, f.name, f.dataType.simpleString()) for name, df in sorted(tables.items()) for i, f in enumerate(df.schema)]
    return spark.createDataFrame(rows, "relation string, place int, column string, data_type string")


@dataclass
class Relations:
    """The tables that an extract reads, the key that joins them, and the name of the table of charges."""

    details: DataFrame
    hospitals: DataFrame
    versions: DataFrame | None
    identity: DataFrame | None
    key: str
    by_run_date: bool
    table_name: str


def relations(tables: dict[str, DataFrame]) -> Relations:
    columns = {n: df.columns for n, df in tables.items()}
    name = sc.pick_relation(columns, DETAILS, NEEDED["details"])
    hospitals = sc.pick_relation(columns, HOSPITALS, NEEDED["hospitals"])
    shared = [k for k in KEYS if k in columns[name] and k in columns[hospitals]]
    if not shared:
        raise ValueError(f"{name} and {hospitals} share none of {', '.join(KEYS)}")

    def optional(names: Sequence[str], kind: str) -> DataFrame | None:
        fits = [n for n in names if n in columns and set(NEEDED[kind]) <= set(columns[n])]
        return tables[fits[0]] if fits and shared[0] == "internal_id" else None

    both_dated = "run_date" in columns[name] and "run_date" in columns[hospitals]
    return Relations(tables[name], tables[hospitals], optional(VERSIONS, "versions"), optional(IDENTITY, "identity"), shared[0], both_dated, name)


def given(x: Column) -> Column:
    """Text without outer blanks; blanks and the marker of a missing value are null."""
    return F.nullif(F.nullif(F.trim(x), F.lit(MISSING)), F.lit(""))


def facilities(rel: Relations) -> DataFrame:
    """A row for each facility: facility_key, mrf_url, mrf_file_id (by content where known), names, address, licence, NPI, version and dates."""
    keys = [rel.key, *(["run_date"] if rel.by_run_date else [])]
    rows = rel.hospitals
    if rel.versions is not None:
        on = [rel.key, *(["run_date"] if "run_date" in rows.columns else [])]
        more = [c for c in rel.versions.columns if c not in rows.columns or c in on]
        rows = rows.join(rel.versions.select(more).dropDuplicates(on), on, "left")
    if rel.identity is not None:
        more = [c for c in rel.identity.columns if c not in rows.columns or c == rel.key]
        rows = rows.join(rel.identity.select(more).dropDuplicates([rel.key]), rel.key, "left")
    of = lambda *names: given(sc.first_of(rows, names))
    url = of("mrf_url", "file_url")
    content = F.coalesce(of("content_hash", "md5"), F.md5(F.coalesce(tx.url_key(url), F.concat(F.lit("facility:"), F.col(rel.key).cast("string")))))
    return rows.select(
        *keys, F.concat_ws("|", *(F.col(k).cast("string") for k in keys)).alias("facility_key"), url.alias("mrf_url"), content.alias("mrf_file_id"),
        of("hospital_name").alias("hospital_name"), of("location_name", "hospital_location").alias("location_name"), of("address", "hospital_address").alias("address"), of("city", "enriched_hospital_city").alias("city"),
        of("state", "enriched_hospital_state").alias("state"), of("license_number").alias("license_number"), F.upper(of("license_state")).alias("license_state"), of("npi", "type_2_npi").alias("type_2_npi"),
        of("version", "file_version").alias("file_version"), of("last_updated_on").alias("last_updated_on"), of("run_date", "retrieved_at").alias("retrieved_at"),
    ).distinct()


def exported_facilities(rel: Relations) -> DataFrame:
    """Facilities for the matching, each with its file's id."""
    columns = "facility_key mrf_url mrf_file_id hospital_name location_name address city state license_number license_state type_2_npi".split()
    return facilities(rel).select(columns[0], F.lit("lake").alias("source"), *columns[1:]).distinct()


def staged(rel: Relations, codebook: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Charge lines with a target in any code column, each file's once: of the facilities that share a file the first by key stands for it. Every line is kept, equal ones too."""
    keys = [rel.key, *(["run_date"] if rel.by_run_date else [])]
    files = facilities(rel)
    first = files.groupBy("mrf_file_id").agg(F.min(F.struct(*keys, "mrf_url", "file_version", "last_updated_on", "retrieved_at")).alias("f"))
    first = first.select("mrf_file_id", *(F.col(f"f.{k}").alias(k) for k in keys), *(F.col(f"f.{c}").alias(f"f_{c}") for c in ("mrf_url", "file_version", "last_updated_on", "retrieved_at")))
    columns = [c for c in ("cpt", "hcpcs", "ms_drg", "other_code1", "other_code2") if c in rel.details.columns]
    book = [(family, code) for _, code, family in codebook]
    return rel.details.where(prefilter(columns, book)).join(first, keys)


def hits(line_codes: Column, codebook: Sequence[tuple[str, str, str]]) -> Column:
    """Of an array of (family, code, type) the distinct targets: concept, code, code_system, code_type, type_verified. codebook: (concept, code, family), a literal of the plan."""
    if len(codebook) > MOST_CODES:
        raise ValueError(f"a codebook of more than {MOST_CODES} entries")
    table = F.create_map(*(x for concept, code, family in codebook for x in (F.concat(F.lit(f"{family}|"), tx.normal_code(F.lit(code), F.lit(family))), F.lit(concept))))
    key = lambda c: F.concat(c["family"], F.lit("|"), tx.normal_code(c["code"], c["family"]))
    fit = lambda c: tx.code_type_fit(c["type"], c["family"])
    good = F.filter(line_codes, lambda c: F.try_element_at(table, key(c)).isNotNull() & (fit(c) != "incompatible"))
    return F.array_distinct(F.transform(good, lambda c: F.struct(
        F.try_element_at(table, key(c)).alias("concept"), tx.normal_code(c["code"], c["family"]).alias("code"), c["family"].alias("code_system"), tx.code_type(c["type"]).alias("code_type"), (fit(c) == "verified").alias("type_verified"))))


def extracted(stage: DataFrame, codebook: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Price rows of staged lines: one for each line and target, without joins or shuffles."""
    slot = lambda family, code, kind: F.struct(F.lit(family).alias("family"), F.col(code).cast("string").alias("code"), kind.cast("string").alias("type"))
    slots = [slot("procedure", "cpt", F.lit("CPT")), slot("procedure", "hcpcs", F.lit("HCPCS")), slot("ms_drg", "ms_drg", F.lit("MS-DRG"))]
    for c in ("other_code1", "other_code2"):
        if c in stage.columns:
            kind = sc.first_of(stage, [f"{c}_type"])
            slots += [slot(family, c, kind) for family in ("procedure", "ms_drg", "apr_drg")]
    of = lambda kind, *names: sc.first_of(stage, names, kind)
    rows = stage.select(
        F.lit("lake").alias("source"), "mrf_file_id", F.col("f_mrf_url").alias("mrf_url"), F.col("f_file_version").alias("file_version"), F.col("f_last_updated_on").alias("last_updated_on"), F.col("f_retrieved_at").alias("retrieved_at"),
        of("string", "description").alias("description"), of("string", "modifiers").alias("modifiers"), of("string", "setting", "enriched_setting").alias("setting"), of("string", "billing_class", "enriched_billing_class").alias("billing_class"),
        of("double", "gross_charge").alias("gross"), of("double", "discounted_cash").alias("discounted_cash"), of("double", "minimum").alias("min"), of("double", "maximum").alias("max"), "payer_name", "plan_name",
        of("string", "enriched_payer_type", "payer_type").alias("payer_type"), of("double", "standard_charge_dollar").alias("negotiated_dollar"), of("double", "standard_charge_percentage").alias("negotiated_percentage"),
        of("string", "standard_charge_algorithm").alias("negotiated_algorithm"), of("string", "methodology", "enriched_methodology").alias("methodology"), of("double", "median_amount").alias("median_amount"),
        of("double", "percentile_10th", "10th_percentile").alias("p10"), of("double", "percentile_90th", "90th_percentile").alias("p90"), of("string", "count").alias("count"), of("double", "estimated_amount").alias("estimated_amount"),
        F.concat_ws(" | ", of("string", "additional_generic_notes"), of("string", "additional_payer_notes")).alias("notes"),
        F.explode(hits(F.array(*slots), codebook)).alias("__hit"),
    )
    return sc.conform(rows.select("*", "__hit.*").drop("__hit"))


def extract(spark: SparkSession, folder: str, codebook: Sequence[tuple[str, str, str]], out: str) -> DataFrame:
    """The whole extract: stages the lines below `out`, unless a finished stage stands there, and writes and returns the price rows; facilities are written beside them."""
    rel = relations(attach(spark, folder))
    try:
        stage = spark.read.parquet(f"{out}/stage")
    except AnalysisException:
        staged(rel, codebook).write.mode("errorifexists").parquet(f"{out}/stage")
        stage = spark.read.parquet(f"{out}/stage")
    extracted(stage, codebook).write.mode("overwrite").parquet(f"{out}/prices")
    exported_facilities(rel).write.mode("overwrite").parquet(f"{out}/facilities")
    return spark.read.schema(sc.PRICE_SCHEMA).parquet(f"{out}/prices")


def codebook_check(codebook: DataFrame, schedule: DataFrame) -> DataFrame:
    """The codebook with whether a fee schedule lists each procedure, and its status. schedule: code, status."""
    listed = schedule.select(tx.procedure_code(F.col("code")).alias("code"), "status").groupBy("code").agg(F.min("status").alias("status"))
    rows = codebook.join(listed.withColumn("__in", F.lit(True)), "code", "left")
    return rows.withColumn("listed", F.when(F.col("code_family") == "procedure", F.col("__in").isNotNull())).drop("__in")
