"""Published price files, CSV (tall or wide) and JSON, to the canonical price table."""

from __future__ import annotations

import csv
import io
import json
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffa import schema as sc
from tariffa.functions import numbers as nu
from tariffa.functions import text as tx
from tariffa.operators import reshape as rs
from tariffa.operators.windows import first_rows
from tariffa.sources import files, pieces, records


#: Bytes looked at, once unpacked, for the metadata of a file that isn't fetched whole.
PREFIX_BYTES = 1 << 16


def header_name(x: str) -> str:
    """A header without a mark of byte order and blanks around bars, in lower case."""
    parts = re.split(r"\s*\|\s*", x.lstrip("﻿").strip().strip('"'))
    # payer and plan names between the bars keep their case
    return "|".join(p.lower() if i in (0, len(parts) - 1) or len(parts) < 3 else p for i, p in enumerate(parts)) if parts[0].lower() == "standard_charge" else "|".join([parts[0].lower(), *(parts[1:] if parts[0].lower() in rs.WIDE_METRICS else [p.lower() for p in parts[1:]])])


def find_header(lines: Sequence[str]) -> int | None:
    """Number of the line that heads the charges: the first with a code|1 column, else one that begins with description."""
    rows = [[header_name(c) for c in row] for row in csv.reader(lines)]
    return next((i for i, r in enumerate(rows) if "code|1" in r), next((i for i, r in enumerate(rows) if r and r[0] == "description"), None))


def layout(names: Sequence[str]) -> str:
    if "payer_name" in names and "plan_name" in names:
        return "tall"
    return "wide" if rs.wide_headers(names) else "unknown"


def metadata(lines: Sequence[str]) -> dict[str, str | None]:
    """Hospital, version, places, licence and NPIs from the two rows above the charges."""
    rows = list(csv.reader(io.StringIO("\n".join(lines))))
    pairs = {header_name(k): v.strip() for k, v in zip(rows[0], rows[1], strict=False)} if len(rows) > 1 else {}
    out = {"hospital_name": pairs.get("hospital_name"), "file_version": pairs.get("version"), "last_updated_on": pairs.get("last_updated_on"), "location_name": pairs.get("location_name") or pairs.get("hospital_location"), "type_2_npi": ";".join(re.findall(r"(?<!\d)\d{10}(?!\d)", pairs.get("type_2_npi", ""))) or None}
    for k, v in pairs.items():
        if m := re.fullmatch(r"license_number\|([a-z]{2})", k):
            out |= {"license_number": v or None, "license_state": m[1].upper()}
    return {k: v or None for k, v in out.items()}


def prefix_metadata(data: bytes) -> dict[str, str | None]:
    """metadata() from the first bytes of a CSV or JSON file, plain or in a gzip or zip stream that breaks off."""
    text = files.decoded(files.inflated(data, PREFIX_BYTES))
    if files.content(text[:512].encode()) != "json":
        lines = text.splitlines()
        return metadata(lines[: min(2, find_header(lines[:-1] or lines) or 2)])
    quoted = r'"(?:[^"\\]|\\.)*"'

    def values(key: str) -> list[str]:
        """The strings of a key or of its list."""
        m = re.search(rf'"{key}"\s*:\s*(?:{quoted}|\[[^\[\]{{}}]*\])', text)
        return [json.loads(x, strict=False) for x in re.findall(quoted, m[0][m[0].index(":") :])] if m else []

    out = {k: next(iter(values(n)), None) for k, n in {"hospital_name": "hospital_name", "file_version": "version", "last_updated_on": "last_updated_on", "license_number": "license_number", "license_state": "state"}.items()}
    out |= {"location_name": "|".join(values("location_name") or values("hospital_location")), "type_2_npi": ";".join(values("type_2_npi"))}
    return {k: v or None for k, v in out.items()}


def probed(prefixes: DataFrame) -> DataFrame:
    """url and the metadata columns of each file's first bytes. prefixes: url, content (binary)."""
    names = ("hospital_name", "file_version", "last_updated_on", "location_name", "type_2_npi", "license_number", "license_state")

    def run(batches):
        for b in batches:
            found = [prefix_metadata(bytes(x or b"")) for x in b["content"]]
            yield pd.DataFrame({"url": b["url"]} | {n: [f.get(n) for f in found] for n in names})

    return prefixes.select("url", "content").mapInPandas(run, "url string, " + ", ".join(f"{n} string" for n in names))


def matched(df: DataFrame, codebook: DataFrame, code: str = "code", kind: str = "type") -> DataFrame:
    """Rows whose code, read as each family's, is a target of that family and whose type fits. codebook: concept, code, code_family (a small table)."""
    families = F.explode(F.array(*(F.lit(f) for f in tx.CODE_TYPES))).alias("code_family")
    every = df.select("*", families).withColumn("__code", tx.normal_code(F.col(code), F.col("code_family"))).withColumn("__fit", tx.code_type_fit(F.col(kind), F.col("code_family")))
    book = codebook.select("concept", "code_family", tx.normal_code(F.col("code"), F.col("code_family")).alias("__code"))
    hits = every.where("__fit <> 'incompatible'").join(F.broadcast(book), ["code_family", "__code"])
    return hits.drop(code).withColumnRenamed("__code", "code").withColumn("code_type", tx.code_type(F.col(kind))).withColumn("type_verified", F.col("__fit") == "verified").withColumnRenamed("code_family", "code_system").drop("__fit")


def prefilter(columns: Sequence[str], codebook: Sequence[tuple[str, str]]) -> Column:
    """Lines on which any column may hold a target; codebook: (family, code)."""
    out = F.lit(False)
    for family in {f for f, _ in codebook}:
        codes = [c for f, c in codebook if f == family]
        for c in columns:
            out = out | tx.normal_code(F.col(f"`{c}`"), F.lit(family)).isin(codes)
    return out


#: From a charge file's columns to the contract's. Fixed names.
LINE_FIELDS = {"description": "description", "modifiers": "modifiers", "setting": "setting", "billing_class": "billing_class", "gross": "standard_charge|gross", "discounted_cash": "standard_charge|discounted_cash", "min": "standard_charge|min", "max": "standard_charge|max", "generic_notes": "additional_generic_notes"}


def _finished(df: DataFrame, meta: dict[str, str | None], url: str, file_id: str, retrieved: str, source: str = "own_crawl") -> DataFrame:
    money = {c: nu.money(F.col(c)) for c in ("gross", "discounted_cash", "min", "max", "negotiated_dollar", "negotiated_percentage", "estimated_amount", "median_amount", "p10", "p90") if c in df.columns}
    own = {"source": source, "mrf_url": url, "mrf_file_id": file_id, "retrieved_at": retrieved} | meta
    out = df.withColumns(money | {k: F.lit(v).cast("string") for k, v in own.items()})
    return sc.conform(out.withColumn("last_updated_on", nu.mrf_date(F.col("last_updated_on"))))


def _charge_lines(spark: SparkSession, path: str, encoding: str, head_lines: int) -> tuple[list[str], int, list[str], DataFrame]:
    """First lines, the number of the header's, its names, and the records of the file as c0, c1, … with what is wrong with them (reject) and their cells.

    UTF-8 files are read by many tasks, other encodings one file a task.
    """
    head = [(r.value or "").rstrip("\r") for r in spark.read.option("encoding", encoding).option("lineSep", "\n").text(path).limit(head_lines).collect()]
    at = find_header(head)
    if at is None:
        raise ValueError(f"no charge header in the first {head_lines} lines")
    names = [header_name(c) for c in next(csv.reader([head[at]]))]
    n = len(names)
    if encoding.upper().replace("_", "-") == "UTF-8":
        rows = records.records(spark, path).where(F.size("cells") > 0)
    else:
        raw = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(n + 1)])
        rows = spark.read.csv(path, schema=raw, header=False, multiLine=True, encoding=encoding, quote='"', escape='"', mode="PERMISSIVE", unescapedQuoteHandling="STOP_AT_CLOSING_QUOTE", maxCharsPerColumn=-1, maxColumns=max(20480, 2 * n))
        rows = rows.select(F.array(*raw.names).alias("cells"), F.lit(0).cast("long").alias("stray"), F.lit(None).cast("string").alias("reject"))
    beyond = F.exists(F.slice("cells", n + 1, F.greatest(F.size("cells") - n, F.lit(1))), lambda c: tx.blank_to_null(c).isNotNull())
    rows = rows.withColumn("reject", F.coalesce("reject", F.when(beyond, "too many cells")))
    return head, at, names, rows.select(*(F.get("cells", i).alias(f"c{i}") for i in range(n)), "reject", "cells", "stray")


def csv_rejects(spark: SparkSession, path: str, encoding: str = "UTF-8", head_lines: int = 60) -> DataFrame:
    """cells and reject of the records that read_csv leaves out: text beyond the header's columns (as an unquoted comma gives), a quote that nothing closes, a stray carriage return."""
    rows = _charge_lines(spark, path, encoding, head_lines)[3]
    return rows.where("reject is not null").select("cells", "reject")


def csv_repairs(spark: SparkSession, path: str) -> DataFrame:
    """path, block, stray: how many bytes of each split aren't UTF-8 and are read as Windows-1252."""
    return records.records(spark, path).groupBy("path", "block").agg(F.sum("stray").alias("stray"))


def read_csv(spark: SparkSession, path: str, codebook: DataFrame, url: str = "", file_id: str = "", retrieved: str = "", encoding: str = "UTF-8", head_lines: int = 60) -> DataFrame:
    """Price rows of a tall or wide CSV file: one for each line, target code and payer; of a line's slots with one code the verified, then the lowest counts. Short lines are filled with nulls; csv_rejects gives the lines that are left out."""
    head, at, names, rows = _charge_lines(spark, path, encoding, head_lines)
    kind = layout(names)
    if kind == "unknown":
        raise ValueError("neither a tall nor a wide charge table")
    rows = rows.where("reject is null").drop("reject", "cells", "stray")
    slots = [(i, names.index(f"{n}|type")) for i, n in enumerate(names) if re.fullmatch(r"code\|\d+", n) and f"{n}|type" in names]
    rows = rows.where(F.coalesce(*(tx.blank_to_null(F.col(f"c{i}")) for i, _ in slots)).isNotNull()).where(~F.lower(F.col(f"c{slots[0][0]}")).eqNullSafe("code|1"))
    # renamed by position, so that repeated or odd names don't matter
    unique = sc.public_names(names) if len(set(names)) < len(names) else names
    rows = rows.toDF(*unique).withColumn("__line", F.monotonically_increasing_id())
    field = lambda n: tx.blank_to_null(F.col(f"`{n}`")) if n in unique else F.lit(None).cast("string")
    lines = rows.select("*", *(field(n).alias(f"__{k}") for k, n in LINE_FIELDS.items()))
    keep = ["__line", *(f"__{k}" for k in LINE_FIELDS)]
    codes = rs.code_slots(rows, [(F.col(f"`{unique[i]}`"), F.col(f"`{unique[j]}`")) for i, j in slots], ["__line"])
    hits = first_rows(matched(codes, codebook), ["__line", "code_system", "code"], [F.desc("type_verified"), F.col("slot")])
    hits = hits.select("__line", "concept", "code", "code_system", "code_type", "type_verified")
    if kind == "wide":
        rates = rs.wide_rates(lines, keep)
    else:
        named = {m: f"standard_charge|{m}" if m in ("negotiated_dollar", "negotiated_percentage", "negotiated_algorithm", "methodology") else m for m in rs.WIDE_METRICS}
        rates = lines.select(*keep, field("payer_name").alias("payer_name"), field("plan_name").alias("plan_name"), *(field(n).alias(m) for m, n in named.items()))
    rates = rates.withColumnsRenamed({f"__{k}": k for k in LINE_FIELDS} | {"10th_percentile": "p10", "90th_percentile": "p90"})
    rates = rates.withColumn("notes", tx.notes(F.col("additional_payer_notes"), F.col("generic_notes")))
    return _finished(rates.join(hits, "__line"), metadata(head[: min(2, at)]), url, file_id, retrieved)


_CODES = "array<struct<code:string,type:string>>"
_PAYERS = "array<struct<payer_name:string,plan_name:string,standard_charge_dollar:string,standard_charge_percentage:string,standard_charge_algorithm:string,methodology:string,estimated_amount:string,median_amount:string,`10th_percentile`:string,`90th_percentile`:string,count:string,additional_payer_notes:string>>"
_CHARGES = f"array<struct<setting:string,billing_class:string,gross_charge:string,discounted_cash:string,minimum:string,maximum:string,modifiers:array<string>,modifier_code:array<string>,additional_generic_notes:string,payers_information:{_PAYERS}>>"
#: Schemas of a JSON price file's items and of the rest of it; all leaves are text.
JSON_ITEM = f"description string, code_information {_CODES}, standard_charges {_CHARGES}"
JSON_SHELL = "hospital_name string, last_updated_on string, version string, location_name array<string>, hospital_location array<string>, hospital_address array<string>, license_information struct<license_number:string,state:string>, type_2_npi array<string>"


def read_json(spark: SparkSession, path: str, codebook: DataFrame, url: str = "", file_id: str = "", retrieved: str = "") -> DataFrame:
    """Price rows of a JSON file of any size: codes, charges and payers exploded, an absent array as one empty entry."""
    c = F.col
    listed, documents = pieces.items(spark, path, JSON_ITEM, JSON_SHELL)
    items = listed.select(c("path").alias("__doc"), c("item_id").alias("__item"), "i")
    about = documents.select(
        c("path").alias("__doc"), "doc.hospital_name", c("doc.version").alias("file_version"), "doc.last_updated_on",
        F.array_join(F.coalesce("doc.location_name", "doc.hospital_location"), "|").alias("location_name"),
        c("doc.license_information.license_number").alias("license_number"), c("doc.license_information.state").alias("license_state"),
        F.array_join("doc.type_2_npi", ";").alias("type_2_npi"),
    )
    meta = ["hospital_name", "file_version", "last_updated_on", "location_name", "license_number", "license_state", "type_2_npi"]
    # targets of an item first: of its entries with one code the verified, then the first counts; only items with targets go on, and each of their charges and payers is a row, equal ones too
    coded = items.select("*", F.posexplode("i.code_information").alias("__slot", "__c")).select("*", c("__c.code").alias("code"), c("__c.type").alias("type"))
    hits = first_rows(matched(coded, codebook), ["__doc", "__item", "code_system", "code"], [F.desc("type_verified"), c("__slot")])
    hits = hits.join(F.broadcast(about), "__doc", "left")  # one short row a file
    target = ["concept", "code", "code_system", "code_type", "type_verified"]
    lines = hits.select(*meta, *target, c("i.description").alias("description"), F.explode_outer("i.standard_charges").alias("s"))
    rates = lines.select(*meta, *target, "description", c("s.setting"), c("s.billing_class"), c("s.gross_charge").alias("gross"), c("s.discounted_cash"), c("s.minimum").alias("min"), c("s.maximum").alias("max"), F.array_join(F.coalesce("s.modifiers", "s.modifier_code"), "|").alias("modifiers"), c("s.additional_generic_notes").alias("generic_notes"), F.explode_outer("s.payers_information").alias("p"))
    first = rates.select("*", c("p.payer_name"), c("p.plan_name"), c("p.standard_charge_dollar").alias("negotiated_dollar"), c("p.standard_charge_percentage").alias("negotiated_percentage"), c("p.standard_charge_algorithm").alias("negotiated_algorithm"), c("p.methodology"), c("p.estimated_amount"), c("p.median_amount"), c("p.10th_percentile").alias("p10"), c("p.90th_percentile").alias("p90"), c("p.count"), tx.notes(c("p.additional_payer_notes"), c("generic_notes")).alias("notes")).drop("p")
    money = {x: nu.money(c(x)) for x in ("gross", "discounted_cash", "min", "max", "negotiated_dollar", "negotiated_percentage", "estimated_amount", "median_amount", "p10", "p90")}
    own = {"source": "own_crawl", "mrf_url": url, "mrf_file_id": file_id, "retrieved_at": retrieved}
    out = first.withColumns(money | {k: F.lit(v) for k, v in own.items()}).withColumn("last_updated_on", nu.mrf_date(c("last_updated_on")))
    return sc.conform(out)


def stage_lake(details: DataFrame, hospitals: DataFrame, codebook: Sequence[tuple[str, str]], code_columns: Sequence[str], hospital_key: str = "hospital_id") -> DataFrame:
    """Lines with a target, each file's once: of the facilities that share a file the first by key represents it."""
    content = F.coalesce("content_hash", "md5", "mrf_url", F.concat(F.lit("hospital:"), F.col(hospital_key).cast("string")))
    facility = hospitals.withColumns({c: F.lit(None).cast("string") for c in ("content_hash", "md5", "mrf_url") if c not in hospitals.columns}).withColumn("mrf_file_id", content)
    chosen = facility.groupBy("mrf_file_id").agg(F.min(hospital_key).alias(hospital_key))
    return details.join(chosen, hospital_key).where(prefilter(code_columns, codebook))
