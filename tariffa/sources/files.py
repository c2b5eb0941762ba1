"""Bytes of published files: what they are, how they are encoded, how they unpack."""

from __future__ import annotations

import gzip
import io
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes looked at for the encoding, and the share of NULs at odd or even places that tells UTF-16.
SNIFFED, NUL_SHARE = 4096, 0.4


def compression(data: bytes) -> str:
    return "gzip" if data[:2] == b"\x1f\x8b" else "zip" if data[:4] in (b"PK\x03\x04", b"PK\x05\x06") else "none"


def content(data: bytes) -> str:
    """json, html, csv or empty, from the first bytes."""
    head = data.lstrip(b"\xef\xbb\xbf\xff\xfe \t\r\n\x00")[:512].lower()
    if not head:
        return "empty"
    if head[:1] in (b"{", b"["):
        return "json"
    return "html" if head.startswith((b"<!doctype html", b"<html", b"<head", b"<?xml")) or b"<html" in head else "csv"


def encoding(data: bytes) -> str:
    """utf-16-le, utf-16-be, utf-8 or cp1252 (UTF-8 with stray bytes)."""
    if data[:2] == b"\xff\xfe":
        return "utf-16-le"
    if data[:2] == b"\xfe\xff":
        return "utf-16-be"
    head = data[:SNIFFED]
    if len(head) >= 4:
        odd, even = head[1::2].count(0) / (len(head) // 2), head[::2].count(0) / ((len(head) + 1) // 2)
        if max(odd, even) > NUL_SHARE:
            return "utf-16-le" if odd > even else "utf-16-be"
    try:
        data.decode("utf-8")
    except UnicodeDecodeError as e:
        return "utf-8" if e.reason == "unexpected end of data" and e.start >= len(data) - 3 else "cp1252"
    return "utf-8"


def decoded(data: bytes) -> str:
    """Text with its marks of byte order off; in UTF-8 with stray bytes only these are read as Windows-1252."""
    kind = encoding(data)
    if kind.startswith("utf-16"):
        return data.decode(kind, "replace").lstrip("﻿")
    out, at = [], 0
    while True:
        try:
            out.append(data[at:].decode("utf-8"))
            return "".join(out).lstrip("﻿")
        except UnicodeDecodeError as e:
            out += [data[at : at + e.start].decode("utf-8"), data[at + e.start : at + e.start + 1].decode("cp1252", "replace")]
            at += e.start + 1


def inflated(data: bytes, most: int | None = None) -> bytes:
    """The start of a gzip stream or of a zip's first entry, which may be cut off."""
    kind = compression(data)
    if kind == "none":
        return data[:most]
    if kind == "zip":
        name, extra = (int.from_bytes(data[i : i + 2], "little") for i in (26, 28))
        body, stored = data[30 + name + extra :], data[8:10] == b"\0\0"
        if stored:
            return body[:most]
        return zlib.decompressobj(-15).decompress(body, most or 0)
    return zlib.decompressobj(31).decompress(data, most or 0)


def unpacked(data: bytes) -> Iterator[tuple[str, bytes]]:
    """(name, bytes) of the wanted entries of an archive, data files first; the file itself if it is none."""
    kind = compression(data)
    if kind == "gzip":
        yield "", gzip.decompress(data)
    elif kind == "zip":
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            names = [n for n in z.namelist() if not n.startswith("__MACOSX") and not n.endswith("/")]
            wanted = [n for n in names if n.lower().endswith((".csv", ".json", ".txt"))] or names
            for n in wanted:
                yield n, z.read(n)
    else:
        yield "", data


def texts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path, entry, kind, encoding, text of each file or archive entry; one file a row, unpacked by the workers."""
    raw = spark.read.format("binaryFile").load(paths).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, data in zip(batch["path"], batch["content"], strict=True):
                for name, part in unpacked(bytes(data)):
                    yield pd.DataFrame({"path": [path], "entry": [name], "kind": [content(part)], "encoding": [encoding(part)], "text": [decoded(part)]})

    return raw.mapInPandas(run, "path string, entry string, kind string, encoding string, text string")


def with_hash(df: DataFrame, column: str = "content", out: str = "mrf_file_id") -> DataFrame:
    return df.withColumn(out, F.sha2(F.col(column), 256))
