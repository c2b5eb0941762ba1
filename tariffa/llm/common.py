"""What the operators share: bounded Arrow slices, word hashes, lineage cuts."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffa.lineage import cut, shared_folder

#: Text bytes a Python worker handles at once; a longer single text forms a slice of its own.
SLICE_BYTES = 2_000_000
#: The same where every byte or letter is hashed, which takes some fifty bytes of memory each.
HASHED_BYTES = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded(spark: SparkSession) -> None:
    """Small Arrow batches keep Python workers' memory bounded."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > 1000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def checkpointed(df: DataFrame) -> DataFrame:
    """df cut from its lineage, in the shared folder."""
    return cut(df)


def stored(df: DataFrame) -> DataFrame:
    """df as Parquet in the shared folder, compressed, and so smaller than a checkpoint of many rows."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Keys that are treated as hot at the most, and rows below which none is.
HOT_KEYS, HOT_ROWS = 10_000, 1000


def told(rows: DataFrame, info: DataFrame, key: str, n: str) -> DataFrame:
    """rows with the columns of their key's row in info (inner). n: how many rows have the key; keys with a ten-thousandth of all rows or more, so ten thousand at the most, are broadcast, the others shuffled."""
    total = info.agg(F.sum(n)).first()[0] or 0
    limit = F.lit(max(HOT_ROWS, total / HOT_KEYS))
    hot, cold = info.where(F.col(n) >= limit), info.where(F.col(n) < limit)
    some = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return some.unionByName(rest.select(*some.columns))


#: Bits of a mark table in all and in one row of it; so it has 2,048 rows and 8 MB at the most, whatever it marks.
MARKS, ROW_MARKS = 1 << 26, 1 << 15


def marked(rows: DataFrame, keys: DataFrame, *names: str) -> DataFrame:
    """rows with __marked: true for each whose columns `names` (none null) are a row of keys, and for few others (one in MARKS / keys). A join with the marked rows alone spares the shuffle of the others."""
    place = F.pmod(F.xxhash64(*names), F.lit(MARKS))
    at, bit = F.floor(place / ROW_MARKS).cast("int"), F.pmod(place, F.lit(ROW_MARKS)).cast("int")
    marks = keys.select(at.alias("__at"), bit.alias("__bit")).groupBy("__at").agg(F.bitmap_construct_agg("__bit").alias("__marks"))
    byte = F.conv(F.hex(F.expr("substring(__marks, __bit div 8 + 1, 1)")), 16, 10).cast("int")
    own = F.expr("int(shiftleft(1, __bit % 8))").bitwiseAND(byte) != 0
    found = rows.withColumns({"__at": at, "__bit": bit}).join(F.broadcast(marks), "__at", "left")
    return found.withColumn("__marked", F.coalesce(own, F.lit(False))).drop("__at", "__bit", "__marks")


def spread(df: DataFrame, tasks: int = 0) -> DataFrame:
    """df in at least as many partitions as the cluster has cores, when its files give fewer."""
    bounded(df.sparkSession)
    n = max(tasks, df.sparkSession.sparkContext.defaultParallelism)
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)


def text_col(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows holding at most so many bytes in the column (one row at least)."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start, n = 0, batch.num_rows
    while start < n:
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + most, "right")))
        yield batch.slice(start, end - start)
        start = end


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, for mapInArrow. When its task ends, memory that it has freed goes back to the system: workers are reused, and the C library keeps what arrays of a few MB have touched."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with suppress(AttributeError, OSError, TypeError):  # glibc has it
                ctypes.CDLL(None).malloc_trim(0)

    return task


#: Odd, so that it has an inverse modulo 2 ** 64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 28, 29, 30, 31, 32])
_BYTES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, np.uint64)  # a value for each byte
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.ones(max(n, 1 << 16), np.uint64)
        known[1:] = np.uint64(base)
        _powers[base] = known = np.multiply.accumulate(known)
    return known[:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of a sequence, each from its values and their places in it, the same wherever it stands."""
    summed = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(_BASE, len(values)), out=summed[1:])
    return mix((summed[ends] - summed[starts]) * powers(_INVERSE, len(values) + 1)[starts] + (ends - starts).astype(np.uint64))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of the texts in a row (nulls empty), and the n + 1 offsets."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each word (split at ASCII white space), and the n + 1 offsets of the texts' words."""
    word = ~_SPACE[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    first[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of each text (lower case, split at white space, nulls empty), and the n + 1 offsets of the texts."""
    data, offsets = text_bytes(pc.utf8_lower(texts))
    starts, ends, words = word_spans(data, offsets)
    return span_hashes(_BYTES[data], starts, ends), words


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of `width` words, and offsets; a shorter text that has a word is one shingle of all its words."""
    n = len(hashes)
    if not n:
        return hashes, np.zeros_like(offsets)
    rolled = np.zeros(n, np.uint64)
    for j in range(width):
        rolled[: n - j] = mix(rolled[: n - j] * np.uint64(0x9E3779B97F4A7C15) + hashes[j:] + np.uint64(j + 1))
    lengths = np.diff(offsets)
    counts = np.where(lengths >= width, lengths - width + 1, np.minimum(lengths, 1))
    out = np.concatenate([[0], np.cumsum(counts)])
    rows = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(out[-1]) - out[rows] + offsets[rows]
    made = rolled[at]
    for i in np.flatnonzero((lengths > 0) & (lengths < width)):
        whole = np.uint64(0)
        for j, h in enumerate(hashes[offsets[i] : offsets[i + 1]]):
            whole = mix(np.array([whole], np.uint64) * np.uint64(0x9E3779B97F4A7C15) + h + np.uint64(j + 1))[0]
        made[out[i]] = mix(np.array([whole + np.uint64(lengths[i])], np.uint64))[0]
    return made, out
