"""Large JSON documents in parts: each object of a top-level list is a row, whatever the size of the file.

The text source cuts a file at closing braces, so its splits are read by different tasks. A first scan finds what each
split does to the open brackets, once for a split that begins within a string and once for one that doesn't; chained,
these give each split's true start. A second scan cuts the items out. Only items that lie on a border of splits and the
text around all items (names, licence, places) are put together by key; no task holds more than a batch and one item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffa.sources.files import decoded

#: What is open within an item of a document, and of a document that is the one entry of a list.
ITEM, LISTED_ITEM = "{[{", "[{[{"


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "}").text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    """Neighbouring pieces of one split, with the braces that the source took from their ends."""
    for batch in batches:
        if not batch.num_rows:
            continue
        path, block = batch.column("path"), batch.column("block").to_numpy()
        file = path.dictionary_encode().indices.to_numpy()
        edges = [0, *(np.flatnonzero((np.diff(block) != 0) | (np.diff(file) != 0)) + 1).tolist(), batch.num_rows]
        # bytes, as stray ones may not be UTF-8
        values = batch.column("value").cast(pa.binary()).to_pylist()
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield path[a].as_py(), int(block[a]), b"}".join([*values[a:b], b""])


def _brackets(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Places and bytes of all brackets, whether an odd number of quotes stands before each, and the parity of all quotes."""
    a = np.frombuffer(data.replace(b"\\\\", b"__").replace(b'\\"', b"__"), np.uint8)
    odd = np.logical_xor.accumulate(a == ord('"'))
    kind = a | 0x20  # square brackets become braces
    at = np.flatnonzero((kind == ord("{")) | (kind == ord("}")))
    return at, a[at], odd[at], int(odd[-1]) if len(odd) else 0


def _steps(brackets: np.ndarray) -> np.ndarray:
    return np.where(brackets | 0x20 == ord("{"), 1, -1)


def _reduced(brackets: np.ndarray) -> tuple[int, str]:
    """Brackets closed that were open before, and those left open."""
    if not len(brackets):
        return 0, ""
    step = _steps(brackets)
    depth = np.cumsum(step)
    low = min(0, int(depth.min()))
    left = [chr(brackets[np.flatnonzero((depth == d) & (step > 0))[-1]]) for d in range(low + 1, int(depth[-1]) + 1)]
    return -low, "".join(left)


def _then(first: tuple[int, str], second: tuple[int, str]) -> tuple[int, str]:
    (closed, left), (more, new) = first, second
    return (closed, left[: len(left) - more] + new) if more <= len(left) else (closed + more - len(left), new)


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each split, if it begins outside (0) or within (1) a string: where it ends, what it closes and leaves open."""

    def row(key, state):
        return {"path": key[0], "block": key[1], "effects": [{"quoted": q, "closed": w[0], "left": w[1]} for q, w in state]}

    schema = pa.schema([("path", pa.string()), ("block", pa.int64()), ("effects", pa.list_(pa.struct([("quoted", pa.int64()), ("closed", pa.int64()), ("left", pa.string())])))])
    key, state = None, []
    for path, block, data in _stretches(batches):
        if key != (path, block):
            if key:
                yield pa.RecordBatch.from_pylist([row(key, state)], schema)
            key, state = (path, block), [(0, (0, "")), (1, (0, ""))]
        _, brackets, odd, parity = _brackets(data)
        state = [(q ^ parity, _then(w, _reduced(brackets[odd == bool(q)]))) for q, w in state]
    if key:
        yield pa.RecordBatch.from_pylist([row(key, state)], schema)


def _starts(pieces: DataFrame) -> dict[tuple[str, int], tuple[str, int, int]]:
    """By split: open brackets, whether within a string, and the split in which an open item began. A row for each split reaches the driver."""
    found = pieces.mapInArrow(_effects, "path string, block long, effects array<struct<quoted:long,closed:long,left:string>>").collect()
    out, last = {}, None
    for r in sorted(found, key=lambda r: (r.path, r.block)):
        if r.path != last:
            last, stack, quoted, since = r.path, "", 0, r.block
        out[r.path, r.block] = (stack, quoted, since)
        e = r.effects[quoted]
        if e.closed >= len(stack) - len(_item(stack)) + 1:  # the item that was open ended
            since = r.block
        stack, quoted = _then((0, stack), (e.closed, e.left))[1], e.quoted
    return out


def _item(stack: str) -> str:
    return LISTED_ITEM if stack.startswith("[") else ITEM


def _cut(starts: dict[tuple[str, int], tuple[str, int, int]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """path, block, n, key, part: whole items (key null), parts of an item by the split it began in, and what surrounds items (key -1)."""
    schema = pa.schema([("path", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("key", pa.int64()), ("part", pa.string())])
    key: tuple[str, int] | None = None
    stack, quoted, since, n, held, around = "", 0, 0, 0, [], []

    def closed():
        parts = [(since, held)] if held else []
        return [(*key, n + i, k, decoded(b"".join(p))) for i, (k, p) in enumerate([*parts, (-1, around)])]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    for path, block, data in _stretches(batches):
        rows = []
        if key != (path, block):
            if key:
                rows += closed()
            key, n, held, around = (path, block), 0, [], []
            stack, quoted, since = starts[key]
            ended, border = not stack and block > 0, stack.startswith(_item(stack))
        if not ended:
            at, brackets, odd, parity = _brackets(data)
            real = odd == bool(quoted)
            at, brackets = at[real], brackets[real]
            step = _steps(brackets)
            depth = len(stack) + np.cumsum(step)
            deep, from_ = len(stack), 0
            for i in np.flatnonzero(depth <= len(LISTED_ITEM)).tolist():
                d, p = int(depth[i]), int(at[i])
                if step[i] > 0:
                    before, stack = stack, stack[: d - 1] + chr(brackets[i])
                    if stack == _item(stack):
                        if text := data[from_:p].strip(b", \t\r\n"):
                            around.append(data[from_:p])
                        from_, held, border = p, [], False
                elif d == len(_item(stack)) - 1 and stack.startswith(_item(stack)):
                    rows.append((path, block, n, since if border else None, decoded(b"".join([*held, data[from_ : p + 1]]))))
                    n, from_, held, border, stack = n + 1, p + 1, [], False, stack[:d]
                    since = block
                else:
                    stack = stack[: max(d, 0)]
                if d <= 0:
                    around.append(data[from_ : p + 1])
                    from_, ended = len(data), True
                    break
            rest = data[from_:]
            # below an item only the depth matters
            deep = int(depth[-1]) if len(depth) else deep
            stack = stack.ljust(deep, "{")[: max(deep, 0)]
            if stack.startswith(_item(stack)):
                if not held and not border:
                    since = block
                held.append(rest)
            elif rest.strip(b", \t\r\n") or quoted ^ parity:
                around.append(rest)
            quoted ^= parity
        if rows:
            yield batch_of(rows)
    if key:
        yield batch_of(closed())


def items(spark: SparkSession, path: str, item: str, shell: str) -> tuple[DataFrame, DataFrame]:
    """(path, item_id, i) of each object in a top-level list, and (path, doc) of each document without those objects.

    path: files of one UTF-8 document each, where stray bytes are read as Windows-1252. item, shell: schemas. Empty files
    give no rows; text after the document is left aside; fields of another type than the schema's are null.
    """
    pieces = _pieces(spark, path)
    starts = _starts(pieces)
    rows = pieces.mapInArrow(lambda batches: _cut(starts, batches), "path string, block long, n long, key long, part string")
    parsed = lambda c, schema: F.from_json(c, schema)
    item_id = F.struct("block", "n").alias("item_id")
    whole = rows.where("key is null").select("path", item_id, parsed(F.col("part"), item).alias("i"))
    # a few rows for each split
    parts = rows.where("key is not null").groupBy("path", "key").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "n", "part"))), lambda x: x["part"]), "").alias("text"))
    split = parts.where("key >= 0").select("path", F.struct(F.col("key").alias("block"), F.lit(-1).cast("long").alias("n")).alias("item_id"), parsed(F.col("text"), item).alias("i"))
    around = F.regexp_replace("text", r"^\s*\[|\]\s*$", "")
    return whole.unionByName(split), parts.where("key = -1").select("path", parsed(around, shell).alias("doc"))
