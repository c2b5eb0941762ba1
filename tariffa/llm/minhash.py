"""N-gram Jaccard join by MinHash banding.

Documents with equal texts form a class, whose least doc_id stands for it. Each text's set of five-word shingles gets
MinHash values in bands, as many as the target recall asks for at the threshold. Representatives meet in the buckets of
their band hashes. A pair counts in the first band that it shares only, so that nothing is kept for the others: first
narrow rows of band hashes and one-byte MinHash values tell who has a likely partner in a bucket, then these documents
alone bring their full shingle sets there and every pair is verified exactly. A bucket of many or large sets is dealt
into tiles of two blocks each, so no task holds it as a whole; tiles give link counts and a spanning forest, never
lists of pairs.

Words are lower case, split at ASCII white space (in scripts without it a text is few long words, and only equal ones agree); a text of fewer than five words is one shingle, one without words has no
links. A null text counts as empty. Rows with a null doc_id take no part; rows that repeat a doc_id and text count as
one copy each, and of one doc_id with several texts each text is classed by itself. An empty table gives an empty
result; other columns are not looked at, or kept as they are by `one_of_each_group`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffa.llm.common import HASHED_BYTES, checkpointed, marked, mix, shingle_hashes, slices, spread, table, text_col, told, trimmed, word_hashes
from tariffa.llm.components import components

WIDTH, THRESHOLD, RECALL, ROWS = 5, 0.8, 0.9999, 5
#: Documents and bytes of shingle hashes of a block; a tile holds two blocks.
BLOCK_DOCS, BLOCK_BYTES = 384, 16_000_000
#: Deviations that the MinHash estimate of a linked pair may lie below the threshold.
SIGMAS = 5.0


def bands_for(threshold: float, recall: float, rows: int) -> int:
    """Bands with which a pair at the threshold shares one with the probability `recall`."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


class Hashing:
    def __init__(self, threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS, width: int = WIDTH):
        self.threshold, self.rows, self.width = threshold, rows, width
        self.bands = bands_for(threshold, recall, rows)
        rng = np.random.Generator(np.random.PCG64(11))
        self.factors = rng.integers(0, 1 << 63, self.bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
        n = self.bands * rows
        self.likely = max(0.0, threshold - SIGMAS * math.sqrt(threshold * (1 - threshold) / n))

    def shingles(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return shingle_hashes(*word_hashes(texts), self.width)

    def signatures(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shingles, band hashes and one-byte MinHash values of each text; those of a text without words mean nothing."""
        hashes, offsets = self.shingles(texts)
        counts = np.diff(offsets)
        full = np.flatnonzero(counts)
        least = np.zeros((len(counts), len(self.factors)), np.uint64)
        if len(full):
            starts = offsets[full]
            for k, f in enumerate(self.factors):
                least[full, k] = np.minimum.reduceat(hashes * f, starts)
        least = mix(least)
        bands = np.full((len(counts), self.bands), np.uint64(1)) * np.arange(1, self.bands + 1, dtype=np.uint64)
        for r in range(self.rows):
            bands = mix(bands * np.uint64(0x9E3779B97F4A7C15) + least[:, r :: self.rows])
        return counts, bands, (least & np.uint64(255)).astype(np.uint8)


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _signed(docs: DataFrame, hashing: Hashing, doc_id: str, text: str) -> DataFrame:
    """doc_id, digest of the text, shingles, band hashes, one-byte MinHash values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=HASHED_BYTES):
                counts, bands, sketch = hashing.signatures(part.column("text"))
                digests = [hashlib.md5(t.encode("utf-8", "surrogatepass")).digest() for t in part.column("text").to_pylist()]
                cols = [part.column("doc_id"), pa.array(digests, pa.binary()), pa.array(counts.astype(np.int64)), _binary(bands), _binary(sketch)]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "digest", "shingles", "bands", "sketch"])

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_col(text).alias("text")).where("doc_id is not null")
    return spread(given).mapInArrow(trimmed(run), "doc_id long, digest binary, shingles long, bands binary, sketch binary")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows with equal keys, from sorted rows; only one run is held."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        cuts = np.flatnonzero(np.any([v[1:] != v[:-1] for v in values], axis=0)) + 1 if batch.num_rows > 1 else []
        edges = [0, *cuts, batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            key = tuple(v[a] for v in values)
            if key != last and held:
                yield last, pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield last, pa.Table.from_batches(held)


def _matrix(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def _candidates(bands: np.ndarray, sketch: np.ndarray, band: int, sides: np.ndarray | None, likely: float) -> np.ndarray:
    """Pairs (upper triangle) whose first common band this is and whose estimated similarity is high enough."""
    m = len(bands)
    if m == 2:
        pair = (sides is None or sides[0] != sides[1]) and not (bands[0, :band] == bands[1, :band]).any() and (sketch[0] == sketch[1]).mean() >= likely
        return np.array([[False, pair], [False, False]])
    good = np.triu(np.ones((m, m), bool), 1)
    if sides is not None:
        good &= sides[:, None] != sides[None, :]
    for i in range(band):
        good &= bands[:, i][:, None] != bands[:, i][None, :]
    if good.any():
        same = np.zeros((m, m), np.int32)
        for k in range(sketch.shape[1]):
            same += sketch[:, k][:, None] == sketch[:, k][None, :]
        good &= same >= likely * sketch.shape[1]
    return good


def _linked(sets: list[np.ndarray], good: np.ndarray, threshold: float) -> np.ndarray:
    """The pairs among `good` whose sets are similar enough, exactly."""
    pairs = np.argwhere(good)
    sizes = np.array([len(s) for s in sets])
    if len(pairs) < 4 * len(sets):
        common = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in pairs])
    else:
        values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = np.cumsum(count > 1) - 1  # columns of the values that two sets hold
        row = np.repeat(np.arange(len(sets)), sizes)
        keep = count[column] > 1
        row, column = row[keep], shared[column[keep]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        table = np.zeros((len(sets), len(sets)), np.float32)
        for first in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            a, b = np.searchsorted(column, [first, first + 4096])
            block = np.zeros((len(sets), 4096), np.float32)
            block[row[a:b], column[a:b] - first] = 1
            table += block @ block.T
        common = table[pairs[:, 0], pairs[:, 1]].astype(np.int64)
    union = sizes[pairs[:, 0]] + sizes[pairs[:, 1]] - common
    return pairs[common >= threshold * union - 1e-9]


def _roots(m: int, pairs: np.ndarray) -> np.ndarray:
    """Least member of each member's component."""
    root = np.arange(m)
    while True:
        least = root.copy()
        np.minimum.at(least, pairs[:, 0], root[pairs[:, 1]])
        np.minimum.at(least, pairs[:, 1], root[pairs[:, 0]])
        least = least[least]
        if (least == root).all():
            return root
        root = least


def _tiles(rows: DataFrame) -> DataFrame:
    """Bucket rows dealt into tiles (lo, hi) of two blocks; blocks: of the bucket. side: the block of the row."""
    side = F.pmod(F.xxhash64("rep", "h"), F.col("blocks")).alias("side")
    dealt = rows.select("*", side).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return dealt.withColumn("lo", F.least("side", "other")).withColumn("hi", F.greatest("side", "other")).drop("other", "blocks")


def _sorted(rows: DataFrame) -> DataFrame:
    keys = ["h", "lo", "hi"]
    return rows.repartition(*keys).sortWithinPartitions(*keys, "rep")


def joined(docs: DataFrame, hashing: Hashing | None = None, doc_id: str = "doc_id", text: str = "text", block_docs: int = BLOCK_DOCS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each document: doc_id, digest, class_id, n_copies (rows of the class), group_id (least class of its component), n_links (other texts at the threshold or above)."""
    hashing = hashing or Hashing()
    likely, threshold = hashing.likely, hashing.threshold
    signed = checkpointed(_signed(docs, hashing, doc_id, text))
    classes = signed.groupBy("digest").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n_copies"))
    # of one text the row of its least doc_id; one doc_id may stand for several texts, so a representative has a number of its own, fixed by the checkpoint
    rep = F.monotonically_increasing_id().alias("rep")
    reps = signed.where("shingles > 0").join(classes.select("digest", F.col("class_id").alias("doc_id")), ["digest", "doc_id"]).dropDuplicates(["digest"])
    reps = checkpointed(reps.select(rep, "digest", "doc_id", "shingles", "bands", "sketch"))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                h = _matrix(pa.chunked_array([batch.column("bands")]), np.int64)
                n = h.shape[1]
                at = pa.array(np.repeat(np.arange(len(h)), n))
                yield pa.RecordBatch.from_arrays([pa.array(h.reshape(-1)), pa.array(np.tile(np.arange(n), len(h))), batch.column("rep").take(at), batch.column("shingles").take(at)], ["h", "band", "rep", "shingles"])

    rows = reps.select("rep", "shingles", "bands").mapInArrow(trimmed(explode), "h long, band long, rep long, shingles long")
    blocks = F.greatest(F.lit(1), F.ceil(F.count("*") / block_docs), F.ceil(F.sum("shingles") * 8 / block_bytes)).cast("long")
    buckets = rows.groupBy("h").agg(F.count("*").alias("n"), blocks.alias("blocks")).where("n > 1").drop("n")
    met = _tiles(rows.join(buckets, "h").select("h", "band", "rep", "blocks").join(reps.select("rep", "bands", "sketch"), "rep"))

    def likely_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (h, lo, hi), t in _groups(batches, ["h", "lo", "hi"]):
            if t.num_rows > 1:
                sides = t.column("side").to_numpy() if lo != hi else None
                good = _candidates(_matrix(t.column("bands"), np.uint64), _matrix(t.column("sketch"), np.uint8), t.column("band")[0].as_py(), sides, likely)
                need = np.flatnonzero(good.any(0) | good.any(1))
                ids, side = t.column("rep").to_numpy(), t.column("side").to_numpy()
                out += [(h, t.column("band")[0].as_py(), lo, hi, side[i], ids[i]) for i in need]
            if len(out) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["h", "band", "lo", "hi", "side", "rep"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["h", "band", "lo", "hi", "side", "rep"])

    needed = checkpointed(_sorted(met).mapInArrow(trimmed(likely_ones), "h long, band long, lo long, hi long, side long, rep long"))

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=HASHED_BYTES):
                hashes, offsets = hashing.shingles(part.column("text"))
                sets = [np.unique(hashes[a:b]).tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("rep"), pa.array(sets, pa.binary())], ["rep", "set"])

    wanted = checkpointed(reps.join(needed.select("rep").distinct(), "rep", "left_semi").select("rep", "doc_id", "digest", "bands"))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_col(text).alias("text"))
    # texts that nobody wants aren't shuffled; the digest tells which text of a doc_id that has several
    texts = marked(texts.where("doc_id is not null"), wanted, "doc_id").where("__marked").drop("__marked")
    named = texts.join(wanted, "doc_id").where(F.unhex(F.md5("text")) == F.col("digest"))
    sets = named.select("rep", "text").mapInArrow(trimmed(shingled), "rep long, set binary").dropDuplicates(["rep"])
    full = needed.join(sets, "rep").join(wanted.select("rep", "bands"), "rep")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, lo, hi), t in _groups(batches, ["h", "lo", "hi"]):
            if t.num_rows < 2:
                continue
            band, sides = t.column("band")[0].as_py(), t.column("side").to_numpy() if lo != hi else None
            bands = _matrix(t.column("bands"), np.uint64)
            good = _candidates(bands, np.zeros((len(bands), 1), np.uint8), band, sides, 0)
            pairs = _linked([np.frombuffer(s, np.uint64) for s in t.column("set").to_pylist()], good, threshold)
            if len(pairs):
                links = np.bincount(pairs.reshape(-1), minlength=len(bands))
                ids, root, on = t.column("rep").to_numpy(), _roots(len(bands), pairs), links > 0
                yield pa.RecordBatch.from_arrays([pa.array(ids[on]), pa.array(links[on]), pa.array(ids[root][on])], ["rep", "links", "root"])

    linked = checkpointed(_sorted(full).mapInArrow(trimmed(verified), "rep long, links long, root long"))
    counts = linked.groupBy("rep").agg(F.sum("links").alias("n_links"))
    roots = components(linked.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    # components are named by the least class in them
    grouped = counts.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep")).join(reps.select("rep", "digest", "doc_id"), "rep")
    least = grouped.groupBy("root").agg(F.min(F.struct("doc_id", "digest")).alias("head"))
    grouped = grouped.join(least, "root").select("digest", "n_links", "head")
    # one row a text; copies of very common ones meet in no task
    out = told(signed.select("doc_id", "digest"), checkpointed(classes.join(grouped, "digest", "left")), "digest", "n_copies")
    head = F.coalesce("head", F.struct(F.col("class_id").alias("doc_id"), "digest"))
    return out.select("doc_id", "digest", "class_id", "n_copies", head["doc_id"].alias("group_id"), head["digest"].alias("group_digest"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each_group(docs: DataFrame, hashing: Hashing | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each group of linked texts the row with the least doc_id of the least class, with all columns; rows with a null doc_id stay."""
    result = joined(docs, hashing, doc_id, text)
    head = (F.col("doc_id") == F.col("group_id")) & (F.col("digest") == F.col("group_digest"))
    keys = checkpointed(result.groupBy(F.col("doc_id").alias("__id"), F.hex("digest").alias("__digest")).agg(F.count("*").alias("n"), F.max(head).alias("head")))
    rows = docs.where(F.col(doc_id).isNotNull()).withColumns({"__id": F.col(doc_id).cast("long"), "__digest": F.upper(F.md5(text_col(text)))})
    every = [F.col(f"`{c}`") for c in docs.columns]
    # a head that stands in one row stays as it is read; the marked rows, others and few of these, are held against the heads
    rows = marked(rows, keys.where("n > 1 or not head"), "__id", "__digest")
    doubtful = rows.where("__marked").join(keys.where("head").select("__id", "__digest"), ["__id", "__digest"])
    # rows that repeat both differ in other columns at the most: the least by hash stays
    kept = doubtful.groupBy("__id", "__digest").agg(F.min_by(F.struct(*every), F.xxhash64(*every)).alias("__row")).select("__row.*")
    return rows.where("not __marked").select(*every).unionByName(kept).unionByName(docs.where(F.col(doc_id).isNull()))


def op5_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_copies", "group_id", "n_links")
