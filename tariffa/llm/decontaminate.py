"""Benchmark decontamination by spaced seeds.

A document overlaps an item if, at some alignment, a window of 13 words has at most 3 substituted ones. An item of fewer
words is one window, with fewer substitutions in proportion: 2 of 9 to 12 words, 1 of 5 to 8, none of 1 to 4. Each mask hashes the words at its fixed places and ignores those between, at every
place of items and documents; equal hashes join, and every alignment that a hit gives is verified word by word. For
each choice of 3 places in 13 some mask misses them all, and of a short item cut into one block more than it may have
substitutions one block stays whole and is its seed, so no such overlap escapes. `item_words` tells the classes apart;
`clean_documents` leaves items of fewer than 5 words aside, as a word or two are no passage of a benchmark (`least`).

Words are lower case, split at ASCII white space; very long texts are slices of their own. Nulls and empty texts overlap
nothing; repeated documents or items each give their own rows; an empty table gives an empty result; other columns are
not looked at, or kept as they are by `clean_documents`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffa.llm.common import HASHED_BYTES, mix, slices, spread, table, trimmed, word_hashes

#: Window, substitutions in it, least words of an item for which documents are dropped.
WINDOW, SUBSTITUTED, LEAST = 13, 3, 5
#: Places that a mask looks at. Fixed values, found by exhaustive search over all choices of SUBSTITUTED places in WINDOW.
MASKS = ((0, 1, 2, 4, 5), (0, 1, 6, 8, 9), (0, 1, 3, 4, 5))
#: Alignments that are verified together.
ALIGNMENTS = 200_000
#: Bytes of benchmark text that are broadcast at once; a larger benchmark is searched in blocks of this size.
BLOCK_BYTES = 16_000_000


def _masked(words: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """Hash of the mask at each place where it fits."""
    n = len(words) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, np.uint64(len(mask)))
    for p in mask:
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[p : p + n])
    return h


def allowed(n: int) -> int:
    """Substitutions that a window of an item of n words may have."""
    return SUBSTITUTED * min(n, WINDOW) // WINDOW


class Seeds:
    """A block of the benchmark: its items' words and sorted seeds."""

    def __init__(self, ids: list[int | None], texts: list[str | None]):
        self.ids = ids
        self.words, self.offsets = word_hashes(pa.array(texts, pa.string()))
        lengths = np.diff(self.offsets)
        self.lengths = lengths
        item = np.repeat(np.arange(len(ids)), lengths)
        self.tables = []
        short = [(i, n) for i, n in enumerate(lengths) if 0 < n < WINDOW]
        blocks: dict[int, list[int]] = {}
        for i, n in short:
            width = int(n) // (allowed(int(n)) + 1)
            blocks.setdefault(width, []).extend(int(self.offsets[i]) + k * width for k in range(allowed(int(n)) + 1))
        for mask in (*MASKS, *(tuple(range(w)) for w in sorted(blocks))):
            h = _masked(self.words, mask)
            if mask in MASKS:
                at = np.arange(len(h))
                at = at[(item[at] == item[at + mask[-1]]) & (lengths[item[at]] >= WINDOW)] if len(h) else at
            else:
                at = np.array(blocks[len(mask)], np.int64)
            h = h[at]
            order = np.argsort(h, kind="stable")
            h, at = h[order], at[order]
            bits = np.zeros(1 << 20, bool)
            bits[(h & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            self.tables.append((mask, h, at, item[at], bits))

    def search(self, words: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(document, item, first word, end, matching words) of each overlap, touching windows joined."""
        good: dict[tuple[int, int, int], list[tuple[int, int, int]]] = {}
        for mask, seeds, at, item, bits in self.tables:
            if not len(seeds) or len(words) <= mask[-1]:
                continue
            h = _masked(words, mask)
            places = np.flatnonzero(bits[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
            left, right = np.searchsorted(seeds, h[places], "left"), np.searchsorted(seeds, h[places], "right")
            doc = np.searchsorted(offsets, places, "right") - 1
            hit = (left < right) & (places + mask[-1] < offsets[doc + 1])
            places, left, right, doc = places[hit], left[hit], right[hit], doc[hit]
            n = right - left
            total = np.concatenate([[0], np.cumsum(n)])
            first = 0
            while first < len(places):  # a seed that many items share makes many alignments: some at a time
                last = max(first + 1, int(np.searchsorted(total, total[first] + ALIGNMENTS, "right")) - 1)
                own = slice(first, last)
                k = np.repeat(left[own] - (total[own] - total[first]), n[own]) + np.arange(total[last] - total[first])
                i = item[k]
                start = np.repeat(places[own], n[own]) - (at[k] - self.offsets[i])  # where the item's first word would stand
                for key in map(tuple, np.unique(np.stack([np.repeat(doc[own], n[own]), i, start], 1), axis=0).tolist()):
                    if key not in good:
                        good[key] = self._verified(words, offsets, *key)
                first = last
        return [(d, i, *span) for (d, i, _), spans in sorted(good.items()) for span in spans]

    def _verified(self, words: np.ndarray, offsets: np.ndarray, d: int, i: int, start: int) -> list[tuple[int, int, int]]:
        """(first word, end, matching words) of the alignment's windows with few enough substitutions, touching ones joined."""
        n = int(self.lengths[i])
        a, b = max(start, int(offsets[d])), min(start + n, int(offsets[d + 1]))
        width, most = min(n, WINDOW), allowed(n)
        if b - a < width:
            return []
        equal = words[a:b] == self.words[self.offsets[i] + a - start : self.offsets[i] + b - start]
        sums = np.concatenate([[0], np.cumsum(equal)])
        found = np.flatnonzero(sums[width:] - sums[:-width] >= width - most)
        if not len(found):
            return []
        breaks = np.flatnonzero(np.diff(found) > width)
        spans = zip(found[np.concatenate([[0], breaks + 1])], found[np.concatenate([breaks, [len(found) - 1]])] + width, strict=True)
        return [(int(a + s - offsets[d]), int(a + e - offsets[d]), int(sums[e] - sums[s])) for s, e in spans]


def seed_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> list[Seeds]:
    """The benchmark in blocks of about so many bytes, each small enough to broadcast."""
    items = items.select(F.col(item_id).cast("long").alias("i"), F.col(text).cast("string").alias("t"))
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = 1 + int(size // block_bytes)
    blocks = []
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).collect() if n > 1 else items.collect()
        if rows:
            blocks.append(Seeds([r.i for r in rows], [r.t for r in rows]))
    return blocks


def overlaps(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each overlap: doc_id, item_id, first word and end in the document, matching words, words of the item."""
    schema = T.StructType(docs.select(F.col(doc_id).alias("doc_id")).schema.fields + T.StructType.fromDDL("item_id long, start_word long, end_word long, n_matched long, item_words long").fields)
    given = spread(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")))
    parts = []
    for block in seed_blocks(items, text="text", block_bytes=block_bytes):
        seeds = docs.sparkSession.sparkContext.broadcast(block)  # at most block_bytes of text, or one item

        def run(batches: Iterator[pa.RecordBatch], seeds=seeds) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch):
                    found = seeds.value.search(*word_hashes(part.column("text")))
                    if found:
                        d, i, start, end, n = map(list, zip(*found, strict=True))
                        cols = [[seeds.value.ids[x] for x in i], start, end, n, [int(seeds.value.lengths[x]) for x in i]]
                        yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(d))] + [pa.array(c, pa.int64()) for c in cols], schema.names)

        parts.append(given.mapInArrow(run, schema))
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def clean_documents(docs: DataFrame, items: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES, least: int = LEAST) -> DataFrame:
    """The documents that overlap no item of at least so many words, with all their columns; rows are decided one by one, so no identifier is needed."""
    out = spread(docs)
    for block in seed_blocks(items, block_bytes=block_bytes):
        seeds = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], seeds=seeds) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, text, HASHED_BYTES):
                    hit = {d for d, i, *_ in seeds.value.search(*word_hashes(part.column(part.schema.names.index(text)))) if seeds.value.lengths[i] >= least}
                    kept = [d for d in range(part.num_rows) if d not in hit]
                    if kept:
                        yield part.take(pa.array(kept))

        out = out.mapInArrow(trimmed(run), docs.schema)
    return out


def op4_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
