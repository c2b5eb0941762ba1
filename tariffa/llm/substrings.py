"""Substring dedup by content-defined chunks.

A gear hash rolls over the last REACH bytes of a text. In each window of WINDOW neighbouring words the one with the least
gear value at its end is followed by a cut, so chunks have at most WINDOW words (twice that where words repeat over and
over), cuts depend on nearby bytes alone, and an insertion moves the cuts around it only. From each chunk on, the least run
of chunks with LEAST_WORDS words is known by the 128-bit digest of its bytes; runs with one digest at several places are
copies of each other as a whole. Digests are counted with partial sums, and runs find their counts by a join in which very
frequent digests are salted. Overlapping or touching repeated runs of a document form a span. The run that stands first (by
doc_id, text and place) is the one to keep; the parts of a span that other runs cover are stale.

Of a passage of 51 words that two texts share, the first 8 words fill the reach at the most, and of the 43 places left the
first and the last window each have one cut, at least 20 words apart: so both texts have a run of 20 words in it, whatever
stands around. A repeat within one text counts like one in two texts.

Words are split at ASCII white space; case and white space count. Texts of fewer than LEAST_WORDS words (nulls and empty ones
too, and long ones without white space) have no runs. A very long text is a slice of its own. Rows with a null doc_id take no
part. Rows that repeat a doc_id are one document, whose texts are cut each by itself, and equal texts once (though `copies`
counts their rows). An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffa.llm.common import _BYTES, checkpointed, slices, span_hashes, spread, table, text_bytes, text_col, word_spans

#: Words of which one is followed by a cut, words of a run, bytes that the gear hash looks back, and bits it shifts for each.
WINDOW, LEAST_WORDS, REACH, SHIFT = 12, 20, 16, 4
#: Most digests that are treated as hot, and tasks that each of them is dealt to.
HOT_DIGESTS, SALTS = 10_000, 64

_MORE = np.random.Generator(np.random.PCG64(20240301)).integers(1, 1 << 63, 256, np.uint64)  # for the digest's other half


def gear_hashes(values: np.ndarray) -> np.ndarray:
    """At each byte the sum of the values of the last REACH bytes, each shifted by its distance; by doubling."""
    h, step = values, 1
    while step < REACH:
        wider = h.copy()
        wider[step:] += h[:-step] << np.uint64(SHIFT * step)
        h, step = wider, 2 * step
    return h


def thinned(at: np.ndarray, key: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Places of least keys; of equal ones close together (words that repeat over and over) one in WINDOW words, counted from the first."""
    close = (np.diff(key[at].view(np.int64)) == 0) & (np.diff(at) < WINDOW) & (np.diff(text[at]) == 0)
    keep = np.ones(len(at), bool)
    for begin in np.flatnonzero(close & ~np.concatenate([[False], close[:-1]])) if len(close) else ():
        kept, i = at[begin], begin + 1
        while i <= len(close) and close[i - 1]:
            if at[i] - kept < WINDOW:
                keep[i] = False
            else:
                kept = at[i]
            i += 1
    return at[keep]


def chunk_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First word and end of each chunk (within the slice), the starts and ends of words in bytes, and the texts' word offsets."""
    starts, ends, words = word_spans(data, offsets)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, starts, ends, words
    # zeros between the texts, so that none looks back into another
    place = np.arange(len(data)) + REACH * np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    values = np.zeros(len(data) + REACH * (len(offsets) - 1), np.uint64)
    values[place] = _BYTES[data]
    key = gear_hashes(values)[place[ends - 1]]
    n = len(key)
    text = np.repeat(np.arange(len(words) - 1), np.diff(words))
    chosen = np.zeros(n, bool)
    if n >= WINDOW:
        begins = np.flatnonzero(text[WINDOW - 1 :] == text[: n - WINDOW + 1])
        chosen[begins + np.lib.stride_tricks.sliding_window_view(key, WINDOW)[begins].argmin(axis=1)] = True
    cut = np.zeros(n, bool)
    cut[thinned(np.flatnonzero(chosen), key, text)] = True
    cut[words[1:][np.diff(words) > 0] - 1] = True
    end = np.flatnonzero(cut) + 1
    return np.concatenate([[0], end[:-1]]), end, starts, ends, words


RUNS = "doc_id long, body long, at long, d1 long, d2 long, span long"


def runs(docs: DataFrame, least_words: int = LEAST_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, body (a hash of the text), at (first word and number of words), d1 and d2 (the digest), span (first byte and end); pairs of numbers are packed into one, 32 bits each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, offsets = text_bytes(part.column("text"))
                first, end, starts, ends, words = chunk_words(data, offsets)
                last = np.searchsorted(end, first + least_words, "left")  # the chunk that completes the run
                first, last = first[last < len(end)], last[last < len(end)]
                row = np.searchsorted(words, first, "right") - 1
                inside = end[last] <= words[row + 1]
                first, after, row = first[inside], end[last[inside]], row[inside]
                if not len(first):
                    continue
                values, more = _BYTES[data], _MORE[data]
                a, b, base = starts[first], ends[after - 1], offsets[row]
                body = span_hashes(values, offsets[:-1], offsets[1:])[row]
                cols = [body, ((first - words[row]) << 32) | (after - first), span_hashes(values, a, b), span_hashes(more, a, b), ((a - base) << 32) | (b - base)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(row))] + [pa.array(c.view(np.int64)) for c in cols], ["doc_id", "body", "at", "d1", "d2", "span"])

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_col(text).alias("text")).where("doc_id is not null")
    return spread(given).mapInArrow(run, RUNS)


def _repeated(found: DataFrame) -> DataFrame:
    """The runs whose digest stands at several places, with copies (occurrences of the digest) and fresh (it stands here first)."""
    place = F.struct("doc_id", "body", "at")
    counts = found.groupBy("d1", "d2").agg(F.count("*").alias("copies"), F.min(place).alias("head"), F.max(place).alias("last"))
    counts = checkpointed(counts.where("copies > 1 and head < last").drop("last"))
    # digests with a ten-thousandth of the repeated runs or more, so ten thousand of them at most, are dealt to SALTS tasks each
    total = counts.agg(F.sum("copies")).first()[0] or 0
    hot = F.broadcast(counts.where(F.col("copies") >= F.lit(max(1000, total / HOT_DIGESTS))).select("d1", "d2", F.lit(True).alias("hot")))
    salted = found.join(hot, ["d1", "d2"], "left").withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id", "at"), F.lit(SALTS))).otherwise(0)).drop("hot")
    every = F.when(F.col("hot"), F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    known = counts.join(hot, ["d1", "d2"], "left").withColumn("salt", F.explode(every)).drop("hot")
    again = salted.join(known, ["d1", "d2", "salt"])
    return again.select("doc_id", "body", "at", "span", "copies", (F.col("head") == place).alias("fresh"))


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of overlapping or touching runs, from rows sorted by document and place; a span may go on in the next batch."""
    open_: list | None = None  # doc_id, body, start, end, first word, end, copies, stale words, end of the stale ones, their bytes
    out: list[list] = []
    names = ["doc_id", "start", "end", "words", "copies", "fresh_words", "stale"]
    pairs = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def made() -> pa.RecordBatch:
        cols = [[r[0] for r in out], [r[2] for r in out], [r[3] for r in out], [r[5] - r[4] for r in out], [r[6] for r in out], [r[5] - r[4] - r[7] for r in out]]
        stale = pa.array([[{"start": a, "end": b} for a, b in r[9]] for r in out], pairs)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols] + [stale], names)

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("doc_id", "body", "at", "span", "copies", "fresh")]
        for doc, body, at, span, copies, fresh in zip(*cols, strict=True):
            word, words, start, end = at >> 32, at & 0xFFFFFFFF, span >> 32, span & 0xFFFFFFFF
            if not open_ or open_[0] != doc or open_[1] != body or word > open_[5]:
                if open_:
                    out.append(open_)
                open_ = [doc, body, start, end, word, word + words, copies, 0, word, []]
            if word + words > open_[5]:
                open_[3], open_[5] = end, word + words
            open_[6] = max(open_[6], copies)
            if not fresh and word + words > open_[8]:
                open_[7] += word + words - max(open_[8], word)
                if open_[9] and word <= open_[8]:
                    open_[9][-1] = (open_[9][-1][0], end)
                else:
                    open_[9].append((start, end))
                open_[8] = word + words
        if len(out) > 5000:
            yield made()
            out = []
    if open_:
        out.append(open_)
    if out:
        yield made()


def repeated_spans(docs: DataFrame, least_words: int = LEAST_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each span: doc_id, start, end (bytes of the UTF-8 text), words, copies (most occurrences of one of its runs), fresh_words (words that aren't stale), stale (start, end of each stale part)."""
    again = _repeated(runs(docs, least_words, doc_id, text))
    dealt = again.repartition("doc_id", "body").sortWithinPartitions("doc_id", "body", "at")
    return dealt.mapInArrow(_spans, "doc_id long, start long, end long, words long, copies long, fresh_words long, stale array<struct<start:long,end:long>>")


def without_repeats(docs: DataFrame, least_words: int = LEAST_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without the stale parts of their texts; what is cut stands in an earlier place. doc_id must name one row (an error otherwise)."""
    cuts = repeated_spans(docs, least_words, doc_id, text).where("size(stale) > 0")
    cuts = cuts.groupBy("doc_id").agg(F.sort_array(F.flatten(F.collect_list("stale"))).alias("__cuts")).withColumnRenamed("doc_id", "__id")
    twice = docs.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).cast("long").alias("__id")).agg(F.count("*").alias("n")).where("n > 1")
    if not twice.isEmpty():
        raise ValueError(f"{doc_id} names several rows")
    rows = docs.join(cuts, F.col(doc_id).cast("long") == F.col("__id"), "left").drop("__id")
    at, names = docs.columns.index(text), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                made = []
                for t, cut in zip(part.column(at).to_pylist(), part.column(len(names)).to_pylist(), strict=True):
                    if cut:
                        raw, last, kept = t.encode(), 0, []
                        for c in cut:
                            kept.append(raw[last : c["start"]])
                            last = c["end"]
                        t = b"".join([*kept, raw[last:]]).decode()
                    made.append(t)
                cols = list(part.columns)[: len(names)]
                cols[at] = pa.array(made, part.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(cols, names)

    return rows.mapInArrow(run, docs.schema)


def op1_gear_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents")).drop("stale")
