"""Periodic runs of words, by an online sparse diagonal DP.

A run is a stretch of words with smallest period q (words q apart are equal) and a length of at least max(12, 2q) that
reaches as far as the period holds. On the diagonal of a lag d the words that equal those d places before follow each
other, and d plus their number is the length of a stretch with period d.

The DP goes over the words in tiles: for lags from 2K to 4K - 1 a tile has K words (one word for lags up to 3), as a
diagonal that is long enough holds a whole tile. The tile's earlier occurrences within these lags are looked up (in
hashes of K words, made from those of K / 2), each one adds K to the match length of its lag, and where the next tile
doesn't match the diagonal ends: the words at both ends are compared one by one, and a sufficient length is a run, emitted
at once with the smallest period that its words have. A word that very many others equal thus costs no more than another:
n words have at most 2n pairs of a tile and a lag for each K, so n log n in all. Places inside a run that was found under a
divisor of the lag open no diagonal.

Words are separated by ASCII white space (space, tab to carriage return), and case counts; scripts that don't use it are
few long words. A null text has no words. Every row is judged by itself, so repeated rows and rows with a null doc_id
give a row each. A very long text is a slice of its own, with some 40 bytes a word. An empty table gives an empty result;
other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffa.llm.common import mix, slices, spread, table, text_col

#: Words of a run at least, and how often it holds its period.
LEAST, TIMES = 12, 2
#: Pairs of a tile and a lag that are compared at once.
AT_ONCE = 1 << 20


def _needed(lag: np.ndarray) -> np.ndarray:
    """Matches in a row on the diagonal of a lag that make a run."""
    return np.maximum((TIMES - 1) * lag, LEAST - lag)


def _matched(tiles: np.ndarray, grams: np.ndarray, first: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Tile (its first word) and lag of each earlier occurrence at lags low to high - 1 in the tile's own text, by tile. first: of each word's text."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    wide = high - low
    view = np.lib.stride_tricks.sliding_window_view(grams, wide)
    inner = tiles - high + 1 >= 0
    for at in tiles[~inner].tolist():  # near the first word of the slice
        back = np.arange(low, min(high, at + 1))
        lag = back[grams[at - back] == grams[at]]
        found.append((np.full(len(lag), at), lag))
    for at in (tiles[inner][a : a + max(1, AT_ONCE // wide)] for a in range(0, int(inner.sum()), max(1, AT_ONCE // wide))):
        row, back = np.nonzero(view[at - high + 1] == grams[at][:, None])
        found.append((at[row], high - 1 - back))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, lag = (np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True))
    own = at - lag >= first[at]
    return at[own], lag[own]


def _extended(words: np.ndarray, begin: int, end: int, lag: int, first: int, last: int, most: int) -> tuple[int, int]:
    """The diagonal's matches from begin to end, with up to `most` more on either side that lie in the text (first to last)."""
    back = min(most, begin - lag - first)
    unlike = np.flatnonzero(words[begin - back : begin] != words[begin - back - lag : begin - lag])
    begin -= back - 1 - int(unlike[-1]) if len(unlike) else back
    on = min(most, last - end)
    unlike = np.flatnonzero(words[end : end + on] != words[end - lag : end + on - lag])
    return begin, end + (int(unlike[0]) if len(unlike) else on)


def _smallest(words: np.ndarray, start: int, end: int, lag: int) -> int:
    """The smallest period of a stretch with the period lag that holds it twice at least: one of its divisors."""
    period, left, prime = lag, lag, 2
    while left > 1:
        if prime * prime > left:
            prime = left
        if left % prime:
            prime += 1
            continue
        left //= prime
        shorter = period // prime
        if (words[start + shorter : end] == words[start : end - shorter]).all():
            period = shorter
    return period


def runs_of(words: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Text, first word (in the text), length and period of each run. words: a number for each distinct word; offsets: n + 1, of the texts."""
    n = len(words)
    sizes = np.diff(offsets)
    if not n:
        return []
    text = np.repeat(np.arange(len(sizes)), sizes)
    first, last = offsets[:-1][text], offsets[1:][text]
    grams, tile = mix(words.astype(np.uint64) + np.uint64(1)), 1
    found: list[tuple[int, int, int, int]] = []  # first word in the slice, end, period, text
    while True:
        low, high = (1 if tile == 1 else 2 * tile), 4 * tile
        tiles = np.arange(0, n - tile + 1, tile)
        tiles = tiles[tiles + tile <= last[tiles]]  # whole in one text
        tiles = tiles[tiles - low >= first[tiles]]
        if high - low > n:
            tiles = tiles[:0]
        if len(tiles):
            at, lag = _matched(tiles, grams, first, low, min(high, n + low))
            opens = np.ones(len(at), bool)
            for start, end, period, _ in found:
                if end - start >= low + tile:
                    a, b = np.searchsorted(at, [start + low, end - tile + 1])
                    opens[a:b] &= (lag[a:b] % period != 0) | (at[a:b] - lag[a:b] < start)
            at, lag = at[opens], lag[opens]
            order = np.lexsort((at, lag))
            at, lag = at[order], lag[order]
            goes_on = (lag[1:] == lag[:-1]) & (at[1:] == at[:-1] + tile) & (text[at[1:]] == text[at[:-1]]) if len(at) else np.zeros(0, bool)
            begins = np.flatnonzero(np.concatenate([[True], ~goes_on])) if len(at) else np.zeros(0, np.int64)
            counts = np.diff(np.append(begins, len(at)))
            enough = counts * tile + 2 * (tile - 1) >= _needed(lag[begins])
            for k, c in zip(begins[enough].tolist(), counts[enough].tolist(), strict=True):
                d, t = int(lag[k]), int(text[at[k]])
                begin, end = _extended(words, int(at[k]), int(at[k]) + c * tile, d, int(offsets[t]), int(offsets[t + 1]), tile - 1)
                if end - begin >= _needed(np.array(d)) and _smallest(words, begin - d, end, d) == d:
                    found.append((begin - d, end, d, t))
        tile *= 2
        if 4 * tile > sizes.max():  # the least lag of the next tiles doesn't fit twice
            break
        grams = mix(grams[: n - tile // 2] * np.uint64(0x9E3779B97F4A7C15) + grams[tile // 2 :])
        if len(grams) < n:  # no tile starts there
            grams = np.concatenate([grams, np.zeros(n - len(grams), np.uint64)])
    return [(t, s - int(offsets[t]), e - s, p) for s, e, p, t in sorted(found, key=lambda r: (r[3], r[0], r[2]))]


RUNS = "array<struct<start: long, length: long, period: long>>"


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, words, runs (by start and period), collapsed: the text's words joined by a space, of each run the first period only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for part in slices(batch):
                split = pc.ascii_split_whitespace(part.column("text"))
                full = pc.not_equal(pc.binary_length(split.flatten()), 0)
                ends = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
                at = split.offsets.to_numpy()
                offsets = ends[at - at[0]]
                words = split.flatten().filter(full)
                numbers = words.dictionary_encode().indices.to_numpy() if len(words) else np.zeros(0, np.int32)
                found = runs_of(numbers, offsets)
                kept = np.ones(len(words), bool)
                lists: list[list[dict]] = [[] for _ in range(part.num_rows)]
                for t, start, length, period in found:
                    lists[t].append({"start": start, "length": length, "period": period})
                    kept[offsets[t] + start + period : offsets[t] + start + length] = False
                after = np.concatenate([[0], np.cumsum(kept)])[offsets]
                left = pa.ListArray.from_arrays(pa.array(after, pa.int32()), words.filter(pa.array(kept)))
                cols = [part.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), pa.array(lists, kind), pc.binary_join(left, " ")]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "words", "runs", "collapsed"])

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_col(text).alias("text"))
    return spread(given).mapInArrow(run, f"doc_id long, words long, runs {RUNS}, collapsed string")


def wrapped(docs: DataFrame) -> DataFrame:
    """doc_id and text of documents; with h = crc32(doc_id), where h is a multiple of 10 the words from one on repeat with a period that h gives."""
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g, n = F.floor(h / 10), F.size("words")
    a = F.when(n > 0, F.pmod(g, n))
    p = 1 + F.floor((n - F.col("a")) / (3 + F.pmod(g, F.lit(8))))

    def place(i: Column) -> Column:
        return F.when(i < F.col("a"), i).otherwise(F.col("a") + F.pmod(i - F.col("a"), F.col("p")))

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_col().alias("text"))
    given = given.withColumn("words", F.when(h % 10 == 0, words)).withColumn("a", a.cast("int")).withColumn("p", p.cast("int"))
    made = F.transform(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.element_at("words", (place(i) + 1).cast("int")))
    return given.select("doc_id", F.when(F.size("words") > 0, F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(wrapped(table(spark, sf_dir, "documents")))
    # greatest length, then smallest start, then period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
