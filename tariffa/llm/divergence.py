"""Source divergence audit by chunk factorization.

Each task splits its documents at ASCII white space, counts chunks per document and adds them up by chunk, language and
source: occurrences, and the documents while they are two at most (from three on only that they are). All counts of a
chunk travel as one row. Rows then meet by chunk; each chunk that is distinct in the whole corpus is tokenized once
there, and its terms are joined back to the counts, which meet again by term. A term is in three documents of a language
if one of its chunks is, or if the documents of its rarer chunks, all known, are three different ones; so no row for each
document and chunk is ever shuffled. Occurrences of terms are sums over chunks. Sorted rows are read as a stream, and what
is held of a chunk or term are its sums by source.

A term's share of a group is an integer, p = 1 + floor(10 ** 9 * (count + 1) / (N + V)), and its divergence from another
share q is floor((p - q) ** 2 / q). Sums over all V kept terms of two sources take the terms that both have from the
groups of a term, those of one source from a histogram of its shares, and the others from their number.

Terms are runs of ASCII letters and characters beyond ASCII; A to Z are lower-cased, nothing else. Null text, language and
source are ''. Every row is a document, so repeated rows and rows with a null doc_id count. A language without kept terms
has no `term` rows and pairs of 0, one with a single source no pairs. Very long texts are a slice of their own, long
chunks are terms like others. An empty table gives an empty result; other columns are not looked at, whatever their names.
Groups are known by 64-bit hashes on the way; two groups with one hash would be an error, not a wrong result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tariffa.llm.common import slices, spread, stored, table, text_col

#: Documents of a language that a kept term is in (the counts tell one, two and more apart), ranks of the terms that are given.
LEAST_DOCS, RANKS = 3, 200
#: Text bytes whose counts are added up at once, rows that are read at once, pairs that are summed at once.
COUNT_BYTES, ROWS, PAIRS = 10_000_000, 50_000, 1_000_000
#: What parts terms.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"

#: Counts of a chunk or term in one group: hashes of language and group, occurrences, least and greatest document (-1: three or more).
LANG, GROUP, N, LOW, HIGH = range(5)


def _starts(*sorted_by: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before it."""
    new = np.ones(len(sorted_by[0]), bool)
    if len(new):
        new[1:] = np.any([x[1:] != x[:-1] for x in sorted_by], axis=0)
    return new


def _merged(key: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of keys in groups, added up; of a key with three documents in a language every low and high is -1. By key, language and group."""
    if not len(key):
        return key, counts
    coded = pa.array(counts[GROUP]).dictionary_encode()
    group, names = coded.indices.to_numpy(), coded.dictionary.to_numpy()
    lang = np.zeros(len(names), np.int64)
    lang[group] = counts[LANG]
    place = np.empty(len(names), np.int64)
    place[np.lexsort((names, lang))] = np.arange(len(names))
    order = np.argsort(key * len(names) + place[group])
    key, counts = key[order], counts[:, order]
    low, high = counts[LOW], counts[HIGH]
    new = _starts(key, counts[LANG])
    begins, own = np.flatnonzero(new), np.cumsum(new) - 1
    least, most = np.minimum.reduceat(low, begins), np.maximum.reduceat(high, begins)
    third = ((low > least[own]) & (low < most[own])) | ((high > least[own]) & (high < most[own]))
    many = np.logical_or.reduceat(third, begins) | (least < 0)
    begins = np.flatnonzero(_starts(key, counts[GROUP]))
    out = counts[:, begins]
    out[N] = np.add.reduceat(counts[N], begins)
    out[LOW] = np.minimum.reduceat(low, begins)
    out[HIGH] = np.maximum.reduceat(high, begins)
    out[LOW:, many[own[begins]]] = -1
    return key[begins], out


def _packed(names: pa.Array, key: np.ndarray, counts: np.ndarray, name: str) -> Iterator[pa.RecordBatch]:
    """A row for each name with its counts. key: sorted places in names."""
    keys, begins = np.unique(key, return_index=True)
    ends = np.append(begins, len(key))
    for a in range(0, len(keys), 10_000):
        b = min(len(keys), a + 10_000)
        raw = np.ascontiguousarray(counts[:, ends[a] : ends[b]].T)
        offsets = ((ends[a : b + 1] - ends[a]) * raw.itemsize * raw.shape[1]).astype(np.int32)
        column = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        yield pa.RecordBatch.from_arrays([names.take(pa.array(keys[a:b])).cast(pa.string()), column], [name, "counts"])


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and counts of each entry."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    counts = data.view(np.int64).reshape(-1, 5).T.copy()
    return np.repeat(np.arange(len(column)), np.diff(offsets) // 40), counts


def _gathered(batches: Iterator[pa.RecordBatch], rows: int, nbytes: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for part in slices(batch, batch.schema.names[-1], nbytes):
            held.append(part)
            if sum(b.num_rows for b in held) >= rows or sum(b.nbytes for b in held) >= nbytes:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _counted(part: pa.Table) -> Iterator[pa.RecordBatch]:
    split = pc.ascii_split_whitespace(part["text"].combine_chunks() if part["text"].num_chunks != 1 else part["text"].chunk(0))
    at = split.offsets.to_numpy()
    chunks = split.flatten().dictionary_encode()
    row = np.repeat(np.arange(part.num_rows), np.diff(at))
    n = max(1, len(chunks.dictionary))
    # counts per document: a row for each document and chunk
    pairs, times = np.unique(row * n + chunks.indices.to_numpy(), return_counts=True)
    row, chunk = pairs // n, pairs % n
    counts = np.stack([part["lang"].to_numpy()[row], part["group"].to_numpy()[row], times, part["doc"].to_numpy()[row], part["doc"].to_numpy()[row]])
    blank = pc.index(chunks.dictionary, "").as_py()
    if blank >= 0:
        counts, chunk = counts[:, chunk != blank], chunk[chunk != blank]
    yield from _packed(chunks.dictionary, *_merged(chunk, counts), "chunk")


def chunk_counts(docs: DataFrame) -> DataFrame:
    """chunk, counts: from lang and group (hashes), doc (a number for each row) and text. Several rows for a chunk, one a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _gathered(batches, 1 << 30, COUNT_BYTES):
            yield from _counted(part)

    return docs.mapInArrow(run, "chunk string, counts binary")


def term_counts(counted: DataFrame) -> DataFrame:
    """term, counts: each distinct chunk is tokenized once, and its terms get its counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, None  # of rows sorted by chunk the last one's terms, as it may go on
        for part in _gathered(batches, ROWS, COUNT_BYTES):
            chunks = part["chunk"].chunk(0).dictionary_encode()
            fresh = chunks.dictionary[1:] if chunks.dictionary[0].as_py() == last else chunks.dictionary
            terms = pc.split_pattern_regex(pc.ascii_lower(fresh), BETWEEN)
            if len(fresh) < len(chunks.dictionary):
                terms = pa.concat_arrays([known, terms])
            last, known = chunks.dictionary[-1].as_py(), terms[-1:]
            words = terms.flatten().dictionary_encode()
            ends = terms.offsets.to_numpy() - terms.offsets[0].as_py()
            row, counts = _unpacked(part["counts"])
            of = chunks.indices.to_numpy()[row]
            # the join: each count once for each term of its chunk
            each = (ends[1:] - ends[:-1])[of]
            entry = np.repeat(np.arange(len(of)), each)
            within = np.arange(len(entry)) - np.repeat(np.cumsum(each) - each, each)
            key = words.indices.to_numpy()[ends[:-1][of][entry] + within].astype(np.int64)
            blank = pc.index(words.dictionary, "").as_py()
            good = key != blank
            yield from _packed(words.dictionary, *_merged(key[good], counts[:, entry[good]]), "term")

    return counted.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(run, "term string, counts binary")


def kept_counts(found: DataFrame) -> DataFrame:
    """lang, group, term, n, whole (of the language) of the terms in LEAST_DOCS documents of the language."""

    def kept(names: pa.Array, key: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        on = counts[LOW] < 0
        key, counts = key[on], counts[:, on]
        if not len(key):
            return
        new = _starts(key, counts[LANG])
        whole = np.add.reduceat(counts[N], np.flatnonzero(new))[np.cumsum(new) - 1]
        cols = [pa.array(counts[LANG]), pa.array(counts[GROUP]), names.take(pa.array(key)).cast(pa.string()), pa.array(counts[N]), pa.array(whole)]
        yield from pa.Table.from_arrays(cols, names=["lang", "group", "term", "n", "whole"]).to_batches(10_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rest = None, np.zeros((5, 0), np.int64)  # sums of the last term, as it may go on
        for part in _gathered(batches, ROWS, COUNT_BYTES):
            terms = part["term"].chunk(0).dictionary_encode()
            row, counts = _unpacked(part["counts"])
            key, names = terms.indices.to_numpy()[row].astype(np.int64), terms.dictionary
            if last is not None:
                if names[0].as_py() != last:
                    key, names = key + 1, pa.concat_arrays([pa.array([last], names.type), names])
                key, counts = np.concatenate([np.zeros(rest.shape[1], np.int64), key]), np.hstack([rest, counts])
            key, counts = _merged(key, counts)
            over = key == len(names) - 1
            last, rest = names[-1].as_py(), counts[:, over]
            yield from kept(names, key[~over], counts[:, ~over])
        if last is not None:
            yield from kept(pa.array([last]), np.zeros(rest.shape[1], np.int64), rest)

    return found.repartition("term").sortWithinPartitions("term").mapInArrow(run, "lang long, group long, term string, n long, whole long")


def _share(count: Column, total: Column, kinds: Column) -> Column:
    """Exact: whole numbers beyond 64 bits on the way."""
    return 1 + F.call_function("div", F.lit(1_000_000_000).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)"), (total + kinds).cast("decimal(19,0)"))


def _gap(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def common_gaps(known: DataFrame) -> DataFrame:
    """group, other, value: sums over the terms that both groups have of their gap less what it were without the term. known: lang, term, group, p, zero."""

    def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // q

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], int] = {}
        rest: pa.Table | None = None

        def add(part: pa.Table) -> None:
            group, p, zero = (part[c].to_numpy() for c in ("group", "p", "zero"))
            names, local = np.unique(group, return_inverse=True)
            code = names.tolist()
            begins = _begins(part)
            ends = np.append(begins[1:], len(group))
            sizes = ends - begins
            own = np.repeat(np.arange(len(begins)), sizes)
            each, first = sizes[own], begins[own]
            total = np.concatenate([[0], np.cumsum(each)])
            a = 0
            while a < len(group):  # some rows, each with all of its term
                b = max(a + 1, int(np.searchsorted(total, total[a] + PAIRS, "right")) - 1)
                x = np.repeat(np.arange(a, b), each[a:b])
                y = np.arange(total[b] - total[a]) - np.repeat(total[a:b] - total[a], each[a:b]) + first[x]
                value = gap(p[x], p[y]) - gap(p[x], zero[y]) - gap(zero[x], p[y]) + gap(zero[x], zero[y])
                pair = local[x] * len(names) + local[y]
                if len(names) ** 2 > PAIRS:
                    pairs, pair = np.unique(pair, return_inverse=True)
                else:
                    pairs = np.arange(len(names) ** 2)
                added = np.zeros(len(pairs), np.int64)
                np.add.at(added, pair, value)
                for k in np.flatnonzero(added).tolist():
                    at = (code[int(pairs[k]) // len(names)], code[int(pairs[k]) % len(names)])
                    sums[at] = sums.get(at, 0) + int(added[k])
                a = b

        def out() -> pa.RecordBatch:
            rows = [(*k, v) for k, v in sums.items() if k[0] != k[1]]
            sums.clear()
            cols = list(zip(*rows, strict=True)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["group", "other", "value"])

        for part in _gathered(batches, ROWS, COUNT_BYTES):
            part = pa.concat_tables([rest, part]).combine_chunks() if rest is not None else part
            last = int(_begins(part)[-1])
            if last:
                add(part[:last])
            rest = part[last:]
            if len(sums) > PAIRS:
                yield out()
        if rest is not None:
            add(rest.combine_chunks())
        yield out()

    rows = known.select("group", "p", "zero", "lang", "term").repartition("lang", "term").sortWithinPartitions("lang", "term")
    return rows.mapInArrow(run, "group long, other long, value long").groupBy("group", "other").agg(F.sum("value").alias("value"))


def _begins(part: pa.Table) -> np.ndarray:
    """First row of each language and term."""
    lang, term = part["lang"].to_numpy(), part["term"].combine_chunks()
    new = np.ones(len(lang), bool)
    if len(lang) > 1:
        new[1:] = (lang[1:] != lang[:-1]) | pc.not_equal(term[1:], term[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def audit(docs: DataFrame, ranks: int = RANKS, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: `pair` rows compare a source with each other one of its language, `term` rows name the terms that it has more of than the language."""
    named = docs.select(text_col(lang).alias("lang"), text_col(source).alias("source"), text_col(text).alias("text"))
    groups = stored(named.select("lang", "source", F.xxhash64("lang").alias("in"), F.xxhash64("lang", "source").alias("group")).distinct())
    same = groups.groupBy("group").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() + groups.groupBy("in").agg(F.count_distinct("lang").alias("n")).where("n > 1").limit(1).count()
    if same:
        raise ValueError("two groups have one hash")
    hashed = spread(named).select(F.xxhash64("lang").alias("lang"), F.xxhash64("lang", "source").alias("group"), F.monotonically_increasing_id().alias("doc"), "text")
    counts = stored(kept_counts(term_counts(chunk_counts(hashed))))
    of_langs = counts.groupBy(F.col("lang").alias("in")).agg(F.sum("n").alias("all"), F.count_distinct("term").alias("kinds"))
    of_sources = counts.groupBy("group").agg(F.sum("n").alias("own"), F.count("*").alias("terms"))
    # a row for each source of each language, with the share of a term that it doesn't have
    sources = groups.join(of_langs, "in", "left").join(of_sources, "group", "left").fillna(0, ["own", "terms", "all", "kinds"])
    zero = F.when(F.col("kinds") > 0, _share(F.lit(0).cast("long"), F.col("own"), F.col("kinds"))).otherwise(1)
    sources = stored(sources.select("lang", "source", "in", "group", "own", "terms", "kinds", "all", zero.alias("zero")))
    known = counts.join(sources.select("group", "source", "own", "kinds", "all", "zero", F.col("lang").alias("name")), "group")
    known = known.select("lang", "name", "source", "group", "term", "whole", "all", "kinds", _share(F.col("n"), F.col("own"), F.col("kinds")).alias("p"), "zero")

    q = _share(F.col("whole"), F.col("all"), F.col("kinds"))
    above = known.withColumn("q", q).where("p > q").select("group", F.col("term").alias("item"), _gap("p", "q").alias("value"))
    first = F.row_number().over(Window.partitionBy("group").orderBy(F.desc("value"), "item"))
    above = above.withColumn("rank", first).where(F.col("rank") <= ranks).join(groups.select("group", "lang", "source"), "group")
    above = above.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")

    shares = known.groupBy("lang", "group", "p").agg(F.count("*").alias("times"))
    others = sources.select(F.col("in").alias("lang"), F.col("group").alias("other"), "zero")
    of_one = shares.join(others, "lang").where("group <> other")
    forth = of_one.select("group", "other", (F.col("times") * _gap("p", "zero")).alias("value"))
    back = of_one.select(F.col("other").alias("group"), F.col("group").alias("other"), (F.col("times") * _gap("zero", "p")).alias("value"))
    none = sources.join(sources.select("in", F.col("group").alias("other"), F.col("zero").alias("q"), F.col("terms").alias("more")), "in").where("group <> other")
    none = none.select("group", "other", ((F.col("kinds") - F.col("terms") - F.col("more")) * _gap("zero", "q")).alias("value"))
    pairs = common_gaps(known).unionByName(forth).unionByName(back).unionByName(none).groupBy("group", "other").agg(F.sum("value").alias("value"))
    names = groups.select("group", "lang", "source")
    pairs = pairs.join(names, "group").join(groups.select(F.col("group").alias("other"), F.col("source").alias("item")), "other")
    order = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", order).unionByName(above)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))
