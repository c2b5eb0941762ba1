"""Language identification by interpolated Kneser-Ney character models.

Each language has a model of order 5 over the letters of its words (lower case, a mark before and after each word).
The counts cover every training document: workers count n-grams of words, Spark sums them, and the lower orders are
continuation counts derived by grouped aggregation. Each window of up to five letters that the texts to be judged hold
gets its bits under every language by joins with these tables, and a 64-bit hash. The most frequent windows, as many as
TABLE_BYTES hold, are broadcast as a sorted hash array that workers search; texts with other windows carry these windows'
hashes, and a join brings the bits. So every n-gram counts at any size of the model, and none is collected beyond that bound.

A text gets the language with the lowest cross-entropy per character (ties: the first by name). It is rejected if it
has no letter, or if that cross-entropy lies above the limit of its language and length: the median of documents that
the judging model did not learn from, and LIMIT times their spread (from the median to the SPREAD quantile) above it,
by powers of two of the number of characters.

Nulls and texts without a letter are `und` with score 0 and rejected. Training rows with a null language or text are
passed over; without any training row every text is `und` and none with letters is rejected. A very long text is read
whole, as a slice of its own. Equal rows give equal results; an empty table gives an empty result; other columns are not
looked at, or kept as they are by `identified` (but for the language, which becomes the predicted one).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffa.llm.common import HASHED_BYTES, mix, slices, span_hashes, spread, stored, table, trimmed

ORDER = 5
START, END = "\x02", "\x03"
#: Bytes of the windows that are broadcast; the rest are joined.
TABLE_BYTES = 64_000_000
#: Rejection: quantile that gives the spread of documents left out of training, spreads above their median, the least spread in bits, and bits for a text of one letter (short texts vary by the root of their length).
SPREAD, LIMIT, LEAST_SPREAD, SHORT = 0.9, 10.0, 0.15, 8.0
#: Documents that a class of lengths needs for a limit of its own; with fewer it takes that of the language.
CLASS_DOCS = 50
#: N-grams that a worker holds before it hands them on.
COUNTED_GRAMS = 300_000
#: Windows whose bits are added up at once.
SUMMED = 250_000

_CODES = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 1 << 16, np.uint64)
_LETTER = np.array([chr(c).isalpha() for c in range(1 << 16)])


def letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-case texts, everything but letters 0, and the n + 1 offsets."""
    texts = [t or "" for t in pc.utf8_lower(texts).to_pylist()]
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32).copy()
    low = codes < 1 << 16
    codes[low] *= _LETTER[codes[low]]
    codes[~low] *= np.array([chr(c).isalpha() for c in codes[~low]], bool)
    return codes, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def letter_words(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of letters within texts, and the n + 1 offsets of the texts' words."""
    letter = codes > 0
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1]
    last[:-1] &= ~letter[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(codes))]
    first[inner] = letter[inner]
    last[inner - 1] = letter[inner - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def value_of(codes: np.ndarray) -> np.ndarray:
    """A 64-bit value of each code point."""
    low = codes < 1 << 16
    out = _CODES[np.where(low, codes, 0)]
    if not low.all():
        out[~low] = mix(codes[~low].astype(np.uint64))
    return out


def distinct_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words of the texts in a row, each between its marks, their lengths with the marks, each word's place among them, and the n + 1 offsets of the texts."""
    codes, offsets = letters(texts)
    starts, ends, words = letter_words(codes, offsets)
    _, first, place = np.unique(span_hashes(value_of(codes), starts, ends), return_index=True, return_inverse=True)
    lengths = ends[first] - starts[first] + 2
    after = np.cumsum(lengths)
    made = np.empty(after[-1] if len(after) else 0, np.uint32)
    made[after - lengths], made[after - 1] = ord(START), ord(END)
    inner = np.ones(len(made), bool)
    inner[after - lengths] = inner[after - 1] = False
    made[inner] = codes[(np.arange(len(made)) + np.repeat(starts[first] - 1 - (after - lengths), lengths))[inner]]
    return made, lengths, place, words


def windows_of(codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words in a row: the hash, the last place and the length of the window of up to ORDER letters that ends at each of their characters but the first."""
    inside = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)  # characters of the word before this one
    keys = gram_keys(value_of(codes))
    at = np.flatnonzero(inside > 0)
    return np.choose(np.minimum(inside, ORDER - 1), keys)[at], at, np.minimum(inside[at] + 1, ORDER)


def gram_keys(values: np.ndarray) -> list[np.ndarray]:
    """For each order 1..ORDER the 64-bit hashes of the n-grams that end at each place of a sequence of values."""
    out, h = [], np.full(len(values), np.uint64(0x51ED270B))
    for k in range(ORDER):
        h = h.copy()
        h[k:] = mix(h[k:] * np.uint64(0x9E3779B97F4A7C15) + values[: max(0, len(values) - k)])
        out.append(h)
    return out


def _count(texts: DataFrame) -> DataFrame:
    """part, lang, gram, n: the n-grams of ORDER letters, and the shorter ones that begin a word. texts: part, lang, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[tuple]] = {}  # hashes, counts and letters of n-grams by part and language
        new = 0

        def merged() -> int:
            for key, parts in held.items():
                hashes, first, place = np.unique(np.concatenate([h for h, _, _ in parts]), return_index=True, return_inverse=True)
                n = np.bincount(place, np.concatenate([n for _, n, _ in parts]), len(hashes))  # exact below 2 ** 53
                held[key] = [(hashes, n, np.concatenate([g for _, _, g in parts])[first])]
            return sum(len(parts[0][0]) for parts in held.values())

        def grams():
            for (p, language), [(hashes, n, gram)] in held.items():
                m = len(hashes)
                yield pa.RecordBatch.from_arrays([pa.array([p] * m, pa.int32()), pa.array([language] * m, pa.string()), pa.array(gram), pa.array(n.astype(np.int64))], ["part", "lang", "gram", "n"])
            held.clear()

        for batch in batches:
            for rows in slices(batch, most=HASHED_BYTES):
                keys = list(zip(rows.column("part").to_pylist(), rows.column("lang").to_pylist(), strict=True))
                for key in dict.fromkeys(keys):
                    codes, lengths, place, _ = distinct_words(rows.column("text").filter(pa.array([k == key for k in keys])))
                    if not len(lengths):
                        continue
                    hashes, at, sizes = windows_of(codes, lengths)
                    hashes, first, own = np.unique(hashes, return_index=True, return_inverse=True)
                    n = np.bincount(own, np.repeat(np.bincount(place), lengths - 1))
                    begin, sizes = at[first] + 1 - sizes[first], sizes[first]
                    gram = np.zeros((len(hashes), ORDER), np.uint32)
                    for k in range(ORDER):
                        some = sizes > k
                        gram[some, k] = codes[begin[some] + k]
                    held.setdefault(key, []).append((hashes, n, gram.view(f"U{ORDER}")[:, 0]))
                    new += len(hashes)
                if new > COUNTED_GRAMS:
                    new = 0
                    if merged() > COUNTED_GRAMS:
                        yield from grams()
        merged()
        yield from grams()

    return spread(texts).mapInArrow(trimmed(run), "part int, lang string, gram string, n long").groupBy("part", "lang", "gram").agg(F.sum("n").alias("n"))


def counted(docs: DataFrame, part: Column, lang: str = "lang", text: str = "text") -> DataFrame:
    """Counts of all texts, by language and part of the training rows; part -1: rows that aren't learned from."""
    known = F.when(F.col(lang).isNotNull() & F.col(text).isNotNull(), F.coalesce(part, F.lit(-1))).otherwise(-1).cast("int")
    rows = docs.select(known.alias("part"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).where("text is not null")
    return stored(_count(rows.withColumn("lang", F.when(F.col("part") >= 0, F.col("lang")))))


def _probabilities(counts: DataFrame) -> DataFrame:
    """m, gram, alpha (the discounted share of the gram after its context), back (the weight of the lower order after the gram), of each model m by its counts."""
    # every gram that occurs is a suffix of a counted one; the kinds of letter before it are its continuation count
    suffixes = F.transform(F.sequence(F.lit(1), F.length("gram")), lambda k: F.expr("gram").substr(k, F.length("gram")))
    kinds = counts.select("m", F.explode(suffixes).alias("gram")).distinct()
    lower = kinds.where(F.length("gram") > 1).groupBy("m", F.col("gram").substr(F.lit(2), F.length("gram")).alias("gram")).agg(F.count("*").alias("n"))
    own = counts.where((F.length("gram") == ORDER) | F.startswith("gram", F.lit(START)))  # the longest, and those that nothing can stand before
    every = stored(lower.unionByName(own.select("m", "gram", "n")).withColumn("k", F.length("gram")))
    tallies = every.groupBy("m", "k").agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2"))
    discount = F.when(F.col("n1") + F.col("n2") == 0, 0.5).otherwise(F.greatest(F.lit(0.1), F.col("n1") / (F.col("n1") + 2 * F.col("n2"))))
    every = every.join(F.broadcast(tallies.select("m", "k", discount.alias("d"))), ["m", "k"])  # models times ORDER rows
    every = every.withColumn("context", F.expr("substring(gram, 1, k - 1)"))
    contexts = every.groupBy("m", "k", "context").agg(F.sum("n").alias("total"), (F.first("d") * F.count("*") / F.sum("n")).alias("back"))
    alpha = every.join(contexts.drop("back"), ["m", "k", "context"]).select("m", "gram", (F.greatest(F.lit(0.0), F.col("n") - F.col("d")) / F.col("total")).alias("alpha"))
    back = contexts.select("m", F.col("context").alias("gram"), "back")
    return alpha.join(back, ["m", "gram"], "full")


class Model:
    """Tables of one or more models of the same languages; column m * len(langs) + i is language i of model m."""

    def __init__(self, counts: DataFrame, members: list[tuple[int, ...]]):
        """members: the parts of the counts that each model learns from."""
        self.langs = sorted(r.lang for r in counts.where("part >= 0").select("lang").distinct().collect())  # a row for each language
        self.models = len(members)
        self.width = len(self.langs) * self.models
        self.limits: DataFrame | None = None
        if not self.langs:
            return
        place = F.array_position(F.array(*map(F.lit, self.langs)), F.col("lang")) - 1
        owners = F.filter(F.array(*(F.when(F.col("part").isin(*parts), m) for m, parts in enumerate(members))), lambda m: m.isNotNull())
        rows = counts.where("part >= 0").withColumn("m", F.explode(owners)).groupBy((F.col("m") * len(self.langs) + place).cast("int").alias("m"), "gram").agg(F.sum("n").alias("n"))
        probabilities = _probabilities(stored(rows))
        values = F.map_from_entries(F.collect_list(F.struct("m", F.struct("alpha", "back"))))
        columns = F.sequence(F.lit(0), F.lit(self.width - 1))
        wide = probabilities.groupBy("gram").agg(values.alias("v"))
        self.values = stored(wide.select("gram", F.transform(columns, lambda i: F.col("v")[i]["alpha"]).alias("alpha"), F.transform(columns, lambda i: F.col("v")[i]["back"]).alias("back")))
        roots = self.values.where("gram = ''").select("back").first()
        self.present = [b is not None for b in roots["back"]] if roots else [False] * self.width
        # letters and the end mark, of all models, and one for those that none has seen
        self.symbols = 1 + self.values.where((F.length("gram") == 1) & (F.col("gram") != START)).count()

    def bits(self, windows: DataFrame) -> DataFrame:
        """key (64-bit hash), n, bits by column of each window (gram, n)."""
        looked = windows.withColumn("k", F.explode(F.sequence(F.lit(0), F.length("gram"))))
        # the gram's last k letters: a context of the next order's probability, and a gram of this order
        looked = looked.select("gram", "n", "k", F.expr("right(gram, k)").alias("s"), F.expr("substring(right(gram, k), 1, k - 1)").alias("c"))
        values = self.values
        looked = looked.join(values.select(F.col("gram").alias("s"), "alpha"), "s", "left").join(values.select(F.col("gram").alias("c"), "back"), "c", "left").where("k > 0")
        steps = F.sort_array(F.collect_list(F.struct("k", "alpha", "back")))
        level = lambda p, x: F.transform(p, lambda v, i: F.when(x["back"][i].isNull(), v).otherwise(F.coalesce(x["alpha"][i], F.lit(0.0)) + x["back"][i] * v))
        p = F.aggregate("steps", F.array_repeat(F.lit(1.0 / self.symbols), self.width), level)
        found = looked.groupBy("gram").agg(F.first("n").alias("n"), steps.alias("steps")).select("gram", "n", F.transform(p, lambda v: (-F.log2(F.greatest(v, F.lit(1e-12)))).cast("float")).alias("bits"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array(_hashes(batch.column("gram").to_pylist()).view(np.int64)), batch.column("n"), batch.column("bits")], ["key", "n", "bits"])

        return stored(found.mapInArrow(trimmed(run), "key long, n long, bits array<float>"))


def _hashes(grams: list[str]) -> np.ndarray:
    codes = np.array(grams or [""], f"U{ORDER}").view(np.uint32).reshape(-1, ORDER)
    lengths = np.array([len(g) for g in grams] or [0])
    keys = np.zeros(len(codes), np.uint64)
    for k in range(1, ORDER + 1):
        if (own := lengths == k).any():
            keys[own] = gram_keys(value_of(codes[own, :k]).reshape(-1))[k - 1][k - 1 :: k]
    return keys[: len(grams)]


class Table:
    """A sorted array of window hashes with a row of bits for each."""

    def __init__(self, keys: np.ndarray, bits: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.bits = keys[order], bits[order]

    def sums(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[list[tuple[int, int]]]]:
        """Bits by text and column, characters by text, and by text the hashes of the windows that aren't in the table with their counts."""
        codes, lengths, place, offsets = distinct_words(texts)
        width = self.bits.shape[1]
        total, chars, rest = np.zeros((len(texts), width)), np.zeros(len(texts), np.int64), [[] for _ in range(len(texts))]
        if not len(lengths):
            return total, chars, rest
        # each distinct window is sought once
        own, which = np.unique(windows_of(codes, lengths)[0], return_inverse=True)
        bits, known = np.zeros((len(own), width), np.float32), np.zeros(len(own), bool)
        if len(self.keys):
            found = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
            known = self.keys[found] == own
            bits[known] = self.bits[found[known]]
        counts = lengths - 1
        per_word = np.concatenate([[0], np.cumsum(counts)])
        word_bits = np.empty((len(lengths), width))
        first = 0
        while first < len(lengths):
            last = max(first + 1, int(np.searchsorted(per_word, per_word[first] + SUMMED, "right")) - 1)
            a, b = per_word[first], per_word[last]
            word_bits[first:last] = np.add.reduceat(bits.take(which[a:b], axis=0), per_word[first:last] - a, axis=0, dtype=np.float64)
            first = last
        some = np.flatnonzero(np.diff(offsets))
        for c, column in enumerate(np.ascontiguousarray(word_bits.T)):
            total[some, c] = np.add.reduceat(column.take(place), offsets[some])
        chars[some] = np.add.reduceat(counts[place], offsets[some])
        if not known.all():
            missing = np.flatnonzero(~known[which])
            word = np.searchsorted(per_word, missing, "right") - 1
            unknown: dict[int, list[int]] = {}
            for w, key in zip(word.tolist(), own[which[missing]].view(np.int64).tolist(), strict=True):
                unknown.setdefault(w, []).append(key)
            text = np.repeat(np.arange(len(texts)), np.diff(offsets))
            lacking = np.zeros(len(lengths), bool)
            lacking[word] = True
            seen: dict[int, Counter] = {}
            for j in np.flatnonzero(lacking[place]):
                seen.setdefault(int(text[j]), Counter()).update(unknown[int(place[j])])
            for i, c in seen.items():
                rest[i] = list(c.items())
        return total, chars, rest


def entropies(docs: DataFrame, model: Model, bits: DataFrame, keep: Iterable[str | Column], text: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The kept columns with __sums (bits by column) and __chars, stored. bits: of every window of the texts."""
    kept = docs.select(*keep)
    made = T.StructType.fromDDL("__sums array<double>, __chars long, __row long, __rest array<struct<key:long,k:long>>")
    most = max(1, table_bytes // (8 + 4 * model.width))
    more = bits.count() > most
    top = (bits.orderBy(F.desc("n"), "key").limit(most) if more else bits).toArrow()  # most rows at the most
    held = Table(top["key"].to_numpy().view(np.uint64), np.asarray(pc.list_flatten(top["bits"].combine_chunks())).astype(np.float32).reshape(top.num_rows, model.width))
    shared = docs.sparkSession.sparkContext.broadcast(held)
    width = len(kept.columns)
    names = kept.columns + made.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch, "__text", HASHED_BYTES):
                sums, chars, rest = shared.value.sums(part.column("__text"))
                rows = pa.array(np.arange(row, row + part.num_rows))
                row += part.num_rows
                flat = pa.ListArray.from_arrays(pa.array((np.arange(len(sums) + 1) * sums.shape[1]).astype(np.int32)), pa.array(sums.reshape(-1)))
                others = pa.array([[{"key": k, "k": n} for k, n in x] for x in rest], pa.list_(pa.struct([("key", pa.int64()), ("k", pa.int64())])))
                yield pa.RecordBatch.from_arrays([*part.columns[:width], flat, pa.array(chars), rows, others], names)

    found = stored(spread(docs.select(*keep, F.col(text).cast("string").alias("__text"))).mapInArrow(trimmed(run), T.StructType(kept.schema.fields + made.fields)))
    if more:
        least = top.slice(top.num_rows - 1)
        n, key = least["n"][0].as_py(), least["key"][0].as_py()
        others = bits.where((F.col("n") < n) | ((F.col("n") == n) & (F.col("key") > key)))
        asked = found.where("size(__rest) > 0").select("__row", F.explode("__rest").alias("r")).select("__row", "r.key", "r.k")
        sums = asked.join(others, "key").groupBy("__row").agg(F.array(*(F.sum(F.col("k") * F.col("bits")[i]) for i in range(model.width))).alias("__more"))
        both = F.when(F.col("__more").isNull(), F.col("__sums")).otherwise(F.zip_with("__sums", "__more", lambda a, b: a + b))
        found = found.join(sums, "__row", "left").withColumn("__sums", both).drop("__more")
    return found.drop("__row", "__rest")


def judged(rows: DataFrame, model: Model, which: Column) -> DataFrame:
    """The rows of `entropies` with lang_pred, score, bits_per_char and __class, by the model whose number `which` gives."""
    n = len(model.langs)
    if not n:
        return rows.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0), "bits_per_char": F.lit(0.0), "__class": F.lit(0)})
    present = F.array(*map(F.lit, model.present))
    own = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.when(F.element_at(present, which * n + i), F.element_at("__sums", which * n + i)).otherwise(F.lit(float("inf"))))
    rows = rows.withColumn("__own", own).withColumn("__least", F.array_min("__own"))
    known = (F.col("__chars") > 0) & (F.col("__least") < float("inf"))
    best = F.element_at(F.array(*map(F.lit, model.langs)), F.array_position("__own", F.col("__least")).cast("int"))
    rows = rows.withColumn("lang_pred", F.when(known, best).otherwise("und"))
    weight = F.aggregate("__own", F.lit(0.0), lambda a, x: a + F.pow(F.lit(2.0), F.expr("__least") - x))
    some = F.col("lang_pred") != "und"
    return rows.withColumns({
        "score": F.when(some, F.try_divide(F.lit(1.0), weight)).otherwise(0.0),
        "bits_per_char": F.when(some, F.try_divide("__least", "__chars")).otherwise(0.0),
        "__class": F.floor(F.log2(F.greatest("__chars", F.lit(1)))).cast("int"),
    }).drop("__own", "__least")


def limits_of(left_out: DataFrame) -> DataFrame:
    """lang_pred, __class, __limit: from judged rows whose model did not learn from them."""
    rows = left_out.where("lang_pred <> 'und'").groupBy("lang_pred", "__class", F.floor(F.col("bits_per_char") * 64).alias("bin")).agg(F.count("*").alias("n"))
    rows = stored(rows)  # at most 64 rows a bit, class and language
    middle = lambda df, keys: df.groupBy(*keys).agg(F.sum("n").alias("docs"), F.expr("percentile(bin, 0.5, n)").alias("m"), F.expr(f"percentile(bin, {SPREAD}, n)").alias("q"))
    limit = (F.col("m") + 1 + LIMIT * F.greatest(F.col("q") - F.col("m"), F.lit(64 * LEAST_SPREAD))) / 64
    whole = middle(rows.groupBy("lang_pred", "bin").agg(F.sum("n").alias("n")), ["lang_pred"]).select("lang_pred", limit.alias("__whole"))
    classes = middle(rows, ["lang_pred", "__class"]).where(F.col("docs") >= CLASS_DOCS).select("lang_pred", "__class", limit.alias("__own"))
    return stored(rows.select("lang_pred", "__class").distinct().join(whole, "lang_pred").join(classes, ["lang_pred", "__class"], "left").select("lang_pred", "__class", F.coalesce("__own", "__whole").alias("__limit"), "__whole"))


def limited(rows: DataFrame, limits: DataFrame | None) -> DataFrame:
    """Judged rows with rejected."""
    if limits is None:
        return rows.withColumn("rejected", F.col("__chars") == 0).drop("__sums", "__chars", "__class")
    own = limits.select("lang_pred", "__class", "__limit")
    whole = limits.select("lang_pred", "__whole").distinct()
    # languages times lengths rows
    rows = rows.join(F.broadcast(own), ["lang_pred", "__class"], "left").join(F.broadcast(whole), "lang_pred", "left")
    short = SHORT / F.sqrt(F.pow(F.lit(2.0), F.col("__class")))
    above = F.col("bits_per_char") > F.coalesce("__limit", "__whole", F.lit(float("inf"))) + short
    return rows.withColumn("rejected", (F.col("__chars") == 0) | above).drop("__sums", "__chars", "__class", "__limit", "__whole")


def _windows(counts: DataFrame) -> DataFrame:
    return counts.groupBy("gram").agg(F.sum("n").alias("n"))


def fold_of(text: str = "text") -> Column:
    """0 or 1; equal texts share it."""
    return F.pmod(F.xxhash64(F.col(text).cast("string")), F.lit(2)).cast("int")


def _judge_all(docs: DataFrame, part: Column, keep: Iterable[str | Column], lang: str, text: str, table_bytes: int) -> tuple[DataFrame, Model]:
    """The kept columns, judged by a model of all training rows, with limits from training rows judged by the other half."""
    counts = counted(docs, part, lang, text)
    model = Model(counts, [(0,), (1,), (0, 1)])
    names = [c if isinstance(c, Column) else F.col(c) for c in keep]
    trained_on = F.when(F.col(lang).isNotNull() & F.col(text).isNotNull(), part).alias("__part")
    if not model.langs:
        rows = entropies(docs, model, _no_bits(docs.sparkSession), [*names, trained_on], text, table_bytes)
        return limited(judged(rows, model, F.lit(2)), None).drop("__part"), model
    rows = entropies(docs, model, model.bits(_windows(counts)), [*names, trained_on], text, table_bytes)
    model.limits = limits_of(judged(rows.where("__part >= 0"), model, 1 - F.col("__part")))
    return limited(judged(rows, model, F.lit(2)), model.limits).drop("__part"), model


def _no_bits(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "key long, n long, bits array<float>")


def trained(docs: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """A model of all rows, with limits of rows judged by the half that they don't belong to."""
    return _judge_all(docs, fold_of(text), [], lang, text, TABLE_BYTES)[1]


def languages(docs: DataFrame, model: Model, keep: Iterable[str | Column] = ("doc_id",), text: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The kept columns with lang_pred, score, bits_per_char and rejected, of any rows."""
    rows = docs.withColumn("__none", F.lit(None).cast("string"))
    bits = model.bits(_windows(counted(rows, F.lit(-1), "__none", text))) if model.langs else _no_bits(docs.sparkSession)
    found = entropies(docs, model, bits, keep, text, table_bytes)
    return limited(judged(found, model, F.lit(model.models - 1)), model.limits)


def identified(docs: DataFrame, lang: str = "lang", text: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows that aren't unlike every language, each judged by a model of the rows whose texts fall into the other half (equal texts into one), with the predicted language as theirs."""
    counts = counted(docs, fold_of(text), lang, text)
    model = Model(counts, [(1,), (0,)])
    bits = model.bits(_windows(counts)) if model.langs else _no_bits(docs.sparkSession)
    named = [F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(docs.columns)]  # no column's name matters
    rows = judged(entropies(docs, model, bits, [*named, fold_of(text).alias("__part")], text, table_bytes), model, F.coalesce("__part", F.lit(0)))
    limits = limits_of(rows) if model.langs else None
    kept = limited(rows, limits).where(~F.col("rejected"))
    own = F.col(f"__k{docs.columns.index(lang)}")
    known = F.when(F.col("lang_pred") == "und", own).otherwise(F.col("lang_pred").cast(docs.schema[lang].dataType))
    return kept.select(*((known if c == lang else F.col(f"__k{i}")).alias(c) for i, c in enumerate(docs.columns)))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    part = F.when(~held_out(), fold_of())
    return _judge_all(docs, part, ["doc_id", held_out().alias("held_out")], "lang", "text", TABLE_BYTES)[0]
