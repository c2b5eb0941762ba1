"""Document quality by hierarchical empirical Bayes.

A logistic classifier gives each document's evidence: how far its text moves the odds of being good from those of the
training rows. Its word features and weights are fitted on at most SAMPLE labelled documents (a documented bound, so
that their ids and labels may be broadcast and no text is shuffled); everything else covers all rows. The evidence of all documents is then summed by path and host. A host's rate of good
documents is shrunk toward the global rate, and a path's toward its host's, each with a strength that the method of
moments estimates from the spread between sites, so sparse sites stay near their prior. A document's score is the
probability that its path's rate and its own evidence give together.

Good means quality 1 and toxic not 1. Labels with a null quality or doc_id, or of two minds about one document, are
passed over. Without labels of both kinds all evidence is 0 and the global rate one half. Nulls and empty texts have
the evidence of an empty text; a null host or path is a site of its own. Repeated rows each give a row; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffa.llm.common import _BYTES, checkpointed, slices, span_hashes, spread, table, text_bytes, text_col, told, word_spans

#: Labelled documents that the classifier is fitted on, hashed words that are counted, and words that become features.
SAMPLE, BUCKETS, WORDS = 10_000, 1 << 16, 192
#: The least that a prior is worth, in documents: with it no rate reaches 0 or 1, where a document could no longer tell.
LEAST = 1.0
RIDGE = 3.0

_UPPER = np.isin(np.arange(256), np.arange(65, 91))
_LETTER = _UPPER | np.isin(np.arange(256), np.arange(97, 123)) | (np.arange(256) >= 128)
_DIGIT = np.isin(np.arange(256), np.arange(48, 58))
_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
STYLES = 8


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word (lower case, marks at its end off), and the n + 1 offsets."""
    data, offsets = text_bytes(pc.utf8_lower(texts))
    starts, ends, words = word_spans(data, offsets)
    for _ in range(3):
        ends = ends - ((ends - starts > 1) & ~_LETTER[data[ends - 1]] & ~_DIGIT[data[ends - 1]])
    return (span_hashes(_BYTES[data], starts, ends) % np.uint64(BUCKETS)).astype(np.int64), words


def _style(texts: pa.Array) -> np.ndarray:
    """Shares of letters, capitals, digits and other marks, log sizes, and shares of repeated lines and words."""
    data, offsets = text_bytes(texts)
    n = np.maximum(np.diff(offsets), 1)
    share = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags[data])])[offsets]) / n
    words, at = _words(texts)
    counts = np.diff(at)
    row = np.repeat(np.arange(len(counts)), counts)
    distinct = np.bincount(np.unique(row * BUCKETS + words) // BUCKETS, minlength=len(counts)) if len(words) else np.zeros(len(counts))
    lines = np.array([1 - len(set(x)) / len(x) for x in ((t or "").split("\n") for t in texts.to_pylist())])
    marks = ~(_LETTER | _DIGIT | _WHITE)
    return np.stack([share(_LETTER), share(_UPPER), share(_DIGIT), share(marks), np.log1p(n) / 8, np.log1p(counts) / 8, lines, 1 - distinct / np.maximum(counts, 1)], 1)


def _features(texts: pa.Array, chosen: np.ndarray) -> np.ndarray:
    """Style, and for each chosen word whether the text has it and its share."""
    words, at = _words(texts)
    slot = np.full(BUCKETS, -1)
    slot[chosen] = np.arange(len(chosen))
    row = np.repeat(np.arange(len(texts)), np.diff(at))
    column = slot[words]
    on = column >= 0
    counts = np.bincount(row[on] * len(chosen) + column[on], minlength=len(texts) * len(chosen)).reshape(len(texts), len(chosen)) if len(chosen) else np.zeros((len(texts), 0))
    total = np.maximum(np.diff(at), 1)[:, None]
    return np.hstack([_style(texts), counts > 0, np.minimum(1, 20 * counts / total)])


def _judged(labels: DataFrame) -> DataFrame:
    good = F.when(F.col("quality").isNotNull(), ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) != 1)).cast("int"))
    rows = labels.select(F.col("doc_id").cast("long").alias("__id"), good.alias("good")).where("__id is not null and good is not null")
    return rows.groupBy("__id").agg(F.min("good").alias("good"), F.max("good").alias("__other")).where("good = __other").drop("__other")


class Classifier:
    """Chosen words and weights; `base` is the log odds of good among the rows that it was fitted on."""

    def __init__(self, chosen: np.ndarray, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, base: float):
        self.chosen, self.mean, self.scale, self.weights, self.base = chosen, mean, scale, weights, base

    def evidence(self, texts: pa.Array) -> np.ndarray:
        x = (_features(texts, self.chosen) - self.mean) / self.scale
        return x @ self.weights[:-1] + self.weights[-1] - self.base


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, text: str = "text") -> Classifier:
    judged = _judged(labels)
    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), text_col(text).alias("text"))
    ids = judged.join(docs.select(F.col("doc_id").cast("long").alias("__id")).distinct(), "__id", "left_semi")
    picked = ids.orderBy(F.xxhash64("__id"), "__id").limit(sample)  # the sample's bound is the feature
    # of an id with several texts the least counts, once
    rows = checkpointed(texts.join(F.broadcast(checkpointed(picked)), "__id").groupBy("__id").agg(F.min("text").alias("text"), F.min("good").alias("good")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, BUCKETS + 1), np.int64)  # the last: documents
        for batch in batches:
            for part in slices(batch):
                words, at = _words(part.column("text"))
                good = part.column("good").to_numpy()
                row = np.repeat(np.arange(len(good)), np.diff(at))
                once = np.unique(row * BUCKETS + words)
                np.add.at(seen, (good[once // BUCKETS], once % BUCKETS), 1)
                np.add.at(seen, (good, np.full(len(good), BUCKETS)), 1)
        good, bucket = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(good), pa.array(seen[good, bucket])], ["bucket", "good", "n"])

    counted = spread(rows.select("text", "good")).mapInArrow(count, "bucket long, good long, n long").groupBy("bucket", "good").agg(F.sum("n").alias("n")).toArrow()  # at most 2 * BUCKETS rows
    seen = np.zeros((2, BUCKETS + 1))
    np.add.at(seen, (counted["good"].to_numpy(), counted["bucket"].to_numpy()), counted["n"].to_numpy())
    n = seen[:, -1]
    if not n.all():
        return Classifier(np.zeros(0, np.int64), np.zeros(STYLES), np.ones(STYLES), np.zeros(STYLES + 1), 0.0)
    share = (seen[:, :-1] + 0.5) / (n[:, None] + 1)
    pooled = (seen[:, :-1].sum(0) + 1) / (n.sum() + 2)
    z = np.abs(share[1] - share[0]) / np.sqrt(pooled * (1 - pooled) * (1 / n[0] + 1 / n[1]))
    chosen = np.sort(np.argsort(-z, kind="stable")[:WORDS])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                x = _features(part.column("text"), chosen).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), part.column("good")], ["x", "good"])

    got = spread(rows.select("text", "good")).mapInArrow(features, "x binary, good int").toArrow()
    x = np.frombuffer(b"".join(got["x"].to_pylist()), np.float32).reshape(got.num_rows, -1).astype(float)
    y = got["good"].to_numpy().astype(float)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    x = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    w[-1] = base = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    penalty = np.full(len(w), RIDGE)
    penalty[-1] = 0
    for _ in range(12):  # Newton's method
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty)
        w -= np.linalg.solve(h, x.T @ (p - y) + penalty * w)
    return Classifier(chosen, mean, scale, w, float(base))


def _moments(rate: str, n: str, prior: Column) -> list[Column]:
    """Sums for the spread of rates around their priors, beyond that of n draws."""
    own, p = F.col(rate), prior
    return [F.sum(n).alias("n"), F.sum(F.col(n) * (own - p) * (own - p)).alias("spread"), F.sum(p * (1 - p)).alias("drawn"), F.sum(F.col(n) * p * (1 - p)).alias("level")]


def _strength(row) -> float:
    """Documents that a prior is worth, by the method of moments; infinite where sites differ no more than draws would."""
    if row is None or not row.n or row.spread <= row.drawn:
        return math.inf
    return max(LEAST, row.level / (row.spread - row.drawn) - 1)


def _shrunk(good: Column, n: Column, strength: float, prior: Column) -> Column:
    """The rate of n rows shrunk to a prior that is worth `strength` documents."""
    return prior if math.isinf(strength) else (good + strength * prior) / (n + strength)


def posteriors(evidence: DataFrame, base: float) -> DataFrame:
    """doc_id, host, path, evidence (log odds) to these with host_rate, path_rate and score. A document's own evidence is left out of the rates that it is judged by, so that it counts once."""
    own = 1 / (1 + F.exp(-(F.col("evidence") + F.lit(base))))
    # sites by grouped aggregation: a partial sum for each site and task
    paths = checkpointed(evidence.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(own).alias("good")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    total = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_good").alias("good")).first()
    rate = (total.good + 0.5) / (total.n + 1) if total.n else 0.5
    shares = hosts.withColumn("share", F.col("host_good") / F.col("host_n"))
    host_m = _strength(shares.agg(*_moments("share", "host_n", F.lit(rate))).first())
    hosts = hosts.withColumn("whole", _shrunk(F.col("host_good"), F.col("host_n"), host_m, F.lit(rate)))
    sites = paths.join(hosts, paths["host"].eqNullSafe(hosts["host"])).drop(hosts["host"]).withColumn("share", F.col("good") / F.col("n"))
    path_m = _strength(sites.agg(*_moments("share", "n", F.col("whole"))).first())
    key = F.to_json(F.struct("host", "path"), {"ignoreNullFields": "false"})
    sites = sites.select(key.alias("__site"), "n", "good", "host_n", "host_good")
    out = told(evidence.withColumn("__site", key).withColumn("__own", own), sites, "__site", "n")
    out = out.withColumn("host_rate", _shrunk(F.col("host_good") - F.col("__own"), F.col("host_n") - 1, host_m, F.lit(rate)))
    out = out.withColumn("path_rate", _shrunk(F.col("good") - F.col("__own"), F.col("n") - 1, path_m, F.col("host_rate")))
    odds = F.log(F.col("path_rate") / (1 - F.col("path_rate"))) + F.col("evidence")
    return out.withColumn("score", 1 / (1 + F.exp(-odds))).drop("__site", "__own", "n", "good", "host_n", "host_good")


def site_of(url: Column) -> tuple[Column, Column]:
    """Host and first part of the path of a URL, for tables that have one."""
    rest = F.regexp_replace(F.lower(F.trim(url)), r"^[a-z][a-z0-9+.-]*://", "")
    return F.nullif(F.regexp_extract(rest, r"^(?:www\.)?([^/?#:]+)", 1), F.lit("")), F.concat(F.lit("/"), F.regexp_extract(rest, r"^[^/?#]*/([^/?#]*)", 1))


def scored(docs: DataFrame, model: Classifier, host: Column | str = "source", path: Column | str = "lang", text: str = "text") -> DataFrame:
    """doc_id, host, path, evidence, host_rate, path_rate, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = pa.array(shared.value.evidence(part.column("text")), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns[:3], found], ["doc_id", "host", "path", "evidence"])

    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_col(host).cast("string").alias("host"), as_col(path).cast("string").alias("path"), text_col(text).alias("text"))
    evidence = spread(given).mapInArrow(run, "doc_id long, host string, path string, evidence double")
    return posteriors(checkpointed(evidence), model.base)


def op10_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fitted(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model).withColumn("keep", F.col("score") >= 0.5)
