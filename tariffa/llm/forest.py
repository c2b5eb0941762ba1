"""Approximate nearest neighbours by a hash-prefix forest.

Distinct vectors are dealt into blocks. In a block each tree is a sorted array of 64-bit hash strings (signs of random
projections, with one more coordinate that turns the largest inner product into the smallest angle). A query descends
in every tree to the rows with its longest prefix; then all trees ascend together, one bit at a time, until the
prefixes hold enough candidates. How many are enough is measured on a bounded sample against brute force. Candidates
are scored exactly in double precision, and the blocks' best rows are merged. Queries are broadcast in blocks of
QUERY_BLOCK; the rows of one vector share its place, so that a vector that very many rows have is searched once.

Vectors that are null, zero, or hold null or non-finite values take no part, nor rows with a null vec_id. Only vectors
of one length are compared. Equal rows count once; of several vectors with the query's vec_id the first by its bytes
asks. Ties go to the smaller vec_id. An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tariffa.llm.common import bounded, checkpointed, table

K, TREES, DEPTH = 20, 32, 64
#: Vectors of a block, queries that are broadcast at once, vectors of the sample, and its recall.
BLOCK, QUERY_BLOCK, SAMPLE, RECALL = 8192, 16_384, 4096, 0.96
#: Candidates, counted in every tree, as shares of a block.
SHARES = (0.02, 0.05, 0.1, 0.25, 0.5, 1.0, 1.5, 2.0, 3.0, 4.0, 6.0, 8.0, 12.0, 16.0, float(TREES))


class Forest:
    def __init__(self, vectors: np.ndarray, trees: int = TREES):
        """vectors: rows of doubles, all of one length."""
        self.vectors = vectors
        n, dims = vectors.shape
        norms = np.linalg.norm(vectors, axis=1)
        most = norms.max()
        raised = np.hstack([vectors / most, np.sqrt(np.maximum(0, 1 - (norms / most) ** 2))[:, None]])
        self.planes = np.random.Generator(np.random.PCG64(dims)).standard_normal((trees, dims + 1, DEPTH))
        self.order, self.codes = [], []
        for p in self.planes:
            code = self._code(raised, p)
            order = np.argsort(code, kind="stable")
            self.order.append(order)
            self.codes.append(code[order])

    @staticmethod
    def _code(rows: np.ndarray, planes: np.ndarray) -> np.ndarray:
        return np.packbits(rows @ planes > 0, axis=1).view(">u8")[:, 0].astype(np.uint64)

    def ranges(self, queries: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
        """First and end in each tree (row) of each query's candidates, from the deepest level that has enough."""
        raised = np.hstack([queries / np.linalg.norm(queries, axis=1)[:, None], np.zeros((len(queries), 1))])
        codes = [self._code(raised, p) for p in self.planes]
        enough = share * len(self.vectors)
        first = np.zeros((len(codes), len(queries)), np.int64)
        end = np.full((len(codes), len(queries)), len(self.vectors), np.int64)
        open_ = np.arange(len(queries))
        for depth in range(DEPTH, 0, -1):  # a vector's own string agrees to the last bit
            low = np.uint64((1 << (DEPTH - depth)) - 1)
            a = np.stack([np.searchsorted(s, c[open_] & ~low, "left") for s, c in zip(self.codes, codes, strict=True)])
            b = np.stack([np.searchsorted(s, c[open_] | low, "right") for s, c in zip(self.codes, codes, strict=True)])
            done = (b - a).sum(axis=0) >= enough
            first[:, open_[done]], end[:, open_[done]] = a[:, done], b[:, done]
            open_ = open_[~done]
            if not len(open_):
                break
        return first, end

    def search(self, queries: np.ndarray, share: float, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query rows and exact scores of its k best candidates and all that tie with the last."""
        first, end = self.ranges(queries, share)
        for j, q in enumerate(queries):
            seen = np.zeros(len(self.vectors), bool)
            for t, order in enumerate(self.order):
                seen[order[first[t, j] : end[t, j]]] = True
            at = np.flatnonzero(seen)
            scores = self.vectors[at] @ q
            if len(at) > k:
                kept = scores >= np.partition(scores, len(at) - k)[len(at) - k]
                at, scores = at[kept], scores[kept]
            yield at, scores


def share_for(sample: np.ndarray, k: int = K, recall: float = RECALL) -> float:
    """The least share that reaches the recall on the sample, each eighth vector being a query."""
    if len(sample) < 4 * k:
        return SHARES[-1]
    forest, queries = Forest(sample), sample[::8]
    exact = queries @ sample.T
    bound = np.partition(exact, exact.shape[1] - k - 1, axis=1)[:, exact.shape[1] - k - 1]  # the query itself is one more
    for share in SHARES[:-1]:
        hits = sum(int((s >= b).sum()) for (_, s), b in zip(forest.search(queries, share, k + 1), bound, strict=True))
        if hits >= recall * (k + 1) * len(queries):
            return share
    return SHARES[-1]


def _usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    v = F.col(embedding).cast("array<double>")
    good = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(v, lambda x: x + F.lit(0.0)).alias("v")).where(F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False)))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = [np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64).tobytes() for v in batch.column("v")]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(raw, pa.binary())], ["vec_id", "key"])


def _least_ids(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key and vec_id, a row for each key with its least ids."""
    last, ids, out = None, [], []

    def batch_of(rows):
        keys, lists = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(lists, pa.list_(pa.int64()))], ["key", "ids"])

    for batch in batches:
        for i, key in zip(batch.column("vec_id").to_pylist(), batch.column("key").to_pylist(), strict=True):
            if key != last:
                if last is not None:
                    out.append((last, ids))
                last, ids = key, []
            if len(ids) < most and (not ids or ids[-1] != i):
                ids.append(i)
        if len(out) > 2000:
            yield batch_of(out)
            out = []
    if last is not None:
        out.append((last, ids))
    if out:
        yield batch_of(out)


def distinct_vectors(vectors: DataFrame, most: int, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """key (the vector's doubles), ids (the least `most` of its rows); a task hands on so many for each vector that it has."""
    bounded(vectors.sparkSession)
    rows = _usable(vectors, vec_id, embedding).mapInArrow(_packed, "vec_id long, key binary")
    made = lambda df: df.mapInArrow(lambda b: _least_ids(b, most), "key binary, ids array<long>")
    first = made(rows.sortWithinPartitions("key", "vec_id")).select(F.explode("ids").alias("vec_id"), "key")
    return made(first.repartition("key").sortWithinPartitions("key", "vec_id"))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding", recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: of each query row the k nearest other rows found."""
    spark = vectors.sparkSession
    index = checkpointed(distinct_vectors(vectors, k + 1, vec_id, embedding))
    n = index.count()
    sample = [r.key for r in index.orderBy(F.xxhash64("key"), "key").limit(SAMPLE).select("key").collect()]
    dims = max({len(s) for s in sample}, key=lambda d: (sum(len(s) == d for s in sample), d)) if sample else 8
    share = share_for(np.frombuffer(b"".join(s for s in sample if len(s) == dims), np.float64).reshape(-1, dims // 8), k, recall)
    index = index.repartition(max(spark.sparkContext.defaultParallelism, -(-n // BLOCK)))
    asked = _usable(queries, vec_id, embedding).mapInArrow(_packed, "vec_id long, key binary").groupBy("vec_id").agg(F.min("key").alias("key"))
    asked = checkpointed(asked)
    n_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    schema = "query_id long, vec_id long, score double"
    parts = []
    for block in range(n_blocks):
        rows = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == block).collect()  # about QUERY_BLOCK vectors
        by_size: dict[int, list] = {}
        for r in rows:
            by_size.setdefault(len(r.key), []).append(r)
        packed = {d: (np.array([r.vec_id for r in v]), np.frombuffer(b"".join(bytes(r.key) for r in v), np.float64).reshape(len(v), -1)) for d, v in by_size.items()}
        shared = spark.sparkContext.broadcast(packed)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            held: dict[int, list] = {}

            def searched(size: int) -> Iterator[pa.RecordBatch]:
                keys, ids = zip(*held.pop(size), strict=True)
                names, asking = shared.value[size]
                own = np.frombuffer(b"".join(keys), np.float64).reshape(len(keys), -1)
                q_out, v_out, s_out = [], [], []
                for q, (at, scores) in zip(names.tolist(), Forest(own).search(asking, share, k + 1), strict=True):
                    best = sorted((-s, i) for s, a in zip(scores.tolist(), at.tolist(), strict=True) for i in ids[a] if i != q)[:k]
                    q_out += [q] * len(best)
                    s_out += [-s for s, _ in best]
                    v_out += [i for _, i in best]
                    if len(q_out) > 50_000:
                        yield pa.RecordBatch.from_arrays([pa.array(q_out, pa.int64()), pa.array(v_out, pa.int64()), pa.array(s_out, pa.float64())], ["query_id", "vec_id", "score"])
                        q_out, v_out, s_out = [], [], []
                yield pa.RecordBatch.from_arrays([pa.array(q_out, pa.int64()), pa.array(v_out, pa.int64()), pa.array(s_out, pa.float64())], ["query_id", "vec_id", "score"])

            for batch in batches:
                for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                    if len(key) in shared.value:
                        held.setdefault(len(key), []).append((key, ids))
                        if len(held[len(key)]) >= BLOCK:
                            yield from searched(len(key))
            for size in list(held):
                yield from searched(size)

        parts.append(index.mapInArrow(run, schema))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionAll(p)
    # a vec_id with several vectors is one row for each of them; the best counts
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where("vec_id % 20 = 0"))
