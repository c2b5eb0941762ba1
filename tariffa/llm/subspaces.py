"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors with a cosine of at least c lie within a squared distance of 2 - 2c. They are rotated at random and split into
blocks of BLOCK_DIMS dimensions; each block gets its proportional part of that budget, and a pair within the whole budget is within
its part in one block at least. In each block a range join finds the pairs within the part: vectors are dealt into cells
of a grid on the block's first coordinates, as wide as the part's radius, and reach into the neighbouring cells that their
ball touches, from the lesser cell to the greater only; in a cell the distance over all the block's coordinates decides. The union of
candidates is verified by the cosine of the original vectors in double precision, in the place where they meet: a pair counts in
the first block in which it is within its part, so counts of links add up, and no list of pairs is kept. Crowded cells
are dealt into tiles of two pieces. Components come from spanning forests of the tiles by alternating stars.

Equal vectors are one row with a number of copies on the way. A group of m different vectors that are all near copies costs
its m * m / 2 distances, in tiles that any number of tasks share.

Only vectors of one length are compared. Vectors that are null, zero, or hold null or non-finite values link with nothing.
Rows with a null vec_id take no part. Rows that repeat a vec_id are one vector, the first by its bytes among those that can
be compared. A vector of any length is held whole. An empty table gives an empty result; other columns are not looked at,
whatever their names.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffa.llm.common import bounded, checkpointed, table, told
from tariffa.llm.components import components

THRESHOLD, BLOCK_DIMS = 0.95, 8
#: Rows of a piece (a tile holds two), rows that are compared with a piece at once, pairs that are verified at once.
PIECE, ROWS, PAIRS = 8192, 512, 65_536
#: Coordinates of a grid at the most; one more for every four times as many vectors.
GRID = 4
#: What rounding may add to a squared distance of unit vectors in single and in double precision.
SLACK, FINE = 1e-5, 1e-12


@functools.lru_cache(maxsize=4)
def rotation(dims: int) -> np.ndarray:
    """A random rotation; each row gives a new coordinate."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(dims)).standard_normal((dims, dims)))
    return np.ascontiguousarray((q * np.sign(np.diag(r))).T)


def blocks_of(dims: int, block_dims: int = BLOCK_DIMS) -> list[tuple[int, int]]:
    """First and end of each block of coordinates; sizes differ by one at the most."""
    n = max(1, dims // block_dims)
    edges = [dims * i // n for i in range(n + 1)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def rotated(unit: np.ndarray) -> np.ndarray:
    """Row by row and in a fixed order of additions, so that a vector's coordinates are the same to the last bit wherever it is rotated."""
    turn = rotation(unit.shape[1])
    out = np.empty_like(unit)
    step = max(1, (1 << 21) // unit.shape[1] ** 2)
    for a in range(0, len(unit), step):
        out[a : a + step] = (unit[a : a + step, None, :] * turn).sum(axis=2)
    return out


def _cells(points: np.ndarray, radius: float, grid: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, cell and whether it is the row's own one: the cell of each point, and the greater ones that its ball touches."""
    at = points[:, :grid] / radius
    own = np.floor(at).astype(np.int64)
    rows, cells, home = [np.arange(len(points))], [own], [np.ones(len(points), bool)]
    for step in np.ndindex(*[3] * grid):
        step = np.array(step) - 1
        if not step.any() or step[np.flatnonzero(step)[0]] < 0:
            continue  # its own or a lesser cell
        gap = np.where(step > 0, own + 1 - at, np.where(step < 0, at - own, 0))
        touched = np.flatnonzero((gap * gap).sum(axis=1) <= 1 + SLACK)
        rows.append(touched)
        cells.append(own[touched] + step)
        home.append(np.zeros(len(touched), bool))
    return np.concatenate(rows), np.concatenate(cells), np.concatenate(home)


class Budget:
    """What each block may take of the squared distance."""

    def __init__(self, threshold: float, block_dims: int = BLOCK_DIMS):
        self.threshold, self.block_dims, self.whole = threshold, block_dims, max(0.0, 2 - 2 * threshold) + 1e-9

    def part(self, dims: int, block: tuple[int, int]) -> float:
        return self.whole * (block[1] - block[0]) / dims + FINE


def _near(a: np.ndarray, b: np.ndarray, budget: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and b within the budget, and perhaps some just beyond. In single precision, as one product."""
    left = np.hstack([2 * a, -(a * a).sum(axis=1, keepdims=True), -np.ones((len(a), 1))]).astype(np.float32)
    right = np.hstack([b, np.ones((len(b), 1)), (b * b).sum(axis=1, keepdims=True)]).astype(np.float32)
    return np.divmod(np.flatnonzero(left @ right.T >= -(budget + SLACK)), len(b))


def _roots(m: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Least member of each member's component."""
    root = np.arange(m)
    while True:
        least = root.copy()
        np.minimum.at(least, x, root[y])
        np.minimum.at(least, y, root[x])
        least = least[least]
        if (least == root).all():
            return root
        root = least


def linked(vectors: np.ndarray, side: np.ndarray, home: np.ndarray, block: int, budget: Budget) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a tile that are similar enough and count in this block. side: 0 and 1 are compared with each other; all 0: among themselves. Two rows that are not at home never pair."""
    dims = vectors.shape[1]
    blocks = blocks_of(dims, budget.block_dims)
    unit = units(vectors)
    own = unit @ rotation(dims)[slice(*blocks[block])].T
    apart = side.any()
    on = side == 1 if apart else np.ones(len(side), bool)
    tasks = [(np.flatnonzero(home & (side == 0)), np.flatnonzero(on))]
    if apart:
        tasks.append((np.flatnonzero(~home & (side == 0)), np.flatnonzero(home & on)))
    for first, among in tasks:
        for a in range(0, len(first) if len(among) else 0, ROWS):
            rows = first[a : a + ROWS]
            x, y = _near(own[rows], own[among], budget.part(dims, blocks[block]))
            x, y = rows[x], among[y]
            if not apart:
                good = ~home[y] | (x < y)
                x, y = x[good], y[good]
            for p in range(0, len(x), PAIRS):
                u, v = x[p : p + PAIRS], y[p : p + PAIRS]
                fine = (unit[u] * unit[v]).sum(axis=1) >= budget.threshold
                u, v = u[fine], v[fine]
                if not len(u):
                    continue
                used, place = np.unique(np.concatenate([u, v]), return_inverse=True)
                turned = rotated(unit[used])
                apart_by = (turned[place[: len(u)]] - turned[place[len(u) :]]) ** 2
                within = [apart_by[:, slice(*blocks[k])].sum(axis=1) <= budget.part(dims, blocks[k]) for k in range(block + 1)]
                counts = within[block] & ~np.any(within[:block], axis=0) if block else within[0]
                if counts.any():
                    yield u[counts], v[counts]


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, from sorted rows; only one run is held."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(key)
        cuts = np.flatnonzero(pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            if held and (a or column[0].as_py() != last):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        last = column[-1].as_py()
    if held:
        yield pa.Table.from_batches(held)


def _rows(column: pa.ChunkedArray, number: np.dtype) -> np.ndarray:
    """The vectors, all of one length, as doubles."""
    column = column.combine_chunks()
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(number).reshape(len(column), -1).astype(np.float64)


def _named(vectors: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, np.dtype]:
    """vec_id and key (the vector's bytes, null where it can't be compared), a row for each vec_id, and the kind of number in key."""
    kind = dict(vectors.dtypes)[embedding]
    number = np.dtype(np.float32 if kind == "array<float>" else np.float64)
    v = F.col(embedding).cast("array<double>")
    good = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    given = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.when(good, F.transform(v, lambda x: x + F.lit(0.0))).alias("v")).where("vec_id is not null")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [None if v.values is None else np.asarray(v.values.to_numpy(zero_copy_only=False), number).tobytes() for v in batch.column("v")]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(raw, pa.binary())], ["vec_id", "key"])

    return given.mapInArrow(packed, "vec_id long, key binary").groupBy("vec_id").agg(F.min("key").alias("key")), number


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", embedding: str = "embedding", block_dims: int = BLOCK_DIMS, piece: int = PIECE) -> DataFrame:
    """vec_id, n_links (other vectors with a cosine of the threshold or more), component_id (least vec_id that links reach), kept (it is the component's least)."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie between 0 and 1")
    bounded(vectors.sparkSession)
    budget = Budget(threshold, block_dims)
    rows, number = _named(vectors, vec_id, embedding)
    rows = checkpointed(rows)
    reps = checkpointed(rows.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")))
    n = reps.count()
    grid = min(GRID, max(1, math.ceil(math.log(max(n, 1) / piece, 4))))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_size: dict[int, list[int]] = {}
            keys = batch.column("key").to_pylist()
            for i, k in enumerate(keys):
                by_size.setdefault(len(k), []).append(i)
            ids = batch.column("rep").to_numpy()
            for size, at in by_size.items():
                turned = rotated(units(np.frombuffer(b"".join(keys[i] for i in at), number).reshape(len(at), -1).astype(np.float64)))
                dims = turned.shape[1]
                for b, block in enumerate(blocks_of(dims, block_dims)):
                    points = turned[:, slice(*block)]
                    row, cell, home = _cells(points, math.sqrt(budget.part(dims, block)), min(grid, points.shape[1]))
                    names = [f"{size}:{b}:" + ",".join(map(str, c)) for c in cell.tolist()]
                    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(ids[np.array(at)[row]]), pa.array(home)], ["cell", "rep", "home"])

    cells = checkpointed(reps.select("key", "rep").mapInArrow(dealt, "cell string, rep long, home boolean"))
    crowd = cells.groupBy("cell").agg(F.count("*").alias("n"), F.sum(F.col("home").cast("int")).alias("homes"))
    # a cell with one row, or with none at home, has no pairs; a small one is one tile, a crowded one has pieces at home and others that meet them only
    one = F.col("n") <= 2 * piece
    crowd = crowd.where("n > 1 and homes > 0").select("cell", "n", F.when(one, 1).otherwise(F.ceil(F.col("homes") / piece)).cast("int").alias("own"), F.when(one, 0).otherwise(F.ceil((F.col("n") - F.col("homes")) / (2 * piece))).cast("int").alias("far"))
    met = told(cells, checkpointed(crowd), "cell", "n")
    at_home = F.col("home") | (F.col("far") == 0)
    mixed = F.xxhash64("rep", "cell")
    side = F.when(at_home, F.pmod(mixed, F.col("own"))).otherwise(F.col("own") + F.pmod(mixed, F.greatest("far", F.lit(1)))).cast("int").alias("side")
    others = F.sequence(F.lit(0), F.when(at_home, F.col("own") + F.col("far")).otherwise(F.col("own")) - 1)
    tiles = met.select("cell", "rep", "home", side, F.explode(others).alias("other"))
    tiles = tiles.select("cell", "rep", "home", "side", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"))
    tiles = tiles.withColumn("tile", F.concat_ws("|", "cell", "lo", "hi")).drop("cell")
    placed = tiles.join(reps, "rep").repartition("tile").sortWithinPartitions("tile", "rep")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, "tile"):
            if t.num_rows < 2 or t["lo"][0] != t["hi"][0] and pc.count_distinct(t["side"]).as_py() < 2:
                continue  # a tile of two pieces of which one has no rows is another tile's
            held = _rows(t["key"], number)
            lo, hi = t["lo"][0].as_py(), t["hi"][0].as_py()
            side = (t["side"].to_numpy() == hi).astype(int) if lo != hi else np.zeros(t.num_rows, int)
            copies, ids = t["copies"].to_numpy(), t["rep"].to_numpy()
            links, root = np.zeros(t.num_rows, np.int64), np.arange(t.num_rows)
            for x, y in linked(held, side, t["home"].to_numpy(zero_copy_only=False), int(t["tile"][0].as_py().split(":")[1]), budget):
                np.add.at(links, x, copies[y])
                np.add.at(links, y, copies[x])
                root = _roots(t.num_rows, np.concatenate([x, np.arange(t.num_rows)]), np.concatenate([y, root]))
            on = links > 0
            yield pa.RecordBatch.from_arrays([pa.array(ids[on]), pa.array(links[on]), pa.array(ids[root][on])], ["rep", "links", "root"])

    found = checkpointed(placed.mapInArrow(verified, "rep long, links long, root long"))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    known = reps.join(counts, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    known = checkpointed(known.select("key", "copies", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("component_id")))
    alone = rows.where("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = told(rows.where("key is not null"), known, "key", "copies").select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op11_subspace_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
