import numpy as np
import pytest

from tariffa.llm import subspaces


def brute(rows, threshold):
    """(vec_id, links, component, kept) from all pairs."""
    good = lambda v: v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
    by_id = {}
    for i, v in rows:
        if i is not None:
            by_id.setdefault(i, []).append(np.array(v, np.float64) if good(v) else None)
    one = {i: min((v for v in vs if v is not None), key=lambda v: v.tobytes(), default=None) for i, vs in by_id.items()}
    ids = sorted(one)
    cosine = lambda u, v: (u := u / abs(u).max()) @ (v := v / abs(v).max()) / np.linalg.norm(u) / np.linalg.norm(v)
    up, links = {i: i for i in ids}, dict.fromkeys(ids, 0)

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            u, v = one[a], one[b]
            if u is not None and v is not None and len(u) == len(v) and cosine(u, v) >= threshold:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return sorted((i, links[i], find(i), find(i) == i) for i in ids)


def some_rows(seed=5, n=400, dims=24):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((20, dims))
    rows = []
    for i in range(n):
        v = centres[rng.integers(20)] + rng.standard_normal(dims) * rng.choice([0.05, 0.2, 0.3])
        rows.append((i, (v * rng.choice([1e-200, 1, 3, 1e150])).tolist()))
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # exact copies
    rows += [(2000, None), (2001, []), (2002, [0.0] * dims), (2003, [1.0] * (dims - 1) + [None]), (2004, [float("nan")] * dims), (2005, [float("inf")] + [1.0] * (dims - 1)), (None, rows[0][1])]
    rows += [(2010, [1.0, 2.0]), (2011, [2.0, 4.0]), (2012, [-1.0, 2.0]), (2013, [3.0]), (2014, [5.0]), (2015, [-5.0]), (2016, [0.0, -0.0, 1.0]), (2017, [-0.0, 0.0, 2.0])]
    rows += [(3, rows[3][1]), (4, rows[5][1]), (2003, rows[0][1])]  # repeated ids
    return rows


@pytest.mark.parametrize(("threshold", "piece", "block_dims"), [(0.95, 8192, 8), (0.9, 16, 4), (0.6, 40, 24), (0.99, 5, 3)])
def test_links_and_components_equal_brute_force(spark, threshold, piece, block_dims):
    rows = some_rows()
    vectors = spark.createDataFrame([(i, v, "odd", 1) for i, v in rows], "vec_id long, embedding array<double>, key string, cell int").repartition(3)
    got = subspaces.near_duplicates(vectors, threshold, block_dims=block_dims, piece=piece)
    assert sorted(map(tuple, got.collect())) == brute(rows, threshold)


def test_pairs_at_the_edge_are_found_in_one_block(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):  # pairs at cosines just above and below the threshold, in any direction
        u = rng.standard_normal(64)
        u /= np.linalg.norm(u)
        w = rng.standard_normal(64)
        w -= (w @ u) * u
        w /= np.linalg.norm(w)
        c = 0.95 + rng.choice([-1, 1]) * 10.0 ** -rng.integers(3, 9)
        rows += [(2 * i, u.tolist()), (2 * i + 1, (c * u + np.sqrt(1 - c * c) * w).tolist())]
    got = subspaces.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), piece=20)
    assert sorted(map(tuple, got.collect())) == brute(rows, 0.95)


def test_empty_table(spark):
    assert subspaces.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_parts_of_the_budget_add_up():
    budget = subspaces.Budget(0.95)
    for dims in (1, 7, 8, 64, 100):
        assert sum(budget.part(dims, b) for b in subspaces.blocks_of(dims)) >= 0.1
