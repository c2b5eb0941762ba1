import math
from collections import defaultdict

import numpy as np
import pytest

from tariffa.llm import forest as ff


def exact(rows, k=20):
    good = [(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    good = sorted(set(good))
    out = {}
    for q, v in good:
        if q % 20 == 0 and q not in out:
            best = {}
            for i, w in good:
                if i != q and len(w) == len(v):
                    s = float(np.dot(np.array(w), np.array(v)))
                    best[i] = max(best.get(i, s), s)
            out[q] = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def recall(got, want):
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: r["rank"]):
        found[r.query_id].append((r.vec_id, r.score))
    assert set(found) == {q for q, v in want.items() if v}
    hits = total = 0
    for q, best in want.items():
        own = found[q]
        assert len(own) == len(best) and len({i for i, _ in own}) == len(own)
        assert own == sorted(own, key=lambda x: (-x[1], x[0]))
        hits += sum(s >= best[-1][1] - 1e-12 for _, s in own)
        total += len(best)
    return hits / total


def test_rows(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 8)).astype(float)
    rows = [(i, base[i].tolist()) for i in range(40)]
    rows += [(100 + i, base[0].tolist()) for i in range(60)]  # one vector that many rows have
    rows += [(300, None), (301, [0.0] * 8), (302, [math.nan] * 8), (303, [None] + [1.0] * 7), (304, [math.inf] * 8), (305, []), (None, base[1].tolist()), (5, base[5].tolist()), (320, [1.0, 2.0]), (340, [2.0, -1.0]), (306, [-0.0, 1.0] + [0.0] * 6)]
    df = spark.createDataFrame([(v, i, 1.0) for i, v in rows], "embedding array<double>, vec_id long, score double")
    got = ff.nearest(df, df.where("vec_id % 20 = 0")).collect()
    want = exact(rows)
    assert recall(got, want) == 1
    for r in got:
        i, s = want[r.query_id][r.rank - 1]
        assert r.vec_id == i and r.score == pytest.approx(s, abs=1e-12)
    assert ff.nearest(df.limit(0), df.limit(0)).count() == 0


def test_prefixes_ascend():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 24))
    forest = ff.Forest(x)
    few, many = (forest.ranges(x[:50], s) for s in (0.05, 1.0))
    assert ((few[1] - few[0]).sum(0) >= 150).all() and ((many[1] - many[0]).sum(0) >= 3000).all()
    assert (many[0] <= few[0]).all() and (many[1] >= few[1]).all()


def test_recall_of_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = ff.op2_prefix_forest(spark, sf).collect()
    assert recall(got, exact(rows)) >= 0.9


def test_candidates_of_clustered_vectors():
    """50,000 clustered vectors of length one: the share that the sample asks for leaves a tenth of the rows as candidates, at recall 0.9."""
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((120, 64))
    x = centres[rng.integers(0, 120, 50_000)] + 0.35 * rng.standard_normal((50_000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    share = ff.share_for(x[: ff.SAMPLE])
    queries = x[::1000]
    bound = np.sort(queries @ x.T, axis=1)[:, -21]
    found = candidates = 0
    for block in np.array_split(x, -(-len(x) // ff.BLOCK)):
        forest = ff.Forest(block)
        first, end = forest.ranges(queries, share)
        candidates += sum(len(np.unique(np.concatenate([o[a:b] for o, a, b in zip(forest.order, first[:, j], end[:, j], strict=True)]))) for j in range(len(queries)))
        found += sum(int((s >= b).sum()) for (_, s), b in zip(forest.search(queries, share, 21), bound, strict=True))
    assert found >= 0.9 * 21 * len(queries)
    assert candidates <= 0.1 * len(x) * len(queries), (share, candidates / len(x) / len(queries))
