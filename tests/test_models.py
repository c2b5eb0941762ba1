import math

import numpy as np
import pandas as pd

from tariffa.operators import models
from tariffa.operators.inference import SEED, WEBB

LEVELS = ("none", "pe", "other", "tiny")


def data():
    rng = np.random.default_rng(9)
    rows = []
    for cell, n in (("a", 400), ("b", 90), ("c", 6)):
        for _ in range(n):
            group = rng.choice(LEVELS, p=[0.6, 0.2, 0.195, 0.005])
            cluster = f"s{rng.integers(25)}"
            state = f"st{rng.integers(7)}"
            rows.append((cell, group, cluster, state, "same" if cell == "b" else rng.choice(["x", "y"]), float(rng.normal(0, 0.4) + 0.3 * (group == "pe") + 0.1 * int(state[2]) + 0.02 * int(cluster[1:]))))
    rows += [("a", "odd", "s1", "st1", "x", 1.0), ("a", "pe", None, "st1", "x", 1.0), ("a", "pe", "s1", None, "x", 1.0), ("a", "pe", "s1", "st1", "x", None)]
    rows += [("d", g, "s1" if g == "pe" else f"s{i}", "st0", "x", float(i % 7)) for i, g in enumerate(["none"] * 9 + ["pe"] * 5 + ["other"] * 6)]
    return pd.DataFrame(rows, columns=["cell", "grp", "cl", "st", "kind", "y"])


def plain(frame, draws):
    """(cell, term) to estimate, error, n, clusters, p of the bootstrap, and a test at any null; each draw is a regression of its own."""
    out = {}
    for cell, rows in frame[frame.grp.isin(LEVELS)].dropna().groupby("cell"):
        sizes = rows.grp.value_counts()
        rows = rows[rows.grp.map(sizes).ge(3) | (rows.grp == "none")]
        if sizes.get("none", 0) < 3 or rows.grp.nunique() < 2 or rows.cl.nunique() < 3:
            continue
        names, columns = ["one"], [np.ones(len(rows))]
        for c, levels in (("grp", [x for x in LEVELS if x in set(rows.grp)]), ("st", sorted(set(rows.st))), ("kind", sorted(set(rows.kind)))):
            for level in levels[1:]:
                names.append(level)
                columns.append((rows[c] == level).to_numpy(float))
        x, y = np.stack(columns, 1), rows.y.to_numpy()
        code, clusters = pd.factorize(rows.cl, sort=True)
        g, (n, k) = len(clusters), x.shape
        inverse = np.linalg.inv(x.T @ x)
        factor = g / (g - 1) * (n - 1) / (n - k)

        def fit(v, x=x, inverse=inverse, code=code, g=g, factor=factor):
            b = inverse @ (x.T @ v)
            s = np.zeros((g, x.shape[1]))
            np.add.at(s, code, x * (v - x @ b)[:, None])
            return b, np.sqrt(np.diag(factor * inverse @ (s.T @ s) @ inverse))

        b, se = fit(y)
        for term in LEVELS[1:]:
            if term in names:
                j = names.index(term)

                def test(null, j=j, x=x, y=y, g=g, code=code, b=b, se=se, fit=fit):
                    z = np.delete(x, j, 1)
                    y0 = y - null * x[:, j]
                    fitted = z @ np.linalg.lstsq(z, y0, rcond=None)[0]
                    beyond = 0
                    for part in range(-(-draws // models.CHUNK_DRAWS)):
                        w = WEBB[np.random.default_rng([SEED, part]).integers(0, 6, (g, min(models.CHUNK_DRAWS, draws - part * models.CHUNK_DRAWS)))]
                        for v in w.T:
                            bb, ss = fit(fitted + (y0 - fitted) * v[code])
                            beyond += abs(bb[j] / ss[j]) >= abs((b[j] - null) / se[j]) - 1e-12
                    return beyond / draws

                out[cell, term] = (b[j], se[j], n, g, test)
    return out


def test_models_equal_one_process(spark, monkeypatch):
    monkeypatch.setattr(models, "CHUNK_DRAWS", 40)
    frame = data()
    rows = spark.createDataFrame([tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in frame.itertuples(index=False)], "cell string, grp string, cl string, st string, kind string, y double").repartition(5)
    series = [{"cell": "a", "term": "pe"}, {"cell": "b", "term": "pe"}, {"cell": "b", "term": "other"}, {"cell": "d", "term": "pe"}, {"cell": "none of them", "term": "pe"}]
    got = {(r.cell, r.term): r for r in models.group_models(rows, ["cell"], "y", "grp", LEVELS, "cl", ["st", "kind"], series, draws=99, chunk_rows=50).collect()}
    want = plain(frame, 99)
    assert {k for k, r in got.items() if r.estimate is not None} == set(want)
    for key, (b, se, n, g, _) in want.items():
        r = got[key]
        assert abs(r.estimate - b) < 1e-9 and abs(r.std_error - se) < 1e-9 and (r.n, r.n_clusters) == (n, g)
        assert abs(r.pct_estimate - math.expm1(b)) < 1e-9
    for key in (("a", "pe"), ("b", "pe"), ("b", "other")):
        r, test = got[key], want[key][-1]
        assert r.wcr_p_value == test(0.0)
        for end, out in ((r.wcr_ci_low, -1), (r.wcr_ci_high, 1)):
            assert test(end - out * 1e-6) > 0.05 >= test(end + out * 1e-6)
    assert {k for k, r in got.items() if r.wcr_p_value is not None} == {("a", "pe"), ("b", "pe"), ("b", "other")}
    assert got["d", "pe"].note == "one cluster, so no error" and got["d", "pe"].ci_low is None and got["d", "pe"].estimate is not None
    assert all("not estimated" in got[k].note for k in got if got[k].estimate is None)


def test_combinations_of_columns_go():
    x = np.eye(5)[:, [0, 1, 1, 2]]
    x = np.hstack([x, x.sum(1, keepdims=True), np.zeros((5, 1))])
    assert models.independent(x.T @ x).tolist() == [0, 1, 3]


def test_no_rows(spark):
    assert models.group_models(spark.createDataFrame([], "cell string, grp string, cl string, y double"), ["cell"], "y", "grp", LEVELS, "cl", draws=10, series=[{"term": "pe"}]).collect() == []


def places():
    rng = np.random.default_rng(4)
    rows = []
    for i in range(240):
        state, x = f"s{i % 13}", float(rng.normal())
        births = float(rng.integers(5, 400))
        p = 1 / (1 + math.exp(-(-1 + 0.4 * x + 0.1 * (i % 13))))
        rows.append(("a" if i % 3 else "b", state, x, 2 * x - 1 if i % 3 else float(rng.normal()), births, float(rng.binomial(int(births), p))))
    return pd.DataFrame(rows, columns=["cell", "st", "x", "z", "births", "part"])


def one_process(rows):
    levels = sorted(set(rows.st))[1:]
    x = np.stack([np.ones(len(rows)), rows.x, rows.z, *((rows.st == s).to_numpy(float) for s in levels)], 1)
    kept = [j for j in range(x.shape[1]) if j == 0 or np.linalg.matrix_rank(x[:, : j + 1]) > np.linalg.matrix_rank(x[:, :j])]
    return x[:, kept], pd.factorize(rows.st, sort=True)[0], kept


def test_weighted_models_equal_one_process(spark):
    from tariffa.operators import inference

    frame = places()
    frame["rate"] = 100 * frame.part / frame.births
    rows = spark.createDataFrame([*map(tuple, frame.itertuples(index=False)), ("a", None, 1.0, 1.0, 2.0, 1.0, 1.0)], "cell string, st string, x double, z double, births double, part double, rate double").repartition(4)
    linear = {(r.cell, r.term): r for r in models.linear_models(rows, ["cell"], "rate", ["x", "z"], "st", ["st"], "births", draws=199, chunk_rows=30).collect()}
    odds = {(r.cell, r.term): r for r in models.share_models(rows, ["cell"], "part", "births", ["x", "z"], "st", ["st"], chunk_rows=30).collect()}
    assert set(linear) == set(odds) == {("a", "x"), ("b", "x"), ("b", "z")}  # z is made of x in a
    for cell in ("a", "b"):
        own = frame[frame.cell == cell]
        x, cluster, kept = one_process(own)
        root = np.sqrt(own.births.to_numpy())
        b, se, g = inference.cluster_ols(own.rate.to_numpy() * root, x * root[:, None], cluster)
        q, qe, effect = inference.quasibinomial((own.part / own.births).to_numpy(), x, own.births.to_numpy(), cluster)
        for name, j in (("x", 1), ("z", 2)):
            if (cell, name) in linear:
                r, o = linear[cell, name], odds[cell, name]
                assert abs(r.estimate - b[j]) < 1e-8 and abs(r.std_error - se[j]) < 1e-8 and (r.n, r.n_clusters, r.n_identifying) == (len(own), g, 13)
                assert r.wcr_ci_low < r.estimate < r.wcr_ci_high and 0 <= r.wcr_p_value <= 1
                assert abs(o.log_odds - q[j]) < 1e-7 and abs(o.std_error - qe[j]) < 1e-7 and abs(o.marginal - effect[j]) < 1e-7
