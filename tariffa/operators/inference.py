"""Regression with clustered errors, by groups: least squares, wild cluster bootstrap, quasi-binomial logit.

Each group's rows go to one task as a design of a few columns. A model's cell is bounded by the number of hospitals, not
of rates; larger tables are summed to hospitals first.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BOOTSTRAPS, LEVEL, SEED, LEAST_GROUP = 9999, 0.95, 20260913, 3
#: Weights of a bootstrap that are held at once.
HELD = 1_000_000
#: Six-point weights of mean 0 and variance 1. Fixed values.
WEBB = np.array([-math.sqrt(1.5), -1.0, -math.sqrt(0.5), math.sqrt(0.5), 1.0, math.sqrt(1.5)])


def _beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_inc(b, a, 1 - x)
    front = math.exp(a * math.log(x) + b * math.log1p(-x) - (math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b))) / a
    c, d = 1.0, 1 / max(1 - (a + b) * x / (a + 1), 1e-300)
    f = d
    for m in range(1, 500):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + num * d
            d = 1 / (d if abs(d) > 1e-300 else 1e-300)
            c = 1 + num / (c if abs(c) > 1e-300 else 1e-300)
            f *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return front * f


def t_two_sided(t: float, df: float) -> float:
    return _beta_inc(df / 2, 0.5, df / (df + t * t)) if math.isfinite(t) else 0.0


def t_quantile(p: float, df: float) -> float:
    """Upper quantile by bisection."""
    low, high = 0.0, 1e6
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - t_two_sided(mid, df) / 2 < p else (low, mid)
    return (low + high) / 2


def _cluster_sums(scores: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    out = np.zeros((cluster.max() + 1, scores.shape[1]))
    np.add.at(out, cluster, scores)
    return out


def cluster_ols(y: np.ndarray, x: np.ndarray, cluster: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Coefficients, standard errors robust to clusters (with the usual small-sample factor), and the number of clusters."""
    n, k = x.shape
    inverse = np.linalg.pinv(x.T @ x)
    b = inverse @ (x.T @ y)
    s = _cluster_sums(x * (y - x @ b)[:, None], cluster)
    g = len(s)
    factor = g / (g - 1) * (n - 1) / (n - k) if g > 1 and n > k else math.nan
    v = factor * inverse @ (s.T @ s) @ inverse
    return b, np.sqrt(np.maximum(np.diag(v), 0)), g


def wild_bootstraps(y: np.ndarray, x: np.ndarray, terms: Sequence[int], cluster: np.ndarray, draws: int = BOOTSTRAPS, seed: int = SEED, null: float = 0.0, chunk: int = 1000, held: int = HELD) -> list[float]:
    """p values of coefficients by the wild cluster bootstrap with the null imposed, all from the same weights.

    A draw moves what a model leaves of y, so a cluster is its sums of that and of its columns' products, whatever its
    rows. The draws go in chunks, of which `held` weights are kept at a time: the generator is set back for a second look.
    """
    b, se, g = cluster_ols(y, x, cluster)
    n, k = x.shape
    inverse = np.linalg.pinv(x.T @ x)
    factor = math.sqrt(g / (g - 1) * (n - 1) / (n - k))
    models = []
    for term in terms:
        others = np.delete(x, term, 1)
        y0 = y - null * x[:, term]
        fit = others @ (np.linalg.pinv(others.T @ others) @ (others.T @ y0))
        row = inverse[term]
        sums = _cluster_sums(x * (y0 - fit)[:, None], cluster)
        models.append((abs((b[term] - null) / se[term]), row @ (x.T @ fit), sums, sums @ row, _cluster_sums(x * (x @ row)[:, None], cluster)))
    rng, beyond, done = np.random.default_rng(seed), [0] * len(models), 0
    while done < draws:
        m = min(chunk, draws - done)
        step = max(1, held // m)
        blocks = [slice(at, min(at + step, g)) for at in range(0, g, step)]
        weights = lambda block: WEBB[rng.integers(0, 6, (block.stop - block.start, m))]
        state, moved = rng.bit_generator.state, [0.0] * len(models)
        for block in blocks:
            w = weights(block)
            moved = [was + sums[block].T @ w for was, (*_, sums, _, _) in zip(moved, models, strict=True)]
        moved = [inverse @ by for by in moved]
        squares = [np.zeros(m) for _ in models]
        if len(blocks) > 1:
            rng.bit_generator.state = state
        for block in blocks:
            w = weights(block) if len(blocks) > 1 else w
            for square, by, (*_, own, onto) in zip(squares, moved, models, strict=True):
                scores = own[block, None] * w
                scores -= onto[block] @ by
                square += np.einsum("ij,ij->j", scores, scores)
        for i, (observed, start, *_) in enumerate(models):
            ts = (start + moved[i][terms[i]]) / np.maximum(factor * np.sqrt(squares[i]), 1e-300)
            beyond[i] += int((np.abs(ts) >= observed - 1e-12).sum())
        done += m
    return [found / draws for found in beyond]


def wild_bootstrap(y: np.ndarray, x: np.ndarray, term: int, cluster: np.ndarray, draws: int = BOOTSTRAPS, seed: int = SEED, null: float = 0.0, chunk: int = 1000) -> float:
    """p value of one coefficient."""
    return wild_bootstraps(y, x, [term], cluster, draws, seed, null, chunk)[0]


def bootstrap_interval(y, x, term: int, cluster, draws: int = 999, seed: int = SEED, level: float = LEVEL) -> tuple[float, float]:
    """Values of the coefficient that the bootstrap doesn't reject: steps of a quarter error outwards, then of one, then bisection."""
    b, se, _ = cluster_ols(y, x, cluster)
    kept = lambda v: wild_bootstrap(y, x, term, cluster, draws, seed, v) >= 1 - level
    ends = []
    for side in (-1, 1):
        steps = [i / 4 for i in range(1, 49)] + list(range(13, 61))
        inner = 0.0
        for s in steps:
            if not kept(b[term] + side * s * se[term]):
                outer = s
                break
            inner = s
        else:
            ends.append(side * math.inf)
            continue
        for _ in range(40):
            mid = (inner + outer) / 2
            inner, outer = (mid, outer) if kept(b[term] + side * mid * se[term]) else (inner, mid)
            if outer - inner < 1e-6:
                break
        ends.append(b[term] + side * inner * se[term])
    return ends[0], ends[1]


def quasibinomial(y: np.ndarray, x: np.ndarray, weight: np.ndarray, cluster: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logit of shares with weights by reweighted least squares: coefficients, clustered errors, average marginal effects."""
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        w = weight * p * (1 - p)
        step = np.linalg.pinv((x * w[:, None]).T @ x) @ (x.T @ (weight * (y - p)))
        b = b + step
        if np.abs(step).max() < 1e-10:
            break
    p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
    bread = np.linalg.pinv((x * (weight * p * (1 - p))[:, None]).T @ x)
    s = _cluster_sums(x * (weight * (y - p))[:, None], cluster)
    g, (n, k) = len(s), x.shape
    v = g / max(g - 1, 1) * (n - 1) / max(n - k, 1) * bread @ (s.T @ s) @ bread
    return b, np.sqrt(np.maximum(np.diag(v), 0)), b * np.average(p * (1 - p), weights=weight)


def design(rows: pd.DataFrame, group: str, reference: str, factors: Sequence[str], numbers: Sequence[str]) -> tuple[np.ndarray, list[str], list[str]]:
    """Constant, a column for each group but the reference, dummies of factors, numbers; single-level covariates go. Also names and the groups too small to estimate."""
    sizes = rows[group].value_counts()
    small = [g for g in sizes.index if sizes[g] < LEAST_GROUP and g != reference]
    names, columns = ["constant"], [np.ones(len(rows))]
    for g in sorted(set(sizes.index) - {reference, *small}):
        names.append(g)
        columns.append((rows[group] == g).to_numpy(float))
    for f in factors:
        for level in sorted(rows[f].dropna().unique())[1:]:
            names.append(f"{f}={level}")
            columns.append((rows[f] == level).to_numpy(float))
    for c in numbers:
        if rows[c].nunique() > 1:
            names.append(c)
            columns.append(rows[c].to_numpy(float))
    return np.stack(columns, 1), names, small


def group_models(df: DataFrame, cell: Sequence[str], y: str, group: str, reference: str, cluster: str, factors: Sequence[str] = (), numbers: Sequence[str] = (), draws: int = 0) -> DataFrame:
    """For each cell and group the effect on log y against the reference, its clustered interval and p (bootstrapped with draws); groups under three aren't estimated."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in cell) + ", term string, estimate double, std_error double, low double, high double, p_value double, p_bootstrap double, pct double, n long, n_group long, n_group_clusters long, n_clusters long, status string"
    need = [*cell, y, group, cluster, *factors, *numbers]

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.dropna(subset=[y, group, cluster, *factors, *numbers])
        rows = rows[rows[y] > 0].sort_values(list(rows.columns), ignore_index=True)
        out, several = [], {}
        add = lambda **v: out.append(dict(zip(cell, key, strict=True)) | dict.fromkeys(("estimate", "std_error", "low", "high", "p_value", "p_bootstrap", "pct"), math.nan) | v)
        if len(rows):
            ids = pd.factorize(rows[cluster], sort=True)[0]
            x, names, small = design(rows, group, reference, factors, numbers)
            counts = rows[group].value_counts()
            able = len(rows) > x.shape[1] and ids.max() > 0 and reference in counts.index
            if able:
                b, se, g = cluster_ols(np.log(rows[y].to_numpy(float)), x, ids)
            for name in sorted(set(counts.index) - {reference}):
                own = {"term": str(name), "n": len(rows), "n_group": int(counts[name]), "n_group_clusters": int(rows[rows[group] == name][cluster].nunique()), "n_clusters": int(ids.max() + 1)}
                if not able or name in small:
                    add(**own, status="not estimated")
                    continue
                i = names.index(name)
                alone = rows[rows[group] == name][cluster].nunique() < 2
                reach = math.nan if alone else t_quantile(0.5 + LEVEL / 2, g - 1) * se[i]
                p = t_two_sided(b[i] / se[i], g - 1) if se[i] > 0 and not alone else math.nan
                if not alone:
                    several[i] = len(out)
                add(**own, estimate=b[i], std_error=se[i], low=b[i] - reach, high=b[i] + reach, p_value=p, pct=100 * math.expm1(b[i]), status="one cluster" if alone else "estimated")
            if draws and several:
                for at, p in zip(several.values(), wild_bootstraps(np.log(rows[y].to_numpy(float)), x, list(several), ids, draws), strict=True):
                    out[at]["p_bootstrap"] = p
        columns = [*cell, "term", "estimate", "std_error", "low", "high", "p_value", "p_bootstrap", "pct", "n", "n_group", "n_group_clusters", "n_clusters", "status"]
        return pd.DataFrame(out, columns=columns)

    return df.select(*need).groupBy(*cell).applyInPandas(fit, schema)


def with_flags(models: DataFrame, clusters: int = 5, members: int = 10) -> DataFrame:
    """exploratory: too few clusters of the group, or members."""
    return models.withColumn("exploratory", (F.col("n_group_clusters") < clusters) | (F.col("n_group") < members))
