"""Models of groups by cell with clustered errors and a wild cluster bootstrap, shared out over the cluster.

A cell (a code, payer type and definition, say) has one regression of y on its groups and factors. Its rows are never in one
task: chunks of whole clusters add up the normal equations, then the squared scores of clusters, and for the terms that are
bootstrapped each cluster becomes a few sums. Draws are dealt in chunks to tasks too; a draw is five numbers, from which
the test at any null, and so the interval by inverting it, follows in one step (as Roodman, Nielsen, MacKinnon and Webb
showed in 2019). Only matrices of a cell's columns, sums of one term's clusters and numbers of draws meet in one place.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffa.lineage import cut
from tariffa.operators.inference import BOOTSTRAPS, LEAST_GROUP, LEVEL, SEED, WEBB, t_quantile, t_two_sided

#: Rows of a chunk, draws of a chunk, numbers of a draw block that are held at once.
CHUNK_ROWS, CHUNK_DRAWS, HELD = 20_000, 1000, 4_000_000
#: A column counts as a combination of those before it when less than this part of its square is left.
COLLINEAR = 1e-9


def independent(gram: np.ndarray) -> np.ndarray:
    """Places of the columns that aren't combinations of the ones before them, from their cross products."""
    kept: list[int] = []
    for j in range(len(gram)):
        left = gram[j, j]
        if kept:
            left -= gram[j, kept] @ np.linalg.solve(gram[np.ix_(kept, kept)], gram[kept, j])
        if gram[j, j] > 0 and left > COLLINEAR * gram[j, j]:
            kept.append(j)
    return np.array(kept)


def _design(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The columns and y. Constant, numbers if there are any, and a column for each level but the first of each factor (cols: places of a row's ones); with weights w the rows are scaled by their roots."""
    x = np.zeros((len(rows), int(rows["k"].iloc[0])))
    x[:, 0] = 1
    if "numbers" in rows:
        values = np.stack(rows["numbers"].to_numpy())
        x[:, 1 : 1 + values.shape[1]] = values
    at = np.repeat(np.arange(len(rows)), rows["cols"].map(len).to_numpy())
    x[at, np.concatenate(rows["cols"].to_numpy()).astype(int)] = 1
    y = rows["y"].to_numpy(float)
    if "w" in rows:
        root = np.sqrt(rows["w"].to_numpy(float))
        return x * root[:, None], y * root
    return x, y


def _square(raw: bytes) -> np.ndarray:
    values = np.frombuffer(raw, np.float64)
    return values.reshape(math.isqrt(len(values)), -1)


def _without(gram: np.ndarray, xy: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The other columns, the inverse of their cross products, and column j's and y's coefficients on them."""
    others = np.delete(np.arange(len(gram)), j)
    inverse = np.linalg.inv(gram[np.ix_(others, others)])
    return others, inverse, inverse @ gram[others, j], inverse @ xy[others]


def draws_of(sums: np.ndarray, inverse: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Five numbers of each draw: what weights (a column each) make of the coefficient, by the y and by the null's part, and the sums of squares and products of the clusters' scores of both. sums: a row for each cluster: of x y, x x, the other columns' x, and their y, all with the other columns taken out."""
    k = (sums.shape[1] - 2) // 2
    a, d, zx, zy = sums[:, 0], sums[:, 1], sums[:, 2 : 2 + k], sums[:, 2 + k :]
    onto, whole, out = zx @ inverse, sums[:, 1].sum(), np.empty((5, weights.shape[1]))
    step = max(1, HELD // len(sums))
    for at in range(0, weights.shape[1], step):
        v = weights[:, at : at + step]
        of_y, of_null = a @ v / whole, d @ v / whole
        scores = a[:, None] * v - onto @ (zy.T @ v) - np.outer(d, of_y)
        parts = d[:, None] * v - onto @ (zx.T @ v) - np.outer(d, of_null)
        out[:, at : at + step] = of_y, of_null, (scores * scores).sum(0), (scores * parts).sum(0), (parts * parts).sum(0)
    return out


def p_value(draws: np.ndarray, estimate: float, error: float, null: float, factor: float, whole: float) -> float:
    """Share of draws whose t is as far from zero as that of the estimate against the null. factor: of small samples; whole: the squares of the term's own part."""
    of_y, of_null, s, m, p = draws
    spread = np.sqrt(factor * np.maximum(s - 2 * null * m + null * null * p, 0)) / whole
    with np.errstate(divide="ignore", invalid="ignore"):
        t = np.abs((of_y - null * of_null) / spread)
    good = ~np.isnan(t)
    return float((t[good] >= abs(estimate - null) / error - 1e-12).mean()) if good.any() else math.nan


def interval(test, estimate: float, error: float, level: float = LEVEL) -> tuple[float, float]:
    """Ends of the nulls that the test keeps: quarter errors outwards up to twelve, then whole ones up to sixty, then bisection; an end that is never rejected is infinite."""
    ends = []
    for side in (-1.0, 1.0):
        inner, outer = 0.0, math.inf
        for step in [q / 4 for q in range(1, 49)] + list(range(13, 61)):
            if test(estimate + side * step * error) <= 1 - level:
                outer = float(step)
                break
            inner = float(step)
        if math.isfinite(outer):
            for _ in range(40):
                middle = (inner + outer) / 2
                inner, outer = (middle, outer) if test(estimate + side * middle * error) > 1 - level else (inner, middle)
        ends.append(estimate + side * error * (inner + outer) / 2)
    return ends[0], ends[1]


def group_models(rows: DataFrame, cell: Sequence[str], y: str, group: str, levels: Sequence[str], cluster: str, factors: Sequence[str] = (), series: Sequence[dict] = (), draws: int = BOOTSTRAPS, least: int = LEAST_GROUP, chunk_rows: int = CHUNK_ROWS, seed: int = SEED) -> DataFrame:
    """A row for each cell and group but the first of levels, with its effect on y against that one.

    term, n_group, n_group_clusters (of all rows of the group); estimate, std_error, ci_low, ci_high, p_value (t with
    clusters less one degrees of freedom); wcr_p_value, wcr_ci_low, wcr_ci_high of the restricted bootstrap, for the
    cells and terms that an entry of series names ({column: value, ..., "term": value}); n, n_clusters of the fit; note.
    Groups under `least` rows are left out of the fit, as are rows with a null in y, the cluster or a factor; factors with
    one level have no column, and columns that others make up go. Groups of one cluster have an estimate, but no error.
    """
    cell, factors = list(cell), list(factors)
    good = rows.where(F.col(group).isin(*levels) & F.expr(" and ".join(f"`{c}` is not null" for c in [y, cluster, *factors])))
    good = cut(good.select(*cell, F.col(y).cast("double").alias("y"), F.col(group).alias("term"), F.col(cluster).cast("string").alias("cluster"), *(F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(factors))))
    sizes = cut(good.groupBy(*cell, "term").agg(F.count("*").alias("n_group"), F.count_distinct("cluster").alias("n_group_clusters")))
    fit = good.join(sizes.where((F.col("n_group") >= least) | (F.col("term") == levels[0])).select(*cell, "term"), [*cell, "term"])
    # the columns of each cell: its levels, of which there are few
    order = F.filter(F.array(*map(F.lit, levels)), lambda x: F.array_contains("terms", x))
    plan = fit.groupBy(*cell).agg(F.collect_set("term").alias("terms"), F.count("*").alias("n"), F.count_distinct("cluster").alias("n_clusters"), F.sum((F.col("term") == levels[0]).cast("int")).alias("n_reference"), *(F.sort_array(F.collect_set(f"f{i}")).alias(f"l{i}") for i in range(len(factors))))
    plan = cut(plan.withColumn("terms", order).where((F.col("n_reference") >= least) & (F.size("terms") > 1) & (F.col("n_clusters") >= 3)))
    coded = fit.join(plan, cell)
    places, before = [F.array_position("terms", F.col("term")) - 1], F.size("terms").cast("long")
    for i in range(len(factors)):
        at = F.array_position(f"l{i}", F.col(f"f{i}")) - 1
        places.append(F.when(at > 0, at + before - 1).otherwise(0))
        before = before + F.size(f"l{i}") - 1
    coded = cut(coded.select(*cell, _chunk(chunk_rows), "cluster", "y", F.filter(F.array(*places), lambda p: p > 0).alias("cols"), before.alias("k")))
    wanted = F.array(*(F.when(F.expr(" and ".join(f"cast(`{c}` as string) = '{v}'" for c, v in s.items() if c != "term") or "true"), F.lit(s["term"])) for s in series)) if series else F.array().cast("array<string>")
    model, boot = _models(coded, plan.select(*cell, "terms", "n", "n_clusters"), cell, wanted, draws, seed, sizes.where("n_group_clusters > 1").select(*cell, "term"))
    model = sizes.where(F.col("term") != levels[0]).join(model, [*cell, "term"], "left")
    alone = F.col("estimate").isNotNull() & (F.col("n_group_clusters") < 2)
    note = F.when(alone, "one cluster, so no error").when(F.col("n_group") < least, F.lit(f"fewer than {least} rows, so not estimated")).when(F.col("estimate").isNull(), "too few rows of the reference or clusters, so not estimated")
    model = model.withColumns({c: F.when(~alone, F.col(c)) for c in ("ci_low", "ci_high", "p_value")} | {"note": note})
    out = model.join(boot, [*cell, "term"], "left")
    percent = {f"pct_{c}": F.exp(c) - 1 for c in ("estimate", "ci_low", "ci_high", "wcr_ci_low", "wcr_ci_high")}
    return out.withColumns(percent)


def _chunk(chunk_rows: int) -> Column:
    """Chunks hold whole clusters, and about so many rows of a cell of n."""
    return F.pmod(F.xxhash64("cluster"), F.ceil(F.col("n") / chunk_rows)).alias("chunk")


def _head(df: DataFrame, cell: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in cell)


def _models(coded: DataFrame, plan: DataFrame, cell: list[str], wanted: Column, draws: int, seed: int, able: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Estimates and bootstraps of the terms of cells. coded: cell, chunk, cluster, y, cols, k, perhaps numbers and w. plan: cell, terms (in the order of the columns, the first being the constant), n, n_clusters. able: the terms that may be bootstrapped."""
    head = _head(coded, cell)

    def sums(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        x, v = _design(part)
        return pd.DataFrame([(*key, (x.T @ x).tobytes(), (x.T @ v).tobytes())], columns=[*cell, "chunk", "xx", "xy"])

    def solve(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values("chunk")
        gram, xy = sum(map(_square, parts["xx"])), sum(np.frombuffer(r, np.float64) for r in parts["xy"])
        kept = independent(gram)
        gram, xy = gram[np.ix_(kept, kept)], xy[kept]
        return pd.DataFrame([(*key, kept.astype(np.int64).tobytes(), gram.tobytes(), xy.tobytes(), sorted(parts["chunk"]))], columns=[*cell, "kept", "xx", "xy", "chunks"])

    solved = coded.groupBy(*cell, "chunk").applyInPandas(sums, f"{head}, chunk long, xx binary, xy binary")
    solved = solved.groupBy(*cell).applyInPandas(solve, f"{head}, kept binary, xx binary, xy binary, chunks array<long>")
    solved = cut(solved.join(plan, cell))
    solved = solved.withColumn("wanted", F.array_distinct(F.filter(wanted, lambda w: w.isNotNull()))) if draws else solved.withColumn("wanted", F.array().cast("array<string>"))

    def scored(key: tuple, part: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        one = known.iloc[0]
        kept, gram, xy = np.frombuffer(one["kept"], np.int64), _square(one["xx"]), np.frombuffer(one["xy"], np.float64)
        x, v = _design(part)
        x = x[:, kept]
        left = v - x @ np.linalg.solve(gram, xy)
        code, names = pd.factorize(part["cluster"], sort=True)

        def by_cluster(values: np.ndarray) -> np.ndarray:
            out = np.zeros((len(names), values.shape[1]))
            np.add.at(out, code, values)
            return out

        s = by_cluster(x * left[:, None])
        out = [(*key[:-1], None, None, (s.T @ s).tobytes())]
        for term in one["wanted"]:
            place = list(one["terms"]).index(term) if term in one["terms"] else -1
            if place < 1 or place not in kept:
                continue
            j = int(np.flatnonzero(kept == place)[0])
            others, _, on_x, on_y = _without(gram, xy, j)
            z = x[:, others]
            own, rest = x[:, j] - z @ on_x, v - z @ on_y
            each = by_cluster(np.hstack([(own * rest)[:, None], (own * own)[:, None], z * own[:, None], z * rest[:, None]]))
            out += [(*key[:-1], term, name, row.tobytes()) for name, row in zip(names, each, strict=True)]
        return pd.DataFrame(out, columns=[*cell, "term", "cluster", "sums"])

    each = solved.select("*", F.explode("chunks").alias("chunk"))
    parts = cut(coded.groupBy(*cell, "chunk").cogroup(each.groupBy(*cell, "chunk")).applyInPandas(scored, f"{head}, term string, cluster string, sums binary"))

    def factor(one: pd.Series, k: int) -> float:
        g, n = int(one["n_clusters"]), int(one["n"])
        return g / (g - 1) * (n - 1) / (n - k) if n > k else math.nan

    def estimated(key: tuple, meats: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        one = known.iloc[0]
        kept, inverse, xy = np.frombuffer(one["kept"], np.int64), np.linalg.inv(_square(one["xx"])), np.frombuffer(one["xy"], np.float64)
        b = inverse @ xy
        errors = np.sqrt(np.maximum(np.diag(factor(one, len(b)) * inverse @ sum(map(_square, sorted(meats["sums"]))) @ inverse), 0))
        out = []
        for place, term in enumerate(one["terms"]):
            if place and place in kept:
                j, df = int(np.flatnonzero(kept == place)[0]), int(one["n_clusters"]) - 1
                reach = t_quantile(0.5 + LEVEL / 2, df) * errors[j]
                p = t_two_sided(b[j] / errors[j], df) if errors[j] > 0 else math.nan
                out.append((*key, term, b[j], errors[j], b[j] - reach, b[j] + reach, p, int(one["n"]), int(one["n_clusters"])))
        return pd.DataFrame(out, columns=[*cell, "term", "estimate", "std_error", "ci_low", "ci_high", "p_value", "n", "n_clusters"])

    model = parts.where("term is null").groupBy(*cell).cogroup(solved.groupBy(*cell)).applyInPandas(estimated, f"{head}, term string, estimate double, std_error double, ci_low double, ci_high double, p_value double, n long, n_clusters long")

    n_chunks = -(-draws // CHUNK_DRAWS)

    def drawn(key: tuple, clusters: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(clusters) or not len(known):
            return pd.DataFrame([], columns=[*cell, "term", "part", "numbers", "estimate", "error", "factor", "whole"])
        one, term, part = known.iloc[0], key[-2], int(key[-1])
        kept, gram, xy = np.frombuffer(one["kept"], np.int64), _square(one["xx"]), np.frombuffer(one["xy"], np.float64)
        j = int(np.flatnonzero(kept == list(one["terms"]).index(term))[0])
        _, inverse, _, _ = _without(gram, xy, j)
        own = np.stack([np.frombuffer(r, np.float64) for r in clusters.sort_values("cluster")["sums"]])
        weights = WEBB[np.random.default_rng([seed, part]).integers(0, 6, (len(own), min(CHUNK_DRAWS, draws - part * CHUNK_DRAWS)))]
        whole = own[:, 1].sum()
        estimate, more = own[:, 0].sum() / whole, factor(one, len(gram))
        error = math.sqrt(more * ((own[:, 0] - estimate * own[:, 1]) ** 2).sum()) / whole
        return pd.DataFrame([(*key[:-2], term, part, draws_of(own, inverse, weights).tobytes(), estimate, error, more, whole)], columns=[*cell, "term", "part", "numbers", "estimate", "error", "factor", "whole"])

    def inverted(key: tuple, made: pd.DataFrame) -> pd.DataFrame:
        made = made.sort_values("part")
        one = made.iloc[0]
        numbers = np.hstack([np.frombuffer(r, np.float64).reshape(5, -1) for r in made["numbers"]])
        test = lambda null: p_value(numbers, one["estimate"], one["error"], null, one["factor"], one["whole"])
        return pd.DataFrame([(*key, test(0.0), *interval(test, one["estimate"], one["error"]))], columns=[*cell, "term", "wcr_p_value", "wcr_ci_low", "wcr_ci_high"])

    of_parts = lambda df: df.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(max(n_chunks - 1, 0)))))
    several = parts.where("term is not null")
    if able is not None:
        several = several.join(able, [*cell, "term"], "left_semi")
    asked = solved.select("*", F.explode("wanted").alias("term"))
    by = [*cell, "term", "part"]
    numbers = of_parts(several).groupBy(*by).cogroup(of_parts(asked).groupBy(*by)).applyInPandas(drawn, f"{head}, term string, part int, numbers binary, estimate double, error double, factor double, whole double")
    boot = numbers.groupBy(*cell, "term").applyInPandas(inverted, f"{head}, term string, wcr_p_value double, wcr_ci_low double, wcr_ci_high double")
    return model, boot


def _coded_numbers(rows: DataFrame, cell: list[str], y: Column, numbers: Sequence[str], cluster: str, factors: Sequence[str], weight: str | None, chunk_rows: int) -> tuple[DataFrame, DataFrame]:
    """Complete rows as columns of a design, and the plan of each cell; also how many clusters have two rows or more."""
    need = [*numbers, cluster, *factors, *([weight] if weight else [])]
    good = rows.withColumn("__y", y.cast("double")).where(F.expr(" and ".join(f"`{c}` is not null" for c in ["__y", *need])))
    good = cut(good.select(*cell, F.col("__y").alias("y"), F.array(*(F.col(c).cast("double") for c in numbers)).alias("numbers"), F.col(cluster).cast("string").alias("cluster"), *(F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(factors)), *([F.col(weight).cast("double").alias("w")] if weight else [])))
    by_cluster = good.groupBy(*cell, "cluster").agg(F.count("*").alias("m")).groupBy(*cell).agg(F.sum("m").alias("n"), F.count("*").alias("n_clusters"), F.sum((F.col("m") > 1).cast("long")).alias("n_identifying"))
    levels = good.groupBy(*cell).agg(F.count("*").alias("__n"), *(F.sort_array(F.collect_set(f"f{i}")).alias(f"l{i}") for i in range(len(factors)))).drop("__n")
    plan = cut(by_cluster.where("n_clusters > 1").join(levels, cell).withColumn("terms", F.array(*map(F.lit, ["", *numbers]))))
    places, before = [], F.lit(1 + len(numbers)).cast("long")
    for i in range(len(factors)):
        at = F.array_position(f"l{i}", F.col(f"f{i}")) - 1
        places.append(F.when(at > 0, at + before - 1).otherwise(0))
        before = before + F.size(f"l{i}") - 1
    ones = F.filter(F.array(*places), lambda p: p > 0) if places else F.array().cast("array<long>")
    coded = good.join(plan, cell).select(*cell, _chunk(chunk_rows), "cluster", "y", "numbers", *(["w"] if weight else []), ones.alias("cols"), before.alias("k"))
    return cut(coded), plan


def linear_models(rows: DataFrame, cell: Sequence[str], y: str, numbers: Sequence[str], cluster: str, factors: Sequence[str] = (), weight: str | None = None, draws: int = BOOTSTRAPS, chunk_rows: int = CHUNK_ROWS, seed: int = SEED) -> DataFrame:
    """For each cell and number its slope with weights and fixed effects (factors), as group_models gives it: errors by cluster, restricted bootstrap and its interval; n_identifying: clusters with two rows or more.

    Weighted squares are plain ones of rows scaled by the root of their weight. Numbers and levels that earlier columns
    make up go; a number that goes has no row. Rows with a null anywhere are left out.
    """
    cell = list(cell)
    coded, plan = _coded_numbers(rows, cell, F.col(y), numbers, cluster, factors, weight, chunk_rows)
    model, boot = _models(coded, plan.select(*cell, "terms", "n", "n_clusters"), cell, F.array(*map(F.lit, numbers)), draws, seed)
    return model.join(boot, [*cell, "term"], "left").join(plan.select(*cell, "n_identifying"), cell)


def share_models(rows: DataFrame, cell: Sequence[str], part: str, whole: str, numbers: Sequence[str], cluster: str, factors: Sequence[str] = (), level: float = LEVEL, most: int = 50, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """For each cell and number its effect on the log odds of part / whole (quasi-binomial, weighted by whole), with errors by cluster, and the average marginal effect on the share.

    Reweighted least squares: each step adds up the normal equations of chunks; coefficients are a small table. It ends
    when no coefficient moves by 1e-10, after `most` steps at the latest.
    """
    cell = list(cell)
    head = _head(rows, cell)
    weighted = rows.where(F.col(whole) > 0).withColumn("__whole", F.col(whole).cast("double"))
    coded, plan = _coded_numbers(weighted, cell, F.col(part) / F.col(whole), numbers, cluster, factors, "__whole", chunk_rows)

    def parts_of(part: pd.DataFrame, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        x, _ = _design(part.drop(columns="w"))
        w = part["w"].to_numpy(float)
        mean = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        return x, w, part["y"].to_numpy(float) - mean, mean * (1 - mean)

    def stepped(key: tuple, part: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        x, w, left, spread = parts_of(part, np.frombuffer(known["b"].iloc[0], np.float64))
        return pd.DataFrame([(*key, ((x * (w * spread)[:, None]).T @ x).tobytes(), (x.T @ (w * left)).tobytes())], columns=[*cell, "chunk", "xx", "xy"])

    def moved(key: tuple, sums: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        sums = sums.sort_values("chunk")
        gram, score = sum(map(_square, sums["xx"])), sum(np.frombuffer(r, np.float64) for r in sums["xy"])
        kept = independent(gram)
        step = np.zeros(len(gram))
        step[kept] = np.linalg.solve(gram[np.ix_(kept, kept)], score[kept])
        b = np.frombuffer(known["b"].iloc[0], np.float64) + step
        return pd.DataFrame([(*key, b.tobytes(), kept.astype(np.int64).tobytes(), gram.tobytes(), float(np.abs(step).max()), sorted(sums["chunk"]))], columns=[*cell, "b", "kept", "xx", "moved", "chunks"])

    schema = f"{head}, b binary, kept binary, xx binary, moved double, chunks array<long>"
    start = coded.groupBy(*cell).agg(F.max("k").alias("k"), F.sort_array(F.collect_set("chunk")).alias("chunks"))
    now = cut(start.select(*cell, F.unhex(F.expr("repeat('00', cast(8 * k as int))")).alias("b"), "chunks"))
    for _ in range(most):
        each = now.select("*", F.explode("chunks").alias("chunk"))
        sums = coded.groupBy(*cell, "chunk").cogroup(each.groupBy(*cell, "chunk")).applyInPandas(stepped, f"{head}, chunk long, xx binary, xy binary")
        now = cut(sums.groupBy(*cell).cogroup(now.groupBy(*cell)).applyInPandas(moved, schema))
        if not (now.agg(F.max("moved")).first()[0] or 0) > 1e-10:
            break

    def scored(key: tuple, part: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        x, w, left, spread = parts_of(part, np.frombuffer(known["b"].iloc[0], np.float64))
        code, names = pd.factorize(part["cluster"], sort=True)
        s = np.zeros((len(names), x.shape[1]))
        np.add.at(s, code, x * (w * left)[:, None])
        return pd.DataFrame([(*key, (s.T @ s).tobytes(), float((w * spread).sum()), float(w.sum()), len(part), len(names))], columns=[*cell, "chunk", "meat", "spread", "w", "rows", "g"])

    def estimated(key: tuple, sums: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        sums, one, out = sums.sort_values("chunk"), known.iloc[0], []
        b, kept = np.frombuffer(one["b"], np.float64), np.frombuffer(one["kept"], np.int64)
        bread = np.linalg.inv(_square(one["xx"])[np.ix_(kept, kept)])
        g, n, k = int(sums["g"].sum()), int(sums["rows"].sum()), len(kept)
        more = g / (g - 1) * (n - 1) / (n - k) if n > k else math.nan
        errors = np.sqrt(np.maximum(np.diag(more * bread @ sum(map(_square, sums["meat"]))[np.ix_(kept, kept)] @ bread), 0))
        for place, name in enumerate(numbers, 1):
            if place in kept:
                j = int(np.flatnonzero(kept == place)[0])
                reach = t_quantile(0.5 + level / 2, g - 1) * errors[j]
                out.append((*key, name, b[place], errors[j], b[place] - reach, b[place] + reach, t_two_sided(b[place] / errors[j], g - 1), b[place] * sums["spread"].sum() / sums["w"].sum(), n, g))
        return pd.DataFrame(out, columns=[*cell, "term", "log_odds", "std_error", "ci_low", "ci_high", "p_value", "marginal", "n", "n_clusters"])

    each = now.select("*", F.explode("chunks").alias("chunk"))
    sums = coded.groupBy(*cell, "chunk").cogroup(each.groupBy(*cell, "chunk")).applyInPandas(scored, f"{head}, chunk long, meat binary, spread double, w double, rows long, g long")
    return sums.groupBy(*cell).cogroup(now.groupBy(*cell)).applyInPandas(estimated, f"{head}, term string, log_odds double, std_error double, ci_low double, ci_high double, p_value double, marginal double, n long, n_clusters long")
