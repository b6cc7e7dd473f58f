"""Least squares, the mean baseline, and regression metrics, each one aggregate.

Models over many levels of categories are fitted without one-hot columns: products of
two dense columns, sums of dense columns by level, and counts of levels that meet are
the blocks of a sparse Gram matrix, each summed by key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.scalars import finite
from tideline.sources.scratch import keep


def least_squares(rows: DataFrame, features: list[str], target: str) -> tuple[float, dict[str, float]]:
    """Intercept and coefficients of ordinary least squares over dense columns (ML-06).

    The normal equations come from one pass.  Collinear columns have the solution of
    least norm.  Rows must have no null.
    """
    return fit_linear(rows, features, {}, target)


@dataclass
class Gram:
    """Sums over rows: ``dense`` of products of two of (1, columns, target); for each category
    ``levels``, a row for each level with the sums of (1, columns, target) where it stands;
    ``pairs`` of two categories as (level, level, rows)."""

    dense: np.ndarray
    levels: list[np.ndarray]
    pairs: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _merged(keys: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of equal ``keys`` added up."""
    order = np.lexsort(keys.T[::-1])
    keys, sums = keys[order], sums[order]
    first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)]) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(sums, first) if len(first) else sums


def gram(rows: DataFrame, dense: list[str], categories: dict[str, list[str]], target: str) -> Gram:
    """One pass over ``rows``, whose dense columns and target have no null; levels that
    ``categories`` does not list count nowhere.

    Tasks add up their own rows; only sums by level and counts of level pairs that they met
    are shuffled, and merged by key before they reach the driver.
    """
    width, names, listed = len(dense) + 2, list(categories), [pa.array(v, pa.string()) for v in categories.values()]
    sizes, schema = [len(v) for v in categories.values()], "kind int, a long, b long, sums array<double>"
    couples = [(i, j) for i in range(len(names)) for j in range(i)]

    def table(kind: int, keys: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(np.arange(0, sums.size + 1, sums.shape[1], dtype=np.int32), pa.array(sums.ravel()))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys[:, 0]), pa.array(keys[:, 1]), lists], ["kind", "a", "b", "sums"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, by_level = np.zeros((width, width)), [np.zeros((n, width)) for n in sizes]
        met = {c: (np.zeros((0, 2), np.int64), np.zeros((0, 1))) for c in couples}
        for batch in batches:
            x = np.column_stack([np.ones(batch.num_rows), *[batch.column(i).to_numpy(zero_copy_only=False) for i in range(width - 1)]])
            square += x.T @ x
            at = [pc.fill_null(pc.index_in(batch.column(width - 1 + i), value_set=v), -1).to_numpy(zero_copy_only=False).astype(np.int64) for i, v in enumerate(listed)]
            for total, i in zip(by_level, at):
                keys, sums = _merged(i[i >= 0, None], x[i >= 0])
                total[keys[:, 0]] += sums
            for i, j in couples:
                both = (at[i] >= 0) & (at[j] >= 0)
                keys, n = met[i, j]
                met[i, j] = _merged(np.concatenate([keys, np.column_stack([at[i], at[j]])[both]]), np.concatenate([n, np.ones((both.sum(), 1))]))
        yield table(0, np.column_stack([np.arange(width), np.zeros(width, np.int64)]), square)
        for c, total in enumerate(by_level):
            there = np.flatnonzero(total[:, 0])
            yield table(1 + c, np.column_stack([there, np.zeros(len(there), np.int64)]), total[there])
        for k, c in enumerate(couples):
            yield table(1 + len(names) + k, *met[c])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            kinds = batch["kind"].to_numpy()
            for kind in np.unique(kinds).tolist():
                some = batch.filter(pa.array(kinds == kind))
                keys, sums = np.column_stack([some["a"].to_numpy(), some["b"].to_numpy()]), some["sums"].flatten().to_numpy().reshape(some.num_rows, -1)
                if kind in held:
                    keys, sums = np.concatenate([held[kind][0], keys]), np.concatenate([held[kind][1], sums])
                held[kind] = _merged(keys, sums)
        for kind, (keys, sums) in held.items():
            yield table(kind, keys, sums)

    cells = [F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate([*dense, target])] + [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]
    summed = rows.select(*cells).mapInArrow(run, schema).repartition("kind", "a", "b").mapInArrow(merge, schema).toArrow()
    kind, a, b = (summed[c].to_numpy() for c in ("kind", "a", "b"))
    offsets, values = np.r_[0, np.cumsum(pc.list_value_length(summed["sums"]).to_numpy())], summed["sums"].combine_chunks().flatten().to_numpy()
    found = Gram(np.zeros((width, width)), [np.zeros((n, width)) for n in sizes], {})
    for into, k in [(found.dense, 0), *((t, 1 + c) for c, t in enumerate(found.levels))]:
        for i in np.flatnonzero(kind == k):
            into[a[i]] = values[offsets[i] : offsets[i + 1]]
    for k, c in enumerate(couples, 1 + len(names)):
        at = np.flatnonzero(kind == k)
        found.pairs[c] = (a[at], b[at], values[offsets[at]])
    return found


def solved(g: Gram, rcond: float = 1e-10) -> tuple[float, np.ndarray, list[np.ndarray]]:
    """Intercept, dense coefficients and coefficients by level of the least-squares solution of least norm.

    Dense columns are centred first.  The levels of the largest category do not meet each
    other, so their block is diagonal and is eliminated; what is left is a dense system of
    the other columns.  Directions along which the rows say nothing are taken out of the
    solution at the end, which makes its norm the least.
    """
    n, d = g.dense[0, 0], g.dense.shape[0] - 2
    if not n:
        raise ValueError("no training rows")
    mean = g.dense[0] / n
    centred = g.dense[1:, 1:] - n * np.outer(mean[1:], mean[1:])
    count = [t[:, 0] for t in g.levels]
    sums = [t[:, 1:] - np.outer(t[:, 0], mean[1:]) for t in g.levels]
    big = int(np.argmax([len(t) for t in g.levels])) if g.levels else -1
    rest = [c for c in range(len(g.levels)) if c != big]
    starts = np.cumsum([1 + d, *(len(g.levels[c]) for c in rest)]).tolist()
    m = starts[-1]
    s, r = np.zeros((m, m)), np.zeros(m)
    s[0, 0], s[1 : 1 + d, 1 : 1 + d], r[1 : 1 + d] = n, centred[:d, :d], centred[:d, d]
    span = {c: slice(lo, hi) for c, lo, hi in zip(rest, starts, starts[1:])}
    met = lambda i, j: (g.pairs[i, j] if i > j else (lambda a, b, v: (b, a, v))(*g.pairs[j, i]))
    for c in rest:
        s[0, span[c]] = s[span[c], 0] = count[c]
        s[1 : 1 + d, span[c]], s[span[c], 1 : 1 + d] = sums[c][:, :d].T, sums[c][:, :d]
        s[span[c], span[c]] = np.diag(count[c])
        r[span[c]] = sums[c][:, d]
        for other in rest:
            if other < c:
                a, b, v = met(c, other)
                s[a + span[c].start, b + span[other].start] = s[b + span[other].start, a + span[c].start] = v
    seen = np.flatnonzero(count[big]) if g.levels else np.zeros(0, int)
    cross, weight = np.zeros((m, len(seen))), count[big][seen] if g.levels else np.zeros(0)
    r_big = sums[big][seen, d] if g.levels else np.zeros(0)
    if g.levels:
        cross[0], cross[1 : 1 + d] = weight, sums[big][seen, :d].T
        place = np.full(len(count[big]), -1)
        place[seen] = np.arange(len(seen))
        for c in rest:
            a, b, v = met(c, big)
            cross[a + span[c].start, place[b]] = v
    schur = s - (cross / weight) @ cross.T
    scale = np.sqrt(np.maximum(np.diag(s), 0))
    scale[scale == 0] = 1.0
    value, vector = np.linalg.eigh(schur / np.outer(scale, scale))
    open_ = value > rcond * max(value.max(), 1e-300)
    basis = vector / scale[:, None]
    u = basis[:, open_] @ ((basis[:, open_].T @ (r - cross @ (r_big / weight))) / value[open_])
    solution = np.r_[u[1:], (r_big - cross.T @ u) / weight]
    silent = np.concatenate([basis[1:, ~open_], -(cross.T @ basis[:, ~open_]) / weight[:, None]])
    if silent.shape[1]:
        q, sizes, _ = np.linalg.svd(silent, full_matrices=False)
        q = q[:, sizes > 1e-12 * sizes[0]] if sizes[0] else q[:, :0]
        solution -= q @ (q.T @ solution)
    dense, levels = solution[:d], [np.zeros(len(t)) for t in g.levels]
    for c in rest:
        levels[c] = solution[span[c].start - 1 : span[c].stop - 1]
    if g.levels:
        levels[big][seen] = solution[m - 1 :]
    intercept = mean[-1] - dense @ mean[1 : 1 + d] - sum(c @ w for c, w in zip(count, levels)) / n
    return float(intercept), dense, levels


def fit_linear(rows: DataFrame, dense: list[str], categories: dict[str, list[str]], target: str) -> tuple[float, dict[str, float]]:
    """Intercept and coefficients by encoded name of ordinary least squares over dense columns
    and columns of levels, each level a column of its own named ``column_level`` (ML-04, ML-06)."""
    intercept, b, levels = solved(gram(rows, dense, categories, target))
    weights = dict(zip(dense, map(float, b)))
    for (c, names), w in zip(categories.items(), levels):
        weights |= {f"{c}_{v}": float(x) for v, x in zip(names, w)}
    return intercept, weights


@dataclass
class LevelEffects:
    """Intercept, coefficients of dense columns, and ``levels``, a stored table (level, weight, m0, m1, ...)
    with the means of the dense columns and the target in each level."""

    intercept: float
    dense: dict[str, float]
    levels: DataFrame


def fit_level_effects(rows: DataFrame, dense: list[str], category: str, target: str, rcond: float = 1e-10) -> LevelEffects:
    """Least squares over dense columns and one category of any number of levels: the solution
    of least norm, as :func:`fit_linear` gives it (ML-04, ML-06).

    Means and covariances within each level are one aggregate by level.  The system of the dense
    columns is the sum of the levels' covariances; a level's weight follows from its own means,
    so levels stay rows of a table.  Only sums of the size of the dense columns reach the driver.
    Rows with a null level, dense value or target teach nothing.
    """
    d, kept = len(dense), [category, *dense, target]
    x, y = [F.col(f"`{c}`").cast("double") for c in dense], F.col(f"`{target}`").cast("double")
    taught = rows.select(*[F.col(f"`{c}`") for c in kept]).dropna()
    centre = list(taught.agg(*[F.coalesce(F.avg(c), F.lit(0.0)) for c in [*x, y]]).first())
    inner = [F.covar_pop(x[i], [*x, y][j]).alias(f"c{i}_{j}") for i in range(d) for j in range(i, d + 1)]
    by_level = keep(taught.groupBy(F.col(f"`{category}`").alias("level")).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate([*x, y])], *inner))
    within = [F.sum(F.col("n") * F.col(f"c{i}_{j}")) for i in range(d) for j in range(i, d + 1)]
    means = [F.lit(1.0), *[F.col(f"m{i}") - F.lit(c) for i, c in enumerate(centre)]]  # of level: the shift of all levels, dense columns, target
    between = [F.sum(means[i] * means[j]) for i in range(d + 2) for j in range(i, d + 2)]
    told = list(by_level.agg(*within, *between).first())
    if told[-1] is None:
        raise ValueError("no training rows")

    def symmetric(values: list[float], width: int, high: int) -> np.ndarray:
        full, at = np.zeros((high, high)), iter(values)
        for i in range(width):
            for j in range(i, high):
                full[i, j] = full[j, i] = next(at)
        return full

    s, m = symmetric(told[: len(within)], d, d + 1), symmetric(told[len(within) :], d + 2, d + 2)
    b, silent = np.zeros(d), np.zeros((d, 0))
    if d:
        scale = np.sqrt(np.maximum(np.diag(s)[:d], 0))
        scale[scale == 0] = 1.0
        value, vector = np.linalg.eigh(s[:d, :d] / np.outer(scale, scale))
        open_, basis = value > rcond * max(value.max(), 1e-300), vector / scale[:, None]
        b, silent = basis[:, open_] @ ((basis[:, open_].T @ s[:d, d]) / value[open_]), basis[:, ~open_]
    # Along these the rows say nothing: a shift of all levels, and dense columns that do not vary within any level.
    free = np.zeros((d + 2, 1 + silent.shape[1]))  # a direction's level part is means @ free, its dense part silent
    free[0, 0], free[1 : 1 + d, 1:] = 1.0, -silent
    weight = np.r_[0.0, -b, 1.0]  # a level's weight is means @ weight
    flat = np.column_stack([np.zeros(d), silent])
    weight_off = np.linalg.pinv(free.T @ m @ free + flat.T @ flat, rcond=1e-12, hermitian=True) @ (free.T @ m @ weight + flat.T @ b)
    b, weight = b - flat @ weight_off, weight - free @ weight_off
    levels = by_level.select("level", sum((F.lit(float(w)) * c for w, c in zip(weight, means)), F.lit(0.0)).alias("weight"), *[f"m{i}" for i in range(d + 1)])
    return LevelEffects(float(centre[d] - b @ np.array(centre[:d]) - weight[0]), dict(zip(dense, map(float, b))), levels)


def predicted_by_level(rows: DataFrame, category: str, model: LevelEffects, name: str) -> DataFrame:
    """``rows`` with a prediction; a level that the model does not know weighs nothing.

    In a known level it is taken from that level's means, where intercept and weight cancel.
    """
    joined = rows.join(model.levels.select([F.col(c).alias(f"_{c}") for c in model.levels.columns]), F.col(f"`{category}`") == F.col("_level"), "left")
    away = sum((F.lit(b) * (F.col(f"`{c}`").cast("double") - F.col(f"_m{i}")) for i, (c, b) in enumerate(model.dense.items())), F.lit(0.0))
    unknown = sum((F.lit(b) * F.col(f"`{c}`").cast("double") for c, b in model.dense.items()), F.lit(model.intercept))
    return joined.withColumn(name, F.when(F.col("_level").isNotNull(), F.col(f"_m{len(model.dense)}") + away).otherwise(unknown)).drop(*[f"_{c}" for c in model.levels.columns])


def predicted(rows: DataFrame, dense: list[str], categories: dict[str, list[str]], model: tuple[float, dict[str, float]], name: str) -> DataFrame:
    """``rows`` of dense columns and columns of levels with a prediction; levels that the
    model does not know weigh nothing.  A category's weights are its parameters: they are broadcast."""
    intercept, weights = model
    total = prediction(intercept, {c: weights[c] for c in dense}) if dense else F.lit(intercept)
    for k, (c, levels) in enumerate(categories.items()):
        known = rows.sparkSession.createDataFrame(pa.table({f"_level{k}": pa.array(levels, pa.string()), f"_weight{k}": pa.array([weights[f"{c}_{v}"] for v in levels], pa.float64())}))
        rows = rows.join(F.broadcast(known), F.col(f"`{c}`") == F.col(f"_level{k}"), "left")
        total += F.coalesce(F.col(f"_weight{k}"), F.lit(0.0))
    return rows.withColumn(name, total).drop(*[f"_{x}{k}" for k in range(len(categories)) for x in ("level", "weight")])


def prediction(intercept: float, coefficients: dict[str, float]) -> Column:
    """The model as a column expression (SV-04)."""
    values, weights = (F.array(*x) for x in zip(*((F.col(f"`{c}`"), F.lit(b)) for c, b in coefficients.items())))
    return F.aggregate(F.zip_with(values, weights, lambda v, w: v * w), F.lit(float(intercept)), lambda acc, x: acc + x)


def _errors(y: Column, p: Column) -> dict[str, Column]:
    """The aggregates of :func:`metrics`."""
    ok = finite(y) & finite(p)
    y, e = F.when(ok, y), F.when(ok, y - p)
    n, sst = F.count(y), F.var_pop(y) * F.count(y)
    return {
        "rows": F.count(F.lit(1)), "finite_rows": n, "zero_targets": F.count_if(y == 0), "mae": F.avg(F.abs(e)), "rmse": F.sqrt(F.avg(e * e)),
        "mape": F.avg(F.when(y != 0, F.abs(e / y))) * 100, "r2": F.when((n > 1) & (sst > 0), 1 - F.try_divide(F.sum(e * e), sst)),
    }


def metrics(rows: DataFrame, truth: str, predicted: str) -> DataFrame:
    """rows, finite_rows, zero_targets, mae, rmse, mape (a percentage over targets that
    are not zero) and r2 (null for one row or a constant target) (AG-22)."""
    return rows.agg(*[x.alias(name) for name, x in _errors(F.col(truth).cast("double"), F.col(predicted).cast("double")).items()])


def metrics_by(rows: DataFrame, by: str, truth: str, models: list[str]) -> DataFrame:
    """(model, by, metrics) for each group and each column of predictions, in one aggregate."""
    every = {m: _errors(F.col(truth).cast("double"), F.col(f"`{m}`").cast("double")) for m in models}
    told = rows.groupBy(by).agg(*[F.struct(F.lit(m).alias("model"), *[x.alias(name) for name, x in e.items()]).alias(f"_{i}") for i, (m, e) in enumerate(every.items())])
    return told.select(by, F.explode(F.array(*[f"_{i}" for i in range(len(models))])).alias("_m")).select("_m.model", by, *[f"_m.{name}" for name in next(iter(every.values()))])


def correlations(rows: DataFrame, features: list[str], target: str, threshold: float = 0.99) -> DataFrame:
    """(feature, corr, suspicious): pairwise complete Pearson correlation with the
    target; null where a side has fewer than two distinct values (AG-17, G5-7)."""
    y = F.col(target).cast("double")
    both = lambda c: F.col(f"`{c}`").isNotNull() & y.isNotNull()

    def pair(c: str) -> Column:  # corr() itself divides by zero for a constant side
        a, b = F.when(both(c), F.col(f"`{c}`").cast("double")), F.when(both(c), y)
        return F.try_divide(F.covar_pop(a, b), F.nullif(F.sqrt(F.var_pop(a) * F.var_pop(b)), F.lit(0.0)))

    wide = rows.agg(*[F.nanvl(pair(c), F.lit(None).cast("double")).alias(c) for c in features])
    long = wide.unpivot([], features, "feature", "corr")
    return long.withColumn("suspicious", F.coalesce(F.abs("corr") >= threshold, F.lit(False)))
