"""Poisson and Tweedie regressions with a log link, all origins, horizons and objectives in one job per step.

Iteratively reweighted least squares needs the weighted cross-products of every fit. Tasks
form them for all fits while they read their rows once, the sums are added up and solved per fit on
the executors, and only coefficients reach the driver. Standardising, screening and missing
values follow the training rows of each origin.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.models.boosting import BUCKET_ROWS, objective_grid, with_truth
from demandcast.models.packed import each_series, map_arrow, origin_days, pack
from demandcast.models.pinball import band_around
from demandcast.operators.features import add_labels
from demandcast.session import materialise

STEPS, SETTLED = 30, 1e-9
#: Linear predictors are held inside this range, so that no exponential overflows.
LIMIT = 30.0


@dataclass
class Glm:
    """One fit: what it learns from and its coefficients, the intercept first, on standardised inputs."""

    origin: int
    end: int
    h: int
    power: float  # 1 is Poisson
    features: np.ndarray
    mean: np.ndarray
    deviation: np.ndarray
    coef: np.ndarray | None = None


def inputs(fit: Glm, x: np.ndarray) -> np.ndarray:
    """Intercept and standardised features; a missing value counts as the training mean."""
    z = (x[:, fit.features] - fit.mean) / fit.deviation
    return np.column_stack([np.ones(len(x)), np.nan_to_num(z)])


def mean_of(fit: Glm, x: np.ndarray) -> np.ndarray:
    return np.exp(np.clip(inputs(fit, x) @ fit.coef, -LIMIT, LIMIT))


def trained_on(fit: Glm, days: np.ndarray, labels: np.ndarray) -> np.ndarray:
    return np.flatnonzero((days <= fit.end - fit.h) & ~np.isnan(labels[:, fit.h - 1]))


def origin_scales(packed: DataFrame, steps: Sequence[tuple], n_features: int, n_labels: int, max_null_fraction: float) -> dict[int, tuple]:
    """(features, means, deviations) of each origin's training rows: few enough missing and more than one value."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(steps), 4, n_features))
        for _, days, x in each_series(batches, n_features + n_labels):
            for k, (_, end, *_) in enumerate(steps):
                inside = x[days <= end, :n_features]
                known = ~np.isnan(inside)
                value = np.where(known, inside, 0.0)
                sums[k] += np.stack([np.full(n_features, len(inside)), known.sum(axis=0), value.sum(axis=0), (value ** 2).sum(axis=0)])
        at = [(k, f) for k in range(len(steps)) for f in range(n_features)]
        flat = sums.transpose(1, 0, 2).reshape(4, -1)
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in at], pa.int32()), pa.array([f for _, f in at], pa.int32()), *[pa.array(v) for v in flat]],
                                         ["k", "f", "rows", "n", "s", "ss"])

    rows = map_arrow(packed, run, "k int, f int, rows double, n double, s double, ss double").groupBy("k", "f").agg(
        *[F.sum(c).alias(c) for c in ("rows", "n", "s", "ss")]).collect()
    out = {}
    for k, (origin, *_) in enumerate(steps):
        own = sorted((r for r in rows if r.k == k and r.n > 0 and r.rows - r.n <= max_null_fraction * r.rows), key=lambda r: r.f)
        mean = np.array([r.s / r.n for r in own])
        variance = np.array([r.ss / r.n for r in own]) - mean ** 2
        moves = variance > 1e-12 * np.maximum(np.array([r.ss / r.n for r in own]), 1e-300)
        out[origin] = (np.array([r.f for r in own], int)[moves], mean[moves], np.sqrt(variance[moves]))
    return out


def step(packed: DataFrame, fits: Sequence[Glm], n_features: int, n_labels: int, reg: float) -> dict[int, np.ndarray]:
    """New coefficients of every fit from its weighted normal equations; the first step starts from the labels."""
    sc = packed.sparkSession.sparkContext
    shared = sc.broadcast(list(fits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits = shared.value
        sums = [np.zeros((len(f.features) + 1, len(f.features) + 3)) for f in fits]
        for _, days, values in each_series(batches, n_features + n_labels):
            x, labels = values[:, :n_features], values[:, n_features:]
            design: dict[int, np.ndarray] = {}
            for k, fit in enumerate(fits):
                rows = trained_on(fit, days, labels)
                if not len(rows):
                    continue
                if fit.origin not in design:
                    design[fit.origin] = inputs(fit, x)
                z, y = design[fit.origin][rows], labels[rows, fit.h - 1]
                mu = np.maximum(y, 0.1) if fit.coef is None else np.exp(np.clip(z @ fit.coef, -LIMIT, LIMIT))
                w = mu ** (2 - fit.power)
                target = np.log(mu) + (y - mu) / mu
                weighted = z * w[:, None]
                sums[k][:, :-2] += weighted.T @ z
                sums[k][:, -2] += weighted.T @ target
                sums[k][0, -1] += len(rows)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(fits)), pa.int32()), pa.array([s.tobytes() for s in sums], pa.binary())], ["fit", "sums"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(raw)
                total[k] = total.get(k, 0.0) + part
        for k, flat in total.items():
            p = round((1 + len(flat)) ** 0.5) - 1  # p rows of p + 2 numbers
            s = flat.reshape(p, p + 2)
            n = s[0, -1]
            if n:
                penalty = reg * n * np.eye(p)
                penalty[0, 0] = 0.0
                coef = np.linalg.lstsq(s[:, :-2] + penalty, s[:, -2], rcond=1e-12)[0]
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([coef], pa.list_(pa.float64()))], ["fit", "coef"])

    sums = map_arrow(packed, run, "fit int, sums binary").repartition("fit")
    found = {r.fit: np.array(r.coef) for r in map_arrow(sums, solve, "fit int, coef array<double>").collect()}
    shared.destroy()
    return found


def fit_all(packed: DataFrame, fits: Sequence[Glm], n_features: int, n_labels: int, reg: float, steps: int = STEPS) -> list[Glm]:
    """Steps until no coefficient of any fit moves; fits without training rows fall away."""
    fits = list(fits)
    for _ in range(steps):
        found = step(packed, fits, n_features, n_labels, reg)
        fits = [f for k, f in enumerate(fits) if k in found]
        new = [found[k] for k in sorted(found)]
        moved = max((1.0 if f.coef is None else float(np.abs(f.coef - c).max()) for f, c in zip(fits, new)), default=0.0)
        for f, c in zip(fits, new):
            f.coef = c
        if moved < SETTLED:
            break
    return [f for f in fits if np.isfinite(f.coef).all()]


def least_error(packed: DataFrame, fits: Sequence[Glm], n_features: int, n_labels: int) -> list[Glm]:
    """Of the objectives of each (origin, horizon) the one with the least in-sample absolute error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(fits))
        for _, days, values in each_series(batches, n_features + n_labels):
            x, labels = values[:, :n_features], values[:, n_features:]
            for k, fit in enumerate(fits):
                rows = trained_on(fit, days, labels)
                sums[k] += np.abs(mean_of(fit, x[rows]) - labels[rows, fit.h - 1]).sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(fits)), pa.int32()), pa.array(sums)], ["fit", "s"])

    errors = {r.fit: r.s for r in map_arrow(packed, run, "fit int, s double").groupBy("fit").agg(F.sum("s").alias("s")).collect()}
    best: dict[tuple[int, int], int] = {}
    for k, fit in enumerate(fits):
        at = (fit.origin, fit.h)
        if at not in best or errors[k] < errors[best[at]]:
            best[at] = k
    return [fits[k] for k in best.values()]


def glm_forecasts(panel: DataFrame, origins: DataFrame, features: Sequence[str], y: str = "y", key: Sequence[str] = ("product",),
                  time: str = "date", horizon: int = 7, objective: str = "all", powers: Sequence[float] = (1.1, 1.3, 1.5), reg: float = 0.01,
                  max_null_fraction: float = 0.30, interval: float = 0.80, model: str = "glm_direct") -> DataFrame:
    """Backtest of the grid: per origin and horizon the objective with the least in-sample error.

    ``objective`` is ``poisson``, ``tweedie`` (every power) or ``all`` for both. Inputs are screened and standardised on
    the training rows of the origin, and ``reg`` times the number of rows is added to the squares
    of their coefficients. Bands are quantile regressions of the training residuals per series.
    """
    steps = origin_days(origins)
    grid = [1.0 if name == "poisson" else power for name, power in objective_grid(objective, powers) if name != "squared"]
    labels = [f"y_{h}" for h in range(1, horizon + 1)]
    labelled = materialise(add_labels(panel.select(*dict.fromkeys([*key, time, y, *features])), y, horizon, key, time))
    n = max(panel.sparkSession.sparkContext.defaultParallelism, -(-labelled.count() // BUCKET_ROWS))
    kept, n_features = [*features, *labels], len(features)
    packed = pack(labelled.withColumn("_bucket", F.pmod(F.xxhash64(*key, time), F.lit(n))), kept, ["_bucket"], time).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        scales = origin_scales(packed, steps, n_features, horizon, max_null_fraction)
        asked = [Glm(o, end, h, p, *scales[o]) for o, end, *_ in steps for h in range(1, horizon + 1) for p in grid]
        fits = fit_all(packed, asked, n_features, horizon, reg) if asked else []
        if not fits:
            raise ValueError("no origin has enough training rows")
        fits = least_error(packed, fits, n_features, horizon) if len(grid) > 1 else fits
    finally:
        packed.unpersist()
    predictions = materialise(predict(pack(labelled, kept, key, time), fits, n_features, horizon, key, interval))
    return with_truth(panel, predictions, origins, y, key, time, model)


def predict(series: DataFrame, fits: Sequence[Glm], n_features: int, n_labels: int, key: Sequence[str], interval: float) -> DataFrame:
    """(key, origin_id, h, yhat, yhat_p10, yhat_p90) from the row of each origin's last training day."""
    types = dict(series.dtypes)
    lo, hi = (1 - interval) / 2, (1 + interval) / 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, days, values in each_series(batches, n_features + n_labels):
            x, labels = values[:, :n_features], values[:, n_features:]
            made: list[tuple] = []
            for fit in fits:
                at = np.flatnonzero(days == fit.end)
                if len(at):
                    rows = trained_on(fit, days, labels)
                    yhat = mean_of(fit, x[at])
                    low, high = band_around(mean_of(fit, x[rows]), labels[rows, fit.h - 1], yhat, lo, hi)
                    made.append((fit.origin, fit.h, float(yhat[0]), *[None if np.isnan(v[0]) else float(v[0]) for v in (low, high)]))
            same = one.take(pa.array([0] * len(made), pa.int64()))
            kinds = [pa.int32(), pa.int32(), *[pa.float64()] * 3]
            yield pa.RecordBatch.from_arrays([*[same.column(k) for k in key], *[pa.array([m[i] for m in made], t) for i, t in enumerate(kinds)]],
                                             [*key, "origin_id", "h", "yhat", "yhat_p10", "yhat_p90"])

    return map_arrow(series, run, ", ".join(f"`{k}` {types[k]}" for k in key) + ", origin_id int, h int, yhat double, yhat_p10 double, yhat_p90 double")
