"""Quantile regression by reweighted cross-products, one small fit per group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.functions.columns import col
from demandcast.models.packed import map_arrow
from demandcast.session import materialise

#: Reweighting steps, and the part of the target's spread below which a residual counts as none.
STEPS, NEAR = 40, 1e-4


def fit_quantile(x: np.ndarray, y: np.ndarray, q: float) -> np.ndarray | None:
    """Coefficients of the q-quantile of ``y`` given the rows of ``x``; None without enough rows.

    The pinball loss is a weighted square with weights q or 1-q over the size of the residual, so
    each step solves one set of normal equations. The intercept, the first column, is then
    moved so that exactly a part q of the rows lies below.
    """
    n, p = x.shape
    if n < 5 * p:
        return None
    scale = np.maximum(np.sqrt((x * x).mean(axis=0)), 1e-12)
    u = x / scale
    near = max(NEAR * float(np.std(y)), 1e-9)
    beta = np.linalg.lstsq(u.T @ u, u.T @ y, rcond=1e-10)[0]
    for _ in range(STEPS):
        rest = y - u @ beta
        w = np.where(rest > 0, q, 1 - q) / np.maximum(np.abs(rest), near)
        weighted = u * w[:, None]
        new = np.linalg.lstsq(weighted.T @ u, weighted.T @ y, rcond=1e-10)[0]
        done = np.abs(new - beta).max() <= 1e-7 * max(np.abs(new).max(), 1e-12)
        beta = new
        if done:
            break
    out = beta / scale
    out[0] += np.quantile(y - x @ out, q)
    return out


def level_design(center: np.ndarray) -> np.ndarray:
    """A band that may widen with the forecast: intercept and centre, or the intercept alone where the centre stands still."""
    one = np.ones(len(center))
    return np.column_stack([one, center]) if len(center) and np.ptp(center) > 1e-9 * max(1.0, np.abs(center).max()) else one[:, None]


def band_around(center: np.ndarray, y: np.ndarray, at: np.ndarray, lo: float, hi: float) -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of ``y`` at the forecasts ``at``, learned on training rows; without enough rows both are NaN."""
    design = level_design(center)
    ends = []
    for q in (lo, hi):
        fitted = fit_quantile(design, y - center, q)
        if fitted is None:
            ends.append(np.full(len(at), np.nan))
        else:
            ends.append(at + fitted[0] + (fitted[1] * at if len(fitted) > 1 else 0.0))
    return np.minimum(*ends), np.maximum(*ends)


def quantile_coefficients(rows: DataFrame, x: Sequence[str], y: str, key: Sequence[str], quantiles: Sequence[float] = (0.1, 0.9)) -> DataFrame:
    """(key, quantile, coef): quantile regressions of ``y`` on an intercept and the columns ``x`` per group.

    A group is one series at one origin and horizon: at most a row a day. Rows with missing values are left out; groups
    with fewer than five rows per coefficient give none.
    """
    value = F.array(*[col(c).cast("double") for c in (y, *x)])
    known = ~F.exists(value, lambda v: v.isNull() | F.isnan(v))
    packed = rows.where(known).groupBy(*key).agg(F.flatten(F.collect_list(value)).alias("_v"))
    p = len(x) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, qs, coefs = [], [], []
            for i, values in enumerate(batch.column("_v")):
                m = values.values.to_numpy(zero_copy_only=False).reshape(-1, p)
                design = np.column_stack([np.ones(len(m)), m[:, 1:]])
                for q in quantiles:
                    fitted = fit_quantile(design, m[:, 0], q)
                    if fitted is not None:
                        at.append(i)
                        qs.append(q)
                        coefs.append(fitted)
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*[taken.column(k) for k in key], pa.array(qs, pa.float64()), pa.array(coefs, pa.list_(pa.float64()))],
                                             [*key, "quantile", "coef"])

    types = dict(rows.dtypes)
    return map_arrow(packed, run, ", ".join(f"`{k}` {types[k]}" for k in key) + ", quantile double, coef array<double>")


def quantile_bands(forecasts: DataFrame, history: DataFrame, x: Sequence[str], key: Sequence[str], y: str = "y",
                   lo: float = 0.1, hi: float = 0.9) -> DataFrame:
    """Forecasts with bands from quantile regressions on ``x``, which both tables have; ends that cross are swapped."""
    fits = materialise(quantile_coefficients(history, x, y, key, (lo, hi)))
    wide = fits.groupBy(*key).agg(F.max(F.when(F.col("quantile") == lo, F.col("coef"))).alias("_lo"), F.max(F.when(F.col("quantile") == hi, F.col("coef"))).alias("_hi"))

    def end(c: str):
        out = F.get(c, F.lit(0))
        for i, name in enumerate(x):
            out = out + F.get(c, F.lit(i + 1)) * col(name)
        return out

    joined = forecasts.drop("yhat_p10", "yhat_p90").join(wide, list(key), "left").withColumns({"_a": end("_lo"), "_b": end("_hi")})
    return joined.withColumns({"yhat_p10": F.least("_a", "_b"), "yhat_p90": F.greatest("_a", "_b")}).drop("_a", "_b", "_lo", "_hi")
