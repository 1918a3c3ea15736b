"""Seasonal ARMA with regressors per series, by the two regressions of Hannan and Rissanen.

A long autoregression stands in for the unknown innovations: its residuals, lagged, become
ordinary regressors beside the lagged target, so moving-average terms are fitted by least squares.
Every order is tried with and without regressors on the same days, and each series and
origin keeps the attempt with the least BIC, or the first that can be fitted.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.constants import DEFAULT_FUTURE_EXOG
from demandcast.models.packed import each_series, fill_forward_back, map_arrow, origin_days, pack
from demandcast.models.series import Z80, known_regressors
from demandcast.operators.splits import final_origin, split_rows

#: A path whose response to one shock grows beyond this is not forecast from.
EXPLOSIVE = 10.0


@dataclass(frozen=True)
class Order:
    """Lags of the target and of the innovations, after differencing by these lags."""

    name: str
    ar: tuple[int, ...]
    ma: tuple[int, ...]
    difference: tuple[int, ...] = ()


#: The two orders of the task, (1,0,1)(1,0,1,7) and (0,1,1)(0,1,1,7), with free coefficients on the product lags.
ORDERS = (Order("101x101", (1, 7, 8), (1, 7, 8)), Order("011x011", (), (1, 7, 8), (1, 7)))
#: Lags of the long autoregression.
LONG = 14


def least_squares(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float, int] | None:
    """Coefficients, squared error and rank; columns that do not move after the first are left at 0."""
    if len(y) <= x.shape[1]:
        return None
    scale = np.sqrt((x * x).sum(axis=0))
    spread = x.max(axis=0) - x.min(axis=0)
    use = (scale > 0) & ((spread > 0) | (np.arange(x.shape[1]) == np.argmax(spread == 0)))
    unit = x[:, use] / scale[use]
    found, _, rank, _ = np.linalg.lstsq(unit.T @ unit, unit.T @ y, rcond=1e-10)
    coef = np.zeros(x.shape[1])
    coef[use] = found / scale[use]
    rest = y - x @ coef
    return coef, float(rest @ rest), int(rank)


def lagged(x: np.ndarray, lags: Sequence[int], start: int) -> list[np.ndarray]:
    return [x[start - i:len(x) - i] for i in lags]


def difference(x: np.ndarray, lags: Sequence[int]) -> np.ndarray:
    """Differences by each lag in turn; the first sum(lags) rows fall away."""
    for lag in lags:
        x = x[lag:] - x[:-lag]
    return x


def level_lags(order: Order, ar: np.ndarray) -> dict[int, float]:
    """Coefficients of the undifferenced target's lags that the differenced autoregression amounts to."""
    poly = {0: 1.0, **{lag: -c for lag, c in zip(order.ar, ar)}}
    for d in order.difference:
        out: dict[int, float] = {}
        for lag, c in poly.items():
            out[lag] = out.get(lag, 0.0) + c
            out[lag + d] = out.get(lag + d, 0.0) - c
        poly = out
    return {lag: -c for lag, c in poly.items() if lag}


def fit_order(y: np.ndarray, x: np.ndarray, order: Order, long: int) -> dict | None:
    """One attempt: coefficients, innovations, sigma and BIC, or None if the series is too short for it."""
    w, v = difference(y, order.difference), difference(x, order.difference)
    constant = [] if order.difference else [np.ones(len(w))]
    if len(w) <= 2 * long + len(order.ar) + len(order.ma) + v.shape[1] + 2:
        return None
    first = np.column_stack([*[c[long:] for c in constant], *lagged(w, range(1, long + 1), long), v[long:]])
    stage = least_squares(first, w[long:])
    if stage is None:
        return None
    shock = np.concatenate([np.full(long, np.nan), w[long:] - first @ stage[0]])
    start = long + max(order.ma, default=0)
    start = max(start, *order.ar, 0) if order.ar else start
    design = np.column_stack([*[c[start:] for c in constant], *lagged(w, order.ar, start), *lagged(shock, order.ma, start), v[start:]])
    second = least_squares(design, w[start:])
    if second is None:
        return None
    coef, sse, rank = second
    n = len(w) - start
    if n <= rank or not np.isfinite(coef).all():
        return None
    a, m, k = len(order.ar), len(order.ma), len(constant)
    return {"constant": float(coef[0]) if k else 0.0, "ar": coef[k:k + a], "ma": coef[k + a:k + a + m], "beta": coef[k + a + m:],
            "shock": shock, "sigma": float(np.sqrt(sse / (n - rank))), "n": n,
            "bic": float(len(y) * np.log(max(sse / n, 1e-12)) + rank * np.log(len(y)))}


def project(y: np.ndarray, x: np.ndarray, future: np.ndarray, order: Order, fit: dict) -> tuple[np.ndarray, np.ndarray]:
    """Forecasts for the rows of ``future`` with innovations to come at 0, and what one innovation does to the days from its own on."""
    steps = len(future)
    past, shocks = list(y), list(fit["shock"])
    lags = level_lags(order, fit["ar"])
    moved = difference(np.vstack([x[-sum(order.difference) or len(x):], future]), order.difference)[-steps:]
    psi = [1.0]
    for j in range(1, steps):
        psi.append(sum(c * psi[j - lag] for lag, c in lags.items() if lag <= j) + sum(c for lag, c in zip(order.ma, fit["ma"]) if lag == j))
    for s in range(steps):
        value = fit["constant"] + float(moved[s] @ fit["beta"])
        value += sum(c * past[-lag] for lag, c in lags.items()) + sum(c * shocks[-lag] for lag, c in zip(order.ma, fit["ma"]))
        past.append(value)
        shocks.append(0.0)
    return np.array(past[-steps:]), np.array(psi)


def normal_band(path: np.ndarray, psi: np.ndarray, sigma: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forecast and the ends of its 80 % interval from the fitted variance."""
    spread = sigma * np.sqrt(np.cumsum(np.square(psi)))
    return path, path - Z80 * spread, path + Z80 * spread


def resampled_band(path: np.ndarray, psi: np.ndarray, shocks: np.ndarray, samples: int, block: int, seed: Sequence[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, p10 and p90 of ``samples`` paths whose innovations are blocks of past ones.

    The recursion is linear, so an innovation of day s moves day h by its weight h-s; the spread grows with
    the horizon. Neighbouring innovations stay together, whatever is left of their dependence.
    """
    steps = len(path)
    pool = shocks[~np.isnan(shocks)]
    pool = pool - pool.mean()
    block = min(block, len(pool))
    first = np.random.default_rng(list(seed)).integers(0, len(pool) - block + 1, size=(samples, -(-steps // block)))
    drawn = pool[first[:, :, None] + np.arange(block)].reshape(samples, -1)[:, :steps]
    moves = np.array([[psi[h - s] if s <= h else 0.0 for h in range(steps)] for s in range(steps)])
    paths = path + drawn @ moves
    return paths.mean(axis=0), np.percentile(paths, 10, axis=0), np.percentile(paths, 90, axis=0)


def best_attempt(y: np.ndarray, x: np.ndarray, future: np.ndarray, orders: Sequence[Order], long: int, choose: str) -> dict | None:
    """The attempts in order, each with regressors and then without; the first that holds or the one of least BIC."""
    tried = []
    for order in orders:
        for use in ((True, False) if x.shape[1] else (False,)):
            xs, fs = (x, future) if use else (x[:, :0], future[:, :0])
            fit = fit_order(y, xs, order, long)
            if fit is None:
                continue
            path, psi = project(y, xs, fs, order, fit)
            if not np.isfinite(path).all() or np.abs(psi).max() > EXPLOSIVE:
                continue
            tried.append({**fit, "order": order, "regressors": use, "path": path, "psi": psi})
            if choose == "first":
                return tried[0]
    return min(tried, key=lambda t: t["bic"]) if tried else None


def daily(days: np.ndarray, values: np.ndarray) -> tuple[int, np.ndarray]:
    """First day and one row per calendar day; days without a row are NaN."""
    out = np.full((int(days[-1] - days[0]) + 1, values.shape[1]), np.nan)
    out[days - days[0]] = values
    return int(days[0]), out


def seasonal_arma_fits(panel: DataFrame, origins: DataFrame, regressors: Sequence[str] | None = None, y: str = "y",
                       key: Sequence[str] = ("product",), time: str = "date", orders: Sequence[Order] = ORDERS, long: int = LONG,
                       choose: str = "bic", samples: int = 0, block: int = 7, seed: int = 42) -> DataFrame:
    """One row per series and origin that can be fitted: chosen order, coefficients, forecasts by day and their 80 % band.

    The target is filled forwards and then backwards inside the training days of the origin,
    regressors alike; a regressor that is never known counts as 0. Future regressors come from the
    whole series, days without a row from the day before. The band is that of the fitted variance, or with
    ``samples`` that of as many paths of resampled innovations, drawn from the series, the origin and ``seed``, so that
    a re-run draws the same.
    """
    regressors = known_regressors(panel.columns) if regressors is None else list(regressors)
    steps = origin_days(origins)
    types = dict(panel.dtypes)
    kept = ", ".join(f"`{k}` {types[k]}" for k in key)
    schema = (f"{kept}, origin_id int, test_start int, model_order string, with_regressors boolean, constant double, ar array<double>, ma array<double>, "
              "beta array<double>, sigma double, n bigint, yhat array<double>, lower array<double>, upper array<double>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, days, values in each_series(batches, 1 + len(regressors)):
            first, grid = daily(days, values)
            known = np.nan_to_num(fill_forward_back(grid[:, 1:])) if regressors else grid[:, 1:]
            for origin, train_end, start, end in steps:
                n = train_end - first + 1
                if n <= 0 or np.isnan(grid[:n, 0]).all():
                    continue
                inside = fill_forward_back(grid[:n])
                if n > len(inside):  # the series ends before the origin does: its last values carry on
                    inside = np.vstack([inside, np.repeat(inside[-1:], n - len(inside), axis=0)])
                at = np.clip(np.arange(start, end + 1) - first, 0, len(known) - 1)
                found = best_attempt(inside[:, 0], np.nan_to_num(inside[:, 1:]), known[at], orders, long, choose)
                if found is None:
                    continue
                fixed = [row.column(k) for k in key]
                name = zlib.crc32("\x1f".join(str(c[0].as_py()) for c in fixed).encode())
                band = (resampled_band(found["path"], found["psi"], found["shock"], samples, block, (seed, name, origin)) if samples
                        else normal_band(found["path"], found["psi"], found["sigma"]))
                made = [[origin], [start], [found["order"].name], [found["regressors"]], [found["constant"]], [found["ar"]], [found["ma"]], [found["beta"]],
                        [found["sigma"]], [found["n"]], *[[b] for b in band]]
                kinds = [pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.float64(), *[pa.list_(pa.float64())] * 3, pa.float64(), pa.int64(), *[pa.list_(pa.float64())] * 3]
                names = [*key, "origin_id", "test_start", "model_order", "with_regressors", "constant", "ar", "ma", "beta", "sigma", "n", "yhat", "lower", "upper"]
                yield pa.RecordBatch.from_arrays([*fixed, *[pa.array(m, t) for m, t in zip(made, kinds)]], names)

    packed = pack(panel, [y, *regressors], key, time)
    return map_arrow(packed, run, schema)


def seasonal_arma_forecasts(panel: DataFrame, origins: DataFrame, regressors: Sequence[str] | None = None, y: str = "y",
                            key: Sequence[str] = ("product",), time: str = "date", orders: Sequence[Order] = ORDERS, long: int = LONG,
                            choose: str = "bic", samples: int = 0, block: int = 7, seed: int = 42, model: str = "seasonal_arma") -> DataFrame:
    """Backtest with an 80 % band; a series that no attempt fits keeps its rows without a forecast."""
    fits = seasonal_arma_fits(panel, origins, regressors, y, key, time, orders, long, choose, samples, block, seed).select(
        *key, "origin_id", "test_start", F.posexplode(F.arrays_zip("yhat", "lower", "upper")).alias("_i", "_v"))
    days = fits.select(*key, "origin_id", F.date_from_unix_date(F.col("test_start") + F.col("_i")).alias(time), "_v.*")
    truth = split_rows(panel.select(*key, time, F.col(y).cast("double").alias("y")), origins, "test", time)
    joined = truth.join(days, [*key, "origin_id", time], "left")
    return joined.select("origin_id", F.col(time).alias("date"), *key, (F.datediff(F.col(time), "test_start") + 1).cast("int").alias("h"), "y", "yhat",
                         F.col("lower").alias("yhat_p10"), F.col("upper").alias("yhat_p90"), F.lit(model).alias("model"))


def seasonal_arma_outlook(panel: DataFrame, horizon: int = 7, regressors: Sequence[str] | None = None, y: str = "y",
                          key: Sequence[str] = ("product",), time: str = "date", **how) -> DataFrame:
    """Refit on the full history: parameters and forecasts of the days after it, one row per series.

    Future regressors take the defaults of the task where it names them and else the last known values.
    """
    regressors = known_regressors(panel.columns) if regressors is None else list(regressors)
    origin = final_origin(panel, horizon, time)
    ahead = panel.select(*key).distinct().crossJoin(origin.select(F.explode(F.sequence("test_start", "test_end")).alias(time)))
    defaults = {c: F.lit(float(DEFAULT_FUTURE_EXOG[c])) if c in DEFAULT_FUTURE_EXOG else F.lit(None).cast("double") for c in regressors}
    rows = panel.select(*key, time, F.col(y).cast("double").alias(y), *[F.col(c).cast("double").alias(c) for c in regressors]).unionByName(
        ahead.withColumn(y, F.lit(None).cast("double")).withColumns(defaults))
    return seasonal_arma_fits(rows, origin, regressors, y, key, time, **how)
