"""Direct sequence regression: a look-back window of every channel to all horizons at once.

The normal equations of a window are sums of products of rows that lie a fixed number of days
apart. A series gives these lagged cross-products once for each distance; block (i, j) of its
windows follows from block (i-1, j-1) by one row gained and one lost. Windows are therefore
never stored: a task keeps one matrix per origin and returns it in blocks that are added up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.models.boosting import with_truth
from demandcast.models.packed import each_series, fill_forward_back, map_arrow, origin_days, pack
from demandcast.models.pinball import band_around
from demandcast.session import materialise


@dataclass
class Window:
    """An origin's fit: scale of the channels, means of window and labels, coefficients (window x horizons)."""

    origin: int
    end: int
    mean: np.ndarray
    deviation: np.ndarray
    at: np.ndarray | None = None
    level: np.ndarray | None = None
    coef: np.ndarray | None = None


def training_part(days: np.ndarray, values: np.ndarray, end: int) -> np.ndarray:
    """Rows up to the origin's last training day, each channel filled forwards and then backwards."""
    return fill_forward_back(values[:int(np.searchsorted(days, end, side="right"))])


def scaled(w: Window, x: np.ndarray) -> np.ndarray:
    """Standardised channels; one that is never known in the series stands at the training mean."""
    return np.nan_to_num((x - w.mean) / w.deviation)


def window_products(z: np.ndarray, y: np.ndarray, lookback: int, horizon: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int] | None:
    """Sums over all full windows with all labels: (window x window, window x labels, window, labels, count).

    Column i * C + c of a window is channel c, i rows back.
    """
    n, c = z.shape
    first, last = lookback - 1, n - horizon - 1  # rows at which a window ends
    m = last - first + 1
    if m <= 0:
        return None
    g = np.empty((lookback, c, lookback, c))
    for j in range(lookback):  # the window's newest row against the one j back
        g[0, :, j, :] = z[first:last + 1].T @ z[first - j:last + 1 - j]
    for i in range(1, lookback):
        # One step back in both: the row before the first joins, the last falls away.
        gained, lost = z[first - i], z[last + 1 - i]
        for j in range(i, lookback):
            g[i, :, j, :] = g[i - 1, :, j - 1, :] + np.outer(gained, z[first - j]) - np.outer(lost, z[last + 1 - j])
    for i in range(1, lookback):
        for j in range(i):
            g[i, :, j, :] = g[j, :, i, :].T
    ahead = np.column_stack([y[first + h:last + 1 + h] for h in range(1, horizon + 1)])
    joint = np.stack([z[first - i:last + 1 - i].T @ ahead for i in range(lookback)])
    whole = np.stack([z[first - i:last + 1 - i].sum(axis=0) for i in range(lookback)])
    return g.reshape(lookback * c, lookback * c), joint.reshape(lookback * c, horizon), whole.reshape(-1), ahead.sum(axis=0), m


def scales(packed: DataFrame, steps: Sequence[tuple], n: int) -> list[Window]:
    """Mean and population deviation of each channel over the filled training rows of each origin; 1 where it does not move."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(steps), 3, n))
        for _, days, x in each_series(batches, n):
            for k, (_, end, *_) in enumerate(steps):
                inside = training_part(days, x, end)
                known = ~np.isnan(inside)
                value = np.where(known, inside, 0.0)
                sums[k] += np.stack([known.sum(axis=0), value.sum(axis=0), (value ** 2).sum(axis=0)])
        at = [(k, f) for k in range(len(steps)) for f in range(n)]
        flat = sums.transpose(1, 0, 2).reshape(3, -1)
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in at], pa.int32()), pa.array([f for _, f in at], pa.int32()), *[pa.array(v) for v in flat]],
                                         ["k", "f", "n", "s", "ss"])

    rows = map_arrow(packed, run, "k int, f int, n double, s double, ss double").groupBy("k", "f").agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss")]).collect()
    out = []
    for k, (origin, end, *_) in enumerate(steps):
        n_, s, ss = (np.array([getattr(r, c) for r in sorted((r for r in rows if r.k == k), key=lambda r: r.f)]) for c in ("n", "s", "ss"))
        count = np.maximum(n_, 1.0)
        mean = s / count
        variance = ss / count - mean ** 2
        out.append(Window(origin, end, mean, np.where(variance > 1e-12 * np.maximum(ss / count, 1e-300), np.sqrt(np.maximum(variance, 0)), 1.0)))
    return out


def normal_equations(packed: DataFrame, windows: Sequence[Window], n: int, lookback: int, horizon: int, log1p: bool) -> dict[int, tuple]:
    """Per origin the summed products of :func:`window_products`; a task sends one row per block of a matrix."""
    size = n * lookback

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for _, days, values in each_series(batches, n):
            for k, w in enumerate(windows):
                inside = training_part(days, values, w.end)
                if len(inside) < lookback + horizon or np.isnan(inside[:, 0]).all():
                    continue
                y = np.log1p(inside[:, 0]) if log1p else inside[:, 0]
                made = window_products(scaled(w, inside), y, lookback, horizon)
                if made is not None:
                    total[k] = [a + b for a, b in zip(total[k], made)] if k in total else list(made)
        for k, (g, joint, whole, level, m) in total.items():
            rows = np.hstack([g, joint, whole[:, None]])
            ends = np.concatenate([level, [m]])
            for block in range(lookback):
                piece = rows[block * n:(block + 1) * n].reshape(-1)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([block], pa.int32()), pa.array([piece.tobytes()], pa.binary()),
                                                  pa.array([ends.tobytes()], pa.binary())], ["k", "block", "rows", "ends"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, list[np.ndarray]] = {}
        for batch in batches:
            for k, block, rows, ends in zip(*[c.to_pylist() for c in batch.columns]):
                parts = [np.frombuffer(rows), np.frombuffer(ends)]
                total[k, block] = [a + b for a, b in zip(total[k, block], parts)] if (k, block) in total else parts
        for (k, block), (rows, ends) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([block], pa.int32()), pa.array([rows.tobytes()], pa.binary()),
                                              pa.array([ends.tobytes()], pa.binary())], ["k", "block", "rows", "ends"])

    schema = "k int, block int, rows binary, ends binary"
    out: dict[int, tuple] = {}
    # The size of a sum follows from channels and look-back, not from the number of series or days.
    found = map_arrow(map_arrow(packed, run, schema).repartition("k", "block"), add, schema).collect()
    for k in {r.k for r in found}:
        own = sorted((r for r in found if r.k == k), key=lambda r: r.block)
        rows = np.vstack([np.frombuffer(r.rows).reshape(n, size + horizon + 1) for r in own])
        ends = np.frombuffer(own[0].ends)
        out[k] = rows[:, :size], rows[:, size:-1], rows[:, -1], ends[:-1], ends[-1]
    return out


def solve(w: Window, sums: tuple, ridge: float) -> Window:
    """Ridge on centred windows and labels; a channel's weight is shrunk by ``ridge`` times the number of windows."""
    g, joint, whole, level, m = sums
    w.at, w.level = whole / m, level / m
    inner = g / m - np.outer(w.at, w.at)
    w.coef = np.linalg.solve(inner + ridge * np.eye(len(inner)), joint / m - np.outer(w.at, w.level))
    return w


def stacked(z: np.ndarray, lookback: int) -> np.ndarray:
    """All full windows of one series, newest row first, for scoring it."""
    return np.hstack([z[lookback - 1 - i:len(z) - i] for i in range(lookback)])


def sequence_forecasts(panel: DataFrame, origins: DataFrame, channels: Sequence[str] = ("y",), y: str = "y", key: Sequence[str] = ("product",),
                       time: str = "date", lookback: int = 30, horizon: int = 7, ridge: float = 0.1, log1p: bool = False,
                       interval: float = 0.80, model: str = "sequence_direct") -> DataFrame:
    """Backtest of the look-back regression, one fit per origin for all series.

    Channels are filled forwards and then backwards inside the training rows of the origin and
    standardised on them; the target is a channel whether named or not. Windows start at the first full one; a
    series shorter than the look-back is padded in front with its oldest row to be forecast. Bands are quantile regressions of
    the training residuals on the forecast, per series and horizon. With ``log1p`` labels and bands live on that scale.
    """
    names = [y, *[c for c in channels if c != y]]
    n, steps = len(names), origin_days(origins)
    packed = pack(panel, names, key, time)
    windows = scales(packed, steps, n)
    sums = normal_equations(packed, windows, n, lookback, horizon, log1p)
    if not sums:
        raise ValueError("no origin has enough training rows")
    fits = [solve(w, sums[k], ridge) for k, w in enumerate(windows) if k in sums]
    shared = panel.sparkSession.sparkContext.broadcast(fits)
    types = dict(packed.dtypes)
    lo, hi = (1 - interval) / 2, (1 + interval) / 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, days, values in each_series(batches, n):
            made: list[tuple] = []
            for w in shared.value:
                inside = training_part(days, values, w.end)
                if not len(inside) or np.isnan(inside[:, 0]).all():
                    continue
                z = scaled(w, inside)
                padded = np.vstack([np.repeat(z[:1], max(lookback - len(z), 0), axis=0), z])
                value = w.level + (stacked(padded, lookback) - w.at) @ w.coef
                truth = np.log1p(inside[:, 0]) if log1p else inside[:, 0]
                for h in range(1, horizon + 1):
                    past = value[:-h, h - 1] if len(z) >= lookback else value[:0, h - 1]
                    yhat = value[-1:, h - 1]
                    low, high = band_around(past, truth[len(truth) - len(past):], yhat, lo, hi)
                    ends = [np.expm1(v[0]) if log1p else v[0] for v in (yhat, low, high)]
                    made.append((w.origin, h, *[None if np.isnan(v) else float(v) for v in ends]))
            same = one.take(pa.array([0] * len(made), pa.int64()))
            kinds = [pa.int32(), pa.int32(), *[pa.float64()] * 3]
            yield pa.RecordBatch.from_arrays([*[same.column(k) for k in key], *[pa.array([m[i] for m in made], t) for i, t in enumerate(kinds)]],
                                             [*key, "origin_id", "h", "yhat", "yhat_p10", "yhat_p90"])

    schema = ", ".join(f"`{k}` {types[k]}" for k in key) + ", origin_id int, h int, yhat double, yhat_p10 double, yhat_p90 double"
    predictions = materialise(map_arrow(packed, run, schema))
    shared.destroy()
    return with_truth(panel, predictions, origins, y, key, time, model)
