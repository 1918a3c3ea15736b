"""Gradient-boosted trees for many fits at once, from histograms of a binned table.

Quantile edges are taken once and every feature becomes one byte, so all fits (origins, horizons,
objectives) read the same small table. A round asks for one level of one tree of every fit: tasks
return sums of gradients per node, feature and bin, these are added up by fit, and only
the best split of each node reaches the driver. The number of jobs is rounds times depth, however
many fits there are. Trees are a few kilobytes and travel with the job; rows hold no state, so a
lost executor costs its own partition only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandcast.functions.columns import col, no_nan
from demandcast.models.packed import each_series, map_arrow, origin_days, pack
from demandcast.models.pinball import band_around
from demandcast.operators.features import add_labels
from demandcast.operators.splits import split_rows
from demandcast.session import materialise

BINS = 64
#: Rows that a bucket of the training table holds.
BUCKET_ROWS = 16_384
#: Rows that both sides of a split need (sums of second derivatives where these are not 1).
LEAST = 20.0
SHRINK = 1.0
#: Bytes of all tasks' sums of one level that the driver may add up by itself.
DRIVER_BYTES = 64 << 20


@dataclass
class Fit:
    """One boosted model: what it learns from, its objective and its trees."""

    origin: int
    end: int  # last training day
    h: int
    features: tuple[int, ...]  # positions in the binned table
    objective: str = "squared"
    power: float = 0.0
    base: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)  # feature, threshold and value per node


def bin_numbers(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bin numbers: 0 where the value is missing, else 1 and up."""
    out = np.zeros(x.shape, np.uint8)
    for f, e in enumerate(edges):
        known = ~np.isnan(x[:, f])
        out[known, f] = np.searchsorted(e, x[known, f], side="left") + 1
    return out


def quantile_edges(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Inner quantiles of each feature, from one aggregation; a feature without values has none."""
    ranks = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    found = rows.agg(*[F.percentile_approx(no_nan(col(c).cast("double")), ranks, F.lit(4_000)).alias(f"_{i}") for i, c in enumerate(features)]).first()
    return [np.unique(np.array(v or [], float)) for v in found]


def binned(packed: DataFrame, n_features: int, n_labels: int, edges: Sequence[np.ndarray], key: Sequence[str]) -> DataFrame:
    """Packed features and labels as (key, days, bins, labels) in binary form."""
    types = dict(packed.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in key) + ", days binary, bins binary, labels binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, days, x in each_series(batches, n_features + n_labels):
            made = [days.astype(np.int32).tobytes(), bin_numbers(x[:, :n_features], edges).tobytes(), np.ascontiguousarray(x[:, n_features:]).tobytes()]
            yield pa.RecordBatch.from_arrays([*[row.column(k) for k in key], *[pa.array([m], pa.binary()) for m in made]], [*key, "days", "bins", "labels"])

    return materialise(map_arrow(packed, run, schema))


def unpacked(batches: Iterator[pa.RecordBatch], n_features: int, n_labels: int) -> Iterator[tuple]:
    """(one-row batch, days, rows x bins, rows x labels)."""
    for batch in batches:
        for i in range(batch.num_rows):
            one = batch.slice(i, 1)
            days, bins, labels = (one.column(c)[0].as_py() for c in ("days", "bins", "labels"))
            yield (one, np.frombuffer(days, np.int32), np.frombuffer(bins, np.uint8).reshape(-1, n_features),
                   np.frombuffer(labels, np.float64).reshape(-1, n_labels))


def descend(tree: tuple, bins: np.ndarray, levels: int) -> np.ndarray:
    """Node of each row after so many levels; a row stays in a leaf it has reached."""
    feature, threshold, _ = tree
    node = np.zeros(len(bins), np.int64)
    at = np.arange(len(bins))
    for _ in range(levels):
        f = feature[node]
        right = bins[at, np.maximum(f, 0)] > threshold[node]
        node = np.where(f < 0, node, 2 * node + 1 + right)
    return node


def raw_score(fit: Fit, bins: np.ndarray, depth: int) -> np.ndarray:
    """Sum of base and trees on the fit's own columns."""
    total = np.full(len(bins), fit.base)
    for tree in fit.trees:
        total += tree[2][descend(tree, bins, depth)]
    return total


def response(fit: Fit, score: np.ndarray) -> np.ndarray:
    return score if fit.objective == "squared" else np.exp(np.clip(score, -30, 30))


def gradients(fit: Fit, score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """First and second derivatives of the loss; the second is None where it is 1."""
    if fit.objective == "squared":
        return score - y, None
    mu = np.exp(np.clip(score, -30, 30))
    if fit.objective == "poisson":
        return mu - y, mu
    a, b = mu ** (1 - fit.power), mu ** (2 - fit.power)
    return b - y * a, (2 - fit.power) * b - y * (1 - fit.power) * a


def trained_on(fit: Fit, days: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Rows whose label is known on the last training day."""
    return np.flatnonzero((days <= fit.end - fit.h) & ~np.isnan(labels[:, fit.h - 1]))


def _summed(parts: DataFrame, run: Callable, schema: str, size: int, tasks: int) -> list:
    """Per fit: add up the tasks' arrays and hand the sum to ``run``.

    Arrays are added on the executors, or on the driver where all of them together, tasks times ``size`` bytes, are small: a
    stage less for each level of each tree, with the same result.
    """
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(raw)
                total[k] = total[k] + part if k in total else part
        for k, whole in total.items():
            yield run(k, whole)

    if size * tasks <= DRIVER_BYTES:
        return [SimpleNamespace(**row) for batch in add(iter(parts.toArrow().to_batches())) for row in batch.to_pylist()]
    return map_arrow(parts.repartition("fit"), add, schema).collect()


def start(table: DataFrame, fits: Sequence[Fit], n_features: int, n_labels: int) -> list[Fit]:
    """Fits with training rows, each starting from its mean (or its logarithm)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(fits), 2))
        for _, days, _, labels in unpacked(batches, n_features, n_labels):
            for k, fit in enumerate(fits):
                y = labels[trained_on(fit, days, labels), fit.h - 1]
                sums[k] += len(y), y.sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(fits)), pa.int32()), pa.array(sums[:, 0]), pa.array(sums[:, 1])], ["fit", "n", "s"])

    rows = map_arrow(table, run, "fit int, n double, s double").groupBy("fit").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    for r in rows:
        mean = r.s / r.n if r.n else None
        fits[r.fit].base = None if mean is None else mean if fits[r.fit].objective == "squared" else float(np.log(max(mean, 1e-3)))
    return [f for f in fits if f.base is not None]


def level_splits(table: DataFrame, shared, level: int, depth: int, n_features: int, n_labels: int, n_bins: int, least: float, tasks: int) -> list:
    """Best split of every node of a level, for all fits. ``shared`` holds the fits and their open trees."""
    nodes = 1 << level
    size = sum(16 * nodes * len(f.features) * n_bins for f in shared.value[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits, open_ = shared.value
        sums = [np.zeros(2 * nodes * len(f.features) * n_bins) for f in fits]
        for _, days, bins, labels in unpacked(batches, n_features, n_labels):
            for k, fit in enumerate(fits):
                rows = trained_on(fit, days, labels)
                if not len(rows):
                    continue
                own = bins[np.ix_(rows, fit.features)]
                g, h = gradients(fit, raw_score(fit, own, depth), labels[rows, fit.h - 1])
                node = descend(open_[k], own, level) - (nodes - 1)
                here = node >= 0
                if not here.all():
                    own, g, node, h = own[here], g[here], node[here], None if h is None else h[here]
                w = len(fit.features)
                cell = (node[:, None] * w + np.arange(w)) * n_bins + own
                cells = nodes * w * n_bins
                flat = cell.reshape(-1)
                sums[k][:cells] += np.bincount(flat, np.repeat(g, w), cells)
                sums[k][cells:] += np.bincount(flat, None if h is None else np.repeat(h, w), cells)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(fits)), pa.int32()), pa.array([s.tobytes() for s in sums], pa.binary())], ["fit", "sums"])

    def best(k: int, total: np.ndarray) -> pa.RecordBatch:
        g, h = total.reshape(2, nodes, -1, n_bins)
        gl, hl = g.cumsum(axis=2), h.cumsum(axis=2)
        gt, ht = gl[:, :, -1:], hl[:, :, -1:]
        gain = gl ** 2 / (hl + SHRINK) + (gt - gl) ** 2 / (ht - hl + SHRINK) - gt ** 2 / (ht + SHRINK)
        gain = np.where((hl >= least) & (ht - hl >= least), gain, -np.inf).reshape(nodes, -1)
        top = gain.argmax(axis=1)
        at = np.arange(nodes)
        left_g, left_h = gl.reshape(nodes, -1)[at, top], hl.reshape(nodes, -1)[at, top]
        fine = gain[at, top] > 1e-9
        columns = [[k] * nodes, at, np.where(fine, top // n_bins, -1), top % n_bins, np.where(fine, gain[at, top], 0.0), gt[:, 0, 0], ht[:, 0, 0], left_g, left_h]
        types = [pa.int32()] * 4 + [pa.float64()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["fit", "node", "feature", "bin", "gain", "g", "h", "gl", "hl"])

    return _summed(map_arrow(table, run, "fit int, sums binary"), best,
                   "fit int, node int, feature int, bin int, gain double, g double, h double, gl double, hl double", size, tasks)


def boost(table: DataFrame, fits: Sequence[Fit], n_features: int, n_labels: int, n_bins: int, rounds: int = 20, depth: int = 4,
          rate: float = 0.1, least: float = LEAST) -> tuple[list[Fit], np.ndarray]:
    """Train all fits together. Returns those with training rows and the gain of each (fit, feature of the table)."""
    sc = table.sparkSession.sparkContext
    fits = start(table, fits, n_features, n_labels)
    gains = np.zeros((len(fits), n_features))
    size = (2 << depth) - 1
    tasks = table.rdd.getNumPartitions() if fits else 0
    for turn in range(rounds if fits else 0):
        step = 1.0 if turn == 0 else rate
        trees = [(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)) for _ in fits]
        for level in range(depth):
            shared = sc.broadcast((fits, trees))
            found = level_splits(table, shared, level, depth, n_features, n_labels, n_bins, least, tasks)
            shared.destroy()
            for r in found:
                feature, threshold, value = trees[r.fit]
                at = (1 << level) - 1 + r.node
                if level == 0:
                    value[0] = -step * r.g / (r.h + SHRINK)
                if r.feature < 0 or (level and feature[(at - 1) // 2] < 0):
                    continue
                feature[at], threshold[at] = r.feature, r.bin
                value[2 * at + 1] = -step * r.gl / (r.hl + SHRINK)
                value[2 * at + 2] = -step * (r.g - r.gl) / (r.h - r.hl + SHRINK)
                gains[r.fit, fits[r.fit].features[r.feature]] += r.gain
        for fit, tree in zip(fits, trees):
            fit.trees.append(tree)
    return fits, gains


def errors_of(table: DataFrame, fits: Sequence[Fit], n_features: int, n_labels: int, depth: int, log1p: bool) -> np.ndarray:
    """In-sample mean absolute error of each fit on the target's own scale."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(fits), 2))
        for _, days, bins, labels in unpacked(batches, n_features, n_labels):
            for k, fit in enumerate(fits):
                rows = trained_on(fit, days, labels)
                got, want = response(fit, raw_score(fit, bins[np.ix_(rows, fit.features)], depth)), labels[rows, fit.h - 1]
                got, want = (np.expm1(got), np.expm1(want)) if log1p else (got, want)
                sums[k] += len(rows), np.abs(got - want).sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(fits)), pa.int32()), pa.array(sums[:, 0]), pa.array(sums[:, 1])], ["fit", "n", "s"])

    rows = map_arrow(table, run, "fit int, n double, s double").groupBy("fit").agg((F.sum("s") / F.sum("n")).alias("e")).collect()
    return np.array([r.e for r in sorted(rows, key=lambda r: r.fit)])


def best_by_error(fits: Sequence[Fit], errors: np.ndarray) -> list[Fit]:
    """Of the objectives of each (origin, horizon) the one with the least error; the first of equal ones."""
    chosen: dict[tuple[int, int], tuple[float, int]] = {}
    for i, (fit, e) in enumerate(zip(fits, errors)):
        at = (fit.origin, fit.h)
        if at not in chosen or e < chosen[at][0]:
            chosen[at] = (float(e), i)
    return [fits[i] for _, i in chosen.values()]


def screened(table: DataFrame, features: Sequence[str], steps: Sequence[tuple], n_labels: int, max_null_fraction: float) -> dict[int, tuple[int, ...]]:
    """Per origin the features that its training rows allow: few enough missing and more than one value."""
    n = len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, gone = np.zeros(len(steps)), np.zeros((len(steps), n))
        low, high = np.full((len(steps), n), 255), np.zeros((len(steps), n), int)
        for _, days, bins, _ in unpacked(batches, n, n_labels):
            for k, (_, end, _, _) in enumerate(steps):
                inside = bins[days <= end]
                if len(inside):
                    rows[k] += len(inside)
                    gone[k] += (inside == 0).sum(axis=0)
                    low[k] = np.minimum(low[k], np.where(inside == 0, 255, inside).min(axis=0))
                    high[k] = np.maximum(high[k], inside.max(axis=0))
        at = [(k, f) for k in range(len(steps)) for f in range(n)]
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in at], pa.int32()), pa.array([f for _, f in at], pa.int32()), pa.array(np.repeat(rows, n)),
                                          pa.array(gone.reshape(-1)), pa.array(low.reshape(-1), pa.int32()), pa.array(high.reshape(-1), pa.int32())],
                                         ["k", "f", "rows", "gone", "low", "high"])

    found = map_arrow(table, run, "k int, f int, rows double, gone double, low int, high int").groupBy("k", "f").agg(
        F.sum("rows").alias("rows"), F.sum("gone").alias("gone"), F.min("low").alias("low"), F.max("high").alias("high")).where(
        (F.col("gone") <= F.col("rows") * max_null_fraction) & (F.col("low") < F.col("high"))).collect()
    return {s[0]: tuple(sorted(r.f for r in found if r.k == k)) for k, s in enumerate(steps)}


@dataclass
class Tables:
    """The binned panel twice: in buckets of random rows for training, by series for forecasts."""

    buckets: DataFrame
    series: DataFrame
    features: list[str]
    edges: list[np.ndarray]
    n_bins: int
    horizon: int
    key: tuple[str, ...]
    log1p: bool

    def close(self) -> None:
        self.buckets.unpersist()


def prepare(panel: DataFrame, features: Sequence[str], until: int, y: str, key: Sequence[str], time: str, horizon: int, log1p: bool, bins: int = BINS) -> Tables:
    """Bin the panel once; the quantile edges see rows up to day ``until`` only."""
    labels = [f"y_{h}" for h in range(1, horizon + 1)]
    labelled = add_labels(panel.select(*dict.fromkeys([*key, time, y, *features])), y, horizon, key, time)
    if log1p:
        labelled = labelled.withColumns({c: F.log1p(c) for c in labels})
    labelled = materialise(labelled)
    edges = quantile_edges(labelled.where(F.unix_date(F.col(time)) <= until), features, bins)
    spark = panel.sparkSession
    n = max(spark.sparkContext.defaultParallelism, -(-labelled.count() // BUCKET_ROWS))
    bucketed = labelled.withColumn("_bucket", F.pmod(F.xxhash64(*key, time), F.lit(n)))
    kept = [*features, *labels]
    buckets = binned(pack(bucketed, kept, ["_bucket"], time), len(features), horizon, edges, ["_bucket"]).persist(StorageLevel.MEMORY_AND_DISK)
    series = binned(pack(labelled, kept, key, time), len(features), horizon, edges, key)
    return Tables(buckets, series, list(features), edges, max(len(e) for e in edges) + 2 if edges else 2, horizon, tuple(key), log1p)


def chosen_features(t: Tables, steps: Sequence[tuple], k: int, max_null_fraction: float, rounds: int, depth: int) -> dict[int, tuple[int, ...]]:
    """Per origin the union of the ``k`` features with most gain at the first and at the last horizon.

    Features are screened on the training rows of the origin; with no more than ``k`` of them nothing is fitted.
    """
    allowed = screened(t.buckets, t.features, steps, t.horizon, max_null_fraction)
    ask = [Fit(o, end, h, allowed[o]) for o, end, _, _ in steps for h in (1, t.horizon) if len(allowed[o]) > k]
    fits, gains = boost(t.buckets, ask, len(t.features), t.horizon, t.n_bins, rounds, depth) if ask else ([], np.zeros((0, len(t.features))))
    out = {o: allowed[o] for o, *_ in steps if len(allowed[o]) <= k}
    for fit, gain in zip(fits, gains):
        top = sorted(fit.features, key=lambda f: (-gain[f], t.features[f]))[:k]
        out[fit.origin] = tuple(sorted({*out.get(fit.origin, ()), *top}))
    return out


def train(t: Tables, steps: Sequence[tuple], features: dict[int, tuple[int, ...]], objectives: Sequence[tuple[str, float]], rounds: int, depth: int,
          rate: float) -> list[Fit]:
    """The best objective of every origin and horizon."""
    asked = [Fit(o, end, h, features.get(o, ()), name, power) for o, end, _, _ in steps for h in range(1, t.horizon + 1) for name, power in objectives if features.get(o)]
    fits, _ = boost(t.buckets, asked, len(t.features), t.horizon, t.n_bins, rounds, depth, rate)
    if len(objectives) > 1 and fits:
        fits = best_by_error(fits, errors_of(t.buckets, fits, len(t.features), t.horizon, depth, t.log1p))
    return fits


def predict(t: Tables, fits: Sequence[Fit], depth: int, interval: float) -> DataFrame:
    """(key, origin_id, h, yhat, yhat_p10, yhat_p90, objective): forecasts from the row of the origin's last training day.

    Bands are quantile regressions of the training residuals on the forecast, per series and fit.
    """
    types = dict(t.series.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in t.key) + ", origin_id int, h int, yhat double, yhat_p10 double, yhat_p90 double, objective string, power double"
    n_features, horizon, log1p, key = len(t.features), t.horizon, t.log1p, t.key
    lo, hi = (1 - interval) / 2, (1 + interval) / 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, days, bins, labels in unpacked(batches, n_features, horizon):
            made: list[tuple] = []
            for fit in fits:
                at = np.flatnonzero(days == fit.end)
                if not len(at):
                    continue
                rows = trained_on(fit, days, labels)
                both = np.concatenate([rows, at])
                value = response(fit, raw_score(fit, bins[np.ix_(both, fit.features)], depth))
                yhat, y = value[len(rows):], labels[rows, fit.h - 1]
                low, high = band_around(value[:len(rows)], y, yhat, lo, hi)
                ends = [float(yhat[0]), float(low[0]), float(high[0])]
                made.append((fit.origin, fit.h, *[float(np.expm1(v)) if log1p else v for v in ends], fit.objective, fit.power))
            same = one.take(pa.array([0] * len(made), pa.int64()))
            kinds = [pa.int32(), pa.int32(), *[pa.float64()] * 3, pa.string(), pa.float64()]
            columns = [pa.array([None if isinstance(m[i], float) and np.isnan(m[i]) else m[i] for m in made], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*[same.column(k) for k in key], *columns],
                                             [*key, "origin_id", "h", "yhat", "yhat_p10", "yhat_p90", "objective", "power"])

    return map_arrow(t.series, run, schema)


def with_truth(panel: DataFrame, predictions: DataFrame, origins: DataFrame, y: str, key: Sequence[str], time: str, model: str) -> DataFrame:
    """Test rows of every origin with their forecasts, NULL where there is none."""
    truth = split_rows(panel.select(*key, time, F.col(y).cast("double").alias("y")), origins, "test", time).withColumn(
        "h", (F.datediff(F.col(time), "test_start") + 1).cast("int"))
    return truth.join(predictions, [*key, "origin_id", "h"], "left").select(
        "origin_id", F.col(time).alias("date"), *key, "h", "y", "yhat", "yhat_p10", "yhat_p90", F.lit(model).alias("model"))


def importance(t: Tables, fits: Sequence[Fit], depth: int) -> DataFrame:
    """(origin_id, h, feature, importance, share): rise of the squared error when a feature's values change places.

    One pass over the buckets scores all fits. A bucket holds random rows, dealt by a hash of their
    key, and its rows change places by a permutation that its number fixes, so a re-run gives the same.
    """
    n_features, horizon = len(t.features), t.horizon
    names = t.features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(fits), n_features + 1))
        for one, days, bins, labels in unpacked(batches, n_features, horizon):
            for k, fit in enumerate(fits):
                rows = trained_on(fit, days, labels)
                if not len(rows):
                    continue
                own, y = bins[np.ix_(rows, fit.features)], labels[rows, fit.h - 1]
                per_tree = [tree[2][descend(tree, own, depth)] for tree in fit.trees]
                whole = fit.base + np.sum(per_tree, axis=0)
                before = (response(fit, whole) - y) ** 2
                order = np.random.default_rng([one.column("_bucket")[0].as_py(), fit.h]).permutation(len(rows))
                sums[k, n_features] += len(rows)
                for f in {int(f) for tree in fit.trees for f in tree[0] if f >= 0}:
                    moved = own.copy()
                    moved[:, f] = own[order, f]
                    score = whole.copy()
                    for tree, old in zip(fit.trees, per_tree):
                        if (tree[0] == f).any():
                            score += tree[2][descend(tree, moved, depth)] - old
                    sums[k, fit.features[f]] += ((response(fit, score) - y) ** 2 - before).sum()
        at = [(k, f) for k in range(len(fits)) for f in fits[k].features]
        yield pa.RecordBatch.from_arrays([pa.array([fits[k].origin for k, _ in at], pa.int32()), pa.array([fits[k].h for k, _ in at], pa.int32()),
                                          pa.array([names[f] for _, f in at], pa.string()), pa.array([sums[k, f] for k, f in at], pa.float64()),
                                          pa.array([sums[k, n_features] for k, _ in at], pa.float64())], ["origin_id", "h", "feature", "s", "n"])

    total = map_arrow(t.buckets, run, "origin_id int, h int, feature string, s double, n double").groupBy("origin_id", "h", "feature").agg(
        (F.sum("s") / F.sum("n")).alias("importance"))
    every = F.sum(F.greatest("importance", F.lit(0.0)))
    share = total.groupBy("origin_id", "h").agg(every.alias("_all"))
    return total.join(share, ["origin_id", "h"]).select("origin_id", "h", "feature", "importance",
                                                        F.when(F.col("_all") > 0, F.greatest("importance", F.lit(0.0)) / F.col("_all")).otherwise(0.0).alias("share"))


#: Objectives that the task tries when it is told to: squared error alone, or the Poisson and Tweedie grid.
def objective_grid(name: str = "squared", powers: Sequence[float] = (1.1, 1.3, 1.5)) -> list[tuple[str, float]]:
    """(objective, power) to compare by in-sample error: one for squared and poisson, one per power for tweedie, or ``all``."""
    tweedie = [("tweedie", float(p)) for p in powers]
    return {"squared": [("squared", 0.0)], "poisson": [("poisson", 0.0)], "tweedie": tweedie,
            "all": [("squared", 0.0), ("poisson", 0.0), *tweedie]}[name]


def boosted_forecasts(panel: DataFrame, origins: DataFrame, features: Sequence[str], y: str = "y", key: Sequence[str] = ("product",),
                      time: str = "date", horizon: int = 7, rounds: int = 20, depth: int = 4, rate: float = 0.1, log1p: bool = False,
                      top_k: int = 40, max_null_fraction: float = 0.30, objectives: Sequence[tuple[str, float]] = (("squared", 0.0),),
                      interval: float = 0.80, model: str = "boosted_direct") -> DataFrame:
    """Backtest of boosted trees, one model per origin and horizon for all series.

    Each origin screens ``features`` on its own training rows and keeps the union of the ``top_k`` of
    the first and the last horizon. Labels never reach into the test window and forecasts start
    from the features of the last training day. Raises where no origin has training rows.
    """
    steps = origin_days(origins)
    if not steps:
        raise ValueError("no origin has enough training rows")
    t = prepare(panel, features, min(s[1] for s in steps), y, key, time, horizon, log1p)
    try:
        chosen = chosen_features(t, steps, top_k, max_null_fraction, rounds // 2, depth)
        fits = train(t, steps, chosen, objectives, rounds, depth, rate)
        if not fits:
            raise ValueError("no origin has enough training rows")
        predictions = materialise(predict(t, fits, depth, interval)).drop("objective", "power")
    finally:
        t.close()
    return with_truth(panel, predictions, origins, y, key, time, model)


def feature_importance(panel: DataFrame, origins: DataFrame, features: Sequence[str], y: str = "y", key: Sequence[str] = ("product",),
                       time: str = "date", horizon: int = 7, rounds: int = 20, depth: int = 4, rate: float = 0.1,
                       max_null_fraction: float = 0.30) -> DataFrame:
    """Permutation importance of every screened feature for all origins and horizons."""
    steps = origin_days(origins)
    t = prepare(panel, features, min(s[1] for s in steps), y, key, time, horizon, False)
    try:
        fits = train(t, steps, screened(t.buckets, t.features, steps, horizon, max_null_fraction), [("squared", 0.0)], rounds, depth, rate)
        return materialise(importance(t, fits, depth))
    finally:
        t.close()


NODES = "origin int, h int, objective string, power double, base double, tree int, node int, feature string, threshold int, value double"


def tree_table(spark: SparkSession, fits: Sequence[Fit], names: Sequence[str]) -> DataFrame:
    """Fits as rows, one per node that holds a split or a value; a few thousand however large the panel was."""
    rows = []
    for fit in fits:
        for n, (feature, threshold, value) in enumerate(fit.trees):
            for at in range(len(feature)):
                if at == 0 or feature[(at - 1) // 2] >= 0:
                    name = names[fit.features[feature[at]]] if feature[at] >= 0 else None
                    rows.append((fit.origin, fit.h, fit.objective, fit.power, fit.base, n, at, name, int(threshold[at]), float(value[at])))
    return spark.createDataFrame(rows, NODES)


def fits_of(table: DataFrame, names: Sequence[str], end: int) -> tuple[list[Fit], int]:
    """Fits from their rows, with the depth of their trees."""
    place = {n: i for i, n in enumerate(names)}
    every = tuple(range(len(names)))
    rows = table.collect()
    depth = max((int(np.log2(r.node + 1)) for r in rows), default=0)
    size = (2 << depth) - 1
    fits: dict[tuple, Fit] = {}
    for r in sorted(rows, key=lambda r: (r.origin, r.h, r.tree, r.node)):
        fit = fits.setdefault((r.origin, r.h), Fit(r.origin, end, r.h, every, r.objective, r.power, r.base))
        while len(fit.trees) <= r.tree:
            fit.trees.append((np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)))
        feature, threshold, value = fit.trees[r.tree]
        feature[r.node], threshold[r.node], value[r.node] = -1 if r.feature is None else place[r.feature], r.threshold, r.value
    return list(fits.values()), depth


def bands_of(t: Tables, fits: Sequence[Fit], depth: int, interval: float) -> DataFrame:
    """(key, h, lo, hi): coefficients of the residual quantiles on the forecast, per series and horizon."""
    from demandcast.models.pinball import fit_quantile, level_design

    types = dict(t.series.dtypes)
    key, n_features, horizon = t.key, len(t.features), t.horizon
    ends = ((1 - interval) / 2, (1 + interval) / 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, days, bins, labels in unpacked(batches, n_features, horizon):
            made = []
            for fit in fits:
                rows = trained_on(fit, days, labels)
                value = response(fit, raw_score(fit, bins[np.ix_(rows, fit.features)], depth))
                found = [fit_quantile(level_design(value), labels[rows, fit.h - 1] - value, q) for q in ends]
                made.append((fit.h, *[None if f is None else [*f.tolist(), 0.0][:2] for f in found]))
            same = one.take(pa.array([0] * len(made), pa.int64()))
            yield pa.RecordBatch.from_arrays([*[same.column(k) for k in key], pa.array([m[0] for m in made], pa.int32()),
                                              *[pa.array([m[i] for m in made], pa.list_(pa.float64())) for i in (1, 2)]], [*key, "h", "lo", "hi"])

    return map_arrow(t.series, run, ", ".join(f"`{k}` {types[k]}" for k in key) + ", h int, lo array<double>, hi array<double>")


def save_final(panel: DataFrame, folder: str, version: str, features: Sequence[str], y: str = "y", key: Sequence[str] = ("product",),
               time: str = "date", horizon: int = 7, rounds: int = 20, depth: int = 4, rate: float = 0.1, log1p: bool = False, top_k: int = 40,
               max_null_fraction: float = 0.30, objectives: Sequence[tuple[str, float]] = (("squared", 0.0),), interval: float = 0.80) -> list[str]:
    """Refit on the full history and store trees, bin edges, band coefficients and a manifest; returns the features used.

    Below ``<folder>/final/<version>``: ``trees`` (with the objective chosen per horizon), ``edges``
    and ``bands``. The manifest names features, horizon, objectives and scale.
    """
    from demandcast.sources.writers import write_manifest

    spark = panel.sparkSession
    last = panel.agg(F.max(F.unix_date(F.col(time)))).first()[0]
    t = prepare(panel, features, last, y, key, time, horizon, log1p)
    try:
        steps = [(0, last, last + 1, last + horizon)]
        chosen = chosen_features(t, steps, top_k, max_null_fraction, rounds // 2, depth)
        # A label counts where it is known: the last rows of a series have none.
        fits = train(t, steps, chosen, objectives, rounds, depth, rate)
        if not fits:
            raise ValueError("no training rows")
        root = f"{folder}/final/{version}"
        used = [t.features[f] for f in chosen[0]]
        tree_table(spark, fits, t.features).coalesce(1).write.mode("overwrite").parquet(f"{root}/trees")
        spark.createDataFrame([(n, t.edges[t.features.index(n)].tolist()) for n in used], "feature string, edges array<double>").coalesce(1).write.mode(
            "overwrite").parquet(f"{root}/edges")
        bands_of(t, fits, depth, interval).write.mode("overwrite").parquet(f"{root}/bands")
    finally:
        t.close()
    write_manifest(spark, folder, "boosted_direct", version, {
        "features": used, "horizon": horizon, "log1p": log1p, "key": list(key), "time": time, "interval": interval,
        "objectives": [{"h": f.h, "objective": f.objective, "power": f.power} for f in sorted(fits, key=lambda f: f.h)]})
    return used


def score_final(panel: DataFrame, folder: str, version: str, key: Sequence[str] = ("product",), time: str = "date", log1p: bool = False) -> DataFrame:
    """(key, date, h, yhat, yhat_p10, yhat_p90): the days after each series' last row, by a stored version."""
    spark = panel.sparkSession
    root = f"{folder}/final/{version}"
    stored = {r.feature: np.array(r.edges) for r in spark.read.parquet(f"{root}/edges").collect()}
    names = sorted(stored)
    fits, depth = fits_of(spark.read.parquet(f"{root}/trees"), names, 0)
    last = panel.groupBy(*key).agg(F.max(time).alias("_last"), F.max_by(F.array(*[no_nan(col(c).cast("double")) for c in names]), time).alias("_x"))
    types = dict(last.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in key) + f", _last {types['_last']}, h int, yhat double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, len(names))
            bins = bin_numbers(x, [stored[n] for n in names])
            for fit in fits:
                yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in key], batch.column("_last"), pa.array([fit.h] * batch.num_rows, pa.int32()),
                                                  pa.array(response(fit, raw_score(fit, bins, depth)))], [*key, "_last", "h", "yhat"])

    scored = map_arrow(last, run, schema).join(spark.read.parquet(f"{root}/bands"), [*key, "h"], "left")
    ends = [F.col("yhat") + F.get(c, F.lit(0)) + F.get(c, F.lit(1)) * F.col("yhat") for c in ("lo", "hi")]
    values = {"yhat": F.col("yhat"), "yhat_p10": F.least(*ends), "yhat_p90": F.greatest(*ends)}
    return scored.select(*key, F.date_add("_last", F.col("h")).alias("date"), "h", *[(F.expm1(v) if log1p else v).alias(n) for n, v in values.items()])
