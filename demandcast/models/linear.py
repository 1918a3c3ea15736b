"""Least squares for many series at once, from grouped cross-products.

The rows never leave the JVM: each series is reduced to the sums of its cross-products
(map-side combined, so a series with a third of all rows is no problem), the sums of disjoint
training segments are added up per origin, and only one small vector per (series, origin)
goes through an Arrow batch to be solved.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def masked(x: Sequence[Column], y: Column) -> dict[str, Column]:
    """Design and target as columns that are NULL together when any of them is missing."""
    complete = y.isNotNull()
    for c in x:
        complete = complete & c.isNotNull()
    return {**{f"_x{i}": F.when(complete, c) for i, c in enumerate(x)}, "_y": F.when(complete, y)}


def cross_products(p: int) -> list[Column]:
    """Upper triangle of x'x, then x'y, then y'y and the row count, over masked columns."""
    pairs = [f"_x{i} * _x{j}" for i in range(p) for j in range(i, p)]
    sums = [f"sum({t})" for t in (*pairs, *[f"_x{i} * _y" for i in range(p)], "_y * _y")]
    # Written as SQL text: hundreds of terms cost one parse instead of thousands of calls.
    return [F.expr(f"coalesce({t}, 0D) AS _g{k}") for k, t in enumerate([*sums, "CAST(count(_y) AS DOUBLE)"])]


def solve_normal(p: int, ridge: float = 0.0):
    """Batched solver: packed sums to coefficients and residual deviation.

    The first column is the intercept. The others and the target are centred per fit, columns
    without variance (a regressor that never moves in training) get coefficient 0, and the rest
    are scaled to unit length; among collinear ones the answer of least norm is taken. The
    intercept is rebuilt from the means, so a constant regressor leaves the fit as it is without
    it. A series with no more rows than free coefficients yields NULL.
    """
    upper = np.triu_indices(p)

    @F.pandas_udf("coef array<double>, sigma double, n double")
    def solve(packed: pd.Series) -> pd.DataFrame:
        g = np.vstack(packed.to_numpy()) if len(packed) else np.empty((0, p * (p + 1) // 2 + p + 2))
        k = len(upper[0])
        xx = np.zeros((len(g), p, p))
        xx[:, upper[0], upper[1]] = g[:, :k]
        xx[:, upper[1], upper[0]] = g[:, :k]
        xy, yy, n = g[:, k:k + p], g[:, k + p], g[:, k + p + 1]
        rows = np.maximum(n, 1.0)
        mean, level = xx[:, 0, 1:] / rows[:, None], xy[:, 0] / rows
        spread = xx[:, 1:, 1:] - rows[:, None, None] * mean[:, :, None] * mean[:, None, :]
        joint = xy[:, 1:] - (rows * level)[:, None] * mean
        total = np.maximum(yy - rows * level * level, 0.0)
        square = np.einsum("nii->ni", xx[:, 1:, 1:])
        moves = np.einsum("nii->ni", spread) > 1e-10 * np.maximum(square, 1e-300)
        scale = np.sqrt(np.where(moves, np.einsum("nii->ni", spread), 1.0))
        both = moves[:, :, None] & moves[:, None, :]
        unit = np.where(both, spread / scale[:, :, None] / scale[:, None, :], 0.0) + ridge * np.eye(p - 1)
        values, vectors = np.linalg.eigh(unit)
        used = values > 1e-10 * np.maximum(values.max(axis=1, keepdims=True, initial=0.0), 1e-300)
        inverse = np.where(used, 1.0 / np.where(used, values, 1.0), 0.0)
        rotated = np.einsum("nij,ni->nj", vectors, np.where(moves, joint / scale, 0.0))
        slope = np.where(moves, np.einsum("nij,nj->ni", vectors, inverse * rotated) / scale, 0.0)
        beta = np.column_stack([level - np.einsum("ni,ni->n", slope, mean), slope])
        sse = np.maximum(total - 2 * np.einsum("ni,ni->n", slope, joint)
                         + np.einsum("ni,nij,nj->n", slope, spread, slope), 0.0)
        free = n - 1 - used.sum(axis=1)
        fine = (free > 0) & np.isfinite(beta).all(axis=1)
        sigma = np.sqrt(sse / np.where(free > 0, free, 1.0))
        return pd.DataFrame({
            "coef": [b if ok else None for b, ok in zip(beta, fine)],
            "sigma": [s if ok else None for s, ok in zip(sigma, fine)],
            "n": n,
        })

    return solve


def summarise_per_origin(rows: DataFrame, x: Sequence[Column], y: Column, key: Sequence[str], seg: Column,
                         keep: dict[str, tuple[Column, Column, Column]] | None = None) -> DataFrame:
    """Everything a linear forecaster needs, one row per series and origin, in one pass.

    Rows are reduced per (series, segment) first; the few segment rows are then repeated for
    each origin, where training segments add up their sums. ``keep`` collects small row lists
    on the way: name -> (row condition, row struct, condition on ``_o`` for using a kept row's
    segment). Only bounded lists belong there, such as the last few rows or the test rows.

    ``rows`` carry ``_origins``. When they are already partitioned by the series key, none of
    these steps needs another exchange.
    """
    keep = keep or {}
    sums = rows.withColumns({"_seg": seg, **masked(x, y)}).groupBy(*key, "_seg", "_origins").agg(
        *cross_products(len(x)),
        *[F.collect_list(F.when(cond, point)).alias(name) for name, (cond, point, _) in keep.items()])
    names = [c for c in sums.columns if c.startswith("_g")]
    # Origins are sorted, so the origin at position i trains on segments 0..i.
    each = sums.select("*", F.posexplode("_origins").alias("_i", "_o"))
    stacked = ", ".join(f"sum(CASE WHEN _seg <= _i THEN {c} ELSE 0D END)" for c in names)
    return each.groupBy(*key, F.col("_o.origin_id").alias("origin_id"), F.col("_o.test_start").alias("test_start"),
                        F.col("_o.test_end").alias("test_end")).agg(
        F.expr(f"array({stacked}) AS _packed"),
        *[F.flatten(F.collect_list(F.when(use, F.col(name)))).alias(name) for name, (_, _, use) in keep.items()])


def solve_packed(summary: DataFrame, p: int, ridge: float = 0.0) -> DataFrame:
    """Replace the packed sums by ``coef``, ``sigma`` and ``n`` (NULL without a fit)."""
    solved = summary.withColumn("_f", solve_normal(p, ridge)("_packed"))
    return solved.select("*", "_f.coef", "_f.sigma", "_f.n").drop("_packed", "_f")


def dot(coef: str, x: Sequence[Column]) -> Column:
    total = F.lit(0.0)
    for i, c in enumerate(x):
        total = total + F.get(coef, F.lit(i)) * c
    return total
