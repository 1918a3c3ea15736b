"""Mergeable sums of least-squares models: a refit reads what is new, not the history.

The state of a series is its cross-products per calendar month, with the last rows of
the series for the lags of the next days. States of disjoint days add up, so a month that has passed
is never read again, and the merged state gives the fit of the whole history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.functions.columns import col
from demandcast.models.linear import cross_products, masked, solve_packed
from demandcast.models.series import additive_design

SEASON = 7


def design(model: str, regressors: Sequence[str], time: str = "date") -> list[Column]:
    """Inputs of a model by name: ``additive`` or ``seasonal_ar`` (whose lags are columns ``_l1`` and ``_ls``)."""
    if model == "additive":
        return additive_design(regressors, time)
    return [F.lit(1.0), F.col("_l1"), F.col("_ls"), *[col(c) for c in regressors]]


def month_state(rows: DataFrame, model: str = "seasonal_ar", regressors: Sequence[str] = (), y: str = "y", key: Sequence[str] = ("product",),
                time: str = "date", tail: DataFrame | None = None, season: int = SEASON) -> DataFrame:
    """(key, month, sums): the cross-products of ``rows``, days of filled series, by series and month.

    ``tail`` holds the last ``season`` rows of each series before these (see :func:`tail_rows`); they give lags and are not counted.
    """
    kept = [*key, time, y, *regressors]
    new = rows.select(*kept, F.lit(True).alias("_new"))
    every = new if tail is None else new.unionByName(tail.select(*kept, F.lit(False).alias("_new")))
    w = Window.partitionBy(*key).orderBy(time)
    lagged = every.withColumns({"_l1": F.lag(F.col(y).cast("double"), 1).over(w), "_ls": F.lag(F.col(y).cast("double"), season).over(w)})
    x = design(model, regressors, time)
    named = lagged.where("_new").withColumns({"_month": F.trunc(F.col(time), "month"), **masked(x, F.col(y).cast("double"))})
    sums = named.groupBy(*key, F.col("_month").alias("month")).agg(*cross_products(len(x)))
    return sums.select(*key, "month", F.array(*[F.col(c) for c in sums.columns if c.startswith("_g")]).alias("sums"))


def tail_rows(rows: DataFrame, key: Sequence[str] = ("product",), time: str = "date", season: int = SEASON) -> DataFrame:
    """The last ``season`` rows of each series."""
    newest = Window.partitionBy(*key).orderBy(F.col(time).desc())
    return rows.withColumn("_r", F.row_number().over(newest)).where(F.col("_r") <= season).drop("_r")


def merge(*states: DataFrame, key: Sequence[str] = ("product",)) -> DataFrame:
    """States of disjoint days as one; a month that stands in several is added up."""
    every = states[0]
    for s in states[1:]:
        every = every.unionByName(s)
    flat = every.select(*key, "month", F.posexplode("sums").alias("_i", "_v")).groupBy(*key, "month", "_i").agg(F.sum("_v").alias("_v"))
    return flat.groupBy(*key, "month").agg(F.transform(F.sort_array(F.collect_list(F.struct("_i", "_v"))), lambda s: s["_v"]).alias("sums"))


def fit_state(state: DataFrame, model: str = "seasonal_ar", regressors: Sequence[str] = (), key: Sequence[str] = ("product",),
              until: str | None = None, season: int = SEASON) -> DataFrame:
    """(key, coef, sigma, n) of all months, or of those that begin before the date ``until``."""
    p = len(design(model, regressors))
    length = p * (p + 1) // 2 + p + 2
    used = state if until is None else state.where(F.col("month") < F.lit(until).cast("date"))
    total = used.groupBy(*key).agg(F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(length)]).alias("_packed"))
    return solve_packed(total, p)
