"""Forecast bands from training residuals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def residual_quantiles(residuals: DataFrame, key: Sequence[str], lo: float = 0.1, hi: float = 0.9) -> DataFrame:
    """Empirical residual percentiles per group (at most one residual per day and series)."""
    p = F.percentile("residual", F.array(F.lit(lo), F.lit(hi)))
    return residuals.groupBy(*key).agg(p.alias("_p")).select(
        *key, F.get("_p", F.lit(0)).alias("r_lo"), F.get("_p", F.lit(1)).alias("r_hi"))


def residual_bands(forecasts: DataFrame, residuals: DataFrame, key: Sequence[str]) -> DataFrame:
    """Centre forecast plus the residual percentiles of its group."""
    out = forecasts.drop("yhat_p10", "yhat_p90").join(residual_quantiles(residuals, key), list(key), "left")
    return out.withColumns({"yhat_p10": F.col("yhat") + F.col("r_lo"), "yhat_p90": F.col("yhat") + F.col("r_hi")}).drop(
        "r_lo", "r_hi")


def _percentile(sorted_values: Column, q: float) -> Column:
    pos = (F.size(sorted_values) - 1) * F.lit(q)
    low = F.floor(pos).cast("int")
    a, b = F.get(sorted_values, low), F.get(sorted_values, F.ceil(pos).cast("int"))
    return a + (b - a) * (pos - low)


def bootstrap_bands(forecasts: DataFrame, residuals: DataFrame, key: Sequence[str], samples: int = 50,
                    seed: int = 42) -> DataFrame:
    """Mean, p10 and p90 of ``samples`` residual draws around each forecast.

    A draw is picked by a digest of (group, horizon, date, draw number, seed), so a re-run, a
    recomputed partition or another engine draws the same residuals.
    """
    pool = residuals.where(F.col("residual").isNotNull()).groupBy(*key).agg(
        F.sort_array(F.collect_list("residual")).alias("_pool"))
    rows = forecasts.drop("yhat_p10", "yhat_p90").join(pool, list(key), "left")
    identity = F.concat_ws("|", *[F.col(c).cast("string") for c in (*key, "h", "date")])

    def pick(i: Column) -> Column:
        digest = F.md5(F.concat_ws("|", identity, i.cast("string"), F.lit(str(seed))))
        return F.pmod(F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint"), F.size("_pool")).cast("int")

    draws = F.sort_array(F.transform(F.sequence(F.lit(1), F.lit(samples)), lambda i: F.col("yhat") + F.get("_pool", pick(i))))
    out = rows.withColumn("_d", draws)
    mean = F.aggregate("_d", F.lit(0.0), lambda a, v: a + v) / samples
    return out.withColumns({"yhat": mean, "yhat_p10": _percentile(F.col("_d"), 0.1),
                            "yhat_p90": _percentile(F.col("_d"), 0.9)}).drop("_d", "_pool")
