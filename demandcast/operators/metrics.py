"""Forecast accuracy as additive parts.

Every metric is a ratio of sums, so one pass over the forecast table yields the parts per
finest group; coarser reports add up parts instead of reading forecasts again.

Missing values follow the task's rules: MAE, RMSE and coverage use complete pairs; MAPE
looks at rows with a non-zero truth and turns NULL if one of them has no forecast; sMAPE
turns NULL if any row lacks a value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandcast.functions.columns import col

PARTS = (
    "n_rows", "n_pairs", "abs_err", "sq_err", "n_mape", "n_mape_missing", "rel_err",
    "sym_err", "n_band", "n_inside",
)


def metric_parts(df: DataFrame, by: Sequence[str], y: str = "y", yhat: str = "yhat", lo: str = "yhat_p10",
                 hi: str = "yhat_p90", eps: float = 1e-6) -> DataFrame:
    t, p = F.col(y), F.col(yhat)
    err = F.abs(t - p)
    nonzero = F.abs(t) > eps
    bands = {lo, hi} <= set(df.columns)
    band_known = t.isNotNull() & F.col(lo).isNotNull() & F.col(hi).isNotNull() if bands else F.lit(False)
    inside = t.between(F.col(lo), F.col(hi)) if bands else F.lit(False)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(err).alias("n_pairs"),
        F.sum(err).alias("abs_err"),
        F.sum(err * err).alias("sq_err"),
        F.count_if(nonzero).alias("n_mape"),
        F.count_if(nonzero & p.isNull()).alias("n_mape_missing"),
        F.sum(F.when(nonzero, F.abs((t - p) / t))).alias("rel_err"),
        F.sum(err * 2.0 / F.greatest(F.abs(t) + F.abs(p), F.lit(eps))).alias("sym_err"),
        F.count_if(band_known).alias("n_band"),
        F.count_if(band_known & inside).alias("n_inside"),
    )


def add_parts(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    return parts.groupBy(*by).agg(*[F.sum(c).alias(c) for c in PARTS])


def finish_metrics(parts: DataFrame, by: Sequence[str], coverage: bool = True) -> DataFrame:
    c = F.col
    out: dict[str, Column] = {
        "MAE": F.try_divide("abs_err", "n_pairs"),
        "RMSE": F.sqrt(F.try_divide("sq_err", "n_pairs")),
        "MAPE": F.when(c("n_mape_missing") == 0, F.try_divide("rel_err", "n_mape") * 100.0),
        "sMAPE": F.when(c("n_pairs") == c("n_rows"), F.try_divide("sym_err", "n_rows") * 100.0),
    }
    if coverage:
        out["COV_p10_p90_%"] = F.try_divide("n_inside", "n_band") * 100.0
    return parts.select(*[col(b) for b in by], *[v.alias(k) for k, v in out.items()])


def summarise_metrics(forecasts: DataFrame, by: Sequence[str] = ("model",), **names) -> DataFrame:
    """Metrics per horizon and overall; the overall row has ``h`` NULL and level 'overall'."""
    parts = metric_parts(forecasts, [*by, "h"], **names)
    per_h = parts.where(F.col("h").isNotNull()).withColumn("level", F.lit("h"))
    total = add_parts(parts, by).withColumn("h", F.lit(None).cast("int")).withColumn("level", F.lit("overall"))
    keep = [*by, "level", "h"]
    return finish_metrics(per_h.select(*keep, *PARTS).unionByName(total.select(*keep, *PARTS)), keep)


def metrics_by_h(forecasts: DataFrame, by: Sequence[str] = ("model",), **names) -> DataFrame:
    parts = metric_parts(forecasts.where(F.col("h").isNotNull()), [*by, "h"], **names)
    return finish_metrics(parts, [*by, "h"])


def metrics_overall(forecasts: DataFrame, by: Sequence[str] = ("model",), **names) -> DataFrame:
    return finish_metrics(metric_parts(forecasts, by, **names), by)


def metrics_by_product(forecasts: DataFrame, by: Sequence[str] = ("model",),
                       product: Sequence[str] = ("product",)) -> DataFrame:
    keys = [*by, *product, "h"]
    return finish_metrics(metric_parts(forecasts.where(F.col("h").isNotNull()), keys), keys).select(
        *keys, "MAE", "sMAPE")


def pool_baselines(df: DataFrame, members: Sequence[str] = ("naive1", "snaive7", "ma7"),
                   name: str = "baselines") -> DataFrame:
    """Add a ``family`` column in which the baselines count as one family."""
    return df.withColumn("family", F.when(F.col("model").isin(*members), name).otherwise(F.col("model")))


def mape_clamped(y: str = "y", yhat: str = "yhat", eps: float = 1e-6) -> Column:
    """MAPE variant that keeps zero truths and clamps the denominator; NULLs poison it."""
    err = F.abs(F.col(y) - F.col(yhat))
    mean = F.avg(err / F.greatest(F.abs(F.col(y)), F.lit(eps))) * 100.0
    return F.when(F.count(err) == F.count(F.lit(1)), mean)


def seasonal_scale(panel: DataFrame, origins: DataFrame, y: str = "y", key: Sequence[str] = ("product",),
                   time: str = "date", season: int = 7) -> DataFrame:
    """Mean |y_t - y_(t-season)| on the training rows of each origin; a NULL value poisons it.

    Differences are summed per training segment and the segments are added up per origin.
    """
    from pyspark.sql import Window

    from demandcast.operators.splits import origin_list, segment, training_origins

    w = Window.partitionBy(*key).orderBy(time)
    rows = panel.select(*key, time, y).withColumns({
        "_d": F.abs(F.col(y) - F.lag(y, season).over(w)),
        "_k": F.row_number().over(w),
        "_origins": origin_list(origins),
    }).withColumn("_seg", segment(time))
    paired = F.col("_k") > season
    sums = rows.groupBy(*key, "_seg", "_origins").agg(
        F.sum(F.when(paired, F.col("_d"))).alias("_sum"), F.count_if(paired).alias("_n"),
        F.count_if(paired & F.col("_d").isNull()).alias("_bad"))
    per_origin = sums.withColumn("_o", F.explode(training_origins(F.col("_seg"))))
    return per_origin.groupBy(*key, F.col("_o.origin_id").alias("origin_id")).agg(
        F.when(F.sum("_bad") == 0, F.try_divide(F.sum("_sum"), F.sum("_n"))).alias("scale"))


def mase(forecasts: DataFrame, scale: DataFrame, key: Sequence[str] = ("product",), eps: float = 1e-6) -> DataFrame:
    """MAE over the seasonal naive training error, per origin, series and model."""
    parts = metric_parts(forecasts, ["origin_id", *key, "model"])
    whole = F.when(F.col("n_pairs") == F.col("n_rows"), F.try_divide("abs_err", "n_rows"))
    return parts.join(scale, ["origin_id", *key], "left").select(
        "origin_id", *key, "model", F.when(F.col("scale") >= eps, whole / F.col("scale")).alias("MASE"))


def panel_errors(df: DataFrame, real: str = "real", fitted: str = "forecast", by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE and MAPE over complete pairs; MAPE is NULL when any real value is 0."""
    pairs = df.where(F.col(real).isNotNull() & F.col(fitted).isNotNull())
    err = F.col(real) - F.col(fitted)
    return pairs.groupBy(*by).agg(
        F.sqrt(F.avg(err * err)).alias("RMSE"), F.avg(F.abs(err)).alias("MAE"),
        F.when(F.count_if(F.col(real) == 0) == 0, F.avg(F.abs(F.try_divide(err, F.col(real)))) * 100.0).alias("MAPE"))
