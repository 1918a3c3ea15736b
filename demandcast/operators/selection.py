"""Ranking, winner per cell, ensemble and model selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandcast.constants import EXCLUDED_FROM_SIMPLE_BEST, FAMILY_ORDER, METRIC_PRIORITY
from demandcast.operators.metrics import finish_metrics, metric_parts


def model_ranking(overall: DataFrame, metric: str = "sMAPE", model: str = "model") -> DataFrame:
    """Overall metrics ordered by one of them, NULL last, with the rank (one row per model)."""
    w = Window.partitionBy(F.lit(0)).orderBy(F.asc_nulls_last(metric), model)
    return overall.withColumn("rank", F.row_number().over(w)).orderBy("rank")


def winners(forecasts: DataFrame, family: str = "model", key: Sequence[str] = ("product", "h"),
            metric: str = "sMAPE") -> DataFrame:
    """Best family per cell by sMAPE, NULL last, name as tie-break."""
    scored = finish_metrics(metric_parts(forecasts.where(F.col("h").isNotNull()), [*key, family]), [*key, family])
    w = Window.partitionBy(*key).orderBy(F.asc_nulls_last(metric), family)
    return scored.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(*key, family, metric)


def ensemble_forecasts(forecasts: DataFrame, won: DataFrame, family: str = "model",
                       key: Sequence[str] = ("product", "h")) -> DataFrame:
    """Winner-takes-all: the forecast rows of the winning family of each cell."""
    return forecasts.join(won.select(*key, family), [*key, family])


def weighted_scores(by_h: DataFrame, metrics: Sequence[str] = METRIC_PRIORITY,
                    weights: Sequence[float] | None = None, model: str = "model") -> DataFrame:
    """Horizon-weighted mean of each metric per model, and the spread of the first one.

    Weights go by horizon order; a list whose length does not match the model's horizons
    counts as uniform. NULL metrics drop out with their weight; a model without any value
    scores infinity.
    """
    w = Window.partitionBy(model)
    place = F.row_number().over(w.orderBy("h"))
    n = F.count(F.lit(1)).over(w)
    one = F.lit(1.0)
    weight = one if not weights else F.when(
        n == len(weights), F.get(F.array(*[F.lit(float(x)) for x in weights]), place - 1)).otherwise(one)
    rows = by_h.withColumn("_w", weight)
    inf = F.lit(float("inf"))

    def score(m: str):
        known = F.col(m).isNotNull()
        den = F.sum(F.when(known, F.col("_w")))
        return F.when(den > 0, F.sum(F.when(known, F.col("_w") * F.col(m))) / den).otherwise(inf).alias(f"score_{m}")

    return rows.groupBy(model).agg(
        *[score(m) for m in metrics], F.coalesce(F.var_pop(metrics[0]), inf).alias("stability_var"))


def select_family(by_h: DataFrame, metrics: Sequence[str] = METRIC_PRIORITY, weights: Sequence[float] | None = None,
                  prefer_stability: bool = True, model: str = "model",
                  family_order: Sequence[str] = FAMILY_ORDER) -> DataFrame:
    """All families ranked by primary score, then spread, then second score; rank 1 is chosen."""
    scores = weighted_scores(by_h, metrics, weights, model)
    known = F.array_position(F.array(*[F.lit(x) for x in family_order]), F.col(model))
    order = [F.asc(f"score_{metrics[0]}")]
    if prefer_stability:
        order.append(F.asc("stability_var"))
    if len(metrics) > 1:
        order.append(F.asc(f"score_{metrics[1]}"))
    order += [F.when(known > 0, known).otherwise(F.lit(len(family_order) + 1)), F.asc(model)]
    return scores.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))


def select_simple(overall: DataFrame, metric: str = "sMAPE", model: str = "model",
                  exclude: Sequence[str] = EXCLUDED_FROM_SIMPLE_BEST) -> DataFrame:
    """Lowest metric among models whose name carries none of the excluded tags."""
    keep = F.col(metric).isNotNull()
    if exclude:
        keep = keep & ~F.lower(model).rlike("|".join(exclude))
    return overall.where(keep).orderBy(metric, model).limit(1)
