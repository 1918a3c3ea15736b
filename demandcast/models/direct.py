"""Direct multi-horizon models by name, with the choice of inputs that they share.

One model per origin and horizon serves all series. Training rows end ``h`` days before the
origin's ``train_end``, so no label reaches into the test window, and forecasts start from
the features at ``train_end``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandcast.models import boosting, glm, sequence
from demandcast.models.boosting import objective_grid
from demandcast.operators.clean import LABEL, numeric_columns, screen_features, sequence_features


def candidate_features(df: DataFrame, target: str = "y", key: Sequence[str] = ("product", "date"),
                       max_null_fraction: float = 0.30) -> list[str]:
    """Names kept by the feature screen (one small row per column reaches the driver)."""
    kept = screen_features(df, target, key, max_null_fraction).where("kept").select("feature").collect()
    return [r.feature for r in kept]


def possible_inputs(df: DataFrame, target: str = "y", key: Sequence[str] = ("product", "date")) -> list[str]:
    """Numeric columns that are neither key, target nor label; each origin screens them on its own training rows."""
    return [c for c in numeric_columns(df, (target, *key)) if not LABEL.fullmatch(c)]


def union_top(importance: DataFrame, k: int = 40, horizons: Sequence[int] = (1, 7), group: Sequence[str] = ("origin_id",)) -> DataFrame:
    """Distinct union of the ``k`` most important features of each of ``horizons``, per group.

    Equal importances are ranked by name. ``importance`` has (group, h, feature, importance), a row per feature.
    """
    ranked = Window.partitionBy(*group, "h").orderBy(F.col("importance").desc_nulls_last(), "feature")
    top = importance.where(F.col("h").isin(*horizons)).withColumn("_r", F.row_number().over(ranked)).where(F.col("_r") <= k)
    return top.select(*group, "feature").distinct().orderBy(*group, "feature")


def boosted_forecasts(panel: DataFrame, origins: DataFrame, features: Sequence[str] | None = None, y: str = "y",
                      key: Sequence[str] = ("product",), time: str = "date", horizon: int = 7, max_iter: int = 20,
                      max_depth: int = 4, rate: float = 0.1, log1p: bool = False, top_k: int = 40, max_null_fraction: float = 0.30,
                      objective: str = "squared", powers: Sequence[float] = (1.1, 1.3, 1.5), interval: float = 0.80,
                      model: str = "boosted_direct") -> DataFrame:
    """Gradient-boosted trees per origin and horizon; see :func:`demandcast.models.boosting.boosted_forecasts`."""
    features = possible_inputs(panel, y, (*key, time)) if features is None else list(features)
    return boosting.boosted_forecasts(panel, origins, features, y, key, time, horizon, max_iter, max_depth, rate, log1p, top_k, max_null_fraction,
                                      objective_grid(objective, powers), interval, model)


def glm_grid_forecasts(panel: DataFrame, origins: DataFrame, features: Sequence[str] | None = None, y: str = "y",
                       key: Sequence[str] = ("product",), time: str = "date", horizon: int = 7,
                       powers: Sequence[float] = (1.1, 1.3, 1.5), poisson: bool = True, reg: float = 0.01,
                       max_null_fraction: float = 0.30, interval: float = 0.80, model: str = "glm_direct") -> DataFrame:
    """Poisson and Tweedie objectives per origin and horizon; the best in-sample MAE is kept. Today's target is an input."""
    features = [y, *possible_inputs(panel, y, (*key, time))] if features is None else list(features)
    return glm.glm_forecasts(panel, origins, features, y, key, time, horizon, "all" if poisson else "tweedie", powers, reg, max_null_fraction,
                             interval, model)


def sequence_forecasts(panel: DataFrame, origins: DataFrame, features: Sequence[str] | None = None, y: str = "y",
                       key: Sequence[str] = ("product",), time: str = "date", lookback: int = 30, horizon: int = 7,
                       ridge: float = 1.0, log1p: bool = False, interval: float = 0.80, model: str = "sequence_direct") -> DataFrame:
    """Look-back regression on every numeric channel; see :func:`demandcast.models.sequence.sequence_forecasts`."""
    channels = sequence_features(panel, y, (*key, time)) if features is None else list(features)
    return sequence.sequence_forecasts(panel, origins, channels, y, key, time, lookback, horizon, ridge, log1p, interval, model)


def save_final_boosted(panel: DataFrame, folder: str, version: str, features: Sequence[str] | None = None, y: str = "y",
                       key: Sequence[str] = ("product",), time: str = "date", horizon: int = 7, max_iter: int = 20,
                       max_depth: int = 4, rate: float = 0.1, log1p: bool = False, top_k: int = 40, max_null_fraction: float = 0.30,
                       objective: str = "squared", powers: Sequence[float] = (1.1, 1.3, 1.5), interval: float = 0.80) -> list[str]:
    """Refit on the full history and store centre, bands and chosen objectives; returns the features used."""
    features = possible_inputs(panel, y, (*key, time)) if features is None else list(features)
    return boosting.save_final(panel, folder, version, features, y, key, time, horizon, max_iter, max_depth, rate, log1p, top_k, max_null_fraction,
                               objective_grid(objective, powers), interval)


def score_final_boosted(panel: DataFrame, folder: str, version: str, key: Sequence[str] = ("product",), time: str = "date",
                        log1p: bool = False) -> DataFrame:
    """Forecast the days after each series' last row with the stored trees and bands."""
    return boosting.score_final(panel, folder, version, key, time, log1p)
