"""Settings shared by every operator, with the defaults of the forecasting task."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class ForecastConfig:
    """One immutable bag of knobs; pass ``replace(cfg, ...)`` copies around."""

    target: str = "y"
    key: tuple[str, ...] = ("product",)
    time: str = "date"
    horizon: int = 7
    n_origins: int = 4
    min_train_days: int = 150
    top_k_features: int = 40
    max_null_fraction: float = 0.30
    log1p_target: bool = False
    cap_outliers: bool = False
    outlier_quantile: float = 0.995
    rich_calendar: bool = True
    business_aggregates: bool = True
    exog_spec: dict[str, str] = field(
        default_factory=lambda: {
            "wx_temperature_2m": "mean",
            "wx_precipitation": "sum",
            "wx_cloudcover": "mean",
        }
    )
    holiday_col: str = "is_holiday"
    objective: str = "squared"
    tweedie_powers: tuple[float, ...] = (1.1, 1.3, 1.5)
    lookback: int = 30
    interval: float = 0.80
    bootstrap_samples: int = 50
    seed: int = 42
