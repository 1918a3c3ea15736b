"""The feature panel in the order the task builds it, and the backtest over all families."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.config import ForecastConfig
from demandcast.models.arma import seasonal_arma_forecasts
from demandcast.models.direct import boosted_forecasts, glm_grid_forecasts, sequence_forecasts
from demandcast.models.series import additive_forecasts, seasonal_ar_forecasts
from demandcast.operators import features as fe
from demandcast.operators.baselines import baseline_forecasts
from demandcast.operators.clean import clip_at_quantile
from demandcast.operators.grid import complete_calendar
from demandcast.operators.metrics import pool_baselines
from demandcast.operators.rollup import daily_exogenous
from demandcast.operators.splits import final_origin, future_days, history_gate, rolling_origins
from demandcast.session import materialise


def feature_panel(base: DataFrame, exog: DataFrame | None = None, holidays: DataFrame | None = None,
                  cfg: ForecastConfig = ForecastConfig(), fill: dict | None = None, readings: DataFrame | None = None) -> DataFrame:
    """Base panel (unique per series and day) to the full causal feature panel.

    ``exog`` has one row per day; ``readings`` are finer ones (hourly weather, holiday flags), which ``cfg.exog_spec`` sums
    up by day.
    The completed panel is written once, because day totals and feature windows both read it.
    """
    key, time, y = cfg.key, cfg.time, cfg.target
    panel = base if exog is None else fe.join_exogenous(base, exog, time)
    daily = None if readings is None else daily_exogenous(readings, cfg.exog_spec, cfg.holiday_col, time)
    panel = panel if daily is None else fe.join_exogenous(panel, daily, time)
    panel = complete_calendar(panel, key, time, fill)
    panel, _ = fe.rebuild_rollings(panel, y, key, time)
    if cfg.cap_outliers:
        panel = clip_at_quantile(panel, y, cfg.outlier_quantile, key)
    panel = materialise(panel)
    if cfg.rich_calendar:
        panel = fe.add_holiday_neighbours(fe.add_calendar(panel, time, cfg.holiday_col), time, cfg.holiday_col)
        if holidays is not None:
            panel = fe.join_holiday_list(panel, holidays, time)
    if cfg.business_aggregates:
        panel = fe.add_business_lag(panel, y, key, time)
    return fe.add_causal_features(panel, y, key, time)


FAMILIES = ("baselines", "additive", "seasonal_ar", "seasonal_arma", "boosted_direct", "glm_direct", "sequence_direct")


def fit_family(name: str, panel: DataFrame, origins: DataFrame, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Forecast rows of one family over the given origins, with the settings of ``cfg``."""
    common = dict(y=cfg.target, key=cfg.key, time=cfg.time)
    direct = dict(horizon=cfg.horizon, interval=cfg.interval, **common)
    run = {
        "baselines": lambda: baseline_forecasts(panel, origins, **common),
        "additive": lambda: additive_forecasts(panel, origins, **common),
        "seasonal_ar": lambda: seasonal_ar_forecasts(panel, origins, **common),
        "seasonal_arma": lambda: seasonal_arma_forecasts(panel, origins, **common),
        "arma_bootstrap": lambda: seasonal_arma_forecasts(panel, origins, samples=cfg.bootstrap_samples, seed=cfg.seed, model="arma_bootstrap", **common),
        "boosted_direct": lambda: boosted_forecasts(
            panel, origins, log1p=cfg.log1p_target, top_k=cfg.top_k_features, max_null_fraction=cfg.max_null_fraction,
            objective=cfg.objective, powers=cfg.tweedie_powers, **direct),
        "glm_direct": lambda: glm_grid_forecasts(panel, origins, powers=cfg.tweedie_powers, max_null_fraction=cfg.max_null_fraction, **direct),
        "sequence_direct": lambda: sequence_forecasts(panel, origins, lookback=cfg.lookback, log1p=cfg.log1p_target, **direct),
    }
    return run[name]()


def run_backtest(panel: DataFrame, cfg: ForecastConfig = ForecastConfig(),
                 families: Sequence[str] = FAMILIES) -> DataFrame:
    """Forecast rows of every family over all origins, with a ``family`` column."""
    origins = materialise(history_gate(rolling_origins(panel, cfg.n_origins, cfg.horizon, cfg.time), cfg.min_train_days))
    parts = [fit_family(f, panel, origins, cfg) for f in families]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return pool_baselines(out)


def final_forecasts(panel: DataFrame, family: str, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """The chosen family refitted on the full history: forecasts of the ``cfg.horizon`` days after it, for every series.

    Every family has this form. Inputs of the days to come are unknown: linear families carry the
    last known values on, direct ones start from the last day's features.
    """
    key, time = cfg.key, cfg.time
    origin = materialise(final_origin(panel, cfg.horizon, time))
    ahead = future_days(panel.select(*key).distinct(), origin).select(*key, F.col("date").alias(time))
    longer = materialise(panel.unionByName(ahead, allowMissingColumns=True))
    return fit_family(family, longer, origin, cfg).drop("origin_id", "y").where(F.col("h").between(1, cfg.horizon))
