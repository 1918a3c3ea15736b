"""End-to-end jobs: backtest, store, log and register; and the dashboard bundle."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.config import ForecastConfig
from demandcast.operators import kpi
from demandcast.operators.metrics import mase, metrics_by_h, metrics_by_product, metrics_overall, seasonal_scale
from demandcast.operators.selection import ensemble_forecasts, model_ranking, select_family, winners
from demandcast.operators.splits import history_gate, rolling_origins
from demandcast.operators.supply import finance_summary, last_prices, supply_detail, supply_summary
from demandcast.plans.panel import FAMILIES, run_backtest
from demandcast.session import materialise
from demandcast.sources import writers


def backtest_job(panel: DataFrame, folder: str, cfg: ForecastConfig = ForecastConfig(),
                 families: Sequence[str] = FAMILIES, weights: Sequence[float] | None = None) -> DataFrame:
    """Backtest all families, store forecasts and metrics, log the run, register the best.

    Returns the family ranking. The forecast table is written once and feeds every report. Each
    call logs under a run id of its own, with its settings as parameters.
    """
    settings = {**asdict(cfg), "families": ",".join(families)}
    run_id = writers.new_run_id(settings)
    fc = materialise(run_backtest(panel, cfg, families))
    writers.write_forecasts(fc, folder)
    by_h, overall = metrics_by_h(fc, ["family"]), metrics_overall(fc, ["family"])
    by_h, overall = materialise(by_h), materialise(overall)
    writers.append_log(writers.run_log(overall, by_h, model="family").withColumn("run_id", F.lit(run_id)), f"{folder}/runs")
    told = writers.parameter_log(panel.sparkSession, "backtest", settings, {"stage": "backtest"})
    writers.append_log(told.withColumn("run_id", F.lit(run_id)), f"{folder}/parameters")
    metrics_by_product(fc, ["family"]).write.mode("overwrite").parquet(f"{folder}/metrics_by_product")
    origins = history_gate(rolling_origins(panel, cfg.n_origins, cfg.horizon, cfg.time), cfg.min_train_days)
    mase(fc, seasonal_scale(panel, origins, cfg.target, cfg.key, cfg.time), cfg.key).write.mode("overwrite").parquet(f"{folder}/mase")
    model_ranking(overall, model="family").write.mode("overwrite").parquet(f"{folder}/ranking")
    won = winners(fc, "family")
    won.write.mode("overwrite").parquet(f"{folder}/winners_by_product_h")
    ensemble_forecasts(fc, won, "family").write.mode("overwrite").parquet(f"{folder}/ensemble")
    ranked = materialise(select_family(by_h, weights=weights, model="family"))
    best = ranked.where("rank = 1").select(F.col("family").alias("model"), F.col("score_sMAPE").alias("sMAPE"))
    writers.write_registry(best, folder, cfg.horizon)
    return ranked.join(overall, "family")


def dashboard(df: DataFrame, recipes: DataFrame, costs: DataFrame, horizon: int = 7) -> dict[str, DataFrame]:
    """Every number of the dashboard for one slice of sales, as lazy tables.

    The slice is stored once; each table reads it with its own columns.
    """
    df = materialise(df)
    forecasts = materialise(kpi.product_forecasts(df, horizon))
    detail = supply_detail(forecasts, last_prices(df), recipes, costs)
    view = kpi.validation_view(df, horizon)
    return {
        "kpis": kpi.kpi_row(df),
        "forecasts": forecasts,
        "series": kpi.actual_and_forecast(df, forecasts),
        "change": kpi.forecast_change(df, forecasts, horizon),
        "validation": view,
        "errors": kpi.validation_errors(view),
        "supply": detail,
        "ingredients": supply_summary(detail),
        "finance": finance_summary(detail),
    }
