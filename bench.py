"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from catalog import base, load  # noqa: E402
from demandcast.models import series  # noqa: E402
from demandcast.operators import baselines, metrics, splits  # noqa: E402
from demandcast.operators.grid import complete_calendar  # noqa: E402
from demandcast.plans.panel import feature_panel  # noqa: E402
from demandcast.session import build_session, materialise  # noqa: E402

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
NAMED = ("tx_hourly_grid", "tx_daily_by_product", "weekday_hour_sum", "amount_box", "pareto_products",
         "cumulative_revenue", "panel_features_full", "metrics_by_h", "ensemble_metrics", "kpi_row", "supply_detail",
         "quality_report", "tx_weather_join", "fit_additive", "fit_seasonal_ar", "fit_sequence_regression",
         "fit_boosted_direct")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS, spark__ui__enabled="false",
                          spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    queries = load()[0]
    times: dict[str, float] = {}

    def timed(name: str, job) -> None:
        start = time.perf_counter()
        run(job())
        times[name] = round(time.perf_counter() - start, 3)

    run(queries["top_seller"](spark, SF))  # start the workers before the clock runs

    for name in NAMED:
        timed(name, lambda name=name: queries[name](spark, SF))

    # Many series: one per supplier, gaps filled with zero sales.
    start = time.perf_counter()
    raw = base.panel(spark, SF, "supplier")
    wide = materialise(complete_calendar(raw, fill={"y": 0.0, "revenue": 0.0}))
    times["wide_panel_build"] = round(time.perf_counter() - start, 3)
    n_rows = wide.count()
    timed("wide_feature_panel", lambda: feature_panel(raw, fill={"y": 0.0, "revenue": 0.0}))
    origins = materialise(splits.history_gate(splits.rolling_origins(wide)))
    timed("wide_baseline_backtest", lambda: metrics.metrics_by_h(baselines.baseline_forecasts(wide, origins)))
    timed("wide_additive_backtest", lambda: series.additive_forecasts(wide, origins))
    timed("wide_seasonal_ar_backtest", lambda: series.seasonal_ar_forecasts(wide, origins))
    n_series = wide.agg(F.count_distinct("product")).first()[0]

    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": SF,
        "wide_panel": {"rows": n_rows, "series": n_series,
                       "feature_rows_per_sec": round(n_rows / times["wide_feature_panel"]),
                       "additive_fits_per_sec": round(4 * n_series / times["wide_additive_backtest"]),
                       "seasonal_ar_fits_per_sec": round(4 * n_series / times["wide_seasonal_ar_backtest"])},
    }))


if __name__ == "__main__":
    main()
