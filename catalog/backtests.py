"""Queries over the rolling-origin backtest: splits, baselines, metrics, selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import BASELINES, ORIGINS, PANEL, PANEL0, metric_sql, plain, query, shown
from catalog.panels import complete
from demandcast.operators import baselines, clean, metrics, selection, splits
from demandcast.session import materialise
from demandcast.sources.writers import run_log

M4 = "MAE RMSE MAPE sMAPE"


def backtest(spark, sf, zero=True):
    """Baseline forecasts. The panel is written once: origins, gate and forecasts all read it."""
    p = materialise(complete(spark, sf, zero).select("product", "date", "y"))
    gated = splits.history_gate(splits.rolling_origins(p))
    return p, gated, baselines.baseline_forecasts(p, gated)


def forecasts(spark, sf, zero=True):
    return backtest(spark, sf, zero)[2]


@query("origins", f"WITH {PANEL}, {ORIGINS} " + shown("origin_id n_train_days", "", "origins", dates="train_end test_start test_end"))
def _(spark, sf):
    return plain(splits.rolling_origins(complete(spark, sf)))


@query("history_gate", f"WITH {PANEL}, {ORIGINS} SELECT origin_id, n_train_days FROM origins WHERE n_train_days >= 2480")
def _(spark, sf):
    return splits.history_gate(splits.rolling_origins(complete(spark, sf)), 2480).select("origin_id", "n_train_days")


@query("split_sizes", f"""WITH {PANEL}, {ORIGINS} SELECT o.origin_id, COUNT(*) FILTER (p.date <= o.train_end) AS n_train,
 COUNT(*) FILTER (p.date BETWEEN o.test_start AND o.test_end) AS n_test FROM panel p, origins o GROUP BY 1""")
def _(spark, sf):
    p = materialise(complete(spark, sf).select("product", "date"))
    origins = splits.rolling_origins(p)
    train = splits.split_rows(p, origins, "train").groupBy("origin_id").agg(F.count("date").alias("n_train"))
    test = splits.split_rows(p, origins, "test").groupBy("origin_id").agg(F.count("date").alias("n_test"))
    return train.join(test, "origin_id")


@query("baseline_forecasts", f"WITH {PANEL}, {BASELINES} " + shown("origin_id product h model", "y yhat", "fc", dates="date"))
def _(spark, sf):
    return plain(forecasts(spark, sf, False).drop("yhat_p10", "yhat_p90"))


@query("forecast_contract", f"""WITH {PANEL0}, {BASELINES} SELECT product, CAST(t.date - test_start + 1 AS INTEGER) AS h, ROUND(t.y, 6) AS y,
 model, CAST(t.date AS VARCHAR) AS date, ROUND(yhat, 6) + 0.0 AS yhat FROM fc t JOIN gated o ON o.origin_id = t.origin_id""")
def _(spark, sf):
    p, gated, fc = backtest(spark, sf)
    raw = fc.drop("h").join(F.broadcast(gated.select("origin_id", "test_start")), "origin_id").withColumnRenamed("y", "units")
    ready = clean.check_forecast(raw, F.col("test_start"))
    return plain(clean.forecast_columns(ready).drop("yhat_p10", "yhat_p90"))


@query("metrics_by_h", f"WITH {PANEL0}, {BASELINES}, m AS ({metric_sql('model', 'h')}) " + shown("model h", M4, "m"))
def _(spark, sf):
    return plain(metrics.metrics_by_h(forecasts(spark, sf)).drop("COV_p10_p90_%"))


@query("metrics_with_gaps", f"""WITH {PANEL}, {BASELINES}, m AS (SELECT model, 'h' AS level, h, MAE, RMSE, MAPE, sMAPE FROM ({metric_sql('model', 'h')}) WHERE h IS NOT NULL
 UNION ALL SELECT model, 'overall', NULL, MAE, RMSE, MAPE, sMAPE FROM ({metric_sql('model')})) """ + shown("model level h", M4, "m"))
def _(spark, sf):
    return plain(metrics.summarise_metrics(forecasts(spark, sf, False)).drop("COV_p10_p90_%"))


@query("metrics_overall", f"WITH {PANEL0}, {BASELINES}, m AS ({metric_sql('model')}) " + shown("model", M4, "m"))
def _(spark, sf):
    return plain(metrics.metrics_overall(forecasts(spark, sf)).drop("COV_p10_p90_%"))


@query("metrics_pooled", f"WITH {PANEL0}, {BASELINES}, p AS (SELECT *, 'baselines' AS family FROM fc), m AS ({metric_sql('family', src='p')}) " + shown("family", M4, "m"))
def _(spark, sf):
    pooled = metrics.pool_baselines(forecasts(spark, sf))
    return plain(metrics.metrics_overall(pooled, ["family"]).drop("COV_p10_p90_%"))


@query("metrics_by_product_h", f"WITH {PANEL0}, {BASELINES}, m AS ({metric_sql('model', 'product', 'h')}) " + shown("model product h", "MAE sMAPE", "m"))
def _(spark, sf):
    return plain(metrics.metrics_by_product(forecasts(spark, sf)))


@query("band_coverage", f"""WITH {PANEL0}, {BASELINES} SELECT model, h, ROUND(100.0 * AVG(CASE WHEN y BETWEEN yhat - 2 AND yhat + 1 THEN 1 ELSE 0 END)
 FILTER (y IS NOT NULL AND yhat IS NOT NULL), 6) + 0.0 AS coverage FROM fc GROUP BY 1, 2""")
def _(spark, sf):
    banded = forecasts(spark, sf).withColumns({"yhat_p10": F.col("yhat") - 2, "yhat_p90": F.col("yhat") + 1})
    return plain(metrics.metrics_by_h(banded).select("model", "h", F.col("`COV_p10_p90_%`").alias("coverage")))


@query("mape_clamped", f"""WITH {PANEL0}, {BASELINES} SELECT model, ROUND(100 * AVG(ABS(y - yhat) / GREATEST(ABS(y), 1e-6)), 4) AS mape FROM fc GROUP BY 1""")
def _(spark, sf):
    return plain(forecasts(spark, sf).groupBy("model").agg(metrics.mape_clamped().alias("mape")), digits=4)


@query("mase_by_product", f"""WITH {PANEL0}, {BASELINES}, dif AS (SELECT product, date, ABS(y - LAG(y, 7) OVER (PARTITION BY product ORDER BY date)) AS d FROM panel),
 sc AS (SELECT o.origin_id, d.product, AVG(d.d) AS scale FROM dif d JOIN gated o ON d.date <= o.train_end GROUP BY 1, 2)
 SELECT f.origin_id, f.product, f.model, ROUND(AVG(ABS(y - yhat)) / ANY_VALUE(sc.scale), 6) + 0.0 AS MASE FROM fc f
 JOIN sc ON sc.origin_id = f.origin_id AND sc.product = f.product GROUP BY 1, 2, 3""")
def _(spark, sf):
    p, gated, fc = backtest(spark, sf)
    return plain(metrics.mase(fc, metrics.seasonal_scale(p, gated)))


@query("model_ranking", f"WITH {PANEL0}, {BASELINES}, m AS ({metric_sql('model')}), r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY sMAPE NULLS LAST, model) AS rank FROM m) "
       + shown("model rank", M4, "r"))
def _(spark, sf):
    return plain(selection.model_ranking(metrics.metrics_overall(forecasts(spark, sf))).drop("COV_p10_p90_%"))


WIN = f"""cells AS ({metric_sql('product', 'h', 'model')}),
 won AS (SELECT product, h, model, sMAPE FROM cells QUALIFY ROW_NUMBER() OVER (PARTITION BY product, h ORDER BY ROUND(sMAPE, 9) NULLS LAST, model) = 1)"""


@query("winners_by_product_h", f"WITH {PANEL0}, {BASELINES}, {WIN} " + shown("product h model", "sMAPE", "won"))
def _(spark, sf):
    return plain(selection.winners(forecasts(spark, sf)))


@query("ensemble_metrics", f"""WITH {PANEL0}, {BASELINES}, {WIN}, e AS (SELECT f.* FROM fc f JOIN won w ON w.product = f.product AND w.h = f.h AND w.model = f.model),
 one AS (SELECT *, 'ensemble' AS name FROM e), m AS ({metric_sql('name', 'h', src='one')}) """ + shown("name h", M4, "m"))
def _(spark, sf):
    fc = materialise(forecasts(spark, sf))
    picked = selection.ensemble_forecasts(fc, selection.winners(fc)).withColumn("name", F.lit("ensemble"))
    return plain(metrics.metrics_by_h(picked, ["name"]).drop("COV_p10_p90_%"))


WEIGHTS = (7, 6, 5, 4, 3, 2, 1)
_W = "CASE h " + " ".join(f"WHEN {i + 1} THEN {w}" for i, w in enumerate(WEIGHTS)) + " END"
SCORES = f"""byh AS ({metric_sql('model', 'h')}), sc AS (SELECT model, """ + ", ".join(
    f"COALESCE(SUM({_W} * {m}) / SUM({_W}) FILTER ({m} IS NOT NULL), CAST('inf' AS DOUBLE)) AS score_{m}" for m in ("sMAPE", "RMSE", "MAE", "MAPE")) + """,
 COALESCE(VAR_POP(sMAPE), CAST('inf' AS DOUBLE)) AS stability_var FROM byh GROUP BY 1)"""
SCORE_COLS = "score_sMAPE score_RMSE score_MAE score_MAPE stability_var"


@query("weighted_score", f"WITH {PANEL0}, {BASELINES}, {SCORES} " + shown("model", SCORE_COLS, "sc"))
def _(spark, sf):
    return plain(selection.weighted_scores(metrics.metrics_by_h(forecasts(spark, sf)), weights=WEIGHTS))


@query("select_family", f"WITH {PANEL0}, {BASELINES}, {SCORES}, r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY score_sMAPE, stability_var, score_RMSE, model) AS rank FROM sc) "
       + shown("model rank", SCORE_COLS, "r"))
def _(spark, sf):
    return plain(selection.select_family(metrics.metrics_by_h(forecasts(spark, sf)), weights=WEIGHTS))


@query("select_simple", f"WITH {PANEL0}, {BASELINES}, m AS ({metric_sql('model')}), r AS (SELECT * FROM m WHERE sMAPE IS NOT NULL ORDER BY sMAPE, model LIMIT 1) "
       + shown("model", M4, "r"))
def _(spark, sf):
    return plain(selection.select_simple(metrics.metrics_overall(forecasts(spark, sf))).drop("COV_p10_p90_%"))


def _log_sql() -> str:
    parts = []
    for m in ("MAE", "RMSE", "sMAPE", "MAPE"):
        parts.append(f"SELECT model AS run, '{m}' AS key, 0 AS step, ROUND({m}, 6) + 0.0 AS value FROM o WHERE {m} IS NOT NULL")
        parts.append(f"SELECT model, '{m}_by_h', h, ROUND({m}, 6) + 0.0 FROM b WHERE {m} IS NOT NULL")
    return " UNION ALL ".join(parts)


@query("run_log", f"WITH {PANEL0}, {BASELINES}, o AS ({metric_sql('model')}), b AS ({metric_sql('model', 'h')}) {_log_sql()}")
def _(spark, sf):
    fc = materialise(forecasts(spark, sf))
    return plain(run_log(metrics.metrics_overall(fc), metrics.metrics_by_h(fc)))
