"""Model jobs on planted signals: recovery, causality, determinism, band coverage."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandcast.models import bands, boosting, direct, series
from demandcast.models.linear import solve_normal
from demandcast.operators import baselines, splits
from demandcast.operators.features import add_causal_features
from demandcast.operators.metrics import metrics_overall
from demandcast.plans.panel import run_backtest


def planted(n_series=6, days=260, noise=1.0, seed=0):
    """Weekly pattern, slow trend, a holiday lift and noise."""
    rng = np.random.default_rng(seed)
    rows = []
    for s in range(n_series):
        week = rng.normal(0, 4, 7)
        for i in range(days):
            d = dt.date(2024, 1, 1) + dt.timedelta(days=i)
            hol = int(i % 29 == 0)
            rows.append((f"p{s}", d, float(20 + 0.02 * i + week[i % 7] + 5 * hol + rng.normal(0, noise)), hol))
    return pd.DataFrame(rows, columns=["product", "date", "y", "is_holiday"])


@pytest.fixture(scope="module")
def panel(spark):
    return spark.createDataFrame(planted()).cache()


@pytest.fixture(scope="module")
def origins(panel):
    return splits.history_gate(splits.rolling_origins(panel))


@pytest.fixture(scope="module")
def naive_mae(panel, origins):
    m = metrics_overall(baselines.baseline_forecasts(panel, origins)).collect()
    return {r.model: r.MAE for r in m}


@pytest.mark.parametrize("fn", [series.additive_forecasts, series.seasonal_ar_forecasts])
def test_series_models_beat_naive_and_cover(panel, origins, naive_mae, fn):
    got = fn(panel, origins)
    assert got.count() == 6 * 28
    m = metrics_overall(got).first()
    assert m.MAE < naive_mae["naive1"] and 60 <= m["COV_p10_p90_%"] <= 95


def test_additive_recovers_the_holiday(panel):
    fit = series.fit_additive(panel, splits.final_origin(panel), ["is_holiday"])
    effects = [r.coef[-1] for r in fit.collect()]
    assert len(effects) == 6 and np.allclose(effects, 5, atol=1.5)


def test_additive_equals_least_squares(spark, panel):
    """The grouped cross-products give the textbook answer."""
    pdf = planted().query("product == 'p0'").reset_index(drop=True)
    d = pd.to_datetime(pdf.date)
    t = (d - pd.Timestamp("2000-01-01")).dt.days / 365.25
    x = np.column_stack([np.ones(len(pdf)), t] + [(d.dt.dayofweek == k).astype(float) for k in range(1, 7)] + [pdf.is_holiday])
    want = x @ np.linalg.lstsq(x, pdf.y, rcond=None)[0]
    got = series.additive_residuals(panel, splits.final_origin(panel), ["is_holiday"]).where(
        "product = 'p0'").orderBy("date").toPandas()
    assert np.allclose(pdf.y - got.residual, want, atol=1e-6)


def test_ar_iteration_matches_a_plain_loop(panel):
    row = series.final_parameters(panel, splits.final_origin(panel), []).where("product = 'p1'").first()
    past = list(row.tail)
    for _ in range(10):
        past.append(row.coef[0] + row.coef[1] * past[-1] + row.coef[2] * past[-7])
    spark = panel.sparkSession
    df = spark.createDataFrame([(row.coef, row.tail)], "coef array<double>, tail array<double>")
    steps = F.array_repeat(F.array().cast("array<double>"), 10)
    got = df.select(series.iterate_ar(F.col("coef"), F.col("tail"), steps).alias("p")).first().p
    assert np.allclose(got, past[7:])


@pytest.mark.parametrize("fn", [series.additive_forecasts, series.seasonal_ar_forecasts])
def test_forecasts_ignore_the_test_window(panel, origins, fn):
    """Changing the last week's truth moves no forecast of the origin before it."""
    last = dt.date(2024, 1, 1) + dt.timedelta(days=259 - 6)
    changed = panel.withColumn("y", F.when(F.col("date") >= last, 500.0).otherwise(F.col("y")))
    a = fn(panel, origins).orderBy("origin_id", "product", "date").select("yhat", "yhat_p10").collect()
    b = fn(changed, origins).orderBy("origin_id", "product", "date").select("yhat", "yhat_p10").collect()
    assert np.allclose(a, b)


def test_a_missing_test_day_moves_no_other_forecast(spark):
    pdf = planted(1, 200)
    full, gap = (spark.createDataFrame(d) for d in (pdf, pdf.drop(index=len(pdf) - 4)))
    o = splits.rolling_origins(full, 1, 7)
    a, b = ({r.h: (r.yhat, r.yhat_p10) for r in series.seasonal_ar_forecasts(p, o, []).collect()} for p in (full, gap))
    assert set(a) - set(b) == {4} and all(np.allclose(a[h], b[h]) for h in b)


def test_leading_gap_is_not_filled_from_the_future(spark):
    """A series whose first value falls into the test window has no training rows."""
    pdf = planted(2)
    late = pdf["product"].eq("p1") & (pdf.index < len(pdf) - 5)
    pdf.loc[late, "y"] = np.nan
    p = spark.createDataFrame(pdf).withColumn("y", F.when(~F.isnan("y"), F.col("y")))
    got = series.additive_forecasts(p, splits.history_gate(splits.rolling_origins(p)))
    assert got.where("product = 'p1' AND yhat IS NOT NULL").count() == 0
    assert got.where("product = 'p1'").count() == 28


def test_constant_regressor_and_short_series(spark):
    pdf = planted(1, 40)
    pdf["is_holiday"] = 0
    short = pd.DataFrame({"product": "s", "date": pdf.date[-10:], "y": 1.0, "is_holiday": 0})
    p = spark.createDataFrame(pd.concat([pdf, short]))
    fit = {r.product: r for r in series.fit_additive(p, splits.final_origin(p), ["is_holiday"]).collect()}
    assert fit["p0"].coef[-1] == pytest.approx(0) and all(np.isfinite(fit["p0"].coef))
    rows = series.seasonal_ar_forecasts(p, splits.rolling_origins(p, 1, 7)).where("product = 's'").collect()
    assert len(rows) == 7 and all(r.yhat is None for r in rows)


def test_a_regressor_that_never_moved_has_no_say(spark):
    """A constant 22 in training and 30 in a request give the forecast of the fit without it."""
    pdf = planted(1, 120)
    p = spark.createDataFrame(pdf.assign(wx=22.0))
    origin = splits.final_origin(p)
    future = spark.createDataFrame([("p0", dt.date(2024, 1, 1) + dt.timedelta(days=120 + i), 30.0) for i in range(3)],
                                   "product string, date date, wx double")
    with_it = series.additive_outlook(p, 3, ["wx"], known=future).orderBy("date").select("yhat", "yhat_p10").collect()
    without = series.additive_outlook(p, 3, []).orderBy("date").select("yhat", "yhat_p10").collect()
    assert np.allclose(with_it, without)
    fits = [series.final_parameters(p, origin, r) for r in (["wx"], [])]
    request = "array(named_struct('wx', 30D), named_struct('wx', 30D))"
    rows = spark.createDataFrame([(1, "p0", 2)], "request_id int, product string, horizon int")
    a = series.score_requests(rows.withColumn("exog", F.expr(request)), fits[0], ["wx"]).first().predictions
    b = series.score_requests(rows.withColumn("exog", F.expr("CAST(NULL AS array<struct<wx:double>>)")), fits[1], []).first().predictions
    assert np.allclose(a, b)


def test_solver_is_stable_on_collinear_columns(spark):
    rng = np.random.default_rng(0)
    x = np.column_stack([np.ones(50), rng.normal(size=50)])
    x = np.column_stack([x, x[:, 1] * 2])
    y = x[:, 1] * 3 + 1
    upper = np.triu_indices(3)
    packed = [*(x.T @ x)[upper], *(x.T @ y), y @ y, 50.0]
    df = spark.createDataFrame([([float(v) for v in packed],)], "g array<double>")
    r = df.select(solve_normal(3)("g").alias("f")).select("f.*").first()
    assert np.allclose(x @ np.array(r.coef), y) and r.sigma < 1e-5


def test_direct_models(panel, naive_mae):
    feats = add_causal_features(panel).cache()
    o = splits.history_gate(splits.rolling_origins(feats, 1, 7))
    gbt = direct.boosted_forecasts(feats, o, horizon=7, max_iter=5, max_depth=4)
    seq = direct.sequence_forecasts(feats, o, ["y"])
    for df in (gbt, seq):
        assert df.count() == 42 and df.where("yhat IS NULL OR yhat_p10 > yhat_p90").count() == 0
        assert metrics_overall(df).first().MAE < naive_mae["naive1"]
    again = direct.sequence_forecasts(feats, o, ["y"]).orderBy("product", "date").select("yhat").collect()
    assert np.allclose(again, seq.orderBy("product", "date").select("yhat").collect())


def test_glm_grid_keeps_one_objective(panel):
    feats = add_causal_features(panel).cache()
    o = splits.history_gate(splits.rolling_origins(feats, 1, 2))
    got = direct.glm_grid_forecasts(feats, o, ["y", "y_lag_1", "y_lag_7", "y_roll_7"], horizon=2, powers=(1.5,))
    assert got.count() == 12 and got.where("yhat IS NULL OR yhat <= 0").count() == 0


def test_direct_labels_stop_before_the_test_window():
    days, labels = np.arange(100, 140), np.arange(80.0).reshape(40, 2)
    labels[3, 1] = np.nan
    fit = boosting.Fit(1, 120, 2, (0,))
    assert days[boosting.trained_on(fit, days, labels)].tolist() == [d for d in range(100, 119) if d != 103]


def test_importance_union(spark):
    rows = [(o, h, f"f{i}", float(i * (h == 1) - i * (h == 7))) for o in (1, 2) for h in (1, 7) for i in range(5)] + [(1, 3, "none", 99.0), (2, 1, "tie", 4.0)]
    got = direct.union_top(spark.createDataFrame(rows, "origin_id int, h int, feature string, importance double"), 2).collect()
    assert [(r.origin_id, r.feature) for r in got] == [(1, f) for f in ("f0", "f1", "f3", "f4")] + [(2, f) for f in ("f0", "f1", "f4", "tie")]


def test_bootstrap_is_deterministic_and_covers(panel, origins):
    fc = series.additive_forecasts(panel, origins)
    res = series.additive_residuals(panel, origins)
    key = ["product", "origin_id"]
    a = bands.bootstrap_bands(fc, res, key).orderBy("origin_id", "product", "date")
    b = bands.bootstrap_bands(fc.repartition(3), res.repartition(5), key).orderBy("origin_id", "product", "date")
    assert np.allclose(a.select("yhat", "yhat_p10", "yhat_p90").collect(), b.select("yhat", "yhat_p10", "yhat_p90").collect())
    assert 55 <= metrics_overall(a).first()["COV_p10_p90_%"] <= 95
    assert 60 <= metrics_overall(bands.residual_bands(fc, res, key)).first()["COV_p10_p90_%"] <= 95


def test_batch_scoring_validates(spark, panel):
    regs = ["is_holiday"]
    params = series.final_parameters(panel, splits.final_origin(panel), regs)
    rows = [(1, "p0", 7, None), (2, "p0", 0, None), (3, "p0", 31, None), (4, "p0", 2, [(0,)]), (5, "p0", 2, [(0,), (1,)]),
            (6, "nobody", 3, None), (7, "p0", 1, [(None,)]), (8, "p0", None, None)]
    req = spark.createDataFrame(rows, "request_id int, product string, horizon int, exog array<struct<is_holiday:int>>")
    got = {r.request_id: r for r in series.score_requests(req, params, regs).collect()}
    assert len(got[1].predictions) == 7 and got[1].error is None and got[1].model_type == "seasonal_ar"
    assert len(got[5].predictions) == 2 and got[5].predictions[1] > got[5].predictions[0] - 15
    assert got[8].horizon == 7 and got[8].predictions == got[1].predictions
    for i in (2, 3, 4, 6, 7):
        assert got[i].predictions is None and got[i].error


def test_all_families_share_one_schema(panel):
    fc = run_backtest(panel, families=("baselines", "additive", "seasonal_ar"))
    assert fc.columns == ["origin_id", "date", "product", "h", "y", "yhat", "yhat_p10", "yhat_p90", "model", "family"]
    assert {r.family: r.n for r in fc.groupBy("family").agg(F.count("*").alias("n")).collect()} == {
        "baselines": 504, "additive": 168, "seasonal_ar": 168}


def test_outlook_follows_the_history(panel):
    got = series.additive_outlook(panel, 5, ["is_holiday"])
    assert got.count() == 30 and got.where("yhat IS NULL OR yhat_p10 >= yhat").count() == 0
    assert got.agg(F.min("date")).first()[0] == dt.date(2024, 1, 1) + dt.timedelta(days=260)
    level = panel.groupBy("product").agg(F.avg("y").alias("m"))
    assert got.join(level, "product").where("abs(yhat - m) > 20").count() == 0


def test_final_boosted_round_trip(spark, panel, tmp_path):
    """Stored trees, bands and objectives give what the fit on the full history gives."""
    feats = add_causal_features(panel).cache()
    names = ["y_lag_1", "y_lag_7", "y_roll_7"]
    args = dict(horizon=2, log1p=True, objective="all")
    assert direct.save_final_boosted(feats, str(tmp_path), "v1", names, max_iter=3, **args) == names
    got = direct.score_final_boosted(feats, str(tmp_path), "v1", log1p=True)
    assert got.count() == 12 and got.where("yhat < 5 OR yhat > 50 OR yhat_p10 >= yhat_p90 OR yhat_p10 IS NULL").count() == 0
    assert got.agg(F.min("date")).first()[0] == dt.date(2024, 1, 1) + dt.timedelta(days=260)
    from demandcast.operators.splits import final_origin, future_days
    from demandcast.sources.writers import list_versions

    origin = final_origin(feats, 2)
    longer = feats.unionByName(future_days(feats.select("product").distinct(), origin).select("product", "date"), allowMissingColumns=True)
    again = direct.boosted_forecasts(longer, origin, names, max_iter=3, **args)
    both = got.join(again.select("product", "h", F.col("yhat").alias("a"), F.col("yhat_p10").alias("b")), ["product", "h"])
    assert both.count() == 12 and both.where("abs(yhat - a) > 1e-6 OR abs(yhat_p10 - b) > 1e-6").count() == 0
    meta = list_versions(spark, str(tmp_path)).first()
    assert meta.version == "v1" and {o["objective"] for o in __import__("json").loads(meta.meta)["objectives"]} <= {"squared", "poisson", "tweedie"}


def test_backtest_job_stores_everything(spark, panel, tmp_path):
    from demandcast.plans.jobs import backtest_job

    folder = str(tmp_path)
    ranked = backtest_job(panel, folder, families=("baselines", "additive", "seasonal_ar")).orderBy("rank").collect()
    assert len(ranked) == 3 and ranked[0].sMAPE <= ranked[-1].sMAPE
    assert spark.read.json(f"{folder}/registry").first().best_model.name == ranked[0].family
    assert spark.read.parquet(f"{folder}/forecasts").count() == 504 + 2 * 168
    # A pooled family wins with all its members, as in the pooled forecast table.
    assert spark.read.parquet(f"{folder}/winners_by_product_h").count() == 42
    assert spark.read.parquet(f"{folder}/runs").where("key = 'MAE'").count() == 3
    assert spark.read.parquet(f"{folder}/metrics_by_product").count() == 3 * 42
    assert spark.read.parquet(f"{folder}/mase").where("MASE IS NULL").count() == 0
    backtest_job(panel, folder, families=("baselines",))
    runs = spark.read.parquet(f"{folder}/runs")
    assert runs.select("run_id").distinct().count() == 2 and runs.groupBy("run_id", "run", "key", "step").count().where("count > 1").isEmpty()
    told = {(r.key, r.value) for r in spark.read.parquet(f"{folder}/parameters").collect()}
    assert ("horizon", "7") in told and ("families", "baselines") in told


def test_dashboard_bundle(spark, sf):
    from catalog.base import sales
    from catalog.business import RECIPES
    from demandcast.constants import UNIT_COSTS as COSTS
    from demandcast.operators.supply import cost_table, recipe_table
    from demandcast.plans.jobs import dashboard

    got = dashboard(sales(spark, sf), recipe_table(spark, RECIPES), cost_table(spark, COSTS))
    assert got["kpis"].count() == 1 and got["forecasts"].count() == 35 and got["validation"].count() == 7
    fin = got["finance"].first()
    assert fin.profit == pytest.approx(fin.revenue - fin.total_cost)
