"""Missing-value rules, ties and edges on small hand-made frames."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandcast.functions.columns import is_dst, local_hour_utc, no_nan, parse_number
from demandcast.functions.ordered import exact_quantiles, running_total
from demandcast.operators import baselines, clean, eda, features, metrics, selection, splits
from demandcast.operators.grid import complete_calendar
from demandcast.operators.rollup import aggregate_transactions, daily_exogenous
from demandcast.sources.external import join_weather

D = dt.date


def series(spark, values, product="a", start=D(2024, 1, 1)):
    rows = [(product, start + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "product string, date date, y double")


def one(df):
    return df.collect()[0].asDict()


def forecast_frame(spark, pairs, model="m", h=1):
    rows = [(model, h, y, p, None if p is None else p - 1, None if p is None else p + 1) for y, p in pairs]
    return spark.createDataFrame(rows, "model string, h int, y double, yhat double, yhat_p10 double, yhat_p90 double")


def numpy_metrics(y, p):
    """Plain numpy statement of the metric rules, NaN for missing."""
    y, p = np.array(y, float), np.array(p, float)
    ok = ~np.isnan(y) & ~np.isnan(p)
    big = np.abs(y) > 1e-6
    with np.errstate(invalid="ignore"):
        return {
            "MAE": np.mean(np.abs(y[ok] - p[ok])) if ok.any() else np.nan,
            "RMSE": np.sqrt(np.mean((y[ok] - p[ok]) ** 2)) if ok.any() else np.nan,
            "MAPE": 100 * np.mean(np.abs((y[big] - p[big]) / y[big])) if big.any() else np.nan,
            "sMAPE": 100 * np.mean(2 * np.abs(y - p) / np.maximum(np.abs(y) + np.abs(p), 1e-6)),
        }


@pytest.mark.parametrize("seed", range(4))
def test_metrics_follow_the_rules(spark, seed):
    rng = np.random.default_rng(seed)
    y, p = rng.integers(0, 5, 40).astype(float), rng.normal(2, 1, 40).round(2)
    if seed % 2:
        y[rng.integers(0, 40, 3)] = np.nan
    if seed == 3:
        p[rng.integers(0, 40, 3)] = np.nan
    pairs = [(None if math.isnan(a) else float(a), None if math.isnan(b) else float(b)) for a, b in zip(y, p)]
    got = one(metrics.metrics_overall(forecast_frame(spark, pairs)))
    for k, want in numpy_metrics(y, p).items():
        assert (got[k] is None) if math.isnan(want) else got[k] == pytest.approx(want), k


def test_metric_edges(spark):
    zero = one(metrics.metrics_overall(forecast_frame(spark, [(0.0, 0.0), (2.0, 2.0)])))
    assert zero["sMAPE"] == 0 and zero["MAPE"] == 0 and zero["COV_p10_p90_%"] == 100
    poisoned = one(metrics.metrics_overall(forecast_frame(spark, [(1.0, None), (2.0, 3.0)])))
    assert poisoned["MAPE"] is None and poisoned["sMAPE"] is None and poisoned["MAE"] == 1
    edge = one(metrics.metrics_overall(forecast_frame(spark, [(3.0, 2.0), (5.0, 2.0)])))
    assert edge["COV_p10_p90_%"] == 50  # on the upper bound counts as inside


def test_panel_errors_zero_truth(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "real double, forecast double")
    got = one(metrics.panel_errors(df))
    assert got["MAPE"] is None and got["MAE"] == 1


def test_calendar_completion(spark):
    rows = [("a", D(2024, 1, 1), 1.0), ("a", D(2024, 1, 4), 2.0), ("b", D(2024, 1, 2), 5.0)]
    df = spark.createDataFrame(rows, "product string, date date, y double")
    out = complete_calendar(df).orderBy("product", "date").collect()
    assert [(r.product, r.date.day, r.y) for r in out] == [
        ("a", 1, 1.0), ("a", 2, None), ("a", 3, None), ("a", 4, 2.0), ("b", 2, 5.0)]
    filled = complete_calendar(df, fill={"y": 0.0}).where("product = 'a'").agg(F.sum("y"), F.count("y")).first()
    assert tuple(filled) == (3.0, 4)


@pytest.mark.parametrize("last,buckets", [("2024-01-01 03:00:00", 4), ("2024-01-01 03:00:01", 5)])
def test_grid_ends_at_ceiling(spark, last, buckets):
    df = spark.createDataFrame([("2024-01-01 00:10:00", 1.0), (last, 2.0)], "t string, amount double").select(
        F.col("t").cast("timestamp").alias("datetime"), "amount")
    out = aggregate_transactions(df, "hour")
    assert out.count() == buckets and out.agg(F.sum("amount")).first()[0] == 3.0


def test_category_grid_drops_missing_category(spark):
    df = spark.createDataFrame([("2024-01-01", "a", 1.0), ("2024-01-03", None, 2.0)], "t string, product string, amount double")
    df = df.withColumn("datetime", F.col("t").cast("timestamp"))
    out = aggregate_transactions(df, "day", category="product")
    assert out.count() == 3 and out.agg(F.sum("amount")).first()[0] == 1.0


def test_fill_both_ways(spark):
    got = clean.fill_both_ways(series(spark, [None, None, 1.0, None, 3.0, None]), ["y"]).orderBy("date").collect()
    assert [r.y for r in got] == [1, 1, 1, 1, 3, 3]


def test_causal_features_ignore_today_and_gaps(spark):
    df = features.add_causal_features(series(spark, [1.0, 2.0, None, 4.0, 100.0]), windows=(3,), lag_days=(1,))
    got = df.orderBy("date").collect()
    assert got[0].y_roll_3 is None and got[1].y_vol_7 is None
    assert got[4].y_roll_3 == 3.0 and got[4].y_lag_1 == 4.0


def test_future_rows_do_not_change_features(spark):
    base = series(spark, [float(i % 5) for i in range(40)])
    changed = base.withColumn("y", F.when(F.col("date") >= D(2024, 1, 31), 999.0).otherwise(F.col("y")))
    a = features.add_causal_features(base).where(F.col("date") < D(2024, 1, 31)).orderBy("date").collect()
    b = features.add_causal_features(changed).where(F.col("date") < D(2024, 1, 31)).orderBy("date").collect()
    assert a == b


def test_origins_and_short_history(spark):
    days = series(spark, [1.0] * 40)
    got = splits.rolling_origins(days, 2, 7).orderBy("origin_id").collect()
    assert [(r.test_start, r.n_train_days) for r in got] == [(D(2024, 1, 27), 26), (D(2024, 2, 3), 33)]
    assert splits.history_gate(splits.rolling_origins(days, 2, 7), 30).count() == 1
    with pytest.raises(Exception, match="need 70 distinct dates"):
        splits.rolling_origins(days, 10, 7).collect()


def test_baselines_short_and_missing(spark):
    short = series(spark, [5.0, None, 7.0], "short", D(2024, 1, 24))
    full = series(spark, [float(i) for i in range(40)], "full")
    tail = series(spark, [1.0] * 7, "new", D(2024, 2, 3))
    p = full.unionByName(short).unionByName(tail)
    # Training ends on Jan 26 and Feb 2; "new" has no history at either origin.
    got = baselines.baseline_forecasts(p, splits.rolling_origins(p, 2, 7))
    full_rows = {(r.origin_id, r.model, r.h): r.yhat for r in got.where("product = 'full'").collect()}
    assert full_rows[(1, "naive1", 3)] == 25 and full_rows[(1, "snaive7", 1)] == 19 and full_rows[(1, "ma7", 7)] == 22
    new = got.where("product = 'new'").collect()
    assert len(new) == 21 and all(r.h is None and r.yhat is None for r in new)
    series6 = series(spark, [float(i) for i in range(6)] + [9.0] * 7, "six", D(2024, 1, 28))
    p2 = full.unionByName(series6)
    six = baselines.baseline_forecasts(p2, splits.rolling_origins(p2, 1, 7)).where("product = 'six' AND model = 'snaive7'").collect()
    assert six and {r.yhat for r in six} == {5.0}  # fewer than seven rows repeat the last value


def test_baseline_keeps_missing_last_value(spark):
    p = series(spark, [1.0] * 20 + [None] + [2.0] * 7)
    got = baselines.baseline_forecasts(p, splits.rolling_origins(p, 1, 7))
    by = {r.model: r.yhat for r in got.where("h = 1").collect()}
    assert by["naive1"] is None and by["ma7"] == 1.0 and by["snaive7"] == 1.0


def test_winner_tie_and_all_missing(spark):
    rows = [("a", 1, 1.0, 2.0, "m2"), ("a", 1, 1.0, 2.0, "m1"), ("a", 1, 1.0, None, "m0")]
    f = spark.createDataFrame(rows, "product string, h int, y double, yhat double, model string")
    assert one(selection.winners(f))["model"] == "m1"
    only = selection.winners(f.where("model = 'm0'")).collect()
    assert only[0].model == "m0" and only[0].sMAPE is None


def test_weighted_score_rules(spark):
    rows = [("a", 1, 10.0), ("a", 2, None), ("a", 3, 40.0), ("b", 1, None), ("b", 2, None), ("b", 3, None)]
    df = spark.createDataFrame(rows, "model string, h int, sMAPE double")
    by = {r.model: r for r in selection.weighted_scores(df, ["sMAPE"], [3, 2, 1]).collect()}
    assert by["a"].score_sMAPE == pytest.approx((3 * 10 + 40) / 4) and by["b"].score_sMAPE == math.inf
    uniform = selection.weighted_scores(df, ["sMAPE"], [1, 2]).where("model = 'a'").first()
    assert uniform.score_sMAPE == 25


def test_simple_selection_excludes(spark):
    df = spark.createDataFrame([("Baselines", 1.0), ("ensemble", 2.0), ("x", 5.0), ("y", None)], "model string, sMAPE double")
    assert one(selection.select_simple(df))["model"] == "x"


def test_one_hot_edges(spark):
    rows = [(True, False), (False, True), (False, False), (True, True)]
    df = spark.createDataFrame(rows, "product_b boolean, product_a boolean")
    assert [r.product for r in clean.reverse_one_hot(df).collect()] == ["b", "a", "b", "b"]


def test_parse_number(spark):
    df = spark.createDataFrame([(" 12.5 ",), ("12,5",), ("abc",), ("",), ("1e3",), ("12d",), (None,)], "t string")
    assert [r.v for r in df.select(parse_number("t").alias("v")).collect()] == [12.5, None, None, None, 1000.0, None, None]


def test_nan_becomes_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert [r.v for r in df.select(no_nan("x").alias("v")).collect()] == [None, 1.0]


def test_kyiv_clock(spark):
    stamps = ["2024-03-31 02:30:00", "2024-03-31 03:30:00", "2024-03-31 04:30:00",
              "2024-10-27 02:30:00", "2024-10-27 03:30:00", "2024-10-27 04:30:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").withColumn("t", F.col("s").cast("timestamp"))
    got = [r.u for r in df.select(local_hour_utc("t", "Europe/Kyiv").cast("string").alias("u")).collect()]
    assert got == ["2024-03-31 00:00:00", "2024-03-31 01:00:00", "2024-03-31 01:00:00",
                   "2024-10-26 23:00:00", None, "2024-10-27 02:00:00"]


def test_quantiles_and_running_total_with_a_hot_value(spark):
    rng = np.random.default_rng(1)
    values = [float(v) for v in rng.integers(0, 50, 600)] + [7.0] * 400
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double").repartition(6)
    got = {r.q: r.value for r in exact_quantiles(df, "v", (0.0, 0.1, 0.5, 0.99, 1.0)).collect()}
    for q, v in got.items():
        assert v == pytest.approx(np.quantile(values, q))
    run = running_total(df, [F.col("v"), F.col("id")], {"v": "cum"}, "rank").orderBy("v", "id").toPandas()
    assert np.allclose(run.cum, np.cumsum(sorted(values))) and list(run["rank"]) == list(range(1, 1001))


def test_weekday_profile_counts_only_sales_days(spark):
    rows = [("2024-01-01 10:00:00", 4.0), ("2024-01-08 10:00:00", 8.0), ("2024-01-02 10:00:00", None)]
    df = spark.createDataFrame(rows, "t string, amount double").withColumn("datetime", F.col("t").cast("timestamp"))
    got = {r.dow: r for r in eda.weekday_profile(df).collect()}
    assert len(got) == 7 and got[0].n == 2 and got[0].mean == 6 and got[1].n == 0 and got[1].mean is None


def test_exogenous_spec_skips_absent(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 1.0)], "date date, t double")
    assert daily_exogenous(df, {"t": "mean", "gone": "sum"}).columns == ["date", "t"]
    assert daily_exogenous(df, {"gone": "sum"}) is None


def test_dictionary_windows_cover_all_variables():
    from demandcast.constants import DAILY_EXOG, MONTHLY_EXOG

    spec = features.exogenous_spec([*DAILY_EXOG, *MONTHLY_EXOG])
    assert len(spec) == 9 * 6 + 15 * 6 == 144
    assert ("tavg_lag1", "tavg", "lag", 1) in spec and ("clear_%_90d_sum", "clear_%", "sum", 90) in spec


def test_shifted_total_is_not_todays(spark):
    a, b = series(spark, [1.0, 2.0, 3.0]), series(spark, [10.0, None, 30.0], "b")
    got = features.add_business_lag(a.unionByName(b)).where("product = 'a'").orderBy("date").collect()
    assert [r.totals_day_t1 for r in got] == [None, 11.0, 2.0]
    assert [r.competitor_sum_t1 for r in got] == [None, 10.0, 0.0]


def test_screening(spark):
    df = spark.createDataFrame(
        [("a", D(2024, 1, i + 1), float(i), 1.0, None if i < 5 else 1.0 * i, float(i)) for i in range(10)],
        "product string, date date, y double, flat double, holes double, good double")
    kept = {r.feature: r.kept for r in clean.screen_features(df).collect()}
    assert kept == {"flat": False, "holes": False, "good": True}


def test_pandas_twin_of_rollings(spark):
    rng = np.random.default_rng(3)
    y = rng.normal(5, 2, 60).round(2)
    y[rng.integers(0, 60, 8)] = np.nan
    df = series(spark, [None if math.isnan(v) else float(v) for v in y])
    got = features.add_causal_features(df).orderBy("date").toPandas()
    s = pd.Series(y).shift(1)
    for n in (3, 7, 30):
        assert np.allclose(got[f"y_roll_{n}"].astype(float), s.rolling(n, min_periods=1).mean(), equal_nan=True)
    assert np.allclose(got["y_vol_7"].astype(float), s.rolling(7, min_periods=1).std(), equal_nan=True)


def test_summer_time_of_either_hemisphere(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-15 12:00:00' AS jan, TIMESTAMP '2024-07-15 12:00:00' AS jul")
    for zone, want in (("Australia/Sydney", (True, False)), ("Europe/Kyiv", (False, True)), ("UTC", (False, False))):
        assert tuple(df.select(is_dst("jan", zone), is_dst("jul", zone)).first()) == want


def test_overlapping_weather_does_not_repeat_sales(spark):
    sales = spark.sql("SELECT TIMESTAMP '2024-01-01 10:30:00' AS datetime, 5D AS amount")
    hours = spark.sql("SELECT TIMESTAMP '2024-01-01 10:00:00' AS hour_utc, t AS temperature_2m FROM VALUES (1D), (3D), (NULL) AS v(t)")
    rows = join_weather(sales, hours).collect()
    assert [(r.amount, r.wx_temperature_2m) for r in rows] == [(5.0, 2.0)]
