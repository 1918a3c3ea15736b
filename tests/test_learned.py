"""Fits on packed series: recovery of planted structure, fallbacks, causality, coverage, equality with a second library."""

import datetime as dt
import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from demandcast.config import ForecastConfig
from demandcast.models import arma, bands, boosting, direct, glm, packed, pinball, sequence, series, state
from demandcast.operators import splits
from demandcast.operators.features import add_causal_features
from demandcast.operators.metrics import metrics_overall
from demandcast.plans.panel import FAMILIES, feature_panel, final_forecasts, run_backtest
from demandcast.sources import readers

START = dt.date(2023, 1, 1)


def frame(spark, values: dict, **more):
    """One series per name; NaN is NULL."""
    rows = [{"product": k, "date": START + dt.timedelta(days=i), "y": float(v), **{c: float(x[i]) for c, x in more.items()}} for k, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(pd.DataFrame(rows))
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("y", *more)})


def weekly(seed, days=260, noise=1.0):
    rng = np.random.default_rng(seed)
    week = rng.normal(0, 4, 7)
    return [20 + 0.02 * i + week[i % 7] + rng.normal(0, noise) for i in range(days)]


# --- B9: seasonal ARMA ----------------------------------------------------------------------

def simulate(phi, theta, n, seed, sigma=1.0):
    rng = np.random.default_rng(seed)
    e = rng.normal(0, sigma, n + 100)
    y = np.zeros(n + 100)
    for t in range(1, n + 100):
        y[t] = 5 + phi * y[t - 1] + e[t] + theta * e[t - 1]
    return y[100:]


def test_arma_recovers_planted_coefficients(spark):
    p = frame(spark, {f"s{i}": simulate(0.6, 0.5, 3000, i) for i in range(3)})
    got = arma.seasonal_arma_fits(p, splits.final_origin(p), [], orders=[arma.Order("101", (1,), (1,))]).collect()
    assert len(got) == 3
    for r in got:
        assert r.ar[0] == pytest.approx(0.6, abs=0.06) and r.ma[0] == pytest.approx(0.5, abs=0.06) and r.sigma == pytest.approx(1, abs=0.05)
        spread = (np.array(r.upper) - np.array(r.yhat)) / series.Z80
        psi = np.array([1.0, *[1.1 * 0.6 ** j for j in range(6)]])
        assert np.allclose(spread, np.sqrt(np.cumsum(psi ** 2)), rtol=0.12)


def test_arma_equals_two_regressions_by_hand(spark):
    y = simulate(0.4, 0.3, 120, 7)
    p = frame(spark, {"s": y})
    r = arma.seasonal_arma_fits(p, splits.final_origin(p), [], orders=[arma.Order("o", (1, 7), (1,))], long=5).first()
    long_x = np.column_stack([np.ones(115)] + [y[5 - k:120 - k] for k in range(1, 6)])
    e = y[5:] - long_x @ np.linalg.lstsq(long_x, y[5:], rcond=None)[0]
    full = np.concatenate([np.full(5, np.nan), e])
    x = np.column_stack([np.ones(113), y[6:119], y[0:113], full[6:119]])
    b = np.linalg.lstsq(x, y[7:], rcond=None)[0]
    assert np.allclose([r.constant, *r.ar, *r.ma], b, atol=1e-6)
    assert r.yhat[0] == pytest.approx(b[0] + b[1] * y[-1] + b[2] * y[-7] + b[3] * full[-1])
    assert r.yhat[1] == pytest.approx(b[0] + b[1] * r.yhat[0] + b[2] * y[-6])


def test_a_differenced_order_follows_a_trend_with_a_week(spark):
    rng = np.random.default_rng(3)
    y = [50 + 0.5 * i + 6 * (i % 7 == 2) + rng.normal(0, 0.3) for i in range(200)]
    p = frame(spark, {"s": y})
    r = arma.seasonal_arma_fits(p, splits.final_origin(p), [], orders=[arma.ORDERS[1]]).first()
    want = [50 + 0.5 * i + 6 * (i % 7 == 2) for i in range(200, 207)]
    assert np.abs(np.array(r.yhat) - want).max() < 1.5 and r.constant == 0 and list(r.ar) == []


def test_short_series_fall_back(spark):
    """Too short with regressors: fitted without. Too short for any order: rows without a forecast."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 6))
    columns = {f"x{k}": x[:, k] for k in range(6)}
    parts = [frame(spark, {f"n{n}": 10 + rng.normal(size=n)}, **columns) for n in (60, 39, 20)]
    p = parts[0].unionByName(parts[1]).unionByName(parts[2])
    fits = {}
    for n in (60, 39, 20):
        own = p.where(f"product = 'n{n}'")
        r = arma.seasonal_arma_fits(own, splits.final_origin(own), list(columns), orders=[arma.ORDERS[0]], choose="first").collect()
        fits[n] = r[0].with_regressors if r else None
    assert fits == {60: True, 39: False, 20: None}
    last = p.where("product = 'n20'")
    rows = arma.seasonal_arma_forecasts(last, splits.rolling_origins(last, 1, 7)).collect()
    assert len(rows) == 7 and all(r.yhat is None for r in rows)


def test_attempts_are_compared_per_series(spark):
    """A regressor that matters is kept in one series and left out in the other; ``first`` takes it wherever it can."""
    rng = np.random.default_rng(5)
    lift = (rng.random(400) < 0.2).astype(float)
    p = frame(spark, {"with": 20 + 9 * lift + rng.normal(size=400), "without": 20 + rng.normal(size=400)}, is_holiday=lift)
    best = {r["product"]: r.with_regressors for r in arma.seasonal_arma_fits(p, splits.final_origin(p)).collect()}
    assert best == {"with": True, "without": False}
    first = {r["product"]: (r.with_regressors, r.model_order) for r in arma.seasonal_arma_fits(p, splits.final_origin(p), choose="first").collect()}
    assert set(first.values()) == {(True, "101x101")}


def test_arma_does_not_see_the_test_window(spark):
    y = weekly(0)
    p = frame(spark, {"a": y, "b": weekly(1)})
    o = splits.rolling_origins(p, 2, 7)
    changed = p.withColumn("y", F.when(F.col("date") >= START + dt.timedelta(days=253), 900.0).otherwise(F.col("y")))
    take = lambda df: df.where("origin_id = 2").orderBy("product", "date").select("yhat", "yhat_p10").collect()
    assert np.allclose(take(arma.seasonal_arma_forecasts(p, o)), take(arma.seasonal_arma_forecasts(changed, o)))


def test_gaps_are_filled_inside_training(spark):
    y = weekly(2)
    y[100:103] = [np.nan] * 3
    p = frame(spark, {"a": y})
    filled = list(y)
    filled[100:103] = [y[99]] * 3
    got, want = (arma.seasonal_arma_fits(d, splits.final_origin(d), []).first().yhat for d in (p, frame(spark, {"a": filled})))
    assert np.allclose(got, want)
    holes = p.where(~F.col("date").isin([START + dt.timedelta(days=d) for d in (100, 101, 102)]))
    assert np.allclose(arma.seasonal_arma_fits(holes, splits.final_origin(holes), []).first().yhat, want)
    late = frame(spark, {"a": [np.nan] * 250 + weekly(3)[:10]})
    assert arma.seasonal_arma_fits(late, splits.rolling_origins(late, 1, 10), []).count() == 0


# --- B17: paths of resampled innovations -----------------------------------------------------

def test_resampled_paths_spread_with_the_horizon(spark):
    """An AR(1) with coefficient 0.8: the 80 % band grows as theory says, and a re-run draws the same."""
    p = frame(spark, {f"s{i}": simulate(0.8, 0.0, 2500, 20 + i) for i in range(3)})
    how = dict(orders=[arma.Order("100", (1,), ())], samples=4000, block=2)
    a = arma.seasonal_arma_fits(p, splits.final_origin(p), [], **how).orderBy("product").collect()
    b = arma.seasonal_arma_fits(p.repartition(5), splits.final_origin(p), [], **how).orderBy("product").collect()
    sd = np.sqrt(np.cumsum(0.8 ** (2 * np.arange(7))))
    for x, again in zip(a, b):
        half = (np.array(x.upper) - np.array(x.lower)) / 2
        assert np.allclose(half, series.Z80 * sd, rtol=0.12) and (np.diff(half) > -0.05).all() and half[-1] > 1.4 * half[0]
        assert x.lower == again.lower and x.yhat == again.yhat
    other = arma.seasonal_arma_fits(p, splits.final_origin(p), [], seed=1, **how).orderBy("product").first()
    assert other.lower != a[0].lower


# --- B10, B13, B14: boosted trees ------------------------------------------------------------

def test_bins_and_trees_on_a_step():
    edges = [np.array([1.0, 2.0]), np.array([])]
    x = np.array([[0.0, 5.0], [1.0, np.nan], [1.5, 0.0], [9.0, 1.0], [np.nan, 2.0]])
    assert boosting.bin_numbers(x, edges).tolist() == [[1, 1], [1, 0], [2, 1], [3, 1], [0, 1]]


def planted_features(spark, n=6, days=300):
    """The next day's target follows ``drive``; thirty columns of noise do not matter."""
    rng = np.random.default_rng(11)
    rows = []
    for s in range(n):
        drive = rng.normal(size=days)
        noise = rng.normal(size=(days, 8))
        for i in range(days):
            rows.append((f"p{s}", START + dt.timedelta(days=i), float(20 + 6 * (drive[i - 1] > 0.3 if i else 0) + rng.normal(0, 0.3)), float(drive[i]), *map(float, noise[i])))
    return spark.createDataFrame(rows, "product string, date date, y double, drive double, " + ", ".join(f"n{k} double" for k in range(8)))


def test_boosting_finds_the_driver_and_importance_names_it(spark):
    p = planted_features(spark).cache()
    o = splits.rolling_origins(p, 4, 7)
    names = ["drive", *[f"n{k}" for k in range(8)]]
    fc = direct.boosted_forecasts(p, o, names, max_iter=10)
    first = fc.where("h = 1").cache()
    assert fc.count() == 6 * 28 and first.agg(F.avg(F.abs(F.col("y") - F.col("yhat")))).first()[0] < 0.6
    imp = boosting.feature_importance(p, o, names, rounds=5)
    assert imp.count() == 4 * 7 * 9
    top = imp.where("h = 1").groupBy("origin_id").agg(F.max_by("feature", "importance").alias("f"), F.max("share").alias("s")).collect()
    assert [r.f for r in top] == ["drive"] * 4 and min(r.s for r in top) > 0.8
    again = boosting.feature_importance(p.repartition(3), o, names, rounds=5)
    assert again.join(imp.withColumnRenamed("importance", "i"), ["origin_id", "h", "feature"]).where("abs(importance - i) > 1e-9").count() == 0


def test_each_origin_takes_its_union_of_top_features(spark):
    """With room for one per horizon, the driver of day 1 and at most one more are kept; a column without training values is never one."""
    p = planted_features(spark).withColumns({"late": F.when(F.col("date") >= START + dt.timedelta(days=290), F.rand(1)), "flat": F.lit(1.0)})
    o = splits.rolling_origins(p, 2, 7)
    steps = packed.origin_days(o)
    names = ["drive", "late", "flat", *[f"n{k}" for k in range(8)]]
    t = boosting.prepare(p, names, min(s[1] for s in steps), "y", ("product",), "date", 7, False)
    chosen = boosting.chosen_features(t, steps, 1, 0.3, 5, 3)
    t.close()
    for picked in chosen.values():
        got = {names[f] for f in picked}
        assert "drive" in got and len(got) <= 2 and not got & {"late", "flat"}


def test_boosting_is_causal_and_deterministic(spark):
    p = planted_features(spark, 3, 200).cache()
    o = splits.rolling_origins(p, 2, 7)
    changed = p.withColumn("y", F.when(F.col("date") >= START + dt.timedelta(days=193), 900.0).otherwise(F.col("y")))
    take = lambda df: df.where("origin_id = 2").orderBy("product", "h").select("yhat", "yhat_p10").collect()
    a, b, c = (take(direct.boosted_forecasts(x, o, ["drive", "n0"], max_iter=3)) for x in (p, changed, p.repartition(7)))
    assert np.allclose(a, b) and np.allclose(a, c)


def test_sums_are_the_same_wherever_they_are_added(spark, monkeypatch):
    p = planted_features(spark, 3, 200).cache()
    o = splits.rolling_origins(p, 2, 7)
    take = lambda: direct.boosted_forecasts(p, o, ["drive", "n0"], max_iter=3).orderBy("origin_id", "product", "h").select("yhat", "yhat_p10").collect()
    here = take()
    monkeypatch.setattr(boosting, "DRIVER_BYTES", -1)
    assert np.allclose(here, take())


def test_objectives_and_log1p(spark):
    p = planted_features(spark, 3, 200).cache()
    o = splits.rolling_origins(p, 1, 7)
    for how in (dict(objective="poisson"), dict(objective="tweedie", powers=(1.5,)), dict(objective="all"), dict(log1p=True)):
        fc = direct.boosted_forecasts(p, o, ["drive", "n0"], max_iter=8, rate=0.3, **how).where("h = 1")
        assert fc.agg(F.avg(F.abs(F.col("y") - F.col("yhat")))).first()[0] < 1.0, how
    assert boosting.objective_grid("all") == [("squared", 0.0), ("poisson", 0.0), ("tweedie", 1.1), ("tweedie", 1.3), ("tweedie", 1.5)]


def test_nothing_to_learn_from_raises(spark):
    p = frame(spark, {"a": [1.0] * 12}, x=np.arange(12.0))
    with pytest.raises(ValueError):
        direct.boosted_forecasts(p, splits.rolling_origins(p, 1, 7).where("origin_id > 9"), ["x"])
    with pytest.raises(ValueError):
        direct.sequence_forecasts(p, splits.rolling_origins(p, 1, 7), ["y"], lookback=30)


# --- B12: quantile bands ---------------------------------------------------------------------

def test_quantile_regression_equals_the_optimum():
    """No nearby line has a smaller pinball loss."""
    rng = np.random.default_rng(0)
    x = np.column_stack([np.ones(400), rng.uniform(0, 10, 400)])
    y = 2 + 3 * x[:, 1] + rng.normal(size=400) * x[:, 1]
    for q in (0.1, 0.5, 0.9):
        b = pinball.fit_quantile(x, y, q)
        loss = lambda c: np.maximum(q * (y - x @ c), (q - 1) * (y - x @ c)).sum()
        best = min(loss(b + d) for d in rng.normal(size=(500, 2)) * [0.3, 0.05])
        assert loss(b) <= best * 1.002
    assert pinball.fit_quantile(x[:6], y[:6], 0.1) is None


def test_quantile_bands_cover_heteroscedastic_series(spark):
    """Noise that grows with the level: the 80 % band holds 80 % of new days, at low and at high levels alike."""
    rng = np.random.default_rng(2)
    rows = []
    for s in range(4):
        level = rng.uniform(5, 60, 4000)
        for i, v in enumerate(level):
            rows.append((f"p{s}", i, float(v), float(v + rng.normal() * 0.2 * v)))
    df = spark.createDataFrame(rows, "product string, i int, yhat double, y double")
    got = pinball.quantile_bands(df.where("i >= 2000"), df.where("i < 2000"), ["yhat"], ["product"]).withColumn("in", F.col("y").between(F.col("yhat_p10"), F.col("yhat_p90")).cast("int"))
    rate = got.groupBy((F.col("yhat") > 30).alias("high")).agg(F.avg("in").alias("r")).collect()
    assert len(rate) == 2 and all(abs(r.r - 0.8) <= 0.03 for r in rate)
    flat = bands.residual_bands(df.where("i >= 2000"), df.where("i < 2000").withColumn("residual", F.col("y") - F.col("yhat")), ["product"])
    low = flat.where("yhat < 15").agg(F.avg(F.col("y").between(F.col("yhat_p10"), F.col("yhat_p90")).cast("int"))).first()[0]
    assert low > 0.95  # a band of one width cannot do it


# --- B11: generalised linear models -----------------------------------------------------------

def test_glm_equals_a_second_library(spark):
    rng = np.random.default_rng(4)
    days = 220
    x = rng.normal(size=(days, 3))
    y = rng.poisson(np.exp(1 + 0.4 * np.roll(x[:, 0], 1) - 0.3 * np.roll(x[:, 1], 1))).astype(float)
    p = frame(spark, {"a": y}, a=x[:, 0], b=x[:, 1], c=5 + 2 * x[:, 2])
    o = splits.rolling_origins(p, 1, 7)
    end = o.first().train_end
    train = p.withColumn("label", F.lead("y", 1).over(__import__("pyspark").sql.Window.orderBy("date"))).where(F.col("date") < F.lit(end))
    table = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(train)
    for poisson, power, powers in ((True, 1.0, ()), (False, 1.4, (1.4,))):
        other = GeneralizedLinearRegression(family="tweedie", variancePower=power, linkPower=0.0, regParam=0.0, maxIter=60, tol=1e-12).fit(table)
        at = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(p.where(F.col("date") == F.lit(end)))
        want = other.transform(at).first().prediction
        got = direct.glm_grid_forecasts(p, o, ["a", "b", "c"], powers=powers, poisson=poisson, reg=0.0).where("h = 1").first().yhat
        assert got == pytest.approx(want, rel=1e-6)


def test_glm_standardises_and_screens_on_training_rows(spark):
    rng = np.random.default_rng(6)
    y = rng.poisson(8, 200).astype(float)
    jump = np.r_[np.zeros(193), rng.normal(0, 1e6, 7)]  # moves in the test window only
    holes = np.where(rng.random(200) < 0.2, np.nan, rng.normal(size=200))
    p = frame(spark, {"a": y}, jump=jump, holes=holes)
    o = splits.rolling_origins(p, 1, 7)
    with_it, without = (direct.glm_grid_forecasts(p, o, f).orderBy("h").select("yhat").collect() for f in (["jump", "holes"], ["holes"]))
    assert np.allclose(with_it, without) and all(r.yhat > 0 for r in with_it)


# --- B16: sequence regression ------------------------------------------------------------------

def test_lagged_products_equal_stacked_windows():
    rng = np.random.default_rng(0)
    for n, c, look, h in ((60, 3, 5, 2), (40, 1, 30, 7), (37, 2, 30, 7), (36, 2, 30, 7)):
        z, y = rng.normal(size=(n, c)), rng.normal(size=n)
        made = sequence.window_products(z, y, look, h)
        m = n - look - h + 1
        if m <= 0:
            assert made is None
            continue
        w = sequence.stacked(z, look)[:m]
        ahead = np.column_stack([y[look - 1 + k:look - 1 + k + m] for k in range(1, h + 1)])
        for got, want in zip(made, (w.T @ w, w.T @ ahead, w.sum(axis=0), ahead.sum(axis=0), m)):
            assert np.allclose(got, want)


def test_sequence_uses_every_channel(spark):
    """A second channel leads the target by three days; missing values are filled inside training."""
    rng = np.random.default_rng(9)
    lead = rng.normal(size=400)
    y = 10 + 4 * np.r_[np.zeros(3), lead[:-3]] + rng.normal(0, 0.2, 400)
    holes = lead.copy()
    holes[50:55] = np.nan
    p = frame(spark, {"a": y, "b": y + 1}, lead=holes, empty=np.full(400, np.nan))
    o = splits.rolling_origins(p, 2, 7)
    alone = direct.sequence_forecasts(p, o, ["y"], lookback=10, ridge=0.01)
    both = direct.sequence_forecasts(p, o, lookback=10, ridge=0.01)
    err = lambda df: df.where("h <= 3").agg(F.avg(F.abs(F.col("y") - F.col("yhat")))).first()[0]
    assert err(both) < 0.6 < 1 < err(alone) and both.where("yhat IS NULL OR yhat_p10 > yhat_p90").count() == 0


def test_sequence_pads_a_short_series(spark):
    p = frame(spark, {"long": weekly(1, 120)}).unionByName(frame(spark, {"short": weekly(2, 120)}).where(F.col("date") >= START + dt.timedelta(days=100)))
    got = direct.sequence_forecasts(p, splits.rolling_origins(p, 1, 7), ["y"], lookback=30).where("product = 'short'").collect()
    assert len(got) == 7 and all(r.yhat is not None and r.yhat_p10 is None for r in got)


# --- B18: state and final forms ----------------------------------------------------------------

@pytest.mark.parametrize("model", ["seasonal_ar", "additive"])
def test_merged_state_equals_a_full_refit(spark, model):
    p = frame(spark, {"a": weekly(0), "b": weekly(1)}, is_holiday=(np.arange(260) % 29 == 0).astype(float)).cache()
    cuts = [START + dt.timedelta(days=d) for d in (0, 100, 101, 173, 260)]
    merged = None
    for lo, hi in zip(cuts, cuts[1:]):
        part = p.where(F.col("date").between(lo, hi - dt.timedelta(days=1)))
        new = state.month_state(part, model, ["is_holiday"], tail=state.tail_rows(p.where(F.col("date") < lo)))
        merged = new if merged is None else state.merge(merged, new)
    got = {r["product"]: (r.coef, r.sigma, r.n) for r in state.fit_state(merged, model, ["is_holiday"]).collect()}
    if model == "additive":
        want = {r["product"]: (r.coef, r.sigma, r.n) for r in series.fit_additive(p, splits.final_origin(p), ["is_holiday"]).collect()}
    else:
        want = {r["product"]: (r.coef, r.sigma, r.n) for r in series.final_parameters(p, splits.final_origin(p), ["is_holiday"]).collect()}
    for k in ("a", "b"):
        assert np.allclose(got[k][0], want[k][0], atol=1e-6) and got[k][1:] == pytest.approx(want[k][1:])
    assert merged.count() == 2 * 9


def test_every_family_has_a_final_form(spark):
    p = add_causal_features(frame(spark, {"a": weekly(0), "b": weekly(1)}, is_holiday=(np.arange(260) % 29 == 0).astype(float))).cache()
    level = {r["product"]: r.m for r in p.groupBy("product").agg(F.avg("y").alias("m")).collect()}
    for family in [*FAMILIES, "arma_bootstrap"]:
        got = final_forecasts(p, family, ForecastConfig(horizon=9 if family in ("additive", "seasonal_arma") else 7)).collect()
        n = 9 if family in ("additive", "seasonal_arma") else 7
        names = 3 if family == "baselines" else 1
        assert len(got) == 2 * n * names, family
        assert {r.date for r in got} == {START + dt.timedelta(days=260 + i) for i in range(n)}
        assert all(r.yhat is not None and abs(r.yhat - level[r["product"]]) < 20 for r in got), family


def test_settings_reach_the_operators(spark):
    """Interval, objective, top features and readings change what they should."""
    readings = spark.createDataFrame([(START + dt.timedelta(days=i // 2), float(i), float(i), 1) for i in range(520)],
                                     "date date, wx_temperature_2m double, wx_precipitation double, is_holiday int")
    p = feature_panel(frame(spark, {"a": weekly(0), "b": weekly(1)}), readings=readings)
    day = p.where(F.col("date") == START + dt.timedelta(days=3)).first()
    assert (day.wx_temperature_2m, day.wx_precipitation, day.is_holiday) == (6.5, 13.0, 1)
    p = p.cache()
    wide, narrow = (run_backtest(p, ForecastConfig(n_origins=1, interval=i), ["sequence_direct"]).agg(F.avg(F.col("yhat_p90") - F.col("yhat_p10"))).first()[0] for i in (0.95, 0.5))
    assert wide > 1.5 * narrow
    few, many = (run_backtest(p, ForecastConfig(n_origins=1, top_k_features=k), ["boosted_direct"]).orderBy("product", "h").select("yhat").collect() for k in (1, 40))
    assert few != many


# --- S6, S15 ------------------------------------------------------------------------------------

def test_metric_files_go_by_their_headers(spark, tmp_path):
    (tmp_path / "a_metrics_overall.csv").write_text("MAE,RMSE,MAPE,sMAPE\n1.0,2.0,3.0,4.0\n")
    (tmp_path / "b_metrics_overall.csv").write_text("sMAPE,MAE,extra,RMSE\n40.0,10.0,x,20.0\n")
    (tmp_path / "all_models_metrics_overall.csv").write_text("MAE,RMSE,MAPE,sMAPE\n9,9,9,9\n")
    (tmp_path / "b_metrics_by_h.csv").write_text("RMSE,h\nbad,3\n")
    got = {r.model: (r.MAE, r.RMSE, r.MAPE, r.sMAPE, r["COV_p10_p90_%"]) for r in readers.read_overall_metrics(spark, str(tmp_path)).collect()}
    assert got == {"a": (1.0, 2.0, 3.0, 4.0, None), "b": (10.0, 20.0, None, 40.0, None)}
    by_h = readers.read_metrics_by_h(spark, str(tmp_path)).first()
    assert (by_h.model, by_h.h, by_h.RMSE, by_h.MAE) == ("b", 3, None, None)
    with pytest.raises(FileNotFoundError):
        readers.read_overall_metrics(spark, str(tmp_path / "none"))


def tree_by_hand(data: bytes, block: int, fan: int) -> str:
    level = [hashlib.sha1(data[i:i + block]).hexdigest() for i in range(0, len(data), block)]
    while len(level) > 1:
        level = [hashlib.sha1("".join(level[i:i + fan]).encode()).hexdigest() for i in range(0, len(level), fan)]
    return level[0]


def test_files_over_the_limit_are_hashed_by_blocks(spark, tmp_path):
    rng = np.random.default_rng(0)
    content = {f"f{n}.bin": rng.bytes(n) for n in (1, 9, 10, 11, 1000, 54321)}
    for name, data in content.items():
        (tmp_path / name).write_bytes(data)
    sizes = readers.file_sizes(spark, str(tmp_path))
    digests = readers.tree_digests(readers.block_digests(sizes, 10), fan_in=7)
    got = {r.path.rsplit("/", 1)[1]: r.sha1 for r in digests.collect()}
    assert got == {n: tree_by_hand(d, 10, 7) for n, d in content.items()}
    mixed = {r.file: (r.method, r.sha1) for r in readers.file_fingerprints(spark, str(tmp_path), whole_bytes=1000, block_bytes=100).collect()}
    assert mixed["f1000.bin"] == ("whole", hashlib.sha1(content["f1000.bin"]).hexdigest())
    assert mixed["f54321.bin"] == ("blocks", tree_by_hand(content["f54321.bin"], 100, 1024)) and len(mixed) == 6


def test_a_large_file_stays_in_bounded_memory(spark, tmp_path):
    """A sparse file of 3 GB, too large for one value, block by block."""
    path = tmp_path / "big.bin"
    with open(path, "wb") as f:
        f.truncate(3 << 30)
    got = readers.file_fingerprints(spark, str(path), block_bytes=64 << 20).first()
    zero = hashlib.sha1(bytes(64 << 20)).hexdigest()
    assert (got.method, got.length, got.sha1) == ("blocks", 3 << 30, hashlib.sha1((zero * 48).encode()).hexdigest())
