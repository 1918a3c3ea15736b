"""Queries that fit models. They have no SQL twin; tests check them on planted signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import ORIGINS, PANEL0, exog, panel, plain, query, shown, table
from catalog.panels import complete
from demandcast.models import bands, boosting, direct, series
from demandcast.operators import features as fe, selection, splits
from demandcast.operators.metrics import metrics_by_h, metrics_overall
from demandcast.operators.rollup import daily_total
from demandcast.plans.panel import feature_panel, run_backtest
from demandcast.session import materialise

REGRESSORS = ["is_holiday", "is_holiday_prev", "is_holiday_next"]
EXOG_FIELDS = ["is_holiday", "is_holiday_prev", "is_holiday_next", "wx_temperature_2m", "wx_precipitation", "wx_cloudcover"]


def modelling_panel(spark, sf):
    """Zero-filled panel with holiday flags of the order calendar, written once."""
    base = complete(spark, sf, True).drop("revenue")
    flagged = materialise(fe.join_exogenous(base, exog(spark, sf).select("date", "is_holiday")))
    flagged = flagged.withColumn("is_holiday", F.coalesce(F.col("is_holiday").cast("int"), F.lit(0)))
    return materialise(fe.add_holiday_neighbours(flagged))


def gated(p):
    return splits.history_gate(splits.rolling_origins(p))


# --- models without regressors have closed forms that SQL can state --------------------------

GATED = ORIGINS + ", gated AS (SELECT * FROM origins WHERE n_train_days >= 150)"
DAYS = """te AS (SELECT o.origin_id, p.product, p.date, CAST(p.date - o.test_start + 1 AS INTEGER) AS h, p.y
 FROM panel p JOIN gated o ON p.date BETWEEN o.test_start AND o.test_end)"""
#: Trend by weekday-demeaned covariance over variance; the level of each weekday from its means.
ADDITIVE = GATED + f""", {DAYS},
 tr AS (SELECT o.origin_id, p.product, p.date, isodow(p.date) AS w, (p.date - DATE '2000-01-01') / 365.25 AS t, p.y FROM panel p JOIN gated o ON p.date <= o.train_end),
 wk AS (SELECT origin_id, product, w, AVG(t) AS mt, AVG(y) AS my FROM tr GROUP BY 1, 2, 3),
 dm AS (SELECT tr.*, t - mt AS dt, y - my AS dy FROM tr JOIN wk USING (origin_id, product, w)),
 sl AS (SELECT origin_id, product, SUM(dt * dy) / SUM(dt * dt) AS b, SUM(dy * dy) - SUM(dt * dy) * SUM(dt * dy) / SUM(dt * dt) AS sse, COUNT(*) AS n FROM dm GROUP BY 1, 2),
 ad AS (SELECT te.*, my + b * ((te.date - DATE '2000-01-01') / 365.25 - mt) AS yhat, SQRT(sse / (n - 8)) AS sigma
 FROM te JOIN sl USING (origin_id, product) JOIN wk ON wk.origin_id = te.origin_id AND wk.product = te.product AND wk.w = isodow(te.date))"""
#: Two centred normal equations for lags 1 and 7.
AR = """lg AS (SELECT product, date, y, LAG(y, 1) OVER s AS a, LAG(y, 7) OVER s AS c FROM panel WINDOW s AS (PARTITION BY product ORDER BY date)),
 ls AS (SELECT k.origin_id, product, y, a, c FROM lg JOIN ends k ON date <= k.train_end WHERE c IS NOT NULL),
 mn AS (SELECT origin_id, product, AVG(y) AS my, AVG(a) AS ma, AVG(c) AS mc FROM ls GROUP BY 1, 2),
 sm AS (SELECT origin_id, product, SUM((a - ma) * (a - ma)) AS aa, SUM((a - ma) * (c - mc)) AS ac, SUM((c - mc) * (c - mc)) AS cc,
 SUM((a - ma) * (y - my)) AS ay, SUM((c - mc) * (y - my)) AS cy, SUM((y - my) * (y - my)) AS yy, COUNT(*) AS n, ANY_VALUE(my) AS my, ANY_VALUE(ma) AS ma, ANY_VALUE(mc) AS mc
 FROM ls JOIN mn USING (origin_id, product) GROUP BY 1, 2),
 be AS (SELECT *, (ay * cc - cy * ac) / (aa * cc - ac * ac) AS b1, (cy * aa - ay * ac) / (aa * cc - ac * ac) AS b7 FROM sm),
 fit AS (SELECT *, my - b1 * ma - b7 * mc AS b0, SQRT((yy - b1 * ay - b7 * cy) / (n - 3)) AS sigma FROM be)"""
BAND = "yhat, yhat - {z} * sigma AS yhat_p10, yhat + {z} * sigma AS yhat_p90".format(z=series.Z80)


@query("bootstrap_bands_plain", f"""WITH {PANEL0}, {ADDITIVE}, re AS (SELECT dm.origin_id, dm.product, dy - b * dt AS e FROM dm JOIN sl USING (origin_id, product)),
 pool AS (SELECT product, origin_id, LIST(e ORDER BY e) AS pool FROM re GROUP BY 1, 2),
 dr AS (SELECT ad.*, yhat + pool[CAST(('0x' || substr(md5(ad.product || '|' || ad.origin_id || '|' || h || '|' || CAST(ad.date AS VARCHAR) || '|' || i || '|42'), 1, 12))::BIGINT % len(pool) AS BIGINT) + 1] AS v
 FROM ad JOIN pool USING (origin_id, product), (SELECT UNNEST(generate_series(1, 50)) AS i)),
 r AS (SELECT origin_id, date, product, h, ANY_VALUE(y) AS y, AVG(v) AS yhat, quantile_cont(v, 0.1) AS yhat_p10, quantile_cont(v, 0.9) AS yhat_p90 FROM dr GROUP BY 1, 2, 3, 4) """
       + shown("origin_id product h", "y yhat yhat_p10 yhat_p90", "r", digits=4, dates="date"))
def _(spark, sf):
    """Fifty residual draws around each forecast, the same in both engines."""
    p = complete(spark, sf, True).drop("revenue")
    o = materialise(gated(p))
    got = bands.bootstrap_bands(series.additive_forecasts(p, o, []), series.additive_residuals(p, o, []), ["product", "origin_id"])
    return plain(got.select("origin_id", "date", "product", "h", "y", "yhat", "yhat_p10", "yhat_p90"), digits=4)


@query("additive_plain", f"WITH {PANEL0}, {ADDITIVE}, r AS (SELECT origin_id, date, product, h, y, {BAND} FROM ad) "
       + shown("origin_id product h", "y yhat yhat_p10 yhat_p90", "r", digits=4, dates="date"))
def _(spark, sf):
    p = complete(spark, sf, True).drop("revenue")
    return plain(series.additive_forecasts(p, gated(p), []).drop("model"), digits=4)


@query("seasonal_ar_plain", f"""WITH RECURSIVE {PANEL0}, {GATED}, {DAYS}, ends AS (SELECT origin_id, train_end FROM gated), {AR},
 back AS (SELECT k.origin_id, product, y, CAST(ROW_NUMBER() OVER (PARTITION BY k.origin_id, product ORDER BY date DESC) AS INTEGER) AS r FROM panel JOIN ends k ON date <= k.train_end),
 path AS (SELECT f.origin_id, f.product, 1 AS h, b0 + b1 * one.y + b7 * old.y AS yhat FROM fit f
 JOIN back one ON one.origin_id = f.origin_id AND one.product = f.product AND one.r = 1 JOIN back old ON old.origin_id = f.origin_id AND old.product = f.product AND old.r = 7
 UNION ALL SELECT f.origin_id, f.product, p.h + 1, b0 + b1 * p.yhat + b7 * old.y FROM path p JOIN fit f ON f.origin_id = p.origin_id AND f.product = p.product
 JOIN back old ON old.origin_id = f.origin_id AND old.product = f.product AND old.r = 7 - p.h WHERE p.h < 7),
 sd AS (SELECT p.*, f.sigma * SQRT((SELECT SUM(POWER(f.b1, 2 * j)) FROM (SELECT UNNEST(generate_series(0, 6)) AS j) WHERE j < p.h)) AS sigma FROM path p JOIN fit f USING (origin_id, product)),
 r AS (SELECT te.origin_id, date, te.product, te.h, y, {BAND} FROM te JOIN sd ON sd.origin_id = te.origin_id AND sd.product = te.product AND sd.h = te.h) """
       + shown("origin_id product h", "y yhat yhat_p10 yhat_p90", "r", digits=4, dates="date"))
def _(spark, sf):
    p = complete(spark, sf, True).drop("revenue")
    return plain(series.seasonal_ar_forecasts(p, gated(p), []).drop("model"), digits=4)


@query("final_parameters_plain", f"""WITH {PANEL0}, ends AS (SELECT 1 AS origin_id, MAX(date) AS train_end FROM panel), {AR},
 last AS (SELECT product, MAX(date) AS last_date FROM panel GROUP BY 1),
 r AS (SELECT product, UNNEST([0, 1, 2]) AS term, UNNEST([b0, b1, b7]) AS value, sigma, last_date FROM fit JOIN last USING (product)) """
       + shown("product term", "value sigma", "r", dates="last_date"))
def _(spark, sf):
    p = complete(spark, sf, True).drop("revenue")
    fit = series.final_parameters(p, splits.final_origin(p), [])
    return plain(fit.select("product", F.posexplode("coef").alias("term", "value"), "sigma", "last_date"))


@query("residual_bands_plain", f"""WITH {PANEL0}, {ADDITIVE}, re AS (SELECT dm.origin_id, dm.product, dy - b * dt AS e FROM dm JOIN sl USING (origin_id, product)),
 q AS (SELECT origin_id, product, quantile_cont(e, 0.1) AS lo, quantile_cont(e, 0.9) AS hi FROM re GROUP BY 1, 2),
 r AS (SELECT ad.origin_id, ad.date, ad.product, ad.h, ad.y, ad.yhat, ad.yhat + lo AS yhat_p10, ad.yhat + hi AS yhat_p90 FROM ad JOIN q USING (origin_id, product)) """
       + shown("origin_id product h", "y yhat yhat_p10 yhat_p90", "r", digits=4, dates="date"))
def _(spark, sf):
    p = complete(spark, sf, True).drop("revenue")
    o = materialise(gated(p))
    got = bands.residual_bands(series.additive_forecasts(p, o, []), series.additive_residuals(p, o, []), ["product", "origin_id"])
    return plain(got.select("origin_id", "date", "product", "h", "y", "yhat", "yhat_p10", "yhat_p90"), digits=4)


@query("fit_additive")
def _(spark, sf):
    p = modelling_panel(spark, sf)
    return plain(series.additive_forecasts(p, gated(p)), digits=4)


@query("fit_seasonal_ar")
def _(spark, sf):
    p = modelling_panel(spark, sf)
    return plain(series.seasonal_ar_forecasts(p, gated(p)), digits=4)


def full_features(spark, sf):
    return materialise(feature_panel(panel(spark, sf), exog(spark, sf), fill={"y": 0.0}))


@query("fit_boosted_direct")
def _(spark, sf):
    """Trees on the union of the most important inputs of each origin."""
    p = full_features(spark, sf)
    return plain(direct.boosted_forecasts(p, gated(p)), digits=4)


@query("fit_glm_grid")
def _(spark, sf):
    """Every screened input, Poisson and three Tweedie powers per origin and horizon."""
    p = full_features(spark, sf)
    return plain(direct.glm_grid_forecasts(p, gated(p)), digits=4)


@query("fit_sequence_regression")
def _(spark, sf):
    """Thirty days of every numeric channel."""
    p = full_features(spark, sf)
    return plain(direct.sequence_forecasts(p, gated(p)), digits=4)


@query("feature_importance")
def _(spark, sf):
    """Permutation importance of every input, for all origins and horizons."""
    p = full_features(spark, sf)
    return plain(boosting.feature_importance(p, materialise(gated(p)), direct.possible_inputs(p)), digits=6)


@query("residual_bands")
def _(spark, sf):
    p = modelling_panel(spark, sf)
    o = materialise(gated(p))
    fc = series.additive_forecasts(p, o)
    return plain(bands.residual_bands(fc, series.additive_residuals(p, o), ["product", "origin_id"]), digits=4)


@query("bootstrap_bands")
def _(spark, sf):
    p = modelling_panel(spark, sf)
    o = materialise(gated(p))
    fc = series.additive_forecasts(p, o)
    return plain(bands.bootstrap_bands(fc, series.additive_residuals(p, o), ["product", "origin_id"]), digits=4)


@query("final_parameters")
def _(spark, sf):
    p = modelling_panel(spark, sf)
    fit = series.final_parameters(p, splits.final_origin(p), REGRESSORS)
    return plain(fit.select("model", "version", "product", F.posexplode("coef").alias("term", "value"), "sigma", "last_date"), digits=6)


def total_parameters(spark, sf):
    p = modelling_panel(spark, sf)
    total = daily_total(p, "y", REGRESSORS).withColumn("product", F.lit("total"))
    # Daily values of the orders stand in for weather: mean price, order count and mean customer number.
    daily = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(
        (F.avg("o_totalprice") / 10000).alias("wx_temperature_2m"), F.count(F.lit(1)).cast("double").alias("wx_precipitation"),
        (F.avg("o_custkey") / 10).alias("wx_cloudcover"))
    total = materialise(total.join(daily, "date", "left"))
    return series.final_parameters(total, splits.final_origin(total), EXOG_FIELDS)


@query("batch_score")
def _(spark, sf):
    """One request per customer, some of them invalid in each way a request can be."""
    c = F.col("c_custkey")
    day = F.struct(*[F.lit(v).alias(n) for n, v in series.DEFAULT_FUTURE_EXOG.items()])
    requests = table(spark, sf, "customer").select(
        c.alias("request_id"), F.lit("total").alias("product"), (c % 33).cast("int").alias("horizon"),
        F.when(c % 3 == 0, F.array_repeat(day, (c % 33).cast("int"))).when(c % 7 == 1, F.array_repeat(day, 2)).alias("exog"))
    scored = series.score_requests(requests, total_parameters(spark, sf), EXOG_FIELDS)
    flat = F.posexplode_outer(F.transform("predictions", lambda v: F.round(v, 4)))
    return scored.select("request_id", "horizon", "error", "model_type", flat.alias("step", "prediction"))


@query("backtest_families")
def _(spark, sf):
    """Every family over all origins, ranked as one selection run."""
    p = full_features(spark, sf)
    fc = materialise(run_backtest(p))
    ranked = selection.select_family(metrics_by_h(fc, ["family"]), model="family")
    return plain(ranked.join(metrics_overall(fc, ["family"]), "family"), digits=4)


@query("future_regressors", f"""WITH {PANEL0}, ex AS (SELECT CAST(o_orderdate AS DATE) AS date, AVG(CAST(o_custkey AS DOUBLE)) AS x3 FROM orders GROUP BY 1),
 px AS (SELECT p.product, p.date, e.x3 FROM panel p LEFT JOIN ex e ON e.date = p.date),
 l AS (SELECT MAX(date) AS last FROM panel WHERE date <= DATE '2001-07-29'), pr AS (SELECT DISTINCT product FROM panel),
 f AS (SELECT pr.product, last + CAST(s.h AS INTEGER) AS date, CAST(s.h AS INTEGER) AS h FROM pr, l, (SELECT UNNEST(generate_series(1, 7)) AS h) s),
 j AS (SELECT f.product, f.date, f.h, px.x3 FROM f LEFT JOIN px ON px.product = f.product AND px.date = f.date)
 SELECT product, CAST(date AS VARCHAR) AS date, h, ROUND(COALESCE(LAST_VALUE(x3 IGNORE NULLS) OVER (PARTITION BY product ORDER BY date ROWS UNBOUNDED PRECEDING),
 FIRST_VALUE(x3 IGNORE NULLS) OVER (PARTITION BY product ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS x3 FROM j""")
def _(spark, sf):
    p = materialise(fe.join_exogenous(complete(spark, sf, True).drop("revenue"), exog(spark, sf).select("date", "x3")))
    origin = splits.final_origin(p.where("date <= DATE '2001-07-29'"))
    future = splits.future_days(p.select("product").distinct(), origin)
    return plain(series.future_regressors(future, p, ["x3"]).drop("origin_id"))
