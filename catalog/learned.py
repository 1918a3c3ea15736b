"""Queries of the fits that run on packed series, with SQL twins where a small case has a closed form."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import PANEL0, plain, query, shown, table
from catalog.fits import AR, BAND, DAYS, GATED, full_features, gated, modelling_panel
from catalog.panels import complete
from demandcast.models import arma, direct, pinball, series, state
from demandcast.operators import features as fe, splits
from demandcast.operators.rollup import daily_total
from demandcast.plans.panel import FAMILIES, final_forecasts
from demandcast.session import materialise

#: One lag of the target and one of the innovations; a long autoregression of two lags stands for the latter.
ARMA11 = arma.Order("101", (1,), (1,))


def _normal2(name: str, src: str, y: str, a: str, b: str) -> str:
    """Least squares of y on two columns per (origin, product), from centred sums."""
    return f"""{name}_m AS (SELECT origin_id, product, AVG({y}) AS my, AVG({a}) AS ma, AVG({b}) AS mb, COUNT(*) AS n FROM {src} GROUP BY 1, 2),
 {name}_s AS (SELECT s.origin_id, s.product, ANY_VALUE(my) AS my, ANY_VALUE(ma) AS ma, ANY_VALUE(mb) AS mb, ANY_VALUE(n) AS n,
 SUM(({a} - ma) * ({a} - ma)) AS aa, SUM(({a} - ma) * ({b} - mb)) AS ab, SUM(({b} - mb) * ({b} - mb)) AS bb,
 SUM(({a} - ma) * ({y} - my)) AS ay, SUM(({b} - mb) * ({y} - my)) AS bz, SUM(({y} - my) * ({y} - my)) AS yy
 FROM {src} s JOIN {name}_m USING (origin_id, product) GROUP BY 1, 2),
 {name}_b AS (SELECT *, (ay * bb - bz * ab) / (aa * bb - ab * ab) AS ba, (bz * aa - ay * ab) / (aa * bb - ab * ab) AS b2 FROM {name}_s),
 {name} AS (SELECT *, my - ba * ma - b2 * mb AS b0, yy - ba * ay - b2 * bz AS sse FROM {name}_b)"""


HANNAN = f"""rows_ AS (SELECT o.origin_id, p.product, p.date, p.y, LAG(p.y, 1) OVER s AS l1, LAG(p.y, 2) OVER s AS l2
 FROM panel p JOIN gated o ON p.date <= o.train_end WINDOW s AS (PARTITION BY o.origin_id, p.product ORDER BY p.date)),
 one AS (SELECT * FROM rows_ WHERE l2 IS NOT NULL), {_normal2("long_", "one", "y", "l1", "l2")},
 shock AS (SELECT one.origin_id, one.product, date, y, l1, y - b0 - ba * l1 - b2 * l2 AS e FROM one JOIN long_ USING (origin_id, product)),
 two AS (SELECT * FROM (SELECT *, LAG(e) OVER (PARTITION BY origin_id, product ORDER BY date) AS e1 FROM shock) WHERE e1 IS NOT NULL),
 {_normal2("fit", "two", "y", "l1", "e1")}"""


@query("seasonal_arma_plain", f"""WITH RECURSIVE {PANEL0}, {GATED}, {DAYS}, {HANNAN},
 last AS (SELECT origin_id, product, ARG_MAX(y, date) AS y, ARG_MAX(e, date) AS e FROM shock GROUP BY 1, 2),
 path AS (SELECT f.origin_id, f.product, 1 AS h, b0 + ba * l.y + b2 * l.e AS yhat FROM fit f JOIN last l USING (origin_id, product)
 UNION ALL SELECT p.origin_id, p.product, h + 1, b0 + ba * p.yhat FROM path p JOIN fit f ON f.origin_id = p.origin_id AND f.product = p.product WHERE h < 7),
 sd AS (SELECT p.*, SQRT(f.sse / (f.n - 3)) * SQRT(1 + (SELECT COALESCE(SUM(POWER((f.ba + f.b2) * POWER(f.ba, j - 1), 2)), 0) FROM (SELECT UNNEST(generate_series(1, 6)) AS j) WHERE j < p.h)) AS sigma
 FROM path p JOIN fit f USING (origin_id, product)),
 r AS (SELECT te.origin_id, date, te.product, te.h, y, {BAND} FROM te LEFT JOIN sd ON sd.origin_id = te.origin_id AND sd.product = te.product AND sd.h = te.h) """
       + shown("origin_id product h", "y yhat yhat_p10 yhat_p90", "r", digits=4, dates="date"))
def _(spark, sf):
    """ARMA(1,1) by two regressions."""
    p = complete(spark, sf, True).drop("revenue")
    return plain(arma.seasonal_arma_forecasts(p, gated(p), [], orders=[ARMA11], long=2).drop("model"), digits=4)


@query("fit_seasonal_arma")
def _(spark, sf):
    """Both orders of the task, with and without regressors, the best per series and origin."""
    p = modelling_panel(spark, sf)
    return plain(arma.seasonal_arma_forecasts(p, gated(p)), digits=4)


@query("seasonal_arma_orders")
def _(spark, sf):
    """Which attempt each series and origin keeps, with its coefficients."""
    p = modelling_panel(spark, sf)
    fits = arma.seasonal_arma_fits(p, gated(p))
    return plain(fits.select("product", "origin_id", "model_order", "with_regressors", "n", "sigma", "constant",
                             F.concat("ar", "ma", "beta").alias("_c")).select("*", F.posexplode("_c").alias("term", "value")).drop("_c"), digits=4)


@query("bootstrap_paths")
def _(spark, sf):
    """Fifty paths of resampled innovations per series and origin."""
    p = modelling_panel(spark, sf)
    return plain(arma.seasonal_arma_forecasts(p, gated(p), samples=50), digits=4)


#: Day sums stand in for features that SQL can rebuild: today's sales and whether the day is a weekend.
SMALL = """tr AS (SELECT o.origin_id, p.product, p.date, p.y, CASE WHEN isodow(p.date) >= 6 THEN 1 ELSE 0 END AS wk, o.train_end,
 LAG(p.y) OVER s AS l1, {leads}
 FROM panel p CROSS JOIN gated o WINDOW s AS (PARTITION BY o.origin_id, p.product ORDER BY p.date))""".format(
    leads=", ".join(f"LEAD(p.y, {h}) OVER s AS y_{h}" for h in range(1, 8)))
LONG = "lb AS (" + " UNION ALL ".join(
    f"SELECT origin_id, product, date, train_end, wk, y, l1, CAST({h} AS INTEGER) AS h, y_{h} AS t FROM tr" for h in range(1, 8)) + ")"
KNOWN = "kn AS (SELECT * FROM lb WHERE date + h <= train_end AND t IS NOT NULL)"
AT_END = "en AS (SELECT * FROM lb WHERE date = train_end)"


def weekend_panel(spark, sf):
    p = complete(spark, sf, True).drop("revenue")
    return p.withColumn("weekend", (F.weekday("date") >= 5).cast("int"))


@query("boosted_stump_plain", f"""WITH {PANEL0}, {GATED}, {DAYS}, {SMALL}, {LONG}, {KNOWN}, {AT_END},
 m AS (SELECT origin_id, h, AVG(t) AS base FROM kn GROUP BY 1, 2),
 lf AS (SELECT kn.origin_id, kn.h, wk, ANY_VALUE(base) + SUM(t - base) / (COUNT(*) + 1) AS yhat FROM kn JOIN m USING (origin_id, h) GROUP BY 1, 2, 3),
 r AS (SELECT te.origin_id, te.date, te.product, te.h, te.y, lf.yhat FROM te LEFT JOIN en ON en.origin_id = te.origin_id AND en.product = te.product AND en.h = te.h
 LEFT JOIN lf ON lf.origin_id = en.origin_id AND lf.h = en.h AND lf.wk = en.wk) """ + shown("origin_id product h", "y yhat", "r", digits=4, dates="date"))
def _(spark, sf):
    """One tree of depth one on one input: two leaves, each the shrunken mean of its rows."""
    p = weekend_panel(spark, sf)
    fc = direct.boosted_forecasts(p, materialise(gated(p)), ["weekend"], max_iter=1, max_depth=1)
    return plain(fc.select("origin_id", "date", "product", "h", "y", "yhat"), digits=4)


@query("glm_plain", f"""WITH {PANEL0}, {GATED}, {DAYS}, {SMALL}, {LONG}, {KNOWN}, {AT_END},
 g AS (SELECT origin_id, h, wk, AVG(t) AS yhat FROM kn GROUP BY 1, 2, 3),
 r AS (SELECT te.origin_id, te.date, te.product, te.h, te.y, g.yhat FROM te LEFT JOIN en ON en.origin_id = te.origin_id AND en.product = te.product AND en.h = te.h
 LEFT JOIN g ON g.origin_id = en.origin_id AND g.h = en.h AND g.wk = en.wk) """ + shown("origin_id product h", "y yhat", "r", digits=4, dates="date"))
def _(spark, sf):
    """A log-linear fit on one flag without shrinkage is the mean of each group, whatever the power."""
    p = weekend_panel(spark, sf)
    fc = direct.glm_grid_forecasts(p, materialise(gated(p)), ["weekend"], powers=(1.3,), poisson=False, reg=0.0)
    return plain(fc.select("origin_id", "date", "product", "h", "y", "yhat"), digits=4)


def _sequence_sql(label: str, back: str) -> str:
    """Two days of one channel, standardised on training rows, ridge 1: two normal equations per origin and horizon."""
    return f"""WITH {PANEL0}, {GATED}, {DAYS}, {SMALL}, {LONG},
 sc AS (SELECT origin_id, AVG(y) AS m, STDDEV_POP(y) AS s FROM tr WHERE date <= train_end GROUP BY 1),
 wi AS (SELECT lb.origin_id, lb.product, lb.date, lb.train_end, lb.h, (y - m) / s AS a, (l1 - m) / s AS b, {label} AS t FROM lb JOIN sc USING (origin_id) WHERE l1 IS NOT NULL),
 ful AS (SELECT * FROM wi WHERE date + 7 <= train_end),
 mn AS (SELECT origin_id, h, AVG(a) AS ma, AVG(b) AS mb, AVG(t) AS mt FROM ful GROUP BY 1, 2),
 cv AS (SELECT f.origin_id, f.h, ANY_VALUE(ma) AS ma, ANY_VALUE(mb) AS mb, ANY_VALUE(mt) AS mt, AVG((a - ma) * (a - ma)) + 1 AS aa, AVG((a - ma) * (b - mb)) AS ab,
 AVG((b - mb) * (b - mb)) + 1 AS bb, AVG((a - ma) * (t - mt)) AS at_, AVG((b - mb) * (t - mt)) AS bt FROM ful f JOIN mn USING (origin_id, h) GROUP BY 1, 2),
 be AS (SELECT *, (at_ * bb - bt * ab) / (aa * bb - ab * ab) AS wa, (bt * aa - at_ * ab) / (aa * bb - ab * ab) AS wb FROM cv),
 fc AS (SELECT wi.origin_id, wi.product, wi.h, mt + wa * (a - ma) + wb * (b - mb) AS v FROM wi JOIN be USING (origin_id, h) WHERE wi.date = wi.train_end),
 r AS (SELECT te.origin_id, te.date, te.product, te.h, te.y, {back} AS yhat FROM te LEFT JOIN fc ON fc.origin_id = te.origin_id AND fc.product = te.product AND fc.h = te.h) """ + shown(
        "origin_id product h", "y yhat", "r", digits=4, dates="date")


@query("sequence_plain", _sequence_sql("t", "v"))
def _(spark, sf):
    """The target alone, two days back."""
    p = complete(spark, sf, True).drop("revenue")
    fc = direct.sequence_forecasts(p, materialise(gated(p)), ["y"], lookback=2, ridge=1.0)
    return plain(fc.select("origin_id", "date", "product", "h", "y", "yhat"), digits=4)


@query("sequence_log1p_plain", _sequence_sql("LN(1 + t)", "EXP(v) - 1"))
def _(spark, sf):
    """The same fit of the logarithm, turned back."""
    p = complete(spark, sf, True).drop("revenue")
    fc = direct.sequence_forecasts(p, materialise(gated(p)), ["y"], lookback=2, ridge=1.0, log1p=True)
    return plain(fc.select("origin_id", "date", "product", "h", "y", "yhat"), digits=4)


INPUTS = ["y_lag_1", "y_lag_7", "y_lag_14", "revenue", "dow", "y_roll_7"]


@query("selected_features", f"""WITH {PANEL0}, {GATED}, f AS (SELECT *, LAG(y, 1) OVER s AS y_lag_1, LAG(y, 7) OVER s AS y_lag_7, LAG(y, 14) OVER s AS y_lag_14,
 isodow(date) - 1 AS dow, AVG(y) OVER (PARTITION BY product ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS y_roll_7,
 LEAD(y, 1) OVER s AS t1, LEAD(y, 7) OVER s AS t7 FROM panel WINDOW s AS (PARTITION BY product ORDER BY date)),
 c AS ({" UNION ALL ".join(f"SELECT origin_id, {h} AS h, '{c}' AS feature, ROUND(ABS(CORR({c}, t{h})), 6) AS importance FROM f JOIN gated ON date + {h} <= train_end GROUP BY 1" for c in INPUTS for h in (1, 7))}),
 k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY origin_id, h ORDER BY importance DESC NULLS LAST, feature) AS r FROM c)
 SELECT DISTINCT origin_id, feature FROM k WHERE r <= 2""")
def _(spark, sf):
    """Union of the two strongest inputs of the first and the last horizon per origin, by correlation with the label."""
    p = complete(spark, sf, True)
    w = fe.series_window()
    f = p.withColumns({"y_lag_1": F.lag("y", 1).over(w), "y_lag_7": F.lag("y", 7).over(w), "y_lag_14": F.lag("y", 14).over(w), "dow": F.weekday("date"),
                       "y_roll_7": F.avg("y").over(w.rowsBetween(-6, 0)), "t1": F.lead("y", 1).over(w), "t7": F.lead("y", 7).over(w)})
    rows = splits.split_rows(f, gated(p), "train")
    known = {h: F.date_add("date", h) <= F.col("train_end") for h in (1, 7)}
    wide = rows.groupBy("origin_id").agg(*[F.round(F.abs(F.corr(F.when(known[h], F.col(c)), F.when(known[h], F.col(f"t{h}")))), 6).alias(f"{c}|{h}")
                                           for c in INPUTS for h in (1, 7)])
    long = wide.select("origin_id", F.explode(F.array(*[F.struct(F.lit(h).alias("h"), F.lit(c).alias("feature"), F.col(f"`{c}|{h}`").alias("importance"))
                                                        for c in INPUTS for h in (1, 7)])).alias("s")).select("origin_id", "s.*")
    return direct.union_top(long, 2)


@query("refit_from_state", f"""WITH {PANEL0}, ends AS (SELECT 1 AS origin_id, MAX(date) AS train_end FROM panel), {AR},
 r AS (SELECT product, UNNEST([0, 1, 2]) AS term, UNNEST([b0, b1, b7]) AS value, sigma FROM fit) """ + shown("product term", "value sigma", "r"))
def _(spark, sf):
    """Old months summed once, then the new days with the last week before them: the fit of the whole history."""
    p = materialise(complete(spark, sf, True).drop("revenue"))
    cut = p.agg(F.date_sub(F.max("date"), 40).alias("d")).scalar()
    old, new = p.where(F.col("date") <= cut), p.where(F.col("date") > cut)
    whole = state.merge(materialise(state.month_state(old)), state.month_state(new, tail=state.tail_rows(old)))
    return plain(state.fit_state(whole).select("product", F.posexplode("coef").alias("term", "value"), "sigma"))


@query("batch_score_plain", f"""WITH RECURSIVE {PANEL0.replace("panel AS (", "each_ AS (")}, panel AS (SELECT 'total' AS product, date, SUM(y) AS y FROM each_ GROUP BY 2),
 ends AS (SELECT 1 AS origin_id, MAX(date) AS train_end FROM panel), {AR},
 back AS (SELECT y, ROW_NUMBER() OVER (ORDER BY date DESC) AS r FROM panel),
 path AS (SELECT 0 AS step, (SELECT LIST(y ORDER BY r) FROM back WHERE r <= 7) AS past, NULL::DOUBLE AS v
 UNION ALL SELECT step + 1, list_prepend(b0 + b1 * past[1] + b7 * past[7], past[1:6]), b0 + b1 * past[1] + b7 * past[7] FROM path, fit WHERE step < 30)
 SELECT c_custkey AS request_id, CAST(c_custkey % 33 AS INTEGER) AS horizon, CASE WHEN c_custkey % 33 NOT BETWEEN 1 AND 30 THEN 'horizon must be 1..30' END AS error,
 CASE WHEN c_custkey % 33 BETWEEN 1 AND 30 THEN 'seasonal_ar' END AS model_type, CASE WHEN p.step IS NOT NULL THEN p.step - 1 END AS step, ROUND(p.v, 4) AS prediction
 FROM customer LEFT JOIN path p ON c_custkey % 33 BETWEEN 1 AND 30 AND p.step BETWEEN 1 AND c_custkey % 33""")
def _(spark, sf):
    """Requests without regressors against the autoregression of the daily total."""
    p = complete(spark, sf, True).drop("revenue")
    total = materialise(daily_total(p, "y").withColumn("product", F.lit("total")))
    fit = series.final_parameters(total, splits.final_origin(total), [])
    requests = table(spark, sf, "customer").select(F.col("c_custkey").alias("request_id"), F.lit("total").alias("product"),
                                                   (F.col("c_custkey") % 33).cast("int").alias("horizon"), F.expr("CAST(NULL AS array<struct<none:double>>)").alias("exog"))
    scored = series.score_requests(requests, fit, [])
    flat = F.posexplode_outer(F.transform("predictions", lambda v: F.round(v + F.lit(1e-9), 4)))
    return scored.select("request_id", "horizon", "error", "model_type", flat.alias("step", "prediction"))


@query("final_families")
def _(spark, sf):
    """Every family refitted on the full history, the days after it."""
    p = full_features(spark, sf)
    out = None
    for family in FAMILIES:
        part = final_forecasts(p, family).withColumn("family", F.lit(family))
        out = part if out is None else out.unionByName(part)
    return plain(out, digits=4)


@query("quantile_bands")
def _(spark, sf):
    """Quantile regressions on the forecast's own level, per series and origin."""
    p = modelling_panel(spark, sf)
    o = materialise(gated(p))
    fc = materialise(series.additive_forecasts(p, o))
    past = series.additive_residuals(p, o).join(p.select("product", "date", "y"), ["product", "date"]).withColumn("yhat", F.col("y") - F.col("residual"))
    return plain(pinball.quantile_bands(fc, past, ["yhat"], ["product", "origin_id"]).select(
        "origin_id", "date", "product", "h", "y", "yhat", "yhat_p10", "yhat_p90"), digits=4)
