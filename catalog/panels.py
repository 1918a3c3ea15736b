"""Queries over the daily panel: completion, features, exogenous tables, model inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    BASE, EXOG, HOLIDAYS, PANEL, PANEL0, TX, exog, holiday_days, panel, plain, query, sales, shown,
)
from catalog.sales import DAILY
from demandcast.config import ForecastConfig
from demandcast.operators import clean, features as fe, rollup
from demandcast.operators.grid import complete_calendar
from demandcast.plans.panel import feature_panel
from demandcast.session import materialise

W = "PARTITION BY product ORDER BY date"


def complete(spark, sf, zero=False):
    return complete_calendar(panel(spark, sf), fill={"y": 0.0} if zero else None)


@query("panel_base", f"WITH {BASE} " + shown("product", "y", "base", money="revenue", dates="date"))
def _(spark, sf):
    return plain(panel(spark, sf), money=["revenue"])


@query("panel_complete", f"WITH {PANEL} " + shown("product", "y", "panel", money="revenue", dates="date"))
def _(spark, sf):
    return plain(complete(spark, sf), money=["revenue"])


@query("panel_complete_zero", f"WITH {PANEL0} " + shown("product", "y", "panel", money="revenue", dates="date"))
def _(spark, sf):
    return plain(complete(spark, sf, True), money=["revenue"])


@query("panel_lags", f"WITH {PANEL}, r AS (SELECT product, date, LAG(y, 1) OVER ({W}) AS y_lag_1, LAG(y, 7) OVER ({W}) AS y_lag_7, "
       f"LAG(y, 14) OVER ({W}) AS y_lag_14 FROM panel) " + shown("product", "y_lag_1 y_lag_7 y_lag_14", "r", dates="date"))
def _(spark, sf):
    df = fe.add_causal_features(complete(spark, sf), windows=(), volatility=None)
    return plain(df.drop("y", "revenue"))


@query("panel_rollings", f"""WITH {PANEL}, r AS (SELECT product, date, AVG(y) OVER ({W} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS y_roll_3,
 AVG(y) OVER ({W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS y_roll_7,
 AVG(y) OVER ({W} ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS y_roll_30 FROM panel) """
       + shown("product", "y_roll_3 y_roll_7 y_roll_30", "r", dates="date"))
def _(spark, sf):
    df = fe.add_causal_features(complete(spark, sf), lag_days=(), volatility=None)
    return plain(df.drop("y", "revenue"))


@query("panel_volatility", f"""WITH {PANEL}, r AS (SELECT product, date,
 STDDEV_SAMP(y) OVER ({W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS y_vol_7 FROM panel) """ + shown("product", "y_vol_7", "r", dates="date"))
def _(spark, sf):
    return plain(fe.add_causal_features(complete(spark, sf), lag_days=(), windows=()).drop("y", "revenue"))


@query("rebuild_rollings", f"""WITH {PANEL}, r AS (SELECT product, date, AVG(y) OVER ({W} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS y_roll_5,
 AVG(y) OVER ({W} ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS y_roll_14 FROM panel) """
       + shown("product", "y_roll_5 y_roll_14", "r", dates="date"))
def _(spark, sf):
    stale = complete(spark, sf).withColumns({"y_roll_5": F.col("y"), "y_roll_14": F.col("revenue")})
    return plain(fe.rebuild_rollings(stale)[0].drop("y", "revenue"))


BUSINESS = f"""t AS (SELECT date, COALESCE(SUM(y), 0.0) AS total FROM panel GROUP BY 1),
 s AS (SELECT p.product, p.date, p.y, t.total, COALESCE(CASE WHEN t.total <> 0 THEN p.y / t.total END, 0.0) AS share FROM panel p JOIN t ON t.date = p.date),
 biz AS (SELECT product, date, LAG(total) OVER ({W}) AS totals_day_t1, LAG(share) OVER ({W}) AS share_day_t1,
 AVG(total) OVER ({W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS totals_day_roll_7,
 LAG(total) OVER ({W}) - LAG(y) OVER ({W}) AS competitor_sum_t1 FROM s)"""


@query("panel_business", f"WITH {PANEL}, {BUSINESS} " + shown(
    "product", "totals_day_t1 share_day_t1 totals_day_roll_7 competitor_sum_t1", "biz", dates="date"))
def _(spark, sf):
    return plain(fe.add_business_lag(materialise(complete(spark, sf))).drop("y", "revenue"))


@query("panel_labels", f"WITH {PANEL}, r AS (SELECT product, date, " + ", ".join(
    f"LEAD(y, {h}) OVER ({W}) AS y_{h}" for h in range(1, 8)) + " FROM panel) " + shown(
    "product", " ".join(f"y_{h}" for h in range(1, 8)), "r", dates="date"))
def _(spark, sf):
    return plain(fe.add_labels(complete(spark, sf)).drop("y", "revenue"))


CALENDAR = """CAST(isodow(date) - 1 AS INTEGER) AS dow, CAST(month(date) AS INTEGER) AS month, CAST(week(date) AS INTEGER) AS weekofyear,
 CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend, CAST(day(date) = 1 AS INTEGER) AS is_month_start,
 CAST(last_day(date) = date AS INTEGER) AS is_month_end, SIN(2 * PI() * (isodow(date) - 1) / 7) AS dow_sin,
 COS(2 * PI() * (isodow(date) - 1) / 7) AS dow_cos, SIN(2 * PI() * (month(date) - 1) / 12) AS month_sin,
 COS(2 * PI() * (month(date) - 1) / 12) AS month_cos"""


@query("calendar_features", f"WITH {PANEL}, r AS (SELECT product, date, 0 AS is_holiday, {CALENDAR} FROM panel) " + shown(
    "product dow month weekofyear is_weekend is_month_start is_month_end is_holiday", "dow_sin dow_cos month_sin month_cos", "r", dates="date"))
def _(spark, sf):
    return plain(fe.add_calendar(complete(spark, sf)).drop("y", "revenue"))


@query("date_parts", f"""WITH {BASE} SELECT product, CAST(date AS VARCHAR) AS date, CAST(year(date) AS INTEGER) AS year,
 CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day, CAST(quarter(date) AS INTEGER) AS quarter,
 CAST(isodow(date) - 1 AS INTEGER) AS dayofweek, CAST(week(date) AS INTEGER) AS week_of_year FROM base""")
def _(spark, sf):
    return plain(fe.add_date_parts(panel(spark, sf)).drop("y", "revenue"))


NEIGHBOURS = """dd AS (SELECT date, MAX(COALESCE(CAST(is_holiday AS INTEGER), 0)) AS f FROM flagged GROUP BY 1),
 near AS (SELECT date, COALESCE(LAG(f) OVER (ORDER BY date), 0) AS is_holiday_prev, COALESCE(LEAD(f) OVER (ORDER BY date), 0) AS is_holiday_next FROM dd)"""


@query("holiday_neighbours", f"""WITH {PANEL}, {EXOG}, flagged AS (SELECT p.product, p.date, e.is_holiday FROM panel p LEFT JOIN ex e ON e.date = p.date),
 {NEIGHBOURS} SELECT f.product, CAST(f.date AS VARCHAR) AS date, CAST(f.is_holiday AS INTEGER) AS is_holiday, is_holiday_prev, is_holiday_next
 FROM flagged f JOIN near n ON n.date = f.date""")
def _(spark, sf):
    flagged = fe.join_exogenous(materialise(complete(spark, sf).select("product", "date")), exog(spark, sf).select("date", "is_holiday"))
    out = fe.add_holiday_neighbours(flagged)
    return plain(out.withColumn("is_holiday", F.col("is_holiday").cast("int")))


@query("holiday_list_join", f"""WITH {PANEL}, {HOLIDAYS} SELECT p.product, CAST(p.date AS VARCHAR) AS date,
 CASE WHEN h.date IS NULL THEN 0 ELSE 1 END AS is_holiday_ext FROM panel p LEFT JOIN hol h ON h.date = p.date""")
def _(spark, sf):
    return plain(fe.join_holiday_list(complete(spark, sf), holiday_days(spark, sf)).drop("y", "revenue"))


@query("exog_daily", f"WITH {EXOG} " + shown("is_holiday", "x1 x3", "ex", money="x2", dates="date"))
def _(spark, sf):
    return plain(exog(spark, sf), money=["x2"])


@query("panel_exog_join", f"WITH {PANEL}, {EXOG}, r AS (SELECT p.product, p.date, p.y, e.x1, e.x2, e.x3, e.is_holiday FROM panel p LEFT JOIN ex e ON e.date = p.date) "
       + shown("product is_holiday", "y x1 x3", "r", money="x2", dates="date"))
def _(spark, sf):
    return plain(fe.join_exogenous(complete(spark, sf).drop("revenue"), exog(spark, sf)), money=["x2"])


_WIN = [("tavg", "x1", [f"LAG(x1, {n}) OVER w AS tavg_lag{n}" for n in (1, 3, 7)] + [
    "AVG(x1) OVER (w ROWS 6 PRECEDING) AS tavg_7d_mean", "SUM(x1) OVER (w ROWS 6 PRECEDING) AS tavg_7d_sum",
    "SUM(x1) OVER (w ROWS 13 PRECEDING) AS tavg_14d_sum"]),
    ("prcp_mm_month", "x3", [f"LAG(x3, {n}) OVER w AS prcp_mm_month_lag{n}d" for n in (30, 90)] + [
        f"{fn}(x3) OVER (w ROWS {n - 1} PRECEDING) AS prcp_mm_month_{n}d_{k}" for n in (30, 90) for k, fn in (("mean", "AVG"), ("sum", "SUM"))])]
_WIN_COLS = [e.rsplit(" AS ", 1)[1] for _, _, es in _WIN for e in es]


@query("exog_lag_roll", f"WITH {EXOG}, r AS (SELECT date, {', '.join(e for _, _, es in _WIN for e in es)} FROM ex WINDOW w AS (ORDER BY date)) "
       + shown("", " ".join(_WIN_COLS), "r", dates="date"))
def _(spark, sf):
    x = exog(spark, sf).select("date", F.col("x1").alias("tavg"), F.col("x3").alias("prcp_mm_month"))
    return plain(fe.add_exogenous_windows(x).drop("tavg", "prcp_mm_month"))


@query("fill_forward_back", f"""WITH {PANEL}, {EXOG}, r AS (SELECT p.product, p.date, p.y, e.x3 FROM panel p LEFT JOIN ex e ON e.date = p.date),
 q AS (SELECT product, date, COALESCE(LAST_VALUE(y IGNORE NULLS) OVER a, FIRST_VALUE(y IGNORE NULLS) OVER b) AS y,
 COALESCE(LAST_VALUE(x3 IGNORE NULLS) OVER a, FIRST_VALUE(x3 IGNORE NULLS) OVER b) AS x3 FROM r
 WINDOW a AS ({W} ROWS UNBOUNDED PRECEDING), b AS ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) """
       + shown("product", "y x3", "q", 4, dates="date"))
def _(spark, sf):
    df = fe.join_exogenous(complete(spark, sf).drop("revenue"), exog(spark, sf).select("date", "x3"))
    return plain(clean.fill_both_ways(df, ["y", "x3"]), digits=4)


@query("cap_outliers", f"""WITH {PANEL}, q AS (SELECT product, quantile_cont(y, 0.995) AS hi FROM panel GROUP BY 1),
 r AS (SELECT p.product, p.date, CASE WHEN p.y > q.hi THEN q.hi ELSE p.y END AS y FROM panel p JOIN q ON q.product = p.product) """
       + shown("product", "y", "r", dates="date"))
def _(spark, sf):
    return plain(clean.clip_at_quantile(complete(spark, sf)).drop("revenue"))


@query("daily_total_series", f"""WITH {PANEL}, {EXOG}, r AS (SELECT p.date, COALESCE(SUM(p.y), 0.0) AS y, AVG(e.x1) AS x1, AVG(e.x3) AS x3
 FROM panel p LEFT JOIN ex e ON e.date = p.date GROUP BY 1) """ + shown("", "y x1 x3", "r", dates="date"))
def _(spark, sf):
    df = fe.join_exogenous(complete(spark, sf), exog(spark, sf))
    return plain(rollup.daily_total(df, "y", ["x1", "x3", "absent"]))


_FULL_CAPPED = f"""{BASE}, {EXOG}, bx AS (SELECT b.product, b.date, b.y, b.revenue, e.x1, e.x2, e.x3, e.is_holiday FROM base b LEFT JOIN ex e ON e.date = b.date),
 bounds AS (SELECT product, MIN(date) AS lo, MAX(date) AS hi FROM base GROUP BY 1),
 grid AS (SELECT product, CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds),
 raw AS (SELECT g.product, g.date, b.y, b.revenue, b.x1, b.x2, b.x3, b.is_holiday FROM grid g LEFT JOIN bx b ON b.product = g.product AND b.date = g.date),
 q AS (SELECT product, quantile_cont(y, 0.995) AS hi FROM raw GROUP BY 1),
 panel AS (SELECT r.* REPLACE (CASE WHEN r.y > q.hi THEN q.hi ELSE r.y END AS y) FROM raw r JOIN q ON q.product = r.product)"""


@query("panel_features_full", f"""WITH {_FULL_CAPPED}, {BUSINESS}, flagged AS (SELECT product, date, is_holiday FROM panel), {NEIGHBOURS}, {HOLIDAYS},
 r AS (SELECT p.product, p.date, p.y, p.revenue, p.x1, p.x2, p.x3, COALESCE(CAST(p.is_holiday AS INTEGER), 0) AS is_holiday,
 n.is_holiday_prev, n.is_holiday_next, CASE WHEN h.date IS NULL THEN 0 ELSE 1 END AS is_holiday_ext,
 b.totals_day_t1, b.share_day_t1, b.totals_day_roll_7, b.competitor_sum_t1 FROM panel p JOIN biz b ON b.product = p.product AND b.date = p.date
 JOIN near n ON n.date = p.date LEFT JOIN hol h ON h.date = p.date),
 z AS (SELECT *, {CALENDAR}, LAG(y, 1) OVER w AS y_lag_1, LAG(y, 7) OVER w AS y_lag_7, LAG(y, 14) OVER w AS y_lag_14,
 AVG(y) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS y_roll_3, AVG(y) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS y_roll_7,
 AVG(y) OVER (w ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS y_roll_30,
 STDDEV_SAMP(y) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS y_vol_7 FROM r WINDOW w AS ({W})) """ + shown(
    "product dow month weekofyear is_weekend is_month_start is_month_end is_holiday is_holiday_prev is_holiday_next is_holiday_ext",
    "y dow_sin dow_cos month_sin month_cos totals_day_t1 share_day_t1 totals_day_roll_7 competitor_sum_t1 y_lag_1 y_lag_7 y_lag_14 "
    "y_roll_3 y_roll_7 y_roll_30 y_vol_7 x1 x3", "z", money="revenue x2", dates="date"))
def _(spark, sf):
    cfg = ForecastConfig(cap_outliers=True)
    full = feature_panel(panel(spark, sf), exog(spark, sf), holiday_days(spark, sf), cfg)
    return plain(full, money=["revenue", "x2"])


@query("lookback_windows", f"WITH {PANEL}, r AS (SELECT product, date, " + " + ".join(
    f"{30 - i} * COALESCE(LAG(y, {i}) OVER w, 0)" for i in range(30)) + " AS x_weighted, " + ", ".join(
    f"LEAD(y, {h}) OVER w AS t{h}" for h in range(1, 8)) + f""", ROW_NUMBER() OVER w AS rn, COUNT(*) OVER (PARTITION BY product) AS n
 FROM panel WINDOW w AS ({W})), f AS (SELECT * FROM r WHERE rn >= 30 AND rn + 7 <= n) """ + shown(
    "product", "x_weighted " + " ".join(f"t{h}" for h in range(1, 8)), "f", dates="date"))
def _(spark, sf):
    wins = fe.lookback_windows(complete(spark, sf), ["y"])
    flat = F.flatten("x")
    weighted = F.aggregate(F.zip_with(flat, F.sequence(F.lit(1), F.lit(30)), lambda v, i: F.coalesce(v, F.lit(0.0)) * i),
                           F.lit(0.0), lambda a, v: a + v)
    return plain(wins.select("product", "date", weighted.alias("x_weighted"),
                             *[F.get("target", F.lit(h - 1)).alias(f"t{h}") for h in range(1, 8)]))


@query("last_window_padded", f"""WITH {TX}, {DAILY}, n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY product ORDER BY date) AS rn,
 COUNT(*) OVER (PARTITION BY product) AS cnt FROM daily), pos AS (SELECT CAST(UNNEST(generate_series(0, 39)) AS INTEGER) AS i)
 SELECT n.product, pos.i, ROUND(n.amount, 2) AS amount FROM pos JOIN n ON n.rn = GREATEST(pos.i - 39 + n.cnt, 1)""")
def _(spark, sf):
    last = fe.last_window(rollup.daily_series(sales(spark, sf)), ["amount"], lookback=40)
    out = last.select("product", F.posexplode("x").alias("i", "v")).select("product", "i", F.get("v", F.lit(0)).alias("amount"))
    return plain(out, money=["amount"])


@query("feature_screen", f"""WITH {PANEL}, {EXOG}, r AS (SELECT p.*, e.x1, 1.0 AS flat, CASE WHEN p.y >= 9 THEN p.y END AS sparse, LAG(p.y, 14) OVER ({W.replace('product', 'p.product').replace('date', 'p.date')}) AS lag14
 FROM panel p LEFT JOIN ex e ON e.date = p.date), """ + "c AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, 1 - COUNT({c}) / CAST(COUNT(*) AS DOUBLE) AS null_fraction, COALESCE(MIN({c}) < MAX({c}), FALSE) AS varies FROM r"
    for c in ("revenue", "x1", "flat", "sparse", "lag14")) + """)
 SELECT feature, ROUND(null_fraction, 6) + 0.0 AS null_fraction, varies, varies AND null_fraction <= 0.3 AS kept FROM c""")
def _(spark, sf):
    df = fe.join_exogenous(complete(spark, sf), exog(spark, sf).select("date", "x1"))
    w = fe.series_window()
    df = df.withColumns({"flat": F.lit(1.0), "sparse": F.when(F.col("y") >= 9, F.col("y")), "lag14": F.lag("y", 14).over(w)})
    return plain(clean.screen_features(df))


@query("scaled_features", f"""WITH {PANEL}, tr AS (SELECT * FROM panel WHERE date <= DATE '2000-12-31'),
 s AS (SELECT AVG(y) AS my, STDDEV_POP(y) AS sy, AVG(revenue) AS mr, STDDEV_POP(revenue) AS sr FROM tr),
 r AS (SELECT product, date, (y - my) / sy AS y, (revenue - mr) / sr AS revenue FROM panel, s) """ + shown("product", "y revenue", "r", dates="date"))
def _(spark, sf):
    df = materialise(complete(spark, sf))
    scaler = fe.fit_scaler(df.where("date <= DATE '2000-12-31'"), ["y", "revenue"])
    return plain(fe.apply_scaler(df, scaler, ["y", "revenue"]))
