"""Queries for KPIs, forecast and validation views, supply and finance."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import TX, plain, query, sales, shown
from catalog.sales import DAILY, TOTAL
from demandcast.constants import UNIT_COSTS
from demandcast.operators import clean, kpi, rollup, supply
from demandcast.operators.baselines import mean7_forecast
from demandcast.session import materialise


def kpi_sql(where: str = "TRUE") -> str:
    return f"""WITH {TX}, s AS (SELECT * FROM tx WHERE {where}), d AS (SELECT CAST(datetime AS DATE) AS d, SUM(amount) AS v FROM s GROUP BY 1),
 l AS (SELECT MAX(d) AS last FROM d),
 k AS (SELECT COALESCE(SUM(v) FILTER (d = last), 0.0) AS now, COALESCE(SUM(v) FILTER (d = last - 7), 0.0) AS wk,
 COALESCE(AVG(v) FILTER (isodow(d) = isodow(last)), 0.0) AS hist, COALESCE(SUM(v), 0.0) AS total FROM d, l)
 SELECT ROUND(now, 2) AS revenue_last_day, ROUND(CASE WHEN wk > 0 THEN (now - wk) / wk * 100 ELSE 0.0 END, 6) + 0.0 AS week_change_pct,
 ROUND(CASE WHEN hist > 0 THEN (now - hist) / hist * 100 ELSE 0.0 END, 6) + 0.0 AS history_change_pct, ROUND(total, 2) AS revenue_total,
 COALESCE((SELECT product FROM s GROUP BY 1 ORDER BY SUM(amount) DESC, 1 LIMIT 1), 'N/A') AS top_product FROM k"""


KPI_MONEY = ["revenue_last_day", "revenue_total"]


@query("kpi_row", kpi_sql())
def _(spark, sf):
    return plain(kpi.kpi_row(sales(spark, sf)), money=KPI_MONEY)


@query("kpi_slice", kpi_sql("""datetime >= TIMESTAMP '2024-01-03 00:00:00' AND datetime <= TIMESTAMP '2024-01-28 23:00:00'
 AND isodow(datetime) IN (5, 6, 7) AND hour(datetime) BETWEEN 9 AND 20"""))
def _(spark, sf):
    df = clean.weekday_name(sales(spark, sf), "datetime").withColumn("hour", F.hour("datetime"))
    part = clean.slice_sales(df, "2024-01-03 00:00:00", "2024-01-28 23:00:00", "All", ["Viernes", "Sábado", "Domingo"], (9, 20))
    return plain(kpi.kpi_row(part), money=KPI_MONEY)


@query("kpi_empty_slice", kpi_sql("product = 'nothing'"))
def _(spark, sf):
    return plain(kpi.kpi_row(clean.slice_sales(sales(spark, sf), product="nothing")), money=KPI_MONEY)


@query("top_seller", f"WITH {TX}, r AS (SELECT product, SUM(amount) AS amount FROM tx GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1) "
       + shown("product", "", "r", money="amount"))
def _(spark, sf):
    return plain(kpi.top_seller(sales(spark, sf)), money=["amount"])


NAMED = f"""{TX}, {DAILY}, tail AS (SELECT product, date, amount, ROW_NUMBER() OVER (PARTITION BY product ORDER BY date DESC) AS r FROM daily),
 lev AS (SELECT upper(product[1]) || product[2:] AS product, AVG(amount) AS forecast, MAX(date) AS last FROM tail WHERE r <= 7 GROUP BY 1),
 hs AS (SELECT CAST(UNNEST(generate_series(1, 7)) AS INTEGER) AS h),
 pf AS (SELECT product, last + h AS date, h, forecast FROM lev, hs), ft AS (SELECT date, SUM(forecast) AS forecast FROM pf GROUP BY 1)"""


@query("ma7_forecast", f"WITH {NAMED} " + shown("product h", "forecast", "pf", dates="date"))
def _(spark, sf):
    return plain(kpi.product_forecasts(sales(spark, sf)))


@query("ma7_forecast_15", f"""WITH {TX}, {DAILY}, tail AS (SELECT product, date, amount, ROW_NUMBER() OVER (PARTITION BY product ORDER BY date DESC) AS r FROM daily),
 lev AS (SELECT product, AVG(amount) AS forecast, MAX(date) AS last FROM tail WHERE r <= 7 GROUP BY 1),
 pf AS (SELECT product, last + CAST(s.h AS INTEGER) AS date, CAST(s.h AS INTEGER) AS h, forecast FROM lev, (SELECT UNNEST(generate_series(1, 15)) AS h) s) """
       + shown("product h", "forecast", "pf", dates="date"))
def _(spark, sf):
    return plain(mean7_forecast(rollup.daily_series(sales(spark, sf)), 15))


@query("forecast_total", f"WITH {NAMED} " + shown("", "forecast", "ft", dates="date"))
def _(spark, sf):
    return plain(kpi.forecast_totals(kpi.product_forecasts(sales(spark, sf))))


@query("actual_and_forecast", f"""WITH {NAMED}, {TOTAL}, r AS (SELECT COALESCE(t.date, f.date) AS date, t.amount AS real, f.forecast
 FROM total t FULL JOIN ft f ON f.date = t.date) """ + shown("", "forecast", "r", money="real", dates="date"))
def _(spark, sf):
    df = sales(spark, sf)
    return plain(kpi.actual_and_forecast(df, kpi.product_forecasts(df)), money=["real"])


@query("forecast_change", f"""WITH {NAMED}, {TOTAL}, b AS (SELECT *, ROW_NUMBER() OVER (ORDER BY date DESC) AS back, COUNT(*) OVER () AS n FROM total),
 p AS (SELECT SUM(amount) AS prev FROM b WHERE back > 7 AND (n < 14 OR back <= 14)), t AS (SELECT SUM(forecast) AS tot FROM pf)
 SELECT ROUND(tot, 4) AS total_forecast, ROUND(prev, 4) AS previous_total, ROUND(CASE WHEN prev > 0 THEN (tot - prev) / prev * 100 END, 4) + 0.0 AS change_pct FROM p, t""")
def _(spark, sf):
    df = sales(spark, sf)
    return plain(kpi.forecast_change(df, kpi.product_forecasts(df)), digits=4)


VALIDATION = f"""{NAMED}, {TOTAL}, b AS (SELECT *, ROW_NUMBER() OVER (ORDER BY date DESC) AS back, COUNT(*) OVER () AS n FROM total),
 fr AS (SELECT forecast, ROW_NUMBER() OVER (ORDER BY date) AS pos FROM ft),
 v AS (SELECT b.date, b.amount AS real, fr.forecast FROM b LEFT JOIN fr ON fr.pos = 8 - b.back WHERE b.back <= 7 AND b.n > 7)"""


@query("validation_view", f"WITH {VALIDATION} " + shown("", "forecast", "v", money="real", dates="date"))
def _(spark, sf):
    return plain(kpi.validation_view(sales(spark, sf)), money=["real"])


@query("validation_errors", f"""WITH {VALIDATION} SELECT ROUND(SQRT(AVG((real - forecast) * (real - forecast))), 6) AS RMSE,
 ROUND(AVG(ABS(real - forecast)), 6) AS MAE, ROUND(CASE WHEN COUNT(*) FILTER (real = 0) = 0
 THEN AVG(ABS((real - forecast) / real)) * 100 END, 6) AS MAPE FROM v""")
def _(spark, sf):
    return plain(kpi.validation_errors(kpi.validation_view(sales(spark, sf))))


# Dimensions of the supply queries: one product without a recipe, one ingredient without a cost.
RECIPES = {
    "Click": {"coffee_g": 7, "milk_ml": 90, "sugar_g": 3},
    "Purchase": {"coffee_g": 11, "water_ml": 45, "cup": 1},
    "Signup": {"milk_ml": 130, "chocolate_g": 12},
    "View": {"coffee_g": 9, "water_ml": 75, "sugar_g": 2},
}
_R = ", ".join(f"('{p}', '{i}', {float(q)})" for p, r in RECIPES.items() for i, q in r.items())
_C = ", ".join(f"('{i}', {c})" for i, c in UNIT_COSTS.items())
SUPPLY = f"""{NAMED}, rec(product, ingredient, qty) AS (VALUES {_R}), cost(ingredient, unit_cost) AS (VALUES {_C}),
 price AS (SELECT upper(product[1]) || product[2:] AS product, CASE WHEN product = 'signup' THEN 0.0 ELSE arg_max(amount, datetime) END AS unit_price FROM tx GROUP BY tx.product),
 dem AS (SELECT product, SUM(forecast) AS revenue FROM pf GROUP BY 1),
 det AS (SELECT d.product, ROUND(d.revenue / p.unit_price, 2) AS units, r.ingredient, ROUND(d.revenue / p.unit_price * r.qty, 2) AS quantity,
 COALESCE(CAST(c.unit_cost AS DOUBLE), 0.0) AS unit_cost, ROUND(d.revenue / p.unit_price * r.qty * COALESCE(CAST(c.unit_cost AS DOUBLE), 0.0), 2) AS total_cost, d.revenue
 FROM dem d JOIN price p ON p.product = d.product AND p.unit_price > 0 JOIN rec r ON r.product = d.product LEFT JOIN cost c ON c.ingredient = r.ingredient)"""


def needs(spark, sf):
    df = sales(spark, sf)
    prices = supply.last_prices(df).withColumn(
        "unit_price", F.when(F.col("product") == "Signup", 0.0).otherwise(F.col("unit_price")))
    return supply.supply_detail(kpi.product_forecasts(df), prices, supply.recipe_table(spark, RECIPES),
                                supply.cost_table(spark, UNIT_COSTS))


@query("supply_detail", f"WITH {SUPPLY} " + shown("product ingredient", "units quantity unit_cost total_cost", "det", money="revenue"))
def _(spark, sf):
    return plain(needs(spark, sf), money=["revenue"])


@query("supply_summary", f"WITH {SUPPLY}, r AS (SELECT ingredient, SUM(quantity) AS quantity, SUM(total_cost) AS total_cost FROM det GROUP BY 1) "
       + shown("ingredient", "quantity total_cost", "r", 2))
def _(spark, sf):
    return plain(supply.supply_summary(needs(spark, sf)), digits=2)


@query("finance_summary", f"""WITH {SUPPLY}, e AS (SELECT product, SUM(total_cost) AS c, MAX(revenue) AS r FROM det GROUP BY 1),
 t AS (SELECT SUM(c) AS c, SUM(r) AS r FROM e) SELECT ROUND(c, 2) AS total_cost, ROUND(r, 2) AS revenue, ROUND(r - c, 2) AS profit,
 ROUND((r - c) / r * 100, 2) AS gross_margin_pct, ROUND(c, 2) AS break_even_revenue FROM t""")
def _(spark, sf):
    return plain(supply.finance_summary(needs(spark, sf)), digits=2)
