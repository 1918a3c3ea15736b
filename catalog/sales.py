"""Queries over raw transactions: cleaning, grids, exploratory summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import TX, panel, plain, query, sales, shown, table
from demandcast.functions.columns import safe_name, season, shorten
from demandcast.operators import clean, eda, grid, rollup
from demandcast.operators.features import add_time_features
from demandcast.operators.supply import last_prices


def dirty_sales(spark, sf):
    """Sales as text with bad numbers, bad times and exact duplicates, derived row by row."""
    e = table(spark, sf, "events")
    k = F.col("event_id")
    text = e.select(
        "event_id", F.col("event_type").alias("product"),
        F.when(k % 10 == 3, " 12,5").when(k % 10 == 7, "abc").when(k % 10 == 9, "").otherwise(
            F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" "))).alias("amount"),
        F.when(k % 11 == 0, "not a time").otherwise(F.col("ts").cast("string")).alias("datetime"),
        F.col("user_id").cast("string").alias("card"))
    return text.unionByName(text.where(k % 5 == 0))


DIRTY = """ev AS (SELECT event_id, event_type AS product,
 CASE WHEN event_id % 10 IN (3, 7, 9) THEN NULL ELSE value END AS amount,
 CASE WHEN event_id % 11 = 0 THEN NULL ELSE ts END AS datetime, user_id FROM events),
 dirty AS (SELECT * FROM ev UNION ALL SELECT * FROM ev WHERE event_id % 5 = 0)"""


def typed_sales(spark, sf):
    df = clean.standardise_types(dirty_sales(spark, sf), ["product", "card"], ["amount"])
    return clean.coerce_datetime(df)


@query("coerce_types", f"WITH {DIRTY} " + shown("event_id product", "amount", "dirty", dates="datetime"))
def _(spark, sf):
    return plain(typed_sales(spark, sf).drop("card"))


@query("clean_transactions", f"WITH {DIRTY}, ok AS (SELECT DISTINCT * FROM dirty WHERE amount >= 0 AND datetime IS NOT NULL) "
       + shown("event_id product", "amount", "ok", dates="datetime"))
def _(spark, sf):
    df = clean.drop_exact_duplicates(typed_sales(spark, sf))
    return plain(clean.valid_sales(clean.drop_missing_time(df)))


@query("duplicate_rows", f"""WITH {DIRTY} SELECT COUNT(*) AS n_rows, (SELECT COUNT(*) FROM ev) AS distinct_rows,
 COUNT(*) - (SELECT COUNT(*) FROM ev) AS duplicates FROM dirty""")
def _(spark, sf):
    return clean.count_exact_duplicates(typed_sales(spark, sf))


@query("duplicate_keys", """SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def _(spark, sf):
    return eda.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("missing_report", f"""WITH {DIRTY}, c AS (SELECT COUNT(*) AS n, COUNT(*) - COUNT(amount) AS a,
 COUNT(*) - COUNT(datetime) AS d FROM dirty)
 SELECT 'amount' AS "column", a AS missing_count, ROUND(100.0 * a / n, 6) AS missing_pct FROM c
 UNION ALL SELECT 'datetime', d, ROUND(100.0 * d / n, 6) FROM c
 UNION ALL SELECT 'event_id', 0, 0.0 FROM c UNION ALL SELECT 'product', 0, 0.0 FROM c""")
def _(spark, sf):
    return plain(eda.missing_report(typed_sales(spark, sf).drop("card")))


@query("reverse_one_hot", """SELECT event_id, CASE WHEN event_id % 7 = 0 OR event_type NOT IN ('click', 'error', 'view')
 THEN 'click' WHEN event_id % 13 = 0 AND event_type = 'view' THEN 'error' ELSE event_type END AS product FROM events""")
def _(spark, sf):
    k, e = F.col("event_id"), F.col("event_type")
    on = k % 7 != 0
    hot = table(spark, sf, "events").select(
        "event_id", (on & (e == "click")).alias("product_click"),
        (on & ((e == "error") | ((k % 13 == 0) & (e == "view")))).alias("product_error"),
        (on & (e == "view")).alias("product_view"))
    return clean.reverse_one_hot(hot, drop=True)


@query("time_features", """SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
 CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS dow,
 CAST(week(ts) AS INTEGER) AS week, ROUND(SIN(2 * PI() * month(ts) / 12), 6) + 0.0 AS month_sin,
 ROUND(COS(2 * PI() * month(ts) / 12), 6) + 0.0 AS month_cos, ROUND(SIN(2 * PI() * hour(ts) / 24), 6) + 0.0 AS hour_sin,
 ROUND(COS(2 * PI() * hour(ts) / 24), 6) + 0.0 AS hour_cos FROM events""")
def _(spark, sf):
    df = add_time_features(sales(spark, sf)).drop("datetime", "product", "amount", "payment", "card")
    return plain(df)


@query("dashboard_slice", f"""WITH {TX} SELECT event_id, product, ROUND(amount, 6) AS amount,
 CAST(datetime AS VARCHAR) AS datetime FROM tx
 WHERE datetime >= TIMESTAMP '2024-01-05 00:00:00' AND datetime <= TIMESTAMP '2024-01-25 12:00:00'
 AND product = 'click' AND isodow(datetime) IN (1, 3, 6) AND hour(datetime) BETWEEN 8 AND 18""")
def _(spark, sf):
    df = clean.weekday_name(sales(spark, sf), "datetime").withColumn("hour", F.hour("datetime"))
    part = clean.slice_sales(df, "2024-01-05 00:00:00", "2024-01-25 12:00:00", "click",
                             ["Lunes", "Miércoles", "Sábado"], (8, 18))
    return plain(part.select("event_id", "product", "amount", "datetime"))


@query("weekday_names", f"""WITH {TX} SELECT event_id, CASE isodow(datetime) WHEN 1 THEN 'Lunes' WHEN 2 THEN 'Martes'
 WHEN 3 THEN 'Miércoles' WHEN 4 THEN 'Jueves' WHEN 5 THEN 'Viernes' WHEN 6 THEN 'Sábado' ELSE 'Domingo' END AS weekday FROM tx""")
def _(spark, sf):
    return clean.weekday_name(sales(spark, sf), "datetime").select("event_id", "weekday")


@query("normalised_names", """WITH n AS (SELECT p_partkey, regexp_replace(trim(lower(p_name)), '\\s+', ' ', 'g') AS s FROM part)
 SELECT p_partkey, array_to_string(list_transform(string_split(s, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS product FROM n""")
def _(spark, sf):
    messy = table(spark, sf, "part").select(
        "p_partkey", F.concat(F.lit("  "), F.upper(F.replace("p_name", F.lit(" "), F.lit("   "))), F.lit(" ")).alias("product"))
    return clean.normalise_names(messy)


@query("label_texts", """SELECT c_custkey, regexp_replace(c_name || '/' || c_mktsegment, '[^A-Za-z0-9_-]', '_', 'g') AS safe,
 CASE WHEN length(c_mktsegment || ' segment customer') <= 20 THEN c_mktsegment || ' segment customer'
 ELSE c_mktsegment || ' segment…' END AS short FROM customer""")
def _(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", safe_name(F.concat_ws("/", "c_name", "c_mktsegment")).alias("safe"),
                    shorten(F.concat("c_mktsegment", F.lit(" segment customer")), 20).alias("short"))


@query("season_flags", """SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter'
 WHEN month(o_orderdate) IN (3, 4, 5) THEN 'spring' WHEN month(o_orderdate) IN (6, 7, 8) THEN 'summer'
 ELSE 'autumn' END AS season, isodow(o_orderdate) >= 6 AS is_weekend FROM orders""")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", season(F.month("o_orderdate")).alias("season"),
                                             (F.weekday("o_orderdate") >= 5).alias("is_weekend"))


# --- grids --------------------------------------------------------------------------------

def grid_sql(step: str, category: str | None = None) -> str:
    cat, on, by = (f", {category}", f" AND a.{category} = g.{category}", ", 2") if category else ("", "", "")
    cats = f", cats AS (SELECT DISTINCT {category} FROM tx WHERE {category} IS NOT NULL)" if category else ""
    cross = ", cats" if category else ""
    gcat = f", g.{category}" if category else ""
    return f"""WITH {TX}, a AS (SELECT date_trunc('{step}', datetime) AS datetime{cat}, SUM(amount) AS amount,
 COUNT(*) AS transactions FROM tx GROUP BY 1{by}),
 lim AS (SELECT date_trunc('{step}', MIN(datetime)) AS lo, CASE WHEN date_trunc('{step}', MAX(datetime)) = MAX(datetime)
 THEN MAX(datetime) ELSE date_trunc('{step}', MAX(datetime)) + INTERVAL 1 {step} END AS hi FROM tx),
 t AS (SELECT UNNEST(generate_series(lo, hi, INTERVAL 1 {step})) AS datetime FROM lim){cats},
 g AS (SELECT t.datetime{cat} FROM t{cross}),
 r AS (SELECT CAST(g.datetime AS TIMESTAMP) AS datetime{gcat}, COALESCE(a.amount, 0.0) AS amount, COALESCE(a.transactions, 0) AS transactions
 FROM g LEFT JOIN a ON a.datetime = g.datetime{on}) """


@query("tx_hourly_grid", grid_sql("hour") + shown("transactions", "", "r", money="amount", dates="datetime"))
def _(spark, sf):
    return plain(rollup.aggregate_transactions(sales(spark, sf), "hour"), money=["amount"])


@query("tx_daily_grid", grid_sql("day") + shown("transactions", "", "r", money="amount", dates="datetime"))
def _(spark, sf):
    return plain(rollup.aggregate_transactions(sales(spark, sf), "day"), money=["amount"])


@query("tx_daily_by_product", grid_sql("day", "product") + shown("product transactions", "", "r", money="amount", dates="datetime"))
def _(spark, sf):
    return plain(rollup.aggregate_transactions(sales(spark, sf), "day", category="product"), money=["amount"])


@query("tx_daily_by_payment", grid_sql("day", "payment") + shown("payment transactions", "", "r", money="amount", dates="datetime"))
def _(spark, sf):
    return plain(rollup.aggregate_transactions(sales(spark, sf), "day", category="payment"), money=["amount"])


@query("canonical_grid", grid_sql("hour") + shown("", "", "r", dates="datetime"))
def _(spark, sf):
    return plain(grid.canonical_grid(sales(spark, sf), "hour"))


def order_sales(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("timestamp").alias("datetime"), F.col("o_orderpriority").alias("product"),
        F.col("o_totalprice").alias("amount"))


@query("weekly_revenue", """WITH a AS (SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS d, SUM(o_totalprice) AS v FROM orders GROUP BY 1),
 g AS (SELECT CAST(UNNEST(generate_series(MIN(d), MAX(d), INTERVAL 7 DAY)) AS DATE) AS d FROM a)
 SELECT CAST(g.d + 6 AS VARCHAR) AS period, ROUND(COALESCE(a.v, 0.0), 2) AS amount FROM g LEFT JOIN a ON a.d = g.d""")
def _(spark, sf):
    return plain(rollup.period_revenue(order_sales(spark, sf), "week"), money=["amount"])


@query("monthly_revenue", """WITH a AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS d, SUM(o_totalprice) AS v FROM orders GROUP BY 1),
 g AS (SELECT CAST(UNNEST(generate_series(MIN(d), MAX(d), INTERVAL 1 MONTH)) AS DATE) AS d FROM a)
 SELECT CAST(last_day(g.d) AS VARCHAR) AS period, ROUND(COALESCE(a.v, 0.0), 2) AS amount FROM g LEFT JOIN a ON a.d = g.d""")
def _(spark, sf):
    return plain(rollup.period_revenue(order_sales(spark, sf), "month"), money=["amount"])


DAILY = """d0 AS (SELECT product, CAST(datetime AS DATE) AS date, SUM(amount) AS v FROM tx GROUP BY 1, 2),
 dg AS (SELECT product, CAST(UNNEST(generate_series(MIN(date), MAX(date), INTERVAL 1 DAY)) AS DATE) AS date FROM d0 GROUP BY 1),
 daily AS (SELECT dg.product, dg.date, COALESCE(d0.v, 0.0) AS amount FROM dg LEFT JOIN d0 ON d0.product = dg.product AND d0.date = dg.date)"""

TOTAL = """t0 AS (SELECT CAST(datetime AS DATE) AS date, SUM(amount) AS v FROM tx GROUP BY 1),
 tg AS (SELECT CAST(UNNEST(generate_series(MIN(date), MAX(date), INTERVAL 1 DAY)) AS DATE) AS date FROM t0),
 total AS (SELECT tg.date, COALESCE(t0.v, 0.0) AS amount FROM tg LEFT JOIN t0 ON t0.date = tg.date)"""


@query("daily_by_product", f"WITH {TX}, {DAILY} " + shown("product", "", "daily", money="amount", dates="date"))
def _(spark, sf):
    return plain(rollup.daily_series(sales(spark, sf)), money=["amount"])


@query("daily_calendar_series", f"WITH {TX}, {TOTAL} " + shown("", "", "total", money="amount", dates="date"))
def _(spark, sf):
    return plain(rollup.daily_series(sales(spark, sf), ()), money=["amount"])


FEATURES6 = f"""WITH {TX}, b AS (SELECT product, CAST(datetime AS DATE) AS date, SUM(amount) AS revenue, CAST(COUNT(*) AS DOUBLE) AS transactions,
 AVG(amount) AS avg_price, CAST(MIN(hour(datetime)) AS DOUBLE) AS first_sale_hour, CAST(MAX(hour(datetime)) AS DOUBLE) AS last_sale_hour,
 AVG(hour(datetime)) AS avg_sale_hour FROM tx GROUP BY 1, 2),
 r AS (SELECT *, SUM(transactions) OVER (PARTITION BY date) AS total_daily_transactions,
 SUM(revenue) OVER (PARTITION BY date) AS total_daily_revenue,
 transactions / SUM(transactions) OVER (PARTITION BY date) AS market_share_transactions FROM b) """


@query("daily_product_features", FEATURES6 + shown(
    "product", "transactions avg_price first_sale_hour last_sale_hour avg_sale_hour total_daily_transactions market_share_transactions",
    "r", money="revenue total_daily_revenue", dates="date"))
def _(spark, sf):
    return plain(rollup.daily_product_features(sales(spark, sf)), money=["revenue", "total_daily_revenue"])


@query("daily_time_of_day", FEATURES6 + """SELECT product, CAST(date AS VARCHAR) AS date, CAST(FLOOR(avg_sale_hour) AS INTEGER) AS hour,
 CAST(CAST(date AS TIMESTAMP) + FLOOR(avg_sale_hour) * INTERVAL 1 HOUR AS VARCHAR) AS datetime, 12 AS noon_hour FROM r""")
def _(spark, sf):
    df = rollup.daily_product_features(sales(spark, sf)).select("product", "date", "avg_sale_hour")
    df = clean.attach_time_of_day(df, out="noon").withColumnRenamed("hour", "noon_hour")
    return plain(clean.attach_time_of_day(df, hour="avg_sale_hour").drop("avg_sale_hour", "noon"))


# --- exploratory summaries ----------------------------------------------------------------

def matrix_sql(agg: str) -> str:
    cells = ", ".join(f"ROUND({agg}(amount) FILTER (hr = {h}), 4) AS h{h}" for h in range(24))
    return grid_sql("hour") + f""", z AS (SELECT isodow(datetime) - 1 AS dow, hour(datetime) AS hr, amount FROM r),
 w AS (SELECT CAST(UNNEST(generate_series(0, 6)) AS INTEGER) AS dow)
 SELECT w.dow, {cells} FROM w LEFT JOIN z ON z.dow = w.dow GROUP BY 1"""


for _how, _fn in (("sum", "SUM"), ("mean", "AVG"), ("median", "MEDIAN")):
    def _matrix(spark, sf, how=_how):
        hourly = rollup.aggregate_transactions(sales(spark, sf), "hour")
        return plain(eda.weekday_hour_matrix(hourly, how), digits=4)
    query(f"weekday_hour_{_how}", matrix_sql(_fn))(_matrix)


@query("heatmap_limits", grid_sql("hour") + """, c AS (SELECT isodow(datetime) AS d, hour(datetime) AS hr, SUM(amount) AS v FROM r GROUP BY 1, 2),
 p AS (SELECT quantile_cont(v, 0.05) AS a, quantile_cont(v, 0.95) AS b, MIN(v) AS mn, MAX(v) AS mx FROM c)
 SELECT ROUND(CASE WHEN a >= b THEN mn ELSE a END, 4) AS vmin, ROUND(CASE WHEN a >= b THEN mx ELSE b END, 4) AS vmax FROM p""")
def _(spark, sf):
    hourly = rollup.aggregate_transactions(sales(spark, sf), "hour")
    return plain(eda.robust_limits(eda.weekday_hour_matrix(hourly)), digits=4)


@query("chart_limits", grid_sql("day") + """SELECT ROUND(quantile_cont(amount, 0.95) * 1.2, 4) AS ymax FROM r""")
def _(spark, sf):
    return plain(eda.chart_top(rollup.aggregate_transactions(sales(spark, sf), "day"), ["amount"], 0.95, 1.2), digits=4)


def profile_sql(error: str) -> str:
    return f"""WITH {TX}, d AS (SELECT CAST(datetime AS DATE) AS day, SUM(amount) AS v FROM tx GROUP BY 1),
 s AS (SELECT isodow(day) - 1 AS dow, AVG(v) AS mean, COUNT(v) AS n, COALESCE(STDDEV_SAMP(v), 0.0) AS std FROM d GROUP BY 1),
 w AS (SELECT CAST(UNNEST(generate_series(0, 6)) AS INTEGER) AS dow)
 SELECT w.dow, ROUND(mean, 4) AS mean, COALESCE(n, 0) AS n, ROUND(COALESCE(std, 0.0), 4) AS std,
 ROUND(COALESCE({error}, 0.0), 4) AS error FROM w LEFT JOIN s ON s.dow = w.dow"""


for _mode, _err in (("ci95", "1.96 * std / SQRT(n)"), ("sem", "std / SQRT(n)"), ("std", "std")):
    def _profile(spark, sf, mode=_mode):
        return plain(eda.weekday_profile(sales(spark, sf), mode), digits=4)
    query(f"weekday_profile_{_mode}", profile_sql(_err))(_profile)

_DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


@query("presence_matrix", f"WITH {TX} SELECT product, " + ", ".join(
    f"COUNT(amount) FILTER (isodow(datetime) = {i + 1}) AS {d}" for i, d in enumerate(_DAYS)) + " FROM tx GROUP BY 1")
def _(spark, sf):
    return eda.presence_matrix(sales(spark, sf))


@query("product_hour_matrix", f"WITH {TX} SELECT product, " + ", ".join(
    f"ROUND(COALESCE(SUM(amount) FILTER (hour(datetime) = {h}), 0.0), 2) AS h{h}" for h in range(24)) + " FROM tx GROUP BY 1")
def _(spark, sf):
    return plain(eda.product_hour_matrix(sales(spark, sf)), digits=2)


@query("sales_composition", f"WITH {TX} SELECT product, ROUND(SUM(amount), 2) AS amount FROM tx GROUP BY 1")
def _(spark, sf):
    return plain(eda.sales_composition(sales(spark, sf)), money=["amount"])


@query("amount_box", f"""WITH {TX}, q AS (SELECT quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.5) AS median,
 quantile_cont(amount, 0.75) AS q3 FROM tx) SELECT ROUND(q1, 6) AS q1, ROUND(median, 6) AS median, ROUND(q3, 6) AS q3,
 ROUND(q3 - q1, 6) AS iqr, ROUND(q1 - 1.5 * (q3 - q1), 6) AS low_fence, ROUND(q3 + 1.5 * (q3 - q1), 6) AS high_fence FROM q""")
def _(spark, sf):
    return plain(eda.box_summary(sales(spark, sf)))


@query("amount_hist", f"""WITH {TX}, lim AS (SELECT MIN(amount) AS lo, MAX(amount) AS hi FROM tx),
 b AS (SELECT LEAST(CAST(FLOOR((amount - lo) / (hi - lo) * 30) AS INTEGER) + 1, 30) AS bin, COUNT(*) AS n FROM tx, lim GROUP BY 1),
 s AS (SELECT CAST(UNNEST(generate_series(1, 30)) AS INTEGER) AS bin)
 SELECT s.bin, ROUND(lo + (hi - lo) / 30 * (s.bin - 1), 6) AS bin_lo, ROUND(lo + (hi - lo) / 30 * s.bin, 6) AS bin_hi,
 COALESCE(b.n, 0) AS n FROM s CROSS JOIN lim LEFT JOIN b ON b.bin = s.bin""")
def _(spark, sf):
    return plain(eda.histogram(sales(spark, sf)))


@query("cumulative_revenue", f"""WITH {TX} SELECT event_id, ROUND(SUM(amount) OVER (ORDER BY datetime, event_id
 ROWS UNBOUNDED PRECEDING), 2) AS cumulative_revenue FROM tx""")
def _(spark, sf):
    out = eda.cumulative_revenue(sales(spark, sf).select("event_id", "datetime", "amount"), ("datetime", "event_id"))
    return plain(out.select("event_id", "cumulative_revenue"), money=["cumulative_revenue"])


def part_sales(spark, sf):
    return table(spark, sf, "lineitem").select(F.col("l_partkey").alias("product"), F.col("l_extendedprice").alias("amount"))


PARETO = """g AS (SELECT l_partkey AS product, SUM(l_extendedprice) AS amount FROM lineitem GROUP BY 1),
 r AS (SELECT product, amount, ROW_NUMBER() OVER (ORDER BY ROUND(amount, 2) DESC, product) AS rank, amount / SUM(amount) OVER () AS share,
 SUM(amount) OVER (ORDER BY ROUND(amount, 2) DESC, product ROWS UNBOUNDED PRECEDING) / SUM(amount) OVER () AS cum_share FROM g)"""


@query("pareto_products", f"WITH {PARETO} " + shown("product rank", "share cum_share", "r", money="amount"))
def _(spark, sf):
    return plain(eda.pareto_full(part_sales(spark, sf)), money=["amount"])


@query("pareto_k", f"WITH {PARETO} SELECT CAST(COUNT(*) FILTER (cum_share < 0.8) + 1 AS INTEGER) AS k FROM r")
def _(spark, sf):
    return eda.pareto_count(eda.pareto_full(part_sales(spark, sf)))


@query("pareto_top", """WITH g AS (SELECT l_partkey AS product, SUM(l_extendedprice) AS amount FROM lineitem GROUP BY 1
 ORDER BY 2 DESC, 1 LIMIT 12), r AS (SELECT product, amount, ROW_NUMBER() OVER w AS rank, amount / SUM(amount) OVER () AS share,
 SUM(amount) OVER (w ROWS UNBOUNDED PRECEDING) / SUM(amount) OVER () AS cum_share FROM g WINDOW w AS (ORDER BY amount DESC, product)) """
       + shown("product rank", "share cum_share", "r", money="amount"))
def _(spark, sf):
    return plain(eda.pareto_top(part_sales(spark, sf), 12), money=["amount"])


@query("top_products", f"WITH {TX}, r AS (SELECT product, SUM(amount) AS amount FROM tx GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3) "
       + shown("product", "", "r", money="amount"))
def _(spark, sf):
    return plain(eda.top_products(sales(spark, sf), 3), money=["amount"])


@query("hourly_rolling", grid_sql("hour") + """, s AS (SELECT datetime, amount,
 CASE WHEN COUNT(amount) OVER a >= 8 THEN AVG(amount) OVER a END AS roll_24,
 CASE WHEN COUNT(amount) OVER b >= 56 THEN AVG(amount) OVER b END AS roll_168, transactions FROM r
 WINDOW a AS (ORDER BY datetime ROWS 23 PRECEDING), b AS (ORDER BY datetime ROWS 167 PRECEDING)) """
       + shown("transactions", "roll_24 roll_168", "s", money="amount", dates="datetime"))
def _(spark, sf):
    return plain(eda.smoothed_hourly(rollup.aggregate_transactions(sales(spark, sf), "hour")), money=["amount"])


@query("daily_rolling", grid_sql("day") + """, s AS (SELECT datetime, amount, AVG(amount) OVER (ORDER BY datetime ROWS 6 PRECEDING) AS amount_roll,
 transactions FROM r) """ + shown("transactions", "amount_roll", "s", money="amount", dates="datetime"))
def _(spark, sf):
    return plain(eda.smoothed_daily(rollup.aggregate_transactions(sales(spark, sf), "day")), money=["amount"])


@query("clip_p99", grid_sql("hour") + """, s AS (SELECT datetime, LEAST(amount, (SELECT quantile_cont(amount, 0.99) FROM r)) AS amount,
 transactions FROM r) """ + shown("transactions", "amount", "s", 4, dates="datetime"))
def _(spark, sf):
    return plain(clean.clip_series(rollup.aggregate_transactions(sales(spark, sf), "hour"), "amount"), digits=4)


SHARES = f"""WITH {TX}, g AS (SELECT CAST(datetime AS DATE) AS date, product, SUM(amount) AS v FROM tx GROUP BY 1, 2),
 d AS (SELECT date, SUM(v) AS tot FROM g GROUP BY 1),
 top AS (SELECT product FROM tx GROUP BY 1 ORDER BY SUM(amount) DESC, 1 LIMIT 3),
 c AS (SELECT d.date, top.product, COALESCE(g.v, 0.0) / NULLIF(d.tot, 0) AS share FROM d CROSS JOIN top
 LEFT JOIN g ON g.date = d.date AND g.product = top.product),
 r AS (SELECT date, product, share, CASE WHEN COUNT(share) OVER w >= 2 THEN AVG(share) OVER w END AS share_smooth FROM c
 WINDOW w AS (PARTITION BY product ORDER BY date ROWS 6 PRECEDING)) """


@query("product_share_smoothed", SHARES + shown("product", "share share_smooth", "r", dates="date"))
def _(spark, sf):
    return plain(eda.product_shares(sales(spark, sf), 3))


@query("share_summary", SHARES + """SELECT product, ROUND(AVG(share), 6) AS mean_share,
 ROUND(LEAST(GREATEST(quantile_cont(share_smooth, 0.97) * 1.15, 0.15), 1.0), 6) AS upper,
 ROUND(arg_max(share_smooth, date) FILTER (share_smooth IS NOT NULL), 6) AS last_share FROM r GROUP BY 1""")
def _(spark, sf):
    return plain(eda.share_summary(eda.product_shares(sales(spark, sf), 3)))


@query("distinct_counts", f"""WITH {TX} SELECT 'product' AS "column", COUNT(DISTINCT product) AS n_distinct FROM tx
 UNION ALL SELECT 'payment', COUNT(DISTINCT payment) FROM tx UNION ALL SELECT 'event_id', COUNT(DISTINCT event_id) FROM tx""")
def _(spark, sf):
    return eda.distinct_counts(sales(spark, sf), ["product", "payment", "event_id"])


@query("filter_options", f"WITH {TX} SELECT DISTINCT product FROM tx")
def _(spark, sf):
    return eda.filter_options(sales(spark, sf), "product")


@query("slider_bounds", f"""WITH {TX} SELECT CAST(MIN(datetime) AS VARCHAR) AS first_time, CAST(MAX(datetime) AS VARCHAR) AS last_time,
 CAST(GREATEST(MIN(hour(datetime)), 6) AS INTEGER) AS first_hour, CAST(LEAST(MAX(hour(datetime)), 22) AS INTEGER) AS last_hour FROM tx""")
def _(spark, sf):
    return plain(eda.slider_bounds(sales(spark, sf), hour_limits=(6, 22)))


@query("last_price", f"""WITH {TX} SELECT upper(product[1]) || product[2:] AS product, ROUND(arg_max(amount, datetime), 6) AS unit_price
 FROM tx WHERE amount IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    return plain(last_prices(sales(spark, sf)))


@query("snapshot_counts", """SELECT COUNT(*) AS n_rows, COUNT(DISTINCT product) AS n_products, COUNT(DISTINCT date) AS n_days
 FROM (SELECT p_type AS product, CAST(l_shipdate AS DATE) AS date FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)""")
def _(spark, sf):
    return eda.snapshot_counts(panel(spark, sf))
