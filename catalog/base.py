"""Query registry and the bindings of the given tables to the canonical frames.

Every entry pairs a Spark query with the SQL an independent engine runs on the same tables.
Results travel as plain values: dates and times as text, doubles rounded.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


NUDGE = "1e-9"


def _nudged(sql: str) -> str:
    """Add a tiny constant inside every ROUND to more than two digits.

    Means of cent amounts often end exactly on a rounding tie, where the last bit of the sum
    decides; shifting both engines by the same amount takes the tie away. Money sums are
    rounded to cents, which they already are.
    """
    out, at = "", 0
    while (start := sql.find("ROUND(", at)) >= 0:
        depth, comma, end = 0, -1, start + 5
        for end in range(start + 5, len(sql)):
            depth += (sql[end] == "(") - (sql[end] == ")")
            if depth == 1 and sql[end] == ",":
                comma = end
            if depth == 0:
                break
        inner = _nudged(sql[start + 6:comma])
        more = f" + {NUDGE}" if int(sql[comma + 1:end]) > 2 else ""
        out += sql[at:start] + f"ROUND({inner}{more}{sql[comma:end + 1]}"
        at = end + 1
    return out + sql[at:]


def query(name: str, sql: str | None = None):
    """Register a Spark query, with its SQL twin when SQL can express it."""
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = _nudged(" ".join(sql.split()))
        return fn
    return register


def plain(df: DataFrame, digits: int = 6, money: Sequence[str] = ()) -> DataFrame:
    """Dates and times as text, doubles rounded (money to cents)."""
    cols = []
    for f in df.schema.fields:
        c = f"`{f.name}`"
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = f"CAST({c} AS STRING)"
        elif isinstance(f.dataType, T.DoubleType):
            # Adding zero turns -0.0 into 0.0.
            places = 2 if f.name in money else digits
            c = f"round({c}{f' + {NUDGE}D' if places > 2 else ''}, {places}) + 0D"
        cols.append(f"{c} AS `{f.name}`")
    return df.selectExpr(*cols)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


# --- canonical frames ---------------------------------------------------------------------

def sales(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("datetime"), F.col("event_type").alias("product"),
        F.col("value").alias("amount"),
        F.when(F.col("user_id") % 2 == 0, "card").otherwise("cash").alias("payment"),
        F.col("user_id").cast("string").alias("card"))


def panel(spark: SparkSession, sf: str, by: str = "p_type") -> DataFrame:
    """Daily panel of line items per part attribute.

    The join carries two columns of ``part``; whether it is broadcast is left to its size.
    """
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    parts = table(spark, sf, "part").select("p_partkey", "p_type", "p_brand")
    keys = {"p_type": F.col("p_type"), "brand_type": F.concat_ws("/", "p_brand", "p_type"),
            "supplier": F.col("l_suppkey").cast("string")}
    joined = lines if by == "supplier" else lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy(keys[by].alias("product"), F.to_date("l_shipdate").alias("date")).agg(
        F.count(F.lit(1)).cast("double").alias("y"), F.sum("l_extendedprice").alias("revenue"))


def exog(spark: SparkSession, sf: str) -> DataFrame:
    from demandcast.operators.rollup import daily_exogenous

    orders = table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("x1"), F.col("o_totalprice").alias("x2"),
        F.col("o_custkey").cast("double").alias("x3"), (F.col("o_orderstatus") == "P").alias("is_holiday"))
    return daily_exogenous(orders, {"x1": "mean", "x2": "sum", "x3": "mean", "absent": "sum"})


def holiday_days(spark: SparkSession, sf: str) -> DataFrame:
    """Days marked as holidays: those whose cheapest order is small (about one in seven)."""
    return table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.min("o_totalprice").alias("m")).where("m < 20000").select("date")


# --- SQL fragments ------------------------------------------------------------------------

TX = """tx AS (SELECT event_id, ts AS datetime, event_type AS product, value AS amount,
 CASE WHEN user_id % 2 = 0 THEN 'card' ELSE 'cash' END AS payment FROM events)"""

BASE = """base AS (SELECT p_type AS product, CAST(l_shipdate AS DATE) AS date, CAST(COUNT(*) AS DOUBLE) AS y,
 SUM(l_extendedprice) AS revenue FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""

PANEL = BASE + """, bounds AS (SELECT product, MIN(date) AS lo, MAX(date) AS hi FROM base GROUP BY 1),
 grid AS (SELECT product, CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds),
 panel AS (SELECT g.product, g.date, b.y, b.revenue FROM grid g LEFT JOIN base b ON b.product = g.product AND b.date = g.date)"""

PANEL0 = PANEL.replace("g.date, b.y,", "g.date, COALESCE(b.y, 0.0) AS y,")

EXOG = """ex AS (SELECT CAST(o_orderdate AS DATE) AS date, AVG(o_totalprice) AS x1, SUM(o_totalprice) AS x2,
 AVG(CAST(o_custkey AS DOUBLE)) AS x3, BOOL_OR(o_orderstatus = 'P') AS is_holiday FROM orders GROUP BY 1)"""

HOLIDAYS = """hol AS (SELECT CAST(o_orderdate AS DATE) AS date FROM orders GROUP BY 1 HAVING MIN(o_totalprice) < 20000)"""

ORIGINS = """days AS (SELECT DISTINCT date FROM panel),
 ranked AS (SELECT date, ROW_NUMBER() OVER (ORDER BY date) AS rk, COUNT(*) OVER () AS n FROM days),
 origins AS (SELECT CAST(4 - (n - rk + 1) / 7 + 1 AS INTEGER) AS origin_id, date - 1 AS train_end,
 date AS test_start, date + 6 AS test_end, CAST(rk - 1 AS INTEGER) AS n_train_days
 FROM ranked WHERE (n - rk + 1) % 7 = 0 AND n - rk + 1 <= 28)"""

BASELINES = ORIGINS + """, gated AS (SELECT * FROM origins WHERE n_train_days >= 150),
 hist AS (SELECT o.origin_id, p.product, p.date, p.y,
 ROW_NUMBER() OVER (PARTITION BY o.origin_id, p.product ORDER BY p.date DESC) AS back
 FROM panel p JOIN gated o ON p.date <= o.train_end),
 tails AS (SELECT origin_id, product, MAX(CASE WHEN back = 1 THEN y END) AS last_y, AVG(y) AS mean_y,
 COUNT(*) AS n FROM hist WHERE back <= 7 GROUP BY 1, 2),
 steps AS (SELECT UNNEST(generate_series(1, 7)) AS h),
 preds AS (
 SELECT t.origin_id, t.product, CAST(s.h AS INTEGER) AS h, 'naive1' AS model, t.last_y AS yhat FROM tails t, steps s
 UNION ALL SELECT t.origin_id, t.product, CAST(s.h AS INTEGER), 'ma7', t.mean_y FROM tails t, steps s
 UNION ALL SELECT t.origin_id, t.product, CAST(s.h AS INTEGER), 'snaive7',
 CASE WHEN t.n < 7 THEN t.last_y ELSE x.y END FROM tails t JOIN steps s ON TRUE
 LEFT JOIN hist x ON x.origin_id = t.origin_id AND x.product = t.product AND x.back = 8 - s.h),
 truth AS (SELECT o.origin_id, o.test_start, p.product, p.date, p.y FROM panel p
 JOIN gated o ON p.date BETWEEN o.test_start AND o.test_end),
 names AS (SELECT UNNEST(['naive1', 'snaive7', 'ma7']) AS model),
 fc AS (SELECT t.origin_id, t.date, t.product, r.h, t.y, r.yhat, m.model FROM truth t CROSS JOIN names m
 LEFT JOIN preds r ON r.origin_id = t.origin_id AND r.product = t.product AND r.model = m.model
 AND r.h = t.date - t.test_start + 1)"""


def metric_sql(*keys: str, src: str = "fc") -> str:
    """Metric columns grouped by ``keys``."""
    by = ", ".join(keys)
    return f"""SELECT {by},
 AVG(ABS(y - yhat)) AS MAE, SQRT(AVG((y - yhat) * (y - yhat))) AS RMSE,
 CASE WHEN COUNT(*) FILTER (ABS(y) > 1e-6 AND yhat IS NULL) = 0
 THEN 100 * AVG(ABS((y - yhat) / y)) FILTER (ABS(y) > 1e-6) END AS MAPE,
 CASE WHEN COUNT(y - yhat) = COUNT(*)
 THEN 100 * AVG(2 * ABS(y - yhat) / GREATEST(ABS(y) + ABS(yhat), 1e-6)) END AS sMAPE
 FROM {src} GROUP BY {by}"""


def shown(keys: str, rounded: str, src: str, digits: int = 6, money: str = "", dates: str = "") -> str:
    """Final projection: keys as they are, dates as text, doubles rounded."""
    out = [k for k in keys.split()]
    out += [f"CAST({d} AS VARCHAR) AS {d}" for d in dates.split()]
    out += [f"ROUND({c}, {digits}) + 0.0 AS {c}" for c in rounded.split()]
    out += [f"ROUND({c}, 2) + 0.0 AS {c}" for c in money.split()]
    return f"SELECT {', '.join(out)} FROM {src}"
