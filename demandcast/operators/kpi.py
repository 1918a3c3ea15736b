"""KPI row, forecast view and validation view over a filtered slice of sales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from demandcast.functions.columns import percent_change, title_name
from demandcast.operators.baselines import mean7_forecast
from demandcast.operators.metrics import panel_errors
from demandcast.operators.rollup import daily_series


def _all_days() -> WindowSpec:
    """The whole daily series, one row per calendar day."""
    return Window.partitionBy(F.lit(0))


def top_seller(df: DataFrame, product: str = "product", amount: str = "amount") -> DataFrame:
    """Product with the most revenue, the first by name on a tie (one row, or none)."""
    return df.groupBy(product).agg(F.coalesce(F.sum(amount), F.lit(0.0)).alias(amount)).orderBy(
        F.desc(amount), product).limit(1)


def kpi_row(df: DataFrame, time: str = "datetime", product: str = "product", amount: str = "amount") -> DataFrame:
    """Last-day revenue, change on the week and on the weekday's history, total, top seller.

    Sales shrink to one row per day before anything is compared; an empty slice gives one
    row of zeros and 'N/A'.
    """
    daily = df.groupBy(F.to_date(time).alias("d")).agg(F.coalesce(F.sum(amount), F.lit(0.0)).alias("v"))
    seen = daily.where(F.col("d").isNotNull()).withColumn("last", F.max("d").over(_all_days()))
    same_weekday = F.weekday("d") == F.weekday("last")
    sums = seen.agg(
        F.coalesce(F.sum(F.when(F.col("d") == F.col("last"), F.col("v"))), F.lit(0.0)).alias("revenue_last_day"),
        F.coalesce(F.sum(F.when(F.col("d") == F.date_sub("last", 7), F.col("v"))), F.lit(0.0)).alias("_week"),
        F.coalesce(F.avg(F.when(same_weekday, F.col("v"))), F.lit(0.0)).alias("_hist"),
        F.coalesce(F.sum("v"), F.lit(0.0)).alias("revenue_total"),
    )
    best = top_seller(df, product, amount).select(product).scalar()
    now, zero = F.col("revenue_last_day"), F.lit(0.0)
    return sums.select(
        "revenue_last_day", percent_change(now, F.col("_week"), zero).alias("week_change_pct"),
        percent_change(now, F.col("_hist"), zero).alias("history_change_pct"), "revenue_total",
        F.coalesce(best, F.lit("N/A")).alias("top_product"))


def product_forecasts(df: DataFrame, horizon: int = 7, time: str = "datetime", product: str = "product",
                      amount: str = "amount", same_start: bool = False) -> DataFrame:
    """7-day-mean forecast of each product's daily revenue, from its own last day on.

    ``same_start`` aligns every product on the last day of the whole slice instead.
    """
    # Names are normalised after the daily sums, so the text work runs per product and day.
    daily = df.groupBy(product, F.to_date(time).alias(time)).agg(F.sum(amount).alias(amount))
    named = daily.withColumn(product, title_name(product))
    start: Column | None = None
    if same_start:
        start = df.agg(F.to_date(F.max(time)).alias("d")).scalar()
    return mean7_forecast(daily_series(named, (product,), time, amount), horizon, amount, (product,), align_to=start)


def forecast_totals(forecasts: DataFrame) -> DataFrame:
    return forecasts.groupBy("date").agg(F.sum("forecast").alias("forecast"))


def actual_and_forecast(df: DataFrame, forecasts: DataFrame, time: str = "datetime", amount: str = "amount") -> DataFrame:
    """Daily actual total and forecast total side by side (outer, one row per day)."""
    real = daily_series(df, (), time, amount).withColumnRenamed(amount, "real")
    return real.join(forecast_totals(forecasts), "date", "full")


def forecast_change(df: DataFrame, forecasts: DataFrame, horizon: int = 7, time: str = "datetime",
                    amount: str = "amount") -> DataFrame:
    """Total forecast and its change against days -2H..-H of the actual total.

    With fewer than 2H days the base is everything but the last H days.
    """
    real = daily_series(df, (), time, amount).withColumns({
        "_back": F.row_number().over(_all_days().orderBy(F.desc("date"))), "_n": F.count(F.lit(1)).over(_all_days())})
    base = (F.col("_back") > horizon) & ((F.col("_n") < 2 * horizon) | (F.col("_back") <= 2 * horizon))
    previous = real.agg(F.sum(F.when(base, F.col(amount))).alias("v")).scalar()
    return forecasts.agg(F.sum("forecast").alias("total_forecast")).select(
        "total_forecast", previous.alias("previous_total")).withColumn(
        "change_pct", percent_change(F.col("total_forecast"), F.col("previous_total")))


def validation_view(df: DataFrame, horizon: int = 7, time: str = "datetime", product: str = "product",
                    amount: str = "amount", strict: bool = False) -> DataFrame:
    """The last H days, actual against forecast, matched by position.

    By default the forecast sees the whole slice, test days included, as the dashboard shows
    it; ``strict`` cuts the last H days off the history first. A slice of H days or fewer has
    no validation rows.
    """
    real = daily_series(df, (), time, amount).withColumns({
        "_back": F.row_number().over(_all_days().orderBy(F.desc("date"))), "_n": F.count(F.lit(1)).over(_all_days())})
    test = real.where((F.col("_back") <= horizon) & (F.col("_n") > horizon)).select(
        "date", F.col(amount).alias("real"), (F.lit(horizon + 1) - F.col("_back")).alias("_pos"))
    history = daily_series(df, (product,), time, amount)
    if strict:
        cut = real.agg(F.date_sub(F.max("date"), horizon).alias("d")).scalar()
        history = history.where(F.col("date") <= cut)
    totals = forecast_totals(mean7_forecast(history, horizon, amount, (product,)))
    ranked = totals.select("forecast", F.row_number().over(_all_days().orderBy("date")).alias("_pos"))
    return test.join(F.broadcast(ranked.where(F.col("_pos") <= horizon)), "_pos", "left").select(
        "date", "real", "forecast")


def validation_errors(view: DataFrame) -> DataFrame:
    return panel_errors(view)
