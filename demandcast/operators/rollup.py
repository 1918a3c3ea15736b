"""Transactions to hourly, daily, weekly, monthly and per-category series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandcast.functions.columns import ceil_time, col, floor_time
from demandcast.operators.grid import close_grid, complete_calendar, time_bounds
from demandcast.session import materialise

AGGREGATES = {
    "sum": F.sum, "mean": F.avg, "avg": F.avg, "max": F.max, "min": F.min,
    "median": F.median, "count": F.count, "std": F.stddev_samp,
}


def aggregate_transactions(df: DataFrame, step: str = "hour", time: str = "datetime", amount: str = "amount",
                           category: str | None = None, full_grid: bool = True,
                           include_ceil: bool = True) -> DataFrame:
    """Amount and transaction count per time bucket, and per category when one is given.

    ``full_grid`` spans floor(min)..ceil(max) of the whole table for every category, with
    empty cells 0; rows without a category then drop out.
    """
    timed = df.where(F.col(time).isNotNull())
    keys = [floor_time(time, step).alias("_bucket")] + ([col(category)] if category else [])
    sums = timed.groupBy(*keys).agg(
        F.coalesce(F.sum(amount), F.lit(0.0)).alias(amount),
        F.count(F.lit(1)).alias("transactions"),
        F.max(time).alias("_newest"),
    ).withColumnRenamed("_bucket", time)
    if not full_grid:
        return sums.drop("_newest")
    fill = {amount: 0.0, "transactions": 0}
    if category is None:
        # The first and the last bucket know the bounds, so no second scan is needed.
        end = ceil_time if include_ceil else floor_time
        return close_grid(sums, F.col(time), end("_newest", step), step, time, fill=fill)
    # A bucket's newest time floors to the bucket, so the sums know both bounds of the table.
    sums = materialise(sums)
    lo, hi = time_bounds(sums, "_newest", step, include_ceil)
    return close_grid(sums.where(col(category).isNotNull()), lo, hi, step, time, [category], fill)


def period_revenue(df: DataFrame, period: str = "week", time: str = "datetime", amount: str = "amount") -> DataFrame:
    """Revenue per week (labelled by its Sunday) or month (by its last day), gaps 0."""
    start = F.to_date(floor_time(time, period))
    sums = df.where(F.col(time).isNotNull()).groupBy(start.alias("_start")).agg(
        F.coalesce(F.sum(amount), F.lit(0.0)).alias(amount)
    )
    sums = sums.withColumnRenamed("_start", "period")
    sums = sums.withColumn("period", F.col("period").cast("timestamp"))
    full = close_grid(sums, F.col("period"), F.col("period"), period, "period", fill={amount: 0.0})
    day = F.to_date("period")
    return full.withColumn("period", F.date_add(day, 6) if period == "week" else F.last_day(day))


def daily_series(df: DataFrame, key: Sequence[str] = ("product",), time: str = "datetime",
                 amount: str = "amount") -> DataFrame:
    """Daily sums per series (or one total with ``key=()``), gaps 0 inside the own range."""
    sums = df.where(F.col(time).isNotNull()).groupBy(*[col(k) for k in key], F.to_date(time).alias("date")).agg(
        F.coalesce(F.sum(amount), F.lit(0.0)).alias(amount)
    )
    if key:
        return complete_calendar(sums, key, "date", {amount: 0.0})
    sums = sums.withColumn("date", F.col("date").cast("timestamp"))
    full = close_grid(sums, F.col("date"), F.col("date"), "day", "date", fill={amount: 0.0})
    return full.withColumn("date", F.to_date("date"))


def daily_product_features(df: DataFrame, time: str = "datetime", amount: str = "amount",
                           product: str = "product") -> DataFrame:
    """Transactions to the daily product panel: sales, hours of sale, day totals, share.

    Raw rows shrink to (product, day) in the map-side combine. That panel is written once,
    since it is read twice: for its rows and for the day totals, which have one row per
    calendar day and so a bounded broadcast.
    """
    base = df.groupBy(col(product), F.to_date(time).alias("date")).agg(
        F.coalesce(F.sum(amount), F.lit(0.0)).alias("revenue"),
        F.count(F.lit(1)).cast("double").alias("transactions"),
        F.avg(amount).alias("avg_price"),
        F.min(F.hour(time)).cast("double").alias("first_sale_hour"),
        F.max(F.hour(time)).cast("double").alias("last_sale_hour"),
        F.avg(F.hour(time)).alias("avg_sale_hour"),
    )
    return add_day_totals(materialise(base))


def add_day_totals(base: DataFrame) -> DataFrame:
    totals = base.groupBy("date").agg(
        F.sum("transactions").alias("total_daily_transactions"),
        F.sum("revenue").alias("total_daily_revenue"),
    )
    return base.join(F.broadcast(totals), "date", "left").withColumn(
        "market_share_transactions", F.try_divide("transactions", "total_daily_transactions"))


def daily_exogenous(df: DataFrame, spec: Mapping[str, str], holiday: str | None = "is_holiday",
                    date: str = "date") -> DataFrame | None:
    """Daily exogenous rollup by a ``column -> aggregate`` spec; absent columns are skipped.

    Returns None when nothing can be aggregated, so the caller skips the join.
    """
    aggs: list[Column] = [AGGREGATES[how](col(c)).alias(c) for c, how in spec.items() if c in df.columns]
    if holiday and holiday in df.columns:
        aggs.append(F.max(col(holiday)).alias(holiday))
    if date not in df.columns:
        raise ValueError(f"exogenous table needs a {date} column")
    return df.groupBy(F.to_date(date).alias(date)).agg(*aggs) if aggs else None


def daily_total(panel: DataFrame, y: str = "y", exog: Sequence[str] = (), date: str = "date") -> DataFrame:
    """All-series total per day with daily mean exogenous values: the final-model input."""
    return panel.groupBy(date).agg(
        F.coalesce(F.sum(y), F.lit(0.0)).alias(y), *[F.avg(col(c)).alias(c) for c in exog if c in panel.columns]
    )
