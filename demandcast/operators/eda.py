"""Exploratory summaries: matrices, profiles, distributions, Pareto, shares."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.constants import WEEKDAYS_EN
from demandcast.functions.columns import col
from demandcast.functions.ordered import exact_quantiles, running_total
from demandcast.operators.features import trailing_mean
from demandcast.operators.rollup import AGGREGATES
from demandcast.session import local_table, materialise


def _every(df: DataFrame, n: int, name: str) -> DataFrame:
    return df.sparkSession.range(n).select(F.col("id").cast("int").alias(name))


def weekday_hour_matrix(hourly: DataFrame, how: str = "sum", time: str = "datetime",
                        amount: str = "amount") -> DataFrame:
    """7 x 24 matrix of an hourly series; cells without data stay NULL.

    The input has one row per hour, so even the exact median of a cell holds at most one
    value per week.
    """
    fn = AGGREGATES.get(how, F.sum)
    known = hourly.where(F.col(amount).isNotNull()).withColumn("_hour", F.hour(time))
    wide = known.groupBy(F.weekday(time).alias("dow")).pivot("_hour", list(range(24))).agg(fn(amount))
    return _every(hourly, 7, "dow").join(F.broadcast(wide), "dow", "left").select(
        "dow", *[col(str(h)).alias(f"h{h}") for h in range(24)])


def robust_limits(matrix: DataFrame, lo: float = 0.05, hi: float = 0.95) -> DataFrame:
    """Colour limits of a matrix: two percentiles of its cells, min and max when they meet."""
    cells = [c for c in matrix.columns if c != "dow"]
    flat = matrix.select(F.explode(F.array(*[col(c).cast("double") for c in cells])).alias("v")).where(
        F.col("v").isNotNull())
    stats = flat.agg(F.percentile("v", F.array(F.lit(lo), F.lit(hi))).alias("p"),
                     F.min("v").alias("a"), F.max("v").alias("b"))
    flat_out = F.get("p", F.lit(0)) >= F.get("p", F.lit(1))
    return stats.select(F.when(flat_out, F.col("a")).otherwise(F.get("p", F.lit(0))).alias("vmin"),
                        F.when(flat_out, F.col("b")).otherwise(F.get("p", F.lit(1))).alias("vmax"))


def chart_top(df: DataFrame, columns: Sequence[str], q: float = 1.0, margin: float = 1.1) -> DataFrame:
    """Upper chart limit of a gridded series: a quantile over some columns times a margin."""
    flat = df.select(F.explode(F.array(*[col(c).cast("double") for c in columns])).alias("v"))
    top = F.max("v") if q >= 1 else F.percentile("v", F.lit(q))
    return flat.agg((top * margin).alias("ymax"))


def weekday_profile(df: DataFrame, mode: str = "ci95", time: str = "datetime", amount: str = "amount") -> DataFrame:
    """Mean, count and error bar of daily sums per weekday; days without sales do not count."""
    daily = df.groupBy(F.to_date(time).alias("_day")).agg(F.sum(amount).alias("_v"))
    std = F.coalesce(F.stddev_samp("_v"), F.lit(0.0))
    n = F.count("_v")
    error = {
        "std": std, "sem": F.try_divide(std, F.sqrt(n)), "none": F.lit(None).cast("double"),
    }.get(mode, F.try_divide(std * 1.96, F.sqrt(n)))
    stats = daily.where(F.col("_day").isNotNull()).groupBy(F.weekday("_day").alias("dow")).agg(
        F.avg("_v").alias("mean"), n.alias("n"), std.alias("std"), error.alias("error"))
    return _every(df, 7, "dow").join(F.broadcast(stats), "dow", "left").fillna(
        {"n": 0, "std": 0.0, **({} if mode == "none" else {"error": 0.0})})


def presence_matrix(df: DataFrame, time: str = "datetime", product: str = "product",
                    amount: str = "amount") -> DataFrame:
    """Sales count per product and weekday name, 0 where a product was never sold."""
    names = F.array(*[F.lit(n) for n in WEEKDAYS_EN])
    return df.where(F.col(time).isNotNull()).withColumn("_dow", F.get(names, F.weekday(time))).groupBy(
        product).pivot("_dow", list(WEEKDAYS_EN)).agg(F.count(amount)).fillna(0)


def product_hour_matrix(df: DataFrame, time: str = "datetime", product: str = "product",
                        amount: str = "amount") -> DataFrame:
    wide = df.withColumn("_hour", F.hour(time)).groupBy(product).pivot("_hour", list(range(24))).agg(
        F.sum(amount)).fillna(0.0)
    return wide.select(product, *[col(str(h)).alias(f"h{h}") for h in range(24)])


def sales_composition(df: DataFrame, product: str = "product", amount: str = "amount") -> DataFrame:
    return df.groupBy(product).agg(F.coalesce(F.sum(amount), F.lit(0.0)).alias(amount)).orderBy(amount, product)


def box_summary(df: DataFrame, value: str = "amount") -> DataFrame:
    """Quartiles, IQR and whisker limits of a raw column, exact at any row count."""
    q = exact_quantiles(df, value, (0.25, 0.5, 0.75))
    wide = q.agg(*[F.max(F.when(F.col("q") == p, F.col("value"))).alias(n)
                   for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    iqr = F.col("q3") - F.col("q1")
    return wide.withColumns({"iqr": iqr, "low_fence": F.col("q1") - 1.5 * iqr, "high_fence": F.col("q3") + 1.5 * iqr})


def histogram(df: DataFrame, value: str = "amount", bins: int = 30) -> DataFrame:
    """Equal-width bins over min..max, the last one closed on the right; empty bins kept."""
    ends = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    flat = F.col("lo") == F.col("hi")
    ends = ends.select(F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).cast("double").alias("lo"),
                       F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).cast("double").alias("hi"))
    ends = materialise(ends)
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    bin_no = F.least(F.width_bucket(F.col(value).cast("double"), lo, hi, F.lit(bins)), F.lit(bins))
    counts = df.where(F.col(value).isNotNull()).groupBy(bin_no.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    width = (hi - lo) / bins
    return _every(df, bins, "bin").withColumn("bin", F.col("bin") + 1).join(
        F.broadcast(counts), "bin", "left").select(
        "bin", (lo + width * (F.col("bin") - 1)).alias("bin_lo"), (lo + width * F.col("bin")).alias("bin_hi"),
        F.coalesce("n", F.lit(0)).alias("n"))


def missing_report(df: DataFrame) -> DataFrame:
    """Missing count and percent per column, most missing first, from one aggregate pass."""
    names = df.columns
    stats = df.agg(F.count(F.lit(1)).alias("_n"),
                   *[F.count_if(col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").alias("missing_count"),
                              (F.try_divide(F.lit(100.0) * F.col(f"_m{i}"), F.col("_n"))).alias("missing_pct"))
                     for i, c in enumerate(names)])
    return stats.select(F.inline(rows)).orderBy(F.desc("missing_pct"), "column")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values per column, one row each, from one scan; values are compared as text."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("_value")) for c in columns])
    found = df.select(F.inline(cells)).where("_value IS NOT NULL").distinct().groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
    names = local_table(df.sparkSession, [(c,) for c in columns], column=pa.string())
    return names.join(found, "column", "left").select("column", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"))


def filter_options(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values of a filter column."""
    return df.select(col(column)).where(col(column).isNotNull()).distinct().orderBy(column)


def slider_bounds(df: DataFrame, time: str = "datetime", hour_limits: tuple[int, int] | None = None) -> DataFrame:
    """First and last time and hour of a table; hours may be clamped to the opening times."""
    lo, hi = F.min(F.hour(time)), F.max(F.hour(time))
    if hour_limits:
        lo, hi = F.greatest(lo, F.lit(hour_limits[0])), F.least(hi, F.lit(hour_limits[1]))
    return df.agg(F.min(time).alias("first_time"), F.max(time).alias("last_time"),
                  lo.alias("first_hour"), hi.alias("last_hour"))


def snapshot_counts(panel: DataFrame, product: str = "product", date: str = "date") -> DataFrame:
    return panel.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(product).alias("n_products"),
                     F.count_distinct(date).alias("n_days"))


def top_products(df: DataFrame, n: int = 10, product: str = "product", amount: str = "amount") -> DataFrame:
    return df.groupBy(product).agg(F.sum(amount).alias(amount)).orderBy(F.desc_nulls_last(amount), product).limit(n)


def pareto_top(df: DataFrame, n: int = 10, product: str = "product", amount: str = "amount") -> DataFrame:
    """Top-n products with share and running share of the *kept* revenue (n rows in all)."""
    top = top_products(df, n, product, amount)
    everything = Window.partitionBy(F.lit(0))
    run = everything.orderBy(F.desc_nulls_last(amount), product).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum(amount).over(everything)
    return top.withColumns({"share": F.try_divide(F.col(amount), total),
                            "cum_share": F.try_divide(F.sum(amount).over(run), total),
                            "rank": F.row_number().over(run)})


def pareto_full(df: DataFrame, product: str = "product", amount: str = "amount") -> DataFrame:
    """Every product by revenue with its running share; products may be many, so the running
    sum is sliced."""
    sums = df.groupBy(product).agg(F.coalesce(F.sum(amount), F.lit(0.0)).alias(amount))
    run = running_total(sums, [F.desc(amount), F.asc(product)], {amount: "_cum"}, "rank", totals=True)
    return run.select(product, amount, "rank", F.try_divide(amount, "_cum_total").alias("share"),
                      F.try_divide("_cum", "_cum_total").alias("cum_share"))


def pareto_count(pareto: DataFrame, threshold: float = 0.8) -> DataFrame:
    """How many leading products reach the threshold."""
    return pareto.agg((F.count_if(F.col("cum_share") < threshold) + 1).cast("int").alias("k"))


def cumulative_revenue(df: DataFrame, order: Sequence[str] = ("datetime",), amount: str = "amount",
                       out: str = "cumulative_revenue") -> DataFrame:
    """Running revenue per transaction in time order; add a tie-break column to ``order``."""
    return running_total(df, [F.col(c) for c in order], {amount: out})


def smoothed_hourly(hourly: DataFrame, windows: Sequence[int] = (24, 168), time: str = "datetime",
                    amount: str = "amount", min_fraction: float = 1 / 3) -> DataFrame:
    """Trailing means of the hourly series (one row per hour) under the partial-window rule."""
    w = Window.partitionBy(F.lit(0)).orderBy(time)
    return hourly.withColumns({f"roll_{n}": trailing_mean(amount, max(2, n), w, min_fraction) for n in windows})


def smoothed_daily(daily: DataFrame, n: int = 7, time: str = "datetime", y: str = "amount",
                   key: Sequence[str] = ()) -> DataFrame:
    w = (Window.partitionBy(*key) if key else Window.partitionBy(F.lit(0))).orderBy(time)
    return daily.withColumn(f"{y}_roll", trailing_mean(y, n, w))


def product_shares(df: DataFrame, top_n: int = 6, smooth: int = 7, time: str = "datetime",
                   product: str = "product", amount: str = "amount") -> DataFrame:
    """Daily revenue share of the top products, raw and smoothed.

    Every day with sales carries a row for each top product, 0 when it sold none; a day
    total of 0 gives NULL. The product names reach the days as one array of ``top_n`` items.
    """
    daily = df.where(F.col(time).isNotNull()).groupBy(F.to_date(time).alias("date"), col(product)).agg(
        F.coalesce(F.sum(amount), F.lit(0.0)).alias("_v"))
    daily = materialise(daily)
    days = daily.groupBy("date").agg(F.sum("_v").alias("_total"))
    names = top_products(daily.where(col(product).isNotNull()), top_n, product, "_v").agg(
        F.collect_list(product).alias("p")).scalar()
    cells = days.withColumn(product, F.explode(names)).join(daily, ["date", product], "left")
    share = F.try_divide(F.coalesce("_v", F.lit(0.0)), F.nullif("_total", F.lit(0.0)))
    w = Window.partitionBy(product).orderBy("date")
    return cells.select("date", product, share.alias("share")).withColumn(
        "share_smooth", trailing_mean("share", smooth, w, 1 / 3) if smooth > 1 else F.col("share"))


def share_summary(shares: DataFrame, product: str = "product") -> DataFrame:
    """Per product: mean share, chart limit (p97 x 1.15 within 0.15..1), last known value."""
    upper = F.least(F.greatest(F.percentile("share_smooth", F.lit(0.97)) * 1.15, F.lit(0.15)), F.lit(1.0))
    known = F.when(F.col("share_smooth").isNotNull(), F.col("date"))
    return shares.groupBy(product).agg(
        F.avg("share").alias("mean_share"), F.coalesce(upper, F.lit(1.0)).alias("upper"),
        F.max_by("share_smooth", known).alias("last_share"))
