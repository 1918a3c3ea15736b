"""Rolling-origin splits as a small table that travels inside the plan.

The origins (a handful of rows) reach the panel as one array literal from a scalar subquery.
A row is matched to its origins by filtering that array, so there is no range join, and
training rows are never copied once per origin: each row is tagged with the first origin
that may train on it, and per-origin results are built from those disjoint segments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def rolling_origins(df: DataFrame, n_origins: int = 4, horizon: int = 7, time: str = "date") -> DataFrame:
    """Origins at the H-th, 2H-th, .. nH-th distinct date from the end, oldest first.

    ``n_train_days`` counts the distinct dates before the test window over all series. The
    window runs over distinct dates only, one row per calendar day. Too few dates raise.
    """
    days = df.select(F.col(time).alias("_d")).where(F.col("_d").isNotNull()).distinct()
    all_days = Window.partitionBy(F.lit(0))
    ranked = days.select("_d", F.row_number().over(all_days.orderBy("_d")).alias("_rank"),
                         F.count(F.lit(1)).over(all_days).alias("_n"))
    need = n_origins * horizon
    back = F.col("_n") - F.col("_rank") + 1
    enough = F.when(F.col("_n") < need, F.raise_error(F.lit(f"need {need} distinct dates")).cast("boolean")).otherwise(
        F.lit(True))
    anchors = ranked.where(enough & (back % horizon == 0) & (back <= need))
    return anchors.select(
        (F.lit(n_origins + 1) - back / horizon).cast("int").alias("origin_id"),
        F.date_sub("_d", 1).alias("train_end"),
        F.col("_d").alias("test_start"),
        F.date_add("_d", horizon - 1).alias("test_end"),
        (F.col("_rank") - 1).cast("int").alias("n_train_days"),
    )


def history_gate(origins: DataFrame, min_days: int = 150) -> DataFrame:
    return origins.where(F.col("n_train_days") >= min_days)


def final_origin(df: DataFrame, horizon: int = 7, time: str = "date") -> DataFrame:
    """One origin that trains on everything and forecasts the days after the last date."""
    last = df.agg(F.max(time).alias("_d"), F.count_distinct(time).cast("int").alias("n_train_days"))
    return last.select(F.lit(1).alias("origin_id"), F.col("_d").alias("train_end"),
                       F.date_add("_d", 1).alias("test_start"), F.date_add("_d", horizon).alias("test_end"),
                       "n_train_days")


def origin_list(origins: DataFrame) -> Column:
    """The origins as one sorted array value."""
    fields = F.struct("origin_id", "train_end", "test_start", "test_end")
    return origins.agg(F.sort_array(F.collect_list(fields)).alias("o")).scalar()


def segment(date: str, origins: str = "_origins") -> Column:
    """How many origins stop training before this row: 0 means every origin may use it."""
    return F.size(F.filter(origins, lambda o: o["train_end"] < F.col(date)))


def ends_segment(date_window: WindowSpec, n: int, seg: str = "_seg") -> Column:
    """True for the last ``n`` rows of each segment of a series.

    Segments never decrease along a series, so looking ``n`` rows ahead is enough; the check
    shares the series window instead of sorting each segment backwards.
    """
    return F.coalesce(F.lead(seg, n).over(date_window) != F.col(seg), F.lit(True))


def training_origins(seg: Column, origins: str = "_origins") -> Column:
    """The origins a row of this segment may train."""
    return F.slice(F.col(origins), seg + 1, F.greatest(F.size(origins) - seg, F.lit(0)))


def testing_origins(date: str, origins: str = "_origins") -> Column:
    return F.filter(origins, lambda o: F.col(date).between(o["test_start"], o["test_end"]))


def split_rows(df: DataFrame, origins: DataFrame, role: str = "test", time: str = "date") -> DataFrame:
    """Rows repeated for every origin they train or test, with ``origin_id``.

    For models that need the training rows of each origin side by side; operators that can
    add up segments use :func:`segment` instead.
    """
    df = df.withColumn("_origins", origin_list(origins))
    which = testing_origins(time) if role == "test" else training_origins(segment(time))
    return df.withColumn("_o", F.explode(which)).select(
        *[c for c in df.columns if c != "_origins"], F.col("_o.origin_id").alias("origin_id"),
        F.col("_o.train_end").alias("train_end"), F.col("_o.test_start").alias("test_start"))


def future_days(df: DataFrame, origins: DataFrame) -> DataFrame:
    """One row per input row, origin and forecast day: adds origin_id, date and h."""
    df = df.withColumn("_o", F.explode(origin_list(origins)))
    days = F.sequence(F.col("_o.test_start"), F.col("_o.test_end"), F.expr("INTERVAL 1 DAY"))
    keep = [c for c in df.columns if c != "_o"]
    return df.select(*keep, F.col("_o.origin_id").alias("origin_id"), F.posexplode(days).alias("_p", "date")).withColumn(
        "h", F.col("_p") + 1).drop("_p")
