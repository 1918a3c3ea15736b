"""Gap-free time grids.

Gaps are closed from the rows themselves: each row looks at the next one in its series and
emits the missing steps in between. That is one window and one explode after the aggregate,
where a separate grid table would need a second pass over the source and a join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.functions.columns import STEPS, add_step, ceil_time, col, floor_time


def _emit(df: DataFrame, time: str, first: Column, last: Column, step: Column,
          fill: Mapping[str, object], keep: Sequence[str]) -> DataFrame:
    steps = F.explode(F.sequence(first, F.greatest(first, last), step))
    at = df.withColumn("_at", steps)
    own = F.col("_at") == F.col(time)
    values = {
        c: F.when(own, col(c)).otherwise(F.lit(fill[c]) if c in fill else F.lit(None))
        for c in df.columns if c not in (*keep, time) and not c.startswith("_")
    }
    return at.select(*[col(c) for c in keep], F.col("_at").alias(time), *[v.alias(c) for c, v in values.items()])


def complete_calendar(df: DataFrame, key: Sequence[str] = ("product",), time: str = "date",
                      fill: Mapping[str, object] | None = None) -> DataFrame:
    """Every day between a series' own first and last date; new days hold NULL or ``fill``."""
    w = Window.partitionBy(*key).orderBy(time)
    df = df.withColumn("_until", F.coalesce(F.date_sub(F.lead(time).over(w), 1), F.col(time)))
    return _emit(df, time, F.col(time), F.col("_until"), F.expr("INTERVAL 1 DAY"), fill or {}, key)


def close_grid(df: DataFrame, lo: Column, hi: Column, step: str = "day", time: str = "datetime",
               key: Sequence[str] = (), fill: Mapping[str, object] | None = None) -> DataFrame:
    """Stretch every series to the common range ``lo..hi`` on a fixed step.

    Without ``key`` there is one series with one row per bucket, so its single window holds
    no more rows than the calendar has buckets.
    """
    w = (Window.partitionBy(*key) if key else Window.partitionBy(F.lit(0))).orderBy(time)
    df = df.withColumns({
        "_first": F.when(F.lag(time).over(w).isNull(), lo).otherwise(F.col(time)),
        "_last": F.coalesce(add_step(F.lead(time).over(w), step, -1), hi),
    })
    return _emit(df, time, F.col("_first"), F.col("_last"), F.expr(STEPS[step]), fill or {}, key)


def time_bounds(df: DataFrame, time: str, step: str, include_ceil: bool = True) -> tuple[Column, Column]:
    """Scalar floor(min) and ceil(max) of a time column, computed from that column alone.

    The last bucket is the ceiling of the maximum, which adds one empty bucket unless the
    maximum lies on a boundary; ``include_ceil=False`` ends at its floor.
    """
    top = ceil_time if include_ceil else floor_time
    ends = df.agg(F.min(time).alias("lo"), F.max(time).alias("hi"))
    lo = ends.select(floor_time("lo", step).alias("lo")).scalar()
    hi = ends.select(top("hi", step).alias("hi")).scalar()
    return lo, hi


def canonical_grid(df: DataFrame, step: str = "hour", time: str = "datetime", include_ceil: bool = True) -> DataFrame:
    """The empty time grid of a table: one row per step between its bounds."""
    top = ceil_time if include_ceil else floor_time
    ends = df.agg(F.min(time).alias("_lo"), F.max(time).alias("_hi"))
    return ends.select(F.explode(F.sequence(
        floor_time("_lo", step), top("_hi", step), F.expr(STEPS[step])
    )).alias(time))
