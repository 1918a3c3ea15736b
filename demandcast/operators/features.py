"""Causal panel features: calendar, lags, rollings, market position, exogenous windows."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandcast.constants import (
    DAILY_EXOG, DAILY_LAGS, DAILY_ROLLS, MONTHLY_EXOG, MONTHLY_LAGS, MONTHLY_ROLLS,
)
from demandcast.functions.columns import col, cyclic, no_nan


def series_window(key: Sequence[str] = ("product",), time: str = "date") -> WindowSpec:
    """The one window every panel feature shares: one exchange and one sort for all."""
    return Window.partitionBy(*key).orderBy(time)


def lags(y: str, ks: Iterable[int], w: WindowSpec) -> dict[str, Column]:
    return {f"{y}_lag_{k}": F.lag(y, k).over(w) for k in ks}


def causal_mean(y: str, n: int, w: WindowSpec) -> Column:
    """Mean of the ``n`` rows before this one, missing values skipped."""
    return F.avg(y).over(w.rowsBetween(-n, -1))


def add_causal_features(df: DataFrame, y: str = "y", key: Sequence[str] = ("product",), time: str = "date",
                        lag_days: Sequence[int] = (1, 7, 14), windows: Sequence[int] = (3, 7, 30),
                        volatility: int | None = 7) -> DataFrame:
    w = series_window(key, time)
    out = lags(y, lag_days, w)
    out.update({f"{y}_roll_{n}": causal_mean(y, n, w) for n in windows})
    if volatility:
        out[f"{y}_vol_{volatility}"] = F.stddev_samp(y).over(w.rowsBetween(-volatility, -1))
    return df.withColumns(out)


def rebuild_rollings(df: DataFrame, y: str = "y", key: Sequence[str] = ("product",),
                     time: str = "date") -> tuple[DataFrame, DataFrame]:
    """Recompute every existing ``<y>_roll_<n>`` column causally; also return the log table."""
    found = [(c, int(m.group(1))) for c in df.columns if (m := re.fullmatch(rf"{re.escape(y)}_roll_(\d+)", c))]
    log = df.sparkSession.createDataFrame(
        sorted(((c, n, True) for c, n in found), key=lambda r: (r[1], r[0])),
        "`column` string, `window` int, reconstructed boolean",
    )
    w = series_window(key, time)
    return (df.withColumns({c: causal_mean(y, n, w) for c, n in found}) if found else df), log


def add_business_lag(df: DataFrame, y: str = "y", key: Sequence[str] = ("product",), time: str = "date") -> DataFrame:
    """Yesterday's market: total of the day, own share, 7-day mean total, competitors' sum.

    The total of a day is a grouped sum with one row per calendar day, joined back by
    broadcast. A window over the day would put every series of that day into one task.
    ``df`` is read twice; hand in a materialised panel when it is costly.
    """
    total = df.groupBy(time).agg(F.coalesce(F.sum(y), F.lit(0.0)).alias("_total"))
    w = series_window(key, time)
    df = df.join(F.broadcast(total), time, "left")
    share = F.coalesce(F.try_divide(F.col(y), F.col("_total")), F.lit(0.0))
    df = df.withColumn("_share", share).withColumns({
        "totals_day_t1": F.lag("_total", 1).over(w),
        "share_day_t1": F.lag("_share", 1).over(w),
        "totals_day_roll_7": F.avg("_total").over(w.rowsBetween(-7, -1)),
        "competitor_sum_t1": F.lag("_total", 1).over(w) - F.lag(y, 1).over(w),
    })
    return df.drop("_total", "_share")


def add_calendar(df: DataFrame, date: str = "date", holiday: str = "is_holiday") -> DataFrame:
    """Weekday (Monday 0), month, ISO week, weekend, month edges, holiday and cyclic encodings."""
    d = F.col(date)
    dow, month = F.weekday(d), F.month(d)
    dow_sin, dow_cos = cyclic(dow, 7)
    month_sin, month_cos = cyclic(month - 1, 12)
    flag = F.coalesce(col(holiday).cast("int"), F.lit(0)) if holiday in df.columns else F.lit(0)
    return df.withColumns({
        "dow": dow, "month": month, "weekofyear": F.weekofyear(d),
        "is_weekend": (dow >= 5).cast("int"),
        "is_month_start": (F.dayofmonth(d) == 1).cast("int"),
        "is_month_end": (F.last_day(d) == d).cast("int"),
        holiday: flag,
        "dow_sin": dow_sin, "dow_cos": dow_cos, "month_sin": month_sin, "month_cos": month_cos,
    })


def add_date_parts(df: DataFrame, date: str = "date") -> DataFrame:
    """Plain calendar columns of the daily panel."""
    d = F.col(date)
    return df.withColumns({
        "year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d), "quarter": F.quarter(d),
        "dayofweek": F.weekday(d), "week_of_year": F.weekofyear(d),
    })


def add_holiday_neighbours(df: DataFrame, date: str = "date", holiday: str = "is_holiday") -> DataFrame:
    """Flags for the day before and after: neighbours in the list of distinct dates.

    The list has one row per calendar day, which bounds both its window and the broadcast.
    """
    days = df.groupBy(date).agg(F.max(F.coalesce(col(holiday).cast("int"), F.lit(0))).alias("_h"))
    w = Window.partitionBy(F.lit(0)).orderBy(date)
    near = days.select(
        date,
        F.coalesce(F.lag("_h").over(w), F.lit(0)).alias("is_holiday_prev"),
        F.coalesce(F.lead("_h").over(w), F.lit(0)).alias("is_holiday_next"),
    )
    return df.join(F.broadcast(near), date, "left")


def join_holiday_list(df: DataFrame, holidays: DataFrame, date: str = "date", out: str = "is_holiday_ext") -> DataFrame:
    """1 on dates of an external holiday list, else 0; one row per date after the distinct."""
    marks = holidays.select(F.to_date(date).alias(date)).distinct().withColumn(out, F.lit(1))
    return df.join(F.broadcast(marks), date, "left").fillna({out: 0})


def join_exogenous(df: DataFrame, exog: DataFrame, date: str = "date") -> DataFrame:
    """Panel with a daily exogenous table.

    Where a date has several rows, each column takes its largest known value. One row per date
    guards the panel against repeated rows and, for a column of dates, bounds the broadcast by
    the calendar; a finer time is left to the planner.
    """
    daily = exog.groupBy(date).agg(*[F.max(col(c)).alias(c) for c in exog.columns if c != date])
    return df.join(F.broadcast(daily) if isinstance(exog.schema[date].dataType, T.DateType) else daily, date, "left")


def add_labels(df: DataFrame, y: str = "y", horizon: int = 7, key: Sequence[str] = ("product",),
               time: str = "date") -> DataFrame:
    """Direct labels ``y_1..y_H``: the target that many rows ahead in the series."""
    w = series_window(key, time)
    return df.withColumns({f"y_{h}": F.lead(y, h).over(w) for h in range(1, horizon + 1)})


def trailing_mean(y: str, n: int, w: WindowSpec, min_fraction: float | None = None) -> Column:
    """Mean of the last ``n`` rows, today included.

    With ``min_fraction`` the window must hold at least ``max(1, floor(n * fraction))``
    values, otherwise one value is enough.
    """
    frame = w.rowsBetween(-(n - 1), 0)
    mean = F.avg(y).over(frame)
    if min_fraction is None:
        return mean
    return F.when(F.count(y).over(frame) >= max(1, int(n * min_fraction)), mean)


def add_time_features(df: DataFrame, time: str = "datetime") -> DataFrame:
    """Time parts of a transaction with month/12 and hour/24 cyclic encodings."""
    t = F.col(time)
    month_sin, month_cos = cyclic(F.month(t), 12)
    hour_sin, hour_cos = cyclic(F.hour(t), 24)
    return df.withColumns({
        "year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t), "hour": F.hour(t),
        "dow": F.weekday(t), "week": F.weekofyear(t),
        "month_sin": month_sin, "month_cos": month_cos, "hour_sin": hour_sin, "hour_cos": hour_cos,
    })


def exogenous_spec(columns: Sequence[str], daily: Sequence[str] = DAILY_EXOG,
                   monthly: Sequence[str] = MONTHLY_EXOG) -> list[tuple[str, str, str, int]]:
    """``(output, variable, kind, days)`` for every window of the variables at hand."""
    spec = []
    for v in (v for v in daily if v in columns):
        spec += [(f"{v}_lag{n}", v, "lag", n) for n in DAILY_LAGS]
        spec += [(f"{v}_{n}d_{kind}", v, kind, n) for kind, n in DAILY_ROLLS]
    for v in (v for v in monthly if v in columns):
        spec += [(f"{v}_lag{n}d", v, "lag", n) for n in MONTHLY_LAGS]
        spec += [(f"{v}_{n}d_{kind}", v, kind, n) for kind, n in MONTHLY_ROLLS]
    return spec


def add_exogenous_windows(df: DataFrame, spec: Sequence[tuple[str, str, str, int]] | None = None,
                          key: Sequence[str] = (), date: str = "date") -> DataFrame:
    """Lag and rolling columns of a daily exogenous table (one row per day and key)."""
    spec = exogenous_spec(df.columns) if spec is None else spec
    w = (Window.partitionBy(*key) if key else Window.partitionBy(F.lit(0))).orderBy(date)
    how = {"mean": F.avg, "sum": F.sum}
    return df.withColumns({
        out: F.lag(col(v), n).over(w) if kind == "lag" else how[kind](col(v)).over(w.rowsBetween(-(n - 1), 0))
        for out, v, kind, n in spec
    })


def lookback_windows(df: DataFrame, features: Sequence[str], y: str = "y", lookback: int = 30, horizon: int = 7,
                     key: Sequence[str] = ("product",), time: str = "date") -> DataFrame:
    """Supervised rows: the last ``lookback`` feature vectors and the next ``horizon`` targets.

    Only full windows are kept; the target array keeps NULLs in place.
    """
    w = series_window(key, time)
    vector = F.array(*[no_nan(col(c).cast("double")) for c in features])
    ahead = F.array(*[F.lead(y, h).over(w) for h in range(1, horizon + 1)])
    rows = df.withColumns({
        "x": F.collect_list(vector).over(w.rowsBetween(-(lookback - 1), 0)),
        "target": ahead if horizon else F.array().cast("array<double>"),
        "_left": F.count(F.lit(1)).over(w.rowsBetween(1, horizon)) if horizon else F.lit(0),
    })
    full = (F.size("x") == lookback) & (F.col("_left") == horizon)
    return rows.where(full).select(*key, time, "x", "target")


def last_window(df: DataFrame, features: Sequence[str], lookback: int = 30, key: Sequence[str] = ("product",),
                time: str = "date") -> DataFrame:
    """The most recent ``lookback`` vectors per series, front-padded with the oldest one kept."""
    newest = Window.partitionBy(*key).orderBy(F.col(time).desc())
    vector = F.array(*[no_nan(col(c).cast("double")) for c in features])
    recent = df.withColumn("_r", F.row_number().over(newest)).where(F.col("_r") <= lookback)
    packed = recent.groupBy(*key).agg(
        F.max(time).alias(time),
        F.transform(F.sort_array(F.collect_list(F.struct(F.col(time).alias("t"), vector.alias("v")))),
                    lambda s: s["v"]).alias("_v"),
    )
    pad = F.array_repeat(F.get("_v", F.lit(0)), F.lit(lookback) - F.size("_v"))
    return packed.select(*key, time, F.concat(pad, F.col("_v")).alias("x"))


def fit_scaler(df: DataFrame, features: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation of each feature (fit it on training rows only)."""
    return df.groupBy(*group).agg(
        *[F.avg(col(c)).alias(f"mean_{c}") for c in features],
        *[F.stddev_pop(col(c)).alias(f"std_{c}") for c in features],
    )


def apply_scaler(df: DataFrame, scaler: DataFrame, features: Sequence[str]) -> DataFrame:
    """Standardise with a one-row scaler; a zero deviation divides by one."""
    # One row as one value: however many features read it, the subquery runs once.
    row = scaler.select(F.struct(*[col(c) for c in scaler.columns])).scalar()

    def part(name: str) -> Column:
        return row[name]

    def unit(c: str) -> Column:
        std = part(f"std_{c}")
        return F.when(std > 0, std).otherwise(F.lit(1.0))

    return df.withColumns({c: (col(c) - part(f"mean_{c}")) / unit(c) for c in features})
