"""Cleaning, typing, slicing and small projections over raw transactions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandcast.constants import (
    DATETIME_SYNONYMS, FORECAST_COLUMNS, TARGET_SYNONYMS, WEEKDAYS_ES,
)
from demandcast.functions.columns import col, parse_number, parse_time, title_name

#: Names of direct labels.
LABEL = re.compile(r"y_\d+")


def reverse_one_hot(df: DataFrame, prefix: str = "product_", out: str = "product", drop: bool = False) -> DataFrame:
    """Product name from one-hot columns; the first column wins ties and all-false rows."""
    names = [c for c in df.columns if c.startswith(prefix)]
    if not names:
        raise ValueError(f"no {prefix}* columns")
    as_int = {c: col(c).cast("int") for c in names}
    top = F.greatest(*as_int.values()) if len(names) > 1 else as_int[names[0]]
    pick = F.coalesce(*[F.when(as_int[c] == top, F.lit(c[len(prefix):])) for c in names])
    df = df.withColumn(out, pick)
    return df.drop(*names) if drop else df


def coerce_datetime(df: DataFrame, time: str | None = "datetime", date: str | None = "date",
                    zone: str = "UTC", local: str | None = None) -> DataFrame:
    """Bad dates become NULL; times are UTC instants, ``local`` adds the zone's wall clock."""
    if time in df.columns:
        df = df.withColumn(time, parse_time(time))
        if local:
            df = df.withColumn(local, F.from_utc_timestamp(time, zone).cast("timestamp_ntz"))
    if date in df.columns:
        df = df.withColumn(date, F.to_date(parse_time(date)))
    return df


def standardise_types(df: DataFrame, strings: Sequence[str] = (), numbers: Sequence[str] = ()) -> DataFrame:
    """Text columns to string, numeric columns to double with bad values NULL."""
    present = set(df.columns)
    plan = {c: col(c).cast("string") for c in strings if c in present}
    plan.update({c: parse_number(c) for c in numbers if c in present})
    return df.withColumns(plan) if plan else df


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def count_exact_duplicates(df: DataFrame) -> DataFrame:
    """One row: rows, distinct rows and duplicates, from per-row counts."""
    each = df.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return each.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
    )


def valid_sales(df: DataFrame, amount: str = "amount", drop: Sequence[str] = ("card",)) -> DataFrame:
    """Keep sales with a known, non-negative amount; drop identifying columns."""
    return df.where(F.col(amount) >= 0).drop(*drop)


def first_present(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    return next((c for c in candidates if c in columns), None)


def resolve_datetime(df: DataFrame, out: str = "datetime", synonyms: Sequence[str] = DATETIME_SYNONYMS) -> DataFrame:
    """Read the event time from the first known synonym, else from ``date``."""
    name = first_present(df.columns, synonyms) or first_present(df.columns, ("date",))
    if name is None:
        raise KeyError("no date-like column")
    return df.withColumn(out, parse_time(name))


def drop_missing_time(df: DataFrame, time: str = "datetime") -> DataFrame:
    return df.dropna(subset=[time])


def slice_sales(
    df: DataFrame,
    start=None,
    end=None,
    product: str | None = None,
    weekdays: Sequence[str] | None = None,
    hours: tuple[int, int] | None = None,
    time: str = "datetime",
    product_col: str = "product",
    weekday_col: str = "weekday",
    hour_col: str = "hour",
) -> DataFrame:
    """Dashboard filter: time range, product, weekday set and hour range, all optional.

    ``"All"`` switches a filter off, as does ``None``. Every predicate is a plain comparison,
    so the ones on stored columns reach the Parquet scan.
    """
    keep: list[Column] = []
    if start is not None:
        keep.append(F.col(time) >= F.lit(start).cast("timestamp"))
    if end is not None:
        keep.append(F.col(time) <= F.lit(end).cast("timestamp"))
    if product not in (None, "All"):
        keep.append(F.col(product_col) == product)
    if weekdays and "All" not in weekdays:
        keep.append(F.col(weekday_col).isin(*weekdays))
    if hours is not None:
        keep.append(F.col(hour_col).between(*hours))
    for k in keep:
        df = df.where(k)
    return df


def attach_time_of_day(df: DataFrame, date: str = "date", hour: str | None = None, default: int = 12,
                       out: str = "datetime") -> DataFrame:
    """Timestamp for a daily row: at ``default`` o'clock, or at the row's own mean hour."""
    h = F.lit(default) if hour is None else F.coalesce(F.floor(F.col(hour)).cast("int"), F.lit(default))
    at = F.timestamp_add("HOUR", h, F.col(date).cast("timestamp"))
    return df.withColumns({out: at, "hour": F.hour(at)})


def weekday_name(df: DataFrame, source: str, out: str = "weekday", names: Sequence[str] = WEEKDAYS_ES) -> DataFrame:
    """Weekday name by a literal lookup; ``source`` is a date/time or a Monday-0 number."""
    is_number = isinstance(df.schema[source].dataType, T.NumericType)
    n = F.col(source).cast("int") if is_number else F.weekday(source)
    return df.withColumn(out, F.get(F.array(*[F.lit(x) for x in names]), n))


def forecast_columns(df: DataFrame, target: str = "y", columns: Sequence[str] = FORECAST_COLUMNS) -> DataFrame:
    """Rename the truth column to ``y``, ``index`` to ``h``; keep known columns in order."""
    if "h" not in df.columns and "index" in df.columns:
        df = df.withColumnRenamed("index", "h")
    truth = first_present(df.columns, ("y", target, *TARGET_SYNONYMS))
    if truth and truth != "y":
        df = df.withColumnRenamed(truth, "y")
    return df.select(*[c for c in columns if c in df.columns])


def check_forecast(df: DataFrame, test_start: Column | None = None) -> DataFrame:
    """Forecast contract: date, product and yhat are required; h is derived when missing."""
    missing = [c for c in ("date", "product", "yhat") if c not in df.columns]
    if missing:
        raise ValueError(f"forecast lacks {missing}")
    if "h" in df.columns:
        return df
    if test_start is None:
        raise ValueError("h is missing and no test_start was given to derive it")
    return df.withColumn("h", F.datediff("date", test_start) + 1)


def clip_at_quantile(df: DataFrame, y: str = "y", q: float = 0.995, key: Sequence[str] = ("product",)) -> DataFrame:
    """Cap ``y`` at each group's linear-interpolated quantile.

    Meant for a daily panel, where a group has at most one row per day, so the exact
    percentile buffer of a group is bounded by the calendar.
    """
    limit = F.percentile(F.col(y), F.lit(q)).over(Window.partitionBy(*key))
    return df.withColumn(y, F.when(F.col(y) > limit, limit).otherwise(F.col(y)))


def clip_series(df: DataFrame, y: str, q: float = 0.99, out: str | None = None) -> DataFrame:
    """Clip a gridded series (one row per time bucket) from above at its own quantile."""
    limit = df.agg(F.percentile(F.col(y), F.lit(q)).alias("limit")).scalar()
    return df.withColumn(out or y, F.least(F.col(y), limit))


def fill_both_ways(df: DataFrame, columns: Sequence[str], key: Sequence[str] = ("product",), time: str = "date") -> DataFrame:
    """Forward fill, then backward fill, inside each series.

    What a forward fill leaves empty lies before the first known value, so the backward fill
    is that one value: a whole-series frame, linear where a frame that starts at each row
    would be quadratic.
    """
    w = Window.partitionBy(*key).orderBy(time)
    back = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumns(
        {c: F.coalesce(F.last(col(c), True).over(back), F.first(col(c), True).over(whole)) for c in columns}
    )


def random_sample(df: DataFrame, n: int = 1000, seed: int = 42) -> DataFrame:
    """At most ``n`` random rows, kept as a bounded top-n rather than a full sort."""
    return df.orderBy(F.rand(seed)).limit(n)


def schema_report(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Expected columns against those present and their types (driver-side metadata only)."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [(c, c in have, want, have.get(c, "MISSING")) for c, want in expected.items()]
    return df.sparkSession.createDataFrame(
        rows, "`column` string, `exists` boolean, expected string, inferred_dtype string"
    )


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in expected if c not in have]


def normalise_names(df: DataFrame, column: str = "product") -> DataFrame:
    return df.withColumn(column, title_name(column))


def pick_numeric(df: DataFrame, name: str) -> str:
    """The series column, if it exists and is numeric."""
    for f in df.schema.fields:
        if f.name == name and isinstance(f.dataType, T.NumericType):
            return name
    raise KeyError(f"no numeric column {name}")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    numeric = (T.NumericType, T.BooleanType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, numeric) and f.name not in exclude]


def sequence_features(df: DataFrame, target: str = "y", exclude: Sequence[str] = ("date", "product")) -> list[str]:
    """Numeric model inputs with the target as the first channel when it is not among them; labels (``y_1``, ``y_2``, ...) are none."""
    cols = [c for c in numeric_columns(df, exclude) if not LABEL.fullmatch(c)]
    return cols if target in cols or target not in df.columns else [target, *cols]


def screen_features(df: DataFrame, target: str = "y", key: Sequence[str] = ("product", "date"),
                    max_null_fraction: float = 0.30) -> DataFrame:
    """Candidate inputs with null fraction and a varies flag, in one aggregate pass.

    A column varies when its minimum and maximum differ, which spares a distinct count
    per column. Labels (``y_1``, ``y_2``, ...) are no inputs; lags and rollings of the target are.
    """
    names = [c for c in numeric_columns(df, (target, *key)) if not LABEL.fullmatch(c)]
    stats = df.agg(
        *[F.avg(col(c).isNull().cast("int")).alias(f"null_{i}") for i, c in enumerate(names)],
        *[(F.min(col(c)) < F.max(col(c))).alias(f"vary_{i}") for i, c in enumerate(names)],
    )
    rows = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"null_{i}").alias("null_fraction"),
                 F.coalesce(F.col(f"vary_{i}"), F.lit(False)).alias("varies"))
        for i, c in enumerate(names)
    ])
    return stats.select(F.inline(rows)).withColumn(
        "kept", F.col("varies") & (F.col("null_fraction") <= max_null_fraction)
    )
