"""Landed weather and holiday JSON, and the enrichment joins that use them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandcast.functions.columns import col, local_date, local_hour_utc
from demandcast.session import materialise

WEATHER_VARIABLES = ("temperature_2m", "relative_humidity_2m", "precipitation", "cloud_cover")
HOLIDAY_SCHEMA = "array<struct<date:string,localName:string,counties:array<string>>>"


def weather_schema(variables: Sequence[str] = WEATHER_VARIABLES) -> T.StructType:
    inner = T.StructType([T.StructField("time", T.ArrayType(T.StringType()))] + [
        T.StructField(v, T.ArrayType(T.DoubleType())) for v in variables])
    return T.StructType([T.StructField("hourly", inner)])


def unpivot_weather(df: DataFrame, payload: str = "payload", variables: Sequence[str] = WEATHER_VARIABLES) -> DataFrame:
    """Parallel arrays under ``hourly`` to one row per UTC hour; a missing variable is NULL.

    Where documents overlap, each variable of an hour is the mean of its known values.
    """
    if isinstance(df.schema[payload].dataType, T.StringType):
        df = df.withColumn(payload, F.from_json(payload, weather_schema(variables)))
    hourly = col(payload)["hourly"]
    # One struct per hour, so the explode carries no arrays along.
    hours = F.transform(hourly["time"], lambda t, i: F.struct(
        t.alias("time"), *[F.get(hourly[v], i).alias(v) for v in variables]))
    at = df.select(F.inline(hours)).select(
        F.date_trunc("hour", F.col("time").try_cast("timestamp")).alias("hour_utc"), *[col(v) for v in variables])
    return weather_hours(at.where(F.col("hour_utc").isNotNull()))


def weather_hours(weather: DataFrame) -> DataFrame:
    """One row per hour: means of the known values, so that enriching never repeats a sale."""
    return weather.groupBy("hour_utc").agg(*[F.avg(col(c)).alias(c) for c in weather.columns if c != "hour_utc"])


def read_weather(spark, path: str, variables: Sequence[str] = WEATHER_VARIABLES) -> DataFrame:
    """Landed payload files, one document each, with a fixed schema."""
    docs = spark.read.schema(weather_schema(variables)).json(path, multiLine=True)
    return unpivot_weather(docs.select(F.struct("hourly").alias("payload")), "payload", variables)


def public_holidays(df: DataFrame, payload: str = "payload", regions: Sequence[str] | None = None) -> DataFrame:
    """Holiday documents to one row per entry.

    With ``regions`` an entry stays when it names no region at all or one of these.
    """
    items = df.select(F.explode(F.from_json(payload, HOLIDAY_SCHEMA)).alias("i"))
    rows = items.select(F.to_date(F.col("i.date").try_cast("timestamp")).alias("date"),
                        F.col("i.localName").alias("holiday_name"),
                        F.coalesce("i.counties", F.array().cast("array<string>")).alias("_c"))
    rows = rows.where(F.col("date").isNotNull())
    if regions:
        allowed = F.array(*[F.lit(r) for r in regions])
        rows = rows.where((F.size("_c") == 0) | F.arrays_overlap("_c", allowed))
    return rows.select("date", F.lit(True).alias("is_holiday"), "holiday_name")


def holiday_calendar(holidays: DataFrame) -> DataFrame:
    """One row per date, so that enriching never repeats a sale; the first name is kept."""
    return holidays.groupBy("date").agg(F.lit(True).alias("is_holiday"), F.min("holiday_name").alias("holiday_name"))


def join_weather(df: DataFrame, weather: DataFrame, time: str = "datetime", zone: str | None = None,
                 prefix: str = "wx_") -> DataFrame:
    """Rows with the weather of their hour.

    ``zone`` reads ``time`` as naive local wall clock; without it ``time`` is an instant. The
    floor happens in UTC, which keeps it safe on clock changes. Weather is reduced to one row
    per hour and written, so the planner sees its size: below the broadcast threshold the sales
    stay where they are, above it AQE splits hot hours.
    """
    hour = local_hour_utc(time, zone) if zone else F.date_trunc("hour", col(time))
    weather = materialise(weather_hours(weather))
    renamed = weather.select(F.col("hour_utc").alias("_hour_utc"),
                             *[col(c).alias(f"{prefix}{c}") for c in weather.columns if c != "hour_utc"])
    return df.withColumn("_hour_utc", hour).join(renamed, "_hour_utc", "left").drop("_hour_utc")


def join_holidays(df: DataFrame, holidays: DataFrame, time: str = "datetime", zone: str = "UTC",
                  keep_date: str | None = "date_local") -> DataFrame:
    """Rows with holiday flag (false when none) and name of their local date."""
    days = holiday_calendar(holidays).withColumnRenamed("date", "_local")
    out = df.withColumn("_local", local_date(time, zone)).join(F.broadcast(days), "_local", "left").withColumn(
        "is_holiday", F.coalesce("is_holiday", F.lit(False)))
    return out.withColumnRenamed("_local", keep_date) if keep_date else out.drop("_local")


def enrich_sales(df: DataFrame, weather: DataFrame | None, holidays: DataFrame | None, time: str = "datetime",
                 zone: str = "UTC") -> DataFrame:
    if weather is not None:
        df = join_weather(df, weather, time)
    return join_holidays(df, holidays, time, zone) if holidays is not None else df
