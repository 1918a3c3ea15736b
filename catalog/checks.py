"""Queries for the quality report and for landed weather and holiday documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import HOLIDAYS, TX, holiday_days, plain, query, sales, shown, table
from demandcast.functions.columns import is_dst, local_hour_utc
from demandcast.operators import quality
from demandcast.operators.features import add_time_features
from demandcast.session import materialise
from demandcast.sources import external

ZONE = "Europe/Berlin"


def enriched(spark, sf):
    """Enriched sales with planted faults, each a function of the event id."""
    df = add_time_features(sales(spark, sf)).drop("payment", "card")
    k = F.col("event_id")
    return df.select(
        "event_id",
        F.when(k % 1000 == 1, F.concat(F.lit("bad"), k.cast("string"))).otherwise(F.to_date("datetime").cast("string")).alias("date"),
        "datetime", F.date_trunc("hour", "datetime").alias("dt_local"), F.to_date("datetime").alias("_date_local"),
        F.when(k % 500 == 2, "voucher").when(k % 2 == 0, "card").otherwise("cash").alias("cash_type"),
        F.when(k % 400 == 3, F.concat(F.lit("4111-"), k.cast("string"))).when(k % 2 == 0, "ANON-AB12-CD34-0001").alias("card"),
        F.when(k % 700 == 4, -F.col("amount")).otherwise(F.col("amount")).alias("money"),
        F.when(k % 900 == 5, "").otherwise(F.col("product")).alias("coffee_name"),
        "year", F.when(k % 800 == 6, F.lit(13)).otherwise(F.col("month")).alias("month"), "day", "hour", "dow", "week",
        "month_sin", "month_cos", F.when(k % 600 == 7, F.lit(1.5)).otherwise(F.col("hour_sin")).alias("hour_sin"), "hour_cos",
        (F.col("amount") % 40 - 10).alias("wx_temperature_2m"),
        F.when(k % 300 == 8, F.lit(-1.0)).otherwise(k % 7 / 1.0).alias("wx_precipitation"),
        F.when(k % 250 == 9, F.lit(9.0)).otherwise(F.lit(0.0)).alias("wx_rain"),
        (k % 101).alias("wx_cloudcover"), (k % 10 == 0).alias("is_holiday"),
        F.when((k % 10 == 0) & (k % 750 != 0), "Fiesta").when(k % 950 == 11, " NaN ").when(k % 650 == 12, "Oops").alias("holiday_name"))


# check -> (column, condition of a failing row in SQL, value shown)
FAULTS = {
    ("date", "iso_date_string"): ("event_id % 1000 = 1", "'bad' || event_id"),
    ("cash_type", "allowed_values"): ("event_id % 500 = 2", "'voucher'"),
    ("card", "anonymized_pattern"): ("event_id % 400 = 3", "'4111-' || event_id"),
    ("money", "numeric_non_negative"): ("event_id % 700 = 4 AND value > 0", "NULL"),
    ("coffee_name", "non_empty"): ("event_id % 900 = 5", "''"),
    ("month", "value_range"): ("event_id % 800 = 6", "'13'"),
    ("month_sin", "consistency_with_month"): ("event_id % 800 = 6 AND FALSE", "NULL"),
    ("hour_sin", "trig_range"): ("event_id % 600 = 7", "'1.5'"),
    ("hour_sin", "consistency_with_hour"): ("event_id % 600 = 7", "'1.5'"),
    ("wx_precipitation", "non_negative"): ("event_id % 300 = 8", "'-1.0'"),
    ("wx_rain", "non_negative"): ("event_id % 300 = 8", "'-1.0'"),
    ("wx_precipitation", "physical_plausibility"): ("event_id % 300 = 8", "'-1.0'"),
    ("wx_rain", "rain_leq_total_precip"): (
        "CASE WHEN event_id % 250 = 9 THEN 9.0 ELSE 0.0 END > CASE WHEN event_id % 300 = 8 THEN -1.0 ELSE event_id % 7 END", "NULL"),
    ("holiday_name", "consistency_with_is_holiday"): (
        "CASE WHEN event_id % 10 = 0 THEN event_id % 750 = 0 AND event_id % 650 <> 12 ELSE event_id % 950 <> 11 AND event_id % 650 = 12 END", "NULL"),
}
CLEAN = [("_date_local", "iso_date_string"), ("datetime", "iso_datetime_with_tz"), ("dt_local", "iso_datetime_with_tz"),
         ("dt_local", "hour_floor_alignment"), ("datetime", "timezone_aware"), ("is_holiday", "boolean_type"),
         ("month_cos", "consistency_with_month"), ("hour_cos", "consistency_with_hour"), ("wx_cloudcover", "value_range"),
         ("wx_temperature_2m", "physical_plausibility"), ("wx_rain", "physical_plausibility"), ("wx_cloudcover", "integer_like"),
         *[(c, "integer_like") for c in ("year", "month", "day", "hour", "dow", "week")],
         *[(c, "value_range") for c in ("day", "hour", "dow", "week")],
         *[(c, "numeric") for c in ("money", "month_sin", "month_cos", "hour_sin", "hour_cos", "wx_temperature_2m", "wx_precipitation", "wx_rain")],
         *[(c, "trig_range") for c in ("month_sin", "month_cos", "hour_cos")]]


def quality_sql() -> str:
    # January: sin(2*pi*1/12) never equals the angle of month 13 under the first convention, but
    # month 13 has the angle of month 1 under the second, so the planted month stays consistent.
    parts = [f"SELECT '{c}' AS \"column\", '{k}' AS \"check\", COUNT(*) FILTER ({cond}) AS n_bad FROM events"
             for (c, k), (cond, _) in FAULTS.items()]
    parts += [f"SELECT '{c}', '{k}', 0" for c, k in CLEAN]
    return f"""WITH r AS ({' UNION ALL '.join(parts)}) SELECT "column", "check", n_bad, CASE WHEN n_bad = 0 THEN 'OK' ELSE 'FAIL' END AS status FROM r
 UNION ALL SELECT '__all__', 'columns_present', 6, 'FAIL'"""


@query("quality_report", quality_sql())
def _(spark, sf):
    # The report reads its table twice, so the derived table is stored first.
    report = quality.validate_enriched(materialise(enriched(spark, sf)))
    return report.select("column", "check", "n_bad", "status")


def samples_sql() -> str:
    parts = [f"SELECT DISTINCT '{c}' AS \"column\", '{k}' AS \"check\", {v} AS value FROM events WHERE {cond}"
             for (c, k), (cond, v) in FAULTS.items() if v != "NULL"]
    return f"""WITH b AS ({' UNION ALL '.join(parts)}) SELECT "column", "check", value FROM b
 QUALIFY ROW_NUMBER() OVER (PARTITION BY "column", "check" ORDER BY value) <= 5"""


@query("quality_samples", samples_sql())
def _(spark, sf):
    df = materialise(enriched(spark, sf))
    shown_here = {k for k, (_, v) in FAULTS.items() if v != "NULL"}
    rules = [r for r in quality.enriched_rules(df) if (r.column, r.check) in shown_here]
    names = F.array(*[F.struct(F.lit(r.column).alias("c"), F.lit(r.check).alias("k")) for r in rules])
    found = quality.bad_samples(df, rules).select(F.get(names, F.col("rule")).alias("n"), F.explode("sample_bad_values").alias("value"))
    return found.select(F.col("n.c").alias("column"), F.col("n.k").alias("check"), "value")


@query("cross_column_checks", """SELECT 'consistency_with_is_holiday' AS "check", COUNT(*) FILTER (""" + FAULTS[
    ("holiday_name", "consistency_with_is_holiday")][0] + """) AS n_bad FROM events UNION ALL SELECT 'rain_leq_total_precip', COUNT(*) FILTER ("""
       + FAULTS[("wx_rain", "rain_leq_total_precip")][0] + ") FROM events")
def _(spark, sf):
    df = enriched(spark, sf)
    rules = [r for r in quality.enriched_rules(df) if r.check in ("rain_leq_total_precip", "consistency_with_is_holiday")]
    return quality.failure_counts(df, rules).select("check", "n_bad")


# --- weather and holiday documents derived from the orders table --------------------------

def weather_docs(spark, sf):
    """One weather document per day: 24 hourly slots, values taken from the day's orders."""
    daily = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(
        F.min("o_totalprice").alias("a"), F.count(F.lit(1)).cast("double").alias("n"))
    hours = F.sequence(F.lit(0), F.lit(23))
    stamp = F.transform(hours, lambda h: F.concat(
        F.col("d").cast("string"), F.lit("T"), F.lpad(h.cast("string"), 2, "0"), F.lit(":00")))
    return daily.select(F.to_json(F.struct(F.struct(
        stamp.alias("time"), F.transform(hours, lambda h: F.col("a") + h).alias("temperature_2m"),
        F.transform(hours, lambda h: F.col("n") * h).alias("precipitation")).alias("hourly"))).alias("payload"))


VARS = ("temperature_2m", "precipitation", "cloud_cover")
WEATHER = """wd AS (SELECT CAST(o_orderdate AS DATE) AS d, MIN(o_totalprice) AS a, COUNT(*) AS n FROM orders GROUP BY 1),
 wx AS (SELECT CAST(d AS TIMESTAMP) + h * INTERVAL 1 HOUR AS hour_utc, a + h AS temperature_2m, CAST(n * h AS DOUBLE) AS precipitation,
 CAST(NULL AS DOUBLE) AS cloud_cover FROM wd, (SELECT UNNEST(generate_series(0, 23)) AS h))"""


@query("weather_unpivot", f"WITH {WEATHER} " + shown("", "temperature_2m precipitation cloud_cover", "wx", dates="hour_utc"))
def _(spark, sf):
    return plain(external.unpivot_weather(weather_docs(spark, sf), variables=VARS))


def holiday_docs(spark, sf):
    """One holiday document per year: entries with no region, a matching or a foreign one."""
    d = holiday_days(spark, sf)
    day = F.dayofmonth("date") % 3
    entry = F.struct(F.col("date").cast("string").alias("date"), F.concat(F.lit("Holiday "), F.col("date").cast("string")).alias("localName"),
                     F.when(day == 0, F.array(F.lit("UA-05"), F.lit("UA-30"))).when(day == 1, F.array(F.lit("UA-63"))).alias("counties"))
    return d.groupBy(F.year("date").alias("y")).agg(F.to_json(F.sort_array(F.collect_list(entry))).alias("payload"))


@query("holiday_filter", f"WITH {HOLIDAYS} SELECT CAST(date AS VARCHAR) AS date, TRUE AS is_holiday, 'Holiday ' || date AS holiday_name FROM hol WHERE day(date) % 3 <> 1")
def _(spark, sf):
    return plain(external.public_holidays(holiday_docs(spark, sf), regions=["UA-05"]))


def shipping(spark, sf):
    """Line items spread over the hours of their shipping day."""
    line = table(spark, sf, "lineitem")
    minute = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 61) % 1440
    return line.select("l_orderkey", "l_linenumber", F.timestamp_add("MINUTE", minute.cast("int"), F.col("l_shipdate").cast("timestamp")).alias("datetime"))


SHIP = """ship AS (SELECT l_orderkey, l_linenumber, l_shipdate + ((l_orderkey * 7 + l_linenumber * 61) % 1440) * INTERVAL 1 MINUTE AS datetime FROM lineitem)"""


@query("tx_weather_join", f"WITH {SHIP}, {WEATHER} SELECT l_orderkey, l_linenumber, CAST(datetime AS VARCHAR) AS datetime, ROUND(temperature_2m, 6) AS wx_temperature_2m,"
       " ROUND(precipitation, 6) AS wx_precipitation, cloud_cover AS wx_cloud_cover FROM ship LEFT JOIN wx ON hour_utc = date_trunc('hour', datetime)")
def _(spark, sf):
    weather = external.unpivot_weather(weather_docs(spark, sf), variables=VARS)
    return plain(external.join_weather(shipping(spark, sf), weather))


@query("weather_overlap_join", f"""WITH {SHIP}, {WEATHER}, twice AS (SELECT hour_utc, temperature_2m FROM wx UNION ALL SELECT hour_utc, temperature_2m + 1 FROM wx),
 one AS (SELECT hour_utc, AVG(temperature_2m) AS temperature_2m FROM twice GROUP BY 1)
 SELECT l_orderkey, l_linenumber, ROUND(temperature_2m, 6) AS wx_temperature_2m FROM ship LEFT JOIN one ON hour_utc = date_trunc('hour', datetime)""")
def _(spark, sf):
    """Two documents for every hour, one of them a degree warmer: no sale is repeated."""
    once = external.unpivot_weather(weather_docs(spark, sf), variables=("temperature_2m",))
    both = once.unionByName(once.withColumn("temperature_2m", F.col("temperature_2m") + 1))
    return plain(external.join_weather(shipping(spark, sf), both).select("l_orderkey", "l_linenumber", "wx_temperature_2m"))


@query("tx_holiday_join", f"WITH {SHIP}, {HOLIDAYS} SELECT l_orderkey, l_linenumber, CAST(datetime AS VARCHAR) AS datetime, CAST(CAST(datetime AS DATE) AS VARCHAR) AS date_local,"
       " h.date IS NOT NULL AS is_holiday, CASE WHEN h.date IS NOT NULL THEN 'Holiday ' || h.date END AS holiday_name FROM ship LEFT JOIN hol h ON h.date = CAST(datetime AS DATE)")
def _(spark, sf):
    holidays = external.public_holidays(holiday_docs(spark, sf))
    return plain(external.join_holidays(shipping(spark, sf), holidays))


# Berlin clock: forward on the last Sunday of March at 01:00 UTC, back at 01:00 UTC on the last
# Sunday of October (of September until 1995).
_SPRING = "(make_date(year(datetime), 3, 31) - CAST(isodow(make_date(year(datetime), 3, 31)) % 7 AS INTEGER))"
_LAST = "(CASE WHEN year(datetime) < 1996 THEN make_date(year(datetime), 9, 30) ELSE make_date(year(datetime), 10, 31) END)"
_AUTUMN = f"({_LAST} - CAST(isodow({_LAST}) % 7 AS INTEGER))"
CLOCK = f"z AS (SELECT *, CAST({_SPRING} AS TIMESTAMP) AS s, CAST({_AUTUMN} AS TIMESTAMP) AS a FROM ship)"


@query("tz_hour_floor", f"""WITH {SHIP}, {CLOCK}
 SELECT l_orderkey, l_linenumber, CAST(CASE WHEN datetime >= a + INTERVAL 2 HOUR AND datetime < a + INTERVAL 3 HOUR THEN NULL
 WHEN datetime >= s + INTERVAL 2 HOUR AND datetime < s + INTERVAL 3 HOUR THEN s + INTERVAL 1 HOUR
 WHEN datetime >= s + INTERVAL 3 HOUR AND datetime < a + INTERVAL 2 HOUR THEN date_trunc('hour', datetime - INTERVAL 2 HOUR)
 ELSE date_trunc('hour', datetime - INTERVAL 1 HOUR) END AS VARCHAR) AS hour_utc FROM z""")
def _(spark, sf):
    return plain(shipping(spark, sf).select("l_orderkey", "l_linenumber", local_hour_utc("datetime", ZONE).alias("hour_utc")))


@query("local_weather_join", f"""WITH {SHIP}, {WEATHER}, {CLOCK}, hours AS (
 SELECT l_orderkey, l_linenumber, CASE WHEN datetime >= a + INTERVAL 2 HOUR AND datetime < a + INTERVAL 3 HOUR THEN NULL
 WHEN datetime >= s + INTERVAL 2 HOUR AND datetime < s + INTERVAL 3 HOUR THEN s + INTERVAL 1 HOUR
 WHEN datetime >= s + INTERVAL 3 HOUR AND datetime < a + INTERVAL 2 HOUR THEN date_trunc('hour', datetime - INTERVAL 2 HOUR)
 ELSE date_trunc('hour', datetime - INTERVAL 1 HOUR) END AS hour_utc FROM z)
 SELECT l_orderkey, l_linenumber, ROUND(temperature_2m, 6) AS wx_temperature_2m FROM hours LEFT JOIN wx USING (hour_utc)""")
def _(spark, sf):
    """Local wall clocks across both clock changes; an ambiguous hour has no weather."""
    weather = external.unpivot_weather(weather_docs(spark, sf), variables=("temperature_2m",))
    return plain(external.join_weather(shipping(spark, sf), weather, zone=ZONE).select("l_orderkey", "l_linenumber", "wx_temperature_2m"))


@query("dst_flag", f"""WITH {SHIP}, {CLOCK}
 SELECT l_orderkey, l_linenumber, datetime >= s + INTERVAL 1 HOUR AND datetime < a + INTERVAL 1 HOUR AS is_dst FROM z""")
def _(spark, sf):
    return shipping(spark, sf).select("l_orderkey", "l_linenumber", is_dst("datetime", ZONE).alias("is_dst"))
