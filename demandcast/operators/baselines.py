"""Baseline forecasters: last value, weekly replay, 7-day mean."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.operators.splits import ends_segment, origin_list, segment, testing_origins, training_origins

BASELINES = ("naive1", "snaive7", "ma7")


def _mean_known(values: Column) -> Column:
    known = F.filter(values, lambda v: v.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda a, v: a + v)
    return F.try_divide(total, F.size(known))


def baseline_forecasts(panel: DataFrame, origins: DataFrame, y: str = "y", key: Sequence[str] = ("product",),
                       time: str = "date", season: int = 7,
                       models: Sequence[str] = BASELINES) -> DataFrame:
    """Backtest rows of the baselines: every truth row with its forecast per origin.

    Only the last ``season`` rows of each (series, segment) can matter to any origin, so the
    panel shrinks to a few rows per series before anything is repeated per origin. Those rows
    and the truth rows meet in one group per (series, origin), whose arrays hold at most
    ``season`` and ``horizon`` items; no join is involved. A series without history keeps its
    truth rows with ``h`` and ``yhat`` NULL.
    """
    rows = panel.select(*key, time, F.col(y).cast("double").alias("_y")).withColumn("_origins", origin_list(origins))
    rows = rows.withColumn("_seg", segment(time))
    rows = rows.withColumn("_recent", ends_segment(Window.partitionBy(*key).orderBy(time), season))

    def roles(which: Column, role: int) -> Column:
        return F.transform(which, lambda o: F.struct(
            o["origin_id"].alias("origin_id"), o["test_start"].alias("test_start"), F.lit(role).alias("role")))

    none = F.filter(F.col("_origins"), lambda o: F.lit(False))
    uses = F.concat(
        roles(F.when(F.col("_recent"), training_origins(F.col("_seg"))).otherwise(none), 0),
        roles(testing_origins(time), 1),
    )
    used = rows.withColumn("_u", F.explode(uses)).select(*key, time, "_y", "_u.origin_id", "_u.test_start", "_u.role")
    point = F.struct(F.col(time).alias("d"), F.col("_y").alias("y"))
    grouped = used.groupBy(*key, "origin_id", "test_start").agg(
        F.slice(F.sort_array(F.collect_list(F.when(F.col("role") == 0, point)), False), 1, season).alias("_tail"),
        F.collect_list(F.when(F.col("role") == 1, point)).alias("_truth"),
    )
    truth = grouped.withColumn("_t", F.explode("_truth")).withColumn("_n", F.size("_tail")).withColumn(
        "_h", F.datediff("_t.d", "test_start") + 1)
    last = F.get("_tail", F.lit(0))["y"]
    replay = F.get("_tail", F.lit(season - 1) - F.pmod(F.col("_h") - 1, F.lit(season)))["y"]
    yhat = {
        "naive1": last,
        "snaive7": F.when(F.col("_n") < season, last).otherwise(replay),
        "ma7": _mean_known(F.transform("_tail", lambda s: s["y"])),
    }
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), yhat[m].alias("yhat")) for m in models]))
    return truth.withColumn("_m", each).select(
        "origin_id", F.col("_t.d").alias("date"), *key,
        F.when(F.col("_n") > 0, F.col("_h")).alias("h"), F.col("_t.y").alias("y"),
        F.col("_m.yhat").alias("yhat"), F.lit(None).cast("double").alias("yhat_p10"),
        F.lit(None).cast("double").alias("yhat_p90"), F.col("_m.model").alias("model"),
    )


def mean7_forecast(series: DataFrame, horizon: int = 15, y: str = "amount", key: Sequence[str] = ("product",),
                   time: str = "date", n: int = 7, align_to: Column | None = None) -> DataFrame:
    """Mean of the last ``n`` known values, repeated from each series' own last date + 1.

    ``align_to`` starts every series after one common date instead. A series without any
    known value forecasts 0 from its last row on.
    """
    w = Window.partitionBy(*key).orderBy(F.col(y).isNull(), F.col(time).desc())
    tail = series.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    level = tail.groupBy(*key).agg(
        F.coalesce(F.avg(y), F.lit(0.0)).alias("forecast"),
        F.coalesce(F.max(F.when(F.col(y).isNotNull(), F.col(time))), F.max(time)).alias("_last"))
    start = F.col("_last") if align_to is None else align_to
    return level.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).select(
        *key, F.date_add(start, F.col("h")).alias("date"), "h", "forecast")
