"""Per-series forecasters: additive trend and season, and seasonal autoregression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.constants import DEFAULT_FUTURE_EXOG, KNOWN_EXOG
from demandcast.functions.columns import col
from demandcast.models.linear import dot, solve_packed, summarise_per_origin
from demandcast.operators.clean import fill_both_ways
from demandcast.operators.splits import (
    ends_segment, final_origin, future_days, origin_list, segment, testing_origins, training_origins,
)

DEFAULT_HORIZON = 7  # days of a request that names none
Z80 = 1.2815515655446004  # half-width of an 80 % normal interval, in deviations


def known_regressors(columns: Sequence[str], names: Sequence[str] = KNOWN_EXOG) -> list[str]:
    return [c for c in names if c in columns]


def prepare_series(panel: DataFrame, origins: DataFrame, regressors: Sequence[str], y: str = "y",
                   key: Sequence[str] = ("product",), time: str = "date") -> DataFrame:
    """Panel with filled target ``_v`` and regressors, its origins and training segment.

    A leading gap is filled backwards from the first known value, so such a row only becomes
    training data once that value has been seen: its segment goes by the later of both dates.
    A regressor that is never known counts as 0, which the solver treats as absent.
    """
    keep = panel.select(*key, time, F.col(y).cast("double").alias("y"), F.col(y).cast("double").alias("_v"),
                        *[col(c).cast("double").alias(c) for c in regressors])
    series = Window.partitionBy(*key).orderBy(time).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first_known = F.min(F.when(F.col("_v").isNotNull(), F.col(time))).over(series)
    rows = keep.withColumn("_ready", F.greatest(F.col(time), first_known))
    rows = fill_both_ways(rows, ["_v", *regressors], key, time).fillna(0.0, list(regressors))
    return rows.withColumn("_origins", origin_list(origins)).withColumn("_seg", segment("_ready"))


def _forecast_schema(df: DataFrame, key: Sequence[str], time: str, model: str) -> DataFrame:
    return df.select("origin_id", F.col(time).alias("date"), *key, F.col("h").cast("int").alias("h"), "y", "yhat",
                     "yhat_p10", "yhat_p90", F.lit(model).alias("model"))


def _truth_rows(regressors: Sequence[str], time: str) -> tuple[Column, Column, Column]:
    """Test rows to keep next to the sums: at most horizon rows per series and origin."""
    x = F.array(*[col(c) for c in regressors]) if regressors else F.array().cast("array<double>")
    point = F.struct(F.col(time).alias("d"), F.col("y").alias("y"), x.alias("x"))
    return F.size(testing_origins(time)) > 0, point, F.lit(True)


def _days_of_origin() -> Column:
    """The kept test rows that fall into the origin's own window, by date."""
    return F.sort_array(F.filter("_truth", lambda s: s["d"].between(F.col("test_start"), F.col("test_end"))))


# --- additive -----------------------------------------------------------------------------

def additive_design(regressors: Sequence[str], time: str = "date", zero: str = "2000-01-01") -> list[Column]:
    """Intercept, linear trend in years, six weekday dummies, regressors."""
    t = F.datediff(F.col(time), F.lit(zero).cast("date")) / 365.25
    return [F.lit(1.0), t, *[(F.weekday(time) == d).cast("double") for d in range(1, 7)],
            *[col(c) for c in regressors]]


def additive_forecasts(panel: DataFrame, origins: DataFrame, regressors: Sequence[str] | None = None, y: str = "y",
                       key: Sequence[str] = ("product",), time: str = "date", model: str = "additive") -> DataFrame:
    """Backtest of the additive model with an 80 % band; series without a fit give NULLs."""
    regressors = known_regressors(panel.columns) if regressors is None else list(regressors)
    rows = prepare_series(panel, origins, regressors, y, key, time)
    design = additive_design(regressors, time)
    fits = solve_packed(summarise_per_origin(rows, design, F.col("_v"), key, F.col("_seg"),
                                             {"_truth": _truth_rows(regressors, time)}), len(design))
    each = fits.withColumn("_day", F.explode(_days_of_origin())).withColumns({
        time: F.col("_day.d"), "y": F.col("_day.y"), "h": F.datediff("_day.d", "test_start") + 1,
        **{c: F.get("_day.x", F.lit(i)) for i, c in enumerate(regressors)}})
    yhat = dot("coef", design)
    return _forecast_schema(each.withColumns({
        "yhat": yhat, "yhat_p10": yhat - Z80 * F.col("sigma"), "yhat_p90": yhat + Z80 * F.col("sigma")}),
        key, time, model)


def fit_additive(panel: DataFrame, origins: DataFrame, regressors: Sequence[str], y: str = "y",
                 key: Sequence[str] = ("product",), time: str = "date") -> DataFrame:
    """Coefficients of the additive model per series and origin."""
    rows = prepare_series(panel, origins, regressors, y, key, time)
    design = additive_design(regressors, time)
    return solve_packed(summarise_per_origin(rows, design, F.col("_v"), key, F.col("_seg")), len(design))


def additive_outlook(panel: DataFrame, horizon: int = 7, regressors: Sequence[str] | None = None, y: str = "y",
                     key: Sequence[str] = ("product",), time: str = "date", known: DataFrame | None = None) -> DataFrame:
    """Refit on the full history and forecast the days after it, per series.

    ``known`` supplies regressors of future days (key, date, regressors); without it the last
    known values carry on.
    """
    regressors = known_regressors(panel.columns) if regressors is None else list(regressors)
    origin = final_origin(panel, horizon, time)
    fits = fit_additive(panel, origin, regressors, y, key, time).where(F.col("coef").isNotNull())
    future = future_days(fits.select(*key, "coef", "sigma"), origin)
    if regressors:
        newest = panel.groupBy(*key).agg(*[F.max_by(col(c), F.when(col(c).isNotNull(), F.col(time))).alias(f"_{c}")
                                           for c in regressors])
        if known is not None:
            future = future_regressors(future, known, regressors, key, time)
        else:
            future = future.withColumns({c: F.lit(None).cast("double") for c in regressors})
        future = future.join(newest, list(key), "left").withColumns(
            {c: F.coalesce(col(c).cast("double"), col(f"_{c}").cast("double"), F.lit(0.0)) for c in regressors})
    yhat = dot("coef", additive_design(regressors, time))
    out = future.withColumns({"y": F.lit(None).cast("double"), "yhat": yhat, "yhat_p10": yhat - Z80 * F.col("sigma"),
                              "yhat_p90": yhat + Z80 * F.col("sigma")})
    return _forecast_schema(out, key, time, "additive")


def additive_residuals(panel: DataFrame, origins: DataFrame, regressors: Sequence[str] | None = None, y: str = "y",
                       key: Sequence[str] = ("product",), time: str = "date") -> DataFrame:
    """Training residuals of the additive fit, per origin."""
    regressors = known_regressors(panel.columns) if regressors is None else list(regressors)
    rows = prepare_series(panel, origins, regressors, y, key, time)
    fits = fit_additive(panel, origins, regressors, y, key, time).select(*key, "origin_id", "coef")
    train = rows.where(F.col("y").isNotNull()).withColumn("_o", F.explode(training_origins(F.col("_seg")))).withColumn(
        "origin_id", F.col("_o.origin_id"))
    return train.join(fits, [*key, "origin_id"]).select(
        *key, "origin_id", time, (F.col("y") - dot("coef", additive_design(regressors, time))).alias("residual"))


# --- seasonal autoregression --------------------------------------------------------------

def fit_seasonal_ar(panel: DataFrame, origins: DataFrame, regressors: Sequence[str], y: str = "y",
                    key: Sequence[str] = ("product",), time: str = "date", season: int = 7) -> DataFrame:
    """Conditional least squares on lags 1 and ``season`` plus regressors.

    One row per series and origin: coefficients, the last ``season`` filled training values
    (``tail``, oldest first), the last training date and the test rows. Lags, sums, tail and
    test rows come from one pass over the panel partitioned by series.
    """
    rows = prepare_series(panel, origins, regressors, y, key, time)
    w = Window.partitionBy(*key).orderBy(time)
    lagged = rows.withColumns({"_l1": F.lag("_v", 1).over(w), "_ls": F.lag("_v", season).over(w),
                               "_recent": ends_segment(w, season)})
    x = [F.lit(1.0), F.col("_l1"), F.col("_ls"), *[col(c) for c in regressors]]
    point = F.struct(F.col(time).alias("d"), F.col("_v").alias("v"))
    fits = solve_packed(summarise_per_origin(lagged, x, F.col("_v"), key, F.col("_seg"), {
        "_truth": _truth_rows(regressors, time),
        "_tail": (F.col("_recent"), point, F.col("_seg") <= F.col("_i")),
    }), len(x))
    recent = F.slice(F.sort_array("_tail", False), 1, season)
    full = F.size("_tail") >= season
    return fits.withColumns({
        "tail": F.when(full, F.reverse(F.transform(recent, lambda s: s["v"]))),
        "last_date": F.array_max(F.transform("_tail", lambda s: s["d"])), "_days": _days_of_origin(),
    }).drop("_tail", "_truth")


def iterate_ar(coef: Column, tail: Column, steps: Column, season: int = 7) -> Column:
    """Feed forecasts back in: ``steps`` is an array with one regressor array per day.

    Returns the forecasts in order, evaluated inside the JVM.
    """
    def next_value(past: Column, x: Column) -> Column:
        beta = F.slice(coef, 4, F.greatest(F.size(coef) - 3, F.lit(0)))
        effect = F.aggregate(F.zip_with(beta, x, lambda b, v: b * v), F.lit(0.0), lambda a, v: a + v)
        n = F.size(past)
        return (F.get(coef, F.lit(0)) + F.get(coef, F.lit(1)) * F.get(past, n - 1)
                + F.get(coef, F.lit(2)) * F.get(past, n - season) + effect)

    path = F.aggregate(steps, tail, lambda past, x: F.concat(past, F.array(next_value(past, x))))
    return F.slice(path, F.size(tail) + 1, F.size(steps))


def ar_spread(coef: Column, sigma: Column, horizon: Column, season: int = 7) -> Column:
    """Forecast deviation per step from the impulse response of the fitted recursion."""
    phi, seasonal = F.get(coef, F.lit(1)), F.get(coef, F.lit(2))
    one = F.array(F.lit(1.0))
    psi = F.aggregate(F.sequence(F.lit(1), horizon), one, lambda a, j: F.concat(a, F.array(
        phi * F.get(a, j - 1) + F.coalesce(seasonal * F.get(a, F.when(j >= season, j - season)), F.lit(0.0)))))
    return F.transform(F.sequence(F.lit(1), horizon), lambda h: sigma * F.sqrt(F.aggregate(
        F.slice(psi, 1, h), F.lit(0.0), lambda a, p: a + p * p)))


def seasonal_ar_forecasts(panel: DataFrame, origins: DataFrame, regressors: Sequence[str] | None = None, y: str = "y",
                          key: Sequence[str] = ("product",), time: str = "date", season: int = 7,
                          model: str = "seasonal_ar") -> DataFrame:
    """Backtest of the seasonal autoregression, iterated over the horizon, with an 80 % band."""
    regressors = known_regressors(panel.columns) if regressors is None else list(regressors)
    fits = fit_seasonal_ar(panel, origins, regressors, y, key, time, season)
    # One step per calendar day of the test window: a day without a truth row takes the regressors of the
    # last day that has one, or of the first.
    def known(d: Column) -> Column:
        before = F.filter("_days", lambda s: s["d"] <= d)
        return F.coalesce(F.get(before, F.size(before) - 1)["x"], F.get("_days", F.lit(0))["x"])

    days = fits.where(F.size("_days") > 0).withColumn("_steps", F.transform(F.sequence("test_start", "test_end"), known))
    scored = days.withColumns({
        "_path": iterate_ar(F.col("coef"), F.col("tail"), F.col("_steps"), season),
        "_sd": ar_spread(F.col("coef"), F.col("sigma"), F.size("_steps"), season),
    })
    flat = scored.select(*key, "origin_id", "test_start", "_path", "_sd", F.explode("_days").alias("_day")).withColumn(
        "_i", F.datediff("_day.d", "test_start"))
    yhat, sd = F.get("_path", F.col("_i")), F.get("_sd", F.col("_i"))
    out = flat.withColumns({time: F.col("_day.d"), "h": F.datediff("_day.d", "test_start") + 1, "y": F.col("_day.y"), "yhat": yhat,
                            "yhat_p10": yhat - Z80 * sd, "yhat_p90": yhat + Z80 * sd})
    return _forecast_schema(out, key, time, model)


# --- final fit and batch scoring ----------------------------------------------------------

def final_parameters(panel: DataFrame, origins: DataFrame, regressors: Sequence[str] | None = None, y: str = "y",
                     key: Sequence[str] = ("product",), time: str = "date", season: int = 7,
                     version: str = "final") -> DataFrame:
    """Seasonal autoregression refitted on the full history: one parameter row per series.

    ``origins`` holds the single final origin. Pass a daily total with a constant key to get
    the all-series model.
    """
    regressors = known_regressors(panel.columns) if regressors is None else list(regressors)
    fits = fit_seasonal_ar(panel, origins, regressors, y, key, time, season)
    return fits.where(F.col("coef").isNotNull() & F.col("tail").isNotNull()).select(
        F.lit("seasonal_ar").alias("model"), F.lit(version).alias("version"), *key, "coef", "sigma", "n", "tail",
        "last_date", F.array(*[F.lit(c) for c in regressors]).cast("array<string>").alias("regressors"))


def default_exog(regressors: Sequence[str]) -> Column:
    """One default future exogenous row."""
    return F.array(*[F.lit(float(DEFAULT_FUTURE_EXOG.get(c, 0.0))) for c in regressors]).cast("array<double>")


def score_requests(requests: DataFrame, parameters: DataFrame, regressors: Sequence[str],
                   key: Sequence[str] = ("product",), season: int = 7, max_horizon: int = 30) -> DataFrame:
    """Batch scoring: ``(request_id, key, horizon, exog)`` to predictions or an error.

    ``exog`` is an array of structs with the regressor fields, one per day, or NULL for the
    default day repeated. A request without a horizon asks for ``DEFAULT_HORIZON`` days. A bad
    request keeps its row with ``error`` set.
    """
    requests = requests.withColumn("horizon", F.coalesce("horizon", F.lit(DEFAULT_HORIZON)))
    vectors = F.transform("exog", lambda e: F.array(*[e[c].cast("double") for c in regressors]))
    filled = F.when(F.col("exog").isNull(), F.array_repeat(
        default_exog(regressors), F.least(F.greatest("horizon", F.lit(0)), F.lit(max_horizon))
    )).otherwise(vectors)
    bad_horizon = ~F.col("horizon").between(1, max_horizon)
    has_null = F.exists("_x", lambda v: F.exists(v, lambda e: e.isNull()))
    checked = requests.withColumn("_x", filled).join(parameters, list(key), "left")
    error = F.when(bad_horizon, F.lit(f"horizon must be 1..{max_horizon}")).when(
        F.size("_x") != F.col("horizon"), F.lit("exog needs one row per day")).when(
        has_null, F.lit("exog has missing values")).when(F.col("coef").isNull(), F.lit("no fitted model"))
    scored = checked.withColumn("error", error)
    path = F.when(F.col("error").isNull(), iterate_ar(F.col("coef"), F.col("tail"), F.col("_x"), season))
    return scored.select("request_id", *key, "horizon", path.alias("predictions"), "version",
                         F.when(F.col("error").isNull(), F.col("model")).alias("model_type"), "error", "last_date")


def future_regressors(future: DataFrame, panel: DataFrame, regressors: Sequence[str],
                      key: Sequence[str] = ("product",), time: str = "date") -> DataFrame:
    """Future days with the regressors known for them (one row per day), gaps filled both ways."""
    known = panel.groupBy(*key, time).agg(*[F.max(col(c)).alias(c) for c in regressors])
    joined = future.join(known, [*key, time], "left")
    series = [*key, *(["origin_id"] if "origin_id" in future.columns else [])]
    return fill_both_ways(joined, regressors, series, time)
