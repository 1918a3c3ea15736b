"""Names, lookup tables, patterns and ranges that results depend on."""

# Weekday names, Monday first.
WEEKDAYS_ES = ("Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo")
WEEKDAYS_EN = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# Column-name synonyms, tried in this order.
DATETIME_SYNONYMS = (
    "datetime", "DateTime", "date_time", "timestamp", "ts", "fecha", "Fecha", "DATE", "Date",
)
TARGET_SYNONYMS = ("revenue", "units", "qty", "quantity", "sales", "target", "y_true")

# Columns of a saved forecast table, in order.
FORECAST_COLUMNS = ("date", "product", "h", "y", "yhat", "yhat_p10", "yhat_p90", "model")

# Exogenous columns understood by the per-series models.
KNOWN_EXOG = (
    "is_holiday", "is_holiday_prev", "is_holiday_next",
    "wx_temperature_2m", "wx_precipitation", "wx_cloudcover",
)

# Future exogenous row used when a caller supplies none.
DEFAULT_FUTURE_EXOG = {
    "is_holiday": 0, "is_holiday_prev": 0, "is_holiday_next": 0,
    "wx_temperature_2m": 22.0, "wx_precipitation": 0.5, "wx_cloudcover": 40.0,
}

# Metric names in reporting order, default selection priority, family order of a tie.
METRICS = ("MAE", "RMSE", "sMAPE", "MAPE", "COV_p10_p90_%")
METRIC_PRIORITY = ("sMAPE", "RMSE", "MAE", "MAPE")
FAMILY_ORDER = ("boosted_direct", "glm_direct", "additive", "seasonal_arma", "seasonal_ar", "sequence_direct", "baselines")
EXCLUDED_FROM_SIMPLE_BEST = ("baseline", "baselines", "ensemble")

# Recipes: grams or millilitres of each ingredient in one unit; and price per gram / ml.
RECIPES = {
    "Espresso": {"coffee_g": 18, "water_ml": 30, "sugar_g": 5},
    "Cappuccino": {"coffee_g": 18, "milk_ml": 150, "sugar_g": 10},
    "Latte": {"coffee_g": 18, "milk_ml": 200, "sugar_g": 10},
    "Americano": {"coffee_g": 18, "water_ml": 100, "sugar_g": 5},
    "Mocha": {"coffee_g": 18, "milk_ml": 150, "chocolate_g": 25, "sugar_g": 12},
    "Americano With Milk": {"coffee_g": 18, "water_ml": 80, "milk_ml": 50, "sugar_g": 8},
    "Cocoa": {"milk_ml": 200, "chocolate_g": 30, "sugar_g": 15},
    "Cortado": {"coffee_g": 18, "milk_ml": 50, "sugar_g": 5},
    "Hot Chocolate": {"milk_ml": 200, "chocolate_g": 25, "sugar_g": 15},
}
UNIT_COSTS = {
    "coffee_g": 1.0, "milk_ml": 0.04, "water_ml": 0.001, "chocolate_g": 0.4, "sugar_g": 0.05,
}

# Patterns of the quality report.
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
ISO_DATETIME_TZ = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:[+-]\d{2}:\d{2}|Z)$"
HAS_OFFSET = r"(?:[+-]\d{2}:\d{2}|Z)$"
ON_THE_HOUR = r"\d{2}:00:00(?:\.0+)?(?:[+-]\d{2}:\d{2}|Z)$"
ANONYMISED_CARD = r"^(?:ANON-[A-Z0-9]{4}-[A-Z0-9]{4}-[A-Z0-9]{4}|NaN|None|nan|\s*)$"
EMPTY_NAMES = ("", "nan", "none", "null")
PAYMENT_TYPES = ("card", "cash")

# Expected columns, integer-like columns, float columns, hard and physical ranges.
ENRICHED_COLUMNS = (
    "date", "datetime", "cash_type", "card", "money", "coffee_name", "year", "month", "day",
    "hour", "dow", "week", "month_sin", "month_cos", "hour_sin", "hour_cos", "_date_local",
    "dt_local", "wx_temperature_2m", "wx_apparent_temperature", "wx_dew_point_2m",
    "wx_relative_humidity_2m", "wx_pressure_msl", "wx_precipitation", "wx_rain",
    "wx_cloudcover", "wx_windspeed_10m", "wx_windgusts_10m", "is_holiday", "holiday_name",
)
INTEGER_COLUMNS = (
    "year", "month", "day", "hour", "dow", "week", "wx_relative_humidity_2m", "wx_cloudcover",
)
FLOAT_COLUMNS = (
    "money", "month_sin", "month_cos", "hour_sin", "hour_cos", "wx_temperature_2m",
    "wx_apparent_temperature", "wx_dew_point_2m", "wx_pressure_msl", "wx_precipitation",
    "wx_rain", "wx_windspeed_10m", "wx_windgusts_10m",
)
VALUE_RANGES = {
    "month": (1, 12), "day": (1, 31), "hour": (0, 23), "dow": (0, 6), "week": (1, 53),
    "wx_relative_humidity_2m": (0, 100), "wx_cloudcover": (0, 100),
}
PHYSICAL_RANGES = {
    "wx_temperature_2m": (-60, 60), "wx_apparent_temperature": (-80, 70),
    "wx_dew_point_2m": (-80, 40), "wx_pressure_msl": (850, 1100), "wx_precipitation": (0, 500),
    "wx_rain": (0, 500), "wx_windspeed_10m": (0, 200), "wx_windgusts_10m": (0, 250),
}

# Exogenous feature dictionary: daily variables, monthly variables and their windows.
DAILY_EXOG = ("tavg", "tmin", "tmax", "prcp", "snow", "wspd", "wpgt", "pres", "tsun")
MONTHLY_EXOG = (
    "prcp_mm_month", "snow_mm_month", "prcp_prob_month_%", "snow_prob_month_%", "clear_%",
    "mostly_clear_%", "partly_cloudy_%", "mostly_cloudy_%", "cloudy_%", "dry_%",
    "comfortable_%", "humid_%", "oppressive_%", "miserable_%", "other_%",
)
DAILY_LAGS = (1, 3, 7)
DAILY_ROLLS = (("mean", 7), ("sum", 7), ("sum", 14))
MONTHLY_LAGS = (30, 90)
MONTHLY_ROLLS = (("mean", 30), ("sum", 30), ("mean", 90), ("sum", 90))
SEASON_OF_MONTH = {
    12: "winter", 1: "winter", 2: "winter", 3: "spring", 4: "spring", 5: "spring",
    6: "summer", 7: "summer", 8: "summer", 9: "autumn", 10: "autumn", 11: "autumn",
}

# Characters replaced in run-log keys, applied in this order.
KEY_REPLACEMENTS = (("%", "pct"), (" ", "_"), ("(", "_"), (")", "_"), (":", "_"), (",", "_"))
