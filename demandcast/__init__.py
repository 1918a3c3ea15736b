"""Retail demand analytics and short-horizon forecasting as Spark DataFrame operators."""

from demandcast.config import ForecastConfig

__all__ = ["ForecastConfig"]
__version__ = "0.1.0"
