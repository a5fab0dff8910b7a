"""Revenue and contract-value forecasts as Spark DataFrame plans."""

from .plans.config import ForecastConfig, driver_config
from .plans.pipeline import build_forecasts, driver_forecasts

__all__ = ["ForecastConfig", "driver_config", "build_forecasts", "driver_forecasts"]
