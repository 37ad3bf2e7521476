from aerolith.functions.rounding import half_away, half_even, half_up, mean
from aerolith.functions.rules import (
    alert_display,
    aqi_alert,
    aqi_category,
    deviation,
    deviation_display,
    exceedance,
    heat_index,
    is_anomaly,
    is_benign,
    pm25_to_aqi,
    temp_alert,
    weather_condition,
)
from aerolith.functions.sql import register_sql_functions

__all__ = [
    "alert_display",
    "aqi_alert",
    "aqi_category",
    "deviation",
    "deviation_display",
    "exceedance",
    "half_away",
    "half_even",
    "half_up",
    "heat_index",
    "is_anomaly",
    "is_benign",
    "mean",
    "pm25_to_aqi",
    "register_sql_functions",
    "temp_alert",
    "weather_condition",
]
