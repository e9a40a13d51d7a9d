from zonehour.functions.columns import (
    day_of_week,
    in_date_window,
    local_date,
    local_hour,
    normalize_text,
    precipitation,
    rain_flag,
    scaled,
    threshold_flag,
    to_local,
    utc_timestamp,
    weekend_flag,
)

__all__ = [
    "day_of_week",
    "in_date_window",
    "local_date",
    "local_hour",
    "normalize_text",
    "precipitation",
    "rain_flag",
    "scaled",
    "threshold_flag",
    "to_local",
    "utc_timestamp",
    "weekend_flag",
]
