from zonehour.operators.features import build_features, hourly_demand, hourly_weather
from zonehour.operators.forecast import (
    baseline_forecast,
    evaluate,
    fit_linear,
    global_mean,
    linear_forecast,
    linear_pipeline,
    score_linear,
    split_counts,
    time_split,
    zone_hour_mean,
)
from zonehour.operators.metrics import compare_models, forecast_metrics, model_metrics
from zonehour.operators.profile import (
    distinct_values,
    keyed_count,
    mode_top,
    null_counts,
    numeric_range,
    numeric_stats,
    profile_trips,
    profile_weather,
    stage_counts,
    value_counts,
)
from zonehour.operators.trips import clean_trips, date_window, trip_rules, typed_trips, valid_trips, with_calendar
from zonehour.operators.weather import clean_weather, decode_weather, parse_weather

__all__ = [
    "baseline_forecast",
    "build_features",
    "clean_trips",
    "clean_weather",
    "compare_models",
    "date_window",
    "decode_weather",
    "distinct_values",
    "evaluate",
    "fit_linear",
    "forecast_metrics",
    "global_mean",
    "hourly_demand",
    "hourly_weather",
    "keyed_count",
    "linear_forecast",
    "linear_pipeline",
    "mode_top",
    "model_metrics",
    "null_counts",
    "numeric_range",
    "numeric_stats",
    "parse_weather",
    "profile_trips",
    "profile_weather",
    "score_linear",
    "split_counts",
    "stage_counts",
    "time_split",
    "trip_rules",
    "typed_trips",
    "valid_trips",
    "value_counts",
    "with_calendar",
    "zone_hour_mean",
]
