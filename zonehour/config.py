"""Frozen configuration objects.

Every operator takes one of these instead of hard-coded names, so the same
code runs on the study month, on a decade of data, or on a test fixture.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date, timedelta


# --- fixed values: must equal the reference job's behaviour -----------------
# Study windows (inclusive), local zone and split date of the January 2024 run.
DEFAULT_TRIP_WINDOW = ("2024-01-01", "2024-01-31")
DEFAULT_WEATHER_WINDOW = ("2023-12-31", "2024-01-31")
DEFAULT_LOCAL_ZONE = "America/New_York"
DEFAULT_TRAIN_END = "2024-01-24"
# Trip flags: long trip when distance >= 5.0, high fare when fare >= 20.0.
LONG_TRIP_MILES = 5.0
HIGH_FARE_AMOUNT = 20.0
# Raw trip columns and their types.
RAW_TRIP_TYPES = (
    ("tpep_pickup_datetime", "timestamp_ntz"),
    ("VendorID", "bigint"),
    ("PULocationID", "bigint"),
    ("DOLocationID", "bigint"),
    ("passenger_count", "double"),
    ("trip_distance", "double"),
    ("RatecodeID", "bigint"),
    ("payment_type", "bigint"),
    ("store_and_fwd_flag", "string"),
    ("fare_amount", "double"),
    ("total_amount", "double"),
)
# Weather text: missing-value sentinel, trace-precipitation code and its value
# in mm, tenths scale, minimum token count, station id pattern in the path.
WEATHER_MISSING = -9999
WEATHER_TRACE = -1
WEATHER_TRACE_MM = 0.1
WEATHER_SCALE = 10.0
WEATHER_MIN_TOKENS = 12
STATION_PATTERN = r"([0-9]{6}-[0-9]{5}-[0-9]{4})"
# Weather line fields in file order.
WEATHER_FIELDS = (
    "year",
    "month",
    "day",
    "hour_utc",
    "air_temp_tenths_c",
    "dew_point_tenths_c",
    "sea_level_pressure_tenths_hpa",
    "wind_direction_degrees",
    "wind_speed_tenths_mps",
    "sky_cover_code",
    "precipitation_1hr_tenths_mm",
    "precipitation_6hr_tenths_mm",
)
# Linear model: feature order and solver settings.
DEFAULT_MODEL_FEATURES = (
    "PULocationID_ohe",
    "pickup_hour",
    "day_of_week",
    "is_weekend",
    "avg_temp_c",
    "avg_wind_speed_mps",
    "avg_precipitation_1hr_mm",
    "is_rain_hour",
    "station_count",
    "avg_trip_distance",
    "avg_fare_amount",
)
MODEL_MAX_ITER = 50
MODEL_REG_PARAM = 0.1
MODEL_ELASTIC_NET = 0.1
# Values written into the joined table where a column is null.
DEFAULT_FEATURE_FILL = (
    ("avg_temp_c", 0.0),
    ("avg_wind_speed_mps", 0.0),
    ("avg_precipitation_1hr_mm", 0.0),
    ("is_rain_hour", 0),
    ("station_count", 0),
    ("avg_trip_distance", 0.0),
    ("avg_fare_amount", 0.0),
)
# Model names in the metrics table.
BASELINE_MODEL_NAME = "baseline_zone_hour_mean"
LINEAR_MODEL_NAME = "weather_aware_linear_regression"
# --- end of fixed values -----------------------------------------------------

# Contract error messages.
MSG_MISSING_COLUMNS = "the {name} table lacks these columns: {columns}"
MSG_NO_USABLE_ROWS = "metrics need at least one row with both {prediction} and {label}"
MSG_NO_TRAIN_ROWS = "the training side is empty: no date up to {date}"
MSG_NO_TEST_ROWS = "the test side is empty: no date later than {date}"


def _as_date(value: str | date) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def window_days(window: tuple[str, str] | None) -> int | None:
    """Number of calendar days in an inclusive window, or None if open."""
    if window is None:
        return None
    lo, hi = (_as_date(v) for v in window)
    return (hi - lo).days + 1


def day_before(value: str | date) -> str:
    return (_as_date(value) - timedelta(days=1)).isoformat()


def day_after(value: str | date) -> str:
    return (_as_date(value) + timedelta(days=1)).isoformat()


@dataclass(frozen=True)
class TripSpec:
    """Raw trip column names, study window and flag thresholds."""

    pickup_ts: str = "tpep_pickup_datetime"
    pickup_zone: str = "PULocationID"
    dropoff_zone: str = "DOLocationID"
    passengers: str = "passenger_count"
    distance: str = "trip_distance"
    rate_code: str = "RatecodeID"
    payment: str = "payment_type"
    store_flag: str = "store_and_fwd_flag"
    fare: str = "fare_amount"
    total: str = "total_amount"
    vendor: str = "VendorID"
    window: tuple[str, str] | None = DEFAULT_TRIP_WINDOW
    long_trip_miles: float = LONG_TRIP_MILES
    high_fare_amount: float = HIGH_FARE_AMOUNT


@dataclass(frozen=True)
class WeatherSpec:
    """Fixed-position weather text layout, sentinels, zone and window."""

    local_zone: str = DEFAULT_LOCAL_ZONE
    window: tuple[str, str] | None = DEFAULT_WEATHER_WINDOW
    missing: int = WEATHER_MISSING
    trace: int = WEATHER_TRACE
    trace_mm: float = WEATHER_TRACE_MM
    scale: float = WEATHER_SCALE
    min_tokens: int = WEATHER_MIN_TOKENS
    station_pattern: str = STATION_PATTERN
    fields: tuple[str, ...] = WEATHER_FIELDS


@dataclass(frozen=True)
class ForecastSpec:
    """Split date, fill values and linear-model settings."""

    train_end: str = DEFAULT_TRAIN_END
    features: tuple[str, ...] = DEFAULT_MODEL_FEATURES
    fill: tuple[tuple[str, float | int], ...] = DEFAULT_FEATURE_FILL
    max_iter: int = MODEL_MAX_ITER
    reg_param: float = MODEL_REG_PARAM
    elastic_net: float = MODEL_ELASTIC_NET
    baseline_name: str = BASELINE_MODEL_NAME
    linear_name: str = LINEAR_MODEL_NAME


@dataclass(frozen=True)
class ScaleSpec:
    """Physical knobs that only matter at volume.

    ``broadcast_bytes`` caps the weather side of the feature join: the hourly
    weather table has at most 24 rows per day of the weather window, so its
    size is known before any job runs; above the cap the join is left to the
    planner (sort-merge, or an AQE runtime broadcast).
    ``row_bytes_bound`` is the per-row size used for that estimate.
    ``trips_layout`` / ``weather_layout`` choose how the clean tables are laid
    out on write (see ``sources.sinks.write_partitioned``). Both are
    rebalanced, which holds the number of files whatever the order of the
    input. ``trips_layout="local"`` writes without a shuffle, for raw files
    known to be in time order.
    """

    broadcast_bytes: int = 64 * 1024 * 1024
    row_bytes_bound: int = 128
    trips_layout: str = "rebalance"
    weather_layout: str = "rebalance"


@dataclass(frozen=True)
class Config:
    trips: TripSpec = field(default_factory=TripSpec)
    weather: WeatherSpec = field(default_factory=WeatherSpec)
    forecast: ForecastSpec = field(default_factory=ForecastSpec)
    scale: ScaleSpec = field(default_factory=ScaleSpec)

    def with_windows(
        self,
        trip_window: tuple[str, str] | None = None,
        weather_window: tuple[str, str] | None = None,
        train_end: str | None = None,
    ) -> "Config":
        cfg = self
        if trip_window is not None:
            cfg = replace(cfg, trips=replace(cfg.trips, window=trip_window))
        if weather_window is not None:
            cfg = replace(cfg, weather=replace(cfg.weather, window=weather_window))
        if train_end is not None:
            cfg = replace(cfg, forecast=replace(cfg.forecast, train_end=train_end))
        return cfg
