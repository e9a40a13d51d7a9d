"""Zone-hour demand x city-wide hourly weather."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonehour.config import ForecastSpec, ScaleSpec, WeatherSpec, window_days
from zonehour.functions.columns import day_of_week, weekend_flag

# --- fixed values: column order of the feature table ---
FEATURE_COLUMNS = (
    "pickup_date",
    "pickup_hour",
    "PULocationID",
    "trip_count",
    "avg_trip_distance",
    "avg_fare_amount",
    "avg_temp_c",
    "avg_wind_speed_mps",
    "avg_precipitation_1hr_mm",
    "is_rain_hour",
    "station_count",
    "day_of_week",
    "is_weekend",
)

# what hourly_demand and hourly_weather read
DEMAND_INPUT_COLUMNS = ("pickup_date", "pickup_hour", "PULocationID", "trip_distance", "fare_amount")
HOURLY_WEATHER_INPUT_COLUMNS = (
    "observation_date_local",
    "observation_hour_local",
    "station_id",
    "air_temp_c",
    "wind_speed_mps",
    "precipitation_1hr_mm",
    "is_rain_1hr",
)


def hourly_demand(trips: DataFrame) -> DataFrame:
    """A1: trips per (date, hour, zone) with mean distance and fare.

    Partial aggregation runs before the shuffle, so a zone holding a third of
    all trips sends one row per (date, hour) from each task, not its trips.
    Only observed zone-hours exist; empty ones are absent, not zero.
    """
    return trips.groupBy(
        F.col("pickup_date").cast("date").alias("pickup_date"), "pickup_hour", "PULocationID"
    ).agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.avg("trip_distance").alias("avg_trip_distance"),
        F.avg("fare_amount").alias("avg_fare_amount"),
    )


def hourly_weather(weather: DataFrame) -> DataFrame:
    """A2: one row per local (date, hour) over all stations and observations.
    Averages skip nulls, rain is the max flag, stations are counted distinct."""
    return weather.groupBy(
        F.col("observation_date_local").cast("date").alias("observation_date_local"),
        "observation_hour_local",
    ).agg(
        F.avg("air_temp_c").alias("avg_temp_c"),
        F.avg("wind_speed_mps").alias("avg_wind_speed_mps"),
        F.avg("precipitation_1hr_mm").alias("avg_precipitation_1hr_mm"),
        F.max("is_rain_1hr").alias("is_rain_hour"),
        F.count_distinct("station_id").alias("station_count"),
    )


def weather_rows_bound(spec: WeatherSpec) -> int | None:
    """Upper bound on rows of ``hourly_weather`` after cleaning with ``spec``:
    at most 24 local hours per day of the window (also across DST changes).
    None when the window is open."""
    days = window_days(spec.window)
    return None if days is None else 24 * days


def build_features(
    demand: DataFrame,
    weather_hourly: DataFrame,
    forecast: ForecastSpec = ForecastSpec(),
    weather_spec: WeatherSpec | None = None,
    scale: ScaleSpec = ScaleSpec(),
    weather_rows: int | None = None,
) -> DataFrame:
    """LEFT join demand to weather on (date, hour) only (weather is
    city-wide), add calendar features, fill the listed columns.

    No row of either side is filtered. The weather side has one row per local
    (date, hour). Its size is known from ``weather_rows`` (a counted table),
    or from ``weather_spec`` when the weather was cleaned with that window: at
    most 24 rows per day. That many rows times a row-size bound is compared
    with ``scale.broadcast_bytes``. Under it the side is broadcast, and the
    demand side, the only one that grows with trip volume, is never shuffled
    for the join. Otherwise the planner decides at runtime (AQE).
    """
    w = weather_hourly.withColumnRenamed("observation_date_local", "pickup_date").withColumnRenamed(
        "observation_hour_local", "pickup_hour"
    )
    bound = weather_rows
    if bound is None and weather_spec is not None:
        bound = weather_rows_bound(weather_spec)
    if bound is not None and bound * scale.row_bytes_bound <= scale.broadcast_bytes:
        w = F.broadcast(w)
    joined = demand.join(w, ["pickup_date", "pickup_hour"], "left")
    dow = day_of_week("pickup_date")
    with_cal = joined.withColumn("day_of_week", dow).withColumn("is_weekend", weekend_flag("day_of_week"))
    filled = with_cal.na.fill(dict(forecast.fill))
    return filled.select(*FEATURE_COLUMNS)
