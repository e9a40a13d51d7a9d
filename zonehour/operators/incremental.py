"""A1, A2 and C5 kept up to date batch by batch.

A state holds what averages are made of (counts and sums by hour, the set of
stations), so states of any batches add up. Each batch is a folder of its own:
running one again replaces it, and nothing is counted twice after a failure.
Averages are taken when the states are read.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonehour.sources.sinks import write_partitioned

DEMAND_KEYS = ("pickup_date", "pickup_hour", "PULocationID")
WEATHER_KEYS = ("observation_date_local", "observation_hour_local")
DEMAND_MEANS = {"trip_distance": "avg_trip_distance", "fare_amount": "avg_fare_amount"}
WEATHER_MEANS = {"air_temp_c": "avg_temp_c", "wind_speed_mps": "avg_wind_speed_mps", "precipitation_1hr_mm": "avg_precipitation_1hr_mm"}


def _keyed(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return df.withColumn(keys[0], F.col(keys[0]).cast("date")).groupBy(*keys)


def _counts_and_sums(means: dict[str, str]) -> list:
    return [f(F.col(c)).alias(f"{name}_{c}") for c in means for f, name in ((F.count, "n"), (F.sum, "sum"))]


def demand_state(trips: DataFrame) -> DataFrame:
    """A1's state: trips, and count and sum of the non-null distances and
    fares, by date, hour and zone."""
    return _keyed(trips, DEMAND_KEYS).agg(F.count(F.lit(1)).alias("trip_count"), *_counts_and_sums(DEMAND_MEANS))


def weather_state(weather: DataFrame) -> DataFrame:
    """A2's state: counts and sums of the non-null values, the rain flag and
    the set of stations, by local date and hour."""
    return _keyed(weather, WEATHER_KEYS).agg(*_counts_and_sums(WEATHER_MEANS), F.max("is_rain_1hr").alias("is_rain_hour"), F.collect_set("station_id").alias("stations"))


def write_batch(state: DataFrame, path: str, batch: str) -> None:
    """The state of one batch, by date, in the folder of that batch alone; the
    same batch again replaces it."""
    dated = DEMAND_KEYS[0] if DEMAND_KEYS[0] in state.columns else WEATHER_KEYS[0]
    write_partitioned(state, f"{path.rstrip('/')}/batch={batch}", dated)


def read_states(spark: SparkSession, path: str, dates: tuple[str | date, str | date] | None = None) -> DataFrame:
    """The states of all batches, a row per batch and key. ``dates`` (first,
    last) reads only these dates' folders."""
    states = spark.read.option("basePath", path).parquet(path).drop("batch")
    if dates is None:
        return states
    dated = DEMAND_KEYS[0] if DEMAND_KEYS[0] in states.columns else WEATHER_KEYS[0]
    return states.where(F.col(dated).between(*[F.lit(d).cast("date") for d in dates]))


def _averages(means: dict[str, str]) -> list:
    # a group without values has a null average, as avg() gives
    return [(F.sum(f"sum_{c}") / F.nullif(F.sum(f"n_{c}"), F.lit(0))).alias(name) for c, name in means.items()]


def demand_of(states: DataFrame) -> DataFrame:
    """A1 from states: the rows of ``hourly_demand`` over all their trips."""
    return _keyed(states, DEMAND_KEYS).agg(F.sum("trip_count").alias("trip_count"), *_averages(DEMAND_MEANS))


def weather_of(states: DataFrame) -> DataFrame:
    """A2 from states: the rows of ``hourly_weather`` over all observations. A
    station that reports in several batches counts once."""
    stations = F.size(F.array_distinct(F.flatten(F.collect_list("stations"))))
    return _keyed(states, WEATHER_KEYS).agg(*_averages(WEATHER_MEANS), F.max("is_rain_hour").alias("is_rain_hour"), stations.cast("bigint").alias("station_count"))
