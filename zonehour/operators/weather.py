"""C4: fixed-position weather text -> typed hourly observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonehour.config import WeatherSpec
from zonehour.functions.columns import (
    local_date,
    local_hour,
    normalize_text,
    precipitation,
    rain_flag,
    scaled,
    to_local,
    utc_timestamp,
)
from zonehour.operators.trips import date_window

# --- fixed values: column order of the clean weather table ---
WEATHER_CLEAN_COLUMNS = (
    "station_id",
    "source_path_normalized",
    "observation_ts_utc",
    "observation_ts_local",
    "observation_date_local",
    "observation_hour_local",
    "air_temp_c",
    "dew_point_c",
    "sea_level_pressure_hpa",
    "wind_direction_degrees",
    "wind_speed_mps",
    "sky_cover_code",
    "precipitation_1hr_mm",
    "precipitation_6hr_mm",
    "is_rain_1hr",
)


def weather_records(lines: DataFrame, spec: WeatherSpec = WeatherSpec(), path_col: str = "source_path") -> DataFrame:
    """A record of every line, split on whitespace runs after a trim, with
    the number of its tokens (``_tokens``). Each token is cast by position; a
    non-numeric or missing token becomes null, extra tokens are ignored.
    """
    parts = F.split(F.trim(F.col("value")), r"\s+")
    tokens = lines.select(F.col(path_col).alias("_path"), parts.alias("_parts"))
    record = F.struct(
        F.size("_parts").alias("_tokens"),
        F.regexp_extract("_path", spec.station_pattern, 1).alias("station_id"),
        normalize_text("_path").alias("source_path_normalized"),
        *[F.get("_parts", i).try_cast("int").alias(name) for i, name in enumerate(spec.fields)],
    )
    # One parsed record per line, emitted through a generator. Filters on the
    # record (the token count in parse_weather, the local-date window in
    # clean_weather) run above it instead of being pushed below, so the regex
    # split runs once per line, not once per field a filter references.
    return tokens.select(F.inline(F.array(record)))


def parse_weather(lines: DataFrame, spec: WeatherSpec = WeatherSpec(), path_col: str = "source_path") -> DataFrame:
    """P2 + F3: the records of the lines with at least ``min_tokens`` tokens.

    Output: station_id ('' when the path carries none), source_path_normalized,
    then the twelve integer fields.
    """
    return weather_records(lines, spec, path_col).where(F.col("_tokens") >= spec.min_tokens).drop("_tokens")


def decode_weather(parsed: DataFrame, spec: WeatherSpec = WeatherSpec()) -> DataFrame:
    """P8/P9 on the parsed fields (used by cleaning and profiling)."""
    return parsed.select(
        "*",
        scaled("air_temp_tenths_c", spec.missing, spec.scale).alias("air_temp_c"),
        scaled("dew_point_tenths_c", spec.missing, spec.scale).alias("dew_point_c"),
        scaled("sea_level_pressure_tenths_hpa", spec.missing, spec.scale).alias("sea_level_pressure_hpa"),
        scaled("wind_speed_tenths_mps", spec.missing, spec.scale).alias("wind_speed_mps"),
        precipitation("precipitation_1hr_tenths_mm", spec.missing, spec.trace, spec.trace_mm, spec.scale).alias(
            "precipitation_1hr_mm"
        ),
        precipitation("precipitation_6hr_tenths_mm", spec.missing, spec.trace, spec.trace_mm, spec.scale).alias(
            "precipitation_6hr_mm"
        ),
    )


def local_timestamp(spec: WeatherSpec = WeatherSpec()) -> Column:
    """P6 + P7 of a parsed line: its wall clock in the local zone."""
    return to_local(utc_timestamp("year", "month", "day", "hour_utc"), spec.local_zone)


def clean_weather(lines: DataFrame, spec: WeatherSpec = WeatherSpec(), path_col: str = "source_path") -> DataFrame:
    """C4. Timestamps are TIMESTAMP_NTZ wall clocks: the UTC hour is built
    from its parts (impossible dates -> null), then shifted to the local
    zone; the local date decides the window, which also drops null dates.
    Wind direction and sky cover keep their sentinel."""
    decoded = decode_weather(parse_weather(lines, spec, path_col), spec)
    ts_local = local_timestamp(spec)
    own = {
        "observation_ts_utc": utc_timestamp("year", "month", "day", "hour_utc"),
        "observation_ts_local": ts_local,
        "observation_date_local": local_date(ts_local),
        "observation_hour_local": local_hour(ts_local),
        "is_rain_1hr": rain_flag("precipitation_1hr_mm"),
    }
    return date_window(decoded.withColumns(own).select(*WEATHER_CLEAN_COLUMNS), "observation_ts_local", spec.window)
