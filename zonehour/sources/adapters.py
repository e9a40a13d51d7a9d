"""Domain inputs derived from the driver's ``events`` table.

The test data holds no taxi or weather files, so both raw inputs are derived
row by row from ``events``: every non-error event is a trip, every error
event is one weather observation line. The mappings are SQL expressions that
run unchanged in Spark SQL and DuckDB, so the oracle queries start from the
same raw rows and re-implement only the operators under test.

The residues below are deterministic fault injection (nulls, sentinels,
short and long lines, impossible dates); no rows are sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonehour.session import file_identity, scratch_path
from zonehour.sources.readers import read_weather_lines

TRIP_EVENT_FILTER = "event_type <> 'error'"
WEATHER_EVENT_FILTER = "event_type = 'error'"

# Raw trip columns (FIXTURES section 3.1).
TRIP_COLUMNS: tuple[tuple[str, str], ...] = (
    ("tpep_pickup_datetime", "ts"),
    ("VendorID", "event_id % 2 + 1"),
    ("PULocationID", "user_id % 50"),
    ("DOLocationID", "event_id % 40"),
    ("passenger_count", "CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(event_id % 7 - 2 AS DOUBLE) + 0.5 END"),
    ("trip_distance", "value / 10.0"),
    ("RatecodeID", "CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_id % 6 + 1 END"),
    ("payment_type", "event_id % 4 + 1"),
    ("store_and_fwd_flag", "CASE event_id % 3 WHEN 0 THEN ' Y ' WHEN 1 THEN 'n' END"),
    ("fare_amount", "value - 5.0"),
    ("total_amount", "value - 4.0"),
)

# Weather observation fields as integers (FIXTURES section 3.2).
WEATHER_FIELD_EXPRS: tuple[tuple[str, str], ...] = (
    ("station_id", "CASE WHEN event_id % 2 = 0 THEN '744860-94789-2024' ELSE '725030-14732-2024' END"),
    ("event_id", "event_id"),
    ("f_year", "CAST(year(ts) AS INT)"),
    ("f_month", "CASE WHEN event_id % 43 = 0 THEN 2 ELSE CAST(month(ts) AS INT) END"),
    ("f_day", "CASE WHEN event_id % 43 = 0 THEN 31 ELSE CAST(day(ts) AS INT) END"),
    ("f_hour", "CAST(hour(ts) AS INT)"),
    ("f_temp", "CASE WHEN event_id % 11 = 0 THEN -9999 ELSE CAST(floor(value) AS INT) - 100 END"),
    ("f_dew", "CASE WHEN event_id % 17 = 0 THEN -9999 ELSE CAST(event_id % 200 - 100 AS INT) END"),
    ("f_pressure", "CASE WHEN event_id % 19 = 0 THEN -9999 ELSE CAST(10000 + event_id % 300 AS INT) END"),
    ("f_wind_dir", "CASE WHEN event_id % 23 = 0 THEN -9999 ELSE CAST(event_id % 36 * 10 AS INT) END"),
    ("f_wind_speed", "CASE WHEN event_id % 29 = 0 THEN -9999 ELSE CAST(event_id % 90 AS INT) END"),
    ("f_sky", "CASE WHEN event_id % 31 = 0 THEN -9999 ELSE CAST(event_id % 9 AS INT) END"),
    ("f_precip1", "CASE event_id % 5 WHEN 0 THEN -9999 WHEN 1 THEN -1 WHEN 2 THEN 0 ELSE CAST(event_id % 40 AS INT) END"),
    ("f_precip6", "CASE event_id % 7 WHEN 0 THEN -9999 WHEN 1 THEN -1 ELSE CAST(event_id % 60 AS INT) END"),
)

_FIELDS = "f_year, f_month, f_day, f_hour, f_temp, f_dew, f_pressure, f_wind_dir, f_wind_speed, f_sky, f_precip1, f_precip6"
_FMT12 = "%04d %02d %02d %02d %5d %5d %5d %5d %5d %5d %5d %5d"

# The text line: 5 tokens (malformed) when event_id % 37 = 0, a 13th token
# when event_id % 41 = 0, padding spaces around every third line.
WEATHER_LINE_EXPR = (
    "CASE WHEN event_id % 37 = 0 THEN printf('%04d %02d %02d %02d %5d', f_year, f_month, f_day, f_hour, f_temp) "
    f"WHEN event_id % 41 = 0 THEN printf('{_FMT12} %d', {_FIELDS}, 7) "
    f"WHEN event_id % 3 = 0 THEN concat('  ', printf('{_FMT12}', {_FIELDS}), ' ') "
    f"ELSE printf('{_FMT12}', {_FIELDS}) END"
)


def trips_from_events(events: DataFrame) -> DataFrame:
    """Raw trip rows (same column names and types as a yellow-taxi file)."""
    return events.where(TRIP_EVENT_FILTER).selectExpr(*[f"{expr} AS {name}" for name, expr in TRIP_COLUMNS])


def weather_line_rows(events: DataFrame) -> DataFrame:
    """(station_id, value) text rows, before they are written to files."""
    fields = events.where(WEATHER_EVENT_FILTER).selectExpr(*[f"{expr} AS {name}" for name, expr in WEATHER_FIELD_EXPRS])
    return fields.selectExpr("station_id", f"{WEATHER_LINE_EXPR} AS value")


_LINES_CACHE: dict[tuple[str, tuple], str] = {}


def write_weather_files(events: DataFrame, root: str) -> str:
    """Write the lines as gzip text, one directory per station (the station id
    is then part of every file path, as in the raw weather archive).
    Returns a glob over the files; ``root`` itself can be read recursively."""
    (
        weather_line_rows(events)
        .write.mode("overwrite")
        .option("compression", "gzip")
        .partitionBy("station_id")
        .text(root)
    )
    return f"{root}/*/*.gz"


def weather_lines_from_events(spark: SparkSession, events_path: str) -> DataFrame:
    """Weather lines read back from real gzip files through ``read_weather_lines``.

    The files go to the shared checkpoint folder and are written once per
    session and state of the input files (name, length, time).
    """
    key = (spark.sparkContext.applicationId, file_identity(spark, events_path))
    root = _LINES_CACHE.get(key)
    if root is None:
        root = scratch_path(spark, "weather-lines")
        write_weather_files(spark.read.parquet(events_path), root)
        _LINES_CACHE[key] = root
    return read_weather_lines(spark, root, recursive=True)
