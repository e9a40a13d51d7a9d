from zonehour.sources.readers import (
    read_clean,
    read_trips,
    read_weather_lines,
    require_columns,
    stage_weather_lines,
    with_source_path,
)
from zonehour.sources.sinks import overwrite_dates, preview, sample_rows, write_metrics, write_partitioned, write_table

__all__ = [
    "overwrite_dates",
    "preview",
    "read_clean",
    "read_trips",
    "read_weather_lines",
    "require_columns",
    "sample_rows",
    "stage_weather_lines",
    "with_source_path",
    "write_metrics",
    "write_partitioned",
    "write_table",
]
