"""The cleaning steps as incremental file-stream jobs.

The reference runs its cleaning as batch jobs over a month of files. The
same ``clean_trips`` / ``clean_weather`` functions are stateless
projections and filters, so they run unchanged on a streaming DataFrame:
new raw files landing in a folder are cleaned and appended to the
date-partitioned table, exactly once per file (the checkpoint records which
files were done). No aggregation or state is involved; the zone-hour
features are still built in batch from the clean tables.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from zonehour.config import TripSpec, WeatherSpec
from zonehour.operators.trips import clean_trips
from zonehour.operators.weather import clean_weather
from zonehour.sources.readers import with_source_path


def _start(df, sink_path: str, partition_col: str, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = (
        df.writeStream.format("parquet")
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(partition_col)
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def stream_clean_trips(
    spark: SparkSession,
    source_dir: str,
    schema: StructType,
    sink_path: str,
    spec: TripSpec = TripSpec(),
    *,
    checkpoint: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Raw trip parquet files arriving in ``source_dir`` -> trips_clean."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.parquet(source_dir)
    return _start(clean_trips(raw, spec), sink_path, "pickup_date", checkpoint, available_now)


def stream_clean_weather(
    spark: SparkSession,
    source_glob: str,
    sink_path: str,
    spec: WeatherSpec = WeatherSpec(),
    *,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Weather text files arriving under ``source_glob`` -> weather_clean."""
    lines = with_source_path(spark.readStream.text(source_glob))
    return _start(clean_weather(lines, spec), sink_path, "observation_date_local", checkpoint, available_now)
