"""Incremental cleaning equals the batch result, file by file."""

from zonehour.operators.trips import TRIPS_CLEAN_COLUMNS, clean_trips
from zonehour.operators.weather import clean_weather
from zonehour.plans import catalog as C
from zonehour.sources.adapters import write_weather_files
from zonehour.sources.readers import read_clean, read_weather_lines
from zonehour.streaming import stream_clean_trips, stream_clean_weather

SF = "/root/testdata/sf0.001"


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_stream_trips_matches_batch(spark, tmp_out):
    raw = C.raw_trips(spark, SF)
    src = tmp_out + "/landing"
    # two arrivals: first and second half of the month
    raw.where("tpep_pickup_datetime < '2024-01-15'").write.parquet(src + "/a")
    raw.where("tpep_pickup_datetime >= '2024-01-15'").write.parquet(src + "/b")
    sink = tmp_out + "/trips_clean"
    q = stream_clean_trips(spark, src + "/*", raw.schema, sink, C.QUERY_CONFIG.trips, checkpoint=tmp_out + "/ckpt")
    q.awaitTermination(120)
    got = read_clean(spark, sink)
    want = clean_trips(raw, C.QUERY_CONFIG.trips)
    assert _rows(got, TRIPS_CLEAN_COLUMNS) == _rows(want, TRIPS_CLEAN_COLUMNS)


def test_stream_weather_matches_batch(spark, tmp_out):
    glob = write_weather_files(spark.read.parquet(f"{SF}/events.parquet"), tmp_out + "/raw_weather")
    sink = tmp_out + "/weather_clean"
    q = stream_clean_weather(spark, glob, sink, C.QUERY_CONFIG.weather, checkpoint=tmp_out + "/ckpt_w")
    q.awaitTermination(120)
    cols = ["station_id", "observation_ts_utc", "observation_hour_local", "air_temp_c", "is_rain_1hr"]
    want = clean_weather(read_weather_lines(spark, glob), C.QUERY_CONFIG.weather)
    assert _rows(read_clean(spark, sink), cols) == _rows(want, cols)


def test_stream_restart_processes_only_new_files(spark, tmp_out):
    """Exactly-once per file: a second run with the same checkpoint only
    appends the files that arrived since the first run."""
    raw = C.raw_trips(spark, SF)
    src, sink, ckpt = tmp_out + "/landing", tmp_out + "/clean", tmp_out + "/ckpt"
    raw.where("tpep_pickup_datetime < '2024-01-15'").write.parquet(src + "/a")
    stream_clean_trips(spark, src + "/*", raw.schema, sink, C.QUERY_CONFIG.trips, checkpoint=ckpt).awaitTermination(120)
    first = read_clean(spark, sink).count()
    raw.where("tpep_pickup_datetime >= '2024-01-15'").write.parquet(src + "/b")
    stream_clean_trips(spark, src + "/*", raw.schema, sink, C.QUERY_CONFIG.trips, checkpoint=ckpt).awaitTermination(120)
    total = read_clean(spark, sink).count()
    assert first < total == clean_trips(raw, C.QUERY_CONFIG.trips).count()


def test_weather_stream_restart_processes_only_new_files(spark, tmp_out):
    from zonehour.sources.adapters import weather_line_rows

    events = spark.read.parquet(f"{SF}/events.parquet")
    lines = weather_line_rows(events)
    src, sink, ckpt = tmp_out + "/landing", tmp_out + "/clean", tmp_out + "/ckpt"
    first_half = lines.where("station_id = '744860-94789-2024'")
    second_half = lines.where("station_id <> '744860-94789-2024'")
    first_half.write.option("compression", "gzip").partitionBy("station_id").text(src + "/a")
    glob = src + "/*/*/*.gz"
    stream_clean_weather(spark, glob, sink, C.QUERY_CONFIG.weather, checkpoint=ckpt).awaitTermination(120)
    first = read_clean(spark, sink).count()
    second_half.write.option("compression", "gzip").partitionBy("station_id").text(src + "/b")
    stream_clean_weather(spark, glob, sink, C.QUERY_CONFIG.weather, checkpoint=ckpt).awaitTermination(120)
    total = read_clean(spark, sink).count()
    want = clean_weather(read_weather_lines(spark, glob), C.QUERY_CONFIG.weather).count()
    assert 0 < first < total == want
