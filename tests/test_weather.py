"""Weather parsing and cleaning (FIXTURES 2.2)."""

from dataclasses import replace
from datetime import date, datetime

import pytest

from zonehour.config import WeatherSpec
from zonehour.operators.features import hourly_weather
from zonehour.operators.weather import WEATHER_CLEAN_COLUMNS, clean_weather, parse_weather
from zonehour.sources.readers import read_weather_lines

STATION = "744860-94789-2024"
REST = "56 -17 10171 320 31 7 0 -9999"

LINES = {
    "w1": "2024 01 01 03 56 -17 10171 320 31 7 0 -9999",
    "w2": "2024 01 10 12 -9999 -9999 -9999 -9999 -9999 -9999 -1 -1",
    "w3": "2024 01 10 12 0 0 10000 0 0 0 -9999 25",
    "w4": "2024 01 01 03 56 -17 10171 320 31 7 0",
    "w5": "2024 01 01 03 56 -17 10171 320 31 7 0 -9999 42",
    "w6": f"2024 02 31 05 {REST}",
    "w7": f"2024 01 XX 05 {REST}",
    "w8a": f"2024 02 01 04 {REST}",
    "w8b": f"2024 02 01 05 {REST}",
    "w9": "   2024  01 01   03 56 -17 10171 320 31 7 0 -9999   ",
    "w10": "2024 01 01 03 56 -17 10171 320 31 7 0 -9999",
}


def _path(case):
    if case == "w10":
        return f"file:/data/weather/no-station/{case}.gz"
    return f"file:/data/weather/{STATION}/{case}.gz"


@pytest.fixture(scope="module")
def cleaned(spark):
    lines = spark.createDataFrame([(v, _path(k)) for k, v in LINES.items()], "value string, source_path string")
    rows = clean_weather(lines, WeatherSpec()).collect()
    out = {}
    for r in rows:
        case = r.source_path_normalized.rsplit("/", 1)[1].split(".")[0]
        out[case] = r
    return out


def test_columns(spark):
    lines = spark.createDataFrame([(LINES["w1"], _path("w1"))], "value string, source_path string")
    df = clean_weather(lines)
    assert tuple(df.columns) == WEATHER_CLEAN_COLUMNS
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert types["observation_ts_utc"] == "timestamp_ntz"
    assert types["observation_date_local"] == "date"
    assert types["observation_hour_local"] == "int"
    assert types["wind_direction_degrees"] == "int"
    assert types["air_temp_c"] == "double"


def test_w1_decode_and_local_time(cleaned):
    r = cleaned["w1"]
    assert r.station_id == STATION
    assert r.observation_ts_utc == datetime(2024, 1, 1, 3, 0)
    assert r.observation_ts_local == datetime(2023, 12, 31, 22, 0)
    assert r.observation_date_local == date(2023, 12, 31)
    assert r.observation_hour_local == 22
    assert (r.air_temp_c, r.dew_point_c, r.sea_level_pressure_hpa, r.wind_speed_mps) == (5.6, -1.7, 1017.1, 3.1)
    assert r.precipitation_1hr_mm == 0.0 and r.precipitation_6hr_mm is None
    assert r.is_rain_1hr == 0


def test_w2_sentinels_and_trace(cleaned):
    r = cleaned["w2"]
    assert r.air_temp_c is None and r.dew_point_c is None and r.sea_level_pressure_hpa is None and r.wind_speed_mps is None
    assert r.wind_direction_degrees == -9999 and r.sky_cover_code == -9999
    assert r.precipitation_1hr_mm == 0.1 and r.precipitation_6hr_mm == 0.1
    assert r.is_rain_1hr == 1


def test_w3_null_precip_is_no_rain(cleaned):
    r = cleaned["w3"]
    assert r.precipitation_1hr_mm is None and r.is_rain_1hr == 0
    assert r.precipitation_6hr_mm == 2.5


def test_dropped_lines(cleaned):
    for case in ("w4", "w6", "w7", "w8b"):
        assert case not in cleaned, case


def test_extra_token_and_spacing(cleaned):
    base = cleaned["w1"].asDict()
    for case in ("w5", "w9"):
        other = cleaned[case].asDict()
        for k in base:
            if k != "source_path_normalized":
                assert base[k] == other[k], (case, k)


def test_window_edge_local(cleaned):
    r = cleaned["w8a"]
    assert r.observation_ts_local == datetime(2024, 1, 31, 23, 0)


def test_station_missing_is_empty_string(cleaned):
    assert cleaned["w10"].station_id == ""


def test_parse_short_and_long(spark):
    lines = spark.createDataFrame(
        [(LINES["w4"], _path("w4")), (LINES["w5"], _path("w5")), ("", _path("e")), ("\t" + LINES["w1"], _path("t"))],
        "value string, source_path string",
    )
    rows = parse_weather(lines).collect()
    # the 11-token and empty lines are dropped; a leading tab is not trimmed,
    # so its first token is empty and every field shifts (then year is null)
    assert len(rows) == 2
    by_path = {r.source_path_normalized.rsplit("/", 1)[1]: r for r in rows}
    assert by_path["w5.gz"].year == 2024
    assert by_path["t.gz"].year is None


def test_w11_dst_fall_back_hours_merge(spark):
    spec = replace(WeatherSpec(), window=("2024-11-01", "2024-11-05"))
    lines = spark.createDataFrame(
        [
            (f"2024 11 03 05 40 0 10000 0 0 0 0 0", _path("a")),
            (f"2024 11 03 06 60 0 10000 0 0 0 0 0", _path("b")),
        ],
        "value string, source_path string",
    )
    cleaned = clean_weather(lines, spec)
    hours = [r.observation_hour_local for r in cleaned.collect()]
    assert hours == [1, 1]
    (h,) = hourly_weather(cleaned).collect()
    assert h.observation_hour_local == 1 and h.avg_temp_c == 5.0 and h.station_count == 1


def test_session_zone_does_not_matter(spark):
    lines = spark.createDataFrame([(LINES["w1"], _path("w1"))], "value string, source_path string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        a = clean_weather(lines).collect()
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        b = clean_weather(lines).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert a == b


def test_real_gzip_files_and_path_station(spark, tmp_out):
    rows = spark.createDataFrame(
        [(STATION, LINES["w1"]), ("725030-14732-2024", LINES["w3"]), (STATION, LINES["w4"])],
        "station string, value string",
    )
    rows.write.mode("overwrite").option("compression", "gzip").partitionBy("station").text(tmp_out + "/raw")
    lines = read_weather_lines(spark, tmp_out + "/raw/*/*.gz")
    assert lines.columns == ["value", "source_path"]
    parsed = parse_weather(lines).collect()
    assert sorted(r.station_id for r in parsed) == ["725030-14732-2024", STATION]
    assert all(r.source_path_normalized.endswith(".gz") for r in parsed)


def test_min_partitions_spreads_lines(spark, tmp_out):
    rows = spark.createDataFrame([(STATION, LINES["w1"])] * 50, "station string, value string").coalesce(1)
    rows.write.mode("overwrite").option("compression", "gzip").partitionBy("station").text(tmp_out + "/one")
    lines = read_weather_lines(spark, tmp_out + "/one/*/*.gz", min_partitions=4)
    assert lines.rdd.getNumPartitions() == 4
    assert parse_weather(lines).count() == 50
    recursive = read_weather_lines(spark, tmp_out + "/one", recursive=True)
    assert recursive.columns == ["value", "source_path"] and recursive.count() == 50


def test_station_id_from_file_name(spark, tmp_out):
    """Raw archives name the station in the file itself (``jfk_<id>.gz``)."""
    import gzip
    from pathlib import Path

    root = Path(tmp_out) / "isd"
    root.mkdir()
    for name, line in (("jfk_744860-94789-2024.gz", LINES["w1"]), ("lga_725030-14732-2024.gz", LINES["w3"])):
        with gzip.open(root / name, "wt") as fh:
            fh.write(line + "\n" + LINES["w4"] + "\n")
    lines = read_weather_lines(spark, str(root / "*.gz"))
    assert lines.count() == 4
    got = sorted((r.station_id, r.year) for r in parse_weather(lines).collect())
    assert got == [("725030-14732-2024", 2024), ("744860-94789-2024", 2024)]


def test_spring_forward_hour_has_no_weather(spark):
    """2024-03-10 06:00 and 07:00 UTC are 01:00 and 03:00 in New York: local
    hour 2 has no weather, so demand in that hour gets zeros and
    station_count 0 (the only trace of the gap)."""
    from zonehour.config import ForecastSpec
    from zonehour.operators.features import build_features

    spec = replace(WeatherSpec(), window=("2024-03-09", "2024-03-11"))
    lines = spark.createDataFrame(
        [("2024 03 10 06 40 0 10000 0 10 0 0 0", _path("a")), ("2024 03 10 07 60 0 10000 0 30 0 0 0", _path("b"))],
        "value string, source_path string",
    )
    weather = hourly_weather(clean_weather(lines, spec))
    assert sorted(r.observation_hour_local for r in weather.collect()) == [1, 3]
    demand = spark.createDataFrame(
        [(date(2024, 3, 10), h, 1, 5, 1.0, 10.0) for h in (1, 2, 3)],
        "pickup_date date, pickup_hour int, PULocationID int, trip_count bigint, avg_trip_distance double, avg_fare_amount double",
    )
    rows = {r.pickup_hour: r for r in build_features(demand, weather, ForecastSpec(), spec).collect()}
    assert rows[1].avg_temp_c == 4.0 and rows[3].avg_temp_c == 6.0
    assert (rows[2].avg_temp_c, rows[2].avg_wind_speed_mps, rows[2].station_count) == (0.0, 0.0, 0)
