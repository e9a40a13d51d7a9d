"""The whole job chain on files."""

from pathlib import Path

import pytest

from zonehour.config import Config
from zonehour.plans import catalog as C
from zonehour.plans.pipeline import PipelinePaths, run_pipeline
from zonehour.sources.adapters import write_weather_files

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("pipe")
    raw_trips = str(root / "raw_trips")
    C.raw_trips(spark, SF).write.mode("overwrite").parquet(raw_trips)
    weather_glob = write_weather_files(spark.read.parquet(f"{SF}/events.parquet"), str(root / "raw_weather"))
    paths = PipelinePaths(raw_trips, weather_glob, str(root / "out"))
    cfg = Config().with_windows(C.QUERY_TRIP_WINDOW, C.QUERY_WEATHER_WINDOW, C.QUERY_TRAIN_END)
    return paths, run_pipeline(spark, paths, cfg)


def test_outputs_exist(result):
    paths, res = result
    for name in ("trips_clean", "weather_clean", "features", "baseline_predictions", "model_predictions", "metrics"):
        assert Path(paths.out(name)).exists(), name
    dates = sorted(p.name for p in Path(paths.out("trips_clean")).glob("pickup_date=*"))
    assert dates[0] == "pickup_date=2024-01-03" and dates[-1] == "pickup_date=2024-01-28"


def test_counts_match_catalogue(spark, result):
    _, res = result
    c = res["counts"]
    assert c["trips_clean"] == C.trips_clean_df(spark, SF).count()
    assert c["weather_clean"] == C.weather_clean_df(spark, SF).count()
    assert c["weather_lines"] == C.weather_lines(spark, SF).count()
    assert c["features"] == C.features_df(spark, SF).count()


def test_metrics_csv_read_back(spark, result):
    _, res = result
    rows = {r.model_name: r for r in res["metrics"].collect()}
    assert set(rows) == {"baseline_zone_hour_mean", "weather_aware_linear_regression"}
    (expected,) = C.q_baseline_metrics(spark, SF).collect()
    assert rows["baseline_zone_hour_mean"].mae == pytest.approx(expected.mae, abs=1e-6)
    assert str(rows["baseline_zone_hour_mean"].train_end_date) == "2024-01-24"


def test_profiles_written(spark, result):
    _, res = result
    assert {"trips_overview", "trips_distinct_values", "weather_mode_top10"} <= set(res["profiles"])
    lists = spark.read.parquet(res["profiles"]["weather_distinct_values"])
    assert lists.where("column_name = 'station_id'").count() == 2


def test_features_through_written_tables_equal_in_memory(spark, result):
    """K1 -> S3 -> C5 (partitioned clean tables read back) gives the same
    feature rows as composing the operators in memory."""
    paths, _ = result
    written = C.rounded(spark.read.parquet(paths.out("features")))
    direct = C.rounded(C.features_df(spark, SF))
    assert written.count() == direct.count()
    assert written.exceptAll(direct).count() == 0 and direct.exceptAll(written).count() == 0


def test_features_job_keeps_rows_outside_the_default_window(spark, tmp_path):
    from datetime import date

    from zonehour.config import Config
    from zonehour.operators.features import DEMAND_INPUT_COLUMNS, HOURLY_WEATHER_INPUT_COLUMNS
    from zonehour.plans.pipeline import features_job

    days = [date(2023, 6, 1), date(2024, 1, 10), date(2024, 3, 5)]
    trips, weather, out = (str(tmp_path / n) for n in ("trips", "weather", "features"))
    spark.createDataFrame([(d, 8, 1, 2.0, 10.0) for d in days], list(DEMAND_INPUT_COLUMNS)).write.parquet(trips)
    spark.createDataFrame([(d, 8, "s", 5.0, 1.0, 0.0, 0) for d in days], list(HOURLY_WEATHER_INPUT_COLUMNS)).write.parquet(weather)
    rows = features_job(spark, trips, weather, out, Config()).collect()
    assert {r.pickup_date: r.avg_temp_c for r in rows} == {d: 5.0 for d in days}
