"""The spark-submit entry point, run in-process."""

from pathlib import Path

from zonehour.plans import catalog as C
from zonehour.plans.cli import main
from zonehour.sources.adapters import write_weather_files

SF = "/root/testdata/sf0.001"
WIN = ["--trip-window", *C.QUERY_TRIP_WINDOW, "--weather-window", *C.QUERY_WEATHER_WINDOW]


def test_job_by_job(spark, tmp_out):
    raw = tmp_out + "/raw_trips"
    C.raw_trips(spark, SF).write.parquet(raw)
    weather = write_weather_files(spark.read.parquet(f"{SF}/events.parquet"), tmp_out + "/raw_weather")
    t = main(["--show", "3", "clean-trips", "--input", raw, "--output", tmp_out + "/trips_clean", *WIN], spark)
    assert t["trips_clean"] == C.trips_clean_df(spark, SF).count()
    w = main(["clean-weather", "--input", weather, "--output", tmp_out + "/weather_clean", *WIN], spark)
    assert w["weather_clean"] == C.weather_clean_df(spark, SF).count()
    p = main(["profile-trips", "--input", raw, "--output", tmp_out + "/profile_trips"], spark)
    assert set(p) == {"schema", "overview", "distinct_values", "sample"}
    a = main(
        [
            "analyze",
            "--taxi-input", tmp_out + "/trips_clean",
            "--weather-input", tmp_out + "/weather_clean",
            "--output-root", tmp_out + "/analytics",
            "--metrics-output", tmp_out + "/metrics_csv",
            "--train-end-date", C.QUERY_TRAIN_END,
            *WIN,
        ],
        spark,
    )
    names = {m["model_name"] for m in a["metrics"]}
    assert names == {"baseline_zone_hour_mean", "weather_aware_linear_regression"}
    assert list(Path(tmp_out + "/metrics_csv").glob("*.csv"))
    assert Path(tmp_out + "/analytics/features").exists()
    (expected,) = C.q_baseline_metrics(spark, SF).collect()
    base = next(m for m in a["metrics"] if m["model_name"] == "baseline_zone_hour_mean")
    assert abs(base["mae"] - expected.mae) < 1e-6


def test_all_in_one(spark, tmp_out):
    raw = tmp_out + "/raw_trips"
    C.raw_trips(spark, SF).write.parquet(raw)
    weather = write_weather_files(spark.read.parquet(f"{SF}/events.parquet"), tmp_out + "/raw_weather")
    out = main(
        ["all", "--raw-trips", raw, "--raw-weather", weather, "--output-root", tmp_out + "/out",
         "--train-end-date", C.QUERY_TRAIN_END, "--no-profile", *WIN],
        spark,
    )
    assert out["counts"]["trips_clean"] == C.trips_clean_df(spark, SF).count()
    assert {m["model_name"] for m in out["metrics"]} == {"baseline_zone_hour_mean", "weather_aware_linear_regression"}
    assert not Path(tmp_out + "/out/profile").exists()


def test_analyze_with_the_source_jobs_arguments(spark, tmp_out):
    """The same argument names as the source analytics job, no output root."""
    import pytest

    raw = tmp_out + "/raw_trips"
    C.raw_trips(spark, SF).write.parquet(raw)
    weather = write_weather_files(spark.read.parquet(f"{SF}/events.parquet"), tmp_out + "/raw_weather")
    main(["clean-trips", "--input", raw, "--output", tmp_out + "/taxi_clean", *WIN], spark)
    main(["clean-weather", "--input", weather, "--output", tmp_out + "/weather_clean", *WIN], spark)
    args = [
        "analyze",
        "--taxi-input", tmp_out + "/taxi_clean",
        "--weather-input", tmp_out + "/weather_clean",
        "--features-output", tmp_out + "/analytics/features",
        "--baseline-output", tmp_out + "/analytics/baseline_predictions",
        "--model-output", tmp_out + "/analytics/weather_aware_predictions",
        "--metrics-output", tmp_out + "/analytics/metrics",
        "--train-end-date", C.QUERY_TRAIN_END,
        *WIN,
    ]
    out = main(args, spark)
    assert len(out["metrics"]) == 2
    for name in ("features", "baseline_predictions", "weather_aware_predictions", "metrics"):
        assert Path(tmp_out + "/analytics/" + name).exists(), name
    with pytest.raises(SystemExit):
        main(["analyze", "--taxi-input", "t", "--weather-input", "w"], spark)
