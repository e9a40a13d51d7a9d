"""Composite jobs (C1-C7): profile, clean, build features, evaluate.

Stage hand-over is through tables (partitioned clean tables, the feature
table, the two prediction tables), as in the reference's job chain. Reading
a written table back also cuts the lineage: a lost executor later in the
job recomputes from those files, not from the raw input, and the model's
passes over the training split read the feature files.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from zonehour.config import RAW_TRIP_TYPES, Config
from zonehour.operators.features import (
    DEMAND_INPUT_COLUMNS,
    HOURLY_WEATHER_INPUT_COLUMNS,
    build_features,
    hourly_demand,
    hourly_weather,
)
from zonehour.operators.forecast import baseline_forecast, linear_forecast, require_both_sides, split_counts, time_split
from zonehour.operators.metrics import compare_models
from zonehour.operators.profile import profile_trips, profile_weather
from zonehour.operators.trips import clean_trips
from zonehour.operators.weather import clean_weather
from zonehour.plans.manifest import Manifest
from zonehour.session import scratch_path
from zonehour.sources.readers import (
    read_clean,
    read_trips,
    read_weather_lines,
    require_columns,
    stage_weather_lines,
)
from zonehour.sources.sinks import write_metrics, write_partitioned, write_table

METRICS_CSV_SCHEMA = "model_name string, mae double, rmse double, mape double, test_rows bigint, train_end_date string"
# what profile_job writes
PROFILES = ("trips_schema", "trips_overview", "trips_distinct_values", "trips_sample", "weather_schema", "weather_line_count", "weather_distinct_values", "weather_numeric_stats", "weather_mode_top10", "weather_sample")
# the columns that hourly_demand and hourly_weather read
TAXI_REQUIRED = DEMAND_INPUT_COLUMNS
WEATHER_REQUIRED = HOURLY_WEATHER_INPUT_COLUMNS


@dataclass(frozen=True)
class PipelinePaths:
    """Inputs and the output root (a shared file system on a cluster).
    ``overrides`` maps an output name (``features``, ``metrics``, ...) to a
    path of its own."""

    raw_trips: str
    raw_weather: str
    output_root: str
    overrides: tuple[tuple[str, str], ...] = ()
    # whether the trip files may differ in types and columns
    drifting: bool = False

    def trips(self, spark: SparkSession) -> DataFrame:
        return read_trips(spark, self.raw_trips, dict(RAW_TRIP_TYPES) if self.drifting else None)

    def out(self, name: str) -> str:
        own = dict(self.overrides).get(name)
        return own or f"{self.output_root.rstrip('/')}/{name}"


def profile_job(spark: SparkSession, paths: PipelinePaths, cfg: Config = Config(), parallel: int = 4, lines: DataFrame | None = None) -> dict[str, str]:
    """C1 + C2: every profile written as a small parquet table. ``lines`` are
    the staged weather lines; without them they are staged here, so that the
    text is read once.

    The profiles are independent jobs. Their writes are submitted from up to
    ``parallel`` threads so Spark can schedule them side by side; no data
    passes through the driver.
    """
    if lines is None:
        lines = stage_weather_lines(read_weather_lines(spark, paths.raw_weather), scratch_path(spark, "weather-lines"))
    profiles = {
        **{f"trips_{k}": v for k, v in profile_trips(paths.trips(spark), cfg.trips).items()},
        **{f"weather_{k}": v for k, v in profile_weather(lines, cfg.weather).items()},
    }
    written = {name: paths.out(f"profile/{name}") for name in profiles}
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        for job in [pool.submit(write_table, df, written[name]) for name, df in profiles.items()]:
            job.result()
    return written


def clean_trips_job(spark: SparkSession, raw_path: str, out_path: str, cfg: Config = Config(), raw: DataFrame | None = None) -> dict[str, int]:
    """C3 + K1: raw parquet -> trips_clean partitioned by pickup_date."""
    raw = read_trips(spark, raw_path) if raw is None else raw
    write_partitioned(clean_trips(raw, cfg.trips), out_path, "pickup_date", cfg.scale.trips_layout)
    # both counts come from parquet footers, not from another pass over rows
    return {"raw_trips": raw.count(), "trips_clean": read_clean(spark, out_path).count()}


def clean_weather_job(spark: SparkSession, raw_glob: str, out_path: str, cfg: Config = Config(), lines: DataFrame | None = None) -> dict[str, int]:
    """C4 + K1: weather text -> weather_clean partitioned by local date.

    The text is staged first (``lines`` if it is already), and both counts
    come from footers rather than from ``observe``d metrics. These are
    accumulator updates inside a map stage, and they can be applied twice when
    that stage is recomputed after an executor loss.
    """
    if lines is None:
        lines = stage_weather_lines(read_weather_lines(spark, raw_glob), scratch_path(spark, "weather-lines"))
    write_partitioned(clean_weather(lines, cfg.weather), out_path, "observation_date_local", cfg.scale.weather_layout)
    return {"weather_lines": lines.count(), "weather_clean": read_clean(spark, out_path).count()}


def features_job(spark: SparkSession, trips_path: str, weather_path: str, out_path: str, cfg: Config = Config()) -> DataFrame:
    """C5 + K2: clean tables -> feature table (written, then read back).

    All rows of the clean tables count, whatever their dates: the windows of
    ``cfg`` are those of cleaning. The hourly weather is written first, so
    that its counted rows decide on the broadcast."""
    taxi = require_columns(read_clean(spark, trips_path), TAXI_REQUIRED, "taxi")
    weather = require_columns(read_clean(spark, weather_path), WEATHER_REQUIRED, "weather")
    hourly_path = scratch_path(spark, "hourly-weather")
    write_table(hourly_weather(weather), hourly_path)
    hourly = spark.read.parquet(hourly_path)
    features = build_features(hourly_demand(taxi), hourly, cfg.forecast, scale=cfg.scale, weather_rows=hourly.count())
    # sorted by date inside each file, so the split's date filter skips row groups
    write_table(features.sortWithinPartitions("pickup_date"), out_path)
    return spark.read.parquet(out_path)


def evaluate_job(spark: SparkSession, features: DataFrame, paths: PipelinePaths, cfg: Config = Config()) -> DataFrame:
    """Split, both models, metrics. Returns the metrics table."""
    fc = cfg.forecast
    train, test = time_split(features, fc.train_end)
    require_both_sides(features, fc.train_end)

    baseline_path = paths.out("baseline_predictions")
    model_path = paths.out("model_predictions")

    def model_predictions() -> None:
        write_table(linear_forecast(train, test, fc), model_path)

    # the baseline write and the model fit are independent jobs
    with ThreadPoolExecutor(max_workers=2) as pool:
        jobs = [pool.submit(write_table, baseline_forecast(train, test), baseline_path), pool.submit(model_predictions)]
        for job in jobs:
            job.result()

    metrics = compare_models(
        {
            fc.baseline_name: spark.read.parquet(baseline_path),
            fc.linear_name: spark.read.parquet(model_path),
        },
        fc.train_end,
    )
    metrics_path = paths.out("metrics")
    write_metrics(metrics, metrics_path)
    return spark.read.option("header", True).schema(METRICS_CSV_SCHEMA).csv(metrics_path)


def run_pipeline(spark: SparkSession, paths: PipelinePaths, cfg: Config = Config(), profile: bool = True, resume: bool = False) -> dict:
    """The whole chain in stage order in one session. The weather text is
    staged once; then the profiles and the two cleaning jobs, which read only
    raw input, run side by side.

    ``resume`` keeps a manifest of finished stages under the output root: the
    same call after a lost driver re-does only what is not finished, or what
    changed inputs or settings ask for (``plans.manifest``).
    """
    done = Manifest(spark, paths.out("_manifest"), resume)
    trips_path, weather_path = paths.out("trips_clean"), paths.out("weather_clean")
    staged_path = paths.out("staging/weather_lines") if resume else scratch_path(spark, "weather-lines")
    result: dict = {}

    def stage() -> dict:
        stage_weather_lines(read_weather_lines(spark, paths.raw_weather), staged_path)
        return {}

    done.run("stage_weather", [paths.raw_weather], [staged_path], None, stage)
    lines = spark.read.schema("value string, source_path string").parquet(staged_path)

    def profiled() -> dict:
        return profile_job(spark, paths, cfg, lines=lines)

    def trips_cleaned() -> dict:
        return clean_trips_job(spark, paths.raw_trips, trips_path, cfg, paths.trips(spark))

    def weather_cleaned() -> dict:
        return clean_weather_job(spark, paths.raw_weather, weather_path, cfg, lines)

    with ThreadPoolExecutor(max_workers=3) as pool:
        profiles = pool.submit(done.run, "profile", [paths.raw_trips, staged_path], [paths.out(f"profile/{p}") for p in PROFILES], cfg, profiled) if profile else None
        trips = pool.submit(done.run, "clean_trips", [paths.raw_trips], [trips_path], cfg, trips_cleaned)
        weather = pool.submit(done.run, "clean_weather", [staged_path], [weather_path], cfg, weather_cleaned)
        result["counts"] = {**trips.result(), **weather.result()}
        if profiles is not None:
            result["profiles"] = profiles.result()

    def featured() -> dict:
        features = features_job(spark, trips_path, weather_path, paths.out("features"), cfg)
        sides = split_counts(features, cfg.forecast.train_end).first()
        return {"features": features.count(), "train": sides.train_rows, "test": sides.test_rows}

    def evaluated() -> dict:
        evaluate_job(spark, spark.read.parquet(paths.out("features")), paths, cfg)
        return {}

    result["counts"] |= done.run("features", [trips_path, weather_path], [paths.out("features")], cfg, featured)
    tables = [paths.out(t) for t in ("baseline_predictions", "model_predictions", "metrics")]
    done.run("evaluate", [paths.out("features")], tables, cfg, evaluated)
    result["metrics"] = spark.read.option("header", True).schema(METRICS_CSV_SCHEMA).csv(paths.out("metrics"))
    return result


__all__ = [
    "PipelinePaths",
    "clean_trips_job",
    "clean_weather_job",
    "evaluate_job",
    "features_job",
    "profile_job",
    "run_pipeline",
]
