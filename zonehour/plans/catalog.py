"""Query catalogue: one entry per operator of the inventory, run on inputs
derived from the driver's ``events`` table (see ``sources.adapters``).

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole tables. Aggregated doubles are rounded to 6 places in the compared
projection (``round(x * 1e6) / 1e6``, the same arithmetic DuckDB's
``round(x, 6)`` uses), because float sums depend on summation order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonehour.config import RAW_TRIP_TYPES, Config, day_before
from zonehour.operators.features import build_features, hourly_demand, hourly_weather
from zonehour.operators.forecast import (
    baseline_forecast,
    evaluate,
    global_mean,
    linear_forecast,
    require_both_sides,
    split_counts,
    time_split,
    zone_hour_mean,
)
from zonehour.operators.incremental import demand_of, demand_state, read_states, weather_of, weather_state, write_batch
from zonehour.operators.linear import ZONE, ZONE_FEATURE, assemble_features, fit_normal, zone_index
from zonehour.operators.metrics import model_metrics
from zonehour.operators.profile import (
    TRIP_NULL_COUNT_NAMES,
    TRIP_RANGE_COLUMNS,
    WEATHER_STAT_COLUMNS,
    TRIP_DISTINCT_COLUMNS,
    distinct_lists,
    distinct_values,
    keyed_count,
    mode_top,
    null_counts,
    numeric_range,
    numeric_stats,
    overview,
    profile_trips,
    profile_weather,
    schema_report,
    stage_counts,
)
from zonehour.operators.trips import TRIPS_CLEAN_COLUMNS, clean_trips, typed_trips, valid_trip_condition, window_condition
from zonehour.operators.weather import WEATHER_CLEAN_COLUMNS, clean_weather, decode_weather, local_timestamp, parse_weather, weather_records
from zonehour.plans.pipeline import METRICS_CSV_SCHEMA, PipelinePaths, evaluate_job, features_job, run_pipeline
from zonehour.session import file_identity, scratch_path
from zonehour.sources.adapters import trips_from_events, weather_lines_from_events, write_weather_files
from zonehour.sources.readers import read_clean, read_trips, require_columns
from zonehour.sources.sinks import overwrite_dates, preview, write_metrics, write_partitioned, write_table

# --- fixed values: the query configuration (FIXTURES section 3.3) -----------
# Windows narrower than the data, so both window filters drop rows.
QUERY_TRIP_WINDOW = ("2024-01-03", "2024-01-28")
QUERY_WEATHER_WINDOW = ("2024-01-01", "2024-01-28")
QUERY_TRAIN_END = "2024-01-24"
# dates that trips_rerun_roundtrip runs again, and one without trips
RERUN_DATES = ("2024-01-05", "2024-01-09", "2024-01-20")
NO_ROWS_DATE = "2024-02-29"
# --- end of fixed values -----------------------------------------------------

QUERY_CONFIG = Config().with_windows(QUERY_TRIP_WINDOW, QUERY_WEATHER_WINDOW, QUERY_TRAIN_END)

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, places: int = 6, only: tuple[str, ...] | None = None) -> DataFrame:
    """Round double columns (all, or ``only``) to ``places`` decimals."""
    scale = float(10**places)
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "double" and (only is None or f.name in only):
            cols.append((F.round(F.col(f.name) * F.lit(scale)) / F.lit(scale)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# ---- inputs -----------------------------------------------------------------

_SCHEMAS: dict[tuple[str, tuple], object] = {}


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet read whose inferred schema is remembered per session and
    state of the files: later reads pass it in and skip the footer-reading inference job."""
    key = (spark.sparkContext.applicationId, file_identity(spark, path))
    schema = _SCHEMAS.get(key)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[key] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_events(read_table(spark, f"{sf_dir}/events.parquet"))


def weather_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_lines_from_events(spark, f"{sf_dir}/events.parquet")


def trips_clean_df(spark: SparkSession, sf_dir: str, cfg: Config = QUERY_CONFIG) -> DataFrame:
    return clean_trips(raw_trips(spark, sf_dir), cfg.trips)


def weather_clean_df(spark: SparkSession, sf_dir: str, cfg: Config = QUERY_CONFIG) -> DataFrame:
    return clean_weather(weather_lines(spark, sf_dir), cfg.weather)


def features_df(spark: SparkSession, sf_dir: str, cfg: Config = QUERY_CONFIG) -> DataFrame:
    demand = hourly_demand(trips_clean_df(spark, sf_dir, cfg))
    weather = hourly_weather(weather_clean_df(spark, sf_dir, cfg))
    return build_features(demand, weather, cfg.forecast, cfg.weather, cfg.scale)


# ---- queries ----------------------------------------------------------------


def q_trips_clean(spark, sf_dir):
    return trips_clean_df(spark, sf_dir)


def q_hourly_demand(spark, sf_dir):
    return rounded(hourly_demand(trips_clean_df(spark, sf_dir)))


def q_weather_parse(spark, sf_dir):
    # of the path, the station's folder; what comes before it names a scratch folder
    parsed = parse_weather(weather_lines(spark, sf_dir), QUERY_CONFIG.weather)
    folder = F.substring_index(F.substring_index("source_path_normalized", "/", -2), "/", 1).alias("source_folder")
    return parsed.select("*", folder).drop("source_path_normalized")


def q_weather_clean(spark, sf_dir):
    return weather_clean_df(spark, sf_dir).drop("source_path_normalized")


def q_hourly_weather(spark, sf_dir):
    return rounded(hourly_weather(weather_clean_df(spark, sf_dir)))


def q_features(spark, sf_dir):
    return rounded(features_df(spark, sf_dir))


def _demand(spark, sf_dir):
    """The zone-hours without weather: the join adds columns, no rows."""
    return hourly_demand(trips_clean_df(spark, sf_dir))


def q_split_counts(spark, sf_dir):
    return split_counts(_demand(spark, sf_dir), QUERY_CONFIG.forecast.train_end)


def q_global_mean(spark, sf_dir):
    train, _ = time_split(_demand(spark, sf_dir), QUERY_CONFIG.forecast.train_end)
    return rounded(global_mean(train))


def q_zone_hour_mean(spark, sf_dir):
    train, _ = time_split(_demand(spark, sf_dir), QUERY_CONFIG.forecast.train_end)
    return rounded(zone_hour_mean(train))


def _written_features(spark, sf_dir):
    """The feature table, written to the shared scratch folder by date order
    within files and read back. The raw trips are aggregated once; each
    branch that follows reads only its columns and dates."""
    path = scratch_path(spark, "features")
    write_table(features_df(spark, sf_dir).sortWithinPartitions("pickup_date"), path)
    return spark.read.parquet(path)


def _written_splits(spark, sf_dir):
    return time_split(_written_features(spark, sf_dir), QUERY_CONFIG.forecast.train_end)


def q_baseline_predictions(spark, sf_dir):
    train, test = _written_splits(spark, sf_dir)
    return rounded(baseline_forecast(train, test))


def q_baseline_metrics(spark, sf_dir):
    train, test = _written_splits(spark, sf_dir)
    fc = QUERY_CONFIG.forecast
    return rounded(model_metrics(baseline_forecast(train, test), fc.baseline_name, fc.train_end))


def q_linear_predictions(spark, sf_dir):
    train, test = _written_splits(spark, sf_dir)
    return rounded(rounded(linear_forecast(train, test, QUERY_CONFIG.forecast)), 4, only=("prediction",))


def q_model_metrics(spark, sf_dir):
    _, _, metrics = evaluate(_written_features(spark, sf_dir), QUERY_CONFIG.forecast)
    return rounded(metrics, 4)


OLS = replace(QUERY_CONFIG.forecast, features=("avg_temp_c",), reg_param=0.0, elastic_net=0.0, linear_name="ols_temperature")


def q_ols_predictions(spark, sf_dir):
    train, test = _written_splits(spark, sf_dir)
    return rounded(linear_forecast(train, test, OLS))


def q_model_comparison(spark, sf_dir):
    _, _, metrics = evaluate(_written_features(spark, sf_dir), OLS)
    return rounded(metrics)


def q_elastic_net_coefficients(spark, sf_dir):
    """Slope and intercept of a one-feature elastic net, at 4 decimals."""
    train, _ = _written_splits(spark, sf_dir)
    fitted = fit_normal(train, replace(OLS, reg_param=0.02, elastic_net=0.1))
    row = spark.range(1).select(F.lit(fitted.coefficients["avg_temp_c"]).alias("slope"), F.lit(fitted.intercept).alias("intercept"))
    return rounded(row, 4)


def q_linear_coefficients(spark, sf_dir):
    """Every coefficient of the default model, at 4 decimals: the intercept,
    the features and the zones."""
    train, _ = _written_splits(spark, sf_dir)
    fitted = fit_normal(train, QUERY_CONFIG.forecast)
    terms = {"intercept": fitted.intercept, **fitted.coefficients}
    named = spark.createDataFrame(list(terms.items()), "term string, coefficient double")
    zones = fitted.zones.select(F.concat(F.lit("zone "), F.col(ZONE).cast("string")).alias("term"), F.col("zone_coefficient").alias("coefficient"))
    return rounded(named.unionByName(zones), 4)


def q_model_features(spark, sf_dir):
    """M1-M3 of the training rows: zone index, place of the zone's 1 in the
    assembled vector, the vector's size and its values beside the one-hot."""
    train, _ = _written_splits(spark, sf_dir)
    fc = QUERY_CONFIG.forecast
    vector = assemble_features(train, zone_index(train), fc)
    zones = fc.features.index(ZONE_FEATURE)
    return rounded(
        vector.select(
            "pickup_date",
            "pickup_hour",
            ZONE,
            F.col("zone_index").cast("int").alias("zone_index"),
            (F.col("features.indices")[zones] - zones).alias("hot_place"),
            F.col("features.values")[zones].alias("hot_sum"),
            F.col("features.size").cast("int").alias("vector_size"),
            *[F.col("features.values")[k].alias(f"x_{c}") for k, c in enumerate(fc.features) if k != zones],
        )
    )


def _pipeline_paths(spark, sf_dir):
    """Clean tables written by the clean jobs' sinks, for the jobs after them."""
    paths = PipelinePaths("", "", scratch_path(spark, "pipeline"))
    write_partitioned(trips_clean_df(spark, sf_dir), paths.out("trips_clean"), "pickup_date", QUERY_CONFIG.scale.trips_layout)
    write_partitioned(weather_clean_df(spark, sf_dir), paths.out("weather_clean"), "observation_date_local", QUERY_CONFIG.scale.weather_layout)
    return paths


def q_pipeline_features(spark, sf_dir):
    """What ``features_job`` wrote, with the default configuration."""
    paths = _pipeline_paths(spark, sf_dir)
    return rounded(features_job(spark, paths.out("trips_clean"), paths.out("weather_clean"), paths.out("features")))


def q_pipeline_baseline_predictions(spark, sf_dir):
    """What ``evaluate_job`` wrote as the baseline's predictions."""
    paths = _pipeline_paths(spark, sf_dir)
    features = features_job(spark, paths.out("trips_clean"), paths.out("weather_clean"), paths.out("features"), QUERY_CONFIG)
    evaluate_job(spark, features, paths, QUERY_CONFIG)
    return rounded(spark.read.parquet(paths.out("baseline_predictions")))


def q_profile_trip_tables(spark, sf_dir):
    """The whole distinct lists as the profile job writes them."""
    path = scratch_path(spark, "profile-trips")
    write_table(profile_trips(raw_trips(spark, sf_dir), QUERY_CONFIG.trips)["distinct_values"], path)
    return spark.read.parquet(path)


def q_profile_weather_tables(spark, sf_dir):
    """What the profile job writes for the weather, one row per entry: the
    line count, the whole distinct lists, the medians and the modes."""
    tables = {}
    for name, df in profile_weather(weather_lines(spark, sf_dir), QUERY_CONFIG.weather).items():
        if name in ("schema", "sample"):
            continue
        path = scratch_path(spark, f"profile-{name}")
        write_table(df, path)
        tables[name] = spark.read.schema(df.schema).parquet(path)
    no_text, no_value, no_n = F.lit(None).cast("string"), F.lit(None).cast("double"), F.lit(None).cast("bigint")
    entries = {
        "line_count": ("metric", no_text, no_value, "value"),
        "distinct_values": ("column_name", F.col("value"), no_value, no_n),
        "numeric_stats": ("column_name", no_text, F.col("median_value"), "non_null_count"),
        "mode_top10": ("column_name", no_text, F.col("value"), "count"),
    }
    out = None
    for name, (key, text, value, n) in entries.items():
        rows = tables[name].select(
            F.lit(name).alias("profile"),
            F.col(key).alias("column_name"),
            text.alias("text"),
            value.alias("value"),
            (F.col(n) if isinstance(n, str) else n).alias("n"),
        )
        out = rows if out is None else out.unionByName(rows)
    return rounded(out)


def q_metrics_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    write_metrics(q_baseline_metrics(spark, sf_dir), path)
    return spark.read.option("header", True).schema(METRICS_CSV_SCHEMA).csv(path)


def q_null_counts(spark, sf_dir):
    names = dict(TRIP_NULL_COUNT_NAMES)
    names.update({"passenger_count": "null_passenger_count", "RatecodeID": "null_ratecode", "store_and_fwd_flag": "null_store_and_fwd_flag"})
    return null_counts(raw_trips(spark, sf_dir), names)


def q_numeric_range(spark, sf_dir):
    return rounded(numeric_range(raw_trips(spark, sf_dir), TRIP_RANGE_COLUMNS))


def q_schema_report(spark, sf_dir):
    """The schemas that the two profiles report."""
    reports = {"trips": raw_trips(spark, sf_dir), "weather": _weather_decoded(spark, sf_dir).drop("source_path_normalized")}
    parts = [schema_report(df).select(F.lit(name).alias("profile"), "position", "column_name", "data_type") for name, df in reports.items()]
    return parts[0].unionByName(parts[1])


def q_record_count(spark, sf_dir):
    return keyed_count(raw_trips(spark, sf_dir))


def q_trip_overview(spark, sf_dir):
    return rounded(overview(raw_trips(spark, sf_dir), dict(TRIP_NULL_COUNT_NAMES), TRIP_RANGE_COLUMNS))


def q_distinct_lists(spark, sf_dir):
    return distinct_lists(raw_trips(spark, sf_dir), list(TRIP_DISTINCT_COLUMNS))


def q_distinct_positions(spark, sf_dir):
    """The whole lists with the place of each value."""
    return distinct_lists(raw_trips(spark, sf_dir), list(TRIP_DISTINCT_COLUMNS), positions=True)


def q_distinct_values(spark, sf_dir):
    return distinct_values(raw_trips(spark, sf_dir), "RatecodeID")


def q_distinct_store_flags(spark, sf_dir):
    return distinct_values(raw_trips(spark, sf_dir), "store_and_fwd_flag")


def _weather_decoded(spark, sf_dir):
    spec = QUERY_CONFIG.weather
    return decode_weather(parse_weather(weather_lines(spark, sf_dir), spec), spec)


def q_distinct_stations(spark, sf_dir):
    return distinct_values(_weather_decoded(spark, sf_dir), "station_id", drop_nulls=False)


def q_distinct_sky_cover_codes(spark, sf_dir):
    return distinct_values(_weather_decoded(spark, sf_dir), "sky_cover_code", exclude=[QUERY_CONFIG.weather.missing])


def q_distinct_wind_directions(spark, sf_dir):
    return distinct_values(_weather_decoded(spark, sf_dir), "wind_direction_degrees", exclude=[QUERY_CONFIG.weather.missing])


def q_numeric_stats(spark, sf_dir):
    return rounded(numeric_stats(_weather_decoded(spark, sf_dir), WEATHER_STAT_COLUMNS))


def q_mode_top10(spark, sf_dir):
    return mode_top(_weather_decoded(spark, sf_dir), WEATHER_STAT_COLUMNS, 10)


def q_stage_counts(spark, sf_dir):
    """One aggregate over each of raw trips, weather lines and zone-hours."""
    cfg = QUERY_CONFIG
    valid = valid_trip_condition(cfg.trips)
    trips = typed_trips(raw_trips(spark, sf_dir), cfg.trips)
    lines = weather_records(weather_lines(spark, sf_dir), cfg.weather).select("_tokens", local_timestamp(cfg.weather).alias("at"))
    parsed = F.col("_tokens") >= cfg.weather.min_tokens
    in_window = window_condition("at", cfg.weather.window)
    is_train = F.col("pickup_date") <= F.lit(cfg.forecast.train_end).cast("date")
    return stage_counts(
        [
            (trips, {"raw_trips": None, "trips_clean": valid}),
            (lines, {"weather_lines": None, "weather_parsed": parsed, "weather_clean": parsed & in_window}),
            (_demand(spark, sf_dir), {"features": None, "train": is_train, "test": ~is_train}),
        ]
    )


def q_trips_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "trips-clean")
    write_partitioned(trips_clean_df(spark, sf_dir), path, "pickup_date", QUERY_CONFIG.scale.trips_layout)
    return read_clean(spark, path).select(*TRIPS_CLEAN_COLUMNS)


def q_trips_rerun_roundtrip(spark, sf_dir):
    """The clean table after a re-run of a few dates: they were written wrong
    first, some without rows, and one date is there that must go."""
    path = scratch_path(spark, "trips-rerun")
    trips = trips_clean_df(spark, sf_dir)
    wrong = trips.where(~F.col("pickup_date").isin(*[F.lit(d).cast("date") for d in RERUN_DATES[1:]])).withColumn(
        "fare_amount", F.when(F.col("pickup_date") == F.lit(RERUN_DATES[0]).cast("date"), F.lit(-1.0)).otherwise(F.col("fare_amount"))
    )
    write_partitioned(wrong.unionByName(trips.withColumn("pickup_date", F.lit(NO_ROWS_DATE).cast("date"))), path, "pickup_date")
    overwrite_dates(trips, path, "pickup_date", [*RERUN_DATES, NO_ROWS_DATE])
    return read_clean(spark, path).select(*TRIPS_CLEAN_COLUMNS)


def q_features_incremental(spark, sf_dir):
    """The features from states of two batches that share hours and stations:
    trips by drop-off zone, weather by sky cover, the second batch written twice."""
    trips, weather = trips_clean_df(spark, sf_dir), weather_clean_df(spark, sf_dir)
    demand, hourly = scratch_path(spark, "demand-state"), scratch_path(spark, "weather-state")
    for batch in (0, 1, 1):
        write_batch(demand_state(trips.where(F.col("DOLocationID") % 2 == batch)), demand, f"{batch}")
        write_batch(weather_state(weather.where(F.pmod(F.coalesce(F.col("sky_cover_code"), F.lit(0)), F.lit(2)) == batch)), hourly, f"{batch}")
    cfg = QUERY_CONFIG
    merged = build_features(demand_of(read_states(spark, demand)), weather_of(read_states(spark, hourly)), cfg.forecast, cfg.weather, cfg.scale)
    return rounded(merged)


def q_weather_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "weather-clean")
    write_partitioned(weather_clean_df(spark, sf_dir), path, "observation_date_local", QUERY_CONFIG.scale.weather_layout)
    cols = [c for c in WEATHER_CLEAN_COLUMNS if c != "source_path_normalized"]
    return read_clean(spark, path).select(*cols)


def q_trips_preview(spark, sf_dir):
    return preview(trips_clean_df(spark, sf_dir), None, 20)


def q_trips_drift(spark, sf_dir):
    """Clean trips from a folder of two schemas: one vendor's files hold whole
    passenger counts, zones as int, decimal rate codes and no flag."""
    path = scratch_path(spark, "trips-drift")
    trips = raw_trips(spark, sf_dir)
    write_table(trips.where("VendorID = 1"), f"{path}/vendor1")
    other = trips.where("VendorID = 2").drop("store_and_fwd_flag").withColumns(
        {"passenger_count": F.col("passenger_count").cast("int"), "PULocationID": F.col("PULocationID").cast("int"), "RatecodeID": F.col("RatecodeID").cast("double")}
    )
    write_table(other, f"{path}/vendor2")
    return clean_trips(read_trips(spark, path, dict(RAW_TRIP_TYPES)), QUERY_CONFIG.trips)


def q_contracts(spark, sf_dir):
    """The errors for a missing column and for split dates that
    leave a side empty; null where the contract holds."""
    raw = raw_trips(spark, sf_dir)
    features = _written_features(spark, sf_dir)
    first, last = (str(x) for x in features.agg(F.min("pickup_date"), F.max("pickup_date")).first())

    def message(check, *args):
        try:
            check(*args)
        except ValueError as e:
            return str(e)
        return None

    rows = [("columns", c, message(require_columns, raw.drop(c), TRIP_RANGE_COLUMNS, "trips")) for c in raw.columns]
    rows += [("rows", d, message(require_both_sides, features, d)) for d in (day_before(first), first, last)]
    return spark.createDataFrame(rows, "contract string, subject string, message string")


def q_chain_report(spark, sf_dir):
    """What the whole chain wrote and returned, one row per figure: counts of
    its stages, profiles, predictions and metrics (4 decimals)."""
    root = scratch_path(spark, "chain")
    write_table(raw_trips(spark, sf_dir), f"{root}/raw_trips")
    weather = write_weather_files(spark.read.parquet(f"{sf_dir}/events.parquet"), f"{root}/raw_weather")
    paths = PipelinePaths(f"{root}/raw_trips", weather, f"{root}/out")
    result = run_pipeline(spark, paths, QUERY_CONFIG)
    read = {name: spark.read.parquet(path) for name, path in result["profiles"].items()}

    def figures(part, df, name, *columns):
        wide = df.select(F.lit(part).alias("part"), F.col(name).alias("name") if name else F.lit("").alias("name"), *[F.col(c).cast("double").alias(c) for c in columns])
        return wide.unpivot(["part", "name"], list(columns), "figure", "value")

    parts = [spark.createDataFrame([("counts", "", k, float(v)) for k, v in result["counts"].items()], "part string, name string, figure string, value double")]
    parts.append(figures("trips_overview", read["trips_overview"], None, *read["trips_overview"].columns))
    parts.append(figures("weather_line_count", read["weather_line_count"], "metric", "value"))
    parts += [figures(p, read[p].groupBy("column_name").agg(F.count("value").alias("values")), "column_name", "values") for p in ("trips_distinct_values", "weather_distinct_values")]
    parts.append(figures("weather_numeric_stats", read["weather_numeric_stats"], "column_name", "non_null_count", "mean_value", "median_value", "stddev_value", "min_value", "max_value"))
    parts.append(figures("weather_mode_top10", read["weather_mode_top10"].where("rank = 1"), "column_name", "value", "count"))
    parts += [figures(p, read[p].agg(F.count(F.lit(1)).alias("rows")), None, "rows") for p in ("trips_sample", "weather_sample")]
    for table in ("baseline_predictions", "model_predictions"):
        sums = spark.read.parquet(paths.out(table)).agg(F.count(F.lit(1)).alias("rows"), F.sum("label").alias("labels"), F.avg("prediction").alias("mean_prediction"))
        parts.append(figures(table, sums, None, "rows", "labels", "mean_prediction"))
    parts.append(figures("metrics", result["metrics"], "model_name", "mae", "rmse", "mape", "test_rows"))
    return rounded(reduce(DataFrame.unionByName, parts), 4)


QUERIES: dict[str, Query] = {
    "trips_clean": q_trips_clean,
    "hourly_demand": q_hourly_demand,
    "weather_parse": q_weather_parse,
    "weather_clean": q_weather_clean,
    "hourly_weather": q_hourly_weather,
    "features": q_features,
    "split_counts": q_split_counts,
    "global_mean": q_global_mean,
    "zone_hour_mean": q_zone_hour_mean,
    "baseline_predictions": q_baseline_predictions,
    "baseline_metrics": q_baseline_metrics,
    "linear_predictions": q_linear_predictions,
    "model_metrics": q_model_metrics,
    "ols_predictions": q_ols_predictions,
    "model_comparison": q_model_comparison,
    "elastic_net_coefficients": q_elastic_net_coefficients,
    "linear_coefficients": q_linear_coefficients,
    "model_features": q_model_features,
    "pipeline_features": q_pipeline_features,
    "pipeline_baseline_predictions": q_pipeline_baseline_predictions,
    "profile_trip_tables": q_profile_trip_tables,
    "profile_weather_tables": q_profile_weather_tables,
    "metrics_csv_roundtrip": q_metrics_csv_roundtrip,
    "null_counts": q_null_counts,
    "numeric_range": q_numeric_range,
    "schema_report": q_schema_report,
    "record_count": q_record_count,
    "trip_overview": q_trip_overview,
    "distinct_values": q_distinct_values,
    "distinct_lists": q_distinct_lists,
    "distinct_positions": q_distinct_positions,
    "distinct_store_flags": q_distinct_store_flags,
    "distinct_stations": q_distinct_stations,
    "distinct_sky_cover_codes": q_distinct_sky_cover_codes,
    "distinct_wind_directions": q_distinct_wind_directions,
    "numeric_stats": q_numeric_stats,
    "mode_top10": q_mode_top10,
    "stage_counts": q_stage_counts,
    "trips_roundtrip": q_trips_roundtrip,
    "trips_drift": q_trips_drift,
    "contracts": q_contracts,
    "chain_report": q_chain_report,
    "trips_rerun_roundtrip": q_trips_rerun_roundtrip,
    "features_incremental": q_features_incremental,
    "weather_roundtrip": q_weather_roundtrip,
    "trips_preview": q_trips_preview,
}
