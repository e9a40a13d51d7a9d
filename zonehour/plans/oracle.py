"""DuckDB twins of the catalogue queries (the correctness oracle).

They start from the same raw rows as the Spark side (the adapter
expressions of ``sources.adapters``, valid in both dialects) and then
re-implement every operator in plain SQL: weather lines are printed and
re-parsed with DuckDB string functions, day of week is shifted from DuckDB's
0 = Sunday, integer casts truncate, and DuckDB's HUGEINT sums are cast to
BIGINT. Aggregated doubles are rounded to 6 places as on the Spark side.
"""

from __future__ import annotations

from zonehour.config import MSG_MISSING_COLUMNS, MSG_NO_TEST_ROWS, MSG_NO_TRAIN_ROWS, WEATHER_FIELDS
from zonehour.operators.profile import TRIP_DISTINCT_COLUMNS, TRIP_NULL_COUNT_NAMES, TRIP_RANGE_COLUMNS
from zonehour.plans.catalog import QUERY_CONFIG
from zonehour.sources.adapters import (
    TRIP_COLUMNS,
    TRIP_EVENT_FILTER,
    WEATHER_EVENT_FILTER,
    WEATHER_FIELD_EXPRS,
    WEATHER_LINE_EXPR,
)

_TRIP_LO, _TRIP_HI = QUERY_CONFIG.trips.window
_W_LO, _W_HI = QUERY_CONFIG.weather.window
_ZONE = QUERY_CONFIG.weather.local_zone
_END = QUERY_CONFIG.forecast.train_end
_BASELINE = QUERY_CONFIG.forecast.baseline_name

_TRIPS_RAW = (
    "trips_raw AS (SELECT "
    + ", ".join(f"{expr} AS {name}" for name, expr in TRIP_COLUMNS)
    + f" FROM events WHERE {TRIP_EVENT_FILTER})"
)

_TRIPS_CLEAN = f"""trips_clean AS (
  SELECT VendorID,
         CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
         CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
         CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS pickup_day_of_week,
         CAST(PULocationID AS INTEGER) AS PULocationID,
         CAST(DOLocationID AS INTEGER) AS DOLocationID,
         CAST(trunc(passenger_count) AS INTEGER) AS passenger_count,
         CAST(trip_distance AS DOUBLE) AS trip_distance,
         CAST(RatecodeID AS INTEGER) AS RatecodeID,
         CAST(payment_type AS INTEGER) AS payment_type,
         lower(trim(store_and_fwd_flag)) AS store_and_fwd_flag_normalized,
         CAST(fare_amount AS DOUBLE) AS fare_amount,
         CAST(total_amount AS DOUBLE) AS total_amount,
         CASE WHEN trip_distance >= 5.0 THEN 1 ELSE 0 END AS is_long_trip,
         CASE WHEN fare_amount >= 20.0 THEN 1 ELSE 0 END AS is_high_fare
  FROM trips_raw
  WHERE tpep_pickup_datetime IS NOT NULL
    AND PULocationID > 0 AND DOLocationID > 0
    AND trunc(passenger_count) >= 0
    AND trip_distance > 0 AND fare_amount >= 0 AND total_amount >= 0
    AND CAST(tpep_pickup_datetime AS DATE) BETWEEN DATE '{_TRIP_LO}' AND DATE '{_TRIP_HI}')"""

_WEATHER_FIELDS = (
    "wfields AS (SELECT "
    + ", ".join(f"{expr} AS {name}" for name, expr in WEATHER_FIELD_EXPRS)
    + f" FROM events WHERE {WEATHER_EVENT_FILTER})"
)
_WEATHER_LINES = f"wlines AS (SELECT station_id, {WEATHER_LINE_EXPR} AS value FROM wfields)"
_WEATHER_TOKENS = "wtokens AS (SELECT station_id, string_split_regex(trim(value), '\\s+') AS parts FROM wlines)"
_WEATHER_PARSED = (
    "weather_parsed AS (SELECT station_id, "
    + ", ".join(f"TRY_CAST(parts[{i + 1}] AS INTEGER) AS {name}" for i, name in enumerate(WEATHER_FIELDS))
    + " FROM wtokens WHERE len(parts) >= 12)"
)


def _scaled(c: str) -> str:
    return f"CASE WHEN {c} <> -9999 THEN CAST({c} AS DOUBLE) / 10 END"


def _precip(c: str) -> str:
    return f"CASE WHEN {c} = -9999 THEN NULL WHEN {c} = -1 THEN 0.1::DOUBLE ELSE CAST({c} AS DOUBLE) / 10 END"


_WEATHER_DECODED = f"""weather_decoded AS (
  SELECT *,
         {_scaled('air_temp_tenths_c')} AS air_temp_c,
         {_scaled('dew_point_tenths_c')} AS dew_point_c,
         {_scaled('sea_level_pressure_tenths_hpa')} AS sea_level_pressure_hpa,
         {_scaled('wind_speed_tenths_mps')} AS wind_speed_mps,
         {_precip('precipitation_1hr_tenths_mm')} AS precipitation_1hr_mm,
         {_precip('precipitation_6hr_tenths_mm')} AS precipitation_6hr_mm
  FROM weather_parsed)"""

_WEATHER_TS = """weather_ts AS (
  SELECT *,
         try_strptime(printf('%04d-%02d-%02d %02d:00:00', year, month, day, hour_utc), '%Y-%m-%d %H:%M:%S')
           AS observation_ts_utc
  FROM weather_decoded)"""

_WEATHER_CLEAN = f"""weather_clean AS (
  SELECT station_id,
         observation_ts_utc,
         observation_ts_local,
         CAST(observation_ts_local AS DATE) AS observation_date_local,
         CAST(hour(observation_ts_local) AS INTEGER) AS observation_hour_local,
         air_temp_c, dew_point_c, sea_level_pressure_hpa, wind_direction_degrees, wind_speed_mps,
         sky_cover_code, precipitation_1hr_mm, precipitation_6hr_mm,
         CASE WHEN precipitation_1hr_mm > 0 THEN 1 ELSE 0 END AS is_rain_1hr
  FROM (SELECT *, CAST((observation_ts_utc AT TIME ZONE 'UTC') AT TIME ZONE '{_ZONE}' AS TIMESTAMP)
                   AS observation_ts_local FROM weather_ts)
  WHERE CAST(observation_ts_local AS DATE) BETWEEN DATE '{_W_LO}' AND DATE '{_W_HI}')"""

_DEMAND = """demand AS (
  SELECT pickup_date, pickup_hour, PULocationID, count(*) AS trip_count,
         avg(trip_distance) AS avg_trip_distance, avg(fare_amount) AS avg_fare_amount
  FROM trips_clean GROUP BY pickup_date, pickup_hour, PULocationID)"""

_HOURLY_WEATHER = """hourly_weather AS (
  SELECT observation_date_local, observation_hour_local,
         avg(air_temp_c) AS avg_temp_c, avg(wind_speed_mps) AS avg_wind_speed_mps,
         avg(precipitation_1hr_mm) AS avg_precipitation_1hr_mm,
         max(is_rain_1hr) AS is_rain_hour, count(DISTINCT station_id) AS station_count
  FROM weather_clean GROUP BY observation_date_local, observation_hour_local)"""

_FEATURES = """features AS (
  SELECT d.pickup_date, d.pickup_hour, d.PULocationID, d.trip_count,
         coalesce(d.avg_trip_distance, 0.0) AS avg_trip_distance,
         coalesce(d.avg_fare_amount, 0.0) AS avg_fare_amount,
         coalesce(w.avg_temp_c, 0.0) AS avg_temp_c,
         coalesce(w.avg_wind_speed_mps, 0.0) AS avg_wind_speed_mps,
         coalesce(w.avg_precipitation_1hr_mm, 0.0) AS avg_precipitation_1hr_mm,
         coalesce(w.is_rain_hour, 0) AS is_rain_hour,
         coalesce(w.station_count, 0) AS station_count,
         CAST(dayofweek(d.pickup_date) + 1 AS INTEGER) AS day_of_week,
         CASE WHEN dayofweek(d.pickup_date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
  FROM demand d LEFT JOIN hourly_weather w
    ON d.pickup_date = w.observation_date_local AND d.pickup_hour = w.observation_hour_local)"""

_SPLITS = f"""train AS (SELECT * FROM features WHERE pickup_date <= DATE '{_END}'),
test AS (SELECT * FROM features WHERE pickup_date > DATE '{_END}')"""

_BASELINE_PREDS = """zone_hour AS (
  SELECT PULocationID, pickup_hour, avg(trip_count) AS baseline_prediction FROM train GROUP BY PULocationID, pickup_hour),
baseline_preds AS (
  SELECT t.pickup_date, t.pickup_hour, t.PULocationID, t.trip_count AS label,
         coalesce(z.baseline_prediction, (SELECT avg(trip_count) FROM train)) AS prediction
  FROM test t LEFT JOIN zone_hour z ON t.PULocationID = z.PULocationID AND t.pickup_hour = z.pickup_hour)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_TRIP_CTES = (_TRIPS_RAW, _TRIPS_CLEAN)
_WEATHER_PARSE_CTES = (_WEATHER_FIELDS, _WEATHER_LINES, _WEATHER_TOKENS, _WEATHER_PARSED, _WEATHER_DECODED)
_WEATHER_CTES = _WEATHER_PARSE_CTES + (_WEATHER_TS, _WEATHER_CLEAN)
_FEATURE_CTES = _TRIP_CTES + _WEATHER_CTES + (_DEMAND, _HOURLY_WEATHER, _FEATURES)

_STAT_COLUMNS = ("air_temp_c", "wind_speed_mps", "precipitation_1hr_mm")


def _numeric_stats_sql() -> str:
    parts = [
        f"""SELECT '{c}' AS column_name, count({c}) AS non_null_count, round(avg({c}), 6) AS mean_value,
       round(quantile_disc({c}, 0.5), 6) AS median_value, round(stddev_samp({c}), 6) AS stddev_value,
       round(min({c}), 6) AS min_value, round(max({c}), 6) AS max_value FROM weather_decoded"""
        for c in _STAT_COLUMNS
    ]
    return _with(*_WEATHER_PARSE_CTES) + "\nUNION ALL\n".join(parts)


def _mode_top10_sql() -> str:
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value FROM weather_decoded WHERE {c} IS NOT NULL" for c in _STAT_COLUMNS
    )
    return (
        _with(*_WEATHER_PARSE_CTES, f"long AS ({long})")
        + """SELECT column_name, value, "count", "rank" FROM (
  SELECT column_name, value, count(*) AS "count",
         CAST(row_number() OVER (PARTITION BY column_name ORDER BY count(*) DESC, value ASC) AS INTEGER) AS "rank"
  FROM long GROUP BY column_name, value) WHERE "rank" <= 10"""
    )


def _profile_weather_sql() -> str:
    nothing = "NULL::VARCHAR AS text, NULL::DOUBLE AS value"
    lists = [f"SELECT DISTINCT 'distinct_values', '{c}', CAST({c} AS VARCHAR), NULL::DOUBLE, NULL::BIGINT FROM weather_decoded WHERE {keep}"
             for c, keep in (("station_id", "station_id IS NOT NULL"), ("wind_direction_degrees", "wind_direction_degrees <> -9999"), ("sky_cover_code", "sky_cover_code <> -9999"))]
    stats = [f"SELECT 'numeric_stats', '{c}', NULL::VARCHAR, round(quantile_disc({c}, 0.5), 6), count({c}) FROM weather_decoded" for c in _STAT_COLUMNS]
    modes = [f"""SELECT * FROM (SELECT 'mode_top10', '{c}', NULL::VARCHAR, round({c}, 6), count(*) FROM weather_decoded
      WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 10)""" for c in _STAT_COLUMNS]  # fmt: skip
    counted = f"SELECT 'line_count' AS profile, 'raw_line_count' AS column_name, {nothing}, count(*) AS n FROM wlines"
    return _with(*_WEATHER_PARSE_CTES) + "\nUNION ALL\n".join([counted, *lists, *stats, *modes])


def _null_counts_sql() -> str:
    names = [
        ("tpep_pickup_datetime", "null_pickup_ts"),
        ("PULocationID", "null_pu_location"),
        ("DOLocationID", "null_do_location"),
        ("trip_distance", "null_trip_distance"),
        ("fare_amount", "null_fare_amount"),
        ("total_amount", "null_total_amount"),
        ("passenger_count", "null_passenger_count"),
        ("RatecodeID", "null_ratecode"),
        ("store_and_fwd_flag", "null_store_and_fwd_flag"),
    ]
    cols = ", ".join(f"CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {n}" for c, n in names)
    return _with(_TRIPS_RAW) + f"SELECT {cols} FROM trips_raw"


def _numeric_range_sql() -> str:
    cols = []
    for c in ("trip_distance", "fare_amount", "total_amount"):
        cols += [f"round(min({c}), 6) AS min_{c}", f"round(max({c}), 6) AS max_{c}", f"round(avg({c}), 6) AS avg_{c}"]
    return _with(_TRIPS_RAW) + f"SELECT {', '.join(cols)} FROM trips_raw"


_CLEAN_COLS = (
    "pickup_date, pickup_hour, pickup_day_of_week, PULocationID, DOLocationID, passenger_count, trip_distance, "
    "RatecodeID, payment_type, store_and_fwd_flag_normalized, fare_amount, total_amount, is_long_trip, is_high_fare"
)
_PREVIEW_ORDER = ", ".join(f"{c.strip()} ASC NULLS FIRST" for c in _CLEAN_COLS.split(","))

_WEATHER_CLEAN_COLS = (
    "station_id, observation_ts_utc, observation_ts_local, observation_date_local, observation_hour_local, "
    "air_temp_c, dew_point_c, sea_level_pressure_hpa, wind_direction_degrees, wind_speed_mps, sky_cover_code, "
    "precipitation_1hr_mm, precipitation_6hr_mm, is_rain_1hr"
)


def _stage_counts_sql() -> str:
    stages = [
        ("raw_trips", "trips_raw"),
        ("trips_clean", "trips_clean"),
        ("weather_lines", "wlines"),
        ("weather_parsed", "weather_parsed"),
        ("weather_clean", "weather_clean"),
        ("features", "features"),
        ("train", "train"),
        ("test", "test"),
    ]
    body = "\nUNION ALL\n".join(f"SELECT '{s}' AS stage, count(*) AS \"rows\" FROM {t}" for s, t in stages)
    return _with(*_FEATURE_CTES, _SPLITS) + body


def _trip_overview_sql() -> str:
    names = [
        ("tpep_pickup_datetime", "null_pickup_ts"),
        ("PULocationID", "null_pu_location"),
        ("DOLocationID", "null_do_location"),
        ("trip_distance", "null_trip_distance"),
        ("fare_amount", "null_fare_amount"),
        ("total_amount", "null_total_amount"),
    ]
    cols = ["count(*) AS record_count"]
    cols += [f"CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {n}" for c, n in names]
    for c in ("trip_distance", "fare_amount", "total_amount"):
        cols += [f"round(min({c}), 6) AS min_{c}", f"round(max({c}), 6) AS max_{c}", f"round(avg({c}), 6) AS avg_{c}"]
    return _with(_TRIPS_RAW) + f"SELECT {', '.join(cols)} FROM trips_raw"


def _distinct_lists_sql() -> str:
    parts = [
        f"SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM trips_raw WHERE {c} IS NOT NULL"
        for c in ("VendorID", "RatecodeID", "payment_type", "store_and_fwd_flag")
    ]
    return _with(_TRIPS_RAW) + "\nUNION ALL\n".join(parts)


def _distinct_positions_sql() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, row_number() OVER (ORDER BY {c}) AS position "
        f"FROM (SELECT DISTINCT {c} FROM trips_raw WHERE {c} IS NOT NULL)"
        for c in ("VendorID", "RatecodeID", "payment_type", "store_and_fwd_flag")
    ]
    return _with(_TRIPS_RAW) + "\nUNION ALL\n".join(parts)


_OLS_PREDS = """ols_preds AS (
  SELECT pickup_date, pickup_hour, PULocationID, trip_count AS label, i + s * avg_temp_c AS prediction,
         avg_temp_c, avg_wind_speed_mps, avg_precipitation_1hr_mm, is_rain_hour
  FROM test, (SELECT regr_slope(trip_count, avg_temp_c) AS s, regr_intercept(trip_count, avg_temp_c) AS i FROM train)
)"""

# zones by number of rows, then as text; the one-hot has one place more, for zones unseen in training
_ZONES = """zones AS (
  SELECT PULocationID, row_number() OVER (ORDER BY count(*) DESC, CAST(PULocationID AS VARCHAR)) - 1 AS zone_index, count(*) OVER () AS n_zones
  FROM train GROUP BY PULocationID)"""
_DENSE = [c for c in QUERY_CONFIG.forecast.features if c != "PULocationID_ohe"]
_MODEL_FEATURES = f"""SELECT pickup_date, pickup_hour, PULocationID, CAST(zone_index AS INTEGER) AS zone_index, zone_index AS hot_place,
  1.0::DOUBLE AS hot_sum, CAST(n_zones + 1 + {len(_DENSE)} AS INTEGER) AS vector_size,
  {", ".join(f"round(CAST({c} AS DOUBLE), 6) AS x_{c}" for c in _DENSE)}
FROM train JOIN zones USING (PULocationID)"""

# closed form of the one-feature elastic net on standardised x and y
_ELASTIC_NET = """SELECT round(slope, 4) AS slope, round(my - slope * mx, 4) AS intercept FROM (
  SELECT *, sign(c) * greatest(abs(c) - 0.02 / sy * 0.1, 0) / ((n - 1) / n + 0.02 / sy * 0.9) * sy / sx AS slope FROM (
    SELECT covar_pop(avg_temp_c, trip_count) / (stddev_samp(avg_temp_c) * stddev_samp(trip_count)) AS c, CAST(count(*) AS DOUBLE) AS n,
           stddev_samp(avg_temp_c) AS sx, stddev_samp(trip_count) AS sy, avg(avg_temp_c) AS mx, avg(trip_count) AS my FROM train))"""

# the default model as a plain proximal gradient descent on the whole Gram matrix of standardised features,
# one-hot columns written out; each step of the recursion multiplies the matrix with the coefficients once
_FC = QUERY_CONFIG.forecast
_LINEAR_STEPS = 3000
_LINEAR = f"""target AS (SELECT avg(trip_count) AS my, stddev_samp(trip_count) AS sy, CAST(count(*) AS DOUBLE) AS n FROM train),
penalty AS (SELECT {_FC.reg_param} / sy * {_FC.elastic_net} AS l1, {_FC.reg_param} / sy * (1 - {_FC.elastic_net}) AS l2 FROM target),
numbered AS (SELECT row_number() OVER () AS r, * FROM train),
dense AS (UNPIVOT (SELECT r, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _DENSE)} FROM numbered) ON {", ".join(_DENSE)} INTO NAME term VALUE x),
hot AS (SELECT r, 'zone ' || zone AS term, CASE WHEN PULocationID = zone THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS x
  FROM numbered, (SELECT DISTINCT PULocationID AS zone FROM train)),
cells AS (SELECT * FROM dense UNION ALL SELECT * FROM hot),
terms AS (SELECT *, row_number() OVER (ORDER BY term) AS i FROM (SELECT term, avg(x) AS mx, stddev_samp(x) AS sx FROM cells GROUP BY term) WHERE sx > 0),
scaled AS MATERIALIZED (SELECT r, i, (x - mx) / sx AS x FROM cells JOIN terms USING (term)),
gram AS (SELECT a.i AS i, b.i AS j, avg(a.x * b.x) AS g FROM scaled a JOIN scaled b USING (r) GROUP BY a.i, b.i),
pull AS (SELECT i, avg(x * (trip_count - my) / sy) AS c FROM scaled JOIN numbered USING (r), target GROUP BY i),
matrix AS MATERIALIZED (SELECT list(g_row ORDER BY i) AS m, list(c ORDER BY i) AS c, max(high) AS high FROM
  (SELECT i, list(g ORDER BY j) AS g_row, sum(abs(g)) AS high FROM gram GROUP BY i) JOIN pull USING (i)),
steps AS (
  SELECT 0 AS k, list_transform(c, lambda x: 0.0::DOUBLE) AS w FROM matrix
  UNION ALL
  SELECT k + 1, list_transform(moved, lambda v: sign(v) * greatest(abs(v) - l1 / (high + l2), 0)) FROM (
    SELECT k, high, l1, l2, list_transform(range(1, len(w) + 1), lambda i: w[i] - (list_dot_product(m[i], w) + l2 * w[i] - c[i]) / (high + l2)) AS moved
    FROM steps, matrix, penalty WHERE k < {_LINEAR_STEPS})
),
weights AS MATERIALIZED (SELECT term, sx, mx, sy * (SELECT w FROM steps WHERE k = {_LINEAR_STEPS})[i] / sx AS b FROM terms, target),
intercept AS MATERIALIZED (SELECT my - (SELECT sum(b * mx) FROM weights) AS b FROM target),
linear_preds AS (
  SELECT pickup_date, pickup_hour, PULocationID, trip_count AS label, (SELECT b FROM intercept)
    + {" + ".join(f"{c} * coalesce((SELECT b FROM weights WHERE term = '{c}'), 0)" for c in _DENSE)} + coalesce(z.b, 0) AS prediction,
    avg_temp_c, avg_wind_speed_mps, avg_precipitation_1hr_mm, is_rain_hour
  FROM test LEFT JOIN weights z ON z.term = 'zone ' || PULocationID)"""


def _schema_report_sql() -> str:
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz"}
    kind = " ".join(f"WHEN '{d}' THEN '{s}'" for d, s in kinds.items())
    sources = (("trips", _with(_TRIPS_RAW) + "SELECT * FROM trips_raw"), ("weather", _with(*_WEATHER_PARSE_CTES) + "SELECT * FROM weather_decoded"))
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS profile, CAST(row_number() OVER () AS INTEGER) AS position, column_name, CASE column_type {kind} END AS data_type FROM (DESCRIBE {sql})"
        for name, sql in sources
    )


def _contracts_sql() -> str:
    missing = MSG_MISSING_COLUMNS.format(name="trips", columns="")
    needed = ", ".join(f"'{c}'" for c in TRIP_RANGE_COLUMNS)
    columns = ", ".join(f"('{c}')" for c, _ in TRIP_COLUMNS)
    no_train, no_test = MSG_NO_TRAIN_ROWS.format(date="@"), MSG_NO_TEST_ROWS.format(date="@")
    return _with(*_FEATURE_CTES) + f"""SELECT 'columns' AS contract, c AS subject, CASE WHEN c IN ({needed}) THEN '{missing}' || c END AS message FROM (VALUES {columns}) v(c)
UNION ALL
SELECT 'rows', CAST(d AS VARCHAR), CASE WHEN NOT EXISTS (SELECT 1 FROM features WHERE pickup_date <= d) THEN replace('{no_train}', '@', CAST(d AS VARCHAR))
  WHEN NOT EXISTS (SELECT 1 FROM features WHERE pickup_date > d) THEN replace('{no_test}', '@', CAST(d AS VARCHAR)) END
FROM (SELECT CAST(min(pickup_date) - INTERVAL 1 DAY AS DATE) AS d FROM features UNION ALL SELECT min(pickup_date) FROM features UNION ALL SELECT max(pickup_date) FROM features)"""


def _chain_report_sql() -> str:
    rows = []

    def figures(part: str, name: str, figs: dict[str, str], source: str) -> None:
        rows.extend(f"SELECT '{part}' AS part, {name} AS name, '{f}' AS figure, round(CAST({x} AS DOUBLE), 4) AS value FROM {source}" for f, x in figs.items())

    for stage, table in (("raw_trips", "trips_raw"), ("trips_clean", "trips_clean"), ("weather_lines", "wlines"), ("weather_clean", "weather_clean"), ("features", "features"), ("train", "train"), ("test", "test")):
        figures("counts", "''", {stage: "count(*)"}, table)
    overview = {"record_count": "count(*)"} | {out: f"count(*) - count({c})" for c, out in TRIP_NULL_COUNT_NAMES}
    overview |= {f"{f}_{c}": f"{f}({c})" for c in TRIP_RANGE_COLUMNS for f in ("min", "max", "avg")}
    figures("trips_overview", "''", overview, "trips_raw")
    figures("weather_line_count", "'raw_line_count'", {"value": "count(*)"}, "wlines")
    for c in TRIP_DISTINCT_COLUMNS:
        figures("trips_distinct_values", f"'{c}'", {"values": f"count(DISTINCT {c})"}, "trips_raw")
    for c in ("station_id", "wind_direction_degrees", "sky_cover_code"):
        figures("weather_distinct_values", f"'{c}'", {"values": f"count(DISTINCT {c})"}, f"weather_decoded WHERE CAST({c} AS VARCHAR) <> '-9999'")
    for c in _STAT_COLUMNS:
        stats = {"non_null_count": f"count({c})", "mean_value": f"avg({c})", "median_value": f"quantile_disc({c}, 0.5)", "stddev_value": f"stddev_samp({c})", "min_value": f"min({c})", "max_value": f"max({c})"}
        figures("weather_numeric_stats", f"'{c}'", stats, "weather_decoded")
        top = f"(SELECT {c} AS x, count(*) AS n FROM weather_decoded WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY n DESC, {c} LIMIT 1)"
        figures("weather_mode_top10", f"'{c}'", {"value": "x", "count": "n"}, top)
    figures("trips_sample", "''", {"rows": "least(20, count(*))"}, "trips_raw")
    figures("weather_sample", "''", {"rows": "least(20, count(*))"}, "weather_decoded")
    for part, table in (("baseline_predictions", "baseline_preds"), ("model_predictions", "linear_preds")):
        figures(part, "''", {"rows": "count(*)", "labels": "sum(label)", "mean_prediction": "avg(prediction)"}, table)
    figures("metrics", "model_name", {c: c for c in ("mae", "rmse", "mape", "test_rows")}, "metrics")
    names = ((_BASELINE, "baseline_preds"), (_FC.linear_name, "linear_preds"))
    metrics = "metrics AS (" + " UNION ALL ".join(_metrics_sql(name, table) for name, table in names) + ")"
    return _recursive(*_FEATURE_CTES, _SPLITS, _BASELINE_PREDS, _LINEAR, metrics) + "\nUNION ALL\n".join(rows)


def _recursive(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def _metrics_sql(name: str, table: str, places: int = 6) -> str:
    return f"""SELECT '{name}' AS model_name, round(avg(abs(prediction - label)), {places}) AS mae,
       round(sqrt(avg(pow(prediction - label, 2))), {places}) AS rmse,
       round(coalesce(avg(CASE WHEN label > 0 THEN abs((prediction - label) / label) END), 'NaN'::DOUBLE), {places}) AS mape,
       count(*) AS test_rows, '{_END}' AS train_end_date FROM {table}"""


ORACLE_SQL: dict[str, str] = {
    "trips_clean": _with(*_TRIP_CTES) + f"SELECT {_CLEAN_COLS} FROM trips_clean",
    "hourly_demand": _with(*_TRIP_CTES, _DEMAND)
    + "SELECT pickup_date, pickup_hour, PULocationID, trip_count, round(avg_trip_distance, 6) AS avg_trip_distance, "
    "round(avg_fare_amount, 6) AS avg_fare_amount FROM demand",
    "weather_parse": _with(*_WEATHER_PARSE_CTES[:-1]) + "SELECT *, 'station_id=' || lower(station_id) AS source_folder FROM weather_parsed",
    "weather_clean": _with(*_WEATHER_CTES) + f"SELECT {_WEATHER_CLEAN_COLS} FROM weather_clean",
    "hourly_weather": _with(*_WEATHER_CTES, _HOURLY_WEATHER)
    + "SELECT observation_date_local, observation_hour_local, round(avg_temp_c, 6) AS avg_temp_c, "
    "round(avg_wind_speed_mps, 6) AS avg_wind_speed_mps, round(avg_precipitation_1hr_mm, 6) AS avg_precipitation_1hr_mm, "
    "is_rain_hour, station_count FROM hourly_weather",
    "features": _with(*_FEATURE_CTES)
    + "SELECT pickup_date, pickup_hour, PULocationID, trip_count, round(avg_trip_distance, 6) AS avg_trip_distance, "
    "round(avg_fare_amount, 6) AS avg_fare_amount, round(avg_temp_c, 6) AS avg_temp_c, "
    "round(avg_wind_speed_mps, 6) AS avg_wind_speed_mps, round(avg_precipitation_1hr_mm, 6) AS avg_precipitation_1hr_mm, "
    "is_rain_hour, station_count, day_of_week, is_weekend FROM features",
    "split_counts": _with(*_FEATURE_CTES)
    + f"SELECT count(*) FILTER (WHERE pickup_date <= DATE '{_END}') AS train_rows, "
    f"count(*) FILTER (WHERE pickup_date > DATE '{_END}') AS test_rows FROM features",
    "global_mean": _with(*_FEATURE_CTES, _SPLITS) + "SELECT round(avg(trip_count), 6) AS mean_trip_count FROM train",
    "zone_hour_mean": _with(*_FEATURE_CTES, _SPLITS)
    + "SELECT PULocationID, pickup_hour, round(avg(trip_count), 6) AS baseline_prediction FROM train "
    "GROUP BY PULocationID, pickup_hour",
    "baseline_predictions": _with(*_FEATURE_CTES, _SPLITS, _BASELINE_PREDS)
    + "SELECT pickup_date, pickup_hour, PULocationID, label, round(prediction, 6) AS prediction FROM baseline_preds",
    "baseline_metrics": _with(*_FEATURE_CTES, _SPLITS, _BASELINE_PREDS)
    + f"""SELECT '{_BASELINE}' AS model_name,
       round(avg(abs(prediction - label)), 6) AS mae,
       round(sqrt(avg(pow(prediction - label, 2))), 6) AS rmse,
       round(coalesce(avg(CASE WHEN label > 0 THEN abs((prediction - label) / label) END), 'NaN'::DOUBLE), 6) AS mape,
       count(*) AS test_rows,
       '{_END}' AS train_end_date
FROM baseline_preds WHERE prediction IS NOT NULL AND label IS NOT NULL""",
    "null_counts": _null_counts_sql(),
    "numeric_range": _numeric_range_sql(),
    "schema_report": _schema_report_sql(),
    "record_count": _with(_TRIPS_RAW) + "SELECT 'record_count' AS metric, count(*) AS value FROM trips_raw",
    "trip_overview": _trip_overview_sql(),
    "distinct_lists": _distinct_lists_sql(),
    "distinct_positions": _distinct_positions_sql(),
    "distinct_values": _with(_TRIPS_RAW)
    + "SELECT DISTINCT RatecodeID FROM trips_raw WHERE RatecodeID IS NOT NULL ORDER BY RatecodeID",
    "distinct_store_flags": _with(_TRIPS_RAW)
    + "SELECT DISTINCT store_and_fwd_flag FROM trips_raw WHERE store_and_fwd_flag IS NOT NULL ORDER BY 1",
    "distinct_stations": _with(*_WEATHER_PARSE_CTES) + "SELECT DISTINCT station_id FROM weather_decoded ORDER BY 1",
    "distinct_sky_cover_codes": _with(*_WEATHER_PARSE_CTES)
    + "SELECT DISTINCT sky_cover_code FROM weather_decoded WHERE sky_cover_code IS NOT NULL AND sky_cover_code <> -9999 ORDER BY 1",
    "distinct_wind_directions": _with(*_WEATHER_PARSE_CTES)
    + "SELECT DISTINCT wind_direction_degrees FROM weather_decoded "
    "WHERE wind_direction_degrees IS NOT NULL AND wind_direction_degrees <> -9999 ORDER BY 1",
    "numeric_stats": _numeric_stats_sql(),
    "mode_top10": _mode_top10_sql(),
    "ols_predictions": _with(*_FEATURE_CTES, _SPLITS, _OLS_PREDS)
    + "SELECT pickup_date, pickup_hour, PULocationID, label, round(prediction, 6) AS prediction, "
    "round(avg_temp_c, 6) AS avg_temp_c, round(avg_wind_speed_mps, 6) AS avg_wind_speed_mps, "
    "round(avg_precipitation_1hr_mm, 6) AS avg_precipitation_1hr_mm, is_rain_hour FROM ols_preds",
    "linear_predictions": _recursive(*_FEATURE_CTES, _SPLITS, _LINEAR)
    + "SELECT pickup_date, pickup_hour, PULocationID, label, round(prediction, 4) AS prediction, "
    "round(avg_temp_c, 6) AS avg_temp_c, round(avg_wind_speed_mps, 6) AS avg_wind_speed_mps, "
    "round(avg_precipitation_1hr_mm, 6) AS avg_precipitation_1hr_mm, is_rain_hour FROM linear_preds",
    "linear_coefficients": _recursive(*_FEATURE_CTES, _SPLITS, _LINEAR)
    + "SELECT term, round(coalesce(b, 0), 4) AS coefficient FROM weights RIGHT JOIN (SELECT DISTINCT term FROM cells) USING (term) "
    "UNION ALL SELECT 'intercept', round(b, 4) FROM intercept",
    "elastic_net_coefficients": _with(*_FEATURE_CTES, _SPLITS) + _ELASTIC_NET,
    "model_features": _with(*_FEATURE_CTES, _SPLITS, _ZONES) + _MODEL_FEATURES,
    "pipeline_features": "",
    "pipeline_baseline_predictions": "",
    "contracts": _contracts_sql(),
    "chain_report": _chain_report_sql(),
    "trips_drift": _with(*_TRIP_CTES)
    + f"SELECT {_CLEAN_COLS.replace('store_and_fwd_flag_normalized', 'CASE WHEN VendorID = 1 THEN store_and_fwd_flag_normalized END AS store_and_fwd_flag_normalized')} FROM trips_clean",
    "trips_rerun_roundtrip": "",
    "features_incremental": "",
    "profile_trip_tables": "",
    "profile_weather_tables": _profile_weather_sql(),
    "metrics_csv_roundtrip": "",
    "model_comparison": "",
    "stage_counts": _stage_counts_sql(),
    "trips_roundtrip": _with(*_TRIP_CTES) + f"SELECT {_CLEAN_COLS} FROM trips_clean",
    "weather_roundtrip": _with(*_WEATHER_CTES) + f"SELECT {_WEATHER_CLEAN_COLS} FROM weather_clean",
    "trips_preview": _with(*_TRIP_CTES) + f"SELECT {_CLEAN_COLS} FROM trips_clean ORDER BY {_PREVIEW_ORDER} LIMIT 20",
}

# what the jobs write equals what the functions return
ORACLE_SQL["pipeline_features"] = ORACLE_SQL["features"]
ORACLE_SQL["trips_rerun_roundtrip"] = ORACLE_SQL["trips_clean"]
ORACLE_SQL["features_incremental"] = ORACLE_SQL["features"]
ORACLE_SQL["pipeline_baseline_predictions"] = ORACLE_SQL["baseline_predictions"]
ORACLE_SQL["profile_trip_tables"] = ORACLE_SQL["distinct_lists"]
ORACLE_SQL["metrics_csv_roundtrip"] = ORACLE_SQL["baseline_metrics"]
ORACLE_SQL["model_comparison"] = (
    _with(*_FEATURE_CTES, _SPLITS, _BASELINE_PREDS, _OLS_PREDS)
    + "\nUNION ALL\n".join(_metrics_sql(name, table) for name, table in ((_BASELINE, "baseline_preds"), ("ols_temperature", "ols_preds")))
)
ORACLE_SQL["model_metrics"] = (
    _recursive(*_FEATURE_CTES, _SPLITS, _BASELINE_PREDS, _LINEAR)
    + "\nUNION ALL\n".join(_metrics_sql(name, table, 4) for name, table in ((_BASELINE, "baseline_preds"), (_FC.linear_name, "linear_preds")))
)
