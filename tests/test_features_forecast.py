"""Join, split, baseline, metrics, model (FIXTURES 2.3) and contracts."""

from datetime import date

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from zonehour.config import ForecastSpec, WeatherSpec
from zonehour.operators.features import FEATURE_COLUMNS, build_features, hourly_demand, hourly_weather
from zonehour.operators.forecast import (
    evaluate,
    MODEL_OUTPUT_COLUMNS,
    PREDICTION_COLUMNS,
    baseline_forecast,
    fit_linear,
    linear_forecast,
    split_counts,
    time_split,
)
from zonehour.operators.metrics import METRIC_COLUMNS, compare_models, forecast_metrics
from zonehour.sources.readers import require_columns

DEMAND_SCHEMA = "pickup_date date, pickup_hour int, PULocationID int, trip_count bigint, avg_trip_distance double, avg_fare_amount double"
HOURLY_W_SCHEMA = (
    "observation_date_local date, observation_hour_local int, avg_temp_c double, avg_wind_speed_mps double, "
    "avg_precipitation_1hr_mm double, is_rain_hour int, station_count bigint"
)
WEATHER_SCHEMA = "station_id string, observation_date_local date, observation_hour_local int, air_temp_c double, wind_speed_mps double, precipitation_1hr_mm double, is_rain_1hr int"


def test_j1_missing_weather_is_zero(spark):
    demand = spark.createDataFrame([(date(2024, 1, 7), 8, 1, 3, 2.0, 10.0)], DEMAND_SCHEMA)
    weather = spark.createDataFrame([], HOURLY_W_SCHEMA)
    (r,) = build_features(demand, weather).collect()
    assert (r.avg_temp_c, r.avg_wind_speed_mps, r.avg_precipitation_1hr_mm, r.is_rain_hour, r.station_count) == (0.0, 0.0, 0.0, 0, 0)
    assert r.day_of_week == 1 and r.is_weekend == 1


def test_j2_j3_hourly_weather(spark):
    d = date(2024, 1, 8)
    weather = spark.createDataFrame(
        [("a", d, 8, 4.0, 1.0, 0.0, 0), ("b", d, 8, 6.0, 3.0, 0.5, 1), ("c", d, 9, None, 2.0, 0.0, 0), ("d", d, 9, 7.0, 2.0, 0.0, 0)],
        WEATHER_SCHEMA,
    )
    rows = {r.observation_hour_local: r for r in hourly_weather(weather).collect()}
    assert rows[8].avg_temp_c == 5.0 and rows[8].is_rain_hour == 1 and rows[8].station_count == 2
    assert rows[9].avg_temp_c == 7.0 and rows[9].station_count == 2


def test_j4_weekend_and_columns(spark):
    demand = spark.createDataFrame(
        [(date(2024, 1, 7), 8, 1, 1, 1.0, 1.0), (date(2024, 1, 6), 8, 1, 1, 1.0, 1.0), (date(2024, 1, 8), 8, 1, 1, 1.0, 1.0)],
        DEMAND_SCHEMA,
    )
    weather = spark.createDataFrame([(date(2024, 1, 8), 8, 1.0, 1.0, 0.0, 0, 1)], HOURLY_W_SCHEMA)
    df = build_features(demand, weather, ForecastSpec(), WeatherSpec())
    assert tuple(df.columns) == FEATURE_COLUMNS
    wk = {r.pickup_date: r.is_weekend for r in df.collect()}
    assert wk == {date(2024, 1, 7): 1, date(2024, 1, 6): 1, date(2024, 1, 8): 0}


def test_weather_side_is_broadcast_when_window_bounded(spark):
    demand = spark.createDataFrame([(date(2024, 1, 7), 8, 1, 3, 2.0, 10.0)], DEMAND_SCHEMA)
    weather = spark.createDataFrame([], HOURLY_W_SCHEMA)
    plan = build_features(demand, weather, ForecastSpec(), WeatherSpec())._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_left_join_does_not_multiply(spark):
    from zonehour.plans import catalog as C

    sf = "/root/testdata/sf0.001"
    demand = hourly_demand(C.trips_clean_df(spark, sf))
    feats = C.features_df(spark, sf)
    assert feats.count() == demand.count()
    assert demand.agg(F.sum("trip_count")).first()[0] == C.trips_clean_df(spark, sf).count()
    filled = ["avg_temp_c", "avg_wind_speed_mps", "avg_precipitation_1hr_mm", "is_rain_hour", "station_count"]
    assert feats.where(" OR ".join(f"{c} IS NULL" for c in filled)).count() == 0
    train, test = time_split(feats, C.QUERY_TRAIN_END)
    assert train.count() + test.count() == feats.count()


def _features(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in zip(FEATURE_COLUMNS, [
        "date", "int", "int", "bigint", "double", "double", "double", "double", "double", "int", "bigint", "int", "int"])))


def _row(d, hour, zone, count, temp=0.0):
    return (d, hour, zone, count, 1.0, 10.0, temp, 0.0, 0.0, 0, 1, 2, 0)


def test_split_inclusive(spark):
    feats = _features(spark, [_row(date(2024, 1, 24), 8, 1, 2), _row(date(2024, 1, 25), 8, 1, 4)])
    train, test = time_split(feats, "2024-01-24")
    assert [r.pickup_date for r in train.collect()] == [date(2024, 1, 24)]
    assert [r.pickup_date for r in test.collect()] == [date(2024, 1, 25)]
    (c,) = split_counts(feats, "2024-01-24").collect()
    assert (c.train_rows, c.test_rows) == (1, 1)


def test_empty_test_split_errors(spark):
    for day, side in ((date(2024, 1, 20), "test"), (date(2024, 1, 26), "training")):
        feats = _features(spark, [_row(day, 8, 1, 2)])
        with pytest.raises(ValueError, match=f"the {side} side is empty.*2024-01-24"):
            evaluate(feats, ForecastSpec(train_end="2024-01-24"))


def test_b1_b2_baseline(spark):
    d0, d1 = date(2024, 1, 10), date(2024, 1, 26)
    feats = _features(
        spark,
        [_row(d0, 8, 1, 2), _row(d0, 8, 1, 4), _row(d0, 9, 2, 9), _row(d1, 8, 1, 5), _row(d1, 8, 7, 1)],
    )
    train, test = time_split(feats, "2024-01-24")
    out = baseline_forecast(train, test)
    assert tuple(out.columns) == PREDICTION_COLUMNS
    preds = {r.PULocationID: r.prediction for r in out.collect()}
    assert preds[1] == 3.0
    assert preds[7] == 5.0


def test_m1_metrics(spark):
    preds = spark.createDataFrame([(2, 3.0), (4, 2.0), (0, 1.0), (5, None)], "label bigint, prediction double")
    (m,) = forecast_metrics(preds).collect()
    assert m.mae == pytest.approx(4 / 3)
    assert m.rmse == pytest.approx(np.sqrt(2))
    assert m.mape == pytest.approx(0.5)
    assert m.test_rows == 3


def test_m2_all_zero_labels_nan(spark):
    preds = spark.createDataFrame([(0, 1.0), (0, 2.0)], "label bigint, prediction double")
    (m,) = forecast_metrics(preds).collect()
    assert np.isnan(m.mape)


def test_m3_no_usable_rows_errors(spark):
    preds = spark.createDataFrame([(1, None)], "label bigint, prediction double")
    for column in ("mae", "rmse", "mape", "test_rows"):
        with pytest.raises(PySparkException, match="at least one row with both prediction and label"):
            forecast_metrics(preds).select(column).collect()


def test_compare_models_columns(spark):
    a = spark.createDataFrame([(2, 3.0)], "label bigint, prediction double")
    b = spark.createDataFrame([(2, 2.0)], "label bigint, prediction double")
    m = compare_models({"x": a, "y": b}, "2024-01-24")
    assert tuple(m.columns) == METRIC_COLUMNS
    rows = {r.model_name: r for r in m.collect()}
    assert rows["x"].mae == 1.0 and rows["y"].mae == 0.0 and rows["y"].train_end_date == "2024-01-24"


def test_c1_required_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="the taxi table lacks these columns: b, c"):
        require_columns(df, ["a", "b", "c"], "taxi")


# ---- linear model -----------------------------------------------------------


def _signal_features(spark, n_days=20):
    rng = np.random.default_rng(7)
    rows = []
    for day in range(1, n_days + 1):
        for hour in range(0, 24, 3):
            for zone in (1, 2, 3):
                temp = float(rng.normal(5, 3))
                count = int(max(1, 10 * zone + 0.5 * hour - 0.8 * temp + rng.normal(0, 1)))
                d = date(2024, 1, day)
                dow = (d.isoweekday() % 7) + 1
                rows.append((d, hour, zone, count, 1.0 + zone, 10.0 + hour, temp, 1.0, 0.0, 0, 1, dow, int(dow in (1, 7))))
    return _features(spark, rows)


def test_l1_unseen_zone_scores(spark):
    feats = _signal_features(spark, 10)
    train = feats
    test = _features(spark, [(date(2024, 1, 26), 8, 99, 5, 1.0, 10.0, 0.0, 0.0, 0.0, 0, 1, 6, 0)])
    scored = linear_forecast(train, test)
    assert tuple(scored.columns) == MODEL_OUTPUT_COLUMNS
    (r,) = scored.collect()
    assert r.prediction is not None and np.isfinite(r.prediction)


def test_ols_when_unpenalised(spark):
    """regParam = 0 on a full-rank design equals the least-squares fit."""
    feats = _signal_features(spark, 12)
    spec = ForecastSpec(features=("pickup_hour", "avg_temp_c", "avg_trip_distance"), reg_param=0.0, elastic_net=0.0, max_iter=200)
    model = fit_linear(feats, spec)
    lr = model.stages[-1]
    pdf = feats.select("pickup_hour", "avg_temp_c", "avg_trip_distance", "trip_count").toPandas()
    X = np.column_stack([np.ones(len(pdf)), pdf[["pickup_hour", "avg_temp_c", "avg_trip_distance"]].to_numpy(float)])
    beta, *_ = np.linalg.lstsq(X, pdf["trip_count"].to_numpy(float), rcond=None)
    assert lr.intercept == pytest.approx(beta[0], rel=1e-4, abs=1e-4)
    assert np.allclose(lr.coefficients.toArray(), beta[1:], rtol=1e-4, atol=1e-4)


def test_elastic_net_optimality(spark):
    """KKT conditions of Spark's standardised elastic-net objective."""
    feats = _signal_features(spark, 12)
    spec = ForecastSpec(features=("pickup_hour", "avg_temp_c", "avg_trip_distance"), max_iter=500)
    lr = fit_linear(feats, spec).stages[-1]
    pdf = feats.select("pickup_hour", "avg_temp_c", "avg_trip_distance", "trip_count").toPandas()
    X = pdf[["pickup_hour", "avg_temp_c", "avg_trip_distance"]].to_numpy(float)
    y = pdf["trip_count"].to_numpy(float)
    sx, sy = X.std(axis=0, ddof=1), y.std(ddof=1)
    Xs = (X - X.mean(axis=0)) / sx
    ys = (y - y.mean()) / sy
    w = lr.coefficients.toArray() * sx / sy
    lam, alpha = spec.reg_param / sy, spec.elastic_net
    g = Xs.T @ (Xs @ w - ys) / len(y) + lam * (1 - alpha) * w
    for gj, wj in zip(g, w):
        if abs(wj) > 1e-12:
            assert abs(gj + lam * alpha * np.sign(wj)) < 1e-3
        else:
            assert abs(gj) <= lam * alpha + 1e-3


def test_two_fits_agree(spark):
    feats = _signal_features(spark, 8)
    a = fit_linear(feats).stages[-1]
    b = fit_linear(feats).stages[-1]
    assert np.allclose(a.coefficients.toArray(), b.coefficients.toArray(), atol=1e-6)
    assert a.intercept == pytest.approx(b.intercept, abs=1e-6)


def test_linear_model_kkt_on_query_input(spark):
    """Brute-force check of the registered model query's fit: the KKT
    conditions of the elastic-net objective hold on the real sf0.01 training
    split (one-hot zones included)."""
    from zonehour.plans import catalog as C

    feats = C.features_df(spark, "/root/testdata/sf0.01")
    train, _ = time_split(feats, C.QUERY_TRAIN_END)
    spec = C.QUERY_CONFIG.forecast
    model = fit_linear(train, spec)
    lr = model.stages[-1]
    pdf = model.transform(train).select("features", "trip_count").toPandas()
    X = np.stack([v.toArray() for v in pdf["features"]])
    y = pdf["trip_count"].to_numpy(float)
    coef = lr.coefficients.toArray()
    sx = X.std(axis=0, ddof=1)
    const = sx == 0
    assert np.all(coef[const] == 0)
    Xs = (X[:, ~const] - X[:, ~const].mean(axis=0)) / sx[~const]
    sy = y.std(ddof=1)
    ys = (y - y.mean()) / sy
    w = coef[~const] * sx[~const] / sy
    lam, alpha = spec.reg_param / sy, spec.elastic_net
    g = Xs.T @ (Xs @ w - ys) / len(y) + lam * (1 - alpha) * w
    for gj, wj in zip(g, w):
        if abs(wj) > 1e-10:
            assert abs(gj + lam * alpha * np.sign(wj)) < 1e-3
        else:
            assert abs(gj) <= lam * alpha + 1e-3
    # the intercept makes the mean residual zero
    pred = X @ coef + lr.intercept
    assert abs((y - pred).mean()) < 1e-6


def test_open_weather_window_sets_no_broadcast_hint(spark):
    from dataclasses import replace

    demand = spark.createDataFrame([(date(2024, 1, 7), 8, 1, 3, 2.0, 10.0)], DEMAND_SCHEMA)
    weather = spark.createDataFrame([], HOURLY_W_SCHEMA)
    bounded = build_features(demand, weather, ForecastSpec(), WeatherSpec())
    open_window = build_features(demand, weather, ForecastSpec(), replace(WeatherSpec(), window=None))
    assert "broadcast" in bounded._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in open_window._jdf.queryExecution().analyzed().toString().lower()


def test_metrics_csv_keeps_nan(spark, tmp_out):
    from zonehour.plans.pipeline import METRICS_CSV_SCHEMA
    from zonehour.sources.sinks import write_metrics

    preds = spark.createDataFrame([(0, 1.0), (0, 2.0)], "label bigint, prediction double")
    write_metrics(compare_models({"m": preds}, "2024-01-24"), tmp_out + "/metrics")
    (r,) = spark.read.option("header", True).schema(METRICS_CSV_SCHEMA).csv(tmp_out + "/metrics").collect()
    assert r.model_name == "m" and r.mae == 1.5 and np.isnan(r.mape) and r.test_rows == 2
