"""Profiling aggregates (FIXTURES 2.4)."""

import pytest

from dataclasses import replace

from zonehour.config import TripSpec

from zonehour.operators.profile import (
    distinct_values,
    keyed_count,
    mode_top,
    null_counts,
    numeric_range,
    numeric_stats,
    profile_trips,
    profile_weather,
    stage_counts,
    value_counts,
)


def test_p1_numeric_stats(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "x double")
    (r,) = numeric_stats(df, ["x"]).collect()
    assert r.column_name == "x"
    assert r.non_null_count == 4 and r.mean_value == 2.5 and r.median_value == 2.0
    assert r.stddev_value == pytest.approx(1.290994, abs=1e-6)
    assert (r.min_value, r.max_value) == (1.0, 4.0)


def test_numeric_stats_many_columns_one_row_each(spark):
    df = spark.createDataFrame([(1.0, 10), (3.0, 30)], "a double, b int")
    rows = {r.column_name: r for r in numeric_stats(df, ["a", "b"]).collect()}
    assert rows["a"].mean_value == 2.0 and rows["b"].max_value == 30.0


def test_p2_mode_order(spark):
    df = spark.createDataFrame([(3.0,), (1.0,), (3.0,), (1.0,), (2.0,)], "x double")
    got = [(r.x, r["count"]) for r in value_counts(df, "x").collect()]
    assert got == [(1.0, 2), (3.0, 2), (2.0, 1)]
    ranked = [(r.value, r["count"], r["rank"]) for r in mode_top(df, ["x"]).orderBy("rank").collect()]
    assert ranked == [(1.0, 2, 1), (3.0, 2, 2), (2.0, 1, 3)]


def test_mode_top_limits_per_column(spark):
    df = spark.createDataFrame([(float(i % 15), float(i % 3)) for i in range(60)], "a double, b double")
    rows = mode_top(df, ["a", "b"], 10).collect()
    per = {}
    for r in rows:
        per.setdefault(r.column_name, []).append(r)
    assert len(per["a"]) == 10 and len(per["b"]) == 3


def test_p3_distinct_without_sentinel(spark):
    df = spark.createDataFrame([(4,), (-9999,), (2,), (None,), (4,)], "x int")
    assert [r.x for r in distinct_values(df, "x", exclude=[-9999]).collect()] == [2, 4]
    assert [r.x for r in distinct_values(df, "x", n=1).collect()] == [-9999]


def test_p4_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (None, 3), (4, 4), (5, 5)], "a int, b int")
    (r,) = null_counts(df, ["a", "b"]).collect()
    assert (r.null_a, r.null_b) == (2, 1)


def test_numeric_range_and_counts(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    (r,) = numeric_range(df, ["x"]).collect()
    assert (r.min_x, r.max_x, r.avg_x) == (1.0, 3.0, 2.0)
    assert keyed_count(df).collect()[0].asDict() == {"metric": "record_count", "value": 2}
    sc = {r.stage: r.rows for r in stage_counts([(df, {"all": None, "big": df["x"] > 2})]).collect()}
    assert sc == {"all": 2, "big": 1}


def test_profile_jobs_return_dicts(spark):
    from zonehour.plans import catalog as C

    sf = "/root/testdata/sf0.001"
    raw = C.raw_trips(spark, sf)
    trips = profile_trips(raw)
    assert set(trips) == {"schema", "overview", "distinct_values", "sample"}
    sample = trips["sample"].collect()
    assert len(sample) == 20 and len(sample[0]) == 9
    (o,) = trips["overview"].collect()
    assert o.record_count == raw.count() and o.null_pickup_ts == 0
    assert o.min_trip_distance == raw.agg({"trip_distance": "min"}).first()[0]
    lists = trips["distinct_values"].collect()
    rate = [r.value for r in lists if r.column_name == "RatecodeID"]
    assert rate == [str(v) for v in sorted(r.RatecodeID for r in raw.select("RatecodeID").distinct().collect() if r.RatecodeID is not None)]
    weather = profile_weather(C.weather_lines(spark, sf))
    assert {"line_count", "distinct_values", "numeric_stats", "mode_top10", "sample"} <= set(weather)
    assert weather["sample"].count() == 20
    stations = weather["distinct_values"].where("column_name = 'station_id'").count()
    assert stations == 2
    assert weather["distinct_values"].where("column_name = 'sky_cover_code' AND value = '-9999'").count() == 0


def test_numeric_stats_exact_median(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    vals = [float(v) for v in rng.normal(10, 4, 20001).round(1)] + [1e9]  # an outlier stretches the buckets
    df = spark.createDataFrame([(v, None) for v in vals], "x double, empty double").repartition(16)
    got = {r.column_name: r for r in numeric_stats(df, ["x", "empty"]).collect()}
    srt = np.sort(vals)
    assert got["x"].median_value == srt[(len(srt) + 1) // 2 - 1]
    assert got["x"].stddev_value == pytest.approx(np.std(vals, ddof=1))
    assert got["empty"].non_null_count == 0 and got["empty"].median_value is None


def test_profile_lists_are_whole(spark):
    from zonehour.operators.profile import TRIP_PROFILE_FIELDS

    spec = replace(TripSpec(), vendor="vendor_no")
    cols = [getattr(spec, f) for f in TRIP_PROFILE_FIELDS]
    raw = spark.range(1000).selectExpr(*[f"cast(id as double) as {c}" for c in cols])
    assert profile_trips(raw, spec)["distinct_values"].where("column_name = 'VendorID'").count() == 1000
    with pytest.raises(ValueError, match="vendor_no"):
        profile_trips(raw.drop("vendor_no"), spec)


def test_distinct_lists_orders_by_type(spark):
    from zonehour.operators.profile import distinct_lists

    df = spark.createDataFrame([(10, "b"), (2, "a"), (None, "10"), (2, "2"), (-9999, None)], "n int, s string")
    got = distinct_lists(df, ["n", "s"], exclude={"n": [-9999]}).collect()
    assert [r.value for r in got if r.column_name == "n"] == ["2", "10"]
    assert [r.value for r in got if r.column_name == "s"] == ["10", "2", "a", "b"]
    top = distinct_lists(df, ["n", "s"], n=1).collect()
    assert sorted((r.column_name, r.value, r.position) for r in top) == [("n", "-9999", 1), ("s", "10", 1)]
