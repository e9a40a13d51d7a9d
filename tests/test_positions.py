"""Positions from counted ranges, the image of a double and the median by
radix selection."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from zonehour.operators.positions import dense_positions
from zonehour.operators.profile import count_ranges, distinct_lists, numeric_stats, stored_histogram, value_image


def test_positions_over_many_ranges(spark):
    df = spark.range(10_000, numPartitions=7).select((F.col("id") * 7919 % 10_007).alias("x"), F.lit("kept").alias("position"))
    got = dense_positions(df, [F.col("x").desc()]).orderBy("position").collect()
    assert [r.position for r in got] == list(range(10_000))
    assert [r.x for r in got] == sorted((r.x for r in got), reverse=True)


def test_positions_within_groups_and_nulls(spark):
    rows = [(g, v) for g in ("a", None, "b") for v in (3, None, 1, 2)]
    df = spark.createDataFrame(rows, "g string, v int")
    got = dense_positions(df, [F.col("g"), F.col("v").asc_nulls_last()], within=["g"], name="at").collect()
    assert {(r.g, r.v): r.at for r in got} == {(g, v): at for g in ("a", None, "b") for at, v in enumerate((1, 2, 3, None))}
    assert dense_positions(df.where("false"), [F.col("g")]).count() == 0


def test_positions_of_whole_lists_need_no_window_over_the_values(spark):
    df = spark.range(0, 300_000, numPartitions=6).select(F.col("id").alias("n"), F.concat(F.lit("v"), (F.col("id") % 11).cast("string")).alias("t"))
    lists = distinct_lists(df, ["n", "t"], positions=True)
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(lists._jdf.queryExecution(), "formatted")
    windows = [line for line in plan.splitlines() if "windowspecdefinition" in line]
    assert windows and all("_span" in line for line in windows)
    got = lists.groupBy("column_name").agg(F.count("*"), F.min("position"), F.max("position"), F.count_distinct("position")).collect()
    assert sorted(map(tuple, got)) == [("n", 300_000, 1, 300_000, 300_000), ("t", 11, 1, 11, 11)]
    assert lists.where("column_name = 'n' AND value <> CAST(position - 1 AS STRING)").isEmpty()
    assert [r.value for r in lists.where("column_name = 't'").orderBy("position").collect()] == sorted(f"v{k}" for k in range(11))


def test_image_is_the_double_bit_for_bit(spark):
    rng = random.Random(1)
    xs = [0.0, -0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, math.inf, -math.inf]
    xs += [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(3000)]
    xs += [math.nextafter(2.0**e, to) for e in range(-1070, 1024, 3) for to in (0, math.inf)] + [2.0**e for e in range(-1074, 1024)]
    xs = [x for x in xs if x == x] + [-x for x in xs if x == x]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", value_image(F.col("x")).alias("image")).collect()
    for r in got:
        bits = struct.unpack("<q", struct.pack("<d", abs(r.x)))[0]
        assert r.image == (-bits if r.x < 0 else bits)
    (nan,) = spark.createDataFrame([(math.nan,)], "x double").select(value_image(F.col("x"))).first()
    assert nan > max(r.image for r in got)


def test_median_beside_a_far_outlier(spark):
    """The ranges that are counted do not depend on the spread of the values:
    none holds more than a hundredth of them after the second level."""
    df = spark.range(100_000, numPartitions=4).select((F.col("id") / 8 - 3000).alias("x")).unionByName(spark.createDataFrame([(1e15,), (-1e300,)], "x double"))
    (r,) = numeric_stats(df, ["x"]).collect()
    assert (r.non_null_count, r.median_value, r.min_value, r.max_value) == (100_002, 49_999 / 8 - 3000, -1e300, 1e15)
    levels = count_ranges(stored_histogram(df, ["x"]), 40)["x"]
    assert max(level.n for level in levels) <= 1000


@pytest.mark.parametrize("values", [[1.0], [2.0, -1.0], [0.1, 0.1, 0.2, 0.3], [-math.inf, 1.0, math.inf], [1.0, math.nan, math.nan], [1 + k * 2.0**-52 for k in range(9)]])
def test_median_is_the_least_with_half_up_to_it(spark, values):
    (r,) = numeric_stats(spark.createDataFrame([(v,) for v in values], "x double"), ["x"]).collect()
    want = sorted(values, key=lambda v: (v != v, v))[(len(values) + 1) // 2 - 1]
    assert r.median_value == want or want != want and r.median_value != r.median_value
