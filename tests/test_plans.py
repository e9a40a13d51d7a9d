"""Physical-plan assertions: pushdown, pruning, join strategy, top-k shape."""

import pytest
from pyspark.sql import functions as F

from zonehour.config import Config
from zonehour.operators.features import hourly_demand
from zonehour.operators.profile import mode_top
from zonehour.operators.trips import clean_trips
from zonehour.plans import catalog as C
from zonehour.sources.readers import read_clean
from zonehour.sources.sinks import write_partitioned

SF = "/root/testdata/sf0.001"


def plan(df):
    """The text ``df.explain("formatted")`` prints (full filter lists)."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def raw_parquet(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "trips")
    C.raw_trips(spark, SF).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_trip_window_and_rules_pushed_to_scan(raw_parquet):
    p = plan(clean_trips(raw_parquet, C.QUERY_CONFIG.trips))
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2024-01-03T00:00)" in p
    assert "LessThan(tpep_pickup_datetime,2024-01-29T00:00)" in p
    assert "GreaterThan(trip_distance,0.0)" in p
    # VendorID is profiling-only and must not be read by the cleaning scan
    assert "VendorID" not in p.split("ReadSchema:")[1].split("\n")[0]
    assert "Exchange" not in p  # cleaning is a narrow stage


def test_narrow_projection_reads_two_columns(raw_parquet):
    p = plan(hourly_demand(clean_trips(raw_parquet)).select("trip_count"))
    schema = p.split("ReadSchema:")[1].split("\n")[0]
    assert "fare_amount" in schema and "payment_type" not in schema and "RatecodeID" not in schema


def test_partition_pruning_on_clean_table(spark, tmp_path):
    path = str(tmp_path / "clean")
    write_partitioned(C.trips_clean_df(spark, SF), path, "pickup_date")
    df = read_clean(spark, path)
    p = plan(df.where(df.pickup_date.cast("date") <= "2024-01-10"))
    assert "PartitionFilters: [isnotnull(pickup_date" in p and "<= 2024-01-10" in p


def test_feature_join_broadcasts_weather(spark):
    p = plan(C.features_df(spark, SF))
    assert "BroadcastHashJoin" in p and "LeftOuter" in p


def test_baseline_has_no_cartesian_product(spark):
    p = plan(C.q_baseline_predictions(spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "Subquery" in p


def test_mode_top_limits_before_shuffle(spark):
    q = mode_top(spark.createDataFrame([(1.0, 2.0)], "a double, b double"), ["a", "b"])
    p = plan(q)
    assert "WindowGroupLimit" in p and "Partial" in p


def test_partitioned_write_spreads_one_date(spark, tmp_path):
    """A hot date is split over several writer tasks (AQE rebalance)."""
    from pathlib import Path

    path = str(tmp_path / "hot")
    df = spark.range(0, 40000, numPartitions=4).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN DATE'2024-01-06' ELSE DATE'2024-01-05' END AS d"
    )
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    try:
        write_partitioned(df, path, "d")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert len(list(Path(path).glob("d=2024-01-05/*.parquet"))) >= 2
    assert spark.read.parquet(path).count() == 40000


def test_default_layout_bounds_the_files_of_unordered_input(spark, tmp_path):
    """Every task holds every date; the default write makes a file per date,
    not one per task and date."""
    rows = spark.range(0, 4000, numPartitions=40).select((F.col("id") % 10).alias("pickup_date"), "id")
    write_partitioned(rows, str(tmp_path / "default"), "pickup_date", Config().scale.trips_layout)
    write_partitioned(rows, str(tmp_path / "local"), "pickup_date", "local")
    assert len(list((tmp_path / "default").glob("*/*.parquet"))) == 10
    assert len(list((tmp_path / "local").glob("*/*.parquet"))) == 400


def test_stage_counts_scan_each_input_once(spark):
    p = plan(C.QUERIES["stage_counts"](spark, SF))
    assert p.count(") Scan text") == 1
    assert p.count(") Scan parquet") == 2  # trip rows, and the zone-hours


def test_local_layout_writes_without_a_shuffle(spark, tmp_path):
    from pathlib import Path

    df = C.trips_clean_df(spark, SF)
    path = str(tmp_path / "local")
    write_partitioned(df, path, "pickup_date", layout="local")
    assert "Exchange" not in plan(df.sortWithinPartitions("pickup_date"))
    assert spark.read.parquet(path).count() == df.count()
    assert len(list(Path(path).glob("pickup_date=*"))) == df.select("pickup_date").distinct().count()


def test_no_query_runs_python_per_row(spark):
    """Every catalogue query stays JVM-side: no Python evaluation node."""
    import re

    for name, fn in C.QUERIES.items():
        p = plan(fn(spark, SF))
        assert not re.search(r"EvalPython|MapInPandas|FlatMapGroupsInPandas|PythonUDF|MapInArrow", p), name
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
