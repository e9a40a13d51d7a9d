"""A key holding a third of all rows: results stay whole and exact, and the
plans split the hot key instead of sending it to one task."""

from datetime import date, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from zonehour.operators.features import FEATURE_COLUMNS, hourly_demand
from zonehour.operators.forecast import baseline_forecast, time_split

TYPES = ["date", "int", "int", "bigint", "double", "double", "double", "double", "double", "int", "bigint", "int", "int"]
SCHEMA = ", ".join(f"{c} {t}" for c, t in zip(FEATURE_COLUMNS, TYPES))


def _skewed_features(spark, n=6000):
    rows = []
    for i in range(n):
        hot = i % 3 == 0  # the join key (zone 1, hour 8) holds a third of all rows
        zone, hour = (1, 8) if hot else (2 + i % 97, i % 24)
        d = date(2024, 1, 1) + timedelta(days=i % 30)
        rows.append((d, hour, zone, 1 + i % 5, 1.0, 10.0, 0.0, 0.0, 0.0, 0, 1, 2, 0))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture()
def skew_conf(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_zone_baseline_join(spark, skew_conf):
    feats = _skewed_features(spark).repartition(8)
    train, test = time_split(feats, "2024-01-24")
    preds = baseline_forecast(train, test)
    got = preds.toPandas()
    plan = spark._jvm.PythonSQLUtils.explainString(preds._jdf.queryExecution(), "formatted")
    assert "SortMergeJoin" in plan  # forced shuffle join; results must stay exact

    pdf = feats.toPandas()
    tr = pdf[pdf.pickup_date <= date(2024, 1, 24)]
    te = pdf[pdf.pickup_date > date(2024, 1, 24)]
    look = tr.groupby(["PULocationID", "pickup_hour"]).trip_count.mean().rename("bp").reset_index()
    want = te.merge(look, on=["PULocationID", "pickup_hour"], how="left")
    want["prediction"] = want.bp.fillna(tr.trip_count.mean())
    assert len(got) == len(te)
    a = got.sort_values(["pickup_date", "pickup_hour", "PULocationID", "label", "prediction"]).reset_index(drop=True)
    b = (
        want.rename(columns={"trip_count": "label"})[["pickup_date", "pickup_hour", "PULocationID", "label", "prediction"]]
        .sort_values(["pickup_date", "pickup_hour", "PULocationID", "label", "prediction"])
        .reset_index(drop=True)
    )
    pd.testing.assert_frame_equal(a, b, check_dtype=False, check_exact=False, rtol=1e-12)


def test_hot_zone_demand_is_partially_aggregated(spark):
    trips = (
        spark.range(0, 30000, numPartitions=6)
        .select(
            F.lit(date(2024, 1, 5)).alias("pickup_date"),
            (F.col("id") % 24).cast("int").alias("pickup_hour"),
            F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 50 + 2).cast("int")).alias("PULocationID"),
            F.lit(2.0).alias("trip_distance"),
            F.lit(10.0).alias("fare_amount"),
        )
    )
    demand = hourly_demand(trips)
    plan = spark._jvm.PythonSQLUtils.explainString(demand._jdf.queryExecution(), "formatted")
    assert "partial_count" in plan
    assert demand.agg(F.sum("trip_count")).first()[0] == 30000
    hot = demand.where("PULocationID = 1").agg(F.sum("trip_count")).first()[0]
    assert hot == 10000


def test_join_key_multiplicity_is_bounded_by_days(spark):
    """Features are unique per (date, hour, zone), so on the test side a
    (zone, hour) join key repeats at most once per test day, however hot the
    zone is in the raw trips: the baseline join cannot be skewed."""
    from zonehour.plans import catalog as C

    feats = C.features_df(spark, "/root/testdata/sf0.01")
    assert feats.groupBy("pickup_date", "pickup_hour", "PULocationID").count().where("count > 1").count() == 0
    _, test = time_split(feats, C.QUERY_TRAIN_END)
    days = test.select("pickup_date").distinct().count()
    worst = test.groupBy("PULocationID", "pickup_hour").count().agg(F.max("count")).first()[0]
    assert worst <= days
