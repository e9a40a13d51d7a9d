"""The elastic net from its normal equations, the zone index and the sparse
assembly, against Spark ML, the optimality conditions and plain Python."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonehour.config import ForecastSpec
from zonehour.operators.forecast import fit_linear, linear_forecast, time_split
from zonehour.operators.linear import ZONE_FEATURE, assemble_features, fit_normal, predict_normal, zone_index
from zonehour.plans import catalog as C

SPEC = ForecastSpec(features=(ZONE_FEATURE, "a", "b", "flat"), reg_param=0.3, elastic_net=0.4)
SCHEMA = "PULocationID int, a double, b double, flat double, trip_count bigint"


def made(spark, zones, rows, seed=1):
    rng = np.random.default_rng(seed)
    zone = np.minimum(rng.integers(0, zones, rows), rng.integers(0, zones, rows))
    zone[: rows // 3] = 1  # one zone holds a third of the rows
    zone[rows // 3 : rows // 3 + zones] = np.arange(zones)
    a, b = rng.normal(3, 2, rows), rng.normal(-100, 0.1, rows)
    y = np.round(20 + 3 * a + 40 * (b + 100) + (zone % 7) + rng.normal(0, 1, rows)).astype(int)
    return spark.createDataFrame([(int(z), float(p), float(q), 4.0, int(t)) for z, p, q, t in zip(zone, a, b, y)], SCHEMA)


def optimum_gap(rows, fit, spec):
    """Largest violation of the optimality conditions, in standardised units."""
    x = {c: np.array([r[c] for r in rows], float) for c in ("a", "b")}
    zone, y = np.array([-1 if r.PULocationID is None else r.PULocationID for r in rows]), np.array([r.trip_count for r in rows], float)
    theta = {-1 if r.PULocationID is None else r.PULocationID: r.zone_coefficient for r in fit.zones.collect()}
    rest = y - fit.intercept - sum(fit.coefficients[c] * x[c] for c in x) - np.array([theta[z] for z in zone])
    sy, n = y.std(ddof=1), len(y)
    penalty = spec.reg_param / sy
    worst = abs(rest.mean() / sy)
    columns = [(x[c], fit.coefficients[c]) for c in x] + [((zone == z).astype(float), theta[z]) for z in theta]
    for column, raw in columns:
        s = column.std(ddof=1)
        w = raw * s / sy
        slope = (column - column.mean()) @ rest / (n * s * sy) - penalty * (1 - spec.elastic_net) * w
        worst = max(worst, abs(slope - penalty * spec.elastic_net * np.sign(w)) if w else max(0, abs(slope) - penalty * spec.elastic_net))
    return worst


@pytest.mark.parametrize("reg,mix", [(0.3, 0.4), (2.0, 1.0), (0.5, 0.0)])
def test_fit_is_the_optimum_on_the_driver_and_in_spark(spark, reg, mix):
    spec = replace(SPEC, reg_param=reg, elastic_net=mix)
    train = made(spark, 40, 1500).cache()
    here, there = fit_normal(train, spec), fit_normal(train, spec, driver_zones=0)
    assert here.coefficients["flat"] == 0
    assert here.intercept == pytest.approx(there.intercept, abs=1e-8) and here.coefficients == pytest.approx(there.coefficients, abs=1e-8)
    assert dict(map(tuple, here.zones.collect())) == pytest.approx(dict(map(tuple, there.zones.collect())), abs=1e-8)
    assert optimum_gap(train.collect(), here, spec) < 1e-9


def test_fit_equals_spark_ml_on_the_training_split(spark):
    train, test = time_split(C.features_df(spark, "/root/testdata/sf0.01").cache(), C.QUERY_CONFIG.forecast.train_end)
    spec = C.QUERY_CONFIG.forecast
    exact, model = linear_forecast(train, test, spec), fit_linear(train, spec).transform(test)
    keys = ["pickup_date", "pickup_hour", "PULocationID"]
    apart = exact.join(model.select(*keys, F.col("prediction").alias("ml")), keys).agg(F.count("*"), F.max(F.abs(F.col("prediction") - F.col("ml")))).first()
    assert apart[0] == 722 and apart[1] < 1e-4


def test_fit_past_4096_zones(spark):
    train = made(spark, 9000, 30_000).cache()
    fit = fit_normal(train, SPEC)  # more zones than the driver takes
    assert fit.zones.count() == 9000
    assert optimum_gap(train.collect(), fit, SPEC) < 1e-9


def test_unseen_null_and_only_zones(spark):
    train = made(spark, 5, 300)
    fit = fit_normal(train, SPEC)
    test = spark.createDataFrame([(None, 1.0, 2.0, 4.0, 1), (77, 1.0, 2.0, 4.0, 1), (1, None, 2.0, 4.0, 1)], SCHEMA)
    by = {r.PULocationID: r.prediction for r in predict_normal(fit, test).collect()}
    plain = fit.intercept + fit.coefficients["a"] + 2 * fit.coefficients["b"]
    assert by[77] == by[None] == pytest.approx(plain) and by[1] is None and fit.unseen == 0
    some = train.withColumn("PULocationID", F.when(F.col("PULocationID") != 2, F.col("PULocationID")))
    for zones in (0, 100):
        fit = fit_normal(some, SPEC, driver_zones=zones)
        by = {r.PULocationID: r.prediction for r in predict_normal(fit, test).collect()}
        assert fit.unseen and by[77] == by[None] == pytest.approx(fit.intercept + fit.coefficients["a"] + 2 * fit.coefficients["b"] + fit.unseen)
        assert optimum_gap(some.collect(), fit, SPEC) < 1e-9
    one = fit_normal(train.withColumn("PULocationID", F.lit(3)), SPEC)
    assert [r.zone_coefficient for r in one.zones.collect()] == [0.0]


def test_bad_training_sides(spark):
    train = made(spark, 5, 60)
    with pytest.raises(ValueError, match="training side is empty"):
        fit_normal(train.where("false"), SPEC)
    with pytest.raises(ValueError, match="nulls or NaN in b"):
        fit_normal(train.withColumn("b", F.when(F.col("a") > 3, F.col("b"))), SPEC)
    constant = fit_normal(train.withColumn("trip_count", F.lit(7)), SPEC)
    assert constant.intercept == 7 and set(constant.coefficients.values()) == {0.0} and constant.zones is None


def test_zone_index_of_a_million_zones(spark):
    rows = spark.range(1_000_000).select(F.col("id").cast("int").alias("PULocationID")).unionByName(spark.createDataFrame([(5,), (5,), (999_999,), (None,)], "PULocationID int"))
    index = zone_index(rows)
    got = index.agg(F.count("*"), F.count_distinct("zone_index"), F.min("zone_index"), F.max("zone_index")).first()
    assert tuple(got) == (1_000_000, 1_000_000, 0, 999_999)
    first = [r.PULocationID for r in index.where("zone_index < 6").orderBy("zone_index").collect()]
    assert first == [5, 999_999, 0, 1, 10, 100]  # by rows, then as text
    wrong = index.where("zone_index >= 2").orderBy("zone_index").select(F.col("PULocationID").cast("string").alias("z")).limit(2000).collect()
    assert [r.z for r in wrong] == sorted(r.z for r in wrong)


def test_sparse_assembly(spark):
    train = made(spark, 3, 30)
    index = zone_index(train)
    test = spark.createDataFrame([(1, 1.5, 2.5, 4.0, 1), (77, 1.0, 2.0, 4.0, 1), (None, 1.0, 2.0, 4.0, 1)], SCHEMA)
    spec = replace(SPEC, features=("a", ZONE_FEATURE, "b"))
    by = {r.PULocationID: r for r in assemble_features(test, index, spec).collect()}
    assert by[1].features.asDict() == {"size": 6, "indices": [0, 1, 5], "values": [1.5, 1.0, 2.5]}
    assert by[77].features.indices == by[None].features.indices == [0, 4, 5]
