"""Every catalogue query against its DuckDB twin (the driver's correctness
gate), the default model's recorded values and the entry contract."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import canon, duck, type_diff  # noqa: E402

from zonehour.operators.forecast import evaluate  # noqa: E402
from zonehour.plans import catalog as C  # noqa: E402
from zonehour.plans.catalog import QUERIES  # noqa: E402
from zonehour.plans.oracle import ORACLE_SQL  # noqa: E402

SF = "/root/testdata/sf0.01"
SQL = ORACLE_SQL


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    assert type_diff(sdf, con, SQL[name]) == {}
    spdf = sdf.toPandas()
    dpdf = con.execute(SQL[name]).df()
    sc, sr = canon(spdf)
    dc, dr = canon(dpdf)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def test_default_model_metrics(spark):
    """The regression values recorded for sf0.01, unrounded."""
    _, predictions, metrics = evaluate(C.features_df(spark, SF).cache(), C.QUERY_CONFIG.forecast)
    by = {r.model_name: r for r in metrics.collect()}
    assert set(by) == {"baseline_zone_hour_mean", "weather_aware_linear_regression"}
    assert all(r.test_rows == 722 for r in by.values())
    assert by["weather_aware_linear_regression"].mae == pytest.approx(0.157236, abs=1e-5)
    assert by["weather_aware_linear_regression"].rmse == pytest.approx(0.282014, abs=1e-5)
    assert predictions.where("prediction IS NOT NULL").count() == 722


def test_regression_values(spark):
    """Counts and metrics recorded for sf0.01."""
    (m,) = QUERIES["baseline_metrics"](spark, SF).collect()
    assert m.mae == pytest.approx(0.152151, abs=1e-6)
    assert m.rmse == pytest.approx(0.337529, abs=1e-6)
    assert m.mape == pytest.approx(0.113634, abs=1e-6)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["model_name", "mae", "rmse", "mape", "test_rows", "train_end_date"]
    assert df.count() == 2


@pytest.mark.parametrize("name", ["trips_clean", "weather_clean", "features", "baseline_metrics"])
def test_results_do_not_depend_on_session_settings(spark, con, name):
    """Same rows with ANSI off and another session time zone."""
    keys = {"spark.sql.ansi.enabled": "false", "spark.sql.session.timeZone": "Asia/Tokyo"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        got = canon(QUERIES[name](spark, SF).toPandas())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == canon(con.execute(SQL[name]).df())
