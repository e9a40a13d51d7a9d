"""Forecast metrics and the model comparison table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonehour.config import MSG_NO_USABLE_ROWS

# --- fixed values: column order of the metrics table ---
METRIC_COLUMNS = ("model_name", "mae", "rmse", "mape", "test_rows", "train_end_date")


def forecast_metrics(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """A5 + F7: one row of MAE, RMSE, MAPE and usable row count.

    Only rows where both columns are non-null count. MAPE is a fraction over
    rows with label > 0 (the guard sits inside ``when``, so no division by
    zero is evaluated) and NaN when no such row exists. Zero usable rows
    raises when any of the columns is computed, inside the same single
    aggregate job.
    """
    p, y = F.col(prediction), F.col(label)
    usable = predictions.where(p.isNotNull() & y.isNotNull())
    err = p - y
    agg = usable.agg(
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(F.pow(err, F.lit(2)))).alias("rmse"),
        F.avg(F.when(y > F.lit(0.0), F.abs(err / y))).alias("mape"),
        F.count(F.lit(1)).alias("test_rows"),
    )
    message = MSG_NO_USABLE_ROWS.format(prediction=prediction, label=label)
    some = F.col("test_rows") > 0

    def guarded(value: Column, kind: str) -> Column:
        return F.when(some, value).otherwise(F.raise_error(F.lit(message)).cast(kind))

    return agg.select(
        guarded(F.col("mae"), "double").alias("mae"),
        guarded(F.col("rmse"), "double").alias("rmse"),
        guarded(F.coalesce(F.col("mape"), F.lit(float("nan"))), "double").alias("mape"),
        guarded(F.col("test_rows"), "bigint").alias("test_rows"),
    )


def model_metrics(predictions: DataFrame, model_name: str, train_end: str) -> DataFrame:
    """K4: one metrics row with its model name and split date."""
    m = forecast_metrics(predictions)
    return m.select(
        F.lit(model_name).alias("model_name"),
        "mae",
        "rmse",
        "mape",
        "test_rows",
        F.lit(train_end).alias("train_end_date"),
    )


def compare_models(predictions: Mapping[str, DataFrame], train_end: str) -> DataFrame:
    """M8: models side by side, one row each, stays a DataFrame."""
    rows = [model_metrics(df, name, train_end) for name, df in predictions.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
