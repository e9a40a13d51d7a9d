"""C6 models: time split, historical baseline, elastic-net linear regression
(F6, A3, A4, J2, J3, M1-M7)."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonehour.config import MSG_NO_TEST_ROWS, MSG_NO_TRAIN_ROWS, ForecastSpec
from zonehour.operators.linear import fit_normal, predict_normal
from zonehour.operators.metrics import compare_models

# --- fixed values: column order of the prediction tables ---
PREDICTION_COLUMNS = ("pickup_date", "pickup_hour", "PULocationID", "label", "prediction")
MODEL_OUTPUT_COLUMNS = PREDICTION_COLUMNS + (
    "avg_temp_c",
    "avg_wind_speed_mps",
    "avg_precipitation_1hr_mm",
    "is_rain_hour",
)


def _end_date(train_end: str):
    return F.lit(train_end).cast("date")


def time_split(features: DataFrame, train_end: str, date_col: str = "pickup_date") -> tuple[DataFrame, DataFrame]:
    """train = date <= train_end, test = date > train_end."""
    end = _end_date(train_end)
    return features.where(F.col(date_col) <= end), features.where(F.col(date_col) > end)


def split_counts(features: DataFrame, train_end: str, date_col: str = "pickup_date") -> DataFrame:
    """Rows on each side of the split, in one pass over ``features``."""
    is_train = F.col(date_col) <= _end_date(train_end)
    is_test = F.col(date_col) > _end_date(train_end)
    return features.agg(
        F.count(F.when(is_train, F.lit(1))).alias("train_rows"),
        F.count(F.when(is_test, F.lit(1))).alias("test_rows"),
    )


def require_both_sides(features: DataFrame, train_end: str) -> None:
    """Error naming the split date if either side has no rows (one aggregate
    over the feature table)."""
    counts = split_counts(features, train_end).first()
    if counts.train_rows == 0:
        raise ValueError(MSG_NO_TRAIN_ROWS.format(date=train_end))
    if counts.test_rows == 0:
        raise ValueError(MSG_NO_TEST_ROWS.format(date=train_end))


def global_mean(train: DataFrame, target: str = "trip_count") -> DataFrame:
    """A3: mean of the target over all training zone-hours (one row)."""
    return train.agg(F.avg(target).alias("mean_trip_count"))


def zone_hour_mean(train: DataFrame, target: str = "trip_count") -> DataFrame:
    """A4: mean target per (zone, hour); at most zones x 24 rows."""
    return train.groupBy("PULocationID", "pickup_hour").agg(F.avg(target).alias("baseline_prediction"))


def baseline_forecast(train: DataFrame, test: DataFrame, target: str = "trip_count") -> DataFrame:
    """M7 (A3 + A4 + J2 + J3): predict the training mean of the same zone and
    hour; a pair unseen in training gets the training mean over all zone-hours.

    The fallback is a scalar subquery: Spark runs the one-row aggregate once
    and folds the value into the projection, with no cross join and no
    value carried through user code on the driver.
    """
    fallback = global_mean(train, target).scalar()
    lookup = zone_hour_mean(train, target)
    return (
        test.join(lookup, ["PULocationID", "pickup_hour"], "left")
        .select(
            "pickup_date",
            "pickup_hour",
            "PULocationID",
            F.col(target).alias("label"),
            F.coalesce(F.col("baseline_prediction"), fallback).alias("prediction"),
        )
    )


def linear_pipeline(spec: ForecastSpec = ForecastSpec(), target: str = "trip_count") -> Pipeline:
    """M1-M4 as Spark ML stages, for callers that want a ``PipelineModel``:
    zone index (unseen zones kept) -> sparse one-hot -> assembled vector ->
    elastic-net linear regression. It keeps every zone's label on the driver
    and, up to 4,096 features, a d x d / 2 matrix (d = zones + 5); the jobs use
    ``linear.fit_normal``, which does not."""
    indexer = StringIndexer(inputCol="PULocationID", outputCol="PULocationID_indexed", handleInvalid="keep")
    encoder = OneHotEncoder(inputCol="PULocationID_indexed", outputCol="PULocationID_ohe", handleInvalid="keep")
    assembler = VectorAssembler(inputCols=list(spec.features), outputCol="features")
    regression = LinearRegression(
        labelCol=target,
        featuresCol="features",
        predictionCol="prediction",
        maxIter=spec.max_iter,
        regParam=spec.reg_param,
        elasticNetParam=spec.elastic_net,
    )
    return Pipeline(stages=[indexer, encoder, assembler, regression])


def fit_linear(train: DataFrame, spec: ForecastSpec = ForecastSpec(), target: str = "trip_count") -> PipelineModel:
    """M5 by Spark ML: fit on the training split (runs Spark jobs)."""
    return linear_pipeline(spec, target).fit(train)


def prediction_columns(scored: DataFrame, target: str = "trip_count") -> DataFrame:
    """The columns of the model's prediction table."""
    return scored.withColumn("label", F.col(target)).select(*MODEL_OUTPUT_COLUMNS)


def score_linear(model: PipelineModel, test: DataFrame, target: str = "trip_count") -> DataFrame:
    """M6 by a fitted pipeline; the vectors are not part of the output."""
    return prediction_columns(model.transform(test), target)


def linear_forecast(
    train: DataFrame, test: DataFrame, spec: ForecastSpec = ForecastSpec(), target: str = "trip_count"
) -> DataFrame:
    """M5 + M6: the exact elastic net (``linear.fit_normal``), scored by a join
    with the zones' coefficients. The fit runs here."""
    return prediction_columns(predict_normal(fit_normal(train, spec, target), test), target)


def evaluate(features: DataFrame, spec: ForecastSpec = ForecastSpec(), target: str = "trip_count"):
    """C6 in memory: split at ``spec.train_end``, then both models and their
    metrics. Returns (baseline predictions, model predictions, metrics table).
    The row check and the model fit run here; everything else stays lazy."""
    require_both_sides(features, spec.train_end)
    train, test = time_split(features, spec.train_end)
    baseline = baseline_forecast(train, test, target)
    model = linear_forecast(train, test, spec, target)
    metrics = compare_models({spec.baseline_name: baseline, spec.linear_name: model}, spec.train_end)
    return baseline, model, metrics
