"""Training, scoring and evaluation of the 24-hour-ahead carbon forecast."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.operators.slices import trailing_slice
from wattloom.plans.features import CATEGORICAL, HORIZON_HOURS, NUMERIC, TARGET

PREDICTION = "prediction"
FORECAST_KEY = ["country_code", "base_hour_utc"]
MODEL_NAME = "carbon_forecast_gbt"


def _numeric(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in NUMERIC})


def train(
    training: DataFrame,
    validation: DataFrame | None = None,
    *,
    max_iter: int = 50,
    max_depth: int = 5,
    step_size: float = 0.1,
    seed: int = 42,
) -> PipelineModel:
    """Gradient-boosted trees over the 18 features; stops early on `validation` when given."""
    rows = _numeric(training).withColumn("_validation", F.lit(False))
    if validation is not None:
        rows = rows.unionByName(_numeric(validation).withColumn("_validation", F.lit(True)))
    filled = [f"{c}_filled" for c in NUMERIC]
    booster = GBTRegressor(
        labelCol=TARGET,
        featuresCol="features",
        predictionCol=PREDICTION,
        maxIter=max_iter,
        maxDepth=max_depth,
        stepSize=step_size,
        subsamplingRate=0.9,
        featureSubsetStrategy="0.9",
        minInstancesPerNode=20,
        seed=seed,
    )
    if validation is not None:
        booster = booster.setValidationIndicatorCol("_validation")
    stages = [
        StringIndexer(
            inputCol=CATEGORICAL, outputCol="_country", handleInvalid="keep", stringOrderType="alphabetAsc"
        ),
        OneHotEncoder(inputCol="_country", outputCol="_country_flags", dropLast=False),
        Imputer(inputCols=NUMERIC, outputCols=filled, strategy="mean"),
        VectorAssembler(inputCols=[*filled, "_country_flags"], outputCol="features"),
        booster,
    ]
    return Pipeline(stages=stages).fit(rows)


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """The features with a `prediction` column; scored where the rows are."""
    scored = model.transform(_numeric(features))
    return scored.select(*features.columns, PREDICTION)


def feature_importance(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Importance per input column, the category's flags added up."""
    booster = model.stages[-1]
    metadata = model.transform(_numeric(features).limit(0)).schema["features"].metadata
    names = {}
    for group in metadata["ml_attr"]["attrs"].values():
        for attr in group:
            name = attr.get("name", str(attr["idx"]))
            names[attr["idx"]] = CATEGORICAL if "_country" in name else name.removesuffix("_filled")
    rows = [(names[i], float(v)) for i, v in enumerate(booster.featureImportances.toArray())]
    return (
        features.sparkSession.createDataFrame(rows, "feature STRING, importance DOUBLE")
        .groupBy("feature")
        .agg(F.sum("importance").alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )


def inference_window(features: DataFrame, days: int = 7, day: str | None = None) -> DataFrame:
    """Feature rows of the last `days` days before the newest hour, both ends included; with `day`,
    the table's date partition column, only those days are read."""
    return trailing_slice(features, "hour_utc", 24 * days, day)


def forecast_rows(
    scored: DataFrame,
    *,
    model_name: str = MODEL_NAME,
    model_version: Column | str = "1",
    generated_at: Column | None = None,
    prediction: str = PREDICTION,
    horizon: int = HORIZON_HOURS,
) -> DataFrame:
    """Scored features as rows of the forecast fact."""
    version = F.lit(model_version) if isinstance(model_version, str) else model_version
    return scored.select(
        "country_code",
        F.col("hour_utc").alias("base_hour_utc"),
        F.timestamp_add("HOUR", F.lit(horizon), F.col("hour_utc")).alias("target_hour_utc"),
        F.lit(horizon).alias("horizon_h"),
        F.col(prediction).alias("predicted_carbon_gco2_kwh"),
        F.col("carbon_current").alias("carbon_current_at_base"),
        version.cast("string").alias("model_version"),
        F.lit(model_name).alias("model_name"),
        (F.current_timestamp() if generated_at is None else generated_at).alias("generated_at"),
    )


def latest_version(runs: DataFrame, model_name: str = MODEL_NAME) -> Column:
    """Highest version of a model in a table of runs (model_name, version), as a scalar."""
    named = runs.filter(F.col("model_name") == model_name)
    return named.agg(F.max(F.col("version").cast("int"))).scalar()


def regression_metrics(
    scored: DataFrame, prediction: str = PREDICTION, target: str = TARGET, by: str = CATEGORICAL
) -> DataFrame:
    """MAE, RMSE, R2, MAPE and relative error per entity and pooled (`by` = 'ALL'), in one pass.

    Rows without a prediction or a target have no error and are left out.
    """
    scored = scored.dropna(subset=[prediction, target])
    y, p = F.col(target), F.col(prediction)
    error = F.abs(y - p)
    rows = F.count(F.lit(1))
    spread = F.var_pop(y) * rows
    return (
        scored.rollup(by)
        .agg(
            rows.alias("row_count"),
            F.avg(error).alias("mae"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
            F.when(spread > 0, 1 - F.sum(error * error) / spread).alias("r2"),
            (F.avg(error / F.greatest(y, F.lit(1.0))) * 100).alias("mape"),
            F.avg(y).alias("avg_target"),
            F.when(F.avg(y) != 0, F.avg(error) / F.avg(y) * 100).alias("relative_error_pct"),
        )
        .withColumn(by, F.coalesce(by, F.lit("ALL")))
    )


def latest_forecast(forecast: DataFrame, country: str | None = None) -> DataFrame:
    """The newest forecast of each country (or of one)."""
    if country is not None:
        forecast = forecast.filter(F.col("country_code") == country.upper())
    newest = Window.partitionBy("country_code").orderBy(F.desc("base_hour_utc"))
    change = F.col("predicted_carbon_gco2_kwh") - F.col("carbon_current_at_base")
    return (
        forecast.withColumn("_rn", F.row_number().over(newest))
        .filter("_rn = 1")
        .select(
            "country_code",
            F.col("base_hour_utc").alias("prediction_made_from"),
            F.col("target_hour_utc").alias("forecast_for"),
            F.round("carbon_current_at_base", 1).alias("current_gco2_per_kwh"),
            F.round("predicted_carbon_gco2_kwh", 1).alias("forecast_gco2_per_kwh_t24h"),
            F.round(change, 1).alias("expected_change_gco2"),
            "model_name",
            "model_version",
        )
    )


def forecast_delta(forecast: DataFrame) -> DataFrame:
    """How far forecasts move from the level they start at, per country."""
    delta = F.col("predicted_carbon_gco2_kwh") - F.col("carbon_current_at_base")
    return forecast.groupBy("country_code").agg(
        F.round(F.avg(delta), 1).alias("avg_delta"),
        F.round(F.avg(F.abs(delta)), 1).alias("avg_abs_delta"),
        F.round(F.max(F.abs(delta)), 1).alias("max_abs_delta"),
    )
