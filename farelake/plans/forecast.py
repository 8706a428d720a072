"""The forecast job: store the training frame, validate on the last days, refit, forecast, log."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.operators import runs, series
from farelake.operators.models import MODELS
from farelake.schemas import FORECAST_VALIDATION, FUTURE_FORECAST, TRAINING, conform
from farelake.sources.tables import csv_sink, csv_source


def run_forecast(
    spark: SparkSession,
    daily: DataFrame,
    root: str,
    model_type: str = "additive",
    target_metric: str = "total_trips",
    horizon: int = 30,
    training_years: int = 2,
    as_of: dt.date | None = None,
    started: dt.datetime | None = None,
) -> str:
    """Train and score one model, write its artifacts under `root` and return the run id.

    The forecast comes from a refit on the whole history: a model fitted without the validation days
    would be dated `horizon` days too late. A run that fails leaves a record with the status FAILED.
    """
    if model_type not in MODELS:
        raise ValueError(f"unknown model {model_type!r}: expected one of {sorted(MODELS)}")
    run_id = uuid.uuid4().hex
    started = started or dt.datetime.now()
    try:
        return _run(spark, daily, root, model_type, target_metric, horizon, training_years, as_of, started, run_id)
    except Exception:
        params = {"model_type": model_type, "target_metric": target_metric, "forecast_horizon_days": horizon}
        name = runs.run_name(model_type, target_metric, as_of or started.date())
        runs.log_run(spark, f"{root}/ml_runs", run_id, name, "FAILED", started, params, {})
        raise


def _run(
    spark: SparkSession,
    daily: DataFrame,
    root: str,
    model_type: str,
    target_metric: str,
    horizon: int,
    training_years: int,
    as_of: dt.date | None,
    started: dt.datetime,
    run_id: str,
) -> str:
    training_path = f"{root}/training/run_id={run_id}"
    csv_sink(conform(series.training_frame(daily, target_metric, training_years, as_of), TRAINING), training_path)
    training = csv_source(spark, training_path, TRAINING)

    tagged = series.holdout_split(training.select("ds", "y"), horizon)
    train, held_out = tagged.filter("NOT is_validation"), tagged.filter("is_validation")
    sizes = tagged.agg(
        F.count_if(~F.col("is_validation")).alias("training_samples"),
        F.count_if("is_validation").alias("validation_samples"),
        F.min(F.when(~F.col("is_validation"), F.col("ds"))).alias("first"),
        F.max(F.when(~F.col("is_validation"), F.col("ds"))).alias("last"),
    ).first()
    if not sizes["training_samples"]:
        raise ValueError("no training days before the validation days")

    fit = MODELS[model_type]
    validation = series.validation_frame(held_out.drop("is_validation"), fit(train, horizon, held_out))
    validation_path = f"{root}/validation/run_id={run_id}"
    csv_sink(conform(validation, FORECAST_VALIDATION).coalesce(1), validation_path)
    stored = csv_source(spark, validation_path, FORECAST_VALIDATION)
    scores = series.forecast_metrics(stored).first()

    ahead = fit(training.select("ds", "y"), horizon)
    if "note" in ahead.columns and (note := ahead.agg(F.max("note")).first()[0]):
        raise ValueError(f"{model_type}: {note}")
    future = series.future_frame(ahead)
    csv_sink(conform(future, FUTURE_FORECAST).coalesce(1), f"{root}/future/run_id={run_id}")

    runs.log_run(
        spark,
        f"{root}/ml_runs",
        run_id,
        runs.run_name(model_type, target_metric, sizes["last"]),
        "FINISHED",
        started,
        {
            "model_type": model_type,
            "target_metric": target_metric,
            "forecast_horizon_days": horizon,
            "training_samples": sizes["training_samples"],
            "validation_samples": sizes["validation_samples"],
            "date_range_start": sizes["first"],
            "date_range_end": sizes["last"],
        },
        {name: scores[name] for name in ("mae", "rmse", "mape") if scores[name] is not None},
    )
    return run_id


def forecast_page(
    spark: SparkSession, root: str, daily_view: DataFrame, target_metric: str = "total_trips", days: int = 90
) -> DataFrame:
    """Best run's validation and forecast beside recent history, read from the job's artifacts."""
    keyed = "run_id STRING"
    validation = spark.read.option("header", True).schema(f"ds DATE, y_true DOUBLE, y_pred DOUBLE, {keyed}")
    future = spark.read.option("header", True).schema(f"date DATE, forecast DOUBLE, {keyed}")
    return runs.forecast_with_history(
        spark.read.parquet(f"{root}/ml_runs"),
        validation.csv(f"{root}/validation"),
        future.csv(f"{root}/future"),
        daily_view,
        target_metric,
        days,
    )
