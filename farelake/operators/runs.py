"""The table of forecast runs: parameters, errors and status of each, and queries over it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.functions import fixed, labels
from farelake.schemas import ML_RUNS
from farelake.sources.tables import append_table


def run_name(model_type: str, target_metric: str, trained_until: dt.date) -> str:
    return f"{model_type}_{target_metric}_trained_until_{trained_until:%Y%m%d}"


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    name: str | None,
    status: str,
    start_time: dt.datetime,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
) -> None:
    """Append one run to the run table. Its small files are compacted from time to time."""
    row = (
        run_id,
        name,
        status,
        start_time,
        {key: str(value) for key, value in params.items()},
        {key: float(value) for key, value in metrics.items()},
    )
    append_table(spark.createDataFrame([row], ML_RUNS).coalesce(1), path, ML_RUNS)


def flatten_runs(runs: DataFrame) -> DataFrame:
    """Maps to columns. A nameless run goes by the head of its id; missing parameters get defaults."""

    def param(key: str, default: str):
        return F.coalesce(F.try_element_at("params", F.lit(key)), F.lit(default))

    def metric(key: str):
        return F.try_element_at("metrics", F.lit(key)).alias(key)

    named = F.when(F.col("run_name") != "", F.col("run_name"))
    return runs.select(
        "run_id",
        F.coalesce(named, F.substring("run_id", 1, 8)).alias("run_name"),
        "status",
        "start_time",
        param("model_type", "unknown").alias("model_type"),
        param("target_metric", "unknown").alias("target_metric"),
        param("forecast_horizon_days", "N/A").alias("forecast_horizon"),
        metric("mae"),
        metric("rmse"),
        metric("mape"),
    )


def _newest(runs: DataFrame, limit: int | None) -> DataFrame:
    """The `limit` newest runs in order; all runs, if it is None."""
    ordered = runs.orderBy(F.col("start_time").desc(), "run_id")
    return ordered if limit is None else ordered.limit(limit)


def recent_runs(runs: DataFrame, limit: int | None = 10) -> DataFrame:
    """The newest runs, any status."""
    return flatten_runs(_newest(runs, limit))


def best_run(runs: DataFrame, target_metric: str = "total_trips") -> DataFrame:
    """The run with the lowest MAPE for a metric, the newest of equals; runs without one come last. At most one row."""
    metric = F.try_element_at("params", F.lit("target_metric"))
    return (
        flatten_runs(runs.filter(metric == target_metric))
        .orderBy(F.col("mape").asc_nulls_last(), F.col("start_time").desc(), "run_id")
        .limit(1)
        .select("run_id", "run_name", "model_type", "target_metric", "mae", "rmse", "mape")
    )


def model_comparison(runs: DataFrame, limit: int | None = 100) -> DataFrame:
    """Finished runs, newest first. What is computed from it should pass `limit=None`."""
    finished = runs.filter(F.col("status") == "FINISHED")
    return (
        flatten_runs(_newest(finished, limit))
        .select("model_type", "target_metric", "mae", "rmse", "mape", "run_id", "start_time")
    )


def graded_runs(runs: DataFrame, limit: int | None = 20) -> DataFrame:
    """The run table with a grade on each error."""
    return recent_runs(runs, limit).withColumn("grade", labels.mape_grade(F.col("mape")))


def forecast_with_history(
    runs: DataFrame,
    validation: DataFrame,
    future: DataFrame,
    daily_view: DataFrame,
    target_metric: str = "total_trips",
    history_days: int | None = fixed.HISTORY_DAYS,
) -> DataFrame:
    """Best run's validation and forecast beside recent history, as one tagged frame.

    `validation` and `future` hold the artifacts of all runs, keyed by run_id; only the best run's
    rows survive the semi join. `daily_view` is the plausible-days read query.
    """
    best = F.broadcast(best_run(runs, target_metric).select("run_id"))  # one row
    days = daily_view.orderBy(F.col("pickup_date").desc())
    history = (days if history_days is None else days.limit(history_days)).select(
        F.lit("history").alias("kind"),
        F.col("pickup_date").alias("date"),
        F.col(target_metric).cast("double").alias("value"),
        F.lit(None).cast("double").alias("predicted"),
    )
    validated = validation.join(best, "run_id", "left_semi").select(
        F.lit("validation").alias("kind"),
        F.col("ds").alias("date"),
        F.col("y_true").alias("value"),
        F.col("y_pred").alias("predicted"),
    )
    ahead = future.join(best, "run_id", "left_semi").select(
        F.lit("forecast").alias("kind"),
        "date",
        F.lit(None).cast("double").alias("value"),
        F.col("forecast").alias("predicted"),
    )
    return history.unionByName(validated).unionByName(ahead)
