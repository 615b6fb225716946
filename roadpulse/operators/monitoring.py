"""Metric logs: summaries and threshold alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.columns import before

# A missing ratio over the first is an alert, over the second a severe one.
MISSING_ALERT, MISSING_HIGH = 0.1, 0.2
# Fixed value: a metric this many times over its threshold is severe.
HIGH_FACTOR = 1.5


def _recent(log: DataFrame, as_of, hours: int, ts_col: str) -> DataFrame:
    return log.filter(F.col(ts_col) > before(as_of, hours, "hours"))


def pipeline_summary(log: DataFrame, as_of, hours: int = 24, ts_col: str = "timestamp") -> DataFrame:
    return _recent(log, as_of, hours, ts_col).groupBy("metric_name", "model_name").agg(
        F.avg("metric_value").alias("avg_value"), F.count(F.lit(1)).alias("count")
    )


def quality_summary(log: DataFrame, as_of, hours: int = 24, ts_col: str = "timestamp") -> DataFrame:
    return _recent(log, as_of, hours, ts_col).groupBy("data_source").agg(
        F.avg("total_records").alias("avg_records"),
        F.avg("missing_values").alias("avg_missing"),
        F.avg("duplicate_records").alias("avg_duplicates"),
        F.avg("outliers").alias("avg_outliers"),
    )


def accuracy_summary(log: DataFrame, as_of, hours: int = 24, ts_col: str = "timestamp") -> DataFrame:
    return _recent(log, as_of, hours, ts_col).groupBy("model_name", "location_id").agg(
        F.avg("absolute_error").alias("mae"), F.count(F.lit(1)).alias("prediction_count")
    )


def threshold_alerts(metrics: DataFrame, quality: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Alerts of both rules. `thresholds` has metric_name and threshold."""
    value, bound = F.col("avg_value"), F.col("threshold")
    over = (
        metrics.join(thresholds, "metric_name")
        .filter(value > bound)
        .select(
            F.lit("threshold_violation").alias("type"),
            "metric_name",
            F.col("model_name").alias("subject"),
            value.alias("value"),
            bound.cast("double").alias("threshold"),
            F.when(value > bound * HIGH_FACTOR, "high").otherwise("medium").alias("severity"),
        )
    )
    ratio = F.when(F.col("avg_records") > 0, F.col("avg_missing") / F.col("avg_records")).otherwise(0.0)
    gaps = (
        quality.withColumn("value", ratio)
        .filter(F.col("value") > MISSING_ALERT)
        .select(
            F.lit("data_quality").alias("type"),
            F.lit("missing_data_ratio").alias("metric_name"),
            F.col("data_source").alias("subject"),
            "value",
            F.lit(MISSING_ALERT).alias("threshold"),
            F.when(F.col("value") > MISSING_HIGH, "high").otherwise("medium").alias("severity"),
        )
    )
    return over.unionByName(gaps)
