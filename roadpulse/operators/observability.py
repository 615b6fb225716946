"""Freshness, volume anomalies, sensor health and their summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.functions.columns import as_time, before, latest, minutes_between

TIME = "reading_timestamp"


def _moment(df: DataFrame, as_of, ts_col: str) -> Column:
    return as_time(latest(df, ts_col) if as_of is None else as_of)


def freshness(df: DataFrame, as_of=None, days: int = 7, ts_col: str = TIME) -> DataFrame:
    """Age and status of every sensor seen in the last days.

    Between 6 and 22 o'clock an age over 120 minutes is stale, and that rule comes
    first; over 360 minutes is critical at other hours.
    """
    moment = _moment(df, as_of, ts_col)
    age = F.col("minutes_since_last_reading")
    return (
        df.filter(F.col(ts_col) >= before(moment, days, "days"))
        .groupBy("sensor_id")
        .agg(F.max(ts_col).alias("last_reading"))
        .withColumn("minutes_since_last_reading", minutes_between("last_reading", moment))
        .withColumn(
            "freshness_status",
            F.when((age > 120) & F.hour(moment).between(6, 22), "stale").when(age > 360, "critical").otherwise("fresh"),
        )
    )


def freshness_summary(sensors: DataFrame) -> DataFrame:
    status = F.col("freshness_status")
    counted = sensors.agg(
        F.count(F.lit(1)).alias("total_sensors"),
        *[F.count_if(status == name).alias(f"{name}_sensors") for name in ("fresh", "stale", "critical")],
    )
    score = F.try_divide(F.col("fresh_sensors") * F.lit(100.0), F.col("total_sensors"))
    return counted.withColumn("freshness_score", F.coalesce(score, F.lit(0.0)))


def feed_freshness(df: DataFrame, as_of, ts_col: str = "weather_timestamp", limit_min: int = 30) -> DataFrame:
    """Age of one feed."""
    return (
        df.agg(F.max(ts_col).alias("last_update"))
        .withColumn("minutes_since_last_update", minutes_between("last_update", as_time(as_of)))
        .withColumn(
            "freshness_status", F.when(F.col("minutes_since_last_update") > limit_min, "stale").otherwise("fresh")
        )
    )


def fresh_rows(df: DataFrame, as_of=None, hours: int = 1, ts_col: str = TIME) -> DataFrame:
    moment = _moment(df, as_of, ts_col)
    counted = df.filter(F.col(ts_col) >= before(moment, hours, "hours")).agg(F.count(F.lit(1)).alias("fresh_records"))
    return counted.withColumn("passed", F.col("fresh_records") > 0)


def volume_anomalies(df: DataFrame, as_of=None, mode: str = "literal", ts_col: str = TIME) -> DataFrame:
    """Daily volume of each sensor against its six preceding days with data.

    `mode='literal'` compares the number of readings of a day with the mean
    *volume* of the days before, as the specification has it; `mode='count'`
    compares it with their mean number of readings. The windows see one row per
    sensor and day, at most 15 per sensor.
    """
    moment = _moment(df, as_of, ts_col)
    daily = (
        df.filter(F.col(ts_col) >= before(moment, 14, "days"))
        .groupBy("sensor_id", F.to_date(ts_col).alias("traffic_date"))
        .agg(
            F.count(F.lit(1)).alias("daily_readings"),
            F.avg("traffic_volume").alias("avg_volume"),
            F.max("traffic_volume").alias("max_volume"),
            F.min("traffic_volume").alias("min_volume"),
        )
    )
    earlier = Window.partitionBy("sensor_id").orderBy("traffic_date").rowsBetween(-6, -1)
    columns = {
        "rolling_7day_avg": F.avg("avg_volume").over(earlier),
        "rolling_7day_std": F.stddev_samp("avg_volume").over(earlier),
    }
    if mode == "count":
        columns["__base"] = F.avg("daily_readings").over(earlier)
    rolled = daily.withColumns(columns)
    base = F.col("__base") if mode == "count" else F.col("rolling_7day_avg")
    n, mean, spread = F.col("daily_readings"), F.col("rolling_7day_avg"), F.col("rolling_7day_std")
    judged = rolled.withColumns(
        {
            "anomaly_type": F.when(base.isNull(), "insufficient_data")
            .when(n < base * 0.8, "volume_drop")
            .when(n > base * 1.5, "volume_spike")
            .otherwise("normal"),
            "volume_pct_change": F.when(base > 0, (n - base) / base * 100).otherwise(0.0),
            "z_score": F.when(spread > 0, F.abs(F.col("avg_volume") - mean) / spread).otherwise(0.0),
        }
    )
    recent = judged.filter(F.col("traffic_date").cast("timestamp_ntz") >= before(moment, 7, "days"))
    return recent.withColumn("severity", _severity()).drop("__base")


def _is_anomaly() -> Column:
    return F.col("anomaly_type").isin("volume_drop", "volume_spike")


def _severity() -> Column:
    return F.when(_is_anomaly(), F.when(F.abs("z_score") > 3, "high").otherwise("medium"))


def anomaly_summary(anomalies: DataFrame) -> DataFrame:
    counted = anomalies.agg(F.count(F.lit(1)).alias("total_records"), F.count_if(_is_anomaly()).alias("anomaly_count"))
    rate = F.try_divide(F.col("anomaly_count") * F.lit(100.0), F.col("total_records"))
    return counted.withColumns(
        {"normal_records": F.col("total_records") - F.col("anomaly_count"), "anomaly_rate": F.coalesce(rate, F.lit(0.0))}
    )


def sensor_health(df: DataFrame, as_of=None, min_n: int = 24, days: int = 7, ts_col: str = TIME) -> DataFrame:
    moment = _moment(df, as_of, ts_col)
    volume, n = F.col("traffic_volume"), F.col("total_readings")
    variation = F.try_divide(F.col("std_volume"), F.col("avg_volume"))
    return (
        df.filter(F.col(ts_col) >= before(moment, days, "days"))
        .groupBy("sensor_id")
        .agg(
            F.count(F.lit(1)).alias("total_readings"),
            F.count_if(volume == 0).alias("zero_volume_count"),
            F.count_if(volume > 8000).alias("extreme_volume_count"),
            F.avg(volume).alias("avg_volume"),
            F.stddev_samp(volume).alias("std_volume"),
            F.min(ts_col).alias("first_reading"),
            F.max(ts_col).alias("last_reading"),
        )
        .filter(n >= min_n)
        .withColumn(
            "health_status",
            F.when(F.col("zero_volume_count") > n * 0.5, "malfunctioning")
            .when(F.col("extreme_volume_count") > n * 0.1, "suspicious")
            .when(variation > 2, "unstable")
            .otherwise("healthy"),
        )
    )


def health_summary(health: DataFrame) -> DataFrame:
    status = F.col("health_status")
    return health.agg(
        F.count(F.lit(1)).alias("total_sensors"),
        *[
            F.count_if(status == name).alias(f"{name}_sensors")
            for name in ("healthy", "malfunctioning", "suspicious", "unstable")
        ],
    )


def summarise_checks(freshness_row: DataFrame, anomaly_row: DataFrame, drift_row: DataFrame) -> DataFrame:
    """One row per check with its issue count, from the one-row summaries of the checks."""
    counts = [
        (freshness_row, "freshness_monitoring", "critical_sensors", "Critical sensors"),
        (anomaly_row, "anomaly_detection", "anomaly_count", "Volume anomalies"),
        (drift_row, "schema_drift_check", "total_changes", "Schema changes"),
    ]
    frames = [
        frame.select(
            F.lit(check).alias("check"),
            F.col(column).cast("long").alias("issues"),
            F.when(F.col(column) > 0, F.concat(F.lit(f"{label}: "), F.col(column).cast("string"))).alias("message"),
        )
        for frame, check, column, label in counts
    ]
    return reduce(DataFrame.unionByName, frames)
