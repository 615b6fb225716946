"""Aggregated tables over the enriched hourly readings."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.operators.tables import compact

VOLUME = "traffic_volume"


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def _avg_if(condition: Column, column: str = VOLUME) -> Column:
    return F.avg(F.when(condition, F.col(column)))


def mart_daily_summary(hourly: DataFrame, ts_col: str = "reading_timestamp") -> DataFrame:
    return hourly.groupBy("sensor_id", F.to_date(ts_col).alias("traffic_date"), "is_holiday", "holiday_name").agg(
        F.count(F.lit(1)).alias("total_readings"),
        F.avg(VOLUME).alias("avg_volume"),
        F.max(VOLUME).alias("peak_volume"),
        F.min(VOLUME).alias("min_volume"),
        _avg_if(F.col("is_rush_hour")).alias("avg_rush_hour_volume"),
        _avg_if(~F.col("is_rush_hour")).alias("avg_off_peak_volume"),
        F.avg("weather_severity").alias("avg_weather_severity"),
        _count_if(F.col("traffic_level") == "congested").alias("congested_hours"),
    )


def mart_congestion(hourly: DataFrame, min_n: int = 30) -> DataFrame:
    """Volume distribution per sensor, hour, weekday and weather.

    `percentile` keeps a count per distinct volume, and staged volumes are whole
    numbers of at most 10,000, so the state of a group is bounded.
    """
    keys = ["sensor_id", "hour_of_day", "day_of_week", "is_weekend", "weather_main", "temp_bucket"]
    return (
        hourly.groupBy(*keys)
        .agg(
            F.avg(VOLUME).alias("avg_volume"),
            F.stddev_samp(VOLUME).alias("std_volume"),
            F.percentile(VOLUME, F.array(F.lit(0.9), F.lit(0.95))).alias("tail"),
            F.count(F.lit(1)).alias("sample_size"),
            _avg_if(F.col("is_precipitation")).alias("avg_volume_precipitation"),
            _avg_if(~F.col("is_precipitation")).alias("avg_volume_clear"),
        )
        .filter(F.col("sample_size") >= min_n)
        .withColumns({"p90_volume": F.col("tail")[0], "p95_volume": F.col("tail")[1]})
        .drop("tail")
    )


def mart_sensor_performance(hourly: DataFrame, ts_col: str = "reading_timestamp") -> DataFrame:
    return hourly.groupBy("sensor_id", F.to_date(ts_col).alias("traffic_date")).agg(
        F.count(F.lit(1)).alias("total_readings"),
        F.avg(VOLUME).alias("avg_volume"),
        F.max(VOLUME).alias("max_volume"),
        F.avg("speed_mph").alias("avg_speed"),
        F.max("speed_mph").alias("max_speed"),
        F.min("speed_mph").alias("min_speed"),
        F.avg("occupancy_pct").alias("avg_occupancy"),
        F.max("occupancy_pct").alias("max_occupancy"),
        _count_if(F.col("traffic_level") == "congested").alias("congestion_events"),
        _count_if(F.col("is_rush_hour")).alias("rush_hour_events"),
        _count_if(F.col("is_precipitation")).alias("precipitation_events"),
        _count_if(F.col(VOLUME) > 0).alias("valid_readings"),
        _count_if(F.col(VOLUME) == 0).alias("zero_volume_events"),
        F.avg("weather_severity").alias("avg_weather_severity"),
        F.max("weather_severity").alias("max_weather_severity"),
        _avg_if(F.col("is_weekend")).alias("avg_weekend_volume"),
        _avg_if(~F.col("is_weekend")).alias("avg_weekday_volume"),
    )


def refresh(built: DataFrame, table: DataFrame, changed: DataFrame, keys: dict[str, Column], build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The mart after rows of its source came in or changed.

    `keys` names columns of the mart that the source row decides; `changed` is any set of
    source rows that covers the new ones. Only the groups they fall into are built again,
    from all their rows in `table`, and take the place of what the mart has for them.
    """
    affected = changed.select(*[value.alias(f"__{name}") for name, value in keys.items()]).distinct()

    def touched(values: dict[str, Column]) -> Column:
        return reduce(lambda a, b: a & b, [value.eqNullSafe(F.col(f"__{name}")) for name, value in values.items()])

    part = build(table.join(affected, touched(keys), "left_semi"))
    rest = built.join(affected, touched({name: F.col(name) for name in keys}), "left_anti")
    return rest.unionByName(part)


def daily_keys(ts_col: str = "reading_timestamp") -> dict[str, Column]:
    """What `refresh` needs for the two marts that are kept by sensor and day."""
    return {"sensor_id": F.col("sensor_id"), "traffic_date": F.to_date(ts_col)}


def write_marts(hourly: DataFrame, folder: str, n_files: int, min_n: int = 30) -> None:
    """Write the hourly table once, clustered by sensor and time, and the three marts from it.

    The marts read the written table, so the joins and windows before it run once.
    """
    compact(hourly, ["sensor_id", "reading_timestamp"], n_files).write.mode("overwrite").parquet(f"{folder}/mart_hourly")
    table = hourly.sparkSession.read.parquet(f"{folder}/mart_hourly")
    marts = {
        "mart_daily_summary": mart_daily_summary(table),
        "mart_congestion": mart_congestion(table, min_n),
        "mart_sensor_performance": mart_sensor_performance(table),
    }
    for name, mart in marts.items():
        mart.write.mode("overwrite").parquet(f"{folder}/{name}")
