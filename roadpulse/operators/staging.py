"""Cleaned, typed views of the raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.columns import dow0_sun, positive_part
from roadpulse.functions.ordered import with_windows

OPEN_END = "9999-12-31 00:00:00"


def audited(df: DataFrame) -> DataFrame:
    """Opt-in load time; left out by default so that results can be reproduced."""
    return df.withColumn("etl_loaded_at", F.current_timestamp())


def _named(raw: DataFrame, ts_col: str) -> DataFrame:
    """Raw tables and feeds call their time `timestamp`; here it is named and free of a zone."""
    if ts_col in raw.columns or "timestamp" not in raw.columns:
        return raw
    return raw.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).withColumnRenamed("timestamp", ts_col)


def stg_readings(
    raw: DataFrame,
    volume_min: int = 0,
    volume_max: int = 10000,
    rush_start: int = 7,
    rush_end: int = 19,
    ts_col: str = "reading_timestamp",
) -> DataFrame:
    """Valid readings with calendar columns (day_of_week: 0 = Sunday)."""
    raw, ts = _named(raw, ts_col), F.col(ts_col)
    hour, dow = F.hour(ts), dow0_sun(ts)
    weekend = dow.isin(0, 6)
    return raw.filter(
        F.col("traffic_volume").between(volume_min, volume_max) & ts.isNotNull() & F.col("sensor_id").isNotNull()
    ).withColumns(
        {
            "hour_of_day": hour,
            "day_of_week": dow,
            "is_weekend": weekend,
            "is_rush_hour": hour.between(rush_start, rush_end) & ~weekend,
            "month": F.month(ts),
            "year": F.year(ts),
        }
    )


def weather_severity(rain: Column, snow: Column, wind: Column, visibility: Column) -> Column:
    """0 (calm) to 10; the sum is rounded to one decimal before the cap."""
    raw = rain * 2 + snow * 5 + positive_part(wind - 20) * 0.3 + positive_part(5 - visibility) * 1.5
    scored = raw.cast("decimal(4,1)").cast("double")
    return F.when(scored.isNotNull(), F.least(F.lit(10.0), scored))


def stg_weather(raw: DataFrame) -> DataFrame:
    raw = _named(raw, "weather_timestamp")
    rain, snow = F.coalesce("rain_1h_mm", F.lit(0.0)), F.coalesce("snow_1h_mm", F.lit(0.0))
    temp, visibility = F.col("temp_fahrenheit"), F.col("visibility_miles")
    return raw.filter(temp.between(-50, 130) & F.col("weather_timestamp").isNotNull()).withColumns(
        {
            "rain_1h_mm": rain,
            "snow_1h_mm": snow,
            "is_precipitation": (rain > 0) | (snow > 0),
            "temp_bucket": F.when(temp < 32, "freezing")
            .when(temp < 50, "cold")
            .when(temp < 70, "mild")
            .when(temp < 85, "warm")
            .otherwise("hot"),
            "visibility_category": F.when(visibility < 2, "poor").when(visibility < 5, "moderate").otherwise("good"),
            "weather_severity": weather_severity(rain, snow, F.col("wind_speed_mph"), visibility),
        }
    )


def stg_holidays(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("date").alias("holiday_date"), F.col("name").alias("holiday_name"), F.lit(True).alias("is_holiday"))


def scd2(history: DataFrame, key: str = "sensor_id", order: tuple[str, ...] = ("updated_at", "seq")) -> DataFrame:
    """Validity interval of every version; `order` starts with the change time and ends with a unique column."""
    changed = order[0]

    def versions(window):
        following = F.lead(changed).over(window)
        return {
            "valid_from": F.col(changed),
            "valid_to": F.coalesce(following, F.lit(OPEN_END).cast("timestamp_ntz")),
            "is_current": following.isNull(),
        }

    return with_windows(history, [key], [F.col(c) for c in order], versions, after=1)
