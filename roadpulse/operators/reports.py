"""Report tables: totals, rankings, profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.columns import as_time, before, congestion_level, latest, tie
from roadpulse.functions.ordered import keep_first

TIME = "reading_timestamp"
# Speed classes in mph.
SPEED_CLASSES = [(20, "0-20 mph"), (40, "20-40 mph"), (60, "40-60 mph")]


def regional_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("region").agg(
        F.round(F.sum("hourly_volume"), 1).alias("hourly_volume"),
        F.sum("total_sensors").alias("total_sensors"),
        F.round(F.avg("congestion_percent"), 1).alias("congestion_percent"),
        F.round(F.sum("revenue_impact"), 1).alias("revenue_impact"),
    )


def status_summary(df: DataFrame, measures: list[str]) -> DataFrame:
    return df.groupBy("status").agg(
        F.count(F.lit(1)).alias("number_of_rows"), *[F.round(F.avg(m), 1).alias(f"avg_{m}") for m in measures]
    )


def overall_summary(df: DataFrame, totals: dict[str, str], means: dict[str, str]) -> DataFrame:
    """Long table (metric, value, unit); `totals` and `means` map a column to its unit."""
    wanted = [("total", c, unit, F.sum(c).cast("double")) for c, unit in totals.items()]
    wanted += [("average", c, unit, F.avg(c)) for c, unit in means.items()]
    flat = df.agg(*[value.alias(f"v{i}") for i, (_, _, _, value) in enumerate(wanted)])
    rows = [
        F.struct(F.lit(f"{kind}_{c}").alias("metric"), F.round(f"v{i}", 1).alias("value"), F.lit(unit).alias("unit"))
        for i, (kind, c, unit, _) in enumerate(wanted)
    ]
    return flat.select(F.inline(F.array(*rows)))


def kpi_overview(df: DataFrame, as_of=None, hours: int = 24, ts_col: str = TIME) -> DataFrame:
    """Key figures of the last period and their change from the one before, in one pass."""
    moment = as_time(latest(df, ts_col) if as_of is None else as_of)
    edge, start = before(moment, hours, "hours"), before(moment, 2 * hours, "hours")
    current = F.col(ts_col) > edge
    volume = F.col("traffic_volume")
    congested = F.when(volume.isNotNull(), (congestion_level(volume) != "normal").cast("double"))
    complete = (volume.isNotNull() & F.col("speed_mph").isNotNull()).cast("double")
    periods = {"current": current, "previous": ~current}
    figures = {
        "sensors": lambda c: F.count_distinct(F.when(c, F.col("sensor_id"))).cast("double"),
        "data_points": lambda c: F.count_if(c).cast("double"),
        "rate_per_second": lambda c: F.count_if(c) / F.lit(hours * 3600.0),
        "avg_volume": lambda c: F.avg(F.when(c, volume)),
        "avg_speed": lambda c: F.avg(F.when(c, F.col("speed_mph"))),
        "congestion_pct": lambda c: F.avg(F.when(c, congested)) * 100,
        "quality_pct": lambda c: F.avg(F.when(c, complete)) * 100,
    }
    flat = df.filter((F.col(ts_col) > start) & (F.col(ts_col) <= moment)).agg(
        *[build(c).alias(f"{name}_{period}") for name, build in figures.items() for period, c in periods.items()]
    )
    rows = [
        F.struct(
            F.lit(name).alias("metric"),
            F.col(f"{name}_current").alias("value"),
            (F.col(f"{name}_current") - F.col(f"{name}_previous")).alias("delta"),
        )
        for name in figures
    ]
    return flat.select(F.inline(F.array(*rows)))


def live_flow(df: DataFrame, as_of=None, minutes: int = 60, ts_col: str = TIME) -> DataFrame:
    """Volume per minute over the last hour."""
    moment = as_time(latest(df, ts_col) if as_of is None else as_of)
    return (
        df.filter((F.col(ts_col) > before(moment, minutes, "mins")) & (F.col(ts_col) <= moment))
        .groupBy(F.window(ts_col, "1 minute").alias("w"))
        .agg(F.sum("traffic_volume").alias("volume"), F.count(F.lit(1)).alias("readings"))
        .select(F.col("w.start").alias("minute"), "volume", "readings")
    )


def hourly_profile(df: DataFrame, ts_col: str = TIME) -> DataFrame:
    return df.groupBy(F.hour(ts_col).alias("hour_of_day")).agg(
        F.sum("traffic_volume").alias("total_volume"), F.avg("traffic_volume").alias("avg_volume")
    )


def speed_histogram(df: DataFrame, column: str = "speed_mph") -> DataFrame:
    label = F
    for bound, name in SPEED_CLASSES:
        label = label.when(F.col(column) < bound, name)
    return df.filter(F.col(column).isNotNull()).groupBy(label.otherwise("60+ mph").alias("speed_range")).agg(
        F.count(F.lit(1)).alias("readings")
    )


def weather_impact(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("weather_main").agg(
        F.avg("traffic_volume").alias("avg_volume"),
        F.avg("speed_mph").alias("avg_speed"),
        F.count(F.lit(1)).alias("readings"),
    )


def weather_correlation(hourly: DataFrame) -> DataFrame:
    return hourly.agg(
        F.corr("traffic_volume", "weather_severity").alias("volume_severity"),
        F.corr("traffic_volume", "temp_fahrenheit").alias("volume_temperature"),
        F.corr("speed_mph", "weather_severity").alias("speed_severity"),
    )


def anomaly_type_counts(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy("anomaly_type").agg(F.count(F.lit(1)).alias("anomalies"))


def anomaly_timeline(anomalies: DataFrame, as_of, hours: int = 168, ts_col: str = "window_start") -> DataFrame:
    """Anomalies per hour over the last week."""
    return (
        anomalies.filter(F.col(ts_col) > before(as_of, hours, "hours"))
        .groupBy(F.window(ts_col, "1 hour").alias("w"))
        .agg(F.count(F.lit(1)).alias("anomalies"))
        .select(F.col("w.start").alias("hour"), "anomalies")
    )


def top_k(df: DataFrame, measure: str, tiebreak: str, k: int = 10) -> DataFrame:
    """The `k` largest rows; every task keeps only its own best `k`."""
    return df.orderBy(F.desc(measure), tiebreak).limit(k)


def latest_per_key(df: DataFrame, key: str = "sensor_id", ts_col: str = TIME, tiebreak: str = "event_id") -> DataFrame:
    return keep_first(df, [key], [F.col(ts_col), tie(df, tiebreak)], last=True)


def ordered(df: DataFrame, columns: list[str]) -> DataFrame:
    """Total order, for output only."""
    return df.orderBy(*columns)


