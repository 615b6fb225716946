"""Windowed metrics; every function runs on a batch or on a watermarked stream."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.columns import congestion_level, trend_indicator

SENSOR = "sensor_id"
# Columns taken from the earliest reading of a window.
FIRST_COLUMNS = ("road_name", "direction", "latitude", "longitude")


def _first(columns: tuple[str, ...], ts_col: str, tiebreak: str | None, condition=None) -> list:
    order = F.struct(ts_col, tiebreak) if tiebreak else F.col(ts_col)
    if condition is not None:
        order = F.when(condition, order)
    return [F.min_by(c, order).alias(c) for c in columns]


def _opened(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c not in (SENSOR, "window")]
    return df.select(SENSOR, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def tumbling(df: DataFrame, length: str = "5 minutes", ts_col: str = "timestamp", tiebreak: str | None = None) -> DataFrame:
    """Volume and speed per sensor and window."""
    return _opened(
        df.groupBy(SENSOR, F.window(ts_col, length)).agg(
            F.avg("traffic_volume").alias("avg_volume"),
            F.max("traffic_volume").alias("max_volume"),
            F.count(F.lit(1)).alias("reading_count"),
            F.avg("speed_mph").alias("avg_speed"),
            *_first(FIRST_COLUMNS, ts_col, tiebreak),
        )
    )


def sliding(
    df: DataFrame, length: str = "15 minutes", slide: str = "5 minutes", ts_col: str = "timestamp", tiebreak: str | None = None
) -> DataFrame:
    return _opened(
        df.groupBy(SENSOR, F.window(ts_col, length, slide)).agg(
            F.avg("traffic_volume").alias("avg_volume"),
            F.avg("speed_mph").alias("avg_speed"),
            F.count(F.lit(1)).alias("reading_count"),
            *_first(FIRST_COLUMNS[:2], ts_col, tiebreak),
        )
    )


def trend(df: DataFrame, step_minutes: int = 5, ts_col: str = "timestamp", tiebreak: str | None = None) -> DataFrame:
    """Each window with the change from the same sensor's window one step earlier.

    One stateful pass: a window of two steps sees both halves. The later half is
    the current window, the earlier half the previous one; rows without either
    half are dropped. The state is one row per sensor and open window.
    """
    length, step = f"{2 * step_minutes} minutes", f"{step_minutes} minutes"
    middle = F.col("window.start") + F.expr(f"interval {step}")
    now = F.col(ts_col) >= middle
    measured = df.groupBy(SENSOR, F.window(ts_col, length, step)).agg(
        F.avg(F.when(now, F.col("traffic_volume"))).alias("avg_volume"),
        F.avg(F.when(~now, F.col("traffic_volume"))).alias("previous_avg_volume"),
        F.max(F.when(now, F.col("traffic_volume"))).alias("max_volume"),
        F.count(F.when(now, 1)).alias("reading_count"),
        F.avg(F.when(now, F.col("speed_mph"))).alias("avg_speed"),
        *_first(FIRST_COLUMNS, ts_col, tiebreak, now),
    )
    return (
        _opened(measured)
        .filter("avg_volume is not null and previous_avg_volume is not null")
        .withColumn("window_start", F.col("window_end") - F.expr(f"interval {step}"))
        .withColumn("volume_trend", F.col("avg_volume") - F.col("previous_avg_volume"))
        .withColumn("trend_indicator", trend_indicator("volume_trend"))
    )


def metrics(df: DataFrame, step_minutes: int = 5, ts_col: str = "timestamp", tiebreak: str | None = None) -> DataFrame:
    """Trend plus congestion level and calendar flags of the window."""
    hour = F.hour("window_start")
    return trend(df, step_minutes, ts_col, tiebreak).withColumns(
        {
            "congestion_level": congestion_level("avg_volume"),
            "is_peak_hour": hour.between(7, 9) | hour.between(17, 19),
            "is_weekend": F.dayofweek("window_start").isin(1, 7),
        }
    )


def anomalies(measured: DataFrame, change: float = 0.5, slow_mph: float = 15.0) -> DataFrame:
    """Windows with a sudden change, slow traffic or congestion, in this order of precedence."""
    previous, now = F.col("previous_avg_volume"), F.col("avg_volume")
    kind = (
        F.when(now > previous * (1 + change), "volume_spike")
        .when(now < previous * (1 - change), "volume_drop")
        .when(F.col("avg_speed") < slow_mph, "speed_issue")
        .when(F.col("congestion_level").isin("severe_congestion", "heavy_traffic"), "congestion")
    )
    return measured.withColumn("anomaly_type", kind).filter("anomaly_type is not null")


def sessions(df: DataFrame, gap: str = "30 minutes", ts_col: str = "timestamp", tiebreak: str | None = None) -> DataFrame:
    """Runs of readings of a sensor with less than `gap` between neighbours, each from its first reading to `gap` after its last.

    On a stream the sessions that overlap are merged, also with those kept from earlier
    batches, and a session is given out once the watermark has passed its end. Inside
    `merged_locally` a task merges what it has before the shuffle.
    """
    measured = df.groupBy(SENSOR, F.session_window(ts_col, gap).alias("window")).agg(
        F.count(F.lit(1)).alias("reading_count"),
        F.avg("traffic_volume").alias("avg_volume"),
        F.max("traffic_volume").alias("max_volume"),
        F.avg("speed_mph").alias("avg_speed"),
        *_first(FIRST_COLUMNS[:2], ts_col, tiebreak),
    )
    return _opened(measured).withColumnsRenamed({"window_start": "session_start", "window_end": "session_end"})


@contextmanager
def merged_locally(spark: SparkSession) -> Iterator[None]:
    """Streams started inside merge the sessions of a task before the shuffle: a busy sensor sends sessions, not rows."""
    key = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def deduplicated(stream: DataFrame, columns: tuple[str, ...] = (SENSOR, "timestamp")) -> DataFrame:
    """First of each repeated message, as long as it repeats within the watermark."""
    return stream.dropDuplicatesWithinWatermark(list(columns))
