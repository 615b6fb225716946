"""Joins that add weather, holidays and sensor attributes to readings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from roadpulse.functions.columns import epoch_minute, surrogate_key, tie, traffic_level
from roadpulse.functions.ordered import carry, keep_first, with_windows
from roadpulse.functions.sizing import group_load
from roadpulse.operators.windows import pct_change, rolling_rows
from roadpulse.session import cut_lineage

TIME = "reading_timestamp"
TOLERANCE_MIN = 60
# Slots of the minute line; a day keeps them few.
SLOT_MINUTES = 1440
# Columns an observation adds to a reading.
WEATHER_COLUMNS = [
    "temp_fahrenheit",
    "humidity_pct",
    "wind_speed_mph",
    "weather_main",
    "is_precipitation",
    "temp_bucket",
    "visibility_category",
    "weather_severity",
]


def weather_by_minute(wx: DataFrame, columns: list[str], tolerance_min: int = TOLERANCE_MIN) -> DataFrame:
    """Nearest observation for every minute that has one within the tolerance.

    The distance depends on whole minutes alone, so one row per minute says all
    there is to know: its size follows the length of the period, not the number
    of observations. Ties go to the earlier observation, then to the lower id.
    """
    payload = ["weather_timestamp"] + [c for c in columns if c != "weather_timestamp"]
    per_minute = wx.groupBy(epoch_minute("weather_timestamp").alias("minute")).agg(
        F.min_by(F.struct(*payload), F.struct("weather_timestamp", tie(wx))).alias("seen")
    )
    # An observation owns the minutes that are nearer to it than to its neighbours. A
    # neighbour further off than two tolerances changes nothing, so the line of
    # minutes is cut into slots, each with a margin from the slots beside it.
    margin, length = 2 * tolerance_min, max(SLOT_MINUTES, 2 * tolerance_min)
    minute, slot, place = F.col("minute"), F.floor(F.col("minute") / length), F.pmod("minute", F.lit(length))
    copies = F.array_compact(
        F.array(slot, F.when(place < margin, slot - 1), F.when(place >= length - margin, slot + 1))
    )
    window = Window.partitionBy("slot").orderBy("minute")
    cells = (
        per_minute.withColumn("slot", F.explode(copies))
        .withColumns({"previous": F.lag("minute").over(window), "next": F.lead("minute").over(window)})
        .filter(slot == F.col("slot"))
    )
    first = F.greatest(minute - tolerance_min, F.floor((F.col("previous") + minute) / 2) + 1)
    last = F.least(minute + tolerance_min, F.floor((minute + F.col("next")) / 2))
    return cells.select(F.explode(F.sequence(first, last)).alias("weather_minute"), "seen.*")


def nearest_join(
    df: DataFrame,
    wx: DataFrame,
    tolerance_min: int = TOLERANCE_MIN,
    columns: list[str] | None = None,
    ts_col: str = TIME,
) -> DataFrame:
    """Left join of each row to the observation nearest in time; rows without one stay.

    The lookup is written first, which runs a job; its known bytes then decide on a broadcast.
    """
    columns = WEATHER_COLUMNS if columns is None else columns
    lookup = cut_lineage(weather_by_minute(wx, columns, tolerance_min))
    joined = df.join(lookup, epoch_minute(ts_col) == F.col("weather_minute"), "left")
    return joined.select(*df.columns, *columns)


def one_per_instant(df: DataFrame, key: str = "sensor_id", ts_col: str = TIME, tiebreak: str = "event_id") -> DataFrame:
    """First row of each (key, time)."""
    return keep_first(df, [key, ts_col], [tie(df, tiebreak)])


def with_holidays(df: DataFrame, holidays: DataFrame, ts_col: str = TIME) -> DataFrame:
    """Left join on the date; Spark broadcasts the calendar because of its known size."""
    joined = df.join(holidays, F.to_date(ts_col) == F.col("holiday_date"), "left").drop("holiday_date")
    return joined.withColumn("is_holiday", F.coalesce("is_holiday", F.lit(False)))


def with_sensor(df: DataFrame, versions: DataFrame, key: str = "sensor_id") -> DataFrame:
    """Left join to the current version of each sensor.

    No broadcast is forced: the size of the dimension decides, and a hot sensor on
    the reading side is split by the adaptive skew join.
    """
    current = versions.filter("is_current").select(key, "city", F.col("road_name").alias("sensor_road_name"))
    return df.join(current, key, "left")


def with_sensor_at(
    df: DataFrame,
    versions: DataFrame,
    key: str = "sensor_id",
    ts_col: str = TIME,
    columns: tuple[str, ...] = ("city",),
    version_order: str = "seq",
    tiebreak: str = "event_id",
) -> DataFrame:
    """Left join to the version valid at the time of the row (valid_from <= t < valid_to).

    Rows and versions are laid on one time line per key and the last version is
    carried forward, so a busy key with many versions makes no pairs. Versions
    of one key must not overlap, which is what `scd2` produces. A null key matches none.
    """
    side = versions.filter(F.col(key).isNotNull()).select(
        key,
        F.col("valid_from").alias("__time"),
        F.lit(0).alias("__kind"),
        F.col(version_order).cast("long").alias("__tie"),
        F.struct("valid_to", *columns).alias("__version"),
    )
    facts = df.select(
        "*", F.col(ts_col).alias("__time"), F.lit(1).alias("__kind"), tie(df, tiebreak).cast("long").alias("__tie")
    )
    line = facts.unionByName(side, allowMissingColumns=True)
    carried = carry(
        line, [key], [F.col("__time"), F.col("__kind"), F.col("__tie")], {"__valid": F.col("__version")}
    ).filter("__kind = 1")
    inside = F.col(ts_col) < F.col("__valid.valid_to")
    return carried.select(*df.columns, *[F.when(inside, F.col(f"__valid.{name}")).alias(name) for name in columns])


def with_previous(win: DataFrame, step: str, key: str = "sensor_id", columns: tuple[str, ...] = ("avg_volume",)) -> DataFrame:
    """Each window with the window of the same key that starts one step earlier (inner join on shifted starts)."""
    previous = win.select(
        F.col(key),
        (F.col("window_start") + F.expr(f"interval {step}")).alias("window_start"),
        *[F.col(name).alias(f"previous_{name}") for name in columns],
    )
    return win.join(previous, [key, "window_start"])


def with_group_stats(df: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Per-key statistics merged back to every row.

    An aggregate and a join: a window over the key would put a hot key into one task.
    """
    return df.join(stats, key, "left")


def enrich_stream(stream: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Left stream-static join; the size of the dimension decides on a broadcast."""
    return stream.join(dimension, key, "left")


def with_measures(readings: DataFrame, more: Callable[[WindowSpec], dict[str, Column]] | None = None) -> DataFrame:
    """One row per (sensor, time) with the rolling measures; `more` adds columns over the same windows, up to 23 rows back."""
    load = group_load(readings, ["sensor_id"])
    if load.hot:
        single = one_per_instant(readings)
    else:
        # Same order as the rolling windows, so duplicates go without a shuffle of their own.
        window = Window.partitionBy("sensor_id").orderBy(F.col(TIME), tie(readings))
        single = readings.withColumn("__last", F.lag(TIME).over(window)).filter(f"__last is null or __last <> {TIME}").drop("__last")
    return with_windows(
        single,
        ["sensor_id"],
        [F.col(TIME)],
        lambda w: {
            "rolling_avg_3hr": rolling_rows("traffic_volume", 3, w),
            "rolling_avg_24hr": rolling_rows("traffic_volume", 24, w),
            "volume_pct_change": pct_change("traffic_volume", w),
            **(more(w) if more else {}),
        },
        before=23,
        load=load,
    )


def with_surroundings(measured: DataFrame, wx: DataFrame, holidays: DataFrame, versions: DataFrame) -> DataFrame:
    """Weather, holidays, sensor attributes, key and level of each row."""
    return with_key_and_level(with_sensor(with_holidays(nearest_join(measured, wx), holidays), versions))


def int_enriched(readings: DataFrame, wx: DataFrame, holidays: DataFrame, versions: DataFrame) -> DataFrame:
    """Staged readings with rolling measures, nearest weather, holidays and current sensor.

    The windows run over one row per (sensor, time), before the joins widen the rows.
    """
    return with_surroundings(with_measures(readings), wx, holidays, versions)


def with_key_and_level(df: DataFrame) -> DataFrame:
    """The two columns of the enriched table that come from the reading alone."""
    return df.withColumns({"surrogate_key": surrogate_key("sensor_id", TIME), "traffic_level": traffic_level("traffic_volume")})
