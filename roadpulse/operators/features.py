"""Model features."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.columns import dow0_mon, dow1_sun, tie
from roadpulse.functions.ordered import number_rows, with_windows
from roadpulse.functions.sizing import GroupLoad, group_load
from roadpulse.operators.cleaning import dedup, fill_missing, iqr_filter
from roadpulse.operators.enrich import with_group_stats
from roadpulse.operators.windows import TIME, rolling_measures
from roadpulse.session import cut_lineage

# Default lags and window lengths, in rows.
LAG_PERIODS = [1, 2, 3, 6, 12, 24]
ROLLING_WINDOWS = [3, 6, 12, 24]


def time_features_stream(df: DataFrame, ts_col: str = TIME) -> DataFrame:
    """Calendar columns of the stream (day_of_week: 1 = Sunday; rush hours 7-9 and 17-19)."""
    hour, dow = F.hour(ts_col), dow1_sun(ts_col)
    return df.withColumns(
        {
            "hour_of_day": hour,
            "day_of_week": dow,
            "day_of_month": F.dayofmonth(ts_col),
            "month": F.month(ts_col),
            "year": F.year(ts_col),
            "is_weekend": dow.isin(1, 7),
            "is_rush_hour": hour.between(7, 9) | hour.between(17, 19),
        }
    )


def _cycle(value: Column, length: int) -> tuple[Column, Column]:
    angle = value * (2 * math.pi) / length
    return F.sin(angle), F.cos(angle)


def time_features_ml(df: DataFrame, ts_col: str = TIME) -> DataFrame:
    """Calendar columns of the models (day_of_week: 0 = Monday; rush hours 7-9 and 16-18)."""
    hour, dow, month = F.hour(ts_col), dow0_mon(ts_col), F.month(ts_col)
    cycles = {"hour": _cycle(hour, 24), "day": _cycle(dow, 7), "month": _cycle(month, 12)}
    return df.withColumns(
        {
            "hour": hour,
            "day_of_week": dow,
            "day_of_month": F.dayofmonth(ts_col),
            "month": month,
            "quarter": F.quarter(ts_col),
            "year": F.year(ts_col),
            **{f"{name}_sin": pair[0] for name, pair in cycles.items()},
            **{f"{name}_cos": pair[1] for name, pair in cycles.items()},
            "is_morning_rush": hour.between(7, 9).cast("int"),
            "is_evening_rush": hour.between(16, 18).cast("int"),
            "is_weekend": (dow >= 5).cast("int"),
        }
    )


def interaction_features(df: DataFrame, count: str = "traffic_volume", speed: str = "speed_mph") -> DataFrame:
    return df.withColumns(
        {
            "traffic_density": F.try_divide(F.col(count), F.col(speed) + 1),
            "rush_hour_speed_factor": F.col(speed) * F.col("is_morning_rush"),
            "evening_rush_speed_factor": F.col(speed) * F.col("is_evening_rush"),
        }
    )


def group_summary(df: DataFrame, by: str, measures: list[str], digits: int = 2) -> DataFrame:
    """mean, std, min and max of each measure per group, rounded half up."""
    kinds = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    return df.groupBy(by).agg(
        *[F.round(fn(m), digits).alias(f"{m}_{kind}") for m in measures for kind, fn in kinds.items()]
    )


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with their alphabetical rank, from 0: the position in their global order."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return number_rows(values, [F.col(column)]).withColumnRenamed("__index", f"{column}_encoded")


def label_encode(df: DataFrame, column: str) -> DataFrame:
    return df.join(label_codes(df, column), column, "left")


def location_features(df: DataFrame, key: str, measures: list[str]) -> DataFrame:
    """Encoded key plus the statistics of its group on every row."""
    return with_group_stats(label_encode(df, key), group_summary(df, key, measures), key)


def lag_and_rolling(
    df: DataFrame,
    target: str,
    lag_periods: list[int] = LAG_PERIODS,
    rolling_windows: list[int] = ROLLING_WINDOWS,
    key: str = "sensor_id",
    ts_col: str = TIME,
    tiebreak: str = "event_id",
    exclude_current: bool = False,
    load: GroupLoad | None = None,
) -> DataFrame:
    """All lag and rolling columns over one sort per key."""

    def measures(window):
        lagged = {f"{target}_lag_{n}": F.lag(target, n).over(window) for n in lag_periods}
        return {**lagged, **rolling_measures([target], rolling_windows, window, exclude_current)}

    return with_windows(
        df, [key], [F.col(ts_col), tie(df, tiebreak)], measures, before=max([*lag_periods, *rolling_windows]), load=load
    )


def clean(
    df: DataFrame, columns: list[str], key: str = "sensor_id", ts_col: str = TIME, tiebreak: str = "event_id", load: GroupLoad | None = None
) -> DataFrame:
    """One row per (time, key), gaps filled, outliers removed."""
    single = dedup(df, [key, ts_col], [tiebreak])
    # Written once: the quartiles of each column are taken from the filled rows.
    return iqr_filter(cut_lineage(fill_missing(single, columns, key, ts_col, tiebreak, load)), columns)


def prepare(
    df: DataFrame,
    target: str = "traffic_volume",
    speed: str = "speed_mph",
    lag_periods: list[int] = LAG_PERIODS,
    rolling_windows: list[int] = ROLLING_WINDOWS,
    key: str = "sensor_id",
    ts_col: str = TIME,
    tiebreak: str = "event_id",
    exclude_current: bool = False,
) -> DataFrame:
    """Clean readings with all feature columns; rows with a gap are left out.

    With `exclude_current` the rolling columns do not see the target of their own row.
    """
    # Cleaning only takes rows away, so one count of the rows per key serves all windows.
    load = group_load(df, [key])
    cleaned = clean(df, [target, speed], key, ts_col, tiebreak, load)
    timed = time_features_ml(cleaned, ts_col)
    rolled = lag_and_rolling(timed, target, lag_periods, rolling_windows, key, ts_col, tiebreak, exclude_current, load)
    return interaction_features(location_features(rolled, key, [target, speed]), target, speed).dropna()


def feature_columns(df: DataFrame, exclude: list[str]) -> list[str]:
    """Numeric columns that are not the target, the key or the time."""
    numeric = {"int", "bigint", "double", "float"}
    return [name for name, kind in df.dtypes if kind in numeric and name not in exclude]


def scale_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with mean and population deviation of each column."""
    return df.agg(
        *[F.avg(c).alias(f"{c}__mean") for c in columns], *[F.stddev_pop(c).alias(f"{c}__std") for c in columns]
    )


def scale(df: DataFrame, columns: list[str], stats: DataFrame | None = None) -> DataFrame:
    """z-scores with the population deviation; a constant column is only centred.

    `stats` from the training rows scales other rows the same way.
    """
    row = (scale_stats(df, columns) if stats is None else stats).first()

    def scaled(c: str) -> Column:
        spread = row[f"{c}__std"]
        return (F.col(c) - F.lit(row[f"{c}__mean"])) / F.lit(spread if spread else 1.0)

    return df.withColumns({c: scaled(c) for c in columns})
