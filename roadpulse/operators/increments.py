"""The enriched hourly table, kept by day and brought up to date by what came in.

The table is partitioned by day. An update finds the rows whose windows reach a new
reading, builds those again from the rows before them, and replaces the days they fall
into; the files of all other days stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators.enrich import TIME, TOLERANCE_MIN, with_measures, with_surroundings
from roadpulse.session import cut_lineage

DAY, KEY = "traffic_date", "sensor_id"
# Rows before a reading that its longest window reaches.
REACH = 23
_NEW, _HIT, _FROM = "__new", "__hit", "__from"


def _write(df: DataFrame, path: str, by: list[str]) -> None:
    """Write or replace the days of `df`; a day is spread over tasks by its keys."""
    laid = df.repartitionByRange(*by).sortWithinPartitions(*by)
    laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def write_hourly(hourly: DataFrame, path: str) -> None:
    # Ranges are sampled first: rows that are not written yet would be made twice.
    _write(cut_lineage(hourly.withColumn(DAY, F.to_date(TIME))), path, [DAY, KEY, TIME])


def read_hourly(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _first_day(built: DataFrame, starts: DataFrame, earliest: date, reach: int) -> date:
    """The day from which every sensor has `reach` rows before its first new reading, or the table's first day.

    The look back doubles, and each step reads key and time of the days in question only.
    """
    oldest = built.agg(F.min(DAY)).first()[0]
    back = 1
    while True:
        day = earliest - timedelta(days=back)
        if oldest is None or day <= oldest:
            return day
        seen = built.filter(F.col(DAY) >= F.lit(day)).select(KEY, TIME).join(starts, KEY).filter(F.col(TIME) < F.col(_FROM))
        enough = seen.groupBy(KEY).count().filter(F.col("count") >= reach).select(KEY)
        if starts.join(enough, KEY, "left_anti").isEmpty():
            return day
        back *= 2


def update_hourly(
    spark: SparkSession, path: str, fresh: DataFrame, wx: DataFrame, holidays: DataFrame, versions: DataFrame
) -> list[date]:
    """Add staged readings, late ones too, to the table; returns the days that were replaced.

    The result is that of a build from all readings, as long as weather, holidays and versions
    say the same for the rows that stay. Readings of an instant that the table has count by the
    same rule as in a full build: the one with the lowest `event_id` stays. The days are written
    beside the table before they take their place in it, so an update that fails can run again.
    """
    fresh = cut_lineage(fresh)
    built = read_hourly(spark, path)
    starts = cut_lineage(fresh.filter(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.min(TIME).alias(_FROM)))
    span = fresh.agg(F.min(TIME), F.max(TIME)).first()
    if span[0] is None:
        return []
    first = _first_day(built, starts, span[0].date(), REACH)
    known = built.filter(F.col(DAY) >= F.lit(first)).join(starts.select(KEY), KEY, "left_semi")
    rows = known.select(*fresh.columns, F.lit(0).alias(_NEW)).unionByName(fresh.withColumn(_NEW, F.lit(1)))

    last = F.greatest(F.lit(span[1]), known.agg(F.max(TIME)).scalar())
    margin = F.expr(f"interval {TOLERANCE_MIN + 1} minutes")
    near = F.col("weather_timestamp").between(F.lit(first).cast("timestamp_ntz") - margin, last + margin)

    def reached(window):
        return {_HIT: F.max(_NEW).over(window.rowsBetween(-REACH, 0))}

    # Only the rows that a new reading reaches go through the joins.
    touched = with_measures(rows, reached).filter(F.col(_HIT) == 1)
    hit = with_surroundings(touched, wx.filter(near), holidays, versions)
    columns = [c for c in built.columns if c != DAY]
    hit = cut_lineage(hit.select(*columns).withColumn(DAY, F.to_date(TIME)))
    days = [r[0] for r in hit.select(DAY).distinct().collect()]  # at most the days of the period
    stays = built.filter(F.col(DAY).isin(days)).join(hit.select(KEY, TIME), [KEY, TIME], "left_anti")
    _write(cut_lineage(stays.select(*columns, DAY).unionByName(hit.select(*columns, DAY))), path, [DAY, KEY, TIME])
    return sorted(days)


def write_daily(spark: SparkSession, hourly_path: str, path: str, build: Callable[[DataFrame], DataFrame], days: list[date] | None = None) -> None:
    """A mart by sensor and day, built from the hourly table; with `days`, those alone are built and replaced."""
    table = read_hourly(spark, hourly_path)
    if days is not None:
        table = table.filter(F.col(DAY).isin(days))
    _write(cut_lineage(build(table)), path, [DAY, KEY])
