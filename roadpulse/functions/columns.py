"""Column functions: classification, keys, calendar helpers."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bounds of the volume classes.
VOLUME_LEVELS = [(1000, "low"), (3000, "medium"), (5000, "high")]
# Lower bounds of the congestion classes, checked top down.
CONGESTION_LEVELS = [(5000, "severe_congestion"), (3000, "heavy_traffic"), (1500, "moderate_traffic")]


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def tie(df: DataFrame, tiebreak: str = "event_id") -> Column:
    """What orders rows that are otherwise equal: the named column, or a hash of the row where there is none."""
    return F.col(tiebreak) if tiebreak in df.columns else F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])


def traffic_level(volume: Column | str) -> Column:
    """Volume class; a null volume falls through to 'congested'."""
    volume = _column(volume)
    level = F
    for bound, name in VOLUME_LEVELS:
        level = level.when(volume < bound, name)
    return level.otherwise("congested")


def congestion_level(avg_volume: Column | str) -> Column:
    avg_volume = _column(avg_volume)
    level = F
    for bound, name in CONGESTION_LEVELS:
        level = level.when(avg_volume > bound, name)
    return level.otherwise("normal")


def trend_indicator(change: Column | str) -> Column:
    change = _column(change)
    return F.when(change > 0, "increasing").when(change < 0, "decreasing").otherwise("stable")


def surrogate_key(*parts: Column | str) -> Column:
    texts = [F.coalesce(_column(part).cast("string"), F.lit("NULL")) for part in parts]
    return F.md5(F.concat_ws("|", *texts).cast("binary"))


def dow0_sun(ts: Column | str) -> Column:
    return F.dayofweek(_column(ts)) - 1


def dow1_sun(ts: Column | str) -> Column:
    return F.dayofweek(_column(ts))


def dow0_mon(ts: Column | str) -> Column:
    return F.weekday(_column(ts))


def positive_part(value: Column) -> Column:
    """max(0, value) that stays null for a null value."""
    return F.when(value.isNotNull(), F.greatest(F.lit(0), value))


def epoch_minute(ts: Column | str) -> Column:
    """Whole minutes since 1970 of the calendar fields; independent of the time zone."""
    ts = _column(ts)
    return F.unix_date(F.to_date(ts)).cast("long") * 1440 + F.hour(ts) * 60 + F.minute(ts)


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970 of the calendar fields; independent of the time zone."""
    ts = _column(ts)
    seconds = F.extract(F.lit("SECOND"), ts)
    return epoch_minute(ts) * 60_000_000 + (seconds * 1_000_000).cast("long")


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minute boundaries crossed from start to end (59 s apart can count as 1)."""
    return epoch_minute(end) - epoch_minute(start)


def latest(df: DataFrame, ts_col: str) -> Column:
    """Greatest time of a table as a scalar subquery, the default for every `as_of`."""
    return df.agg(F.max(ts_col)).scalar()


def as_time(as_of: Column | str | date | datetime) -> Column:
    """Accept a literal or a column wherever an operator needs its reference time."""
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        return F.expr(f"timestamp_ntz'{datetime.fromisoformat(as_of)}'")
    return F.expr(f"timestamp_ntz'{as_of}'")


def before(as_of: Column | str | date | datetime, amount: int, unit: str) -> Column:
    """`as_of` minus a number of days, hours or minutes."""
    parts = {"days": F.lit(0), "hours": F.lit(0), "mins": F.lit(0), unit: F.lit(amount)}
    return as_time(as_of) - F.make_dt_interval(**parts)
