"""Deduplication, gap filling and outlier removal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.columns import tie
from roadpulse.functions.ordered import carry, keep_first
from roadpulse.functions.quantiles import exact_quantiles
from roadpulse.functions.sizing import GroupLoad
from roadpulse.session import cut_lineage


def dedup(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key; repeats are dropped before the shuffle. A column of `order` that is missing stands for a hash of the row."""
    return keep_first(df, keys, [tie(df, c) for c in order])


def fill_missing(
    df: DataFrame, columns: list[str], key: str, ts_col: str, tiebreak: str, load: GroupLoad | None = None
) -> DataFrame:
    """Fill gaps with the last value of the key, then the next one, then the overall median.

    The median is that of the rows after both fills, and matters only for keys without any
    value. One pass counts those; only where there are some the filled rows are written, to
    be read for the median and for the result.
    """
    order = [F.col(ts_col), tie(df, tiebreak)]
    around = carry(
        df, [key], order, {f"__last_{c}": F.col(c) for c in columns}, {f"__next_{c}": F.col(c) for c in columns}, load
    )
    filled = around.withColumns({c: F.coalesce(F.col(f"__last_{c}"), F.col(f"__next_{c}")) for c in columns})
    filled = filled.select(*df.columns).withColumns({c: F.col(c).cast("double") for c in columns})
    per_key = df.groupBy(key).agg(*[F.count(c).alias(c) for c in columns])
    bare = per_key.agg(*[F.count_if(F.col(c) == 0).alias(c) for c in columns]).first()
    open_ = [c for c in columns if bare[c]]
    if not open_:
        return filled
    filled = cut_lineage(filled)
    medians = exact_quantiles(filled, {c: [0.5] for c in open_})
    return filled.withColumns({c: F.coalesce(F.col(c), F.lit(medians[c][0])) for c in open_})


def iqr_bounds(df: DataFrame, column: str, k: float = 1.5) -> tuple[float, float] | None:
    """Limits of the accepted values; None for a column without values."""
    q1, q3 = exact_quantiles(df, {column: [0.25, 0.75]})[column]
    return None if q1 is None else (q1 - (q3 - q1) * k, q3 + (q3 - q1) * k)


def iqr_filter(df: DataFrame, columns: list[str], k: float = 1.5) -> DataFrame:
    """Keep rows inside Q1 - k*IQR .. Q3 + k*IQR, one column after the other.

    The quartiles of a later column come from the rows the earlier ones left.
    """
    for c in columns:
        bounds = iqr_bounds(df, c, k)
        df = df.filter(F.col(c).between(*bounds) if bounds else F.lit(False))
    return df


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.dropna(subset=columns) if columns else df.dropna()
