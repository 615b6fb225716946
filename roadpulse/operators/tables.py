"""Keyed upserts, incremental loads, table layout and table statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.functions.columns import as_time
from roadpulse.functions.ordered import keep_first

START_OF_TIME = "0001-01-01 00:00:00"


def merge(
    target: DataFrame, source: DataFrame, keys: list[str], order: list[str], as_of=None, late_flags: bool = False, required: list[str] | None = None
) -> DataFrame:
    """New snapshot of `target`: matched keys take the source's columns, new keys are added.

    A matched row keeps what only the target has. The last source row per key (by
    `order`) counts; source rows without a value in `required` (the last key, if not
    given: the time) are left out. A null key matches nothing, so such a row is added.
    With `as_of` the changed rows are stamped `updated_at`.
    """
    last = keep_first(source.dropna(subset=keys[-1:] if required is None else required), keys, [F.col(c) for c in order], last=True)
    if late_flags:
        last = last.withColumn("is_late_arrival", F.lit(True))
    if as_of is not None:
        last = last.withColumn("updated_at", as_time(as_of))
    given = last.select(*[F.col(c).alias(f"__new_{c}") for c in last.columns], F.lit(True).alias("__matched"))
    same = [F.col(k) == F.col(f"__new_{k}") for k in keys]
    both = target.join(given, same, "left")
    columns = [c for c in target.columns] + [c for c in last.columns if c not in target.columns]

    def value(c: str) -> Column:
        old = F.col(c) if c in target.columns else F.lit(None)
        return (F.when(F.col("__matched"), F.col(f"__new_{c}")).otherwise(old) if c in last.columns and c not in keys else old).alias(c)

    known = target.select(*[F.col(k).alias(f"__old_{k}") for k in keys])
    added = last.join(known, [F.col(k) == F.col(f"__old_{k}") for k in keys], "left_anti")
    return both.select(*map(value, columns)).unionByName(added, allowMissingColumns=True)


def incremental(source: DataFrame, built: DataFrame, ts_col: str = "reading_timestamp", lookback: str | None = None) -> DataFrame:
    """Source rows newer than the built table.

    The high-water mark is a scalar subquery, so the scan can use it to skip
    files. `lookback` (such as '24 hours') rereads a margin for late rows.
    """
    newest = F.max(ts_col) - F.expr(f"interval {lookback}") if lookback else F.max(ts_col)
    edge = built.agg(F.coalesce(newest, F.expr(f"timestamp_ntz'{START_OF_TIME}'"))).scalar()
    return source.filter(F.col(ts_col) > edge)


def state_as_of(log: DataFrame, keys: list[str], order: list[str], t, op_col: str | None = None) -> DataFrame:
    """Rows of a change log as they stood at time `t` (`order` starts with the change time)."""
    seen = log.filter(F.col(order[0]) <= as_time(t))
    last = keep_first(seen, keys, [F.col(c) for c in order], last=True)
    return last.filter(F.col(op_col) != "DELETE") if op_col else last


def compact(df: DataFrame, columns: list[str], n_files: int) -> DataFrame:
    """Rows laid out for few files clustered by `columns`.

    Range partitioning bounds every file by the columns' values, which makes the
    min/max statistics of the files selective; a key with many rows is split by
    the later columns.
    """
    return df.repartitionByRange(n_files, *columns).sortWithinPartitions(*columns)


def write_compacted(df: DataFrame, path: str, columns: list[str], n_files: int) -> None:
    compact(df, columns, n_files).write.mode("overwrite").parquet(path)


def profile(df: DataFrame, ts_col: str = "reading_timestamp") -> DataFrame:
    """One row: counts, distinct sensors and dates, period, volume measures.

    Rows are summed per sensor and date first, so the distinct counts see those alone.
    """
    volume = F.col("traffic_volume")
    daily = df.groupBy("sensor_id", F.to_date(ts_col).alias("date")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(ts_col).alias("first"),
        F.max(ts_col).alias("last"),
        F.sum(volume).alias("total"),
        F.count(volume).alias("known"),
        F.max(volume).alias("most"),
        F.min(volume).alias("least"),
    )
    return daily.agg(
        F.sum("rows").alias("total_records"),
        F.countDistinct("sensor_id").alias("unique_sensors"),
        F.min("first").alias("earliest_timestamp"),
        F.max("last").alias("latest_timestamp"),
        F.countDistinct("date").alias("unique_dates"),
        F.sum("total").alias("total_volume"),
        F.try_divide(F.sum("total"), F.sum("known")).alias("avg_volume"),
        F.max("most").alias("max_volume"),
        F.min("least").alias("min_volume"),
    )


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count, mean, stddev, min and max of every numeric column, one row per column."""
    numeric = columns or [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    measures = {"n": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    flat = df.agg(
        *[
            (fn(c) if m == "n" else fn(F.col(c).cast("double"))).alias(f"{c}__{m}")
            for c in numeric
            for m, fn in measures.items()
        ]
    )
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{m}").alias(m) for m in measures]) for c in numeric]
    )
    return flat.select(F.inline(rows))


def publish(staging: DataFrame, path: str, schema: T.StructType) -> None:
    """Append staged predictions to the served table; the columns must match the contract."""
    have = {f.name: f.dataType for f in staging.schema}
    want = {f.name: f.dataType for f in schema}
    if have != want:
        raise ValueError(f"staged columns {have} differ from the contract {want}")
    staging.select(*schema.names).write.mode("append").parquet(path)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header. One file is only for small reports: it makes one task write all rows."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").csv(path, header=True)
