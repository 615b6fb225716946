"""Data-quality checks: each returns rows (check, column, violations, passed)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.columns import as_time, before, latest


Rule = tuple[str, str, Column]


def check_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """All rules (check, column, condition of a violation) in one pass over the data."""
    flat = df.agg(*[F.count_if(bad).alias(f"v{i}") for i, (_, _, bad) in enumerate(rules)])
    rows = [
        F.struct(F.lit(check).alias("check"), F.lit(column).alias("column"), F.col(f"v{i}").alias("violations"))
        for i, (check, column, _) in enumerate(rules)
    ]
    return flat.select(F.inline(F.array(*rows))).withColumn("passed", F.col("violations") == 0)


def not_null(columns: list[str]) -> list[Rule]:
    return [("not_null", c, F.col(c).isNull()) for c in columns]


def accepted_range(bounds: dict[str, tuple[float, float]]) -> list[Rule]:
    """Inclusive bounds; nulls pass."""
    return [("accepted_range", c, ~F.col(c).between(low, high)) for c, (low, high) in bounds.items()]


def accepted_values(allowed: dict[str, list]) -> list[Rule]:
    """Nulls pass."""
    return [("accepted_values", c, ~F.col(c).isin(values)) for c, values in allowed.items()]


def not_in_future(ts_col: str, as_of) -> list[Rule]:
    return [("future_time", ts_col, F.col(ts_col) > as_time(as_of))]


def level_consistent(volume: int = 5000) -> list[Rule]:
    """A high volume must not be classed as low."""
    return [("level_consistency", "traffic_level", (F.col("traffic_volume") > volume) & (F.col("traffic_level") == "low"))]


def severity_consistent(severity: float = 5) -> list[Rule]:
    """Severe weather without precipitation; high wind alone can cause it."""
    return [("severity_consistency", "weather_severity", (F.col("weather_severity") > severity) & ~F.col("is_precipitation"))]


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return check_rows(df, not_null(columns))


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once; keys with a null do not count."""
    counted = df.dropna(subset=keys).groupBy(*keys).count()
    return check_rows(counted, [("unique", ",".join(keys), F.col("count") > 1)])


def check_accepted_range(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    return check_rows(df, accepted_range(bounds))


def check_accepted_values(df: DataFrame, allowed: dict[str, list]) -> DataFrame:
    return check_rows(df, accepted_values(allowed))


def orphans(df: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows whose key is set but absent from the parent."""
    known = parent.select(F.col(parent_key or key).alias(key)).distinct()
    return df.filter(F.col(key).isNotNull()).join(known, key, "left_anti")


def check_relationship(df: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Counts orphans per key before the join, so a hot key crosses the network once per task."""
    keyed = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    missing = orphans(keyed, parent, key, parent_key)
    counted = missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
    return counted.select(
        F.lit("relationship").alias("check"),
        F.lit(key).alias("column"),
        "violations",
        (F.col("violations") == 0).alias("passed"),
    )


def check_future_time(df: DataFrame, ts_col: str, as_of) -> DataFrame:
    return check_rows(df, not_in_future(ts_col, as_of))


def check_level_consistency(df: DataFrame, volume: int = 5000) -> DataFrame:
    return check_rows(df, level_consistent(volume))


def check_severity_consistency(wx: DataFrame, severity: float = 5) -> DataFrame:
    return check_rows(wx, severity_consistent(severity))


def run_checks(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def quality_gate(df: DataFrame, as_of=None, hours: int = 24, min_rows: int = 1000, ts_col: str = "reading_timestamp") -> DataFrame:
    """One row over the last day: counts of suspicious rows and the list of issues."""
    moment = as_time(latest(df, ts_col) if as_of is None else as_of)
    volume = F.col("traffic_volume")
    found = df.filter(F.col(ts_col) >= before(moment, hours, "hours")).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(volume.isNull()).alias("null_volumes"),
        F.count_if(volume < 0).alias("negative_volumes"),
        F.count_if(F.col(ts_col) > moment).alias("future_timestamps"),
        F.avg(volume).alias("avg_volume"),
        F.stddev_samp(volume).alias("std_volume"),
    )

    def issue(condition: Column, label: str, count: str) -> Column:
        return F.when(condition, F.concat(F.lit(f"{label}: "), F.col(count).cast("string")))

    issues = F.array_compact(
        F.array(
            issue(F.col("null_volumes") > 0, "Null volumes", "null_volumes"),
            issue(F.col("negative_volumes") > 0, "Negative volumes", "negative_volumes"),
            issue(F.col("future_timestamps") > 0, "Future timestamps", "future_timestamps"),
            issue(F.col("total_records") < min_rows, "Low record count", "total_records"),
        )
    )
    return found.withColumn("issues", F.concat_ws("; ", issues)).withColumn("passed", F.col("issues") == "")


def quality_metrics(
    df: DataFrame, keys: list[str], columns: list[str], volume: str, low: float, high: float, source: str = "source"
) -> DataFrame:
    """Records, missing values, repeated records and outliers of each source.

    Rows are first reduced per key, which gives the repeats and the sums in one shuffle.
    """
    missing = sum(F.col(c).isNull().cast("long") for c in columns)
    per_key = df.groupBy(source, *keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(missing).alias("missing"),
        F.count_if(~F.col(volume).between(low, high)).alias("outliers"),
    )
    return per_key.groupBy(source).agg(
        F.sum("n").alias("total_records"),
        F.sum("missing").alias("missing_values"),
        F.sum(F.col("n") - 1).alias("duplicate_records"),
        F.sum("outliers").alias("outliers"),
    )
