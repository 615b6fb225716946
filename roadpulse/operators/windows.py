"""Rolling, lag and range measures per sensor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from roadpulse.functions.columns import epoch_micros, tie
from roadpulse.functions.ordered import running_sums, with_windows

TIME = "reading_timestamp"


def rolling_rows(column: str, rows: int, window: WindowSpec) -> Column:
    """Mean over the last `rows` rows, the current one included."""
    return F.avg(column).over(window.rowsBetween(-(rows - 1), 0))


def pct_change(column: str, window: WindowSpec) -> Column:
    """Change from the previous row in percent; null after a zero."""
    previous = F.lag(column).over(window)
    return (F.col(column) - previous).cast("double") / F.nullif(previous, F.lit(0)) * 100


def _order(df: DataFrame, ts_col: str, tiebreak: str) -> list[Column]:
    return [F.col(ts_col), tie(df, tiebreak)]


def rolling_averages(df: DataFrame, column: str, sizes: tuple[int, ...] = (3, 24), key="sensor_id", ts_col=TIME, tiebreak="event_id"):
    return with_windows(
        df,
        [key],
        _order(df, ts_col, tiebreak),
        lambda w: {f"rolling_avg_{n}": rolling_rows(column, n, w) for n in sizes},
        before=max(sizes) - 1,
    )


def percent_changes(df: DataFrame, column: str, key="sensor_id", ts_col=TIME, tiebreak="event_id") -> DataFrame:
    return with_windows(
        df, [key], _order(df, ts_col, tiebreak), lambda w: {f"{column}_pct_change": pct_change(column, w)}, before=1
    )


def lags(df: DataFrame, columns: list[str], periods: list[int], key="sensor_id", ts_col=TIME, tiebreak="event_id") -> DataFrame:
    return with_windows(
        df,
        [key],
        _order(df, ts_col, tiebreak),
        lambda w: {f"{c}_lag_{n}": F.lag(c, n).over(w) for c in columns for n in periods},
        before=max(periods),
    )


def rolling_measures(columns: list[str], sizes: list[int], window: WindowSpec, exclude_current: bool = False) -> dict[str, Column]:
    """Mean, sample deviation and maximum over the last n rows."""
    shift = 1 if exclude_current else 0
    out = {}
    for c in columns:
        for n in sizes:
            frame = window.rowsBetween(-(n - 1) - shift, -shift)
            out[f"{c}_rolling_mean_{n}"] = F.avg(c).over(frame)
            out[f"{c}_rolling_std_{n}"] = F.stddev_samp(c).over(frame)
            out[f"{c}_rolling_max_{n}"] = F.max(c).over(frame)
    return out


def rolling_features(
    df: DataFrame, columns: list[str], sizes: list[int], key="sensor_id", ts_col=TIME, tiebreak="event_id", exclude_current=False
) -> DataFrame:
    return with_windows(
        df,
        [key],
        _order(df, ts_col, tiebreak),
        lambda w: rolling_measures(columns, sizes, w, exclude_current),
        before=max(sizes),
    )


def rolling_range(df: DataFrame, column: str, minutes: int = 15, key: str = "sensor_id", ts_col: str = TIME) -> DataFrame:
    """Sample deviation and mean of `column` over the last `minutes` minutes of each key.

    Each time of a key is summed up once and entered twice, on arrival and (negated)
    on expiry, so one running sum serves all rows: the work is linear in the rows,
    however dense the readings or long the frame, and oversized keys are summed in blocks.
    Sums are exact decimals, so leaving values cancel without a remainder: values
    count to six decimals, and NaN and infinities as missing.
    """
    span = minutes * 60_000_000
    value = F.col(column).cast("decimal(18,6)")
    at = epoch_micros(ts_col)
    per_time = df.groupBy(F.col(key).alias("__key"), at.alias("__at")).agg(
        F.count(value).alias("n"), F.sum(value).alias("s"), F.sum((value * value).cast("decimal(30,6)")).alias("ss")
    )
    zero = F.lit(0).cast("decimal(38,6)")
    arrive = F.struct(
        F.col("__at").alias("at"),
        F.lit(0).alias("leaves"),
        F.col("n"),
        F.coalesce(F.col("s").cast("decimal(38,6)"), zero).alias("s"),
        F.coalesce(F.col("ss").cast("decimal(38,6)"), zero).alias("ss"),
    )
    # The frame includes its far edge: at equal times an expiry comes after the arrivals.
    expire = F.struct(
        (F.col("__at") + span).alias("at"),
        F.lit(1).alias("leaves"),
        (-F.col("n")).alias("n"),
        (-arrive["s"]).cast("decimal(38,6)").alias("s"),
        (-arrive["ss"]).cast("decimal(38,6)").alias("ss"),
    )
    entries = per_time.select("__key", F.inline(F.array(arrive, expire)))
    running = running_sums(entries, ["__key"], [F.col("at"), F.col("leaves")], ["n", "s", "ss"])
    totals = running.filter("leaves = 0").select("__key", F.col("at").alias("__at"), "n", "s", "ss")
    count, total, squares = F.col("n"), F.col("s").cast("double"), F.col("ss").cast("double")
    spread = (squares - total * total / count) / (count - 1)
    joined = df.join(totals, F.col(key).eqNullSafe(F.col("__key")) & (at == F.col("__at")), "left")
    return joined.select(
        *df.columns,
        F.when(count > 1, F.sqrt(F.greatest(F.lit(0.0), spread))).alias(f"{column}_rolling_std"),
        F.when(count > 0, total / count).alias(f"{column}_rolling_avg"),
    )


def zscore_anomaly(
    df: DataFrame, column: str = "traffic_volume", threshold: float = 2.5, minutes: int = 15, key="sensor_id", ts_col=TIME
) -> DataFrame:
    """Rows that lie more than `threshold` deviations from their rolling mean."""
    rolled = rolling_range(df, column, minutes, key, ts_col)
    z = F.try_divide(F.abs(F.col(column) - F.col(f"{column}_rolling_avg")), F.col(f"{column}_rolling_std"))
    return rolled.withColumn("z_score", z).filter(F.col("z_score") > threshold)


def sequences(df: DataFrame, columns: list[str], target: str, n: int = 24, key="sensor_id", ts_col=TIME, tiebreak="event_id") -> DataFrame:
    """The `n` rows before each row as an array, with the row's own value as target."""
    built = with_windows(
        df,
        [key],
        _order(df, ts_col, tiebreak),
        lambda w: {"sequence": F.collect_list(F.array(*[F.col(c).cast("double") for c in columns])).over(w.rowsBetween(-n, -1))},
        before=n,
    )
    own = [c for c in (key, ts_col, tiebreak) if c in df.columns]
    return built.filter(F.size("sequence") == n).select(*own, "sequence", F.col(target).alias("next_value"))
