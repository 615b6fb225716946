"""Batch sources: scans, landed files, combined sources, nested records."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.functions.columns import as_time
from roadpulse.sources.schemas import WEATHER_DOCUMENT

# Attributes given to every row of the hourly history file.
HISTORY_ROAD = "I-94 Westbound"
HISTORY_DIRECTION = "West"
HISTORY_LATITUDE = 44.98
HISTORY_LONGITUDE = -93.27
HISTORY_SENSOR_PREFIX = "i94-sensor-"
METERS_PER_MILE = 1609.34


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fail while the plan is built if a loader delivers too few columns."""
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"required columns are missing: {missing}")
    return df


def range_scan(df: DataFrame, start, end, ts_col: str = "reading_timestamp", ordered: bool = False) -> DataFrame:
    """Rows in [start, end]; the filter stays on the raw column so the scan can skip files.

    The sort is for a final consumer: inside a larger query it would only add a shuffle.
    """
    found = df.filter(F.col(ts_col).between(as_time(start), as_time(end)))
    return found.orderBy(ts_col) if ordered else found


def read_database(spark: SparkSession, url: str, table: str, predicates: list[str], **properties: str) -> DataFrame:
    """Database table read in parallel, one task per predicate."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)


def read_history_csv(spark: SparkSession, path: str, n_sensors: int = 10) -> DataFrame:
    """Hourly counts from CSV; rows with a bad time or count are left out (`history_rejects` gives them).

    A row's sensor follows from its time, by a hash that other engines have too.
    """
    header_types = T.StructType([T.StructField("date_time", T.StringType()), T.StructField("traffic_volume", T.StringType())])
    raw = spark.read.csv(path, header=True, mode="PERMISSIVE", enforceSchema=False, inferSchema=False)
    raw = require_columns(raw, header_types.names).select(*header_types.names)
    sensor = (F.conv(F.substring(F.md5("date_time"), 1, 8), 16, 10).cast("long") % n_sensors).cast("string")
    return (
        _typed_history(raw)
        .filter("timestamp is not null and volume is not null")
        .select(
            F.concat(F.lit(HISTORY_SENSOR_PREFIX), sensor).alias("sensor_id"),
            "timestamp",
            F.col("volume").alias("traffic_volume"),
            F.lit(None).cast("double").alias("speed_mph"),
            F.lit(None).cast("double").alias("occupancy_pct"),
            F.lit(HISTORY_ROAD).alias("road_name"),
            F.lit(HISTORY_DIRECTION).alias("direction"),
            F.lit(HISTORY_LATITUDE).alias("latitude"),
            F.lit(HISTORY_LONGITUDE).alias("longitude"),
        )
    )


def _typed_history(raw: DataFrame) -> DataFrame:
    return raw.withColumn("timestamp", F.try_to_timestamp("date_time", F.lit("yyyy-MM-dd HH:mm:ss"))).withColumn(
        "volume", F.expr("try_cast(traffic_volume AS INT)")
    )


def history_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a history file that `read_history_csv` leaves out, as they stand there."""
    raw = spark.read.csv(path, header=True, mode="PERMISSIVE", enforceSchema=False, inferSchema=False)
    raw = require_columns(raw, ["date_time", "traffic_volume"])
    return _typed_history(raw).filter("timestamp is null or volume is null").select("date_time", "traffic_volume")


def flatten_weather(raw: DataFrame, json_col: str = "value") -> DataFrame:
    """Weather API documents (JSON text) to flat observations.

    Temperature, humidity, wind and condition are required; a document without
    one of them is dropped. Missing visibility and clouds become 0.
    """
    doc = F.from_json(F.col(json_col).cast("string"), WEATHER_DOCUMENT)
    condition = F.get("weather", F.lit(0))
    # The generator keeps the parse apart from its fields, so a document is parsed once.
    flat = raw.select(F.inline(F.array(doc))).select(
        F.timestamp_seconds("dt").alias("timestamp"),
        F.col("coord.lat").alias("latitude"),
        F.col("coord.lon").alias("longitude"),
        F.col("main.temp").alias("temp_fahrenheit"),
        F.col("main.humidity").alias("humidity_pct"),
        F.col("wind.speed").alias("wind_speed_mph"),
        condition["main"].alias("weather_main"),
        condition["description"].alias("weather_description"),
        (F.coalesce("visibility", F.lit(0.0)) / METERS_PER_MILE).alias("visibility_miles"),
        F.coalesce("clouds.all", F.lit(0)).alias("clouds_pct"),
        F.col("rain.`1h`").alias("rain_1h_mm"),
        F.col("snow.`1h`").alias("snow_1h_mm"),
    )
    return flat.dropna(subset=["temp_fahrenheit", "humidity_pct", "wind_speed_mph", "weather_main"])


def collect_sources(
    loaders: dict[str, Callable[..., DataFrame]], start, end, ts_col: str = "timestamp", ordered: bool = True,
    on_failure: Callable[[str, Exception], None] | None = None,
) -> DataFrame:
    """Stack what each named loader returns for [start, end], tagged with its name.

    A loader that fails while it builds its frame is left out and told to `on_failure`
    (a warning, if not given); it is an error if none is left. What fails when the rows
    are read fails the query.
    """
    loaded, failures = [], []
    for name, load in loaders.items():
        try:
            loaded.append(load(start, end).withColumn("source", F.lit(name)))
        except Exception as error:
            failures.append(f"{name}: {error}")
            if on_failure:
                on_failure(name, error)
            else:
                warnings.warn(f"source {name} is left out: {error}", stacklevel=2)
    if not loaded:
        raise ValueError(f"no source could be loaded: {failures}")
    stacked = union_all(*loaded)
    return stacked.orderBy(ts_col) if ordered else stacked


def union_all(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; a column missing on one side is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def nest_reading(df: DataFrame) -> DataFrame:
    """Flat reading to the nested table layout."""
    return df.select(
        "event_id",
        "sensor_id",
        F.col("reading_timestamp").alias("timestamp"),
        F.struct("latitude", "longitude", F.col("road_name").alias("address")).alias("location"),
        F.struct(
            F.col("traffic_volume").alias("volume"),
            F.col("speed_mph").alias("speed"),
            F.col("occupancy_pct").alias("occupancy"),
        ).alias("traffic_data"),
    )


def flatten_reading(df: DataFrame) -> DataFrame:
    """Nested table layout to flat readings."""
    return df.select(
        "event_id",
        "sensor_id",
        F.col("timestamp").alias("reading_timestamp"),
        F.col("traffic_data.volume").alias("traffic_volume"),
        F.col("traffic_data.speed").alias("speed_mph"),
        F.col("traffic_data.occupancy").alias("occupancy_pct"),
        F.col("location.address").alias("road_name"),
        F.col("location.latitude").alias("latitude"),
        F.col("location.longitude").alias("longitude"),
    )


def batch_load(spark: SparkSession, source: str, target: str, schema: T.StructType, ts_col: str = "timestamp") -> None:
    """Raw Parquet files to the bronze table, under a fixed schema, partitioned by date."""
    raw = spark.read.parquet(source)
    require_columns(raw, schema.names)
    typed = raw.select(*[F.col(field.name).cast(field.dataType) for field in schema])
    with_date_parts(typed, ts_col).write.mode("append").partitionBy("year", "month", "day").parquet(target)


def with_date_parts(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    return df.withColumns({"year": F.year(ts_col), "month": F.month(ts_col), "day": F.dayofmonth(ts_col)})
