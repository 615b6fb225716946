"""Domain tables (readings, weather, holidays, sensor history) over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The holidays inside the period of the given events.
HOLIDAYS = [("2024-01-01", "New Year"), ("2024-01-15", "MLK Day")]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def readings_from(events: DataFrame) -> DataFrame:
    """Events, as a table or a stream, read as sensor readings."""
    user, event = F.col("user_id"), F.col("event_id")
    return events.select(
        F.concat(F.lit("sensor_"), user.cast("string")).alias("sensor_id"),
        F.col("ts").alias("reading_timestamp"),
        F.floor(F.col("value") * 20).cast("int").alias("traffic_volume"),
        F.when(event % 50 != 0, (5 + (event * 7) % 66).cast("double")).alias("speed_mph"),
        ((event * 13) % 101).cast("double").alias("occupancy_pct"),
        F.col("event_type").alias("road_name"),
        F.element_at(F.array(*map(F.lit, ("North", "South", "East", "West"))), (user % 4 + 1).cast("int")).alias("direction"),
        F.expr("CAST(44 + (user_id % 100) / 100.0 AS DOUBLE)").alias("latitude"),
        F.expr("CAST(-93 - (user_id % 50) / 100.0 AS DOUBLE)").alias("longitude"),
        event,
    )


def readings(spark: SparkSession, folder: str) -> DataFrame:
    return readings_from(table(spark, folder, "events"))


def reading_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events file as a stream of readings; `timestamp` is a TIMESTAMP, as watermarks need it."""
    schema = table(spark, folder, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    stream = readings_from(events).withColumnRenamed("reading_timestamp", "timestamp")
    return stream.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def weather(spark: SparkSession, folder: str) -> DataFrame:
    """One observation per ten events."""
    nth = F.expr("event_id DIV 10")
    kinds = F.array(*map(F.lit, ("Clear", "Clouds", "Rain", "Snow", "Fog")))
    return (
        table(spark, folder, "events")
        .filter("event_id % 10 = 0")
        .select(
            F.col("ts").alias("weather_timestamp"),
            (-20 + (nth * 7) % 120).cast("double").alias("temp_fahrenheit"),
            ((nth * 11) % 101).cast("double").alias("humidity_pct"),
            ((nth * 7) % 46).cast("double").alias("wind_speed_mph"),
            F.element_at(kinds, (nth % 5 + 1).cast("int")).alias("weather_main"),
            (nth % 11).cast("double").alias("visibility_miles"),
            F.when(nth % 5 == 2, (nth % 4).cast("double") / 2).alias("rain_1h_mm"),
            F.when(nth % 5 == 3, (nth % 3).cast("double") / 2).alias("snow_1h_mm"),
            "event_id",
        )
    )


def holidays(spark: SparkSession, folder: str) -> DataFrame:
    """A literal table: Spark knows its size and broadcasts it."""
    rows = ", ".join(f"(DATE'{day}', '{name}')" for day, name in HOLIDAYS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(date, name)")


def sensor_history(spark: SparkSession, folder: str) -> DataFrame:
    """Versions of the sensor attributes; `updated_at` has ties, `seq` orders them."""
    return table(spark, folder, "orders").select(
        F.concat(F.lit("sensor_"), (F.col("o_custkey") % 150).cast("string")).alias("sensor_id"),
        F.col("o_orderdate").alias("updated_at"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderpriority").alias("road_name"),
        F.col("o_orderstatus").alias("city"),
    )


def sensor_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer, read as a sensor with its state (nation) and region."""
    c = table(spark, folder, "customer")
    n = table(spark, folder, "nation")
    r = table(spark, folder, "region")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
