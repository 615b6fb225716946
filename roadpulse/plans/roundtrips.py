"""Registered queries that write something, read it back and compare it with what went in."""

from __future__ import annotations

import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.operators import enrich, forecast, marts, staging, tables
from roadpulse.plans import measures
from roadpulse.plans.base import columns_sql, r, rounded, sensor_versions, sql, staged, staged_holidays
from roadpulse.plans.rolling import KIND_SQL, TREND_SQL
from roadpulse.plans.sources import READING, stream_messages, weather_documents
from roadpulse.plans.streams import CLOSED_SQL
from roadpulse.session import work_folder
from roadpulse.sources import adapters, readers, streams
from roadpulse.streaming import progress, sinks, state, windows

FEATURE, TARGET = "occupancy_pct", "traffic_volume"
SENSORS = 10


def history_csv(spark, d):
    """Readings written as an hourly history file, some rows of it broken, and read by the loader."""
    path = f"{work_folder(spark)}/history"
    volume = F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(F.col(TARGET).cast("string"))
    moment = F.when(F.col("event_id") % 11 == 0, "yesterday").otherwise(F.date_format("reading_timestamp", "yyyy-MM-dd HH:mm:ss"))
    raw = adapters.readings(spark, d).select(F.lit("Clear").alias("weather_main"), moment.alias("date_time"), volume.alias("traffic_volume"))
    raw.write.csv(path, header=True)
    rows = readers.read_history_csv(spark, path, SENSORS)
    return rounded(rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).drop("speed_mph", "occupancy_pct"))


def validated(spark, d):
    df = readers.require_columns(adapters.readings(spark, d), READING)
    return rounded(df.select(*READING))


def exported(spark, d):
    """The daily export as CSV, read back under its schema."""
    path = f"{work_folder(spark)}/export"
    df = adapters.readings(spark, d).select("event_id", "sensor_id", TARGET, FEATURE)
    tables.export_csv(df, path)
    return rounded(spark.read.schema(df.schema).csv(path, header=True))


def published(spark, d):
    """Staged predictions appended twice to the served table."""
    path = f"{work_folder(spark)}/served"
    contract = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("predicted", T.DoubleType())])
    made = staged(spark, d).select(F.col("event_id").cast("long").alias("event_id"), (F.col(FEATURE) * 10).alias("predicted"))
    for part in (made.filter("event_id % 2 = 0"), made.filter("event_id % 2 = 1")):
        tables.publish(part, path, contract)
    return rounded(spark.read.parquet(path))


def saved_model(spark, d):
    """A line fitted, saved, loaded and applied to every reading."""
    path = f"{work_folder(spark)}/model"
    rows = staged(spark, d).select("event_id", FEATURE, F.col(TARGET).cast("double").alias(TARGET))
    forecast.save(forecast.fit(rows, "linear", [FEATURE], TARGET), path)
    return rounded(forecast.predict(forecast.load(path), rows, "linear", ["event_id"], TARGET), 4)


def three_sinks(spark, d):
    """Metrics and alerts of one stream in a table, a log and a message sink: rows in each.

    The windows are kept and closed once, in RocksDB; the three sinks read the closed ones as a stream.
    """
    folder = work_folder(spark)
    stream = windows.metrics(streams.with_watermark(adapters.reading_stream(spark, d)), 60, "timestamp", "event_id")
    with state.rocksdb_state(spark):
        measured = sinks.staged(stream, f"{folder}/metrics", f"{folder}/checkpoint/metrics", None)
    cfg = sinks.SinkConfig(
        f"{folder}/table", f"{folder}/checkpoint", "parquet", "parquet", {"path": f"{folder}/alerts"}, None, None, None, {"path": f"{folder}/log"}
    )
    for query in sinks.start_sinks(measured, windows.anomalies(measured), cfg):
        query.awaitTermination()
    kept = {"table": "sensor_id string", "log": "sensor_id string", "alerts": "key string"}
    found = {name: spark.read.schema(columns).parquet(f"{folder}/{name}") for name, columns in kept.items()}
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("sink"), "rows") for name, df in found.items()]
    return readers.union_all(*parts)


def reported(spark, d):
    """Input rows that the progress listener saw of a stream over all readings."""
    folder = work_folder(spark)
    listener = progress.ProgressListener()
    spark.streams.addListener(listener)
    try:
        query = (
            adapters.reading_stream(spark, d).writeStream.format("parquet").queryName(f"reported_{folder[-8:]}")
            .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start(f"{folder}/rows")
        )
        query.awaitTermination()
        until = time.monotonic() + 30  # reports arrive a little later than the rows
        while not any(row[0] == query.name and row[3] for row in listener.rows) and time.monotonic() < until:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    return listener.frame(spark).filter(F.col("name") == query.name).agg(F.sum("input_rows").alias("input_rows"))


def raw_to_daily(spark, d):
    """From JSON messages and weather documents to the daily summary, in the package's own source layouts."""
    readings = streams.decode_readings(stream_messages(spark, d))
    observed = readers.flatten_weather(weather_documents(spark, d))
    table = enrich.int_enriched(
        staging.stg_readings(readings), staging.stg_weather(observed), staged_holidays(spark, d), sensor_versions(spark, d)
    )
    return rounded(marts.mart_daily_summary(table))


QUERIES = {
    "src_csv_history": history_csv,
    "src_validate_columns": validated,
    "export_csv": exported,
    "publish_predictions": published,
    "model_persistence": saved_model,
    "sink_multi": three_sinks,
    "stream_progress": reported,
    "raw_to_daily": raw_to_daily,
}

ORACLES = {
    "src_csv_history": sql(f"""SELECT 'i94-sensor-' || CAST(('0x' || substr(md5(t), 1, 8))::BIGINT % {SENSORS} AS VARCHAR) AS sensor_id,
        CAST(t AS TIMESTAMP) AS timestamp, traffic_volume, 'I-94 Westbound' AS road_name, 'West' AS direction,
        44.98::DOUBLE AS latitude, (-93.27)::DOUBLE AS longitude
        FROM (SELECT *, strftime(reading_timestamp, '%Y-%m-%d %H:%M:%S') AS t FROM readings WHERE event_id % 7 <> 0 AND event_id % 11 <> 0)"""),
    "src_validate_columns": sql(f"SELECT {columns_sql(READING)} FROM readings"),
    "export_csv": sql("SELECT event_id, sensor_id, traffic_volume, occupancy_pct FROM readings"),
    "publish_predictions": sql(f"SELECT CAST(event_id AS BIGINT) AS event_id, {r('occupancy_pct * 10', 'predicted')} FROM staged"),
    "model_persistence": sql(f"""SELECT event_id, 'linear' AS model_name, {r('traffic_volume', 'actual', 4)},
        {r('(SELECT regr_intercept(traffic_volume, occupancy_pct) FROM staged) + (SELECT regr_slope(traffic_volume, occupancy_pct) FROM staged) * occupancy_pct',
           'predicted', 4)} FROM staged"""),
    "sink_multi": sql(TREND_SQL + f""", closed AS (SELECT *, {KIND_SQL} AS anomaly_type FROM trend WHERE {CLOSED_SQL})
        SELECT 'table' AS sink, count(*) AS rows FROM closed UNION ALL SELECT 'log', count(*) FROM closed
        UNION ALL SELECT 'alerts', count(anomaly_type) FROM closed"""),
    # The daily summary over weather as its documents carry it: whole seconds, visibility in metres.
    "raw_to_daily": measures.ORACLES["mart_daily_summary"]
    .replace("SELECT ts AS weather_timestamp", "SELECT date_trunc('second', ts) AS weather_timestamp")
    .replace("% 11 AS DOUBLE) AS visibility_miles", "% 11 AS DOUBLE) * 1000 / CAST(1609.34 AS DOUBLE) AS visibility_miles"),
    "stream_progress": "SELECT CAST(count(*) AS BIGINT) AS input_rows FROM events",
}
