"""Registered queries that run a real stream over the events file and read what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.operators import enrich, staging
from roadpulse.plans.base import columns_sql, r, rounded, sql
from roadpulse.plans.rolling import KIND_SQL, TREND_SQL, TUMBLING_SQL
from roadpulse.plans.sources import CDC_SQL, OVERLAP, SPLIT, change_log, change_target
from roadpulse.session import work_folder
from roadpulse.sources import adapters, streams
from roadpulse.sources.schemas import READING_MESSAGE
from roadpulse.streaming import changes, dimension, late, sinks, state, windows

LATE_AS_OF = "2024-02-15 00:00:00"
GAP = 120
SESSION_GAP_HOURS = 12
ID = ["sensor_id", "reading_timestamp", "event_id"]


def _written(spark, stream):
    """Run a stream to its end into Parquet files and read them."""
    folder = work_folder(spark)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/rows")
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def _plain(df, *columns):
    """TIMESTAMP columns as zone-free times."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def bronze(spark, d):
    folder = work_folder(spark)
    sinks.write_bronze(adapters.reading_stream(spark, d), f"{folder}/bronze", f"{folder}/checkpoint", None).awaitTermination()
    return rounded(_plain(spark.read.parquet(f"{folder}/bronze"), "timestamp"))


def ingested(spark, d):
    """Readings landed as files and loaded by the incremental ingest."""
    folder = work_folder(spark)
    landed = adapters.readings(spark, d).withColumn("timestamp", F.col("reading_timestamp").cast("timestamp"))
    landed.select(*[F.col(f.name).cast(f.dataType) for f in READING_MESSAGE]).write.parquet(f"{folder}/landing")
    streams.auto_ingest(spark, f"{folder}/landing", "traffic_events", f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    return rounded(_plain(spark.read.parquet(f"{folder}/table").drop("batch_id"), "timestamp"))


def closed_windows(spark, d):
    """Hourly windows behind the watermark."""
    stream = streams.with_watermark(adapters.reading_stream(spark, d))
    return rounded(_plain(_written(spark, windows.tumbling(stream, "60 minutes", "timestamp", "event_id")), "window_start", "window_end"))


def live_anomalies(spark, d):
    stream = streams.with_watermark(adapters.reading_stream(spark, d))
    found = windows.anomalies(windows.metrics(stream, 60, "timestamp", "event_id"))
    return _plain(_written(spark, found), "window_start").select("sensor_id", "window_start", "anomaly_type", "trend_indicator")


def deduplicated(spark, d):
    """Every message sent twice."""
    twice = adapters.reading_stream(spark, d).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    kept = windows.deduplicated(streams.with_watermark(twice))
    return _plain(_written(spark, kept), "timestamp").select("sensor_id", "timestamp", "traffic_volume", "event_id")


def late_merged(spark, d):
    """Late rows of a stream upserted into a table that holds the first three weeks."""
    folder = work_folder(spark)
    columns = ["sensor_id", "reading_timestamp", "traffic_volume", "event_id"]
    base = adapters.readings(spark, d).select(*columns)
    late.write_snapshot(base.filter(F.col("reading_timestamp") < F.lit(SPLIT).cast("timestamp_ntz")), f"{folder}/table", 0)
    stream = (
        _plain(adapters.reading_stream(spark, d), "timestamp")
        .withColumnRenamed("timestamp", "reading_timestamp")
        .filter(F.col("reading_timestamp") >= F.lit(OVERLAP).cast("timestamp_ntz"))
        .withColumn("traffic_volume", F.col("traffic_volume") + 1)
        .select(*columns)
    )
    late.late_merge(stream, f"{folder}/table", f"{folder}/checkpoint", LATE_AS_OF).awaitTermination()
    return late.read_current(spark, f"{folder}/table").select(*columns, "is_late_arrival", "updated_at")


def sensor_gaps(spark, d):
    stream = streams.with_watermark(adapters.reading_stream(spark, d))
    with state.rocksdb_state(spark):
        found = _written(spark, state.sensor_state(stream, GAP))
    return rounded(_plain(found, "last_reading", "previous_reading"))


def sensor_sessions(spark, d):
    """Sessions behind the watermark."""
    stream = streams.with_watermark(adapters.reading_stream(spark, d))
    with windows.merged_locally(spark):
        found = _written(spark, windows.sessions(stream, f"{SESSION_GAP_HOURS} hours", "timestamp", "event_id"))
    return rounded(_plain(found, "session_start", "session_end"))


def changes_streamed(spark, d):
    """A change log in three batches, none in the order of the changes and the last a repetition of the first."""
    folder = work_folder(spark)
    log, keys, order = change_log(spark, d), ["sensor_key"], ["change_timestamp", "seq"]
    changes.write_target(change_target(spark, d), f"{folder}/table", keys, {c: log.schema[c].dataType.simpleString() for c in order})
    for load, half in enumerate((1, 0, 1)):
        log.filter(F.col("seq") % 2 == half).write.parquet(f"{folder}/log/load={load}")
        stream = spark.readStream.schema(log.schema).parquet(f"{folder}/log/load=*")
        changes.apply_change_stream(stream, f"{folder}/table", f"{folder}/checkpoint", keys, order).awaitTermination()
    return changes.read_target(spark, f"{folder}/table")


def joined_static(spark, d):
    """A stream against the current versions."""
    current = adapters.sensor_history(spark, d)
    stream = _plain(adapters.reading_stream(spark, d), "timestamp").withColumnRenamed("timestamp", "reading_timestamp")
    versions = staging.scd2(current).filter("is_current").select("sensor_id", "city")
    return _written(spark, enrich.enrich_stream(stream.select(*ID), versions, "sensor_id"))


def moving_history(spark, d):
    """Versions of the sensors inside the period of the readings; `load` tells when they come in."""
    hours = F.make_dt_interval(hours=(F.col("seq") % 720).cast("int"))
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return adapters.sensor_history(spark, d).withColumns({"updated_at": start + hours, "load": (F.col("seq") % 3 == 0).cast("int")})


def joined_changing(spark, d):
    """Readings in two batches; versions that come in between are seen by the second alone."""
    folder = work_folder(spark)
    rows, history = adapters.readings(spark, d).select(*ID), moving_history(spark, d)
    kept = history.drop("load")
    split = F.col("reading_timestamp") < F.lit(SPLIT).cast("timestamp_ntz")
    for load, part in enumerate((split, ~split)):
        history.filter(F.col("load") == load).drop("load").write.parquet(f"{folder}/history/load={load}")
        rows.filter(part).write.parquet(f"{folder}/rows/load={load}")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/rows/load=*")
        dimension.enrich_changing(
            stream, lambda s: s.read.schema(kept.schema).parquet(f"{folder}/history"), f"{folder}/joined", f"{folder}/checkpoint"
        ).awaitTermination()
    return spark.read.parquet(f"{folder}/joined").select(*ID, "city")


QUERIES = {
    "sink_bronze_partitioned": bronze,
    "src_auto_ingest": ingested,
    "stream_watermark": closed_windows,
    "stream_anomaly_live": live_anomalies,
    "stream_dedup": deduplicated,
    "stream_late_merge": late_merged,
    "stream_stateful_sensor": sensor_gaps,
    "stream_session": sensor_sessions,
    "src_cdc_apply_stream": changes_streamed,
    "join_stream_static": joined_static,
    "join_stream_changing": joined_changing,
}

_PARTS = ["sensor_id", "traffic_volume", "road_name", "direction"]
_MEASURES = ["speed_mph", "occupancy_pct", "latitude", "longitude"]
CLOSED_SQL = "window_end <= date_trunc('millisecond', (SELECT max(ts) FROM events)) - INTERVAL 10 MINUTE"

ORACLES = {
    "sink_bronze_partitioned": sql(f"""SELECT {columns_sql(_PARTS + _MEASURES)}, event_id, reading_timestamp AS timestamp,
        CAST(year(reading_timestamp) AS INTEGER) AS year, CAST(month(reading_timestamp) AS INTEGER) AS month,
        CAST(day(reading_timestamp) AS INTEGER) AS day FROM readings"""),
    "src_auto_ingest": sql(f"SELECT {columns_sql(_PARTS + _MEASURES)}, reading_timestamp AS timestamp FROM readings"),
    "stream_watermark": sql(f"""SELECT * REPLACE ({r('avg_volume', 'avg_volume')}, {r('avg_speed', 'avg_speed')})
        FROM ({TUMBLING_SQL}) WHERE {CLOSED_SQL}"""),
    "stream_anomaly_live": sql(TREND_SQL + f""" SELECT sensor_id, window_start, anomaly_type, trend_indicator
        FROM (SELECT *, {KIND_SQL} AS anomaly_type FROM trend) WHERE anomaly_type IS NOT NULL AND {CLOSED_SQL}"""),
    "stream_dedup": sql("SELECT sensor_id, reading_timestamp AS timestamp, traffic_volume, event_id FROM readings"),
    "stream_late_merge": sql(f""", src AS (SELECT * FROM readings WHERE reading_timestamp >= TIMESTAMP '{OVERLAP}')
        SELECT sensor_id, reading_timestamp, traffic_volume, event_id, NULL::BOOLEAN AS is_late_arrival,
            NULL::TIMESTAMP AS updated_at FROM readings WHERE reading_timestamp < TIMESTAMP '{OVERLAP}'
        UNION ALL SELECT sensor_id, reading_timestamp, traffic_volume + 1, event_id, TRUE, TIMESTAMP '{LATE_AS_OF}' FROM src"""),
    "stream_stateful_sensor": sql(f"""SELECT sensor_id, reading_timestamp AS last_reading, earlier AS previous_reading,
        {r("(epoch_us(reading_timestamp) - epoch_us(earlier)) / 1000000.0", 'gap_seconds')}, 'resumed' AS status
        FROM (SELECT *, lag(reading_timestamp) OVER (PARTITION BY sensor_id ORDER BY reading_timestamp) AS earlier FROM readings)
        WHERE reading_timestamp - earlier > INTERVAL {GAP} MINUTE
        UNION ALL SELECT sensor_id, max(reading_timestamp), NULL, {GAP * 60}.0::DOUBLE, 'silent' FROM readings GROUP BY sensor_id
        HAVING max(reading_timestamp) + INTERVAL {GAP} MINUTE < date_trunc('millisecond', (SELECT max(ts) FROM events)) - INTERVAL 10 MINUTE"""),
    "stream_session": sql(f"""SELECT sensor_id, session_start, session_end, reading_count, {r('avg_volume', 'avg_volume')}, max_volume,
        {r('avg_speed', 'avg_speed')}, road_name, direction FROM (
        SELECT sensor_id, min(reading_timestamp) AS session_start, max(reading_timestamp) + INTERVAL {SESSION_GAP_HOURS} HOUR AS session_end,
            count(*) AS reading_count, avg(traffic_volume) AS avg_volume, max(traffic_volume) AS max_volume, avg(speed_mph) AS avg_speed,
            arg_min(road_name, (reading_timestamp, event_id)) AS road_name, arg_min(direction, (reading_timestamp, event_id)) AS direction
        FROM (SELECT *, count(*) FILTER (opens) OVER (PARTITION BY sensor_id ORDER BY reading_timestamp, event_id) AS island
            FROM (SELECT *, coalesce(reading_timestamp - lag(reading_timestamp) OVER (PARTITION BY sensor_id
                ORDER BY reading_timestamp, event_id) > INTERVAL {SESSION_GAP_HOURS} HOUR, TRUE) AS opens FROM readings))
        GROUP BY sensor_id, island) WHERE session_end <= date_trunc('millisecond', (SELECT max(ts) FROM events)) - INTERVAL 10 MINUTE"""),
    "src_cdc_apply_stream": CDC_SQL,
    "join_stream_static": sql(f"""SELECT {', '.join('t.' + c for c in ID)}, v.city
        FROM readings t LEFT JOIN versions v ON v.sensor_id = t.sensor_id AND v.is_current"""),
    "join_stream_changing": sql(f""", moving AS (SELECT sensor_id, city, seq, TIMESTAMP '2024-01-01' + to_hours(seq % 720) AS valid_from,
            seq % 3 = 0 AS later FROM sensor_history),
        seen AS (SELECT 0 AS load, * FROM moving WHERE NOT later UNION ALL SELECT 1, * FROM moving),
        t AS (SELECT {', '.join(ID)}, CASE WHEN reading_timestamp < TIMESTAMP '{SPLIT}' THEN 0 ELSE 1 END AS load FROM readings)
        SELECT {', '.join(ID)}, (SELECT arg_max(v.city, (v.valid_from, v.seq)) FROM seen v
            WHERE v.load = t.load AND v.sensor_id = t.sensor_id AND v.valid_from <= t.reading_timestamp) AS city FROM t"""),
}
