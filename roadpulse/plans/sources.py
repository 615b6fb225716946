"""Registered queries: sources, sinks and table upkeep."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from roadpulse.operators import enrich, increments, layout, tables
from roadpulse.plans.base import columns_sql, r, rounded, sensor_versions, sql, staged, staged_holidays, staged_weather
from roadpulse.session import work_folder
from roadpulse.sources import adapters, changes, readers, streams
from roadpulse.streaming import sinks, windows

READING = [
    "sensor_id", "reading_timestamp", "traffic_volume", "speed_mph", "occupancy_pct", "road_name", "direction",
    "latitude", "longitude", "event_id",
]
SPLIT = "2024-01-21 00:00:00"
OVERLAP = "2024-01-11 00:00:00"


def stream_messages(spark, d):
    """Readings as binary JSON messages."""
    message = F.struct(
        "sensor_id", F.col("reading_timestamp").alias("timestamp"), "traffic_volume", "speed_mph", "occupancy_pct",
        "road_name", "direction", "latitude", "longitude",
    )
    return adapters.readings(spark, d).select(
        F.to_json(message, {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).cast("binary").alias("value")
    )


def stream_json(spark, d):
    """Readings written as messages and decoded again."""
    return rounded(streams.decode_readings(stream_messages(spark, d)).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")))


def weather_documents(spark, d):
    """Weather rows as API documents."""
    doc = F.struct(
        F.unix_timestamp(F.col("weather_timestamp").cast("timestamp")).alias("dt"),
        F.struct(F.lit(44.98).alias("lat"), F.lit(-93.27).alias("lon")).alias("coord"),
        F.struct(F.col("temp_fahrenheit").alias("temp"), F.col("humidity_pct").alias("humidity")).alias("main"),
        F.struct(F.col("wind_speed_mph").alias("speed")).alias("wind"),
        F.array(F.struct(F.col("weather_main").alias("main"), F.lower("weather_main").alias("description"))).alias("weather"),
        (F.col("visibility_miles") * 1000).alias("visibility"),
        F.when(F.col("rain_1h_mm").isNotNull(), F.struct(F.col("rain_1h_mm").alias("1h"))).alias("rain"),
        F.when(F.col("snow_1h_mm").isNotNull(), F.struct(F.col("snow_1h_mm").alias("1h"))).alias("snow"),
    )
    return adapters.weather(spark, d).select(F.to_json(doc).alias("value"))


def weather_json(spark, d):
    """Weather rows written as documents and flattened again."""
    flat = readers.flatten_weather(weather_documents(spark, d))
    return rounded(flat.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")))


def range_scan(spark, d):
    found = readers.range_scan(adapters.readings(spark, d), OVERLAP, SPLIT)
    return rounded(found.select(*READING))


def collected(spark, d):
    def detectors(start, end):
        seen = adapters.readings(spark, d).select(
            F.col("reading_timestamp").alias("timestamp"), F.col("sensor_id").alias("location_id"),
            F.col("traffic_volume").cast("long").alias("vehicle_count"), F.col("speed_mph").alias("avg_speed"),
        )
        return readers.range_scan(seen, start, end, "timestamp")

    def shipments(start, end):
        shipped = adapters.table(spark, d, "lineitem").select(
            F.col("l_shipdate").alias("timestamp"), F.concat(F.lit("dock_"), F.col("l_suppkey").cast("string")).alias("location_id"),
            F.col("l_quantity").cast("long").alias("vehicle_count"),
        )
        return readers.range_scan(shipped, start, end, "timestamp")

    def unreachable(start, end):
        raise ConnectionError("source is down")

    loaders = {"detectors": detectors, "shipments": shipments, "unreachable": unreachable}
    return rounded(readers.collect_sources(loaders, "1990-01-01", "2030-01-01", ordered=False))


def nested(spark, d):
    return rounded(readers.flatten_reading(readers.nest_reading(adapters.readings(spark, d))))


def change_target(spark, d):
    return adapters.table(spark, d, "customer").select(
        F.col("c_custkey").alias("sensor_key"), F.col("c_mktsegment").alias("road_name"), F.lit("-").alias("city")
    )


def change_log(spark, d):
    operation = F.when(F.col("o_orderstatus") == "P", "DELETE").when(F.col("o_orderstatus") == "O", "INSERT").otherwise("UPDATE")
    return adapters.table(spark, d, "orders").select(
        operation.alias("operation"), F.col("o_custkey").alias("sensor_key"), F.col("o_orderpriority").alias("road_name"),
        F.col("o_orderstatus").alias("city"), F.col("o_orderdate").alias("change_timestamp"), F.col("o_orderkey").alias("seq"),
    )


def cdc(spark, d):
    return changes.apply_changes(change_target(spark, d), change_log(spark, d), ["sensor_key"], ["change_timestamp", "seq"])


def batch_load(spark, d):
    """Raw files, with times as text and a column too many, loaded into the partitioned table."""
    folder = work_folder(spark)
    raw = adapters.readings(spark, d).withColumn("reading_timestamp", F.col("reading_timestamp").cast("string"))
    raw.withColumn("unasked", F.lit(1)).write.parquet(f"{folder}/raw")
    schema = adapters.readings(spark, d).select(*READING).schema
    readers.batch_load(spark, f"{folder}/raw", f"{folder}/bronze", schema, "reading_timestamp")
    return rounded(spark.read.parquet(f"{folder}/bronze"))


def merged(spark, d):
    all_rows = adapters.readings(spark, d).select("sensor_id", "reading_timestamp", "traffic_volume", "event_id")
    target = all_rows.filter(F.col("reading_timestamp") < F.lit(SPLIT).cast("timestamp_ntz"))
    source = all_rows.filter(F.col("reading_timestamp") >= F.lit(OVERLAP).cast("timestamp_ntz")).withColumn(
        "traffic_volume", F.col("traffic_volume") + 1
    )
    return tables.merge(target, source, ["sensor_id", "reading_timestamp"], ["event_id"], as_of="2024-01-31 00:00:00", late_flags=True)


def increment(spark, d):
    """The hourly table built from the first days, then brought up to date twice; the first update holds rows that come late."""
    path = f"{work_folder(spark)}/hourly"
    rows, seen = staged(spark, d), F.col("reading_timestamp")
    split, overlap = (F.lit(t).cast("timestamp_ntz") for t in (SPLIT, OVERLAP))
    late = (seen < overlap) & (F.col("event_id") % 200 == 0)
    side = staged_weather(spark, d), staged_holidays(spark, d), sensor_versions(spark, d)
    increments.write_hourly(enrich.int_enriched(rows.filter((seen < overlap) & ~late), *side), path)
    for part in (((seen >= overlap) & (seen < split)) | late, seen >= split):
        increments.update_hourly(spark, path, rows.filter(part), *side)
    built = increments.read_hourly(spark, path)
    return rounded(built.select("surrogate_key", "sensor_id", "reading_timestamp", "traffic_volume", "weather_severity", "rolling_avg_24hr", "volume_pct_change"))


# Places of the period and of the sensors that a reader may ask for: one day, one group of sensors, both.
BOXES = {
    **{f"day {n}": {"reading_timestamp": (date(2024, 1, n), date(2024, 1, n + 1))} for n in (3, 9, 14, 22)},
    **{f"sensors {n}": {"sensor_id": (f"sensor_{n}", f"sensor_{n}9")} for n in (11, 42, 7)},
    "week of some sensors": {"reading_timestamp": (date(2024, 1, 8), date(2024, 1, 14)), "sensor_id": ("sensor_2", "sensor_3")},
}


def _inside(box):
    out = F.lit(True)
    for c, (low, high) in box.items():
        out = out & F.col(c).between(F.lit(low), F.lit(high))
    return out


def compacted(spark, d):
    """Boxes read from the table laid out along the Morton curve: their rows, and whether fewer files are met than in sorted files."""
    folder, columns, n_files = work_folder(spark), ["sensor_id", "reading_timestamp"], 16
    rows = adapters.readings(spark, d)
    layouts = {"morton": layout.compact_morton(rows, columns, n_files), "sorted": tables.compact(rows, columns, n_files)}
    met = []
    for name, laid in layouts.items():
        laid.write.parquet(f"{folder}/{name}")
        bounds = layout.file_bounds(spark, f"{folder}/{name}", columns)
        met.append(layout.files_met(bounds, BOXES).agg(F.sum("files").alias(name)))
    better = met[0].crossJoin(met[1]).select((F.col("morton") * 5 < F.col("sorted") * 4).alias("a_fifth_fewer_files"))
    kept = spark.read.parquet(f"{folder}/morton")
    counts = kept.agg(*[F.count_if(_inside(box)).alias(name) for name, box in BOXES.items()])
    listed = F.array(*[F.struct(F.lit(name).alias("box"), F.col(name).alias("rows")) for name in BOXES])
    return counts.select(F.inline(listed)).crossJoin(better)


def compacted_rows(spark, d):
    return rounded(tables.compact(adapters.readings(spark, d), ["sensor_id", "reading_timestamp"], 8))


def as_of_state(spark, d):
    return tables.state_as_of(adapters.sensor_history(spark, d), ["sensor_id"], ["updated_at", "seq"], "1998-06-30 00:00:00")


def alerts(spark, d):
    measured = windows.metrics(adapters.readings(spark, d), 60, "reading_timestamp", "event_id")
    messages = sinks.to_alert_messages(windows.anomalies(measured))
    # Fields read back from the messages, so that both engines can compare them.
    number = F.get_json_object("value", "$.reading_count").cast("long")
    texts = [F.get_json_object("value", f"$.{c}").alias(c) for c in ("sensor_id", "anomaly_type", "trend_indicator")]
    return messages.select("key", *texts, number.alias("reading_count"), F.get_json_object("value", "$.max_volume").cast("int").alias("max_volume"))


QUERIES = {
    "src_stream_json": stream_json,
    "src_weather_json": weather_json,
    "src_range_scan": range_scan,
    "src_collect_sources": collected,
    "src_nested_flatten": nested,
    "src_cdc_apply": cdc,
    "src_batch_load": batch_load,
    "sink_alerts": alerts,
    "upsert_merge": merged,
    "incremental_mart": increment,
    "compact_layout": compacted,
    "compact_layout_rows": compacted_rows,
    "table_profile": lambda s, d: rounded(tables.profile(adapters.readings(s, d))),
    "describe_stats": lambda s, d: rounded(
        tables.describe(adapters.readings(s, d), ["traffic_volume", "speed_mph", "occupancy_pct", "latitude", "longitude"])
    ),
    "state_as_of": as_of_state,
    "union_all": lambda s, d: readers.union_all(
        adapters.readings(s, d).select("sensor_id", F.col("reading_timestamp").alias("timestamp"), "traffic_volume"),
        adapters.weather(s, d).select("weather_main", F.col("weather_timestamp").alias("timestamp")),
    ),
}

_DESCRIBE = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS n, {r(f'avg({c})', 'mean')}, {r(f'stddev_samp({c})', 'stddev')}, "
    f"{r(f'min({c})', 'min')}, {r(f'max({c})', 'max')} FROM readings"
    for c in ["traffic_volume", "speed_mph", "occupancy_pct", "latitude", "longitude"]
)

CDC_SQL = """WITH last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
            ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1)
        SELECT c_custkey AS sensor_key, c_mktsegment AS road_name, '-' AS city FROM customer
        WHERE c_custkey NOT IN (SELECT o_custkey FROM last)
        UNION ALL SELECT o_custkey, o_orderpriority, o_orderstatus FROM last WHERE o_orderstatus <> 'P'"""

ORACLES = {
    "src_stream_json": sql(f"""SELECT {columns_sql(READING[:1])}, reading_timestamp AS timestamp,
        {columns_sql(READING[2:-1])} FROM readings"""),
    "src_weather_json": sql(f"""SELECT date_trunc('second', weather_timestamp) AS timestamp, 44.98::DOUBLE AS latitude,
        (-93.27)::DOUBLE AS longitude, {columns_sql(['temp_fahrenheit', 'humidity_pct', 'wind_speed_mph', 'weather_main'])},
        lower(weather_main) AS weather_description,
        {r('visibility_miles * 1000 / CAST(1609.34 AS DOUBLE)', 'visibility_miles')}, CAST(0 AS INTEGER) AS clouds_pct,
        {columns_sql(['rain_1h_mm', 'snow_1h_mm'])} FROM weather"""),
    "src_range_scan": sql(f"""SELECT {columns_sql(READING)} FROM readings
        WHERE reading_timestamp BETWEEN TIMESTAMP '{OVERLAP}' AND TIMESTAMP '{SPLIT}'"""),
    "src_collect_sources": sql(f"""SELECT reading_timestamp AS timestamp, sensor_id AS location_id,
            CAST(traffic_volume AS BIGINT) AS vehicle_count, {r('speed_mph', 'avg_speed')}, 'detectors' AS source FROM readings
        UNION ALL SELECT l_shipdate, 'dock_' || CAST(l_suppkey AS VARCHAR), CAST(l_quantity AS BIGINT), NULL, 'shipments'
        FROM lineitem"""),
    "src_nested_flatten": sql(f"""SELECT {columns_sql([c for c in READING if c != 'direction'])} FROM readings"""),
    "src_cdc_apply": CDC_SQL,
    "src_batch_load": sql(f"""SELECT {columns_sql(READING)}, CAST(year(reading_timestamp) AS INTEGER) AS year,
        CAST(month(reading_timestamp) AS INTEGER) AS month, CAST(day(reading_timestamp) AS INTEGER) AS day FROM readings"""),
    "upsert_merge": sql(f""", src AS (SELECT * FROM readings WHERE reading_timestamp >= TIMESTAMP '{OVERLAP}')
        SELECT sensor_id, reading_timestamp, traffic_volume, event_id, NULL::BOOLEAN AS is_late_arrival,
            NULL::TIMESTAMP AS updated_at FROM readings
        WHERE reading_timestamp < TIMESTAMP '{SPLIT}'
          AND (sensor_id, reading_timestamp) NOT IN (SELECT (sensor_id, reading_timestamp) FROM src)
        UNION ALL SELECT sensor_id, reading_timestamp, traffic_volume + 1, event_id, TRUE, TIMESTAMP '2024-01-31 00:00:00'
        FROM (SELECT *, row_number() OVER (PARTITION BY sensor_id, reading_timestamp ORDER BY event_id DESC) AS n FROM src)
        WHERE n = 1"""),
    "incremental_mart": sql(f"""SELECT surrogate_key, sensor_id, reading_timestamp, traffic_volume,
        {columns_sql(['weather_severity', 'rolling_avg_24hr', 'volume_pct_change'])} FROM hourly"""),
    "compact_layout": sql(" UNION ALL ".join(
        f"SELECT '{name}' AS box, count(*) AS rows, TRUE AS a_fifth_fewer_files FROM readings WHERE "
        + " AND ".join(f"{c} BETWEEN '{low}' AND '{high}'" for c, (low, high) in box.items()) for name, box in BOXES.items())),
    "compact_layout_rows": sql(f"SELECT {columns_sql(READING)} FROM readings"),
    "table_profile": sql(f"""SELECT count(*) AS total_records, count(DISTINCT sensor_id) AS unique_sensors,
        min(reading_timestamp) AS earliest_timestamp, max(reading_timestamp) AS latest_timestamp,
        count(DISTINCT CAST(reading_timestamp AS DATE)) AS unique_dates, CAST(sum(traffic_volume) AS BIGINT) AS total_volume,
        {r('avg(traffic_volume)', 'avg_volume')}, max(traffic_volume) AS max_volume, min(traffic_volume) AS min_volume
        FROM readings"""),
    "describe_stats": sql(_DESCRIBE),
    "state_as_of": sql("""SELECT sensor_id, updated_at, seq, road_name, city FROM (SELECT *, row_number() OVER (
            PARTITION BY sensor_id ORDER BY updated_at DESC, seq DESC) AS n FROM sensor_history
            WHERE updated_at <= TIMESTAMP '1998-06-30 00:00:00') WHERE n = 1"""),
    "union_all": sql("""SELECT sensor_id, reading_timestamp AS timestamp, traffic_volume, NULL::VARCHAR AS weather_main
        FROM readings UNION ALL SELECT NULL, weather_timestamp, NULL, weather_main FROM weather"""),
}
