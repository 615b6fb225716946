"""Registered queries: marts, observability, logs, costs, reports, rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.functions.columns import latest
from roadpulse.operators import costs, enrich, features, increments, late, marts, monitoring, observability, quality, reports
from roadpulse.plans import graphs
from roadpulse.plans.base import columns_sql, hourly, r, rounded, sensor_versions, sql, staged, staged_holidays, staged_weather
from roadpulse.plans.shaping import STATS_SQL
from roadpulse.session import cut_lineage, work_folder
from roadpulse.sources import adapters
from roadpulse.streaming import windows

AS_OF = "2024-01-31 00:00:00"
HEALTH_MIN = 8


def _end(spark, d):
    """Latest event time as a scalar subquery."""
    return latest(adapters.table(spark, d, "events"), "ts")


def _late(spark, d):
    """Late rows with the time they were merged: one day after they arrived."""
    found = late.late_arrivals(adapters.readings(spark, d), _end(spark, d))
    return found.withColumn("updated_at", F.col("reading_timestamp") + F.expr("interval 1 day"))


# Hours to two places, rounded half up in whole numbers: floats would fall just short of a half.
_LATE_SQL = """, late AS (SELECT *, TRUE AS is_late_arrival,
    (2 * (epoch(date_trunc('second', (SELECT max(ts) FROM events))) - epoch(date_trunc('second', reading_timestamp)))::BIGINT + 36) // 72
        / CAST(100 AS DOUBLE)
        AS late_arrival_hours, reading_timestamp + INTERVAL 1 DAY AS updated_at
    FROM readings WHERE reading_timestamp < (SELECT max(ts) FROM events) - INTERVAL 24 HOUR)"""


def late_cleanup(spark, d):
    kept = late.late_cleanup(_late(spark, d), _end(spark, d), days=14)
    return rounded(kept.select("sensor_id", "reading_timestamp", "updated_at", "late_arrival_hours", "event_id"))


def metric_log(spark, d):
    return adapters.table(spark, d, "events").select(
        F.col("ts").alias("timestamp"), F.col("event_type").alias("metric_name"), F.col("value").alias("metric_value"),
        F.concat(F.lit("model_"), (F.col("user_id") % 5).cast("string")).alias("model_name"),
    )


def quality_log(spark, d):
    n = F.col("event_id")
    return adapters.table(spark, d, "events").select(
        F.col("ts").alias("timestamp"), (100 + n % 50).alias("total_records"), (n % (F.length("event_type") * 9)).alias("missing_values"),
        (n % 7).alias("duplicate_records"), (n % 11).alias("outliers"), F.col("event_type").alias("data_source"),
    )


def accuracy_log(spark, d):
    return adapters.table(spark, d, "events").select(
        F.col("ts").alias("timestamp"), F.concat(F.lit("model_"), (F.col("event_id") % 3).cast("string")).alias("model_name"),
        F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("location_id"),
        F.abs(F.col("value") - 50).alias("absolute_error"),
    )


_LOGS_SQL = """WITH latest AS (SELECT max(ts) - INTERVAL 24 HOUR AS cut FROM events),
metric AS (SELECT event_type AS metric_name, 'model_' || CAST(user_id % 5 AS VARCHAR) AS model_name, avg(value) AS avg_value,
    count(*) AS count FROM events WHERE ts > (SELECT cut FROM latest) GROUP BY ALL),
quality AS (SELECT event_type AS data_source, avg(100 + event_id % 50) AS avg_records,
    avg(event_id % (length(event_type) * 9)) AS avg_missing, avg(event_id % 7) AS avg_duplicates, avg(event_id % 11) AS avg_outliers
    FROM events WHERE ts > (SELECT cut FROM latest) GROUP BY ALL) """

THRESHOLDS = [("click", 45.0), ("view", 40.0), ("purchase", 20.0), ("error", 60.0)]


def threshold_alerts(spark, d):
    end = _end(spark, d)
    bounds = spark.createDataFrame(THRESHOLDS, "metric_name string, threshold double")
    metrics = monitoring.pipeline_summary(metric_log(spark, d), end)
    return rounded(monitoring.threshold_alerts(metrics, monitoring.quality_summary(quality_log(spark, d), end), bounds))


def quality_metrics(spark, d):
    df = adapters.readings(spark, d).withColumn("hour", F.date_trunc("hour", "reading_timestamp"))
    return quality.quality_metrics(
        df, ["sensor_id", "hour"], ["traffic_volume", "speed_mph"], "traffic_volume", 100, 4000, source="road_name"
    )


def observability_summary(spark, d):
    df = staged(spark, d)
    return observability.summarise_checks(
        observability.freshness_summary(observability.freshness(df, AS_OF)),
        observability.anomaly_summary(observability.volume_anomalies(df)),
        graphs.drift_summary(spark, d),
    )


def usage_log(spark, d):
    return adapters.table(spark, d, "lineitem").select(
        F.concat(F.lit("TRAFFIC_"), F.col("l_suppkey").cast("string")).alias("warehouse_name"), F.col("l_shipdate").alias("start_time"),
        F.col("l_quantity").alias("credits_used"), F.col("l_extendedprice").alias("total_elapsed_ms"),
        (F.col("l_tax") * 1000).alias("queued_ms"),
    )


def order_log(spark, d):
    return adapters.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("query_id"), F.col("o_orderkey").alias("transfer_id"), F.col("o_orderdate").alias("start_time"),
        F.concat(F.lit("TRAFFIC_"), "o_orderpriority").alias("warehouse_name"), F.col("o_totalprice").alias("total_elapsed_ms"),
        (F.col("o_totalprice") * 1e6).alias("bytes_scanned"), (F.col("o_totalprice") * 1e5).alias("bytes_transferred"),
        F.col("o_orderpriority").alias("region"), F.col("o_orderstatus").alias("transfer_type"),
        (F.col("o_custkey") % 10).cast("double").alias("credits_used"),
    )


def catalog(spark, d):
    return adapters.table(spark, d, "part").select(
        F.col("p_brand").alias("table_schema"), F.concat(F.col("p_name"), F.lit("#"), F.col("p_partkey").cast("string")).alias("table_name"),
        F.col("p_size").alias("row_count"), (F.col("p_retailprice") * 1e7).alias("bytes"),
    )


def _last(spark, d, table, column):
    return latest(adapters.table(spark, d, table), column)


def state_table(spark, d):
    """Customers as sensors: state (nation), region and report measures."""
    n, bal = F.col("c_custkey"), F.col("c_acctbal")
    return adapters.sensor_dimension(spark, d).select(
        F.col("n_name").alias("state"), F.col("r_name").alias("region"), F.col("c_mktsegment").alias("status"), "c_custkey",
        (15000 + n % 30000).alias("hourly_volume"), (1 + n % 20).alias("total_sensors"), (15 + n % 20).cast("double").alias("congestion_percent"),
        bal.alias("revenue_impact"), (92 + (n % 30) / 10).alias("ml_accuracy"), (1.5 + (n % 30) / 10).alias("response_time"),
        (95 + (n % 45) / 10).alias("data_quality"),
    )


_STATE_SQL = """WITH state AS (SELECT n_name AS state, r_name AS region, c_mktsegment AS status, c_custkey,
    15000 + c_custkey % 30000 AS hourly_volume, 1 + c_custkey % 20 AS total_sensors,
    CAST(15 + c_custkey % 20 AS DOUBLE) AS congestion_percent, c_acctbal AS revenue_impact,
    92 + (c_custkey % 30) / CAST(10 AS DOUBLE) AS ml_accuracy, 1.5 + (c_custkey % 30) / CAST(10 AS DOUBLE) AS response_time,
    95 + (c_custkey % 45) / CAST(10 AS DOUBLE) AS data_quality
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) """
_TOTALS = {"total_sensors": "Sensors", "hourly_volume": "Vehicles/Hour"}
_MEANS = {"congestion_percent": "Percent", "data_quality": "Percent", "ml_accuracy": "Percent", "response_time": "Minutes"}


def sensor_totals(spark, d):
    return staged(spark, d).groupBy("sensor_id").agg(
        F.sum("traffic_volume").alias("total_volume"),
        (F.avg((F.col("traffic_volume") >= 3000).cast("double")) * 100).alias("congestion_pct"),
        F.avg("speed_mph").alias("avg_speed"),
    )


_TOTALS_SQL = """, totals AS (SELECT sensor_id, CAST(sum(traffic_volume) AS BIGINT) AS total_volume,
    avg(CASE WHEN traffic_volume >= 3000 THEN 1.0 ELSE 0.0 END) * 100 AS congestion_pct, avg(speed_mph) AS avg_speed
    FROM staged GROUP BY ALL) """
_TOTALS_COLUMNS = f"sensor_id, total_volume, {r('congestion_pct', 'congestion_pct')}, {r('avg_speed', 'avg_speed')}"


def anomaly_timeline(spark, d):
    measured = windows.metrics(adapters.readings(spark, d), 60, "reading_timestamp", "event_id")
    return reports.anomaly_timeline(windows.anomalies(measured), AS_OF)


def incremental_daily(spark, d):
    """The daily summary built up to a day, then brought up to date twice."""
    table = cut_lineage(hourly(spark, d))
    seen = F.col("reading_timestamp")
    first, second = (F.lit(f"2024-01-{day} 07:00:00").cast("timestamp_ntz") for day in ("11", "21"))
    mart = marts.mart_daily_summary(table.filter(seen < first))
    for known, changed in ((table.filter(seen < second), table.filter((seen >= first) & (seen < second))), (table, table.filter(seen >= second))):
        mart = cut_lineage(marts.refresh(mart, known, changed, marts.daily_keys(), marts.mart_daily_summary))
    return rounded(mart)


def mart_hourly(spark, d):
    """The hourly table, written by day and read back."""
    path = f"{work_folder(spark)}/hourly"
    increments.write_hourly(hourly(spark, d), path)
    built = increments.read_hourly(spark, path)
    return rounded(
        built.select("surrogate_key", "sensor_id", "reading_timestamp", "traffic_volume", "traffic_level", "weather_severity", "rolling_avg_3hr")
    )


def daily_by_partition(spark, d):
    """The hourly table and the daily mart beside it, brought up to date by the days that an update replaced."""
    folder, rows, seen = work_folder(spark), staged(spark, d), F.col("reading_timestamp")
    edge = F.lit("2024-01-21 07:00:00").cast("timestamp_ntz")
    side = staged_weather(spark, d), staged_holidays(spark, d), sensor_versions(spark, d)
    increments.write_hourly(enrich.int_enriched(rows.filter(seen < edge), *side), f"{folder}/hourly")
    increments.write_daily(spark, f"{folder}/hourly", f"{folder}/daily", marts.mart_sensor_performance)
    days = increments.update_hourly(spark, f"{folder}/hourly", rows.filter(seen >= edge), *side)
    increments.write_daily(spark, f"{folder}/hourly", f"{folder}/daily", marts.mart_sensor_performance, days)
    return rounded(spark.read.parquet(f"{folder}/daily"))


QUERIES = {
    "incremental_mart_daily": incremental_daily,
    "incremental_mart_performance": daily_by_partition,
    "mart_hourly": mart_hourly,
    "mart_daily_summary": lambda s, d: rounded(marts.mart_daily_summary(hourly(s, d))),
    "mart_congestion": lambda s, d: rounded(marts.mart_congestion(hourly(s, d), min_n=2)),
    "mart_sensor_performance": lambda s, d: rounded(marts.mart_sensor_performance(hourly(s, d))),
    "late_arrivals": lambda s, d: rounded(
        late.late_arrivals(adapters.readings(s, d), _end(s, d)).select("event_id", "sensor_id", "is_late_arrival", "late_arrival_hours")
    ),
    "late_stats": lambda s, d: rounded(late.late_stats(_late(s, d), _end(s, d))),
    "late_cleanup": late_cleanup,
    "late_sample": lambda s, d: rounded(late.late_sample(_late(s, d))),
    "freshness_sensors": lambda s, d: observability.freshness(staged(s, d), AS_OF),
    "freshness_summary": lambda s, d: rounded(observability.freshness_summary(observability.freshness(staged(s, d), AS_OF))),
    "freshness_feed": lambda s, d: observability.feed_freshness(adapters.weather(s, d), _end(s, d)),
    "fresh_rows": lambda s, d: observability.fresh_rows(staged(s, d)),
    "volume_anomalies": lambda s, d: rounded(observability.volume_anomalies(staged(s, d))),
    "anomaly_summary": lambda s, d: rounded(observability.anomaly_summary(observability.volume_anomalies(staged(s, d)))),
    "sensor_health": lambda s, d: rounded(observability.sensor_health(staged(s, d), min_n=HEALTH_MIN)),
    "sensor_health_summary": lambda s, d: observability.health_summary(observability.sensor_health(staged(s, d), min_n=HEALTH_MIN)),
    "quality_gate": lambda s, d: rounded(quality.quality_gate(adapters.readings(s, d))),
    "quality_metrics": quality_metrics,
    "metrics_summary_pipeline": lambda s, d: rounded(monitoring.pipeline_summary(metric_log(s, d), _end(s, d))),
    "metrics_summary_quality": lambda s, d: rounded(monitoring.quality_summary(quality_log(s, d), _end(s, d))),
    "metrics_summary_accuracy": lambda s, d: rounded(monitoring.accuracy_summary(accuracy_log(s, d), _end(s, d))),
    "threshold_alerts": threshold_alerts,
    "observability_summary": observability_summary,
    "location_stats": lambda s, d: rounded(features.group_summary(staged(s, d), "sensor_id", ["traffic_volume", "speed_mph"])),
    "regional_summary": lambda s, d: rounded(reports.regional_summary(state_table(s, d))),
    "status_summary": lambda s, d: rounded(reports.status_summary(state_table(s, d), ["ml_accuracy", "response_time", "data_quality"])),
    "overall_summary": lambda s, d: rounded(reports.overall_summary(state_table(s, d), _TOTALS, _MEANS)),
    "kpi_overview": lambda s, d: rounded(reports.kpi_overview(adapters.readings(s, d))),
    "live_flow_60m": lambda s, d: reports.live_flow(adapters.readings(s, d)),
    "hourly_profile": lambda s, d: rounded(reports.hourly_profile(adapters.readings(s, d))),
    "speed_histogram": lambda s, d: reports.speed_histogram(adapters.readings(s, d)),
    "weather_impact": lambda s, d: rounded(reports.weather_impact(hourly(s, d))),
    "weather_correlation": lambda s, d: rounded(reports.weather_correlation(hourly(s, d))),
    "anomaly_type_counts": lambda s, d: reports.anomaly_type_counts(observability.volume_anomalies(staged(s, d))),
    "anomaly_timeline": anomaly_timeline,
    "usage_cost_daily": lambda s, d: rounded(costs.usage_cost(usage_log(s, d), _last(s, d, "lineitem", "l_shipdate"))),
    "transfer_cost": lambda s, d: rounded(costs.transfer_cost(order_log(s, d), _last(s, d, "orders", "o_orderdate"))),
    "topk_queries": lambda s, d: rounded(costs.slow_queries(order_log(s, d), _last(s, d, "orders", "o_orderdate"), hours=24 * 365)),
    "table_sizes": lambda s, d: rounded(costs.table_sizes(catalog(s, d))),
    "topk_volume": lambda s, d: rounded(reports.top_k(sensor_totals(s, d), "total_volume", "sensor_id")),
    "topk_congested": lambda s, d: rounded(reports.top_k(sensor_totals(s, d), "congestion_pct", "sensor_id")),
    "latest_per_key": lambda s, d: rounded(reports.latest_per_key(staged(s, d)).select("sensor_id", "reading_timestamp", "traffic_volume", "event_id")),
    "sorted_output": lambda s, d: rounded(
        reports.ordered(adapters.readings(s, d).select("sensor_id", "reading_timestamp", "traffic_volume"), ["sensor_id", "reading_timestamp"])
    ),
}

_V = "traffic_volume"


def _doubles(*pairs):
    return ", ".join(r(expression, name) for expression, name in pairs)


_FRESH = f""", fresh AS (SELECT *, CASE WHEN minutes_since_last_reading > 120 AND hour(TIMESTAMP '{AS_OF}') BETWEEN 6 AND 22 THEN 'stale'
    WHEN minutes_since_last_reading > 360 THEN 'critical' ELSE 'fresh' END AS freshness_status FROM (
    SELECT sensor_id, max(reading_timestamp) AS last_reading,
        date_diff('minute', max(reading_timestamp), TIMESTAMP '{AS_OF}') AS minutes_since_last_reading
    FROM staged WHERE reading_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY GROUP BY ALL)) """
_ANOMALY = """, moment AS (SELECT max(reading_timestamp) AS t FROM staged),
daily AS (SELECT sensor_id, CAST(reading_timestamp AS DATE) AS traffic_date, count(*) AS daily_readings, avg(traffic_volume) AS avg_volume,
    max(traffic_volume) AS max_volume, min(traffic_volume) AS min_volume FROM staged
    WHERE reading_timestamp >= (SELECT t FROM moment) - INTERVAL 14 DAY GROUP BY ALL),
rolled AS (SELECT *, avg(avg_volume) OVER w AS rolling_7day_avg, stddev_samp(avg_volume) OVER w AS rolling_7day_std FROM daily
    WINDOW w AS (PARTITION BY sensor_id ORDER BY traffic_date ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)),
judged AS (SELECT *, CASE WHEN rolling_7day_avg IS NULL THEN 'insufficient_data' WHEN daily_readings < rolling_7day_avg * 0.8
        THEN 'volume_drop' WHEN daily_readings > rolling_7day_avg * 1.5 THEN 'volume_spike' ELSE 'normal' END AS anomaly_type,
    CASE WHEN rolling_7day_avg > 0 THEN (daily_readings - rolling_7day_avg) / rolling_7day_avg * 100 ELSE 0 END AS volume_pct_change,
    CASE WHEN rolling_7day_std > 0 THEN abs(avg_volume - rolling_7day_avg) / rolling_7day_std ELSE 0 END AS z_score FROM rolled
    WHERE traffic_date >= (SELECT t FROM moment) - INTERVAL 7 DAY) """
_ANOMALY_COUNTS = """count(*) AS total_records, count(*) FILTER (anomaly_type IN ('volume_drop', 'volume_spike')) AS anomaly_count"""
_HEALTH = f""", health AS (SELECT *, CASE WHEN zero_volume_count > total_readings * 0.5 THEN 'malfunctioning'
        WHEN extreme_volume_count > total_readings * 0.1 THEN 'suspicious' WHEN std_volume / nullif(avg_volume, 0) > 2 THEN 'unstable'
        ELSE 'healthy' END AS health_status FROM (
    SELECT sensor_id, count(*) AS total_readings, count(*) FILTER ({_V} = 0) AS zero_volume_count,
        count(*) FILTER ({_V} > 8000) AS extreme_volume_count, avg({_V}) AS avg_volume, stddev_samp({_V}) AS std_volume,
        min(reading_timestamp) AS first_reading, max(reading_timestamp) AS last_reading FROM staged
    WHERE reading_timestamp >= (SELECT max(reading_timestamp) FROM staged) - INTERVAL 7 DAY GROUP BY ALL
    HAVING count(*) >= {HEALTH_MIN})) """
_KPI_PARTS = {
    "sensors": "count(DISTINCT sensor_id)",
    "data_points": "count(*)",
    "rate_per_second": "count(*) / 86400.0",
    "avg_volume": f"avg({_V})",
    "avg_speed": "avg(speed_mph)",
    "congestion_pct": f"avg(CASE WHEN {_V} > 1500 THEN 1.0 ELSE 0.0 END) * 100",
    "quality_pct": f"avg(CASE WHEN {_V} IS NOT NULL AND speed_mph IS NOT NULL THEN 1.0 ELSE 0.0 END) * 100",
}


def _kpi_sql():
    def period(low, high):
        names = ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in _KPI_PARTS.items())
        t = "(SELECT max(reading_timestamp) FROM readings)"
        return f"""(SELECT {names} FROM readings WHERE reading_timestamp > {t} - INTERVAL {low} HOUR
            AND reading_timestamp <= {t} - INTERVAL {high} HOUR)"""

    rows = " UNION ALL ".join(
        f"SELECT '{n}' AS metric, {r('a.' + n, 'value')}, {r(f'a.{n} - b.{n}', 'delta')} FROM a, b" for n in _KPI_PARTS
    )
    return sql(f", a AS {period(24, 0)}, b AS {period(48, 24)} {rows}")


_OVERALL = " UNION ALL ".join(
    [f"SELECT 'total_{c}' AS metric, {r(f'round(CAST(sum({c}) AS DOUBLE), 1)', 'value')}, '{u}' AS unit FROM state" for c, u in _TOTALS.items()]
    + [f"SELECT 'average_{c}' AS metric, {r(f'round(avg({c}), 1)', 'value')}, '{u}' AS unit FROM state" for c, u in _MEANS.items()]
)
_ALERT_BOUNDS = ", ".join(f"('{n}', {b}::DOUBLE)" for n, b in THRESHOLDS)

ORACLES = {
    "mart_hourly": sql(f"""SELECT surrogate_key, sensor_id, reading_timestamp, traffic_volume, traffic_level,
        {columns_sql(['weather_severity', 'rolling_avg_3hr'])} FROM hourly"""),
    "mart_daily_summary": sql(f"""SELECT sensor_id, CAST(reading_timestamp AS DATE) AS traffic_date, is_holiday, holiday_name,
        count(*) AS total_readings, {_doubles((f'avg({_V})', 'avg_volume'))}, max({_V}) AS peak_volume, min({_V}) AS min_volume,
        {_doubles((f'avg({_V}) FILTER (is_rush_hour)', 'avg_rush_hour_volume'), (f'avg({_V}) FILTER (NOT is_rush_hour)', 'avg_off_peak_volume'),
                  ('avg(weather_severity)', 'avg_weather_severity'))},
        count(*) FILTER (traffic_level = 'congested') AS congested_hours FROM hourly GROUP BY ALL"""),
    "mart_congestion": sql(f"""SELECT sensor_id, hour_of_day, day_of_week, is_weekend, weather_main, temp_bucket, count(*) AS sample_size,
        {_doubles((f'avg({_V})', 'avg_volume'), (f'stddev_samp({_V})', 'std_volume'), (f'quantile_cont({_V}, 0.9)', 'p90_volume'),
                  (f'quantile_cont({_V}, 0.95)', 'p95_volume'), (f'avg({_V}) FILTER (is_precipitation)', 'avg_volume_precipitation'),
                  (f'avg({_V}) FILTER (NOT is_precipitation)', 'avg_volume_clear'))}
        FROM hourly GROUP BY sensor_id, hour_of_day, day_of_week, is_weekend, weather_main, temp_bucket HAVING count(*) >= 2"""),
    "mart_sensor_performance": sql(f"""SELECT sensor_id, CAST(reading_timestamp AS DATE) AS traffic_date, count(*) AS total_readings,
        max({_V}) AS max_volume, count(*) FILTER (traffic_level = 'congested') AS congestion_events,
        count(*) FILTER (is_rush_hour) AS rush_hour_events, count(*) FILTER (is_precipitation) AS precipitation_events,
        count(*) FILTER ({_V} > 0) AS valid_readings, count(*) FILTER ({_V} = 0) AS zero_volume_events,
        {_doubles((f'avg({_V})', 'avg_volume'), ('avg(speed_mph)', 'avg_speed'), ('max(speed_mph)', 'max_speed'), ('min(speed_mph)', 'min_speed'),
                  ('avg(occupancy_pct)', 'avg_occupancy'), ('max(occupancy_pct)', 'max_occupancy'),
                  ('avg(weather_severity)', 'avg_weather_severity'), ('max(weather_severity)', 'max_weather_severity'),
                  (f'avg({_V}) FILTER (is_weekend)', 'avg_weekend_volume'), (f'avg({_V}) FILTER (NOT is_weekend)', 'avg_weekday_volume'))}
        FROM hourly GROUP BY ALL"""),
    "late_arrivals": sql(_LATE_SQL + f" SELECT event_id, sensor_id, is_late_arrival, {r('late_arrival_hours', 'late_arrival_hours')} FROM late"),
    "late_stats": sql(_LATE_SQL + f""", banded AS (SELECT *, CASE WHEN late_arrival_hours <= 48 THEN 'up to 2 days'
            WHEN late_arrival_hours <= 168 THEN 'up to 7 days' WHEN late_arrival_hours <= 720 THEN 'up to 30 days' ELSE 'later' END AS lateness
        FROM late WHERE updated_at >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY)
        SELECT coalesce(lateness, 'all') AS lateness, count(*) AS readings, count(DISTINCT sensor_id) AS sensors,
        {_doubles(('avg(late_arrival_hours)', 'mean_hours'), ('max(late_arrival_hours)', 'longest_hours'))}
        FROM banded GROUP BY ROLLUP (lateness) HAVING count(*) > 0"""),
    "late_cleanup": sql(_LATE_SQL + f""" SELECT sensor_id, reading_timestamp, updated_at, {r('late_arrival_hours', 'late_arrival_hours')},
        event_id FROM late WHERE NOT (updated_at < (SELECT max(ts) FROM events) - INTERVAL 14 DAY)"""),
    "late_sample": sql(_LATE_SQL + f""" SELECT sensor_id, reading_timestamp, traffic_volume, {r('late_arrival_hours', 'late_arrival_hours')}
        FROM late ORDER BY reading_timestamp, event_id LIMIT 5"""),
    "freshness_sensors": sql(_FRESH + "SELECT * FROM fresh"),
    "freshness_summary": sql(_FRESH + f"""SELECT count(*) AS total_sensors, count(*) FILTER (freshness_status = 'fresh') AS fresh_sensors,
        count(*) FILTER (freshness_status = 'stale') AS stale_sensors, count(*) FILTER (freshness_status = 'critical') AS critical_sensors,
        {r("count(*) FILTER (freshness_status = 'fresh') * 100.0 / count(*)", 'freshness_score')} FROM fresh"""),
    "freshness_feed": sql("""SELECT last_update, minutes_since_last_update, CASE WHEN minutes_since_last_update > 30 THEN 'stale'
        ELSE 'fresh' END AS freshness_status FROM (SELECT max(weather_timestamp) AS last_update, date_diff('minute',
        max(weather_timestamp), (SELECT max(ts) FROM events)) AS minutes_since_last_update FROM weather)"""),
    "fresh_rows": sql("""SELECT count(*) AS fresh_records, count(*) > 0 AS passed FROM staged
        WHERE reading_timestamp >= (SELECT max(reading_timestamp) FROM staged) - INTERVAL 1 HOUR"""),
    "volume_anomalies": sql(_ANOMALY + f"""SELECT sensor_id, traffic_date, daily_readings, max_volume, min_volume, anomaly_type,
        {_doubles(*[(c, c) for c in ('avg_volume', 'rolling_7day_avg', 'rolling_7day_std', 'volume_pct_change', 'z_score')])},
        CASE WHEN anomaly_type IN ('volume_drop', 'volume_spike') THEN CASE WHEN abs(z_score) > 3 THEN 'high' ELSE 'medium' END END
        AS severity FROM judged"""),
    "anomaly_summary": sql(_ANOMALY + f"""SELECT total_records, anomaly_count, total_records - anomaly_count AS normal_records,
        {r('anomaly_count * 100.0 / total_records', 'anomaly_rate')} FROM (SELECT {_ANOMALY_COUNTS} FROM judged)"""),
    "sensor_health": sql(_HEALTH + f"""SELECT sensor_id, total_readings, zero_volume_count, extreme_volume_count, first_reading,
        last_reading, health_status, {_doubles(('avg_volume', 'avg_volume'), ('std_volume', 'std_volume'))} FROM health"""),
    "sensor_health_summary": sql(_HEALTH + "SELECT count(*) AS total_sensors, " + ", ".join(
        f"count(*) FILTER (health_status = '{s}') AS {s}_sensors" for s in ("healthy", "malfunctioning", "suspicious", "unstable")
    ) + " FROM health"),
    "quality_gate": sql(f"""SELECT *, issues = '' AS passed FROM (SELECT total_records, null_volumes, negative_volumes, future_timestamps,
        {_doubles(('avg_volume', 'avg_volume'), ('std_volume', 'std_volume'))},
        concat_ws('; ', CASE WHEN null_volumes > 0 THEN 'Null volumes: ' || null_volumes END,
            CASE WHEN negative_volumes > 0 THEN 'Negative volumes: ' || negative_volumes END,
            CASE WHEN future_timestamps > 0 THEN 'Future timestamps: ' || future_timestamps END,
            CASE WHEN total_records < 1000 THEN 'Low record count: ' || total_records END) AS issues FROM (
        SELECT count(*) AS total_records, count(*) FILTER ({_V} IS NULL) AS null_volumes, count(*) FILTER ({_V} < 0) AS negative_volumes,
            count(*) FILTER (reading_timestamp > (SELECT max(reading_timestamp) FROM readings)) AS future_timestamps,
            avg({_V}) AS avg_volume, stddev_samp({_V}) AS std_volume FROM readings
        WHERE reading_timestamp >= (SELECT max(reading_timestamp) FROM readings) - INTERVAL 24 HOUR))"""),
    "quality_metrics": sql(f"""SELECT road_name, CAST(sum(n) AS BIGINT) AS total_records, CAST(sum(missing) AS BIGINT) AS missing_values,
        CAST(sum(n - 1) AS BIGINT) AS duplicate_records, CAST(sum(outliers) AS BIGINT) AS outliers FROM (
        SELECT road_name, sensor_id, date_trunc('hour', reading_timestamp) AS h, count(*) AS n,
            count(*) FILTER ({_V} IS NULL) + count(*) FILTER (speed_mph IS NULL) AS missing,
            count(*) FILTER ({_V} NOT BETWEEN 100 AND 4000) AS outliers FROM readings GROUP BY ALL) GROUP BY ALL"""),
    "metrics_summary_pipeline": _LOGS_SQL + f"SELECT metric_name, model_name, {r('avg_value', 'avg_value')}, count FROM metric",
    "metrics_summary_quality": _LOGS_SQL + "SELECT data_source, " + _doubles(
        *[(c, c) for c in ("avg_records", "avg_missing", "avg_duplicates", "avg_outliers")]) + " FROM quality",
    "metrics_summary_accuracy": f"""SELECT 'model_' || CAST(event_id % 3 AS VARCHAR) AS model_name,
        'sensor_' || CAST(user_id AS VARCHAR) AS location_id, {r('avg(abs(value - 50))', 'mae')}, count(*) AS prediction_count
        FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 24 HOUR GROUP BY ALL""",
    "threshold_alerts": _LOGS_SQL + f"""SELECT 'threshold_violation' AS type, m.metric_name, model_name AS subject, {r('avg_value', 'value')},
        {r('threshold', 'threshold')}, CASE WHEN avg_value > threshold * 1.5 THEN 'high' ELSE 'medium' END AS severity
        FROM metric m JOIN (VALUES {_ALERT_BOUNDS}) t(metric_name, threshold) ON m.metric_name = t.metric_name
        WHERE avg_value > threshold
        UNION ALL SELECT 'data_quality', 'missing_data_ratio', data_source, {r('avg_missing / avg_records', 'value')}, 0.1::DOUBLE,
        CASE WHEN avg_missing / avg_records > 0.2 THEN 'high' ELSE 'medium' END FROM quality WHERE avg_missing / avg_records > 0.1""",
    "observability_summary": sql(_FRESH + _ANOMALY + graphs.DRIFT_SQL + """, found AS (
        SELECT 'freshness_monitoring' AS "check", count(*) FILTER (freshness_status = 'critical') AS issues, 'Critical sensors' AS label FROM fresh
        UNION ALL SELECT 'anomaly_detection', count(*) FILTER (anomaly_type IN ('volume_drop', 'volume_spike')), 'Volume anomalies' FROM judged
        UNION ALL SELECT 'schema_drift_check', count(*), 'Schema changes' FROM drift)
        SELECT "check", issues, CASE WHEN issues > 0 THEN label || ': ' || issues END AS message FROM found"""),
    "location_stats": sql(STATS_SQL),
    "regional_summary": _STATE_SQL + f"""SELECT region, CAST(sum(hourly_volume) AS BIGINT) AS hourly_volume,
        CAST(sum(total_sensors) AS BIGINT) AS total_sensors, {r('round(avg(congestion_percent), 1)', 'congestion_percent')},
        {r('round(sum(revenue_impact), 1)', 'revenue_impact')} FROM state GROUP BY ALL""",
    "status_summary": _STATE_SQL + "SELECT status, count(*) AS number_of_rows, " + _doubles(
        *[(f"round(avg({c}), 1)", f"avg_{c}") for c in ("ml_accuracy", "response_time", "data_quality")]) + " FROM state GROUP BY ALL",
    "overall_summary": _STATE_SQL + _OVERALL,
    "kpi_overview": _kpi_sql(),
    "live_flow_60m": sql(f"""SELECT date_trunc('minute', reading_timestamp) AS minute, CAST(sum({_V}) AS BIGINT) AS volume,
        count(*) AS readings FROM readings WHERE reading_timestamp > (SELECT max(reading_timestamp) FROM readings) - INTERVAL 60 MINUTE
        GROUP BY ALL"""),
    "hourly_profile": sql(f"""SELECT CAST(hour(reading_timestamp) AS INTEGER) AS hour_of_day, CAST(sum({_V}) AS BIGINT) AS total_volume,
        {r(f'avg({_V})', 'avg_volume')} FROM readings GROUP BY hour(reading_timestamp)"""),
    "speed_histogram": sql("""SELECT CASE WHEN speed_mph < 20 THEN '0-20 mph' WHEN speed_mph < 40 THEN '20-40 mph'
        WHEN speed_mph < 60 THEN '40-60 mph' ELSE '60+ mph' END AS speed_range, count(*) AS readings FROM readings
        WHERE speed_mph IS NOT NULL GROUP BY ALL"""),
    "weather_impact": sql(f"""SELECT weather_main, {_doubles((f'avg({_V})', 'avg_volume'), ('avg(speed_mph)', 'avg_speed'))},
        count(*) AS readings FROM hourly GROUP BY ALL"""),
    "weather_correlation": sql("SELECT " + _doubles((f"corr({_V}, weather_severity)", "volume_severity"),
        (f"corr({_V}, temp_fahrenheit)", "volume_temperature"), ("corr(speed_mph, weather_severity)", "speed_severity")) + " FROM hourly"),
    "anomaly_type_counts": sql(_ANOMALY + "SELECT anomaly_type, count(*) AS anomalies FROM judged GROUP BY ALL"),
    "usage_cost_daily": f"""SELECT 'TRAFFIC_' || CAST(l_suppkey AS VARCHAR) AS warehouse_name, CAST(l_shipdate AS DATE) AS usage_date,
        count(*) AS query_count, {_doubles(('sum(l_quantity)', 'total_credits'), ('sum(l_quantity) * 3.0', 'estimated_cost_usd'),
            ('avg(l_extendedprice) / 1000', 'avg_query_seconds'), ('max(l_extendedprice) / 1000', 'max_query_seconds'),
            ('avg(l_tax * 1000) / 1000', 'avg_queue_time'))}
        FROM lineitem WHERE l_shipdate >= (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 30 DAY GROUP BY ALL""",
    "transfer_cost": f"""SELECT o_orderkey AS transfer_id, o_orderdate AS start_time, o_orderpriority AS region,
        o_orderstatus AS transfer_type, {_doubles(('o_totalprice * 1e5 / 1073741824', 'gb_transferred'),
            ('CAST(o_custkey % 10 AS DOUBLE)', 'credits_used'), ('(o_custkey % 10) * 3.0', 'estimated_cost_usd'))}
        FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 7 DAY""",
    "topk_queries": f"""SELECT o_orderkey AS query_id, 'TRAFFIC_' || o_orderpriority AS warehouse_name, o_orderdate AS start_time,
        {_doubles(('o_totalprice / 1000', 'duration_seconds'), ('o_totalprice * 1e6 / 1073741824', 'gb_scanned'))}
        FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 8760 HOUR
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",
    "table_sizes": f"""SELECT p_brand AS table_schema, p_name || '#' || CAST(p_partkey AS VARCHAR) AS table_name, p_size AS row_count,
        {_doubles(('p_retailprice * 1e7 / 1073741824', 'table_size_gb'), ('p_retailprice * 1e7', 'bytes'))} FROM part""",
    "topk_volume": sql(_TOTALS_SQL + f"SELECT {_TOTALS_COLUMNS} FROM totals ORDER BY totals.total_volume DESC, sensor_id LIMIT 10"),
    "topk_congested": sql(_TOTALS_SQL + f"SELECT {_TOTALS_COLUMNS} FROM totals ORDER BY totals.congestion_pct DESC, sensor_id LIMIT 10"),
    "latest_per_key": sql(f"""SELECT sensor_id, reading_timestamp, {_V}, event_id FROM (SELECT *, row_number() OVER (
        PARTITION BY sensor_id ORDER BY reading_timestamp DESC, event_id DESC) AS n FROM staged) WHERE n = 1"""),
    "sorted_output": sql(f"SELECT sensor_id, reading_timestamp, {_V} FROM readings ORDER BY ALL"),
}

ORACLES["incremental_mart_daily"] = ORACLES["mart_daily_summary"]
ORACLES["incremental_mart_performance"] = ORACLES["mart_sensor_performance"]
