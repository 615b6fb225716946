"""Registered queries: window functions and batch twins of the stream operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.operators import features, windows as measures
from roadpulse.plans.base import r, rounded, sensor_versions, sql, staged
from roadpulse.sources import adapters
from roadpulse.streaming import windows

ID = ["sensor_id", "reading_timestamp", "event_id"]
STEP = 60
DAY, WEEK = 1440, 10080


def _slim(spark, d, *more):
    return staged(spark, d).select(*ID, "traffic_volume", *more)


def _raw(spark, d):
    return adapters.readings(spark, d)


def sequences(spark, d):
    found = measures.sequences(_slim(spark, d), ["traffic_volume"], "traffic_volume")
    numbers = F.transform("sequence", lambda step: step[0].cast("int").cast("string"))
    return found.select(*ID, F.array_join(numbers, ",").alias("sequence"), "next_value")


QUERIES = {
    "scd2_versions": lambda s, d: sensor_versions(s, d),
    "rolling_rows": lambda s, d: rounded(measures.rolling_averages(_slim(s, d), "traffic_volume")),
    "pct_change": lambda s, d: rounded(measures.percent_changes(_slim(s, d), "traffic_volume")),
    "lag_features": lambda s, d: rounded(measures.lags(_slim(s, d, "speed_mph"), ["traffic_volume", "speed_mph"], [1, 5, 15])),
    "rolling_range": lambda s, d: rounded(measures.rolling_range(_slim(s, d), "traffic_volume", DAY)),
    "rolling_features": lambda s, d: rounded(measures.rolling_features(_slim(s, d), ["traffic_volume"], features.ROLLING_WINDOWS)),
    "zscore_anomaly": lambda s, d: rounded(measures.zscore_anomaly(_slim(s, d), threshold=2.5, minutes=WEEK)),
    "sequence_windows": sequences,
    "label_encode": lambda s, d: features.label_encode(_slim(s, d), "sensor_id"),
    "stream_tumbling": lambda s, d: rounded(windows.tumbling(_raw(s, d), f"{STEP} minutes", "reading_timestamp", "event_id")),
    "stream_sliding": lambda s, d: rounded(
        windows.sliding(_raw(s, d), f"{3 * STEP} minutes", f"{STEP} minutes", "reading_timestamp", "event_id")
    ),
    "stream_trend": lambda s, d: rounded(windows.trend(_raw(s, d), STEP, "reading_timestamp", "event_id")),
    "stream_metrics": lambda s, d: rounded(windows.metrics(_raw(s, d), STEP, "reading_timestamp", "event_id")),
    "stream_anomaly": lambda s, d: rounded(windows.anomalies(windows.metrics(_raw(s, d), STEP, "reading_timestamp", "event_id"))),
}

_ID = ", ".join(ID)
_W = "PARTITION BY sensor_id ORDER BY reading_timestamp, event_id"
_V = "traffic_volume"


def _range(minutes: int) -> str:
    frame = f"PARTITION BY sensor_id ORDER BY reading_timestamp RANGE BETWEEN INTERVAL {minutes} MINUTE PRECEDING AND CURRENT ROW"
    return f"""(SELECT {_ID}, {_V}, stddev_samp({_V}) OVER ({frame}) AS traffic_volume_rolling_std,
        avg({_V}) OVER ({frame}) AS traffic_volume_rolling_avg FROM staged)"""


_RANGE_COLUMNS = f"{_ID}, {_V}, {r('traffic_volume_rolling_std', 'traffic_volume_rolling_std')}, {r('traffic_volume_rolling_avg', 'traffic_volume_rolling_avg')}"
_FIRSTS = ["road_name", "direction", "latitude", "longitude"]


def _first(column: str) -> str:
    value = f"arg_min({column}, (reading_timestamp, event_id))"
    return r(value, column) if column in ("latitude", "longitude") else f"{value} AS {column}"


TUMBLING_SQL = f"""SELECT sensor_id, time_bucket(INTERVAL 1 HOUR, reading_timestamp) AS window_start,
    time_bucket(INTERVAL 1 HOUR, reading_timestamp) + INTERVAL 1 HOUR AS window_end, avg({_V}) AS avg_volume, max({_V}) AS max_volume,
    count(*) AS reading_count, avg(speed_mph) AS avg_speed, {', '.join(_first(c) for c in _FIRSTS)} FROM readings GROUP BY ALL"""
TREND_SQL = f""", win AS ({TUMBLING_SQL}),
trend AS (SELECT c.*, p.avg_volume AS previous_avg_volume, c.avg_volume - p.avg_volume AS volume_trend,
    CASE WHEN c.avg_volume > p.avg_volume THEN 'increasing' WHEN c.avg_volume < p.avg_volume THEN 'decreasing' ELSE 'stable' END
        AS trend_indicator,
    CASE WHEN c.avg_volume > 5000 THEN 'severe_congestion' WHEN c.avg_volume > 3000 THEN 'heavy_traffic'
         WHEN c.avg_volume > 1500 THEN 'moderate_traffic' ELSE 'normal' END AS congestion_level,
    hour(c.window_start) BETWEEN 7 AND 9 OR hour(c.window_start) BETWEEN 17 AND 19 AS is_peak_hour,
    dayofweek(c.window_start) IN (0, 6) AS is_weekend
    FROM win c JOIN win p ON p.sensor_id = c.sensor_id AND p.window_start = c.window_start - INTERVAL 1 HOUR)"""
_TREND_COLUMNS = f"""sensor_id, window_start, window_end, max_volume, reading_count, {', '.join(_FIRSTS)}, trend_indicator,
    {', '.join(r(c, c) for c in ('avg_volume', 'previous_avg_volume', 'avg_speed', 'volume_trend'))}"""
_FLAGS = "congestion_level, is_peak_hour, is_weekend"
KIND_SQL = """CASE WHEN avg_volume > previous_avg_volume * 1.5 THEN 'volume_spike' WHEN avg_volume < previous_avg_volume * 0.5 THEN
    'volume_drop' WHEN avg_speed < 15 THEN 'speed_issue' WHEN congestion_level IN ('severe_congestion', 'heavy_traffic')
    THEN 'congestion' END"""
_ROLLING = ", ".join(
    r(f"{fn}({_V}) OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)", f"{_V}_rolling_{name}_{n}")
    if fn != "max"
    else f"{fn}({_V}) OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS {_V}_rolling_{name}_{n}"
    for n in features.ROLLING_WINDOWS
    for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("max", "max"))
)

ORACLES = {
    "scd2_versions": sql("SELECT * FROM versions"),
    "rolling_rows": sql(f"""SELECT {_ID}, {_V}, """ + ", ".join(
        r(f"avg({_V}) OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)", f"rolling_avg_{n}") for n in (3, 24)) + " FROM staged"),
    "pct_change": sql(f"""SELECT {_ID}, {_V}, {r(f'CAST({_V} - lag({_V}) OVER w AS DOUBLE) / nullif(lag({_V}) OVER w, 0) * 100',
        'traffic_volume_pct_change')} FROM staged WINDOW w AS ({_W})"""),
    "lag_features": sql(f"SELECT {_ID}, {_V}, {r('speed_mph', 'speed_mph')}, " + ", ".join(
        [f"lag({_V}, {n}) OVER w AS {_V}_lag_{n}" for n in (1, 5, 15)]
        + [r(f"lag(speed_mph, {n}) OVER w", f"speed_mph_lag_{n}") for n in (1, 5, 15)]) + f" FROM staged WINDOW w AS ({_W})"),
    "rolling_range": sql(f"SELECT {_RANGE_COLUMNS} FROM {_range(DAY)}"),
    "rolling_features": sql(f"SELECT {_ID}, {_V}, {_ROLLING} FROM staged"),
    "zscore_anomaly": sql(f"""SELECT {_RANGE_COLUMNS}, {r('z', 'z_score')} FROM (SELECT *,
        abs({_V} - traffic_volume_rolling_avg) / nullif(traffic_volume_rolling_std, 0) AS z FROM {_range(WEEK)}) WHERE z > 2.5"""),
    "sequence_windows": sql(f"""SELECT {_ID}, array_to_string(s, ',') AS sequence, CAST({_V} AS INTEGER) AS next_value FROM (
        SELECT *, list({_V}) OVER ({_W} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS s FROM staged) WHERE len(s) = 24"""),
    "label_encode": sql(f"""SELECT {_ID}, {_V}, CAST(dense_rank() OVER (ORDER BY sensor_id) - 1 AS BIGINT) AS sensor_id_encoded FROM staged"""),
    "stream_tumbling": sql(f"""SELECT * REPLACE ({r('avg_volume', 'avg_volume')}, {r('avg_speed', 'avg_speed')}) FROM ({TUMBLING_SQL})"""),
    "stream_sliding": sql(f"""SELECT sensor_id, window_start, window_start + INTERVAL 3 HOUR AS window_end,
        {r(f'avg({_V})', 'avg_volume')}, {r('avg(speed_mph)', 'avg_speed')}, count(*) AS reading_count,
        {', '.join(_first(c) for c in _FIRSTS[:2])}
        FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, reading_timestamp) - to_hours(unnest([0, 1, 2])) AS window_start FROM readings)
        GROUP BY ALL"""),
    "stream_trend": sql(TREND_SQL + f" SELECT {_TREND_COLUMNS} FROM trend"),
    "stream_metrics": sql(TREND_SQL + f" SELECT {_TREND_COLUMNS}, {_FLAGS} FROM trend"),
    "stream_anomaly": sql(TREND_SQL + f""" SELECT {_TREND_COLUMNS}, {_FLAGS}, anomaly_type
        FROM (SELECT *, {KIND_SQL} AS anomaly_type FROM trend) WHERE anomaly_type IS NOT NULL"""),
    "sink_alerts": sql(TREND_SQL + f""" SELECT sensor_id AS key, sensor_id, anomaly_type, trend_indicator, reading_count, max_volume
        FROM (SELECT *, {KIND_SQL} AS anomaly_type FROM trend) WHERE anomaly_type IS NOT NULL"""),
    "anomaly_timeline": sql(TREND_SQL + f""" SELECT date_trunc('hour', window_start) AS hour, count(*) AS anomalies
        FROM (SELECT *, {KIND_SQL} AS anomaly_type FROM trend)
        WHERE anomaly_type IS NOT NULL AND window_start > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 168 HOUR GROUP BY ALL"""),
}
