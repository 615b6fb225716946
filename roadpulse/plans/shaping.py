"""Registered queries: projections, filters, scalar functions, joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.functions import columns as C
from roadpulse.operators import access, cleaning, enrich, features, staging
from roadpulse.plans.base import (
    HOURLY_COLUMNS, LEVEL_SQL, columns_sql, hourly, r, rounded, sensor_versions, sql, staged, staged_holidays, staged_weather,
)
from roadpulse.sources import adapters
from roadpulse.streaming import windows

STAGED = HOURLY_COLUMNS[1:16] + ["event_id"]
WEATHER = [
    "weather_timestamp", "temp_fahrenheit", "humidity_pct", "wind_speed_mph", "weather_main", "visibility_miles",
    "rain_1h_mm", "snow_1h_mm", "is_precipitation", "temp_bucket", "visibility_category", "weather_severity", "event_id",
]
ID = ["sensor_id", "reading_timestamp", "event_id"]


def _gappy(spark, d):
    """Readings with gaps: no volume on busy roads, no speed from one direction's sensors at night."""
    raw = adapters.readings(spark, d)
    night = F.hour("reading_timestamp") < 6
    return raw.withColumns(
        {
            "traffic_volume": F.when(F.col("road_name") != "error", F.col("traffic_volume")).cast("double"),
            "speed_mph": F.when(~((F.col("direction") == "West") & night), F.col("speed_mph")),
        }
    )


_GAPPY_SQL = """, gappy AS (SELECT * REPLACE (
    CASE WHEN road_name <> 'error' THEN CAST(traffic_volume AS DOUBLE) END AS traffic_volume,
    CASE WHEN NOT (direction = 'West' AND hour(reading_timestamp) < 6) THEN speed_mph END AS speed_mph) FROM readings)"""


def _repeats(df):
    """The hour as time, which makes repeats per sensor."""
    return df.withColumn("reading_timestamp", F.date_trunc("hour", "reading_timestamp").cast("timestamp_ntz"))


def row_filter(spark, d):
    """Rows each role sees, counted per role and region."""
    dims = adapters.sensor_dimension(spark, d).select("c_custkey", F.col("r_name").alias("region"))
    roles = ["TRAFFIC_ADMIN", "TRAFFIC_ANALYST", "UNKNOWN_ROLE"]
    seen = [access.apply_row_policy(dims, role, analyst_region="AMERICA").withColumn("role", F.lit(role)) for role in roles]
    return seen[0].unionByName(seen[1]).unionByName(seen[2])


def masks(spark, d):
    seen = access.apply_masks(adapters.readings(spark, d), access.MASKED_ROLE)
    return rounded(seen.select("sensor_id", "latitude", "longitude", "traffic_volume", "event_id"))


def scd_point(spark, d):
    """Readings shifted into the period of the sensor history."""
    facts = adapters.readings(spark, d).select(
        "sensor_id", (F.col("reading_timestamp") - F.expr("interval 9500 days")).alias("reading_timestamp"), "traffic_volume", "event_id"
    )
    return enrich.with_sensor_at(facts, sensor_versions(spark, d), columns=("city", "road_name"))


def hourly_windows(spark, d):
    return windows.tumbling(adapters.readings(spark, d), "60 minutes", "reading_timestamp", "event_id")


def previous(spark, d):
    return rounded(
        enrich.with_previous(hourly_windows(spark, d), "1 hour").select(
            "sensor_id", "window_start", "avg_volume", "previous_avg_volume"
        )
    )


def group_stats(spark, d):
    df = staged(spark, d)
    stats = features.group_summary(df, "sensor_id", ["traffic_volume", "speed_mph"])
    return rounded(enrich.with_group_stats(df.select(*ID, "traffic_volume"), stats, "sensor_id"))


def current_sensor(spark, d):
    return enrich.with_sensor(adapters.readings(spark, d).select(*ID), sensor_versions(spark, d))


def fn_datetime(spark, d):
    ts = F.col("o_orderdate") + F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    df = adapters.table(spark, d, "orders").select("o_orderkey", ts.alias("t"), "o_orderdate")
    return df.select(
        "o_orderkey", F.hour("t").alias("hour"), C.dow0_sun("t").alias("dow0_sun"), C.dow1_sun("t").alias("dow1_sun"),
        C.dow0_mon("t").alias("dow0_mon"), F.month("t").alias("month"), F.year("t").alias("year"), F.quarter("t").alias("quarter"),
        F.to_date("t").alias("day"), F.date_trunc("month", "t").cast("timestamp_ntz").alias("month_start"),
        C.minutes_between("o_orderdate", "t").alias("minutes"), C.before(F.col("t"), 7, "days").alias("week_before"),
        F.try_to_timestamp(F.date_format("t", "yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz").alias("parsed"),
    )


def fn_math(spark, d):
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    return rounded(
        adapters.table(spark, d, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", F.abs(q - 25).alias("distance"), F.least(q, F.lit(10.0)).alias("low"),
            F.greatest(q, F.lit(10.0)).alias("high"), F.round(p / 7, 2).alias("r2"), F.sin(q).alias("sin_q"), F.cos(q).alias("cos_q"),
            F.sqrt(p).alias("root"), q.cast("int").alias("whole"), F.try_divide(p, q - 25).alias("ratio"),
        )
    )


def fn_string(spark, d):
    name = F.col("c_name")
    return adapters.table(spark, d, "customer").select(
        "c_custkey", C.surrogate_key("c_custkey", "c_name").alias("key"), F.concat(F.left(name, F.lit(3)), F.lit("***")).alias("masked"),
        name.like("Customer#0000000%").alias("is_first"), F.upper(F.trim("c_mktsegment")).alias("segment"),
        F.startswith(name, F.lit("Customer")).alias("prefixed"), F.regexp_replace(name, "#0+", "-").alias("short"),
        F.concat_ws("|", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("joined"),
    )


def fn_conditional(spark, d):
    s = F.col("speed_mph")
    return rounded(
        adapters.readings(spark, d).select(
            "event_id", F.coalesce(s, F.lit(-1.0)).alias("speed"), F.nullif(s, F.lit(5.0)).alias("not_five"),
            s.between(20, 40).alias("mid"), F.col("road_name").isin("click", "view").alias("seen"),
            F.when(s < 20, "slow").when(s < 50, "normal").otherwise("fast").alias("pace"),
        )
    )


def fn_json(spark, d):
    parsed = F.from_json("props", "map<string,int>")
    pair = F.array(F.try_element_at(parsed, F.lit("k")), F.col("user_id").cast("int"))
    return adapters.table(spark, d, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), F.explode(parsed).alias("name", "number"),
        F.element_at(pair, 2).alias("second"), F.array_contains(pair, 8).alias("has_eight"),
        F.to_json(F.struct(F.col("event_type").alias("t"))).alias("text"),
    )


QUERIES = {
    "stg_readings": lambda s, d: rounded(staged(s, d)),
    "stg_weather": lambda s, d: rounded(staged_weather(s, d)),
    "stg_holidays": lambda s, d: staged_holidays(s, d).join(
        adapters.readings(s, d).groupBy(F.to_date("reading_timestamp").alias("holiday_date")).agg(F.count(F.lit(1)).alias("readings")),
        "holiday_date",
        "left",
    ),
    "traffic_level": lambda s, d: adapters.readings(s, d).select("event_id", C.traffic_level("traffic_volume").alias("traffic_level")),
    "surrogate_key": lambda s, d: adapters.readings(s, d).select(
        "event_id", C.surrogate_key("sensor_id", "reading_timestamp").alias("surrogate_key")
    ),
    "congestion_level": lambda s, d: rounded(
        hourly_windows(s, d).select("sensor_id", "window_start", C.congestion_level("avg_volume").alias("congestion_level"))
    ),
    "trend_indicator": lambda s, d: previous(s, d).select(
        "sensor_id", "window_start", C.trend_indicator(F.col("avg_volume") - F.col("previous_avg_volume")).alias("trend_indicator")
    ),
    "time_features_stream": lambda s, d: features.time_features_stream(adapters.readings(s, d).select(*ID)),
    "time_features_ml": lambda s, d: rounded(features.time_features_ml(adapters.readings(s, d).select(*ID))),
    "interaction_features": lambda s, d: rounded(
        features.interaction_features(features.time_features_ml(adapters.readings(s, d))).select(
            "event_id", "traffic_density", "rush_hour_speed_factor", "evening_rush_speed_factor"
        )
    ),
    "iqr_outliers": lambda s, d: rounded(
        cleaning.iqr_filter(adapters.readings(s, d), ["traffic_volume", "speed_mph"]).select("event_id", "traffic_volume", "speed_mph")
    ),
    "dedup_readings": lambda s, d: cleaning.dedup(
        _repeats(adapters.readings(s, d).select(*ID, "traffic_volume")), ["sensor_id", "reading_timestamp"], ["event_id"]
    ),
    "fill_missing": lambda s, d: rounded(
        cleaning.fill_missing(
            _gappy(s, d).select(*ID, "traffic_volume", "speed_mph"), ["traffic_volume", "speed_mph"], "sensor_id", "reading_timestamp", "event_id"
        )
    ),
    "drop_incomplete": lambda s, d: rounded(cleaning.drop_incomplete(_gappy(s, d)).select(*ID, "traffic_volume", "speed_mph")),
    "mask_columns": masks,
    "row_filter": row_filter,
    "join_nearest_weather": lambda s, d: rounded(
        enrich.nearest_join(enrich.one_per_instant(staged(s, d).select(*ID)), staged_weather(s, d))
    ),
    "join_holidays": lambda s, d: enrich.with_holidays(adapters.readings(s, d).select(*ID), staged_holidays(s, d)),
    "join_current_sensor": current_sensor,
    "join_scd2_point_in_time": scd_point,
    "join_prev_window": previous,
    "join_group_stats": group_stats,
    "int_enriched": lambda s, d: rounded(hourly(s, d).select(*HOURLY_COLUMNS)),
    "fn_datetime": fn_datetime,
    "fn_math": fn_math,
    "fn_string": fn_string,
    "fn_conditional": fn_conditional,
    "fn_json": fn_json,
}

_WINDOWED = """, win AS (SELECT sensor_id, time_bucket(INTERVAL 1 HOUR, reading_timestamp) AS window_start,
    avg(traffic_volume) AS avg_volume FROM readings GROUP BY ALL),
paired AS (SELECT c.sensor_id, c.window_start, c.avg_volume, p.avg_volume AS previous_avg_volume
    FROM win c JOIN win p ON c.sensor_id = p.sensor_id AND c.window_start = p.window_start + INTERVAL 1 HOUR)"""
_ID = ", ".join(ID)
_STREAM_TIME = """CAST(hour(reading_timestamp) AS INTEGER) AS hour_of_day,
    CAST(dayofweek(reading_timestamp) + 1 AS INTEGER) AS day_of_week, CAST(day(reading_timestamp) AS INTEGER) AS day_of_month,
    CAST(month(reading_timestamp) AS INTEGER) AS month, CAST(year(reading_timestamp) AS INTEGER) AS year,
    dayofweek(reading_timestamp) IN (0, 6) AS is_weekend,
    hour(reading_timestamp) BETWEEN 7 AND 9 OR hour(reading_timestamp) BETWEEN 17 AND 19 AS is_rush_hour"""
_CYCLES = ", ".join(
    r(f"{fn}(2 * pi() * ({value}) / {length})", f"{name}_{fn}")
    for name, value, length in [
        ("hour", "hour(reading_timestamp)", 24), ("day", "isodow(reading_timestamp) - 1", 7), ("month", "month(reading_timestamp)", 12),
    ]
    for fn in ("sin", "cos")
)
_ML_RUSH = """CAST(hour(reading_timestamp) BETWEEN 7 AND 9 AS INTEGER) AS is_morning_rush,
    CAST(hour(reading_timestamp) BETWEEN 16 AND 18 AS INTEGER) AS is_evening_rush"""
ML_TIME_SQL = f"""CAST(hour(reading_timestamp) AS INTEGER) AS hour, CAST(isodow(reading_timestamp) - 1 AS INTEGER) AS day_of_week,
    CAST(day(reading_timestamp) AS INTEGER) AS day_of_month, CAST(month(reading_timestamp) AS INTEGER) AS month,
    CAST(quarter(reading_timestamp) AS INTEGER) AS quarter, CAST(year(reading_timestamp) AS INTEGER) AS year,
    {_CYCLES}, {_ML_RUSH}, CAST(isodow(reading_timestamp) >= 6 AS INTEGER) AS is_weekend"""
_STATS = ", ".join(
    f"{r(f'{fn}({c})', f'{c}_{name}', 2)}" if fn not in ("min", "max") or c == "speed_mph" else f"{fn}({c}) AS {c}_{name}"
    for c in ("traffic_volume", "speed_mph")
    for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
)
STATS_SQL = f"SELECT sensor_id, {_STATS} FROM staged GROUP BY sensor_id"


def fill_sql(source: str, name: str) -> str:
    """CTE that fills volume and speed of `source` forward, backward, then by the median."""
    cols = ("traffic_volume", "speed_mph")
    near = ", ".join(
        f"coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY sensor_id ORDER BY reading_timestamp, event_id "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value({c} IGNORE NULLS) OVER (PARTITION BY sensor_id "
        f"ORDER BY reading_timestamp, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"
        for c in cols
    )
    filled = ", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM {name}_near)) AS {c}" for c in cols)
    return f""", {name}_near AS (SELECT * REPLACE ({near}) FROM {source}),
        {name} AS (SELECT * REPLACE ({filled}) FROM {name}_near)"""


def iqr_sql(source: str, name: str) -> str:
    def inside(c: str, table: str) -> str:
        q1, q3 = (f"(SELECT quantile_cont({c}, {p}) FROM {table})" for p in (0.25, 0.75))
        return f"{c} >= {q1} - 1.5 * ({q3} - {q1}) AND {c} <= {q3} + 1.5 * ({q3} - {q1})"

    return f""", {name}_first AS (SELECT * FROM {source} WHERE {inside('traffic_volume', source)}),
        {name} AS (SELECT * FROM {name}_first WHERE {inside('speed_mph', name + '_first')})"""


ORACLES = {
    "stg_readings": sql(f"SELECT {columns_sql(STAGED)} FROM staged"),
    "stg_weather": sql(f"SELECT {columns_sql(WEATHER)} FROM staged_weather"),
    "stg_holidays": sql("""SELECT h.holiday_date, h.holiday_name, h.is_holiday, r.readings FROM holidays h LEFT JOIN (
        SELECT CAST(reading_timestamp AS DATE) AS day, count(*) AS readings FROM readings GROUP BY ALL) r ON r.day = h.holiday_date"""),
    "traffic_level": sql(f"SELECT event_id, {LEVEL_SQL.format('traffic_volume')} AS traffic_level FROM readings"),
    "surrogate_key": sql("""SELECT event_id, md5(concat_ws('|', coalesce(sensor_id, 'NULL'),
        coalesce(CAST(reading_timestamp AS VARCHAR), 'NULL'))) AS surrogate_key FROM readings"""),
    "congestion_level": sql(_WINDOWED + """ SELECT sensor_id, window_start, CASE WHEN avg_volume > 5000 THEN 'severe_congestion'
        WHEN avg_volume > 3000 THEN 'heavy_traffic' WHEN avg_volume > 1500 THEN 'moderate_traffic' ELSE 'normal' END
        AS congestion_level FROM win"""),
    "trend_indicator": sql(_WINDOWED + """ SELECT sensor_id, window_start, CASE WHEN avg_volume > previous_avg_volume
        THEN 'increasing' WHEN avg_volume < previous_avg_volume THEN 'decreasing' ELSE 'stable' END AS trend_indicator FROM paired"""),
    "time_features_stream": sql(f"SELECT {_ID}, {_STREAM_TIME} FROM readings"),
    "time_features_ml": sql(f"SELECT {_ID}, {ML_TIME_SQL} FROM readings"),
    "interaction_features": sql(f"""SELECT event_id, {r('traffic_volume / nullif(speed_mph + 1, 0)', 'traffic_density')},
        {r('speed_mph * is_morning_rush', 'rush_hour_speed_factor')}, {r('speed_mph * is_evening_rush', 'evening_rush_speed_factor')}
        FROM (SELECT *, {_ML_RUSH} FROM readings)"""),
    "iqr_outliers": sql(iqr_sql("readings", "kept") + " SELECT event_id, traffic_volume, speed_mph FROM kept"),
    "dedup_readings": sql("""SELECT * EXCLUDE (n) FROM (SELECT sensor_id, date_trunc('hour', reading_timestamp) AS reading_timestamp,
        event_id, traffic_volume, row_number() OVER (PARTITION BY sensor_id, date_trunc('hour', reading_timestamp)
        ORDER BY event_id) AS n FROM readings) WHERE n = 1"""),
    "fill_missing": sql(_GAPPY_SQL + fill_sql("gappy", "filled") + f" SELECT {_ID}, traffic_volume, speed_mph FROM filled"),
    "drop_incomplete": sql(_GAPPY_SQL + f""" SELECT {_ID}, traffic_volume, speed_mph FROM gappy
        WHERE traffic_volume IS NOT NULL AND speed_mph IS NOT NULL"""),
    "mask_columns": sql("""SELECT left(sensor_id, 3) || '***' AS sensor_id, round(latitude, 1) AS latitude,
        round(longitude, 1) AS longitude, traffic_volume, event_id FROM readings"""),
    "row_filter": """WITH dims AS (SELECT c_custkey, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey)
        SELECT *, 'TRAFFIC_ADMIN' AS role FROM dims UNION ALL SELECT *, 'TRAFFIC_ANALYST' FROM dims WHERE region = 'AMERICA'""",
    "join_nearest_weather": sql(f"""SELECT {_ID}, {columns_sql(HOURLY_COLUMNS[16:24])} FROM hourly"""),
    "join_holidays": sql(f"""SELECT {', '.join('t.' + c for c in ID)}, h.holiday_name, coalesce(h.is_holiday, FALSE) AS is_holiday
        FROM readings t LEFT JOIN holidays h ON CAST(t.reading_timestamp AS DATE) = h.holiday_date"""),
    "join_current_sensor": sql(f"""SELECT {', '.join('t.' + c for c in ID)}, v.city, v.road_name AS sensor_road_name
        FROM readings t LEFT JOIN versions v ON v.sensor_id = t.sensor_id AND v.is_current"""),
    "join_scd2_point_in_time": sql(""", facts AS (SELECT sensor_id, reading_timestamp - INTERVAL 9500 DAY AS reading_timestamp,
            traffic_volume, event_id FROM readings)
        SELECT f.*, v.city, v.road_name FROM facts f LEFT JOIN versions v ON v.sensor_id = f.sensor_id
            AND f.reading_timestamp >= v.valid_from AND f.reading_timestamp < v.valid_to"""),
    "join_prev_window": sql(_WINDOWED + f""" SELECT sensor_id, window_start, {r('avg_volume', 'avg_volume')},
        {r('previous_avg_volume', 'previous_avg_volume')} FROM paired"""),
    "join_group_stats": sql(f"""SELECT {', '.join('t.' + c for c in ID)}, t.traffic_volume, g.* EXCLUDE (sensor_id)
        FROM staged t JOIN ({STATS_SQL}) g ON g.sensor_id = t.sensor_id"""),
    "int_enriched": sql(f"SELECT {columns_sql(HOURLY_COLUMNS)} FROM hourly"),
    "fn_datetime": """SELECT o_orderkey, CAST(hour(t) AS INTEGER) AS hour, CAST(dayofweek(t) AS INTEGER) AS dow0_sun,
        CAST(dayofweek(t) + 1 AS INTEGER) AS dow1_sun, CAST(isodow(t) - 1 AS INTEGER) AS dow0_mon, CAST(month(t) AS INTEGER) AS month,
        CAST(year(t) AS INTEGER) AS year, CAST(quarter(t) AS INTEGER) AS quarter, CAST(t AS DATE) AS day,
        CAST(date_trunc('month', t) AS TIMESTAMP) AS month_start, date_diff('minute', o_orderdate, t) AS minutes,
        t - INTERVAL 7 DAY AS week_before, strptime(strftime(t, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed
        FROM (SELECT o_orderkey, o_orderdate, o_orderdate + to_minutes(o_orderkey % 1440) AS t FROM orders)""",
    "fn_math": f"""SELECT l_orderkey, l_linenumber, l_partkey, {r('abs(l_quantity - 25)', 'distance')},
        {r('least(l_quantity, 10.0)', 'low')}, {r('greatest(l_quantity, 10.0)', 'high')}, {r('round(l_extendedprice / 7, 2)', 'r2')},
        {r('sin(l_quantity)', 'sin_q')}, {r('cos(l_quantity)', 'cos_q')}, {r('sqrt(l_extendedprice)', 'root')},
        CAST(l_quantity AS INTEGER) AS whole, {r('l_extendedprice / nullif(l_quantity - 25, 0)', 'ratio')} FROM lineitem""",
    "fn_string": """SELECT c_custkey, md5(CAST(c_custkey AS VARCHAR) || '|' || c_name) AS key, left(c_name, 3) || '***' AS masked,
        c_name LIKE 'Customer#0000000%' AS is_first, upper(trim(c_mktsegment)) AS segment, starts_with(c_name, 'Customer') AS prefixed,
        regexp_replace(c_name, '#0+', '-', 'g') AS short, c_mktsegment || '|' || CAST(c_nationkey AS VARCHAR) AS joined FROM customer""",
    "fn_conditional": sql(f"""SELECT event_id, {r('coalesce(speed_mph, -1)', 'speed')}, {r('nullif(speed_mph, 5)', 'not_five')},
        speed_mph BETWEEN 20 AND 40 AS mid, road_name IN ('click', 'view') AS seen,
        CASE WHEN speed_mph < 20 THEN 'slow' WHEN speed_mph < 50 THEN 'normal' ELSE 'fast' END AS pace FROM readings"""),
    "fn_json": """SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k, 'k' AS name, CAST(props->>'$.k' AS INTEGER) AS number,
        CAST(user_id AS INTEGER) AS second, CAST(props->>'$.k' AS INTEGER) = 8 OR user_id = 8 AS has_eight,
        '{"t":"' || event_type || '"}' AS text FROM events""",
}
