"""Fixed schemas of the messages, landed files and tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


READING_MESSAGE = _struct(
    sensor_id=T.StringType(),
    timestamp=T.TimestampType(),
    traffic_volume=T.IntegerType(),
    speed_mph=T.DoubleType(),
    occupancy_pct=T.DoubleType(),
    road_name=T.StringType(),
    direction=T.StringType(),
    latitude=T.DoubleType(),
    longitude=T.DoubleType(),
)

WEATHER_UPDATE = _struct(
    timestamp=T.TimestampType(),
    latitude=T.DoubleType(),
    longitude=T.DoubleType(),
    temp_fahrenheit=T.DoubleType(),
    humidity_pct=T.DoubleType(),
    wind_speed_mph=T.DoubleType(),
    weather_main=T.StringType(),
    weather_description=T.StringType(),
    visibility_miles=T.DoubleType(),
    clouds_pct=T.IntegerType(),
    rain_1h_mm=T.DoubleType(),
    snow_1h_mm=T.DoubleType(),
)

HOLIDAY = _struct(date=T.DateType(), name=T.StringType())

SENSOR_METADATA = _struct(
    sensor_id=T.StringType(),
    road_name=T.StringType(),
    city=T.StringType(),
    direction=T.StringType(),
    latitude=T.DecimalType(10, 6),
    longitude=T.DecimalType(10, 6),
    is_active=T.BooleanType(),
    installed_date=T.TimestampType(),
    updated_at=T.TimestampType(),
)

SENSOR_CHANGE = _struct(
    operation=T.StringType(),
    sensor_id=T.StringType(),
    road_name=T.StringType(),
    city=T.StringType(),
    direction=T.StringType(),
    latitude=T.DoubleType(),
    longitude=T.DoubleType(),
    is_active=T.BooleanType(),
    change_timestamp=T.TimestampType(),
)

# Weather API document; `1h` is the amount over the last hour.
WEATHER_DOCUMENT = _struct(
    dt=T.LongType(),
    coord=_struct(lat=T.DoubleType(), lon=T.DoubleType()),
    main=_struct(temp=T.DoubleType(), humidity=T.DoubleType()),
    wind=_struct(speed=T.DoubleType()),
    weather=T.ArrayType(_struct(main=T.StringType(), description=T.StringType())),
    visibility=T.DoubleType(),
    clouds=_struct(all=T.IntegerType()),
    rain=_struct(**{"1h": T.DoubleType()}),
    snow=_struct(**{"1h": T.DoubleType()}),
)

# Feeds of the incremental file ingest: (file format, schema).
FEEDS = {
    "traffic_events": ("parquet", READING_MESSAGE),
    "weather_updates": ("json", WEATHER_UPDATE),
    "holidays": ("json", HOLIDAY),
    "sensor_metadata": ("json", SENSOR_METADATA),
}
