"""Landed files, tables and exports."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import tables
from roadpulse.sources import readers, streams
from roadpulse.sources.schemas import READING_MESSAGE

T0 = datetime(2024, 1, 10, 12, 0, 0)


def readings(spark, n=10, **more):
    return spark.createDataFrame(
        [(f"s{i % 3}", T0 + timedelta(hours=i), i, 30.0, 1.0, "road", "North", 44.0, -93.0) for i in range(n)], READING_MESSAGE
    )


def test_history_csv_skips_bad_rows(spark, tmp_path):
    text = "holiday,date_time,traffic_volume\nNone,2012-10-02 09:00:00,5545\nNone,not a time,1\nNone,2012-10-02 10:00:00,many\n,2012-10-02 11:00:00,0\n"
    (tmp_path / "h.csv").write_text(text)
    got = readers.read_history_csv(spark, str(tmp_path / "h.csv")).orderBy("timestamp").collect()
    assert [r["traffic_volume"] for r in got] == [5545, 0]
    assert all(r["sensor_id"].startswith("i94-sensor-") and r["speed_mph"] is None and r["direction"] == "West" for r in got)
    again = readers.read_history_csv(spark, str(tmp_path / "h.csv")).orderBy("timestamp").collect()
    assert got == again


def test_history_csv_needs_its_columns(spark, tmp_path):
    (tmp_path / "h.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="missing"):
        readers.read_history_csv(spark, str(tmp_path / "h.csv"))


def test_weather_documents(spark):
    full = {
        "dt": 1704067200, "coord": {"lat": 1.0, "lon": 2.0}, "main": {"temp": 40.0, "humidity": 50}, "wind": {"speed": 5.0},
        "weather": [{"main": "Rain", "description": "light rain"}, {"main": "Fog"}], "visibility": 16093.4, "clouds": {"all": 75}, "rain": {"1h": 0.3},
    }
    bare = {"main": {"temp": 40.0, "humidity": 50}, "wind": {"speed": 5.0}, "weather": [{"main": "Clear"}]}
    broken = {"main": {"temp": 40.0}, "weather": []}
    raw = spark.createDataFrame([(json.dumps(d),) for d in (full, bare, broken)] + [("{oops",)], "value string")
    got = readers.flatten_weather(raw).orderBy("weather_main").collect()
    assert [r["weather_main"] for r in got] == ["Clear", "Rain"]
    assert (got[0]["visibility_miles"], got[0]["clouds_pct"], got[0]["rain_1h_mm"]) == (0.0, 0, None)
    assert (got[1]["visibility_miles"], got[1]["clouds_pct"], got[1]["rain_1h_mm"]) == (pytest.approx(10.0), 75, 0.3)


def test_batch_load_enforces_the_schema(spark, tmp_path):
    raw = readings(spark).withColumn("traffic_volume", F.col("traffic_volume").cast("string"))
    raw.write.parquet(str(tmp_path / "raw"))
    readers.batch_load(spark, str(tmp_path / "raw"), str(tmp_path / "bronze"), READING_MESSAGE)
    table = spark.read.parquet(str(tmp_path / "bronze"))
    assert table.count() == 10 and dict(table.dtypes)["traffic_volume"] == "int"
    assert table.filter("year = 2024 and month = 1 and day = 10").count() == 10
    raw.drop("speed_mph").write.parquet(str(tmp_path / "short"))
    with pytest.raises(ValueError, match="speed_mph"):
        readers.batch_load(spark, str(tmp_path / "short"), str(tmp_path / "bronze"), READING_MESSAGE)


def test_auto_ingest_json(spark, tmp_path):
    land, table, check = (str(tmp_path / n) for n in ("land", "table", "check"))
    (tmp_path / "land").mkdir()
    (tmp_path / "land" / "a.json").write_text('{"DATE": "2024-01-01", "Name": "New Year"}\nnot json\n')
    streams.auto_ingest(spark, land, "holidays", table, check).awaitTermination()
    assert [r["name"] for r in spark.read.parquet(table).collect()] == ["New Year"]
    assert spark.read.parquet(f"{table}_rejected").first()["_corrupt_record"] == "not json"
    (tmp_path / "land" / "b.json").write_text('{"date": "2024-07-04", "name": "Independence Day", "extra": 1}\n{"date": "soon", "name": "Bad"}\n')
    streams.auto_ingest(spark, land, "holidays", table, check).awaitTermination()
    assert sorted(r["name"] for r in spark.read.parquet(table).collect()) == ["Independence Day", "New Year"]


def test_auto_ingest_parquet_once(spark, tmp_path):
    land, table, check = (str(tmp_path / n) for n in ("land", "table", "check"))
    upper = readings(spark).select(*[F.col(c).alias(c.upper()) for c in READING_MESSAGE.names])
    upper.write.parquet(land)
    for _ in range(2):
        streams.auto_ingest(spark, land, "traffic_events", table, check, purge=True).awaitTermination()
    assert spark.read.parquet(table).filter("traffic_volume is not null").count() == 10


def test_compaction_makes_few_sorted_files(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_compacted(readings(spark, 300).repartition(20), path, ["sensor_id", "timestamp"], 4)
    written = spark.read.parquet(path)
    assert len(written.inputFiles()) <= 4 and written.count() == 300
    spans = written.groupBy(F.input_file_name().alias("f")).agg(
        F.min(F.struct("sensor_id", "timestamp")).alias("lo"), F.max(F.struct("sensor_id", "timestamp")).alias("hi")
    )
    ordered = sorted((tuple(r["lo"]), tuple(r["hi"])) for r in spans.collect())
    assert all(a[1] < b[0] for a, b in zip(ordered, ordered[1:], strict=False))


def test_publish_checks_the_contract(spark, tmp_path):
    path = str(tmp_path / "served")
    staging = readings(spark).select("sensor_id", "traffic_volume")
    tables.publish(staging, path, staging.schema)
    tables.publish(staging, path, staging.schema)
    assert spark.read.parquet(path).count() == 20
    with pytest.raises(ValueError, match="contract"):
        tables.publish(staging.withColumn("more", F.lit(1)), path, staging.schema)


def test_export_csv(spark, tmp_path):
    tables.export_csv(readings(spark).select("sensor_id", "traffic_volume"), str(tmp_path / "csv"), single_file=True)
    files = list((tmp_path / "csv").glob("*.csv"))
    assert len(files) == 1
    lines = files[0].read_text().splitlines()
    assert lines[0] == "sensor_id,traffic_volume" and len(lines) == 11


def test_nested_round_trip(spark, rows):
    df = readings(spark).withColumnRenamed("timestamp", "reading_timestamp").withColumn("event_id", F.col("traffic_volume"))
    flat = readers.flatten_reading(readers.nest_reading(df))
    assert rows(flat) == rows(df, *flat.columns)


def test_marts_from_one_written_table(spark, data, rows, tmp_path):
    from roadpulse.operators import marts
    from roadpulse.plans.base import hourly

    df = hourly(spark, data)
    marts.write_marts(df, str(tmp_path), 3, min_n=1)
    written = spark.read.parquet(str(tmp_path / "mart_daily_summary"))
    assert rows(written) == rows(marts.mart_daily_summary(df), *written.columns)
    assert len(spark.read.parquet(str(tmp_path / "mart_hourly")).inputFiles()) <= 3
    assert spark.read.parquet(str(tmp_path / "mart_congestion")).count() > 0
