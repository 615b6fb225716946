"""Streams: decoding, sinks, restarts, late rows, state, progress."""

import json
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from roadpulse.operators import enrich
from roadpulse.sources import adapters, streams
from roadpulse.sources.schemas import READING_MESSAGE
from roadpulse.streaming import changes, dimension, late, progress, sinks, state, windows

T0 = datetime(2024, 1, 10, 12, 0, 0)


def land(spark, folder, rows):
    """One more file of readings for a file stream."""
    spark.createDataFrame(rows, "sensor_id string, timestamp timestamp, traffic_volume int, speed_mph double, event_id long").coalesce(1).write.mode(
        "append"
    ).parquet(str(folder))


def reading(sensor, minutes, volume=100, event_id=0):
    return (sensor, T0 + timedelta(minutes=minutes), volume, 30.0, event_id)


def stream_of(spark, folder):
    frame = spark.read.parquet(str(folder))
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    extra = {"road_name": F.lit("r"), "direction": F.lit("N"), "latitude": F.lit(1.0), "longitude": F.lit(2.0), "occupancy_pct": F.lit(3.0)}
    return stream.withColumns(extra)


def drain(stream, path, check):
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", str(check)).trigger(availableNow=True).start(str(path))
    )
    query.awaitTermination()
    return query


def test_decode_and_quarantine(spark):
    good = {"sensor_id": "a", "timestamp": "2024-01-10T12:00:00.123456", "traffic_volume": 5, "speed_mph": 1.5}
    millis = {**good, "sensor_id": "b", "timestamp": 1704888000123}
    bad = [b"{broken", json.dumps({"sensor_id": "c"}).encode(), json.dumps({**good, "timestamp": "yesterday"}).encode(), None]
    raw = spark.createDataFrame([(json.dumps(m).encode(),) for m in (good, millis)] + [(b,) for b in bad], "value binary")
    got = streams.decode_readings(raw).orderBy("sensor_id").collect()
    assert [r["sensor_id"] for r in got] == ["a", "b"]
    assert got[0]["timestamp"] == datetime(2024, 1, 10, 12, 0, 0, 123456) and got[1]["timestamp"] == datetime(2024, 1, 10, 12, 0, 0, 123000)
    assert got[0]["occupancy_pct"] is None
    assert streams.decode_readings(raw).schema == READING_MESSAGE
    assert streams.quarantined(raw).count() == len(bad)


def test_topic_reader_is_wired(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        streams.read_topic(spark, "localhost:9092", "traffic-sensor-events")


def test_windows_close_behind_the_watermark_and_survive_a_restart(spark, tmp_path):
    source, out, check = (tmp_path / n for n in ("in", "out", "check"))
    land(spark, source, [reading("a", 1), reading("a", 3), reading("a", 7)])
    stream = streams.with_watermark(stream_of(spark, source))
    drain(windows.tumbling(stream), out, check)
    assert spark.read.schema("window_start timestamp").parquet(str(out)).count() == 0
    land(spark, source, [reading("a", 30)])
    drain(windows.tumbling(streams.with_watermark(stream_of(spark, source))), out, check)
    rows = spark.read.parquet(str(out)).orderBy("window_start").collect()
    assert [(r["window_start"], r["reading_count"]) for r in rows] == [(T0, 2), (T0 + timedelta(minutes=5), 1)]
    # A row behind the watermark is dropped.
    land(spark, source, [reading("a", 2), reading("a", 60)])
    drain(windows.tumbling(streams.with_watermark(stream_of(spark, source))), out, check)
    counts = {r["window_start"]: r["reading_count"] for r in spark.read.parquet(str(out)).collect()}
    assert counts[T0] == 2 and counts[T0 + timedelta(minutes=30)] == 1


def test_trend_in_one_pass(spark):
    rows = [reading("a", m, v, i) for i, (m, v) in enumerate([(0, 10), (1, 20), (5, 30), (10, 30), (25, 5), (30, 50)])]
    df = spark.createDataFrame(rows, "sensor_id string, timestamp timestamp, traffic_volume int, speed_mph double, event_id long").withColumns(
        {"road_name": F.lit("r"), "direction": F.lit("N"), "latitude": F.lit(1.0), "longitude": F.lit(2.0)}
    )
    got = windows.metrics(df).orderBy("window_start").collect()
    assert [(r["window_start"], r["volume_trend"], r["trend_indicator"]) for r in got] == [
        (T0 + timedelta(minutes=5), 15.0, "increasing"), (T0 + timedelta(minutes=10), 0.0, "stable"), (T0 + timedelta(minutes=30), 45.0, "increasing"),
    ]
    assert all(r["window_end"] - r["window_start"] == timedelta(minutes=5) for r in got)
    kinds = [r["anomaly_type"] for r in windows.anomalies(windows.metrics(df)).orderBy("window_start").collect()]
    assert kinds == ["volume_spike", "volume_spike"]


def test_dedup_across_batches(spark, tmp_path):
    source, out, check = (tmp_path / n for n in ("in", "out", "check"))
    land(spark, source, [reading("a", 1, 1), reading("a", 1, 1), reading("b", 1, 2)])
    drain(windows.deduplicated(streams.with_watermark(stream_of(spark, source))), out, check)
    land(spark, source, [reading("a", 1, 1), reading("a", 2, 3)])
    drain(windows.deduplicated(streams.with_watermark(stream_of(spark, source))), out, check)
    assert sorted(r["traffic_volume"] for r in spark.read.parquet(str(out)).collect()) == [1, 2, 3]


def test_three_sinks(spark, tmp_path):
    source = tmp_path / "in"
    land(spark, source, [reading("a", m, v, m) for m, v in [(0, 100), (5, 900), (10, 910), (60, 1)]])
    measured = windows.metrics(streams.with_watermark(stream_of(spark, source)), 5, "timestamp", "event_id")
    config = sinks.SinkConfig(
        str(tmp_path / "table"), str(tmp_path / "check"), log_format="memory", alert_format="memory",
        table_trigger=None, log_trigger=None, alert_trigger=None,
    )
    queries = sinks.start_sinks(measured, windows.anomalies(measured), config)
    for query in queries:
        query.awaitTermination()
    table = spark.read.parquet(str(tmp_path / "table"))
    assert table.count() == 2 and {"year", "month", "day"} <= set(table.columns)
    assert spark.table("metrics_log").count() == 2
    alert = spark.table("alert_messages").first()
    assert alert["key"] == "a" and json.loads(alert["value"])["anomaly_type"] == "volume_spike"


def test_sinks_over_a_staged_stream_keep_no_state(spark, tmp_path):
    source = tmp_path / "in"
    land(spark, source, [reading("a", m, v, m) for m, v in [(0, 100), (5, 900), (10, 910), (60, 1)]])
    stream = windows.metrics(streams.with_watermark(stream_of(spark, source)), 5, "timestamp", "event_id")
    with state.rocksdb_state(spark):
        measured = sinks.staged(stream, str(tmp_path / "metrics"), str(tmp_path / "check" / "metrics"), None)
    config = sinks.SinkConfig(
        str(tmp_path / "table"), str(tmp_path / "check"), "parquet", "parquet", {"path": str(tmp_path / "alerts")}, None, None, None,
        {"path": str(tmp_path / "log")},
    )
    queries = sinks.start_sinks(measured, windows.anomalies(measured), config)
    for query in queries:
        query.awaitTermination()
        assert query.lastProgress["stateOperators"] == []
    assert spark.read.parquet(str(tmp_path / "table")).count() == spark.read.parquet(str(tmp_path / "log")).count() == 2
    alert = spark.read.parquet(str(tmp_path / "alerts")).first()
    assert alert["key"] == "a" and json.loads(alert["value"])["anomaly_type"] == "volume_spike"


def test_stream_static_join(spark, tmp_path):
    source, out, check = (tmp_path / n for n in ("in", "out", "check"))
    land(spark, source, [reading("a", 1), reading("b", 1)])
    cities = spark.createDataFrame([("a", "Minneapolis")], "sensor_id string, city string")
    drain(enrich.enrich_stream(stream_of(spark, source), cities, "sensor_id"), out, check)
    assert {r["sensor_id"]: r["city"] for r in spark.read.parquet(str(out)).collect()} == {"a": "Minneapolis", "b": None}


def late_stream(spark, source):
    stream = stream_of(spark, source).withColumn("reading_timestamp", F.col("timestamp").cast("timestamp_ntz"))
    return stream.select("sensor_id", "reading_timestamp", "traffic_volume", "event_id")


def test_late_rows_merge_batch_by_batch(spark, tmp_path):
    source, table, check = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "check")
    base = spark.createDataFrame(
        [("a", T0, 1, 1), ("b", T0, 2, 2)], "sensor_id string, reading_timestamp timestamp_ntz, traffic_volume int, event_id long"
    )
    late.write_snapshot(base, table, 0)
    as_of = str(T0 + timedelta(hours=30))
    land(spark, source, [reading("a", 0, 10, 3), reading("c", 0, 20, 4), reading("fresh", 25 * 60, 1, 5)])
    late.late_merge(late_stream(spark, source), table, check, as_of).awaitTermination()
    land(spark, source, [reading("a", 0, 11, 1), reading("d", 0, 30, 7)])
    late.late_merge(late_stream(spark, source), table, check, as_of).awaitTermination()
    expected = {"a": (11, True), "b": (2, None), "c": (20, True), "d": (30, True)}

    def current():
        return {r["sensor_id"]: (r["traffic_volume"], r["is_late_arrival"]) for r in late.read_current(spark, table).collect()}

    assert current() == expected
    assert late.fold(spark, table) == 2 == late.fold(spark, table)
    assert late.versions(spark, table) == [0, 2] and current() == expected
    land(spark, source, [reading("b", 0, 12, 8)])
    late.late_merge(late_stream(spark, source), table, check, as_of).awaitTermination()
    assert current() == {**expected, "b": (12, True)}


def test_unfinished_changes_are_not_read_and_written_again(spark, tmp_path):
    source, table, check = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "check")
    late.write_snapshot(late_base(spark), table, 0)
    half = tmp_path / "table" / "changes" / "batch_id=0"
    half.mkdir(parents=True)
    (half / "part-0.parquet").write_text("half written")
    as_of = str(T0 + timedelta(hours=30))
    assert late.read_current(spark, table).first()["traffic_volume"] == 1
    land(spark, source, [reading("a", 0, 10, 3)])
    late.late_merge(late_stream(spark, source), table, check, as_of).awaitTermination()
    assert late.read_current(spark, table).first()["traffic_volume"] == 10


def late_base(spark):
    return spark.createDataFrame([("a", T0, 1, 1)], "sensor_id string, reading_timestamp timestamp_ntz, traffic_volume int, event_id long")


def test_sensor_state_over_batches(spark, tmp_path):
    source, out, check = (tmp_path / n for n in ("in", "out", "check"))

    def run():
        stream = streams.with_watermark(stream_of(spark, source))
        with state.rocksdb_state(spark):
            drain(state.sensor_state(stream, 120), out, check)

    land(spark, source, [reading("a", 0), reading("a", 5), reading("b", 0)])
    run()
    land(spark, source, [reading("a", 300), reading("a", 301)])
    run()
    land(spark, source, [reading("a", 420), reading("b", 500)])
    run()
    got = sorted((r["sensor_id"], r["status"], r["gap_seconds"]) for r in spark.read.parquet(str(out)).collect())
    assert ("a", "resumed", 295 * 60.0) in got
    assert ("b", "silent", 7200.0) in got
    assert len([g for g in got if g[0] == "a" and g[1] == "resumed"]) == 1


def test_a_busy_sensor_reaches_the_state_as_minutes(spark):
    """Each task gives out two times a minute, whatever the number of readings."""
    rows = [("hot", T0 + timedelta(seconds=k % 600)) for k in range(50_000)] + [("hot", None), ("cold", T0)]
    df = spark.createDataFrame(rows, "sensor_id string, timestamp timestamp").repartition(4)
    edges = state.minute_edges(df)
    assert edges.count() <= 4 * 10 + 1
    hot = edges.filter("sensor_id = 'hot'").agg(F.min("first"), F.max("last")).first()
    assert tuple(hot) == (T0, T0 + timedelta(seconds=599))
    with pytest.raises(ValueError):
        state.sensor_state(df, 0)


def test_provider_is_put_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    with pytest.raises(RuntimeError), state.rocksdb_state(spark):
        assert spark.conf.get(key) == state.PROVIDER
        raise RuntimeError
    assert spark.conf.get(key, None) == before


def test_sessions_merge_across_batches(spark, tmp_path):
    """Two sessions of the first batch become one by a reading of the second."""
    source, out, check = (tmp_path / n for n in ("in", "out", "check"))

    def run():
        stream = streams.with_watermark(stream_of(spark, source), delay="2 hours")
        with windows.merged_locally(spark):
            drain(windows.sessions(stream, "30 minutes", "timestamp", "event_id"), out, check)

    land(spark, source, [reading("a", 0, 10, 1), reading("a", 50, 30, 2), reading("b", 10, 7, 3)])
    run()
    assert not out.exists() or spark.read.schema("sensor_id string").parquet(str(out)).count() == 0
    land(spark, source, [reading("a", 25, 20, 4), reading("a", 300, 1, 5)])
    run()
    got = {(r["sensor_id"], r["session_start"], r["session_end"], r["reading_count"], r["avg_volume"]) for r in spark.read.parquet(str(out)).collect()}
    at = lambda m: T0 + timedelta(minutes=m)
    assert got == {("a", at(0), at(80), 3, 20.0), ("b", at(10), at(40), 1, 7.0)}


CHANGES = "operation string, k long, name string, at timestamp_ntz, seq long"


def test_changes_in_any_order_end_the_same(spark, tmp_path):
    """Late, repeated and reordered changes over several batches; a deleted key comes back by a later insert only."""
    table, check, source = str(tmp_path / "table"), str(tmp_path / "check"), tmp_path / "in"
    base = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three"), (None, "none")], "k long, name string")
    keys, order = ["k"], ["at", "seq"]
    changes.write_target(base, table, keys, {"at": "timestamp_ntz", "seq": "bigint"}, 4)
    when = lambda h: T0 + timedelta(hours=h)
    batches = [
        [("DELETE", 1, None, when(5), 9), ("UPDATE", 2, "zwei", when(2), 3), ("INSERT", 7, "seven", when(1), 1)],
        [("UPDATE", 1, "eins", when(4), 8), ("UPDATE", 2, "deux", when(1), 2), ("DELETE", 7, None, when(1), 2), ("UPDATE", 3, "drei", None, 1), ("INSERT", None, "x", when(1), 1)],
        [("DELETE", 1, None, when(5), 9), ("UPDATE", 2, "zwei", when(2), 3), ("INSERT", 7, "seven", when(1), 1), ("INSERT", 8, "eight", when(0), 1)],
        [("INSERT", 1, "again", when(6), 10)],
    ]
    expected = [
        {2: "zwei", 3: "three", 7: "seven"}, {2: "zwei", 3: "three"}, {2: "zwei", 3: "three", 8: "eight"}, {1: "again", 2: "zwei", 3: "three", 8: "eight"},
    ]
    for batch, want in zip(batches, expected, strict=True):
        spark.createDataFrame(batch, CHANGES).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(CHANGES).parquet(str(source))
        changes.apply_change_stream(stream, table, check, keys, order, buckets=4).awaitTermination()
        assert {r["k"]: r["name"] for r in changes.read_target(spark, table).collect() if r["k"] is not None} == want
    assert [r["name"] for r in changes.read_target(spark, table).filter("k is null").collect()] == ["none"]


def test_a_cut_off_batch_is_finished(spark, tmp_path):
    """What a batch merged is there when it runs again, even if the table has lost a partition by then."""
    import shutil

    table, check, source = tmp_path / "table", str(tmp_path / "check"), tmp_path / "in"
    base = spark.createDataFrame([(k, f"n{k}") for k in range(40)], "k long, name string")
    changes.write_target(base, str(table), ["k"], {"at": "timestamp_ntz", "seq": "bigint"}, 4)
    untouched = {(f.parent.name, f.name) for f in table.glob("__bucket=*/part-*")}
    spark.createDataFrame([("UPDATE", 5, "five", T0, 1)], CHANGES).coalesce(1).write.parquet(str(source))

    def run():
        changes.apply_change_stream(spark.readStream.schema(CHANGES).parquet(str(source)), str(table), check, ["k"], ["at", "seq"], buckets=4).awaitTermination()
        return {r["k"]: r["name"] for r in changes.read_target(spark, str(table)).collect()}

    want = {k: f"n{k}" for k in range(40)} | {5: "five"}
    assert run() == want
    assert len(untouched & {(f.parent.name, f.name) for f in table.glob("__bucket=*/part-*")}) == 3
    # As if the commit of the batch and the replaced partition had been lost.
    for name in ("commits/0", "commits/.0.crc"):
        (tmp_path / "check" / name).unlink(missing_ok=True)
    bucket = next(r[0] for r in spark.read.parquet(str(table)).filter("k = 5").select("__bucket").collect())
    shutil.rmtree(table / f"__bucket={bucket}")
    assert run() == want


def test_dimension_changes_between_batches(spark, tmp_path):
    source, history, out, check = tmp_path / "in", str(tmp_path / "history"), str(tmp_path / "out"), str(tmp_path / "check")
    kind = "sensor_id string, updated_at timestamp_ntz, seq long, city string"
    spark.createDataFrame([("a", T0 - timedelta(days=1), 1, "Old")], kind).write.parquet(history)

    def run():
        stream = stream_of(spark, source).withColumn("reading_timestamp", F.col("timestamp").cast("timestamp_ntz"))
        rows = stream.select("sensor_id", "reading_timestamp", "event_id")
        dimension.enrich_changing(rows, lambda s: s.read.parquet(history), out, check).awaitTermination()
        return {(r["event_id"], r["city"]) for r in spark.read.parquet(out).collect()}

    land(spark, source, [reading("a", 0, event_id=1), reading("b", 0, event_id=2)])
    assert run() == {(1, "Old"), (2, None)}
    spark.createDataFrame([("a", T0 + timedelta(minutes=30), 2, "New"), ("b", T0, 3, "B")], kind).write.mode("append").parquet(history)
    land(spark, source, [reading("a", 10, event_id=3), reading("a", 30, event_id=4), reading("b", 1, event_id=5)])
    assert run() == {(1, "Old"), (2, None), (3, "Old"), (4, "New"), (5, "B")}


def test_progress_of_queries(spark, tmp_path):
    source, out, check = (tmp_path / n for n in ("in", "out", "check"))
    land(spark, source, [reading("a", 1), reading("b", 2)])
    seen = []
    listener = progress.ProgressListener(seen.append, keep=5)
    spark.streams.addListener(listener)
    try:
        drain(stream_of(spark, source), out, check)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        import time

        for _ in range(50):
            if seen:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert sum(r["input_rows"] for r in listener.frame(spark).collect()) == 2
    assert listener.errors == [] and len(listener.rows) <= 5
    assert progress.active_progress(spark).count() == 0


def test_stream_equals_batch_on_closed_windows(spark, data, tmp_path):
    stream = streams.with_watermark(adapters.reading_stream(spark, data))
    drain(windows.sliding(stream, "3 hours", "1 hour", "timestamp", "event_id"), tmp_path / "out", tmp_path / "check")
    batch = adapters.readings(spark, data).withColumn("timestamp", F.col("reading_timestamp").cast("timestamp"))
    twin = windows.sliding(batch, "3 hours", "1 hour", "timestamp", "event_id")
    edge = batch.agg(F.max("timestamp")).first()[0] - timedelta(minutes=10)
    closed = {tuple(r) for r in twin.filter(F.col("window_end") <= F.lit(edge)).collect()}
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select(*twin.columns).collect()} == closed


def test_a_new_sensor_asks_for_its_state_once():
    times = pd.to_datetime(["2024-01-01 00:00", "2024-01-01 05:00", "2024-01-01 01:00"])
    asked = []

    class Held:
        def get(self):
            asked.append("get")

        def update(self, value):
            asked.append(value)

    class Handle:
        def getValueState(self, name, schema):
            return Held()

        def registerTimer(self, due):
            asked.append(due)

    class Timers:
        def getCurrentWatermarkInMs(self):
            return 0

    watch = state.GapWatch(120)
    watch.init(Handle())
    (found,) = watch.handleInputRows(("a",), iter([pd.DataFrame({"first": times, "last": times})]), Timers())
    assert found.iloc[0].tolist() == ["a", times[1], times[2], 4 * 3600.0, "resumed"] and len(found) == 1
    assert asked == ["get", (datetime(2024, 1, 1, 5),), 1704092400000]
