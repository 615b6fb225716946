"""Edge rules on small literal frames."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from roadpulse.functions import columns as C
from roadpulse.operators import (
    access, cleaning, enrich, features, forecast, late, lineage, marts, observability, quality, reports, schema, staging, tables,
    windows,
)
from roadpulse.plans import models
from roadpulse.sources import changes, readers

T0 = datetime(2024, 1, 10, 12, 0, 0)


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def readings(spark, rows):
    return frame(spark, rows, "sensor_id string, reading_timestamp timestamp_ntz, traffic_volume int, event_id long")


def observations(spark, rows):
    return frame(spark, rows, "weather_timestamp timestamp_ntz, weather_main string, event_id long")


def brute_nearest(reading, seen, tolerance=60):
    def minute(t):
        return int((t - datetime(1970, 1, 1)).total_seconds() // 60)

    near = [(abs(minute(reading) - minute(t)), t, i, name) for t, name, i in seen]
    near = [n for n in near if n[0] <= tolerance]
    return min(near)[3] if near else None


def test_nearest_join_boundaries(spark):
    at = lambda **kw: T0 + timedelta(**kw)
    seen = [
        (at(minutes=-61), "far", 1), (at(seconds=59), "late second", 2), (at(minutes=-30), "tie early", 3),
        (at(minutes=30), "tie late", 4), (at(minutes=30), "same time", 5), (at(hours=5), "alone", 6),
    ]
    times = [at(minutes=m, seconds=s) for m in range(-200, 420, 7) for s in (0, 59)]
    df = readings(spark, [(f"s{i}", t, 1, i) for i, t in enumerate(times)])
    joined = enrich.nearest_join(df, observations(spark, seen), columns=["weather_main"])
    got = {r["event_id"]: r["weather_main"] for r in joined.collect()}
    assert got == {i: brute_nearest(t, seen) for i, t in enumerate(times)}


@pytest.mark.parametrize("seed", range(3))
def test_nearest_join_against_brute_force(spark, seed):
    import random

    rnd = random.Random(seed)
    base = datetime(2024, 3, 1)
    seen = [(base + timedelta(seconds=rnd.randrange(4 * 86400)), f"w{i}", i) for i in range(80)]
    times = [base + timedelta(seconds=rnd.randrange(-7200, 4 * 86400 + 7200)) for _ in range(300)]
    df = readings(spark, [("s", t, 1, i) for i, t in enumerate(times)])
    joined = enrich.nearest_join(df, observations(spark, seen), columns=["weather_main"])
    got = {r["event_id"]: r["weather_main"] for r in joined.collect()}
    assert got == {i: brute_nearest(t, seen) for i, t in enumerate(times)}


def test_minutes_count_boundaries(spark):
    df = frame(spark, [(T0 + timedelta(seconds=59), T0 + timedelta(seconds=61))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(C.minutes_between("a", "b")).first()[0] == 1


def test_severity_nulls_and_cap(spark):
    rows = [(0.0, 0.0, None, 5.0), (0.0, 0.0, 10.0, None), (10.0, 10.0, 50.0, 0.0), (0.0, 0.0, 10.0, 10.0)]
    df = frame(spark, rows, "rain double, snow double, wind double, visibility double")
    got = [r[0] for r in df.select(staging.weather_severity(*[F.col(c) for c in df.columns])).collect()]
    assert got == [None, None, 10.0, 0.0]


def test_level_of_null_volume_is_congested(spark):
    df = frame(spark, [(999,), (1000,), (3000,), (5000,), (None,)], "v int")
    assert [r[0] for r in df.select(C.traffic_level("v")).collect()] == ["low", "medium", "high", "congested", "congested"]


def test_surrogate_key_of_null(spark):
    import hashlib

    df = frame(spark, [("a", None)], "x string, y string")
    assert df.select(C.surrogate_key("x", "y")).first()[0] == hashlib.md5(b"a|NULL").hexdigest()


def test_duplicates_collapse_and_pct_change_after_zero(spark):
    df = readings(spark, [("s", T0, 0, 2), ("s", T0, 7, 3), ("s", T0 + timedelta(hours=1), 5, 4)])
    single = enrich.one_per_instant(df)
    assert sorted(r["event_id"] for r in single.collect()) == [2, 4]
    changed = windows.percent_changes(single, "traffic_volume").orderBy("event_id").collect()
    assert [r["traffic_volume_pct_change"] for r in changed] == [None, None]


def test_single_row_has_no_deviation(spark):
    df = readings(spark, [("s", T0, 5, 1)])
    row = windows.rolling_features(df, ["traffic_volume"], [3]).first()
    assert row["traffic_volume_rolling_mean_3"] == 5 and row["traffic_volume_rolling_std_3"] is None
    assert windows.rolling_range(df, "traffic_volume").first()["traffic_volume_rolling_std"] is None


def test_rolling_range_dense_against_brute_force(spark):
    import random
    import statistics

    rnd = random.Random(5)
    rows = [("hot" if i % 3 else "cold", T0 + timedelta(seconds=rnd.randrange(6000)), rnd.randrange(500), i) for i in range(300)]
    rows += [("edge", T0, 1, 1000), ("edge", T0 + timedelta(minutes=15), 3, 1001), ("edge", T0 + timedelta(minutes=15, seconds=1), 5, 1002)]
    got = windows.rolling_range(readings(spark, rows), "traffic_volume", 15).collect()
    assert len(got) == len(rows)
    for r in got:
        frame_values = [v for k, t, v, _ in rows if k == r["sensor_id"] and r["reading_timestamp"] - timedelta(minutes=15) <= t <= r["reading_timestamp"]]
        assert r["traffic_volume_rolling_avg"] == pytest.approx(statistics.fmean(frame_values))
        if len(frame_values) > 1:
            assert r["traffic_volume_rolling_std"] == pytest.approx(statistics.stdev(frame_values), abs=1e-9)
        else:
            assert r["traffic_volume_rolling_std"] is None


def test_fill_order_and_median(spark):
    rows = [("a", T0, None, 1), ("a", T0 + timedelta(hours=1), 4, 2), ("a", T0 + timedelta(hours=2), None, 3), ("b", T0, None, 4), ("a", T0 + timedelta(hours=3), 8, 5)]
    filled = cleaning.fill_missing(readings(spark, rows), ["traffic_volume"], "sensor_id", "reading_timestamp", "event_id")
    got = {r["event_id"]: r["traffic_volume"] for r in filled.collect()}
    assert got == {1: 4, 2: 4, 3: 4, 5: 8, 4: 4}


def test_iqr_is_sequential_and_empty_input(spark):
    rows = [(float(i), float(i)) for i in range(20)] + [(1000.0, 5.0), (5.0, 1000.0)]
    df = frame(spark, rows, "x double, y double")
    assert cleaning.iqr_filter(df, ["x", "y"]).count() == 20
    assert cleaning.iqr_filter(df.limit(0), ["x"]).count() == 0


def test_cdc_insert_delete_insert(spark, rows):
    target = frame(spark, [(1, "old"), (2, "stay"), (3, "gone")], "k int, v string")
    log = frame(
        spark,
        [("INSERT", 1, "a", 1), ("DELETE", 1, "a", 2), ("INSERT", 1, "b", 3), ("DELETE", 3, "x", 1), ("UPDATE", 4, "new", 1)],
        "operation string, k int, v string, seq int",
    )
    assert rows(changes.apply_changes(target, log, ["k"], ["seq"])) == [(1, "b"), (2, "stay"), (4, "new")]


def test_merge_is_idempotent(spark, rows):
    target = readings(spark, [("a", T0, 1, 1), ("b", T0, 2, 2)])
    source = readings(spark, [("a", T0, 9, 3), ("a", T0, 8, 4), ("c", T0, 5, 5), ("d", None, 5, 6)])
    once = tables.merge(target, source, ["sensor_id", "reading_timestamp"], ["event_id"])
    twice = tables.merge(once, source, ["sensor_id", "reading_timestamp"], ["event_id"])
    assert rows(once, "sensor_id", "traffic_volume") == [("a", 8), ("b", 2), ("c", 5)]
    assert rows(once) == rows(twice)


def test_incremental_on_empty_table(spark):
    df = readings(spark, [("a", T0, 1, 1)])
    assert tables.incremental(df, df.limit(0)).count() == 1
    assert tables.incremental(df, df).count() == 0
    assert tables.incremental(df, df, lookback="1 hour").count() == 1


def test_point_in_time_join_edges(spark):
    history = frame(
        spark,
        [("s", T0, 1, "r1", "c1"), ("s", T0 + timedelta(hours=1), 2, "r2", "c2"), ("s", T0 + timedelta(hours=1), 3, "r3", "c3")],
        "sensor_id string, updated_at timestamp_ntz, seq long, road_name string, city string",
    )
    times = [T0 - timedelta(seconds=1), T0, T0 + timedelta(minutes=59), T0 + timedelta(hours=1)]
    df = readings(spark, [("s", t, 1, i) for i, t in enumerate(times)] + [("none", T0, 1, 9)])
    got = {r["event_id"]: r["city"] for r in enrich.with_sensor_at(df, staging.scd2(history)).collect()}
    assert got == {0: None, 1: "c1", 2: "c1", 3: "c3", 9: None}


def test_three_calendars(spark):
    sunday = datetime(2024, 1, 14, 18, 0)
    df = readings(spark, [("s", sunday, 1, 1)])
    assert staging.stg_readings(df).first()["day_of_week"] == 0
    assert features.time_features_stream(df).first()["day_of_week"] == 1
    ml = features.time_features_ml(df).first()
    assert (ml["day_of_week"], ml["is_weekend"], ml["is_evening_rush"], ml["is_morning_rush"]) == (6, 1, 1, 0)
    assert ml["hour_sin"] == pytest.approx(math.sin(2 * math.pi * 18 / 24))


def test_staging_drops_bad_rows(spark):
    df = readings(spark, [("s", T0, 10000, 1), ("s", T0, 10001, 2), ("s", T0, -1, 3), ("s", None, 5, 4), (None, T0, 5, 5), ("s", T0, None, 6)])
    assert [r["event_id"] for r in staging.stg_readings(df).collect()] == [1]


def test_freshness_order_of_rules(spark):
    as_of = "2024-01-10 12:00:00"
    df = readings(spark, [("stale", T0 - timedelta(minutes=500), 1, 1), ("fresh", T0 - timedelta(minutes=5), 1, 2), ("old", T0 - timedelta(days=9), 1, 3)])
    day = {r["sensor_id"]: r["freshness_status"] for r in observability.freshness(df, as_of).collect()}
    assert day == {"stale": "stale", "fresh": "fresh"}
    night = {r["sensor_id"]: r["freshness_status"] for r in observability.freshness(df, "2024-01-10 23:00:00").collect()}
    assert night["stale"] == "critical"


def test_sensor_health_classes(spark):
    def series(name, values):
        return [(name, T0 - timedelta(hours=i), v, i) for i, v in enumerate(values)]

    rows = series("zero", [0] * 20 + [5] * 4) + series("high", [9000] * 4 + [100] * 20) + series("calm", [100] * 24)
    rows += series("wild", [0] * 12 + [1] * 11 + [500]) + series("few", [1] * 3)
    got = {r["sensor_id"]: r["health_status"] for r in observability.sensor_health(readings(spark, rows)).collect()}
    assert got == {"zero": "malfunctioning", "high": "suspicious", "calm": "healthy", "wild": "unstable"}


def test_anomaly_modes(spark):
    rows = [("s", datetime(2024, 1, d, h), 2, d * 100 + h) for d in range(1, 8) for h in range(2 if d < 7 else 6)]
    df = readings(spark, rows)
    literal = {r["traffic_date"].day: r["anomaly_type"] for r in observability.volume_anomalies(df).collect()}
    counted = {r["traffic_date"].day: r["anomaly_type"] for r in observability.volume_anomalies(df, mode="count").collect()}
    assert literal[1] == "insufficient_data" and literal[7] == "volume_spike"
    assert counted[6] == "normal" and counted[7] == "volume_spike"


def test_checks(spark):
    df = frame(spark, [("a", 1), ("a", 2), (None, 50)], "k string, v int")
    parent = frame(spark, [("b",)], "k string")
    suite = quality.run_checks(
        [
            quality.check_not_null(df, ["k", "v"]), quality.check_unique(df, ["k"]), quality.check_accepted_range(df, {"v": (1, 10)}),
            quality.check_accepted_values(df, {"k": ["b"]}), quality.check_relationship(df, parent, "k"),
        ]
    )
    got = {(r["check"], r["column"]): (r["violations"], r["passed"]) for r in suite.collect()}
    assert got == {
        ("not_null", "k"): (1, False), ("not_null", "v"): (0, True), ("unique", "k"): (1, False),
        ("accepted_range", "v"): (1, False), ("accepted_values", "k"): (2, False), ("relationship", "k"): (2, False),
    }
    empty = quality.check_relationship(df.limit(0), parent, "k").first()
    assert (empty["violations"], empty["passed"]) == (0, True)


def test_quality_gate_issues(spark):
    df = readings(spark, [("s", T0, -1, 1), ("s", T0, None, 2), ("s", T0 + timedelta(hours=1), 5, 3)])
    row = quality.quality_gate(df, "2024-01-10 12:30:00").first()
    assert row["issues"] == "Null volumes: 1; Negative volumes: 1; Future timestamps: 1; Low record count: 3"
    assert not row["passed"]


def test_late_rows(spark):
    df = readings(spark, [("s", T0, 1, 1), ("s", T0 - timedelta(hours=30), 1, 2), ("s", T0 - timedelta(hours=24), 1, 3)])
    found = late.late_arrivals(df, "2024-01-10 12:00:00").collect()
    assert [(r["event_id"], r["late_arrival_hours"]) for r in found] == [(2, 30.0)]
    merged = late.late_arrivals(df, "2024-01-10 12:00:00").withColumn("updated_at", F.lit(T0))
    assert late.late_stats(merged.limit(0), "2024-01-10 12:00:00").isEmpty()
    bands = late.late_stats(merged, "2024-01-10 12:00:00").collect()
    assert sorted((r["lateness"], r["readings"], r["sensors"], r["mean_hours"]) for r in bands) == [("all", 1, 1, 30.0), ("up to 2 days", 1, 1, 30.0)]


def test_cleanup_keeps_rows_on_time(spark):
    df = frame(
        spark,
        [(1, True, T0 - timedelta(days=40)), (2, True, T0), (3, None, T0 - timedelta(days=40)), (4, False, T0 - timedelta(days=40))],
        "id int, is_late_arrival boolean, updated_at timestamp_ntz",
    )
    assert sorted(r["id"] for r in late.late_cleanup(df, "2024-01-10 12:00:00").collect()) == [2, 3, 4]


def test_masks_and_rows_per_role(spark):
    df = frame(spark, [("sensor_12", 44.98, -93.27, "US"), ("sensor_13", 1.0, 2.0, "EU")], "sensor_id string, latitude double, longitude double, region string")
    masked = access.apply_masks(df, "TRAFFIC_ANALYST").first()
    assert (masked["sensor_id"], masked["latitude"], masked["longitude"]) == ("sen***", 45.0, -93.3)
    assert access.apply_masks(df, "TRAFFIC_ADMIN").first()["sensor_id"] == "sensor_12"
    counts = {role: access.apply_row_policy(df, role).count() for role in ("TRAFFIC_ADMIN", "TRAFFIC_ANALYST", "GUEST")}
    assert counts == {"TRAFFIC_ADMIN": 2, "TRAFFIC_ANALYST": 1, "GUEST": 0}
    access.publish_view(df, "readings", "TRAFFIC_ANALYST", "region")
    assert spark.table("readings_traffic_analyst").count() == 1


def test_type_normalise_matches_column_form(spark):
    names = ["INTEGER", "number(10,2)", " double ", "TIMESTAMP", "TIMESTAMP_NTZ", "VARCHAR2(5)", "string", "BOOLEAN"]
    expected = ["INT", "DECIMAL(10,2)", "FLOAT", "TIMESTAMP_NTZ", "TIMESTAMP_NTZ", "VARCHAR(5)", "VARCHAR", "BOOLEAN"]
    assert [schema.normalise(n) for n in names] == expected
    df = frame(spark, [(n,) for n in names], "t string")
    assert [r[0] for r in df.select(schema.normalised(F.col("t"))).collect()] == expected


def test_drift_kinds(spark, rows):
    contract = schema.contract_frame(spark, {"t": {"A": "INTEGER", "b": "VARCHAR(5)", "gone": "FLOAT"}})
    current = schema.observed_schema(frame(spark, [(1, 2.0, None)], "a int, b double, added string"), "t")
    assert rows(schema.drift(current, contract), "column_name", "change") == [("added", "new_column"), ("b", "type_change"), ("gone", "removed_column")]


def test_schema_compatibility(spark, rows):
    from pyspark.sql import types as S

    old = S.StructType([S.StructField("a", S.IntegerType(), True), S.StructField("b", S.StringType(), False), S.StructField("c", S.DoubleType())])
    new = S.StructType(
        [S.StructField("a", S.LongType(), True), S.StructField("c", S.IntegerType()), S.StructField("d", S.StringType(), False), S.StructField("e", S.StringType())]
    )
    problems = schema.compat(schema.schema_rows(spark, old), schema.schema_rows(spark, new))
    assert rows(problems, "column_name", "problem") == [("c", "type_not_readable"), ("d", "added_field_not_nullable")]
    assert schema.compat(schema.schema_rows(spark, old), schema.schema_rows(spark, old)).count() == 0


def test_lineage_with_cycle(spark, rows):
    links = frame(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y"), ("a", "d")], "src string, dst string")
    assert rows(lineage.impact(links, "a")) == [("b", 1), ("c", 2), ("d", 1)]
    sources, sinks = frame(spark, [("a",)], "id string"), frame(spark, [("d",), ("y",)], "id string")
    nodes = frame(spark, [(n, "view") for n in "abcdxy"], "id string, materialization string")
    assert rows(lineage.paths(links, nodes, sources, sinks)) == [("a", "d", "a > d", 2, False)]


def test_sequences_stay_inside_a_sensor(spark):
    rows = [("a", T0 + timedelta(hours=i), i, i) for i in range(5)] + [("b", T0 + timedelta(hours=i), 100 + i, 10 + i) for i in range(3)]
    got = windows.sequences(readings(spark, rows), ["traffic_volume"], "traffic_volume", n=3).collect()
    assert {r["event_id"]: ([s[0] for s in r["sequence"]], r["next_value"]) for r in got} == {3: ([0.0, 1.0, 2.0], 3), 4: ([1.0, 2.0, 3.0], 4)}


def test_scale_with_constant_column(spark):
    df = frame(spark, [(1.0, 5.0), (3.0, 5.0)], "x double, y double")
    assert sorted(tuple(r) for r in features.scale(df, ["x", "y"]).collect()) == [(-1.0, 0.0), (1.0, 0.0)]
    other = frame(spark, [(5.0, 6.0)], "x double, y double")
    assert tuple(features.scale(other, ["x", "y"], features.scale_stats(df, ["x", "y"])).first()) == (3.0, 1.0)


def test_metrics_skip_zero_actuals(spark):
    pred = frame(spark, [("m", "test", 0.0, 1.0), ("m", "test", 2.0, 1.0)], "model_name string, split string, actual double, predicted double")
    row = forecast.evaluate(pred).first()
    assert (row["mae"], row["mse"], row["rmse"], row["mape"], row["r2"]) == (1.0, 1.0, 1.0, 50.0, 0.0)


def test_best_model_and_alert(spark):
    scores = frame(spark, [("a", 60.0, 0.5), ("b", 55.0, 0.9), ("c", 55.0, 0.1)], "model_name string, rmse double, r2 double")
    assert tuple(forecast.best(scores).first()) == ("b", 55.0)
    assert forecast.best(scores, "r2").first()["model_name"] == "b"
    assert forecast.rmse_alert(scores).count() == 1 and forecast.rmse_alert(scores, 55.0).count() == 0


def test_ensemble_with_given_weights(spark):
    pred = frame(spark, [(1, "a", 10.0), (1, "b", 20.0)], "id int, model_name string, predicted double")
    scores = frame(spark, [("a", 2.0), ("b", 2.0)], "model_name string, rmse double")
    assert forecast.ensemble(pred, ["id"], forecast.inverse_rmse(scores)).first()["ensemble_prediction"] == 15.0
    weighted = forecast.inverse_rmse(scores, {"a": 1.5})
    assert forecast.ensemble(pred, ["id"], weighted).first()["ensemble_prediction"] == 12.5


def test_forecast_steps(spark):
    df = frame(spark, [("s", T0, 100.0, 10.0)], "sensor_id string, reading_timestamp timestamp_ntz, prediction double, residual_std double")
    got = forecast.forecast(df, hours=1).orderBy("forecast_time").collect()
    assert [r["forecast_time"] for r in got] == [T0 + timedelta(minutes=15 * i) for i in range(1, 5)]
    assert (got[0]["lower_bound"], got[0]["upper_bound"]) == (80.4, 119.6)


def test_models_learn_and_persist(spark, tmp_path):
    df = spark.range(400).select(
        F.col("id"), (F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("z"), F.lit(1.0).alias("constant"),
        (3 * (F.col("id") % 20) - 2 * (F.col("id") % 7) + 5).cast("double").alias("y"),
    )
    train, test = forecast.split(df, 0.2, key=["id"])
    assert train.count() + test.count() == 400 and 40 < test.count() < 120
    params = {"forest": {"numTrees": 5}, "gbt": {"maxIter": 5}}
    for kind in ("ridge", "lasso", "linear", "forest", "gbt"):
        model = forecast.fit(train, kind, ["x", "z", "constant"], "y", **params.get(kind, {}))
        pred = forecast.predict(model, test, kind, ["id"], "y").withColumn("split", F.lit("test"))
        row = forecast.evaluate(pred).first()
        assert row["r2"] > 0.8, kind
        forecast.save(model, str(tmp_path / kind))
        again = forecast.load(str(tmp_path / kind))
        assert forecast.model_features(again) == ["x", "z", "constant"]
        second = forecast.predict(again, test, kind, ["id"], "y").collect()
        assert sorted(second) == sorted(pred.drop("split").collect())


def test_split_by_time(spark):
    df = readings(spark, [("s", T0 + timedelta(hours=i), 1, i) for i in range(11)])
    train, test = forecast.split(df, 0.2, mode="time")
    assert train.count() == 9 and sorted(r["event_id"] for r in test.collect()) == [9, 10]


def test_prepare_without_leak(spark):
    rows = [("s", T0 + timedelta(hours=i), 10 + i, i) for i in range(8)]
    df = readings(spark, rows).withColumn("speed_mph", F.lit(30.0) + F.col("event_id") % 3)
    out = features.prepare(df, lag_periods=[1], rolling_windows=[2], exclude_current=True).orderBy("event_id").first()
    assert out["traffic_volume_rolling_max_2"] < out["traffic_volume"]


def test_required_columns_and_failed_sources(spark):
    df = readings(spark, [("s", T0, 1, 1)])
    with pytest.raises(ValueError, match="missing"):
        readers.require_columns(df, ["sensor_id", "nope"])

    def broken(start, end):
        raise OSError("down")

    got = readers.collect_sources({"a": lambda s, e: df, "b": broken}, None, None, "reading_timestamp")
    assert got.first()["source"] == "a"
    with pytest.raises(ValueError, match="no source"):
        readers.collect_sources({"b": broken}, None, None)


def test_marts_on_empty_input(spark, data):
    from roadpulse.plans.base import hourly

    empty = hourly(spark, data).limit(0)
    assert marts.mart_daily_summary(empty).count() == 0
    assert marts.mart_congestion(empty).count() == 0


def test_top_k_ties(spark):
    df = frame(spark, [("b", 1), ("a", 1), ("c", 0)], "k string, v int")
    assert [r["k"] for r in reports.top_k(df, "v", "k", 2).collect()] == ["a", "b"]


def test_merge_keeps_columns_of_the_target_and_adds_null_keys(spark, rows):
    schema_ = "sensor_id string, t timestamp_ntz, v int"
    moment = datetime(2024, 1, 1)
    target = frame(spark, [("a", moment, 1, "keepme"), ("b", moment, 2, "too"), (None, moment, 3, "null")], f"{schema_}, city string")
    source = frame(spark, [("a", moment, 10), (None, moment, 30), ("c", None, 40), ("d", moment, 50)], schema_)
    merged = tables.merge(target, source, ["sensor_id", "t"], ["v"])
    assert merged.columns == target.columns
    assert rows(merged, "sensor_id", "v", "city") == sorted(
        [("a", 10, "keepme"), ("b", 2, "too"), (None, 3, "null"), (None, 30, None), ("d", 50, None)], key=repr
    )


def test_drift_of_empty_and_all_null_tables(spark):
    contract = schema.contract_frame(spark, {"t": {"a": "INTEGER", "b": "DECIMAL(10,6)"}})
    for df in (frame(spark, [], "a int, b decimal(10,6)"), frame(spark, [(None, None)], "a int, b decimal(10,6)")):
        assert schema.drift(schema.observed_schema(df, "t"), contract).isEmpty()
    narrower = schema.observed_schema(frame(spark, [], "a int, b decimal(5,2)"), "t")
    assert [r["change"] for r in schema.drift(narrower, contract).collect()] == ["type_change"]
    complete = schema.column_completeness(frame(spark, [(1, None), (2, 3)], "a int, b int"), "t")
    assert {r["column_name"]: r["null_rows"] for r in complete.collect()} == {"a": 0, "b": 1}


def test_ensemble_leaves_out_missing_predictions(spark):
    pred = frame(spark, [(1, "x", 10.0), (1, "y", None), (2, "x", None), (2, "y", None)], "k int, model_name string, predicted double")
    weights = frame(spark, [("x", 1.0), ("y", 1.0)], "model_name string, weight double")
    assert {r["k"]: r["ensemble_prediction"] for r in forecast.ensemble(pred, ["k"], weights).collect()} == {1: 10.0, 2: None}
    exact = forecast.inverse_rmse(frame(spark, [("x", 0.0), ("y", 2.0)], "model_name string, rmse double"))
    assert {r["model_name"]: r["weight"] for r in exact.collect()}["y"] == 0.5


def test_predictions_keep_rows_without_features(spark, rows):
    df = frame(spark, [(k, float(k), 2.0 * k) for k in range(20)] + [(99, None, 5.0)], "k int, x double, traffic_volume double")
    model = forecast.fit(df, "linear", ["x"])
    found = {r["k"]: r["predicted"] for r in forecast.predict(model, df, "linear", ["k"]).collect()}
    assert len(found) == 21 and found[99] is None and abs(found[7] - 14) < 1e-6


def test_null_sensor_has_no_version(spark):
    versions = frame(spark, [(None, datetime(2023, 1, 1), datetime(9999, 12, 31), "X", 1)], "sensor_id string, valid_from timestamp_ntz, valid_to timestamp_ntz, city string, seq int")
    readings = frame(spark, [(None, datetime(2024, 1, 1), 1)], "sensor_id string, reading_timestamp timestamp_ntz, event_id long")
    assert enrich.with_sensor_at(readings, versions).first()["city"] is None


def test_uneven_graph_with_cycle_and_diamond(spark, rows):
    edges = [("s", "a"), ("s", "b"), ("a", "c"), ("b", "c"), ("c", "d"), ("d", "a"), ("s", "z"), ("d", "z")]
    links = frame(spark, edges, "src string, dst string")
    assert rows(lineage.impact(links, "s")) == [("a", 1), ("b", 1), ("c", 2), ("d", 3), ("z", 1)]
    ids = frame(spark, [("s",)], "id string"), frame(spark, [("z",), ("d",)], "id string")
    nodes = frame(spark, [("b", "table"), ("z", "table")] + [(n, "view") for n in "sacd"], "id string, materialization string")
    # The path to d goes by a, the smaller of two, so the table b isn't on it; z is a table itself.
    assert [tuple(r) for r in lineage.paths(links, nodes, *ids).orderBy("dst").collect()] == [("s", "d", "s > a > c > d", 4, False), ("s", "z", "s > z", 2, True)]
    assert rows(lineage.paths(links, nodes, *ids, k=1), "dst") == [("z",)]
    assert lineage.paths(links.limit(0), nodes, *ids).count() == 0
    chain = frame(spark, [(f"n{k:03d}", f"n{k + 1:03d}") for k in range(12)], "src string, dst string")
    assert max(r["hops"] for r in lineage.impact(chain, "n000").collect()) == 12


def test_feeds_without_event_id_chain(spark):
    moment = datetime(2024, 1, 1, 8)
    raw = frame(spark, [("a", moment, 100, 30.0, 5.0), ("a", moment, 120, 30.0, 5.0)], "sensor_id string, timestamp timestamp, traffic_volume int, speed_mph double, occupancy_pct double")
    wx = frame(spark, [(moment, 50.0, 40.0, 5.0, "Clear", 10.0, None, None)], "timestamp timestamp, temp_fahrenheit double, humidity_pct double, wind_speed_mph double, weather_main string, visibility_miles double, rain_1h_mm double, snow_1h_mm double")
    holidays = frame(spark, [], "date date, name string")
    history = frame(spark, [("a", datetime(2023, 1, 1), 1, "R", "C")], "sensor_id string, updated_at timestamp_ntz, seq int, road_name string, city string")
    made = enrich.int_enriched(staging.stg_readings(raw), staging.stg_weather(wx), staging.stg_holidays(holidays), staging.scd2(history))
    row = made.first()
    assert made.count() == 1 and row["weather_main"] == "Clear" and row["city"] == "C"


def test_models_prepare_and_read_the_rows_once(spark, data, monkeypatch):
    calls, whole = [], models.prepared

    def counted(*args):
        calls.append(args)
        return whole(*args)

    monkeypatch.setattr(models, "prepared", counted)
    # Ten trees are enough here.
    monkeypatch.setattr(forecast, "TREES", 10)
    found = models.beaten("forest")(spark, data)
    assert len(calls) == 1 and {r["split"] for r in found.collect()} == {"train", "test"}
    df = frame(spark, [(i, float(i % 7), float(i % 3), 5.0, float(i % 7) * 2) for i in range(60)], "id long, x double, z double, constant double, y double")
    model = forecast.fit(df, "forest", ["x", "z", "constant"], "y", numTrees=3, maxDepth=3)
    assert model.stages[-1].numFeatures == 2  # no tree counts rows under a constant
    plan = forecast.predict(model, df, "forest", ["id"], "y")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
