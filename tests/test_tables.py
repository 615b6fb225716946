"""Increments of the hourly table, layouts and linear models."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.operators import enrich, forecast, increments, layout, linear, marts
from roadpulse.plans.base import hourly, sensor_versions, staged, staged_holidays, staged_weather
from roadpulse.session import work_folder


def side(spark, data):
    return staged_weather(spark, data), staged_holidays(spark, data), sensor_versions(spark, data)


def files(path):
    return {(f.parent.name, f.name) for f in path.glob("traffic_date=*/part-*")}


def test_increments_equal_a_full_build(spark, data, tmp_path):
    """In order, then late rows of two weeks ago, then a repetition of rows the table has."""
    path, rows, seen = tmp_path / "hourly", staged(spark, data), F.col("reading_timestamp")
    edge = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    late = (seen < F.lit("2024-01-08 00:00:00").cast("timestamp_ntz")) & (F.col("event_id") % 17 == 0)
    increments.write_hourly(enrich.int_enriched(rows.filter((seen < edge) & ~late), *side(spark, data)), str(path))
    before = files(path)
    days = increments.update_hourly(spark, str(path), rows.filter(seen >= edge), *side(spark, data))
    assert min(days).isoformat() == "2024-01-20"
    # Days that no window of a new reading reaches keep their files.
    kept = {file for file in files(path) if file[0] < "traffic_date=2024-01-19"}
    assert kept and kept <= before
    late_days = increments.update_hourly(spark, str(path), rows.filter(late), *side(spark, data))
    assert min(late_days).isoformat() < "2024-01-08"
    assert increments.update_hourly(spark, str(path), rows.filter((seen >= edge) & (F.col("event_id") % 5 == 0)), *side(spark, data)) == []
    assert increments.update_hourly(spark, str(path), rows.limit(0), *side(spark, data)) == []
    whole = hourly(spark, data)
    built = increments.read_hourly(spark, str(path)).select(*whole.columns)
    assert built.count() == whole.count()
    assert built.exceptAll(whole).isEmpty() and whole.exceptAll(built).isEmpty()


def test_an_update_joins_only_the_rows_it_reaches(spark, data, tmp_path, monkeypatch):
    path, rows, seen = str(tmp_path / "hourly"), staged(spark, data), F.col("reading_timestamp")
    edge = F.lit("2024-01-29 00:00:00").cast("timestamp_ntz")
    increments.write_hourly(enrich.int_enriched(rows.filter(seen < edge), *side(spark, data)), path)
    joined, join = [], enrich.nearest_join

    def counted(df, *args, **kwargs):
        joined.append(df.count())
        return join(df, *args, **kwargs)

    monkeypatch.setattr(enrich, "nearest_join", counted)
    fresh = rows.filter(seen >= edge)
    increments.update_hourly(spark, path, fresh, *side(spark, data))
    assert joined == [fresh.count()]  # no reading of the table comes after the new ones


def test_daily_marts_follow_the_replaced_days(spark, data, tmp_path):
    path, mart, rows = str(tmp_path / "hourly"), str(tmp_path / "mart"), staged(spark, data)
    edge = F.lit("2024-01-25 12:00:00").cast("timestamp_ntz")
    seen = F.col("reading_timestamp")
    increments.write_hourly(enrich.int_enriched(rows.filter(seen < edge), *side(spark, data)), path)
    increments.write_daily(spark, path, mart, marts.mart_daily_summary)
    before = files(tmp_path / "mart")
    days = increments.update_hourly(spark, path, rows.filter(seen >= edge), *side(spark, data))
    increments.write_daily(spark, path, mart, marts.mart_daily_summary, days)
    whole = marts.mart_daily_summary(hourly(spark, data))
    built = spark.read.parquet(mart).select(*whole.columns)
    assert built.exceptAll(whole).isEmpty() and whole.exceptAll(built).isEmpty()
    assert len(before & files(tmp_path / "mart")) >= 20


def test_morton_key_interleaves(spark):
    df = spark.range(1).select(layout.interleaved([F.lit(0b101), F.lit(0b011)], 3).alias("key"))
    assert df.first()["key"] == 0b100111


def test_morton_cells_hold_equal_shares(spark):
    df = spark.range(4096).select((F.col("id") ** 5).alias("x"), F.lit(None).cast("double").alias("y"), F.format_string("k%05d", "id").alias("s"))
    keyed = layout.with_morton_key(df, ["x", "s"], bits=3)
    assert keyed.columns == [*df.columns, "__morton"]
    counts = [r["count"] for r in keyed.groupBy("__morton").count().collect()]
    # Both columns rise together, so the cells lie on the diagonal.
    assert len(counts) in (8, 9, 10, 11, 12) and sum(counts) == 4096
    assert layout.with_morton_key(df, ["y"], bits=3).select("__morton").distinct().collect() == [(0,)]
    with pytest.raises(ValueError):
        layout.with_morton_key(df, ["x"] * 8, bits=8)


def test_morton_files_are_boxes(spark):
    df = spark.range(20_000).select((F.rand(1) * 100).alias("x"), (F.rand(2) * 100).alias("y"))
    boxes = {"x": {"x": (10.0, 12.0)}, "y": {"y": (10.0, 12.0)}, "both": {"x": (40.0, 45.0), "y": (70.0, 75.0)}}
    met = {}
    for name, laid in (("plain", df.repartitionByRange(16, "x")), ("morton", layout.compact_morton(df, ["x", "y"], 16)), ("none", df.repartition(16))):
        path = work_folder(spark)
        laid.write.parquet(path)
        assert spark.read.parquet(path).count() == 20_000
        met[name] = {r["box"]: r["files"] for r in layout.files_met(layout.file_bounds(spark, path, ["x", "y"]), boxes).collect()}
    assert met["plain"]["y"] == 16 and met["morton"]["y"] <= 8 and met["morton"]["x"] <= 8 and met["morton"]["both"] <= 4
    assert set(met["none"].values()) == {16}


@pytest.fixture(scope="module")
def plane(spark):
    draw = np.random.default_rng(3)
    x = draw.normal([2024.0, 5.0, -93.2], [0.5, 10.0, 0.01], (3000, 3))
    y = 4 * x[:, 0] - 0.5 * x[:, 1] + 30 * x[:, 2] + draw.normal(0, 2, 3000)
    rows = [(k, *map(float, r), float(t)) for k, (r, t) in enumerate(zip(x, y, strict=True))]
    rows += [(9001, None, 1.0, 1.0, 5.0), (9002, 1.0, 1.0, 1.0, None)]
    return spark.createDataFrame(rows, "k long, a double, b double, c double, y double").repartition(5)


@pytest.mark.parametrize("kind", ["linear", "ridge", "lasso"])
def test_sums_of_products_agree_with_the_library(plane, kind):
    ours = linear.fit(plane, kind, ["a", "b", "c"], "y", 1.0)
    library = forecast.fit(plane, kind, ["a", "b", "c"], "y", tol=1e-12, maxIter=500).stages[-1]
    assert ours.coefficients == pytest.approx(list(library.coefficients), rel=1e-3, abs=1e-6)
    assert ours.intercept == pytest.approx(library.intercept, rel=1e-3)
    found = plane.withColumn("p", ours.column())
    assert found.filter("a is null and p is not null").isEmpty()
    error = found.agg(F.avg(F.pow(F.col("y") - F.col("p"), 2))).first()[0]
    assert error < (6 if kind != "lasso" else 20)


def test_equal_and_constant_columns(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("a"), F.col("id").cast("double").alias("b"), F.lit(3.0).alias("c"), (F.col("id") * 2.0).alias("y"))
    for kind in ("linear", "ridge", "lasso"):
        found = linear.fit(df, kind, ["a", "b", "c"], "y", 0.001)
        assert abs(sum(found.coefficients[:2]) - 2) < 0.01 and abs(found.coefficients[2]) < 1e-6
    with pytest.raises(ValueError):
        linear.fit(df.limit(0), "linear", ["a"], "y")
    with pytest.raises(ValueError):
        linear.fit(df, "cubic", ["a"], "y")


def test_models_of_one_pass(plane):
    both = linear.fit_all(plane, ["linear", "ridge"], ["a", "b"], "y", 100.0)
    assert both["linear"] == linear.fit(plane, "linear", ["a", "b"], "y") and both["ridge"] != both["linear"]
