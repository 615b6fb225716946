"""The paths for oversized keys give what the plain paths give."""

import math

import pytest
from compare import database, difference
from pyspark.sql import functions as F

from roadpulse.functions import ordered
from roadpulse.functions.quantiles import exact_quantiles
from roadpulse.functions.sizing import GroupLoad, group_load
from roadpulse.plans import registry

# Queries whose operators have a second path, with one of their keys holding many rows.
SPLIT = [
    "scd2_versions", "rolling_rows", "pct_change", "lag_features", "rolling_features", "sequence_windows", "label_encode",
    "int_enriched", "fill_missing", "iqr_outliers", "join_scd2_point_in_time", "prepare_features", "mart_daily_summary",
]


@pytest.mark.parametrize("key", SPLIT)
def test_split_path_matches_sql(spark, data, split_groups, key):
    assert difference(spark, database(data), registry.QUERIES[key], registry.ORACLES[key], data) is None


def _line(spark, n=200):
    """One key with two thirds of the rows, times that repeat, values with gaps."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).otherwise("hot").alias("k"),
        F.floor(F.col("id") / 4).alias("t"),
        F.col("id"),
        F.when(F.col("id") % 5 == 0, F.col("id") * 10).alias("v"),
    )


def _measures(w):
    return {
        "back": F.sum("id").over(w.rowsBetween(-3, 0)),
        "ahead": F.lead("id", 2).over(w),
        "listed": F.collect_list("id").over(w.rowsBetween(-2, 1)),
    }


def test_windows_over_block_borders(spark, rows, split_groups):
    df, order = _line(spark), [F.col("t"), F.col("id")]
    split = ordered.with_windows(df, ["k"], order, _measures, before=3, after=2)
    plain = ordered.with_windows(df, ["k"], order, _measures, load=GroupLoad(0, 0, 1))
    assert rows(split) == rows(plain.select(*split.columns))
    assert split.count() == 200


def test_carry_over_many_blocks(spark, rows):
    df = _line(spark).withColumn("v", F.when(F.col("id").isin(1, 150), F.col("id")))

    def carried():
        found = ordered.carry(df, ["k"], [F.col("t"), F.col("id")], {"last": F.col("v")}, {"next": F.col("v")})
        return rows(found, "k", "id", "last", "next")

    plain = carried()
    tiny = {"maxGroupRows": 3, "blockRows": 5}
    for name, value in tiny.items():
        spark.conf.set(f"roadpulse.{name}", str(value))
    try:
        split = carried()
    finally:
        for name in tiny:
            spark.conf.unset(f"roadpulse.{name}")
    assert split == plain and len(split) == 200


def test_numbering_is_dense_and_ordered(spark):
    df = _line(spark).repartition(6)
    numbered = ordered.number_rows(df, [F.col("k"), F.col("t"), F.col("id")]).orderBy("__index").collect()
    assert [r["__index"] for r in numbered] == list(range(200))
    assert [(r["k"], r["t"], r["id"]) for r in numbered] == sorted((r["k"], r["t"], r["id"]) for r in numbered)


@pytest.mark.parametrize("values", [[1.0], [1, 2], [5] * 50, [-3.5, 0, 0, 1e9, 1e-9], list(range(1001)), [0.1 * i * i for i in range(500)]])
def test_narrowed_quantiles_are_exact(spark, split_groups, values):
    import numpy as np

    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    probabilities = [0.0, 0.25, 0.5, 0.9, 1.0]
    found = exact_quantiles(df, {"x": probabilities})["x"]
    assert found == pytest.approx(list(np.quantile(values, probabilities)), rel=1e-12)


@pytest.mark.parametrize(("rows", "sketch"), [(200_000, 4096), (50, 16), (1, 8)])
def test_quantiles_of_skewed_columns(spark, rows, sketch):
    """Many repeats, a heavy tail and infinities; two columns at once; brackets that must be sketched again."""
    import numpy as np

    draw = np.random.default_rng(5)
    heavy = np.concatenate([np.full(3000, 7.0), draw.lognormal(0, 3, 2000), [-np.inf] * 20, [np.inf] * 30])
    even = draw.normal(1e9, 1e-3, len(heavy))
    df = spark.createDataFrame(list(zip(heavy.tolist(), even.tolist(), strict=True)), "x double, y double")
    spark.conf.set("roadpulse.quantileRows", str(rows))
    spark.conf.set("roadpulse.quantileSketch", str(sketch))
    try:
        probabilities = [0.0, 0.1, 0.25, 0.5, 0.733, 0.75, 0.99, 1.0]
        found = exact_quantiles(df, {"x": probabilities, "y": probabilities})
    finally:
        spark.conf.unset("roadpulse.quantileRows")
        spark.conf.unset("roadpulse.quantileSketch")
    with np.errstate(invalid="ignore"):
        assert found["x"][1:-1] == pytest.approx(list(np.quantile(heavy, probabilities))[1:-1], rel=1e-12)
    assert found["x"][0] == -np.inf and found["x"][-1] == np.inf
    assert found["y"] == pytest.approx(list(np.quantile(even, probabilities)), rel=1e-15)


def test_quantiles_between_neighbouring_doubles(spark, monkeypatch):
    """No double lies between the two values, and their middle is rounded to the upper one."""
    from roadpulse.functions import quantiles

    low = math.nextafter(1.0, 2.0)
    high = math.nextafter(low, 2.0)
    assert low / 2 + high / 2 == high
    passes = []
    run = quantiles._counted

    def counted(*args):
        passes.append(1)
        assert len(passes) < 9, "the same zone is halved again and again"
        return run(*args)

    monkeypatch.setattr(quantiles, "_counted", counted)
    monkeypatch.setattr(quantiles, "ROWS", 1)
    monkeypatch.setattr(quantiles, "SKETCH", 8)
    df = spark.createDataFrame([(v,) for v in [low, low, high, high]], "x double")
    assert exact_quantiles(df, {"x": [0.0, 1 / 3, 2 / 3, 1.0]})["x"] == [low, low, high, high]


def test_quantiles_take_two_passes(spark, monkeypatch):
    from roadpulse.functions import quantiles

    passes = []
    for name in ("_counted", "_collected"):
        run = getattr(quantiles, name)
        monkeypatch.setattr(quantiles, name, lambda *args, run=run, name=name: passes.append(name) or run(*args))
    df = spark.range(50_000).selectExpr("CASE WHEN id % 3 = 0 THEN 5.0D ELSE id * id * 1.0D END AS x", "sqrt(id) AS y")
    found = quantiles.exact_quantiles(df, {"x": [0.25, 0.75], "y": [0.5]})
    assert passes == ["_counted", "_collected"]
    assert found["y"] == [pytest.approx((24_999**0.5 + 25_000**0.5) / 2)]


def test_quantiles_without_values(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(df, {"x": [0.5]})["x"] == [None]


def test_load_of_the_largest_key(spark, split_groups):
    load = group_load(_line(spark), ["k"])
    assert (load.rows, load.largest, load.hot) == (200, 133, True)
    assert group_load(_line(spark).limit(0), ["k"]).hot is False


def test_only_hot_keys_are_split(spark, rows):
    df = _line(spark)
    load = group_load(df, ["k"])
    assert not load.hot
    half = GroupLoad(load.rows, load.largest, load.largest - 1, load.sizes)
    bounded, hot = ordered._parted(df, ["k"], half)
    assert hot.select("k").distinct().count() == 1 and bounded.count() + hot.count() == load.rows


@pytest.mark.parametrize("values", [[1, 2, float("inf")], [-float("inf"), 0, float("inf")], [-1e308, 1e308, 0, 5], [1, float("nan"), 2], [5e-324, 0.0, 1e-320]])
def test_quantiles_of_extreme_values(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    order = sorted(values, key=lambda v: (math.isnan(v), v))
    steps = len(order) - 1
    got = exact_quantiles(df, {"x": [k / steps for k in range(steps + 1)]})["x"]
    assert [repr(v) for v in got] == [repr(float(v)) for v in order]


def test_running_sums_over_blocks(spark, rows):
    df = _line(spark).withColumn("v", F.col("id").cast("decimal(38,6)")).select("k", "t", "id", "v")
    order = [F.col("t"), F.col("id")]
    plain = rows(ordered.running_sums(df, ["k"], order, ["v"]))
    for name, value in {"maxGroupRows": 100, "blockRows": 7}.items():
        spark.conf.set(f"roadpulse.{name}", str(value))
    try:
        split = rows(ordered.running_sums(df, ["k"], order, ["v"]))
    finally:
        for name in ("maxGroupRows", "blockRows"):
            spark.conf.unset(f"roadpulse.{name}")
    assert split == plain and len(split) == 200
