"""The forest against Spark's own trees, and the rules of its bags and thresholds."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from roadpulse.operators import forecast, forest

FEATURES = ["flag", "day", "many", "constant"]


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("forest") / "rows")
    noise = {name: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(n)) for k, (name, n) in enumerate({"flag": 2, "day": 7, "many": 30, "extra": 20}.items())}
    df = spark.range(3000).select("id", *[column.cast("double").alias(name) for name, column in noise.items()], F.lit(3.0).alias("constant"))
    df.withColumn("y", F.col("day") * 10 + F.col("many") * F.col("flag") + F.col("extra")).repartition(6).write.parquet(path)
    return spark.read.parquet(path)


def shape(model):
    """Splits of the trees, without what the leaves say."""
    return [line for line in model.toDebugString.split("\n")[1:] if "Predict" not in line]


def test_tree_without_bags_is_that_of_spark(spark, rows, monkeypatch):
    monkeypatch.setattr(forest, "PART_ROWS", 700)  # several parts
    params = {"numTrees": 1, "maxDepth": 7, "bootstrap": False}
    model = forecast.fit(rows, "forest", FEATURES, "y", **params)
    ready = PipelineModel(model.stages[:2]).transform(rows)
    theirs = forecast.estimator("forest", 0, "y", "varying", **params).fit(ready)
    assert shape(model.stages[-1]) == shape(theirs) and theirs.totalNumNodes > 50
    both = theirs.transform(ready).select("id", F.col("prediction").alias("told")).join(forecast.predict(model, rows, "forest", ["id"], "y"), "id")
    assert both.filter(F.abs(F.col("told") - F.col("predicted")) < 1e-9).count() == 3000
    assert np.allclose(model.stages[-1].featureImportances.toArray(), theirs.featureImportances.toArray())


def test_all_rows_stay_out_of_sparks_fit(rows, monkeypatch):
    # Spark's fit passes over the rows for each few nodes; it may only see the two rows that its parameters are taken from.
    seen, whole = [], RandomForestRegressor._fit

    def counted(self, df):
        seen.append(df.count())
        return whole(self, df)

    monkeypatch.setattr(RandomForestRegressor, "_fit", counted)
    model = forecast.fit(rows, "forest", FEATURES, "y", numTrees=4, maxDepth=3)
    assert seen == [2] and len(model.stages[-1].trees) == 4
    forecast.fit(rows, "forest", FEATURES, "y", numTrees=2, maxDepth=2, subsamplingRate=0.5)
    assert seen == [2, 3000]  # a parameter that only Spark knows


def test_forest_is_as_good_as_that_of_spark(rows):
    model = forecast.fit(rows, "forest", FEATURES, "y", numTrees=20, maxDepth=5)
    ready = PipelineModel(model.stages[:2]).transform(rows)
    theirs = forecast.estimator("forest", 0, "y", "varying", numTrees=20, maxDepth=5).fit(ready)
    error = [m.transform(ready).agg(F.avg((F.col("prediction") - F.col("y")) ** 2)).first()[0] for m in (model.stages[-1], theirs)]
    assert abs(error[0] / error[1] - 1) < 0.05
    assert len({t.toDebugString.split("\n", 1)[1] for t in model.stages[-1].trees}) == 20


def test_prediction_is_that_of_the_model(rows):
    model = forecast.fit(rows, "forest", FEATURES, "y", numTrees=5, maxDepth=4)
    gaps = rows.withColumn("day", F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 10 == 1, float("nan")).otherwise(F.col("day")))
    told = forecast.predict(model, gaps, "forest", ["id"], "y")
    theirs = model.transform(rows).select("id", F.col("prediction").alias("whole"))
    both = told.join(theirs, "id")
    assert both.filter("predicted is null").count() == both.filter("id % 10 < 2").count() == 600
    assert both.filter("predicted = whole").count() == 2400


def test_equal_labels_make_one_leaf(rows):
    model = forecast.fit(rows.withColumn("y", F.lit(0.1)), "forest", FEATURES, "y", numTrees=3, maxDepth=4)
    assert model.stages[-1].totalNumNodes == 3
    assert {round(r["predicted"], 12) for r in forecast.predict(model, rows, "forest", ["id"], "y").collect()} == {0.1}


def test_bags_are_poisson_and_come_again():
    times = forest._draws(42, 3, 7, 400_000)
    assert (times == forest._draws(42, 3, 7, 400_000)).all() and (times != forest._draws(42, 4, 7, 400_000)).any()
    share = np.bincount(times, minlength=5) / len(times)
    assert np.allclose(share[:5], [0.36788, 0.36788, 0.18394, 0.06131, 0.01533], atol=0.004) and times.max() < 12


def test_joint_counts_are_those_of_each_feature():
    random = np.random.default_rng(1)
    sizes = [5, 2, 32, 7, 32]
    bins, node, weight = np.stack([random.integers(0, s, 500) for s in sizes], axis=1).astype(np.uint8), random.integers(0, 3, 500), random.random(500)
    for most in (32, 64, 1024, 32_768):
        groups, found = forest._grouped(sizes, most), np.zeros((3, 5, 32))
        assert sorted(f for g in groups for f in g) == [0, 1, 2, 3, 4]
        for members, code in zip(groups, forest._codes(bins, sizes, groups, most), strict=True):
            forest._spread(np.bincount(node * most + code, weight, 3 * most), most, members, sizes, found)
        for f in range(5):
            assert np.allclose(found[:, f], np.bincount(node * 32 + bins[:, f], weight, 96).reshape(3, 32))


def test_thresholds():
    values = np.array([1.0, 2.0, 4.0])
    assert forest._cuts(values, np.array([5, 1, 1]), 31).tolist() == [1.5, 3.0]
    assert forest._cuts(np.arange(100.0), np.ones(100), 3).tolist() == [24.5, 49.5, 74.5]
    points, counts = forest._points(np.arange(10_000.0), np.ones(10_000), 1024)
    assert len(points) == 1024 and counts.sum() == 10_000
