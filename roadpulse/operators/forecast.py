"""Splits, regression models, evaluation, ensembles and forecast grids."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VarianceThresholdSelector, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.columns import tie
from roadpulse.functions.ordered import keep_first
from roadpulse.functions.quantiles import exact_quantiles
from roadpulse.operators import forest, linear
from roadpulse.session import cut_lineage

LINEAR = ("ridge", "lasso", "linear")
# Settings of the models.
SEED = 42
ALPHA = 1.0
TREES, TREE_DEPTH = 100, 10
# Histograms of nodes that a pass fills at once; more than a cache holds slow down every row, the trees are the same.
FOREST_MB = 32
BOOST_ROUNDS, BOOST_DEPTH, BOOST_RATE = 100, 6, 0.1
ERROR_METRICS = ("mae", "mse", "rmse", "mape")
RMSE_LIMIT = 50.0
LEAST_RMSE = 1e-9
BAND = 1.96


def split(df: DataFrame, test_size: float = 0.2, mode: str = "random", key: list[str] | None = None, ts_col: str = "reading_timestamp"):
    """(train, test). Random rows by a hash of the key, or `mode='time'` with the latest rows as test."""
    if mode == "time":
        seconds = F.unix_timestamp(F.col(ts_col).cast("timestamp"))
        cut = exact_quantiles(df.withColumn("__t", seconds), {"__t": [1 - test_size]})["__t"][0]
        return df.filter(seconds <= cut), df.filter(seconds > cut)
    inside = in_training(test_size, key or ["sensor_id", ts_col])
    return df.filter(inside), df.filter(~inside)


def in_training(test_size: float = 0.2, key: tuple[str, ...] | list[str] = ("sensor_id", "reading_timestamp")) -> Column:
    """Whether a row is one of the training rows of the random split."""
    # A hash that other engines have too.
    mark = F.concat_ws("|", F.lit(str(SEED)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])
    place = F.conv(F.substring(F.md5(mark), 1, 8), 16, 10).cast("long") % 10_000
    return place < round((1 - test_size) * 10_000)


def estimator(kind: str, rows: int, label: str, features: str = "features", spread: float = 1.0, **params):
    """Model by name.

    Spark averages the loss and fits a label divided by its deviation, so ridge divides its
    penalty by the rows and multiplies it by that `spread`; lasso needs neither.
    """
    common = {"featuresCol": features, "labelCol": label, "predictionCol": "prediction"}
    if kind in LINEAR:
        penalty = {"ridge": ALPHA * spread / max(rows, 1), "lasso": ALPHA, "linear": 0.0}[kind]
        l1_share = 1.0 if kind == "lasso" else 0.0
        return LinearRegression(regParam=penalty, elasticNetParam=l1_share, standardization=False, **{**common, **params})
    if kind == "forest":
        forest = {"numTrees": TREES, "maxDepth": TREE_DEPTH, "featureSubsetStrategy": "all", "seed": SEED, "maxMemoryInMB": FOREST_MB}
        return RandomForestRegressor(**{**common, **forest, **params})
    if kind == "gbt":
        boost = {"maxIter": BOOST_ROUNDS, "maxDepth": BOOST_DEPTH, "stepSize": BOOST_RATE, "seed": SEED}
        return GBTRegressor(**{**common, **boost, **params})
    raise ValueError(f"unknown model {kind}")


def fit(df: DataFrame, kind: str, features: list[str], label: str = "traffic_volume", **params) -> PipelineModel:
    """Fitted pipeline; the feature list is kept inside it by the assembler.

    Rows with a null feature or label don't train. Constant features are dropped before the
    fit: no tree can split by them, yet every row is counted under each of them, and they make
    the normal equations singular. A forest with other parameters than those of `forest.fit`,
    and boosted trees, are trained by Spark on as many parts as there are cores, because each
    part sends a histogram of every node, whatever the number of its rows.
    """
    df = df.dropna(subset=[*features, label])
    size = df.agg(F.count(F.lit(1)).alias("rows"), F.stddev_samp(label).alias("spread")).first() if kind == "ridge" else None
    rows, spread = (size["rows"], size["spread"] or 1.0) if size else (0, 1.0)
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")
    varying = VarianceThresholdSelector(featuresCol="features", outputCol="varying", varianceThreshold=0.0)
    model = estimator(kind, rows, label, "varying", spread, **params)
    if kind == "forest" and set(params) <= forest.PARAMS:
        size = forest.extent(df, features, label)
        if kept := [c for c, (least, most) in zip(features, size.ends, strict=True) if size.rows and least < most]:
            # The least and the greatest values tell which features vary.
            ends = df.sparkSession.createDataFrame([tuple(map(float, x)) for x in zip(*size.ends, strict=True)], [f"f{i}" for i in range(len(features))])
            chosen = varying.fit(VectorAssembler(inputCols=ends.columns, outputCol="features").transform(ends))
            return PipelineModel([assembler, chosen, forest.fit(df, model, kept, label, size)])
    if kind not in LINEAR:
        df = df.coalesce(df.sparkSession.sparkContext.defaultParallelism)
    return Pipeline(stages=[assembler, varying, model]).fit(df)


def predict(model: PipelineModel, df: DataFrame, name: str, keys: list[str], label: str = "traffic_volume") -> DataFrame:
    """Long predictions: keys, model_name, actual, predicted; null where a feature is null."""
    needed = model_features(model)
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in needed])
    # Every row goes through the model, so the rows are read once; what it says of a row with a gap is dropped.
    if isinstance(model.stages[-1], RandomForestRegressionModel):
        told, said = df, forest.prediction(df, model.stages[-1], [needed[i] for i in model.stages[1].selectedFeatures])
    else:
        told, said = model.transform(df, {model.stages[0].handleInvalid: "keep"}), F.col("prediction")
    return told.select(*keys, F.lit(name).alias("model_name"), F.col(label).cast("double").alias("actual"), F.when(whole, said).alias("predicted"))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_features(model: PipelineModel) -> list[str]:
    return model.stages[0].getInputCols()


def evaluate(pred: DataFrame, by: list[str] | None = None) -> DataFrame:
    """mae, mse, rmse, r2 and mape per model and split; zero actuals are left out of mape."""
    y, p = F.col("actual"), F.col("predicted")
    error = y - p
    measured = pred.groupBy(*(by or ["model_name", "split"])).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.sum(error * error).alias("__residual"),
        (F.var_pop(y) * F.count(y)).alias("__total"),
        (F.avg(F.abs(error / F.nullif(y, F.lit(0.0)))) * 100).alias("mape"),
    )
    r2 = 1 - F.try_divide(F.col("__residual"), F.col("__total"))
    return measured.withColumn("r2", r2).drop("__residual", "__total")


def best(metrics: DataFrame, metric: str = "rmse", by: list[str] | None = None) -> DataFrame:
    """Model with the least error (or the greatest r2); ties go to the first name."""
    good = metrics.filter(F.col(metric).isNotNull())
    order = F.struct(F.col(metric) if metric in ERROR_METRICS else -F.col(metric), F.col("model_name"))
    return good.groupBy(*(by or [])).agg(
        F.min_by("model_name", order).alias("model_name"), F.min_by(metric, order).alias(metric)
    )


def ensemble(pred: DataFrame, keys: list[str], weights: DataFrame) -> DataFrame:
    """Weighted mean of the models' predictions per row.

    `weights` has model_name and weight; `inverse_rmse` makes it from metrics. It
    holds one row per model, so the join is a broadcast.
    """
    joined = pred.join(F.broadcast(weights), "model_name")
    return joined.groupBy(*keys).agg(
        F.try_divide(F.sum(F.col("weight") * F.col("predicted")), F.sum(F.when(F.col("predicted").isNotNull(), F.col("weight")))).alias("ensemble_prediction")
    )


def inverse_rmse(metrics: DataFrame, given: dict[str, float] | None = None) -> DataFrame:
    """Weight of each model: the given one, else 1 / rmse. A model without error outweighs all others."""
    weight: Column = 1 / F.greatest(F.col("rmse"), F.lit(LEAST_RMSE))
    for name, value in (given or {}).items():
        weight = F.when(F.col("model_name") == name, F.lit(float(value))).otherwise(weight)
    return metrics.select("model_name", weight.alias("weight"))


def forecast(latest_pred: DataFrame, hours: int = 24, step_min: int = 15, key: str = "sensor_id", ts_col: str = "reading_timestamp") -> DataFrame:
    """One row per step after the latest time of each key.

    Needs columns `prediction` and `residual_std`; the band is the 95 % interval.
    """
    start = F.col(ts_col) + F.make_dt_interval(mins=F.lit(step_min))
    end = F.col(ts_col) + F.make_dt_interval(hours=F.lit(hours))
    margin = F.col("residual_std") * BAND
    return latest_pred.select(
        key,
        F.explode(F.sequence(start, end, F.make_dt_interval(mins=F.lit(step_min)))).alias("forecast_time"),
        F.col("prediction").alias("predicted_volume"),
        (F.col("prediction") - margin).alias("lower_bound"),
        (F.col("prediction") + margin).alias("upper_bound"),
    )


def train_and_forecast(
    df: DataFrame,
    kinds: list[str],
    features: list[str],
    label: str = "traffic_volume",
    hours: int = 24,
    step_min: int = 15,
    test_size: float = 0.2,
    key: str = "sensor_id",
    ts_col: str = "reading_timestamp",
    tiebreak: str = "event_id",
    alpha: float = ALPHA,
) -> tuple[DataFrame, DataFrame]:
    """Metrics of each model on the latest rows, and the forecast grid of their ensemble.

    Models are fitted on the earlier rows, weighed by their error on the later ones, and
    applied to the last row of each key; the band is the key's own spread of the
    ensemble's errors, and null where a key has fewer than two later rows. All linear
    models come from one pass over the training rows; `alpha` is their penalty.
    """
    rows = cut_lineage(df)
    train, test = split(rows, test_size, "time", ts_col=ts_col)
    place = [key, ts_col, tiebreak]
    lines = linear.fit_all(train, [k for k in kinds if k in LINEAR], features, label, alpha) if set(kinds) & set(LINEAR) else {}
    models = {kind: fit(train, kind, features, label) for kind in kinds if kind not in LINEAR}

    def predicted(part: DataFrame) -> DataFrame:
        told = [F.struct(F.lit(kind).alias("model_name"), line.column().alias("predicted")) for kind, line in lines.items()]
        actual = F.col(label).cast("double").alias("actual")
        frames = [part.select(*place, actual, F.inline(F.array(*told))).select(*place, "model_name", "actual", "predicted")] if told else []
        return reduce(DataFrame.unionByName, frames + [predict(model, part, kind, place, label) for kind, model in models.items()])

    tested = cut_lineage(predicted(test))
    metrics = cut_lineage(evaluate(tested, ["model_name"]))
    weights = inverse_rmse(metrics)
    joined = ensemble(tested, [*place, "actual"], weights)
    spread = joined.groupBy(key).agg(F.stddev_samp(F.col("actual") - F.col("ensemble_prediction")).alias("residual_std"))
    newest = ensemble(predicted(keep_first(rows, [key], [F.col(ts_col), tie(rows, tiebreak)], last=True)), place, weights)
    latest = newest.join(spread, key, "left").withColumnRenamed("ensemble_prediction", "prediction")
    return metrics, forecast(latest, hours, step_min, key, ts_col)


def errors(actual: DataFrame, pred: DataFrame, keys: list[str]) -> DataFrame:
    """Error and absolute error of each prediction that has an actual value."""
    joined = pred.join(actual, keys)
    error = F.col("actual_value") - F.col("predicted_value")
    return joined.withColumns({"error": error, "absolute_error": F.abs(error)})


def rmse_alert(metrics: DataFrame, limit: float = RMSE_LIMIT) -> DataFrame:
    """The best model, if even its error is over the limit."""
    return best(metrics, "rmse").filter(F.col("rmse") > limit).withColumn("threshold", F.lit(float(limit)))
