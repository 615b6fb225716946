"""Registered queries: features, models, evaluation, forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.operators import features, forecast, linear, reports
from roadpulse.plans.base import r, rounded, sql, staged
from roadpulse.plans.shaping import ML_TIME_SQL, fill_sql, iqr_sql
from roadpulse.session import cut_lineage
from roadpulse.sources import adapters

ID = ["sensor_id", "reading_timestamp", "event_id"]
TARGET, SPEED = "traffic_volume", "speed_mph"
SCALED = ["traffic_volume", "occupancy_pct", "latitude"]
PLANE = ["occupancy_pct", "hour_of_day"]
# Penalties at which both models differ from the plain plane on the given tables.
PLANE_ALPHA = {"ridge": 10_000.0, "lasso": 2.0}
# Models of the whole pipeline and their penalties.
PIPELINE = {"linear": 0.0, "ridge": 5_000_000.0}
# Simple predictors for the evaluation operators: name and formula, valid on both engines.
PREDICTORS = {
    "occupancy": "1000 + 5 * occupancy_pct",
    "damped": "0.9 * traffic_volume + occupancy_pct",
    "noisy": "traffic_volume + ((event_id * 37) % 201 - 100)",
}


def prepared(spark, d):
    return features.prepare(adapters.readings(spark, d).select(*ID, TARGET, SPEED), TARGET, SPEED)


def predictions(spark, d):
    """Long predictions of all predictors, one pass over the readings."""
    formulas = [
        F.struct(F.lit(name).alias("model_name"), F.expr(text).cast("double").alias("predicted")) for name, text in PREDICTORS.items()
    ]
    return staged(spark, d).select(
        *ID,
        F.col(TARGET).cast("double").alias("actual"),
        F.when(F.col("event_id") % 5 == 0, "test").otherwise("train").alias("split"),
        F.inline(F.array(*formulas)),
    )


def metrics(spark, d):
    return forecast.evaluate(predictions(spark, d))


def _test_metrics(spark, d):
    return metrics(spark, d).filter("split = 'test'")


def measured_splits(spark, d, kind):
    """Prepared rows with their split, each prepared and dealt once, and the metrics of a model fitted on the training rows."""
    split = F.when(forecast.in_training(), "train").otherwise("test").alias("split")
    rows = cut_lineage(prepared(spark, d).select("*", split))
    columns = features.feature_columns(rows, [TARGET, *ID])
    model = forecast.fit(rows.filter("split = 'train'"), kind, columns, TARGET)
    return rows, forecast.evaluate(forecast.predict(model, rows, kind, [*ID, "split"], TARGET))


def trained(kind):
    """Fit on the training rows and measure both splits."""
    return lambda spark, d: measured_splits(spark, d, kind)[1]


def beaten(kind):
    """Rows of both splits, and whether the model beats their mean."""

    def query(spark, d):
        rows, measured = measured_splits(spark, d, kind)
        found = measured.select("split", (F.col("r2") > 0).alias("beats_mean"))
        return rows.groupBy("split").agg(F.count(F.lit(1)).alias("rows")).join(found, "split")

    return query


def gram_fit(kind):
    """Coefficients from one pass of sums of products, on two features whose plane SQL can fit too."""

    def query(spark, d):
        return rounded(linear.fit(staged(spark, d), kind, PLANE, TARGET, PLANE_ALPHA[kind]).frame(spark))

    return query


def split_rows(spark, d):
    train, test = forecast.split(staged(spark, d).select(*ID), key=["sensor_id", "event_id"])
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


def grid(spark, d):
    """The ensemble of all predictors, weighed by their errors on the test rows."""
    pred = cut_lineage(predictions(spark, d))
    weights = forecast.inverse_rmse(forecast.evaluate(pred).filter("split = 'test'"))
    joined = cut_lineage(forecast.ensemble(pred, [*ID, "actual"], weights).withColumnRenamed("ensemble_prediction", "prediction"))
    spread = joined.groupBy("sensor_id").agg(F.stddev_samp(F.col("actual") - F.col("prediction")).alias("residual_std"))
    newest = reports.latest_per_key(joined.select(*ID, "prediction"))
    return forecast.forecast(newest.join(spread, "sensor_id"))


def _pipeline(spark, d):
    """Fit, weigh and forecast in one go, with two models on one feature whose lines SQL can fit too."""
    rows = staged(spark, d).select(*ID, "occupancy_pct", F.col(TARGET).cast("double").alias(TARGET))
    return forecast.train_and_forecast(rows, list(PIPELINE), ["occupancy_pct"], TARGET, alpha=PIPELINE["ridge"])


def trained_grid(spark, d):
    return rounded(_pipeline(spark, d)[1], 3)


def trained_metrics(spark, d):
    return rounded(_pipeline(spark, d)[0], 3)


def prediction_errors(spark, d):
    pred = predictions(spark, d).select("event_id", "model_name", F.col("predicted").alias("predicted_value"))
    actual = staged(spark, d).select("event_id", F.col(TARGET).cast("double").alias("actual_value"))
    return forecast.errors(actual, pred, ["event_id"])


QUERIES = {
    "prepare_features": lambda s, d: rounded(prepared(s, d)),
    "scale_features": lambda s, d: rounded(features.scale(staged(s, d).select("event_id", *SCALED), SCALED)),
    "train_test_split": split_rows,
    "fit_linear": gram_fit("ridge"),
    "fit_lasso": gram_fit("lasso"),
    "fit_linear_metrics": trained("ridge"),
    "fit_lasso_metrics": trained("lasso"),
    "fit_forest": beaten("forest"),
    "fit_gbt": beaten("gbt"),
    "eval_metrics": lambda s, d: rounded(metrics(s, d)),
    "best_model": lambda s, d: rounded(forecast.best(_test_metrics(s, d))),
    "ensemble_predict": lambda s, d: rounded(
        forecast.ensemble(predictions(s, d), ["event_id"], forecast.inverse_rmse(_test_metrics(s, d)))
    ),
    "forecast_grid": lambda s, d: rounded(grid(s, d)),
    "forecast_pipeline": trained_grid,
    "forecast_pipeline_metrics": trained_metrics,
    "prediction_errors": lambda s, d: rounded(prediction_errors(s, d)),
    "rmse_alert": lambda s, d: rounded(forecast.rmse_alert(_test_metrics(s, d))),
}

_V = TARGET
_W = "PARTITION BY sensor_id ORDER BY reading_timestamp, event_id"


def _rolled(fn: str, name: str, n: int) -> str:
    return f"{fn}({_V}) OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS {_V}_rolling_{name}_{n}"


_LAGS = [f"lag({_V}, {n}) OVER ({_W}) AS {_V}_lag_{n}" for n in features.LAG_PERIODS]
_ROLLS = [
    _rolled(fn, name, n) for n in features.ROLLING_WINDOWS for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("max", "max"))
]
_STAT_NAMES = [f"{c}_{kind}" for c in (TARGET, SPEED) for kind in ("mean", "std", "min", "max")]
_STATS = ", ".join(
    f"round({fn}({c}), 2) AS {c}_{kind}"
    for c in (TARGET, SPEED)
    for kind, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
)
_TIME_NAMES = ["hour", "day_of_week", "day_of_month", "month", "quarter", "year", "is_morning_rush", "is_evening_rush", "is_weekend"]
_CYCLE_NAMES = [f"{n}_{f}" for n in ("hour", "day", "month") for f in ("sin", "cos")]
_LAG_NAMES = [f"{_V}_lag_{n}" for n in features.LAG_PERIODS]
_ROLL_NAMES = [f"{_V}_rolling_{k}_{n}" for n in features.ROLLING_WINDOWS for k in ("mean", "std", "max")]
_MIXED = {
    "traffic_density": f"{_V} / (speed_mph + 1)",
    "rush_hour_speed_factor": "speed_mph * is_morning_rush",
    "evening_rush_speed_factor": "speed_mph * is_evening_rush",
}
_DOUBLE_NAMES = [TARGET, SPEED, *_CYCLE_NAMES, *_LAG_NAMES, *_ROLL_NAMES, *_STAT_NAMES]
_COMPLETE = " AND ".join(f"{n} IS NOT NULL" for n in [*_LAG_NAMES, *_ROLL_NAMES, *_STAT_NAMES])
_WIDE = (
    f""", single AS (SELECT * EXCLUDE (n) FROM (SELECT sensor_id, reading_timestamp, event_id, traffic_volume, speed_mph, row_number() OVER (
        PARTITION BY sensor_id, reading_timestamp ORDER BY event_id) AS n FROM readings) WHERE n = 1)"""
    + fill_sql("single", "filled")
    + iqr_sql("filled", "cleaned")
    + f""", stats AS (SELECT sensor_id, {_STATS} FROM cleaned GROUP BY ALL),
    wide AS (SELECT *, {', '.join(_LAGS + _ROLLS)}, dense_rank() OVER (ORDER BY sensor_id) - 1 AS code FROM cleaned),
    timed AS (SELECT w.*, s.* EXCLUDE (sensor_id), {ML_TIME_SQL} FROM wide w JOIN stats s ON s.sensor_id = w.sensor_id)"""
)
_PREPARED = (
    _WIDE
    + f""" SELECT {', '.join(ID)}, {', '.join(_TIME_NAMES)}, CAST(code AS BIGINT) AS sensor_id_encoded,
        {', '.join(r(n, n) for n in _DOUBLE_NAMES)}, {', '.join(r(e, n) for n, e in _MIXED.items())} FROM timed WHERE {_COMPLETE}"""
)
_PRED = (
    ", pred AS ("
    + " UNION ALL ".join(
        f"""SELECT {', '.join(ID)}, CAST({_V} AS DOUBLE) AS actual, CASE WHEN event_id % 5 = 0 THEN 'test' ELSE 'train' END AS split,
        '{name}' AS model_name, CAST({text} AS DOUBLE) AS predicted FROM staged"""
        for name, text in PREDICTORS.items()
    )
    + """), metrics AS (SELECT model_name, split, avg(abs(actual - predicted)) AS mae, avg((actual - predicted) ** 2) AS mse,
        sqrt(avg((actual - predicted) ** 2)) AS rmse, avg(abs((actual - predicted) / nullif(actual, 0))) * 100 AS mape,
        1 - sum((actual - predicted) ** 2) / (var_pop(actual) * count(actual)) AS r2 FROM pred GROUP BY ALL),
    tested AS (SELECT * FROM metrics WHERE split = 'test'), best AS (SELECT model_name, rmse FROM tested ORDER BY rmse, model_name LIMIT 1)"""
)

_PLANE_SQL = f""", plane AS (SELECT occupancy_pct::DOUBLE AS a, hour_of_day::DOUBLE AS b, {TARGET}::DOUBLE AS y FROM staged
        WHERE occupancy_pct IS NOT NULL AND hour_of_day IS NOT NULL),
    sums AS (SELECT count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) * count(*) AS saa, var_pop(b) * count(*) AS sbb,
        covar_pop(a, b) * count(*) AS sab, covar_pop(a, y) * count(*) AS say, covar_pop(b, y) * count(*) AS sby FROM plane)"""
_TERMS_SQL = f""" SELECT 'intercept' AS term, {r('my - wa * ma - wb * mb', 'coefficient')} FROM w
    UNION ALL SELECT 'occupancy_pct', {r('wa', 'coefficient')} FROM w UNION ALL SELECT 'hour_of_day', {r('wb', 'coefficient')} FROM w"""
# The same hash of key and time as the split of the rows.
_SPLITS_SQL = (
    _WIDE
    + f""" SELECT split, count(*) AS rows, TRUE AS beats_mean FROM (SELECT CASE WHEN ('0x' || substr(md5('42|' || sensor_id || '|'
        || reading_timestamp::VARCHAR), 1, 8))::BIGINT % 10000 < 8000 THEN 'train' ELSE 'test' END AS split FROM timed WHERE {_COMPLETE}) GROUP BY split"""
)
_PIPELINE_SQL = f""", timed AS (SELECT *, epoch(date_trunc('second', reading_timestamp))::BIGINT AS sec, traffic_volume::DOUBLE AS y,
        occupancy_pct::DOUBLE AS x FROM staged),
    cut AS (SELECT quantile_cont(sec, 0.8) AS edge FROM timed),
    sums AS (SELECT avg(x) AS mx, avg(y) AS my, var_pop(x) * count(*) AS sxx, covar_pop(x, y) * count(*) AS sxy FROM timed, cut
        WHERE sec <= edge AND x IS NOT NULL),
    lines AS (SELECT model_name, my - slope * mx AS a, slope AS b FROM (
        SELECT *, sxy / (sxx + alpha) AS slope FROM sums, (VALUES {', '.join(f"('{k}', {a}::DOUBLE)" for k, a in PIPELINE.items())}) v(model_name, alpha))),
    pred AS (SELECT model_name, sensor_id, reading_timestamp, event_id, y AS actual, a + b * x AS predicted FROM timed, cut, lines WHERE sec > edge),
    weighed AS (SELECT model_name, avg(abs(actual - predicted)) AS mae, avg((actual - predicted) ** 2) AS mse,
        sqrt(avg((actual - predicted) ** 2)) AS rmse, avg(abs((actual - predicted) / nullif(actual, 0))) * 100 AS mape,
        1 - sum((actual - predicted) ** 2) / (var_pop(actual) * count(actual)) AS r2 FROM pred GROUP BY ALL),
    line AS (SELECT sum(a / rmse) / sum(1 / rmse) AS a, sum(b / rmse) / sum(1 / rmse) AS b FROM lines JOIN weighed USING (model_name)),
    spread AS (SELECT sensor_id, stddev_samp(y - a - b * x) AS sd FROM timed, cut, line WHERE sec > edge GROUP BY sensor_id),
    newest AS (SELECT sensor_id, max(reading_timestamp) AS t, any_value(a) + any_value(b) * arg_max(x, (reading_timestamp, event_id)) AS p
        FROM timed, line GROUP BY sensor_id)"""

ORACLES = {
    "fit_linear": sql(_PLANE_SQL + f""", ridge AS (SELECT *, (saa + {PLANE_ALPHA['ridge']}) * (sbb + {PLANE_ALPHA['ridge']}) - sab * sab AS det FROM sums),
        w AS (SELECT *, ((sbb + {PLANE_ALPHA['ridge']}) * say - sab * sby) / det AS wa, ((saa + {PLANE_ALPHA['ridge']}) * sby - sab * say) / det AS wb
            FROM ridge)""" + _TERMS_SQL),
    "fit_lasso": sql(_PLANE_SQL + f""", steps(k, wa, wb) AS (SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE
            UNION ALL SELECT k + 1, na, sign(sby - sab * na) * greatest(abs(sby - sab * na) - n * {PLANE_ALPHA['lasso']}, 0) / sbb
            FROM (SELECT k, sbb, sby, sab, n, sign(say - sab * wb) * greatest(abs(say - sab * wb) - n * {PLANE_ALPHA['lasso']}, 0) / saa AS na
                FROM steps, sums WHERE k < 60)),
        w AS (SELECT * FROM sums, (SELECT wa, wb FROM steps ORDER BY k DESC LIMIT 1))""" + _TERMS_SQL).replace("WITH", "WITH RECURSIVE", 1),
    "fit_forest": sql(_SPLITS_SQL),
    "fit_gbt": sql(_SPLITS_SQL),
    "forecast_pipeline": sql(_PIPELINE_SQL + f""" SELECT sensor_id, t + k * INTERVAL 15 MINUTE AS forecast_time, {r('p', 'predicted_volume', 3)},
            {r('p - 1.96::DOUBLE * sd', 'lower_bound', 3)}, {r('p + 1.96::DOUBLE * sd', 'upper_bound', 3)}
        FROM newest LEFT JOIN spread USING (sensor_id), range(1, 97) t2(k)"""),
    "forecast_pipeline_metrics": sql(_PIPELINE_SQL + " SELECT model_name, " + ", ".join(
        r(m, m, 3) for m in ("mae", "mse", "rmse", "mape", "r2")) + " FROM weighed"),
    "train_test_split": sql("""SELECT sensor_id, reading_timestamp, event_id,
        CASE WHEN ('0x' || substr(md5('42|' || sensor_id || '|' || event_id), 1, 8))::BIGINT % 10000 < 8000 THEN 'train' ELSE 'test' END AS split
        FROM staged"""),
    "prepare_features": sql(_PREPARED),
    "scale_features": sql("SELECT event_id, " + ", ".join(
        r(f"({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1)", c) for c in SCALED) + " FROM staged"),
    "eval_metrics": sql(_PRED + " SELECT model_name, split, " + ", ".join(
        r(m, m) for m in ("mae", "mse", "rmse", "mape", "r2")) + " FROM metrics"),
    "best_model": sql(_PRED + f" SELECT model_name, {r('rmse', 'rmse')} FROM best"),
    "ensemble_predict": sql(_PRED + f""" SELECT event_id, {r('sum(predicted / rmse) / sum(1 / rmse)', 'ensemble_prediction')}
        FROM pred JOIN tested ON tested.model_name = pred.model_name GROUP BY event_id"""),
    "forecast_grid": sql(_PRED + f""", joined AS (SELECT sensor_id, reading_timestamp, event_id, any_value(actual) AS actual,
            sum(predicted / rmse) / sum(1 / rmse) AS predicted FROM pred JOIN tested ON tested.model_name = pred.model_name GROUP BY ALL),
        spread AS (SELECT sensor_id, stddev_samp(actual - predicted) AS s FROM joined GROUP BY ALL),
        newest AS (SELECT * FROM joined QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY reading_timestamp DESC, event_id DESC) = 1)
        SELECT n.sensor_id, unnest(generate_series(reading_timestamp + INTERVAL 15 MINUTE, reading_timestamp + INTERVAL 24 HOUR,
            INTERVAL 15 MINUTE)) AS forecast_time, {r('predicted', 'predicted_volume')}, {r('predicted - 1.96 * s', 'lower_bound')},
            {r('predicted + 1.96 * s', 'upper_bound')} FROM newest n JOIN spread s ON s.sensor_id = n.sensor_id"""),
    "prediction_errors": sql(_PRED + f""" SELECT event_id, model_name, {r('predicted', 'predicted_value')}, {r('actual', 'actual_value')},
        {r('actual - predicted', 'error')}, {r('abs(actual - predicted)', 'absolute_error')} FROM pred"""),
    "rmse_alert": sql(_PRED + f" SELECT model_name, {r('rmse', 'rmse')}, 50.0::DOUBLE AS threshold FROM best WHERE rmse > 50"),
}
