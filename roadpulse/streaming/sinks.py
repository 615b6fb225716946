"""Stream sinks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.sources.readers import with_date_parts


def to_alert_messages(anomalies: DataFrame, key: str = "sensor_id") -> DataFrame:
    """Keyed messages with the whole row as JSON."""
    return anomalies.select(F.col(key).alias("key"), F.to_json(F.struct(*anomalies.columns)).alias("value"))


def _triggered(writer, trigger: str | None):
    """`trigger=None` works off what is there and stops."""
    return writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)


def write_bronze(
    stream: DataFrame, path: str, checkpoint: str, trigger: str | None = "5 minutes", ts_col: str = "timestamp", fmt: str = "parquet"
) -> StreamingQuery:
    """Append to a table partitioned by date. Other formats, such as Delta, need their jars."""
    writer = (
        with_date_parts(stream, ts_col)
        .writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("mergeSchema", "true")
        .partitionBy("year", "month", "day")
    )
    return _triggered(writer, trigger).start(path)


@dataclass
class SinkConfig:
    table_path: str
    checkpoint: str
    log_format: str = "console"
    alert_format: str = "kafka"
    alert_options: dict[str, str] | None = None
    table_trigger: str | None = "5 minutes"
    log_trigger: str | None = "30 seconds"
    alert_trigger: str | None = "1 minute"
    log_options: dict[str, str] | None = None


def staged(stream: DataFrame, path: str, checkpoint: str, trigger: str | None = "1 minute") -> DataFrame:
    """A stream over what `stream` gives out, written to a table by one query of its own.

    Sinks that read it share that query's state; given `stream` itself, each would keep all of it
    again. `trigger=None` works off what is there first.
    """
    query = _triggered(stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint), trigger).start(path)
    if trigger is None:
        query.awaitTermination()
    return stream.sparkSession.readStream.schema(stream.schema).parquet(path)


def start_sinks(metrics: DataFrame, anomalies: DataFrame, cfg: SinkConfig) -> list[StreamingQuery]:
    """Three independent queries (table, log, alerts), each with its own checkpoint.

    Streams with state are best given as `staged` ones.
    """
    table = write_bronze(metrics, cfg.table_path, f"{cfg.checkpoint}/table", cfg.table_trigger, "window_start")
    log = metrics.writeStream.format(cfg.log_format).outputMode("append").queryName("metrics_log")
    if cfg.log_format == "console":
        log = log.option("truncate", "false")
    if cfg.log_options:
        log = log.options(**cfg.log_options)
    if cfg.log_format not in ("console", "memory"):
        log = log.option("checkpointLocation", f"{cfg.checkpoint}/log")
    alerts = (
        to_alert_messages(anomalies)
        .writeStream.format(cfg.alert_format)
        .outputMode("append")
        .queryName("alert_messages")
        .options(**(cfg.alert_options or {}))
    )
    if cfg.alert_format != "memory":
        alerts = alerts.option("checkpointLocation", f"{cfg.checkpoint}/alerts")
    return [table, _triggered(log, cfg.log_trigger).start(), _triggered(alerts, cfg.alert_trigger).start()]
