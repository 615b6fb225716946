"""Rows of a stream joined to a dimension that changes while the stream runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from roadpulse.operators.enrich import with_sensor_at
from roadpulse.operators.staging import scd2


def enrich_changing(
    stream: DataFrame,
    history: Callable[[SparkSession], DataFrame],
    target: str,
    checkpoint: str,
    key: str = "sensor_id",
    ts_col: str = "reading_timestamp",
    columns: tuple[str, ...] = ("city",),
    version_order: str = "seq",
    tiebreak: str = "event_id",
    trigger: str | None = None,
) -> StreamingQuery:
    """Left join of each row to the version that is valid at its own time, as known when its batch runs.

    A static side of a stream join keeps the files it had when the stream started. Here
    `history` is called for every micro-batch, so it reads the versions that are there by
    then. Rows written earlier stay as they are. A batch has a folder of its own below
    `target`; one that runs again replaces what it wrote before.
    """

    def join(batch: DataFrame, batch_id: int) -> None:
        versions = scd2(history(batch.sparkSession))
        rows = with_sensor_at(batch, versions, key, ts_col, columns, version_order, tiebreak)
        rows.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(join).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()
