"""Late rows of a stream, kept as changes beside a Parquet table and merged when it is read.

A table folder holds `version=K` (a snapshot with the changes of all batches below K)
and `changes/batch_id=N` (the late rows of batch N). A micro-batch writes only its own
rows, whatever the size of the table; `fold` makes a new snapshot from time to time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from roadpulse.functions.columns import as_time
from roadpulse.operators.late import late_arrivals
from roadpulse.operators.tables import merge

KEYS = ("sensor_id", "reading_timestamp")


def _complete(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """Numbers of the finished sub-folders `prefix=N`, in ascending order, by one listing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{prefix}=*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(int(status.getPath().getParent().getName().split("=")[1]) for status in found or [])


def versions(spark: SparkSession, table: str) -> list[int]:
    return _complete(spark, table, "version")


def write_snapshot(df: DataFrame, table: str, version: int) -> None:
    df.write.mode("overwrite").parquet(f"{table}/version={version}")


def late_merge(
    stream: DataFrame, table: str, checkpoint: str, as_of, hours: int = 24, ts_col: str = KEYS[1], trigger: str | None = None
) -> StreamingQuery:
    """Upsert the late rows of each micro-batch.

    No watermark is set, because it would drop the very rows meant here. A batch
    that runs again after a failure overwrites what it wrote before.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        found = late_arrivals(batch, as_of, hours, ts_col)
        # The stamp is stored with the rows: read later, they are as old as they are.
        found.withColumn("updated_at", as_time(as_of)).write.mode("overwrite").parquet(f"{table}/changes/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


def read_current(
    spark: SparkSession, table: str, keys: tuple[str, ...] = KEYS, order: tuple[str, ...] = ("event_id",)
) -> DataFrame:
    """Newest snapshot with the later changes merged in; the later batch wins."""
    version = versions(spark, table)[-1]
    snapshot = spark.read.parquet(f"{table}/version={version}")
    batches = [n for n in _complete(spark, f"{table}/changes", "batch_id") if n >= version]
    if not batches:
        return snapshot
    paths = [f"{table}/changes/batch_id={n}" for n in batches]
    changes = spark.read.option("basePath", f"{table}/changes").parquet(*paths)
    merged = merge(snapshot, changes, list(keys), ["batch_id", *order])
    return merged.drop("batch_id")


def fold(spark: SparkSession, table: str, keys: tuple[str, ...] = KEYS, order: tuple[str, ...] = ("event_id",)) -> int:
    """Write a snapshot with all finished changes; returns its version."""
    batches = _complete(spark, f"{table}/changes", "batch_id")
    version = max([batches[-1] + 1 if batches else 0, versions(spark, table)[-1]])
    if version not in versions(spark, table):
        write_snapshot(read_current(spark, table, keys, order), table, version)
    return version


