"""Change records of a stream applied to a keyed table.

The table keeps, beside each row, the place of the change that made it in the order of the
changes, and keeps deleted keys as tombstones. So a change is applied only if it is later
than what the key has: changes that come late, twice or in another order end in the same
table, and none brings a deleted row back.

Keys are spread by a hash over a fixed number of partitions of the table. A micro-batch
reads and writes the partitions that its keys fall into, and no others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.sources.changes import latest_changes

PLACE, DELETED, BUCKET = "__place", "__deleted", "__bucket"
BUCKETS = 64


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def write_target(df: DataFrame, table: str, keys: list[str], order: dict[str, str], buckets: int = BUCKETS) -> None:
    """Write the rows that are there before any change. `order` names the order's columns and their types."""
    place = F.struct(*[F.lit(None).cast(kind).alias(name) for name, kind in order.items()])
    rows = df.withColumns({PLACE: place, DELETED: F.lit(False), BUCKET: _bucket(keys, buckets)})
    rows.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(table)


def read_target(spark: SparkSession, table: str) -> DataFrame:
    """The rows as they stand, without the keys that were deleted."""
    return spark.read.parquet(table).filter(~F.col(DELETED)).drop(PLACE, DELETED, BUCKET)


def merged(current: DataFrame, changes: DataFrame, keys: list[str], order: list[str], op_col: str = "operation") -> DataFrame:
    """Rows and tombstones after the changes; only changes later than a key's own place count."""
    last = latest_changes(changes, keys, order)
    place = F.struct(*[F.col(c) for c in order]).cast(current.schema[PLACE].dataType)
    last = last.withColumns({PLACE: place, DELETED: F.col(op_col) == "DELETE"})
    new = last.select(*keys, F.struct(*[c for c in current.columns if c not in (*keys, BUCKET)]).alias("__new"))
    # At most one change per key, so the join can't grow; a row without a change has none to its right.
    both = current.join(new, keys, "full_outer")
    known, later = F.col(DELETED).isNotNull(), F.col(f"__new.{PLACE}") > F.col(PLACE)
    # A row from before all changes has a place without values.
    first = reduce(lambda a, b: a & b, [F.col(f"{PLACE}.{c}").isNull() for c in order])
    takes = F.col("__new").isNotNull() & (~known | first | later)
    columns = [F.when(takes, F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) for c in current.columns if c not in (*keys, BUCKET)]
    return both.select(*keys, *columns)


def _finished(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def apply_change_stream(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    keys: list[str],
    order: list[str],
    op_col: str = "operation",
    buckets: int = BUCKETS,
    trigger: str | None = None,
) -> StreamingQuery:
    """Apply INSERT, UPDATE and DELETE changes batch by batch to a table made by `write_target`.

    `order` must end with a unique column. Changes with a null key or a null in the order are
    left out. The merged partitions are first written under the checkpoint: a batch that was
    cut off while it replaced them in the table finds them there and only replaces them again.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        staged = f"{checkpoint}/merged/batch_id={batch_id}"
        if not _finished(spark, staged):
            changes = batch.dropna(subset=[*keys, *order]).withColumn(BUCKET, _bucket(keys, buckets))
            # A change is read for its partition and for the merge.
            changes.write.mode("overwrite").parquet(f"{staged}-changes")
            changes = spark.read.schema(changes.schema).parquet(f"{staged}-changes")
            touched = [r[0] for r in changes.select(BUCKET).distinct().collect()]  # at most `buckets` numbers
            current = spark.read.parquet(table).filter(F.col(BUCKET).isin(touched))
            rows = merged(current, changes, keys, order, op_col).withColumn(BUCKET, _bucket(keys, buckets))
            rows.repartition(BUCKET).write.mode("overwrite").parquet(staged)
        rows = spark.read.parquet(staged)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(table)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()
