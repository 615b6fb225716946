"""Streaming sources: decoded messages and incremental file ingest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roadpulse.sources.schemas import FEEDS, READING_MESSAGE

WATERMARK = "10 minutes"
_MESSAGE = "__message"


def read_topic(spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None, **options: str) -> DataFrame:
    """Message stream; needs the Kafka connector on the class path.

    It begins with the earliest message and stops on lost ones, unless `options` say
    otherwise; `max_offsets` bounds a micro-batch.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**{"startingOffsets": "earliest", **options})
    )
    return (reader.option("maxOffsetsPerTrigger", max_offsets) if max_offsets else reader).load()


def _times_as_text(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField(f.name, T.StringType() if f.dataType == T.TimestampType() else f.dataType) for f in schema]
    )


def _to_time(text: Column) -> Column:
    """Time from ISO text or from milliseconds since 1970; null if it is neither."""
    millis = F.timestamp_millis(text.try_cast("long"))
    return F.when(text.rlike("^-?[0-9]{1,15}$"), millis).otherwise(text.try_cast("timestamp"))


def _parsed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Message text and its fields.

    The generator keeps the parse apart from the columns made of it; a plain
    projection would parse the message again for every field. Times are read as
    text and cast, which is several times faster than inside `from_json`.
    """
    record = F.from_json(F.col("value").cast("string"), _times_as_text(schema))
    fields = raw.select(F.col("value").cast("string").alias(_MESSAGE), F.inline(F.array(record)))
    times = {f.name: _to_time(F.col(f.name)) for f in schema if f.dataType == T.TimestampType()}
    return fields.withColumns(times) if times else fields


def _readable(required: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in required])


def decode_readings(
    raw: DataFrame, schema: T.StructType = READING_MESSAGE, required: tuple[str, ...] = ("sensor_id", "timestamp")
) -> DataFrame:
    """Readings from a binary JSON `value` column; works on batches and streams."""
    return _parsed(raw, schema).filter(_readable(required)).select(*schema.names)


def quarantined(
    raw: DataFrame, schema: T.StructType = READING_MESSAGE, required: tuple[str, ...] = ("sensor_id", "timestamp")
) -> DataFrame:
    """The messages that `decode_readings` leaves out, as text."""
    return _parsed(raw, schema).filter(~_readable(required)).select(F.col(_MESSAGE).alias("value"))


def with_watermark(stream: DataFrame, ts_col: str = "timestamp", delay: str = WATERMARK) -> DataFrame:
    """Watermark on a TIMESTAMP column; other time types are cast first."""
    return stream.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, delay)


def _from_text(text: Column, kind: T.DataType) -> Column:
    return _to_time(text) if kind == T.TimestampType() else text.try_cast(kind)


def parse_json_rows(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of a schema from JSON text lines (`value`); names match in any case.

    A line that is no JSON object, or has a value of the wrong type, keeps its text
    in `_corrupt_record`.
    """
    entries = F.map_entries(F.from_json("value", "map<string,string>"))
    listed = lines.select("value", entries.alias("entries"))

    def text_of(name: str) -> Column:
        found = F.filter("entries", lambda e: F.lower(e["key"]) == name.lower())
        return F.get(found, F.lit(0))["value"]

    texts = listed.select("value", F.col("entries").isNull().alias("bad"), *[text_of(f.name).alias(f.name) for f in schema])
    typed = {f.name: _from_text(F.col(f.name), f.dataType) for f in schema}
    bad = F.col("bad")
    for name, value in typed.items():
        bad = bad | (F.col(name).isNotNull() & value.isNull())
    return texts.select(*[v.alias(n) for n, v in typed.items()], F.when(bad, F.col("value")).alias("_corrupt_record"))


def read_feed(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType, purge: bool = False, max_files: int | None = None
) -> DataFrame:
    """File stream under a fixed schema; names match in any case, bad rows go to `_corrupt_record`."""
    reader = spark.readStream.format("text" if fmt == "json" else fmt)
    if purge:
        reader = reader.option("cleanSource", "delete")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if fmt == "json":
        return parse_json_rows(reader.load(path).filter("trim(value) <> ''"), schema)
    return reader.schema(schema).load(path)


def auto_ingest(
    spark: SparkSession, path: str, feed: str, target: str, checkpoint: str, purge: bool = False
) -> StreamingQuery:
    """Load the files that are new since the last run into a Parquet table, then stop.

    Rows that cannot be parsed are kept in `<target>_rejected`; the load goes on.
    """
    fmt, schema = FEEDS[feed]
    stream = read_feed(spark, path, fmt, schema, purge)

    def load(batch: DataFrame, batch_id: int) -> None:
        # One folder per batch: a batch that is run again replaces what it wrote before.
        if fmt != "json":
            batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")
            return
        # Parsed once for both tables.
        batch = batch.persist()
        good, bad = F.col("_corrupt_record").isNull(), F.col("_corrupt_record").isNotNull()
        batch.filter(good).drop("_corrupt_record").write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")
        batch.filter(bad).select("_corrupt_record").write.mode("overwrite").parquet(
            f"{target}_rejected/batch_id={batch_id}"
        )
        batch.unpersist()

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
