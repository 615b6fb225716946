"""Last reading and gaps of each sensor on a stream."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "sensor_id string, last_reading timestamp, previous_reading timestamp, gap_seconds double, status string"
STATE = "last_reading timestamp"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Minutes with readings that a task holds before it gives them out.
HELD_MINUTES = 500_000
EPOCH = datetime(1970, 1, 1)
NEVER = np.iinfo("int64").min  # as a time: none


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which timers and value states need."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, PROVIDER)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _edges(times: pa.Table) -> pa.Table:
    """First and last time of every sensor and minute."""
    found = times.group_by(["sensor_id", "minute"]).aggregate([("first", "min"), ("last", "max")])
    return found.rename_columns({"first_min": "first", "last_max": "last"})


def minute_edges(stream: DataFrame, key: str = "sensor_id", ts_col: str = "timestamp") -> DataFrame:
    """`sensor_id, first, last`: first and last time of a sensor in every minute, as each task sees them.

    Each task reduces its own rows before the shuffle. So a sensor with many rows sends at
    most one row per minute from each task to the one that keeps its state.
    """

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            times = batch.column(1)
            rows = pa.table({"sensor_id": batch.column(0), "minute": pc.floor_temporal(times, unit="minute"), "first": times, "last": times})
            found = _edges(rows)
            held = found if held is None else _edges(pa.concat_tables([held, found]))
            if held.num_rows > HELD_MINUTES:
                yield from held.select(["sensor_id", "first", "last"]).to_batches()
                held = None
        if held is not None:
            yield from held.select(["sensor_id", "first", "last"]).to_batches()

    named = stream.select(F.col(key).alias("sensor_id"), F.col(ts_col).cast("timestamp").alias("time")).filter("time is not null")
    return named.mapInArrow(reduce_rows, "sensor_id string, first timestamp, last timestamp")


class GapWatch(StatefulProcessor):
    """Keeps the last time of a sensor, with a timer for its silence."""

    def __init__(self, gap_minutes: int):
        self.gap_minutes = gap_minutes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        edges = [(_micros(part["first"]), _micros(part["last"])) for part in rows]
        first, until = (np.concatenate(side) for side in zip(*edges, strict=True))
        order = np.lexsort((until, first))
        first, until = first[order], until[order]
        held = self.last.get()
        # Nothing is before the first reading of a sensor without state.
        start = first[:1] if held is None else _micros(pd.Series([held[0]]))
        reached = np.maximum.accumulate(np.concatenate([start, until]))
        before, last = reached[:-1], int(reached[-1])
        if held is not None:
            # A sensor without state has no timer.
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
        self.last.update((EPOCH + timedelta(microseconds=last),))
        due = last // 1000 + self.gap_minutes * 60_000
        self.handle.registerTimer(max(due, timerValues.getCurrentWatermarkInMs() + 1))
        late = np.flatnonzero(first - before > self.gap_minutes * 60_000_000)
        if len(late):
            yield _rows(key[0], first[late], before[late], (first[late] - before[late]) / 1e6, "resumed")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = _micros(pd.Series([self.last.get()[0]]))
        self.last.clear()
        yield _rows(key[0], last, np.array([NEVER]), np.array([self.gap_minutes * 60.0]), "silent")

    def close(self) -> None:
        pass


def _micros(times: pd.Series) -> np.ndarray:
    return times.to_numpy("datetime64[us]").view("int64")


def _rows(sensor: str, last: np.ndarray, previous: np.ndarray, gap: np.ndarray, status: str) -> pd.DataFrame:
    """Times in microseconds as rows of `OUTPUT`."""
    return pd.DataFrame(
        {
            "sensor_id": [sensor] * len(last),
            "last_reading": last.view("datetime64[us]"),
            "previous_reading": previous.view("datetime64[us]"),
            "gap_seconds": gap,
            "status": [status] * len(last),
        }
    )


def sensor_state(stream: DataFrame, gap_minutes: int = 120, key: str = "sensor_id", ts_col: str = "timestamp") -> DataFrame:
    """A row whenever a sensor resumes after a gap or falls silent for longer than the limit.

    The stream must have a watermark on `ts_col`; start it inside `rocksdb_state`. The state is
    one time per sensor and a timer. Only the first and last time per minute and task come to
    the state: a gap of a minute or more lies between the last time of one minute and the first
    of another. A sensor whose silence was told starts anew with its next reading.
    """
    if gap_minutes < 1:
        raise ValueError("a gap is a minute or longer")
    edges = minute_edges(stream, key, ts_col)
    return edges.groupBy("sensor_id").transformWithStateInPandas(GapWatch(gap_minutes), OUTPUT, "append", "EventTime")
