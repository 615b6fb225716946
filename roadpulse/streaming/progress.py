"""Rates and totals of the streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = (
    "name string, batch_id long, timestamp string, input_rows long, input_rate double, processing_rate double, "
    "duration_ms long, state_rows long"
)


def _row(progress) -> tuple:
    return (
        progress.name,
        progress.batchId,
        progress.timestamp,
        progress.numInputRows,
        float(progress.inputRowsPerSecond),
        float(progress.processedRowsPerSecond),
        progress.durationMs.get("triggerExecution"),
        sum(state.numRowsTotal for state in progress.stateOperators),
    )


class ProgressListener(StreamingQueryListener):
    """Keeps all reports, or the newest `keep` of them, and hands each to an optional sink.

    A stream that runs for long should have a sink that writes them, and a bound here.
    """

    def __init__(self, sink=None, keep: int | None = None):
        self.rows: list[tuple] = []
        self.errors: list[str] = []
        self._sink = sink
        self._keep = keep

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        row = _row(event.progress)
        self.rows.append(row)
        if self._keep is not None:
            del self.rows[: -self._keep or None]
        if self._sink:
            self._sink(row)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.exception:
            self.errors.append(event.exception)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, PROGRESS)


def active_progress(spark: SparkSession) -> DataFrame:
    """The last report of every active query."""
    reports = [query.lastProgress for query in spark.streams.active]
    return spark.createDataFrame([_row(p) for p in reports if p is not None], PROGRESS)
