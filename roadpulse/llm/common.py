"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.session import cut_lineage, work_folder

__all__ = ["column", "cut_lineage", "drop_folder", "load", "records", "runs_of_rows", "text_or_empty", "without", "work_folder"]


def load(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def column(name: str) -> Column:
    """A column by its exact name, whatever signs are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(column(name).cast("string"), F.lit(""))


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The frame without input columns that an operator's own output columns would clash with."""
    return df.drop(*[c for c in df.columns if c in set(names)])


def records(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*[column.to_pylist() for column in batch.columns], strict=True)


def runs_of_rows(batch: pa.RecordBatch, texts: int, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows: a column of texts holds less than `size` bytes in each, but for its last row. Null texts have none."""
    stops = np.cumsum(pc.fill_null(pc.binary_length(batch.column(texts)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    low = 0
    while low < batch.num_rows:
        before = stops[low - 1] if low else 0
        high = int(np.searchsorted(stops, before + size)) + 1
        yield batch.slice(low, high - low)
        low = high


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate files that this session wrote under its work folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
