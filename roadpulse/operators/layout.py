"""Table layout along a Morton curve, and what it saves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.functions.ordered import number_rows

# Cells per column are 2 ** BITS.
BITS = 8
SKETCH = 4096
_KEY = "__morton"


def _as_number(df: DataFrame, column: str) -> tuple[DataFrame, str]:
    """The frame with a number that orders like the column: its value, its microseconds, or its place among the distinct texts."""
    kind, name = df.schema[column].dataType, f"__value_{column}"
    if isinstance(kind, T.NumericType):
        return df.withColumn(name, F.col(column).cast("double")), name
    if isinstance(kind, T.DateType | T.TimestampType | T.TimestampNTZType):
        return df.withColumn(name, F.unix_micros(F.col(column).cast("timestamp")).cast("double")), name
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    places = number_rows(values, [F.col(column)]).select(F.col(column), F.col("__index").cast("double").alias(name))
    return df.join(places, column, "left"), name


def _cell(df: DataFrame, value: str, bounds: list[float], bits: int) -> DataFrame:
    """The number of bounds that the value reaches, by halving: one comparison per bit. Null values are in cell 0."""
    known = F.array(*[F.lit(float(b)) for b in bounds])
    df = df.withColumn(f"{value}_cell", F.lit(0))
    for bit in reversed(range(bits)):
        step = 1 << bit
        reached = F.col(value) >= F.element_at(known, F.col(f"{value}_cell") + step)
        df = df.withColumn(f"{value}_cell", F.col(f"{value}_cell") + F.when(reached, step).otherwise(0))
    return df


def interleaved(cells: list[Column], bits: int) -> Column:
    """One number whose bits are taken from the cells in turn, the highest first."""
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for j, cell in enumerate(cells):
            one = F.shiftright(cell.cast("long"), bit).bitwiseAND(F.lit(1))
            out = out.bitwiseOR(F.shiftleft(one, bit * len(cells) + len(cells) - 1 - j))
    return out


def with_morton_key(df: DataFrame, columns: list[str], bits: int = BITS, name: str = _KEY) -> DataFrame:
    """Rows with the Morton key of their ranked columns.

    Each column is cut into 2**bits cells of about equally many rows, by a sketch of its values
    (one pass for all columns), so skewed columns use all of their bits.
    """
    if bits * len(columns) > 62:
        raise ValueError("the key has 62 bits at most")
    wide, values = df, []
    for c in columns:
        wide, value = _as_number(wide, c)
        values.append(value)
    shares = F.array(*[F.lit(i / (1 << bits)) for i in range(1, 1 << bits)])
    sketches = wide.agg(*[F.kll_sketch_agg_double(v, F.lit(SKETCH)).alias(v) for v in values], *[F.count(v).alias(f"n_{v}") for v in values])
    told = sketches.select(*[F.when(F.col(f"n_{v}") > 0, F.kll_sketch_get_quantile_double(v, shares)).alias(v) for v in values]).first()
    for v in values:
        wide = _cell(wide, v, told[v] or [0.0] * ((1 << bits) - 1), bits)
    key = interleaved([F.col(f"{v}_cell") for v in values], bits)
    return wide.withColumn(name, key).select(*df.columns, name)


def compact_morton(df: DataFrame, columns: list[str], n_files: int, bits: int = BITS) -> DataFrame:
    """Rows laid out for few files, each a box in all of `columns` rather than a slice of the first."""
    keyed = with_morton_key(df, columns, bits)
    return keyed.repartitionByRange(n_files, _KEY).sortWithinPartitions(_KEY).drop(_KEY)


def file_bounds(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Smallest and largest value of each column in every file, as the file's statistics have them."""
    files = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("file"))
    ends = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    return files.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *ends)


def files_met(bounds: DataFrame, boxes: dict[str, dict[str, tuple]]) -> DataFrame:
    """`box`, `files`, `of_files`: how many files a reader of each box can't skip. A box has (low, high) for some columns."""
    out = bounds.agg(
        F.count(F.lit(1)).alias("of_files"),
        *[
            F.count_if(_overlaps({c: (F.lit(low), F.lit(high)) for c, (low, high) in box.items()})).alias(name)
            for name, box in boxes.items()
        ],
    )
    rows = F.array(*[F.struct(F.lit(name).alias("box"), F.col(name).alias("files"), F.col("of_files")) for name in boxes])
    return out.select(F.inline(rows))


def _overlaps(box: dict[str, tuple[Column, Column]]) -> Column:
    out = F.lit(True)
    for c, (low, high) in box.items():
        out = out & (F.col(f"min_{c}") <= high) & (F.col(f"max_{c}") >= low)
    return out
