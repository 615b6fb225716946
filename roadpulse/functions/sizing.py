"""Counts of rows per key, made before windows are laid out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.session import cut_lineage

# Most rows of one key that a single task should sort.
MAX_GROUP_ROWS = 4_000_000
# Rows of one block when the rows of a key must be split.
BLOCK_ROWS = 1_000_000


def setting(df: DataFrame, name: str, default: int) -> int:
    return int(df.sparkSession.conf.get(f"roadpulse.{name}", str(default)))


@dataclass(frozen=True)
class GroupLoad:
    """Rows of an input, rows of its largest key, the most one task should sort, and the counted keys."""

    rows: int
    largest: int
    bound: int
    sizes: DataFrame | None = None

    @property
    def hot(self) -> bool:
        return self.largest > self.bound


def group_load(df: DataFrame, keys: list[str]) -> GroupLoad:
    """How the rows spread over the keys: one map-side aggregation over the key columns alone.

    Only where a key is oversized the counts are made again, for those keys, and written.
    """
    bound = setting(df, "maxGroupRows", MAX_GROUP_ROWS)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    row = sizes.agg(F.coalesce(F.sum("__rows"), F.lit(0)).alias("rows"), F.coalesce(F.max("__rows"), F.lit(0)).alias("largest")).first()
    if row["largest"] > bound:
        sizes = cut_lineage(sizes.filter(F.col("__rows") > bound))
    return GroupLoad(row["rows"], row["largest"], bound, sizes)
