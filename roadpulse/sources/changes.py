"""Change records applied to a keyed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.ordered import keep_first


def latest_changes(changes: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The last change of each key. The order must end with a unique column."""
    return keep_first(changes, keys, [F.col(c) if isinstance(c, str) else c for c in order], last=True)


def apply_changes(
    target: DataFrame, changes: DataFrame, keys: list[str], order: list[str | Column], op_col: str = "operation"
) -> DataFrame:
    """Target after INSERT, UPDATE and DELETE changes: last change wins, deletes remove."""
    last = latest_changes(changes, keys, order)
    upserts = last.filter(F.col(op_col) != "DELETE").select(*target.columns)
    untouched = target.join(last.select(*keys), keys, "left_anti")
    return untouched.select(*target.columns).unionByName(upserts)
