"""Ordered windows per key that keep working when one key holds most rows.

Keys of bounded size go through a plain window: one shuffle by key. The rows of
oversized keys alone are range-partitioned by (key, order), numbered, and cut into
blocks of equal row count. Each block receives copies of the few neighbouring rows its
frames reach, so no task ever sorts more than a block, and the result is exact.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from roadpulse.functions.sizing import BLOCK_ROWS, GroupLoad, group_load, setting
from roadpulse.session import cut_lineage

_INDEX, _BLOCK, _PLACE, _PART = "__index", "__block", "__place", "__part"
_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def number_rows(df: DataFrame, order: list[Column], rows: int = 0) -> DataFrame:
    """Add the 0-based position of each row in the global order.

    The order must be total (end with a unique column). Positions are fixed by
    writing them, because range bounds are sampled anew on every run. `rows`,
    if known, gives enough partitions for one block of rows in each.
    """
    parts = max(-(-rows // setting(df, "blockRows", BLOCK_ROWS)), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(parts, *order) if rows else df.repartitionByRange(*order)
    placed = cut_lineage(
        ranged.sortWithinPartitions(*order).withColumn(_PLACE, F.monotonically_increasing_id())
    ).withColumn(_PART, F.shiftright(_PLACE, 33))
    offsets = cut_lineage(_starts(placed.groupBy(_PART).agg(F.count(F.lit(1)).alias("__rows"))))
    local = F.col(_PLACE).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.join(offsets, _PART)
        .withColumn(_INDEX, F.col("__start") + local)
        .drop(_PART, _PLACE, "__start")
    )


def _starts(sizes: DataFrame) -> DataFrame:
    """Rows before each part: over groups of parts first, then inside each group."""
    earlier = (Window.unboundedPreceding, -1)
    grouped = sizes.withColumn("__group", F.floor(F.col(_PART) / 1024))
    inside = F.sum("__rows").over(Window.partitionBy("__group").orderBy(_PART).rowsBetween(*earlier))
    groups = grouped.groupBy("__group").agg(F.sum("__rows").alias("__all"))
    before = F.sum("__all").over(Window.orderBy("__group").rowsBetween(*earlier))
    bases = groups.select("__group", F.coalesce(before, F.lit(0)).alias("__base"))
    placed = grouped.withColumn("__inside", F.coalesce(inside, F.lit(0))).join(bases, "__group")
    return placed.select(_PART, (F.col("__base") + F.col("__inside")).alias("__start"))


def _parted(df: DataFrame, keys: list[str], load: GroupLoad) -> tuple[DataFrame, DataFrame]:
    """Rows of bounded keys, and those of oversized ones."""
    hot = load.sizes.filter(F.col("__rows") > load.bound).select(*[F.col(k).alias(f"__hot_{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__hot_{i}")) for i, k in enumerate(keys)])
    return df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi")


def _total_order(keys: list[str], order: list[Column]) -> list[Column]:
    return [F.col(key) for key in keys] + list(order)


def with_windows(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    build: Callable[[WindowSpec], dict[str, Column]],
    before: int = 0,
    after: int = 0,
    load: GroupLoad | None = None,
) -> DataFrame:
    """Add the columns of `build(window)`.

    `build` gets a window partitioned and ordered as asked; its frames may reach
    `before` rows back and `after` rows ahead (counting lag and lead). `load` tells
    how the rows spread over the keys; left out, they are counted, which runs a job.
    """
    load = load or group_load(df, keys)
    plain = build(Window.partitionBy(*keys).orderBy(*order))
    if not load.hot:
        return df.withColumns(plain)
    bounded, df = _parted(df, keys, load)
    size = max(setting(df, "blockRows", BLOCK_ROWS), before + after + 1)
    numbered = number_rows(df, _total_order(keys, order), load.rows)
    own = F.floor(F.col(_INDEX) / size)
    place = F.col(_INDEX) % size
    copies = F.array_compact(
        F.array(
            own,
            F.when(place >= size - before, own + 1),
            F.when((place < after) & (own > 0), own - 1),
        )
    )
    spread = numbered.withColumn(_BLOCK, F.explode(copies))
    window = Window.partitionBy(_BLOCK, *keys).orderBy(_INDEX)
    blocked = spread.withColumns(build(window)).filter(F.col(_BLOCK) == own).drop(_BLOCK, _INDEX)
    return bounded.withColumns(plain).unionByName(blocked)


def carry(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    forward: dict[str, Column],
    backward: dict[str, Column] | None = None,
    load: GroupLoad | None = None,
) -> DataFrame:
    """Add last and next non-null values per key.

    A column of `forward` holds the last non-null value up to the current row, one
    of `backward` the next one from the current row on. The order must be total. `load` is
    as for `with_windows`.
    """
    backward = backward or {}
    load = load or group_load(df, keys)
    plain = {}
    for values, by in ((forward, order), (backward, [c.desc() for c in order])):
        window = Window.partitionBy(*keys).orderBy(*by).rowsBetween(*_SO_FAR)
        plain.update({name: F.last(value, True).over(window) for name, value in values.items()})
    if not load.hot:
        return df.withColumns(plain)
    bounded, df = _parted(df, keys, load)
    size = setting(df, "blockRows", BLOCK_ROWS)
    values = {**forward, **backward}
    numbered = (
        number_rows(df, _total_order(keys, order), load.rows)
        .withColumn(_BLOCK, F.floor(F.col(_INDEX) / size))
        .withColumns({f"__held_{name}": value for name, value in values.items()})
    )
    filled = numbered
    if forward:
        filled = _carry_blocks(filled, numbered, keys, list(forward), reverse=False)
    if backward:
        filled = _carry_blocks(filled, numbered, keys, list(backward), reverse=True)
    filled = filled.drop(_INDEX, _BLOCK, *[f"__held_{name}" for name in values])
    return bounded.withColumns(plain).unionByName(filled)


def _carry_blocks(filled: DataFrame, numbered: DataFrame, keys: list[str], names: list[str], reverse: bool) -> DataFrame:
    """Carry inside each (key, block), then into it what the blocks before it end with."""

    def along(column: str) -> Column:
        return F.col(column).desc() if reverse else F.col(column).asc()

    window = Window.partitionBy(_BLOCK, *keys).orderBy(along(_INDEX)).rowsBetween(*_SO_FAR)
    local = filled.withColumns({name: F.last(f"__held_{name}", True).over(window) for name in names})
    pick = F.min_by if reverse else F.max_by
    closing = numbered.groupBy(*keys, _BLOCK).agg(
        *[pick(f"__held_{n}", F.when(F.col(f"__held_{n}").isNotNull(), F.col(_INDEX))).alias(f"__held_{n}") for n in names]
    )
    # A key has as many rows here as it spans blocks.
    before = Window.partitionBy(*keys).orderBy(along(_BLOCK)).rowsBetween(Window.unboundedPreceding, -1)
    opening = closing.select(
        *[F.col(key).alias(f"__key_{key}") for key in keys],
        F.col(_BLOCK).alias("__opening"),
        F.count(F.lit(1)).over(before).alias("__seen"),
        *[F.last(f"__held_{name}", True).over(before).alias(f"__from_{name}") for name in names],
    ).filter("__seen > 0")
    match = F.col(_BLOCK) == F.col("__opening")
    for key in keys:
        match = match & F.col(key).eqNullSafe(F.col(f"__key_{key}"))
    joined = local.join(opening, match, "left")
    out = joined.withColumns({name: F.coalesce(F.col(name), F.col(f"__from_{name}")) for name in names})
    return out.drop("__opening", "__seen", *[f"__key_{key}" for key in keys], *[f"__from_{name}" for name in names])


def running_sums(df: DataFrame, keys: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """Each column summed from its key's first row to the current one. The order must be total.

    Rows of oversized keys are summed inside blocks first, to which what the key's
    earlier blocks sum up to is added.
    """
    load = group_load(df, keys)
    kinds = {f.name: f.dataType for f in df.schema}
    so_far = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*_SO_FAR)
    plain = {c: F.sum(c).over(so_far).cast(kinds[c]) for c in columns}
    if not load.hot:
        return df.withColumns(plain)
    bounded, hot = _parted(df, keys, load)
    block = F.floor(F.col(_INDEX) / setting(df, "blockRows", BLOCK_ROWS))
    numbered = number_rows(hot, _total_order(keys, order), load.rows).withColumn(_BLOCK, block)
    inside = Window.partitionBy(_BLOCK, *keys).orderBy(_INDEX).rowsBetween(*_SO_FAR)
    # A key has as many rows here as it spans blocks.
    before = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    totals = numbered.groupBy(*keys, _BLOCK).agg(*[F.sum(c).alias(f"__all_{c}") for c in columns])
    opening = totals.select(
        *[F.col(key).alias(f"__key_{key}") for key in keys],
        F.col(_BLOCK).alias("__opening"),
        *[F.sum(f"__all_{c}").over(before).alias(f"__from_{c}") for c in columns],
    )
    match = F.col(_BLOCK) == F.col("__opening")
    for key in keys:
        match = match & F.col(key).eqNullSafe(F.col(f"__key_{key}"))
    local = numbered.withColumns({c: F.sum(c).over(inside) for c in columns})
    joined = local.join(opening, match)
    added = joined.withColumns({c: F.when(F.col(f"__from_{c}").isNull(), F.col(c)).otherwise(F.col(c) + F.col(f"__from_{c}")).cast(kinds[c]) for c in columns})
    return bounded.withColumns(plain).unionByName(added.select(*df.columns))


def keep_first(df: DataFrame, keys: list[str], order: list[Column], last: bool = False) -> DataFrame:
    """One whole row per key: the first (or last) in the given order.

    Spark keeps only the first row of each key in every task before the shuffle, so a
    key with many rows costs no more than any other.
    """
    by = [c.desc() for c in order] if last else order
    numbered = df.withColumn("__place", F.row_number().over(Window.partitionBy(*keys).orderBy(*by)))
    return numbered.filter("__place = 1").drop("__place")
