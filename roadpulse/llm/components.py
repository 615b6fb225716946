"""Connected components of a large edge table, by alternating star contractions."""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import drop_folder, work_folder


def _stars(arcs: DataFrame, larger_only: bool) -> DataFrame:
    """Link neighbours of every node `u` in arcs (u, v) to the smallest of them and of `u`."""
    least = arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = arcs.join(least, "u")
    if larger_only:
        return linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)


def _edges(df: DataFrame) -> DataFrame:
    """Distinct edges from the larger end to the smaller."""
    return df.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """`node`, `root` for every node of links (u, v) that isn't its own root; the root is the smallest node.

    Each round is two aggregations and two joins, written to the shared folder, so
    a lost executor costs the current round only; the join keys may be hot, since
    plain joins can be split. Ends when a round changes nothing. Null ends are ignored.
    """
    spark = links.sparkSession

    def stored(df: DataFrame) -> tuple[DataFrame, str, tuple]:
        path = work_folder(spark)
        df.write.parquet(path)
        df = spark.read.schema(df.schema).parquet(path)
        return df, path, tuple(df.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())

    edges, path, mark = stored(_edges(links.select("u", "v").dropna()))
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        wide = _edges(_stars(both, larger_only=True))
        after, new_path, new_mark = stored(_edges(_stars(wide, larger_only=False)))
        with contextlib.suppress(Exception):  # a folder that stays costs only disk
            drop_folder(spark, path)
        edges, path, done, mark = after, new_path, new_mark == mark, new_mark
        if done:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
