"""Side-by-side run of a registered query on Spark and its SQL twin on DuckDB."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, Decimal):
        return f"decimal {value}"
    if isinstance(value, bool):
        return f"bool {value}"
    if isinstance(value, float):
        return f"float {value!r}"
    if isinstance(value, int):
        return f"int {value}"
    return f"{value}"


def rows_of(table) -> tuple[list[str], Counter]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, Counter(tuple(_cell(v) for v in row) for row in zip(*columns, strict=True))


def difference(spark: SparkSession, con, query, text: str, folder: str) -> str | None:
    """None if both sides agree, else a short account of what differs."""
    left_names, left = rows_of(query(spark, folder).toArrow())
    right_names, right = rows_of(con.sql(text).to_arrow_table())
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    if left != right:
        more, less = left - right, right - left
        return (
            f"rows {sum(left.values())} / {sum(right.values())}, differing {sum(more.values())} / {sum(less.values())}\n"
            f"  {left_names}\n  spark {sorted(more.items(), key=str)[:2]}\n  sql   {sorted(less.items(), key=str)[:2]}"
        )
    return None if left else "no rows"


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    bad = 0
    for key, query in entry.queries().items():
        if wanted and key not in wanted:
            continue
        began = time.time()
        text = entry.oracle_sql().get(key)
        try:
            problem = difference(spark, con, query, text, folder) if text else f"(rows only: {query(spark, folder).count()})"
        except Exception as error:
            problem = f"error {type(error).__name__}: {str(error)[:900]}"
        if problem and not problem.startswith("(rows"):
            bad += 1
        print(f"{key:28s} {time.time() - began:6.2f}s {problem or 'ok'}", flush=True)
    print("problems:", bad)
