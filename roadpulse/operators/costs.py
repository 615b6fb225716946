"""Warehouse usage, transfers, slow queries and table sizes from exported logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.columns import before

# Fixed value: price of one credit in USD.
CREDIT_PRICE = 3.00
GIGABYTE = 1024**3


def usage_cost(log: DataFrame, as_of, rate: float = CREDIT_PRICE, days: int = 30) -> DataFrame:
    """Credits, cost and times per warehouse and day."""
    return (
        log.filter(F.col("start_time") >= before(as_of, days, "days"))
        .groupBy("warehouse_name", F.date_trunc("day", "start_time").cast("date").alias("usage_date"))
        .agg(
            F.sum("credits_used").alias("total_credits"),
            (F.sum("credits_used") * rate).alias("estimated_cost_usd"),
            F.count(F.lit(1)).alias("query_count"),
            (F.avg("total_elapsed_ms") / 1000).alias("avg_query_seconds"),
            (F.max("total_elapsed_ms") / 1000).alias("max_query_seconds"),
            (F.avg("queued_ms") / 1000).alias("avg_queue_time"),
        )
    )


def transfer_cost(log: DataFrame, as_of, rate: float = CREDIT_PRICE, days: int = 7) -> DataFrame:
    return log.filter(F.col("start_time") >= before(as_of, days, "days")).select(
        "transfer_id",
        "start_time",
        "region",
        "transfer_type",
        (F.col("bytes_transferred") / GIGABYTE).alias("gb_transferred"),
        "credits_used",
        (F.col("credits_used") * rate).alias("estimated_cost_usd"),
    )


def slow_queries(log: DataFrame, as_of, hours: int = 24, warehouse: str = "TRAFFIC_%", k: int = 100) -> DataFrame:
    """The slowest queries of the period, with seconds and gigabytes."""
    return (
        log.filter((F.col("start_time") >= before(as_of, hours, "hours")) & F.col("warehouse_name").like(warehouse))
        .orderBy(F.desc("total_elapsed_ms"), "query_id")
        .limit(k)
        .select(
            "query_id",
            "warehouse_name",
            "start_time",
            (F.col("total_elapsed_ms") / 1000).alias("duration_seconds"),
            (F.col("bytes_scanned") / GIGABYTE).alias("gb_scanned"),
        )
    )


def table_sizes(catalog: DataFrame) -> DataFrame:
    """Tables by size, largest first."""
    sized = catalog.select("table_schema", "table_name", "row_count", (F.col("bytes") / GIGABYTE).alias("table_size_gb"), "bytes")
    return sized.orderBy(F.desc("bytes"), "table_schema", "table_name")
