"""Masks and row filters per role."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Role names and the region open to analysts.
MASKED_ROLE = "TRAFFIC_ANALYST"
FULL_ROLES = ["TRAFFIC_ADMIN", "TRAFFIC_LOADER", "TRAFFIC_TRANSFORMER", "TRAFFIC_ML_CONSUMER"]
ANALYST_REGION = "US"


def apply_masks(df: DataFrame, role: str) -> DataFrame:
    """Analysts see positions to one decimal and the first three characters of an id."""
    if role != MASKED_ROLE:
        return df
    masked = {c: F.round(c, 1) for c in ("latitude", "longitude") if c in df.columns}
    if "sensor_id" in df.columns:
        masked["sensor_id"] = F.concat(F.left("sensor_id", F.lit(3)), F.lit("***"))
    return df.withColumns(masked)


def apply_row_policy(df: DataFrame, role: str, region_col: str = "region", analyst_region: str = ANALYST_REGION) -> DataFrame:
    """Four roles see all rows, analysts one region, anyone else nothing."""
    if role in FULL_ROLES:
        return df
    if role == MASKED_ROLE:
        return df.filter(F.col(region_col) == analyst_region)
    return df.filter(F.lit(False))


def publish_view(df: DataFrame, name: str, role: str, region_col: str | None = None) -> None:
    """Temporary view with what the role may see."""
    seen = apply_row_policy(df, role, region_col) if region_col else df
    apply_masks(seen, role).createOrReplaceTempView(f"{name}_{role.lower()}")
