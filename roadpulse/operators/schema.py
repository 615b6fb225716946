"""Schema contracts, drift and compatibility."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Equivalent base types.
TYPE_ALIASES = {
    "INTEGER": "INT",
    "NUMBER": "DECIMAL",
    "NUMERIC": "DECIMAL",
    "DOUBLE": "FLOAT",
    "TIMESTAMP": "TIMESTAMP_NTZ",
    "VARCHAR2": "VARCHAR",
    "STRING": "VARCHAR",
}

# Columns and types the hourly mart is declared with.
HOURLY_CONTRACT = {
    "surrogate_key": "VARCHAR",
    "sensor_id": "VARCHAR(50)",
    "reading_timestamp": "TIMESTAMP_NTZ",
    "traffic_volume": "INTEGER",
    "speed_mph": "FLOAT",
    "occupancy_pct": "FLOAT",
    "road_name": "VARCHAR(100)",
    "direction": "VARCHAR(10)",
    "latitude": "DECIMAL(10,6)",
    "longitude": "DECIMAL(10,6)",
    "hour_of_day": "INTEGER",
    "day_of_week": "INTEGER",
    "is_weekend": "BOOLEAN",
    "is_rush_hour": "BOOLEAN",
    "month": "INTEGER",
    "year": "INTEGER",
    "is_holiday": "BOOLEAN",
    "holiday_name": "VARCHAR(100)",
    "city": "VARCHAR(50)",
    "sensor_road_name": "VARCHAR(100)",
    "rolling_avg_3hr": "FLOAT",
    "rolling_avg_24hr": "FLOAT",
    "volume_pct_change": "FLOAT",
    "traffic_level": "VARCHAR(20)",
    "etl_loaded_at": "TIMESTAMP_NTZ",
}

# Columns and types the raw readings are declared with.
RAW_CONTRACT = {
    "sensor_id": "VARCHAR(50)",
    "timestamp": "TIMESTAMP_NTZ",
    "traffic_volume": "INTEGER",
    "speed_mph": "FLOAT",
    "occupancy_pct": "FLOAT",
    "road_name": "VARCHAR(100)",
    "direction": "VARCHAR(10)",
    "latitude": "DECIMAL(10,6)",
    "longitude": "DECIMAL(10,6)",
    "year": "INTEGER",
    "month": "INTEGER",
    "day": "INTEGER",
    "etl_loaded_at": "TIMESTAMP_NTZ",
}

_CONTRACT_COLUMNS = "table_name string, column_name string, data_type string"


def normalise(data_type: str) -> str:
    """Upper case, alias of the base type resolved, length or precision kept."""
    base, bracket, rest = data_type.strip().upper().partition("(")
    base = base.strip()
    return TYPE_ALIASES.get(base, base) + bracket + rest


def normalised(data_type: Column, with_size: bool = True) -> Column:
    """Column form of `normalise`."""
    text = F.upper(F.trim(data_type))
    base = F.trim(F.substring_index(text, "(", 1))
    aliases = F.create_map(*[F.lit(x) for pair in TYPE_ALIASES.items() for x in pair])
    resolved = F.coalesce(F.try_element_at(aliases, base), base)
    return F.concat(resolved, F.regexp_extract(text, r"\(.*$", 0)) if with_size else resolved


def contract_frame(spark: SparkSession, contracts: dict[str, dict[str, str]]) -> DataFrame:
    rows = [(t, c, kind) for t, columns in contracts.items() for c, kind in columns.items()]
    return spark.createDataFrame(rows, _CONTRACT_COLUMNS)


def observed_schema(df: DataFrame, table_name: str) -> DataFrame:
    """One row per column: name and type, from the metadata alone; no data is read."""
    rows = [(table_name, name, kind.upper()) for name, kind in df.dtypes]
    return df.sparkSession.createDataFrame(rows, _CONTRACT_COLUMNS)


def column_completeness(df: DataFrame, table_name: str) -> DataFrame:
    """Per column: rows and null rows, from one pass over the data. A matter apart from drift."""
    nulls = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    rows = [
        F.struct(
            F.lit(table_name).alias("table_name"), F.lit(name).alias("column_name"),
            F.col("total").alias("total_rows"), F.col(f"n{i}").alias("null_rows"),
        )
        for i, name in enumerate(df.columns)
    ]
    return nulls.select(F.inline(F.array(*rows)))


def drift(current: DataFrame, contract: DataFrame, with_size: bool = False) -> DataFrame:
    """New, removed and retyped columns. Names compare in any case.

    Precision and scale of decimals always count; the sizes of other types are left out
    by default, because a Spark string has none.
    """
    key = ["table_name", "column_key"]
    have = current.select("table_name", F.lower("column_name").alias("column_key"), F.col("data_type").alias("current_type"))
    want = contract.select("table_name", F.lower("column_name").alias("column_key"), F.col("data_type").alias("expected_type"))
    decimals = normalised(F.col("current_type"), False).eqNullSafe("DECIMAL") & normalised(F.col("expected_type"), False).eqNullSafe("DECIMAL")
    have_type, want_type = (
        normalised(F.col(c), True) if with_size else F.when(decimals, F.regexp_replace(normalised(F.col(c), True), " ", "")).otherwise(normalised(F.col(c), False))
        for c in ("current_type", "expected_type")
    )
    kind = (
        F.when(F.col("expected_type").isNull(), "new_column")
        .when(F.col("current_type").isNull(), "removed_column")
        .when(have_type != want_type, "type_change")
    )
    return (
        have.join(want, key, "full")
        .withColumn("change", kind)
        .filter("change is not null")
        .select("table_name", F.col("column_key").alias("column_name"), "change", "expected_type", "current_type")
    )


def drift_summary(changes: DataFrame, tables_checked: DataFrame) -> DataFrame:
    """One row over all checked tables (`tables_checked`: frame with table_name)."""
    per_kind = changes.agg(
        F.count(F.lit(1)).alias("total_changes"),
        F.countDistinct("table_name").alias("tables_changed"),
        F.count_if(F.col("change") == "new_column").alias("new_columns"),
        F.count_if(F.col("change") == "removed_column").alias("removed_columns"),
        F.count_if(F.col("change") == "type_change").alias("type_changes"),
    )
    return per_kind.withColumn("tables_checked", tables_checked.agg(F.countDistinct("table_name")).scalar())


def schema_set_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Columns in one schema frame and not in the other, with the side that has them."""
    names_a = a.select(F.lower("column_name").alias("column_name"))
    names_b = b.select(F.lower("column_name").alias("column_name"))
    only_a = names_a.exceptAll(names_b).withColumn("side", F.lit("left_only"))
    return only_a.unionByName(names_b.exceptAll(names_a).withColumn("side", F.lit("right_only")))


# Types that an older value can be read as without loss.
WIDER_TYPES = {
    "int": {"bigint", "float", "double"},
    "bigint": {"float", "double"},
    "float": {"double"},
    "string": {"binary"},
    "binary": {"string"},
}


def schema_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in schema]
    return spark.createDataFrame(rows, "column_name string, data_type string, nullable boolean")


def compat(old: DataFrame, new: DataFrame) -> DataFrame:
    """Fields that break backward compatibility: a reader with the new schema must read old data.

    An added field must be nullable and a changed type must be wider. Removing a
    field is allowed. Both inputs come from `schema_rows`.
    """
    wider = F.create_map(
        *[x for name, wide in WIDER_TYPES.items() for x in (F.lit(name), F.array(*[F.lit(w) for w in sorted(wide)]))]
    )
    o = old.select("column_name", F.col("data_type").alias("old_type"), F.col("nullable").alias("old_nullable"))
    n = new.select("column_name", F.col("data_type").alias("new_type"), F.col("nullable").alias("new_nullable"))
    readable = F.coalesce(F.array_contains(F.try_element_at(wider, "old_type"), F.col("new_type")), F.lit(False))
    problem = (
        F.when(F.col("old_type").isNull() & ~F.col("new_nullable"), "added_field_not_nullable")
        .when((F.col("old_type") != F.col("new_type")) & ~readable, "type_not_readable")
        .when(F.col("old_nullable") & ~F.col("new_nullable"), "nullable_became_required")
    )
    joined = n.join(o, "column_name", "left").withColumn("problem", problem)
    return joined.filter("problem is not null").select("column_name", "old_type", "new_type", "problem")
