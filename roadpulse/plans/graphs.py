"""Registered queries: checks, schema drift, lineage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from roadpulse.operators import enrich, lineage, quality, schema
from roadpulse.plans.base import HOURLY_COLUMNS, hourly, hourly_layout, sensor_versions, sql, staged, staged_weather
from roadpulse.sources import adapters

AS_OF = "2024-01-25 00:00:00"
LEVELS = ["low", "medium", "high", "congested"]
RANGES = {"traffic_volume": (100, 5000), "speed_mph": (10, 60)}
START = "region.0"


def _unique(spark, d):
    df = staged(spark, d).withColumn("hour", F.date_trunc("hour", "reading_timestamp"))
    return quality.check_unique(df, ["sensor_id", "hour"])


def _parents(spark, d):
    return sensor_versions(spark, d).filter(F.col("city") == "P").filter("is_current").select("sensor_id")


def suite(spark, d):
    """Rules over the same table share one pass."""
    df, wx = staged(spark, d), staged_weather(spark, d)
    # Key and level come from the reading alone; the joins, each with at most one match, add no row.
    mart = enrich.with_key_and_level(enrich.one_per_instant(df.select("sensor_id", "reading_timestamp", "event_id", "traffic_volume")))
    row_rules = [
        *quality.not_null(["sensor_id", "reading_timestamp", "traffic_volume", "speed_mph"]),
        *quality.accepted_range(RANGES),
        *quality.accepted_values({"hour_of_day": list(range(24)), "day_of_week": [1, 2, 3, 4, 5]}),
        *quality.not_in_future("reading_timestamp", AS_OF),
    ]
    return quality.run_checks(
        [
            quality.check_rows(df, row_rules),
            quality.check_rows(wx, quality.severity_consistent()),
            quality.check_rows(mart, [*quality.not_null(["surrogate_key"]), *quality.level_consistent()]),
            quality.check_unique(mart, ["surrogate_key"]),
            quality.check_relationship(df, _parents(spark, d), "sensor_id"),
        ]
    )


def _contract(spark):
    return schema.contract_frame(spark, {"MART_HOURLY_TRAFFIC": schema.HOURLY_CONTRACT, "TRAFFIC_EVENTS": schema.RAW_CONTRACT})


def drift(spark, d):
    """Both declared tables against what the package makes."""
    mart = schema.observed_schema(hourly_layout(spark, d).select(*HOURLY_COLUMNS), "MART_HOURLY_TRAFFIC")
    raw = schema.observed_schema(adapters.readings(spark, d).withColumnRenamed("reading_timestamp", "timestamp"), "TRAFFIC_EVENTS")
    changes = schema.drift(mart.unionByName(raw), _contract(spark))
    kept = [schema.normalised(F.col(c), with_size=False).alias(c) for c in ("expected_type", "current_type")]
    return changes.select("table_name", "column_name", "change", *kept)


def drift_summary(spark, d):
    return schema.drift_summary(drift(spark, d), _contract(spark).select("table_name").distinct())


def set_diff(spark, d):
    """Columns of the raw readings against those of the mart."""
    raw = schema.observed_schema(adapters.readings(spark, d), "readings")
    mart = schema.observed_schema(hourly_layout(spark, d).select(*HOURLY_COLUMNS), "hourly")
    return schema.schema_set_diff(raw, mart)


def normalised_types(spark, d):
    """Declared and observed types of the raw readings and of the given tables, as they are compared."""
    seen = [schema.observed_schema(adapters.table(spark, d, t), t) for t in ("orders", "events", "documents")]
    every = reduce(lambda a, b: a.unionByName(b), [_contract(spark), *seen])
    return every.select("table_name", "column_name", schema.normalised(F.col("data_type")).alias("data_type"))


def compatibility(spark, d):
    """Whether a reader of a later layout of the orders can read the given ones: a type that narrows, one that widens, new fields."""
    old = schema.schema_rows(spark, adapters.table(spark, d, "orders").schema)
    changed = F.expr("CASE column_name WHEN 'o_totalprice' THEN 'int' WHEN 'o_orderkey' THEN 'double' ELSE data_type END")
    kept = old.filter("column_name <> 'o_orderpriority'").select("column_name", changed.alias("data_type"), (F.col("column_name") != "o_orderdate").alias("nullable"))
    added = spark.sql("SELECT * FROM VALUES ('o_channel', 'string', true), ('o_checked', 'boolean', false) AS t(column_name, data_type, nullable)")
    return schema.compat(old, kept.unionByName(added))


def _id(kind, column):
    return F.concat(F.lit(f"{kind}."), F.col(column).cast("string"))


def links(spark, d):
    n, c, o = (adapters.table(spark, d, t) for t in ("nation", "customer", "orders"))
    pairs = [
        n.select(_id("region", "n_regionkey").alias("src"), _id("nation", "n_nationkey").alias("dst")),
        c.select(_id("nation", "c_nationkey").alias("src"), _id("customer", "c_custkey").alias("dst")),
        o.select(_id("customer", "o_custkey").alias("src"), _id("order", "o_orderkey").alias("dst")),
    ]
    return reduce(lambda a, b: a.unionByName(b), pairs)


def tangled_links(spark, d):
    """The same graph with ways back to the regions, shortcuts to customers and orders, and chains of orders."""
    c, o = (adapters.table(spark, d, t) for t in ("customer", "orders"))
    more = [
        o.filter("o_orderkey % 97 = 0").select(_id("order", "o_orderkey").alias("src"), F.expr("concat('region.', o_orderkey % 5)").alias("dst")),
        c.filter("c_custkey % 7 = 0").select(F.expr("concat('region.', c_custkey % 5)").alias("src"), _id("customer", "c_custkey").alias("dst")),
        o.filter("o_orderkey % 11 = 0").select(F.expr("concat('nation.', o_orderkey % 25)").alias("src"), _id("order", "o_orderkey").alias("dst")),
        o.filter("o_orderkey % 13 = 0").select(_id("order", "o_orderkey").alias("src"), F.expr("concat('order.', o_orderkey, '.part')").alias("dst")),
    ]
    return reduce(lambda a, b: a.unionByName(b), [links(spark, d), *more])


def nodes(spark, d):
    r, n, c, o = (adapters.table(spark, d, t) for t in ("region", "nation", "customer", "orders"))

    def kind(df, name, key, node_type, schema_name, table):
        return df.select(
            _id(name, key).alias("id"), F.lit(node_type).alias("type"), F.lit(schema_name).alias("schema"),
            F.when(table, "table").otherwise("view").alias("materialization"),
        )

    return reduce(
        lambda a, b: a.unionByName(b),
        [
            kind(r, "region", "r_regionkey", "source", "RAW", F.lit(False)),
            kind(n, "nation", "n_nationkey", "model", "STAGING", F.lit(False)),
            kind(c, "customer", "c_custkey", "model", "STAGING", F.col("c_acctbal") > 5000),
            kind(o, "order", "o_orderkey", "model", "ANALYTICS", F.col("o_orderstatus") == "F"),
        ],
    )


def manifests(spark, d):
    """One manifest document per customer: a model that depends on its nation's model and its region's source."""
    dims = adapters.sensor_dimension(spark, d)
    model = F.struct(
        F.lit("model").alias("resource_type"), F.col("c_name").alias("name"), F.lit("STAGING").alias("schema"),
        F.struct(F.array(_id("nation", "n_nationkey")).alias("nodes"), F.array(_id("region", "r_regionkey")).alias("sources")).alias("depends_on"),
        F.struct(F.when(F.col("c_acctbal") > 5000, "table").otherwise("view").alias("materialized")).alias("config"),
    )
    source = F.struct(F.col("r_name").alias("name"), F.lit("RAW").alias("schema"))
    doc = F.struct(
        F.create_map(_id("customer", "c_custkey"), model).alias("nodes"), F.create_map(_id("region", "r_regionkey"), source).alias("sources")
    )
    return dims.select(F.to_json(doc).alias("value"))


def impact(spark, d):
    return lineage.impact_report(lineage.impact(links(spark, d), START), nodes(spark, d))


def paths(spark, d):
    every = nodes(spark, d)
    return lineage.paths(links(spark, d), every, every.filter("type = 'source'"), every.filter("schema = 'ANALYTICS'"))


def tangled_impact(spark, d):
    return lineage.impact(tangled_links(spark, d), START)


def tangled_paths(spark, d):
    every = nodes(spark, d)
    return lineage.paths(tangled_links(spark, d), every, every.filter(F.col("id") == START), every.filter("schema = 'ANALYTICS'"))


QUERIES = {
    "check_not_null": lambda s, d: quality.check_not_null(staged(s, d), ["sensor_id", "reading_timestamp", "traffic_volume", "speed_mph"]),
    "check_unique": _unique,
    "check_accepted_range": lambda s, d: quality.check_accepted_range(staged(s, d), RANGES),
    "check_accepted_values": lambda s, d: quality.check_accepted_values(
        staged(s, d), {"hour_of_day": list(range(24)), "day_of_week": [1, 2, 3, 4, 5], "road_name": ["click", "view"]}
    ),
    "check_relationship": lambda s, d: quality.check_relationship(staged(s, d), _parents(s, d), "sensor_id"),
    "check_future_time": lambda s, d: quality.check_future_time(staged(s, d), "reading_timestamp", AS_OF),
    "check_level_consistency": lambda s, d: quality.check_level_consistency(hourly(s, d)),
    "check_severity_consistency": lambda s, d: quality.check_severity_consistency(staged_weather(s, d)),
    "check_suite": suite,
    "schema_drift": drift,
    "schema_drift_summary": drift_summary,
    "schema_set_diff": set_diff,
    "type_normalise": normalised_types,
    "schema_compat": compatibility,
    "lineage_edges": lambda s, d: lineage.edges(manifests(s, d)),
    "lineage_nodes": lambda s, d: lineage.manifest_nodes(manifests(s, d)),
    "lineage_impact": impact,
    "lineage_impact_summary": lambda s, d: lineage.impact_summary(impact(s, d)),
    "lineage_impact_cycles": tangled_impact,
    "lineage_paths": paths,
    "lineage_paths_cycles": tangled_paths,
    "lineage_summary": lambda s, d: lineage.lineage_summary(nodes(s, d), links(s, d)),
}


def _check(name: str, column: str, bad: str, table: str) -> str:
    return f"""SELECT '{name}' AS "check", '{column}' AS "column", v AS violations, v = 0 AS passed
        FROM (SELECT count(*) FILTER ({bad}) AS v FROM {table})"""


def _all(*checks: str) -> str:
    return " UNION ALL ".join(checks)


_NOT_NULL = [_check("not_null", c, f"{c} IS NULL", "staged") for c in ("sensor_id", "reading_timestamp", "traffic_volume", "speed_mph")]
_RANGE = [_check("accepted_range", c, f"{c} NOT BETWEEN {lo} AND {hi}", "staged") for c, (lo, hi) in RANGES.items()]
_VALUES = [
    _check("accepted_values", "hour_of_day", "hour_of_day NOT BETWEEN 0 AND 23", "staged"),
    _check("accepted_values", "day_of_week", "day_of_week NOT IN (1, 2, 3, 4, 5)", "staged"),
]
_FUTURE = _check("future_time", "reading_timestamp", f"reading_timestamp > TIMESTAMP '{AS_OF}'", "staged")
_LEVEL = _check("level_consistency", "traffic_level", "traffic_volume > 5000 AND traffic_level = 'low'", "hourly")
_SEVERITY = _check("severity_consistency", "weather_severity", "weather_severity > 5 AND NOT is_precipitation", "staged_weather")
_ORPHANS = _check(
    "relationship", "sensor_id", "sensor_id NOT IN (SELECT sensor_id FROM versions WHERE is_current AND city = 'P')", "staged"
)
_TYPES = {"VARCHAR": "VARCHAR", "INTEGER": "INT", "BIGINT": "BIGINT", "DOUBLE": "FLOAT", "TIMESTAMP": "TIMESTAMP_NTZ", "BOOLEAN": "BOOLEAN"}
_TYPE_CASES = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _TYPES.items())
_RAW_COLUMNS = [
    "sensor_id", "reading_timestamp", "traffic_volume", "speed_mph", "occupancy_pct", "road_name", "direction",
    "latitude", "longitude", "event_id",
]


def _have(table: str, source: str, columns: list[str]) -> str:
    rows = [(c, "timestamp" if source == "readings" and c == "reading_timestamp" else c) for c in columns]
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS column_name, CASE typeof({c}) {_TYPE_CASES} END AS current_type FROM (SELECT * FROM {source} LIMIT 1)"
        for c, name in rows
    )


def _want(table: str, contract: dict[str, str]) -> str:
    return ", ".join(f"('{table}', '{c}', '{schema.normalise(kind).partition('(')[0]}')" for c, kind in contract.items())


# The declared types as they are normalised.
_DECLARED = ", ".join(
    f"('{table}', '{c}', '{kind.replace('INTEGER', 'INT')}')"
    for table, contract in (("MART_HOURLY_TRAFFIC", schema.HOURLY_CONTRACT), ("TRAFFIC_EVENTS", schema.RAW_CONTRACT))
    for c, kind in contract.items()
)
DRIFT_SQL = f""", have AS ({_have("MART_HOURLY_TRAFFIC", "hourly", HOURLY_COLUMNS)} UNION ALL {_have("TRAFFIC_EVENTS", "readings", _RAW_COLUMNS)}),
    want AS (SELECT * FROM (VALUES {_want("MART_HOURLY_TRAFFIC", schema.HOURLY_CONTRACT)}, {_want("TRAFFIC_EVENTS", schema.RAW_CONTRACT)})
        t(table_name, column_name, expected_type)),
    drift AS (SELECT table_name, column_name,
    CASE WHEN expected_type IS NULL THEN 'new_column' WHEN current_type IS NULL THEN 'removed_column' ELSE 'type_change' END AS change,
    expected_type, current_type FROM have FULL JOIN want USING (table_name, column_name) WHERE expected_type IS DISTINCT FROM current_type)"""
_LINKS = """WITH RECURSIVE links AS (
    SELECT 'region.' || n_regionkey AS src, 'nation.' || n_nationkey AS dst FROM nation
    UNION ALL SELECT 'nation.' || c_nationkey, 'customer.' || c_custkey FROM customer
    UNION ALL SELECT 'customer.' || o_custkey, 'order.' || o_orderkey FROM orders),
nodes AS (
    SELECT 'region.' || r_regionkey AS id, 'source' AS type, 'RAW' AS schema, 'view' AS materialization FROM region
    UNION ALL SELECT 'nation.' || n_nationkey, 'model', 'STAGING', 'view' FROM nation
    UNION ALL SELECT 'customer.' || c_custkey, 'model', 'STAGING', CASE WHEN c_acctbal > 5000 THEN 'table' ELSE 'view' END FROM customer
    UNION ALL SELECT 'order.' || o_orderkey, 'model', 'ANALYTICS', CASE WHEN o_orderstatus = 'F' THEN 'table' ELSE 'view' END FROM orders)"""
# More hops than any shortest path of the given tables has.
MOST_HOPS = 25
_TANGLED = _LINKS + """, tangled AS (SELECT * FROM links
    UNION SELECT 'order.' || o_orderkey, 'region.' || (o_orderkey % 5) FROM orders WHERE o_orderkey % 97 = 0
    UNION SELECT 'region.' || (c_custkey % 5), 'customer.' || c_custkey FROM customer WHERE c_custkey % 7 = 0
    UNION SELECT 'nation.' || (o_orderkey % 25), 'order.' || o_orderkey FROM orders WHERE o_orderkey % 11 = 0
    UNION SELECT 'order.' || o_orderkey, 'order.' || o_orderkey || '.part' FROM orders WHERE o_orderkey % 13 = 0)"""
_IMPACT = f"""{_LINKS}, down AS (SELECT dst AS node, 1 AS hops FROM links WHERE src = '{START}'
    UNION SELECT l.dst, d.hops + 1 FROM down d JOIN links l ON l.src = d.node),
report AS (SELECT node, CASE WHEN min(hops) = 1 THEN 'direct' ELSE 'indirect' END AS impact, schema, materialization = 'table' AS critical
    FROM down JOIN nodes ON id = node GROUP BY ALL) """

ORACLES = {
    "check_not_null": sql(_all(*_NOT_NULL)),
    "check_unique": sql(_check("unique", "sensor_id,hour", "n > 1",
        "(SELECT sensor_id, date_trunc('hour', reading_timestamp) AS h, count(*) AS n FROM staged GROUP BY ALL)")),
    "check_accepted_range": sql(_all(*_RANGE)),
    "check_accepted_values": sql(_all(*_VALUES, _check("accepted_values", "road_name", "road_name NOT IN ('click', 'view')", "staged"))),
    "check_relationship": sql(_ORPHANS),
    "check_future_time": sql(_FUTURE),
    "check_level_consistency": sql(_LEVEL),
    "check_severity_consistency": sql(_SEVERITY),
    "check_suite": sql(_all(*_NOT_NULL, *_RANGE, *_VALUES, _FUTURE, _SEVERITY,
        _check("not_null", "surrogate_key", "surrogate_key IS NULL", "hourly"),
        _check("unique", "surrogate_key", "n > 1", "(SELECT surrogate_key, count(*) AS n FROM hourly GROUP BY ALL)"), _LEVEL, _ORPHANS)),
    "schema_drift": sql(DRIFT_SQL + " SELECT * FROM drift"),
    "schema_drift_summary": sql(DRIFT_SQL + """ SELECT count(*) AS total_changes, count(DISTINCT table_name) AS tables_changed,
        count(*) FILTER (change = 'new_column') AS new_columns, count(*) FILTER (change = 'removed_column') AS removed_columns,
        count(*) FILTER (change = 'type_change') AS type_changes, 2::BIGINT AS tables_checked FROM drift"""),
    "type_normalise": f"""WITH seen AS (SELECT table_name, column_name, CASE data_type WHEN 'VARCHAR' THEN 'VARCHAR' WHEN 'INTEGER' THEN 'INT'
            WHEN 'DOUBLE' THEN 'FLOAT' WHEN 'TIMESTAMP' THEN 'TIMESTAMP_NTZ' ELSE data_type END AS data_type FROM (
            SELECT 'orders' AS table_name, column_name, column_type AS data_type FROM (DESCRIBE orders)
            UNION ALL SELECT 'events', column_name, column_type FROM (DESCRIBE events)
            UNION ALL SELECT 'documents', column_name, column_type FROM (DESCRIBE documents)))
        SELECT * FROM seen UNION ALL SELECT * FROM (VALUES {_DECLARED})""",
    "schema_compat": """SELECT column_name, old_type, new_type, problem FROM (
            SELECT column_name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
                ELSE lower(column_type) END AS old_type,
            CASE column_name WHEN 'o_totalprice' THEN 'int' WHEN 'o_orderkey' THEN 'double' ELSE old_type END AS new_type,
            CASE WHEN column_name = 'o_totalprice' THEN 'type_not_readable'
                WHEN column_name = 'o_orderdate' THEN 'nullable_became_required' END AS problem FROM (DESCRIBE orders))
        WHERE problem IS NOT NULL
        UNION ALL SELECT 'o_checked', NULL, 'boolean', 'added_field_not_nullable'""",
    "schema_set_diff": sql(""", have AS (SELECT unnest(map_keys(to_json(t)::MAP(VARCHAR, JSON))) AS column_name
            FROM (SELECT * FROM readings LIMIT 1) t),
        want AS (SELECT unnest(map_keys(to_json(t)::MAP(VARCHAR, JSON))) AS column_name FROM (SELECT * EXCLUDE (event_id) FROM hourly LIMIT 1) t)
        SELECT column_name, 'left_only' AS side FROM have WHERE column_name NOT IN (SELECT column_name FROM want)
        UNION ALL SELECT column_name, 'right_only' FROM want WHERE column_name NOT IN (SELECT column_name FROM have)"""),
    "lineage_edges": """SELECT 'nation.' || c_nationkey AS src, 'customer.' || c_custkey AS dst, 'model_dependency' AS type FROM customer
        UNION ALL SELECT 'region.' || n_regionkey, 'customer.' || c_custkey, 'source_dependency' FROM customer
        JOIN nation ON c_nationkey = n_nationkey""",
    "lineage_nodes": """SELECT 'customer.' || c_custkey AS id, c_name AS name, 'model' AS type, 'STAGING' AS schema,
            CASE WHEN c_acctbal > 5000 THEN 'table' ELSE 'view' END AS materialization FROM customer
        UNION ALL SELECT DISTINCT 'region.' || r_regionkey, r_name, 'source', 'RAW', NULL FROM customer
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "lineage_impact": _IMPACT + "SELECT * FROM report",
    "lineage_impact_summary": _IMPACT + """SELECT count(*) AS total_affected, count(*) FILTER (impact = 'direct') AS direct_downstream,
        count(*) FILTER (impact = 'indirect') AS indirect_downstream, count(*) FILTER (schema = 'ANALYTICS') AS analytics_models,
        count(*) FILTER (schema = 'STAGING') AS staging_models, count(*) FILTER (critical) AS critical_models FROM report""",
    "lineage_paths": _LINKS + """, found AS (SELECT a.src, c.dst, a.src || ' > ' || a.dst || ' > ' || b.dst || ' > ' || c.dst AS path,
            bool_or(n.materialization = 'table') AS critical
        FROM links a JOIN links b ON b.src = a.dst JOIN links c ON c.src = b.dst JOIN nodes n ON n.id IN (b.dst, c.dst)
        WHERE a.src LIKE 'region.%' GROUP BY ALL)
        SELECT src, dst, path, CAST(4 AS INTEGER) AS length, critical FROM found ORDER BY critical DESC, src, dst LIMIT 10""",
    "lineage_impact_cycles": _TANGLED + f""", down AS (SELECT dst AS node, 1 AS hops FROM tangled WHERE src = '{START}'
            UNION SELECT l.dst, d.hops + 1 FROM down d JOIN tangled l ON l.src = d.node WHERE d.hops < {MOST_HOPS})
        SELECT node, CAST(min(hops) AS INTEGER) AS hops FROM down WHERE node <> '{START}' GROUP BY node""",
    "lineage_paths_cycles": _TANGLED + f""", reach AS (SELECT id AS origin, id AS node, 0 AS hops FROM nodes WHERE id = '{START}'
            UNION SELECT r.origin, l.dst, r.hops + 1 FROM reach r JOIN tangled l ON l.src = r.node WHERE r.hops < {MOST_HOPS}),
        least AS MATERIALIZED (SELECT origin, node, min(hops) AS hops FROM reach GROUP BY ALL),
        told AS MATERIALIZED (SELECT a.origin, a.node, a.hops, min(l.src) AS parent FROM least a
            JOIN tangled l ON l.dst = a.node JOIN least b ON b.origin = a.origin AND b.node = l.src AND b.hops = a.hops - 1 GROUP BY ALL),
        flags AS (SELECT id AS origin, id AS node, 0 AS hops, materialization = 'table' AS critical FROM nodes WHERE id = '{START}'
            UNION ALL SELECT t.origin, t.node, t.hops, f.critical OR coalesce(n.materialization = 'table', FALSE)
            FROM flags f JOIN told t ON t.origin = f.origin AND t.parent = f.node AND t.hops = f.hops + 1 LEFT JOIN nodes n ON n.id = t.node),
        top AS (SELECT f.* FROM flags f JOIN nodes n ON n.id = f.node AND n.schema = 'ANALYTICS' WHERE hops > 0
            ORDER BY critical DESC, hops DESC, origin, node LIMIT 10),
        walk AS (SELECT *, node AS stop, node AS path, hops AS here FROM top
            UNION ALL SELECT w.origin, w.node, w.hops, w.critical, t.parent, t.parent || ' > ' || w.path, w.here - 1
            FROM walk w JOIN told t ON t.origin = w.origin AND t.node = w.stop)
        SELECT origin AS src, node AS dst, path, CAST(hops + 1 AS INTEGER) AS length, critical FROM walk WHERE here = 0""",
    "lineage_summary": _LINKS + """ SELECT count(*) AS total_nodes, count(*) FILTER (type = 'source') AS sources,
        count(*) FILTER (type = 'model') AS models, count(*) FILTER (type = 'model' AND materialization = 'table') AS materialized_tables,
        (SELECT count(*) FROM links) AS total_edges FROM nodes""",
}
