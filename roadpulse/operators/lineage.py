"""Lineage graph: nodes, edges, impact and paths."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.session import cut_lineage, work_folder

_NODE = T.StructType(
    [
        T.StructField("resource_type", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("schema", T.StringType()),
        T.StructField(
            "depends_on",
            T.StructType(
                [
                    T.StructField("nodes", T.ArrayType(T.StringType())),
                    T.StructField("sources", T.ArrayType(T.StringType())),
                ]
            ),
        ),
        T.StructField("config", T.StructType([T.StructField("materialized", T.StringType())])),
    ]
)
_SOURCE = T.StructType([T.StructField("name", T.StringType()), T.StructField("schema", T.StringType())])
MANIFEST = T.StructType(
    [
        T.StructField("nodes", T.MapType(T.StringType(), _NODE)),
        T.StructField("sources", T.MapType(T.StringType(), _SOURCE)),
    ]
)


def manifest_nodes(manifests: DataFrame, json_col: str = "value") -> DataFrame:
    """Nodes (id, name, type, schema, materialization) of manifest documents, one document per row."""
    doc = manifests.select(F.from_json(json_col, MANIFEST).alias("m"))
    models = (
        doc.select(F.explode("m.nodes").alias("id", "n"))
        .filter("n.resource_type = 'model'")
        .select(
            "id",
            "n.name",
            F.lit("model").alias("type"),
            "n.schema",
            F.coalesce("n.config.materialized", F.lit("view")).alias("materialization"),
        )
    )
    sources = doc.select(F.explode("m.sources").alias("id", "s")).select(
        "id", "s.name", F.lit("source").alias("type"), "s.schema", F.lit(None).cast("string").alias("materialization")
    )
    return models.unionByName(sources).distinct()


def edges(manifests: DataFrame, json_col: str = "value") -> DataFrame:
    """Edges (src, dst, type) from both dependency lists of every model."""
    models = (
        manifests.select(F.explode(F.from_json(json_col, MANIFEST)["nodes"]).alias("id", "n"))
        .filter("n.resource_type = 'model'")
        .select("id", "n.depends_on.*")
    )
    lists = [("nodes", "model_dependency"), ("sources", "source_dependency")]
    frames = [
        models.select(F.explode(column).alias("src"), F.col("id").alias("dst"), F.lit(kind).alias("type"))
        for column, kind in lists
    ]
    return frames[0].unionByName(frames[1]).distinct()


def impact(links: DataFrame, node: str) -> DataFrame:
    """Every node downstream of `node`, with its smallest number of hops.

    Breadth first: each round joins only the newest nodes to the edges and leaves
    out what was reached before, so cycles end. What is reached lies in one table
    with a part for each round; the number of rounds is the depth of the graph.
    """
    start = links.sparkSession.createDataFrame([(node, node)], "origin string, node string")
    return search(links, start).filter(F.col("hops") > 0).select("node", "hops")


def search(links: DataFrame, starts: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """Breadth-first search from every start (origin, node): one row per pair that is reached.

    Returns `origin, node, parent, critical, hops`: the smallest number of hops, the node
    before (of several, the smallest by name) and whether the path so told touches one of
    `tables` (column `stop`). No path is kept: a row is as short after many hops as after one.
    """
    spark = links.sparkSession
    marks = tables.select(F.col("stop").alias("dst"), F.lit(True).alias("mark")).distinct() if tables is not None else None

    def marked(df: DataFrame) -> DataFrame:
        if marks is None:
            return df.withColumn("mark", F.lit(False))
        return df.join(marks, "dst", "left").withColumn("mark", F.coalesce("mark", F.lit(False)))

    # Whether a node is a table goes with the edge to it, so a round is one join and one aggregate.
    pairs = cut_lineage(marked(links.select("src", "dst").distinct()).select("src", "dst", "mark"))
    folder, schema = work_folder(spark), "origin string, node string, parent string, critical boolean"
    first = marked(starts.select("origin", F.col("node").alias("dst")).distinct())
    frontier = first.select("origin", F.col("dst").alias("node"), F.lit(None).cast("string").alias("parent"), F.col("mark").alias("critical"))
    for hop in count(0):
        frontier.write.parquet(f"{folder}/hops={hop}")
        newest = spark.read.schema(schema).parquet(f"{folder}/hops={hop}")
        reached = spark.read.schema(f"{schema}, hops int").parquet(folder)
        if newest.isEmpty():
            return reached
        step = newest.select("origin", F.col("node").alias("src"), "critical").join(pairs, "src")
        best = step.groupBy("origin", F.col("dst").alias("node")).agg(F.min(F.struct("src", F.col("critical") | F.col("mark"))).alias("via"))
        new = best.join(reached.select("origin", "node"), ["origin", "node"], "left_anti")
        frontier = new.select("origin", "node", F.col("via.src").alias("parent"), F.col("via.col2").alias("critical"))


def impact_report(affected: DataFrame, nodes: DataFrame) -> DataFrame:
    """Affected nodes with how they are hit: direct or indirect, schema, critical or not."""
    joined = affected.join(nodes.select(F.col("id").alias("node"), "schema", "materialization"), "node", "left")
    return joined.select(
        "node",
        F.when(F.col("hops") == 1, "direct").otherwise("indirect").alias("impact"),
        "schema",
        F.coalesce(F.col("materialization") == "table", F.lit(False)).alias("critical"),
    )


def impact_summary(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count(F.lit(1)).alias("total_affected"),
        F.count_if(F.col("impact") == "direct").alias("direct_downstream"),
        F.count_if(F.col("impact") == "indirect").alias("indirect_downstream"),
        F.count_if(F.col("schema") == "ANALYTICS").alias("analytics_models"),
        F.count_if(F.col("schema") == "STAGING").alias("staging_models"),
        F.count_if("critical").alias("critical_models"),
    )


def paths(links: DataFrame, nodes: DataFrame, sources: DataFrame, sinks: DataFrame, k: int = 10) -> DataFrame:
    """The `k` most critical of the shortest paths from a source to a sink.

    First those that touch a materialised table, then the longest, then by source and sink.
    Of equally short paths between two nodes, the one with the smallest last step counts, and
    so on backwards. Only the `k` winners' paths are put together, step by step from their ends.
    """
    tables = nodes.filter("materialization = 'table'").select(F.col("id").alias("stop"))
    reached = search(links, sources.select(F.col("id").alias("origin"), F.col("id").alias("node")), tables)
    ends = sinks.select(F.col("id").alias("node")).distinct()
    order = [F.desc("critical"), F.desc("hops"), F.asc("origin"), F.asc("node")]
    best = cut_lineage(reached.filter("hops > 0").join(ends, "node").orderBy(*order).limit(k))
    steps = reached.select("origin", F.col("node").alias("at"), F.col("parent").alias("before"), F.col("hops").alias("left"))
    walk = best.select("origin", "node", "critical", "hops", F.array("node").alias("path"), F.col("node").alias("at"), F.col("hops").alias("left"))
    for _ in range(best.agg(F.max("hops")).first()[0] or 0):
        # Only rows that are still under way take a step; the hop tells the part of the table.
        moved = walk.join(steps.filter("left > 0"), ["origin", "at", "left"], "left")
        walk = moved.select(
            "origin",
            "node",
            "critical",
            "hops",
            F.when(F.col("before").isNull(), F.col("path")).otherwise(F.array_prepend("path", F.col("before"))).alias("path"),
            F.coalesce("before", "at").alias("at"),
            F.when(F.col("before").isNull(), F.col("left")).otherwise(F.col("left") - 1).alias("left"),
        )
    return walk.select(
        F.col("origin").alias("src"),
        F.col("node").alias("dst"),
        F.array_join("path", " > ").alias("path"),
        F.size("path").alias("length"),
        "critical",
    )


def lineage_summary(nodes: DataFrame, links: DataFrame) -> DataFrame:
    kind = F.col("type")
    counted = nodes.agg(
        F.count(F.lit(1)).alias("total_nodes"),
        F.count_if(kind == "source").alias("sources"),
        F.count_if(kind == "model").alias("models"),
        F.count_if((kind == "model") & (F.col("materialization") == "table")).alias("materialized_tables"),
    )
    return counted.withColumn("total_edges", links.agg(F.count(F.lit(1))).scalar())
