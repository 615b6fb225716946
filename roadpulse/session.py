"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "roadpulse", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session; a local one is made only on a local master."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        named = tempfile.mkdtemp(prefix="roadpulse-checkpoint-")
    context.setCheckpointDir(named)
    return named


def work_folder(spark: SparkSession) -> str:
    """New folder name beside the checkpoints, reachable from every executor."""
    return f"{ensure_checkpoint_dir(spark)}/work-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows as a table written to the shared folder.

    They survive the loss of executors, are computed once (a checkpoint computes
    them twice), and later plans know their size and read only the columns they need.
    """
    path = work_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
