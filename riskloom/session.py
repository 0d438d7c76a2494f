"""Session settings and the shared folder used for checkpoints and staged tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Start from many shuffle partitions (set spark.sql.shuffle.partitions to the shuffled bytes
    # over this size); adaptive execution merges the small ones.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    # Source texts run from a few bytes to 200 000 characters, so read splits are kept
    # at 64 MB of compressed Parquet: a regex stage then holds a few hundred MB per task.
    "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
}

_LOCAL_FOLDERS: dict[str, str] = {}


def build_session(app: str = "riskloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh path below the folder that ``spark.checkpoint.dir`` names.

    Only a local-mode session may do without that setting; it then gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        root = _LOCAL_FOLDERS.get(app) or tempfile.mkdtemp(prefix="run-", dir="/tmp")
        _LOCAL_FOLDERS[app] = root
    return os.path.join(root, "-".join([*parts, uuid.uuid4().hex[:12]]))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add costly columns that later filters read.

    Catalyst pushes a filter below the projection it reads from and so computes the projection's
    expressions a second time. A projection that also reads the task number is left in place.
    """
    return df.withColumns({**columns, "_task": F.spark_partition_id()}).filter("_task >= 0").drop("_task")

