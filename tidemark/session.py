"""Session helpers for tests, benchmarks and jobs that need a shared folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, name: str = "tidemark") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.sql.shuffle.partitions", str(cores)).config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true").config("spark.driver.memory", "8g").getOrCreate()
    )


@cache
def _own_folder(application: str) -> str:
    """One temporary folder an application: spark.checkpoint.dir can't be set in a session that runs."""
    return tempfile.mkdtemp(prefix="tidemark-")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir); a temporary folder only where it is unset, and only in local mode."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = _own_folder(spark.sparkContext.applicationId)
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back, for what several results use: computed once, and its plan ends there."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
