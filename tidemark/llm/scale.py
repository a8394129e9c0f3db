"""Helpers that keep the operators' jobs bounded: shared scratch tables and prefix sums without one big window."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words of every contract of this subpackage: runs of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


@cache
def _own_folder(application: str) -> str:
    """One temporary folder an application: spark.checkpoint.dir can't be set in a session that runs."""
    return tempfile.mkdtemp(prefix="tidemark-")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir); a temporary one only where it is unset, and only in local mode."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = _own_folder(spark.sparkContext.applicationId)
    return found.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut, and its size is known to the optimizer.

    Survives a lost executor, unlike a local checkpoint. A table without rows reads back with its schema.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def chunks_for(n_rows: int) -> int:
    """How many chunks a random order of n_rows is cut into: as many as there are rows in each, so both grow with the root."""
    return max(16, min(1 << 20, math.ceil(math.sqrt(max(1, n_rows)))))


def random_key(*cols: Column) -> Column:
    """32 hex digits that order rows randomly and alike in every run (MD5 of the columns, null as empty)."""
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def chunk_of(key: Column, chunks: int) -> Column:
    """The chunk of a random_key: equal slices of the key space, in the order of the keys."""
    return F.floor(F.conv(F.substring(key, 1, 10), 16, 10).cast("double") * chunks / float(16**10)).cast("int")


def chunk_offsets(totals: DataFrame, group: list[str], chunk: list[str], sums: dict[str, str]) -> DataFrame:
    """For chunk totals: what all earlier chunks of the group hold. sums: total's column -> name of the offset."""
    w = Window.partitionBy(*group).orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumns({to: F.coalesce(F.sum(c).over(w), F.lit(0).cast("long")) for c, to in sums.items()})


def before(value: Column, part: list[str], order: list) -> Column:
    """Sum of value over the earlier rows of the same chunk."""
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(w), F.lit(0).cast("long"))


def let(value: Column, then) -> Column:
    """then(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def crc_of_id(doc_id: Column) -> Column:
    """CRC-32 of the id as text (null as empty), as the contracts' folds take it."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def on_workers(df: DataFrame) -> DataFrame:
    """df, after seeing to it that Python workers started from here on can import this package where it is installed by path."""
    root, env = str(Path(__file__).resolve().parents[2]), df.sparkSession.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
    return df
