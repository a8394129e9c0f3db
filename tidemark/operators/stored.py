"""The knowledge store as files: a table in buckets of its key's hash, of which a merge rewrites those it touches.

A run first merges the touched buckets into a staged table, so it can fail or be turned down (`check`) while the store is as it
was. Then the staged buckets take the place of the old ones: Spark's dynamic overwrite writes beside the table and moves
files when all tasks have ended. Files of other buckets aren't read, nor written, and keep their names.

The number of buckets belongs to a table: the same one must be given each time, and should let a bucket fit a task. Nothing
but the numbers of touched buckets comes to the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import saved

BUCKETS = 64
#: A bucket whose last row is taken out keeps one row that says so: a bucket that isn't written would stay.
_GONE = "_gone"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def create(df: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS) -> None:
    _write(df.withColumns({_GONE: F.lit(False), "bucket": bucket_of(keys, buckets)}), path, "static")


def _write(rows: DataFrame, path: str, mode: str) -> None:
    rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("bucket").parquet(path)


def _held(spark: SparkSession, path: str, schema) -> DataFrame:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return spark.read.schema(f"{columns}, {_GONE} boolean, bucket int").parquet(path)


def read(spark: SparkSession, path: str, schema) -> DataFrame:
    """schema: the table's columns, as a StructType."""
    return _held(spark, path, schema).where(~F.col(_GONE)).drop(_GONE, "bucket")


def rewrite(path: str, incoming: DataFrame, schema, keys: list[str], change: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = BUCKETS, check: Callable[[int, int], None] | None = None) -> list[int]:
    """The table with its touched buckets as change(their rows, incoming) makes them. check(rows before, rows after) may raise. The touched buckets' numbers.

    change must keep each row's key, or drop the row.
    """
    spark = incoming.sparkSession
    arrived = saved(incoming.withColumn("bucket", bucket_of(keys, buckets)), "incoming")
    touched = sorted(r.bucket for r in arrived.select("bucket").distinct().collect())
    if not touched:
        return []
    held = _held(spark, path, schema).where(F.col("bucket").isin(touched) & ~F.col(_GONE)).drop(_GONE, "bucket")
    names = [f.name for f in schema]
    staged = saved(change(held, arrived.drop("bucket")).select(*names).withColumns({_GONE: F.lit(False), "bucket": bucket_of(keys, buckets)}), "staged")
    if check:
        check(held.count(), staged.count())
    empty = spark.createDataFrame([(b,) for b in touched], "bucket int").join(staged.select("bucket").distinct(), "bucket", "left_anti")
    gone = empty.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema], F.lit(True).alias(_GONE), "bucket")
    _write(staged.unionByName(gone), path, "dynamic")
    return touched


def remove(path: str, unwanted: DataFrame, schema, keys: list[str], buckets: int = BUCKETS, check: Callable[[int, int], None] | None = None) -> list[int]:
    """The table without the rows of these keys."""
    return rewrite(path, unwanted.select(*keys), schema, keys, lambda held, gone: held.join(gone.distinct(), keys, "left_anti"), buckets, check)
