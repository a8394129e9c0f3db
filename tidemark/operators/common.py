"""Order-dependent picks, always by an explicit ordinal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick(df: DataFrame, keys: list[str], order: list[Column | str], n: int = 1) -> DataFrame:
    """The first n rows of each key in the order. Spark cuts each task's rows to n a key before it shuffles them."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_pick", F.row_number().over(w)).where(F.col("_pick") <= n).drop("_pick")


def last_wins(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """Of each key the row with the highest ordinal: an aggregate, so a common key is summed in the tasks first."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(ordinal)).alias("_row")).select(*keys, "_row.*")


def first_wins(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(ordinal)).alias("_row")).select(*keys, "_row.*")


def unique_only(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys and value where exactly one value stands for the key."""
    return df.groupBy(*keys).agg(F.min(value).alias(value), F.max(value).alias("_most")).where(F.col(value) == F.col("_most")).drop("_most")


def histogram(df: DataFrame, key: str, ordinal: str | None = None) -> DataFrame:
    """Counts, most common first; ties by first occurrence where there is an ordinal, else by key."""
    counted = df.groupBy(key).agg(F.count("*").alias("n"), *([F.min(ordinal).alias("_first")] if ordinal else []))
    return counted.orderBy(F.desc("n"), F.asc("_first" if ordinal else key)).drop("_first")
