"""Running sums over the order of a whole table, and the budgets that end somewhere in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import saved


def running_sums(df: DataFrame, order: list[str], costs: dict[str, Column], tasks: int | None = None) -> DataFrame:
    """df with the sum of each cost over all earlier rows, under the costs' names. order: columns that tell all rows apart.

    The table is range-sorted and saved in slices. A slice's total is one row, so the driver adds up as many numbers as there
    are slices; the sums inside a slice are a window over that slice alone.
    """
    spark = df.sparkSession
    tasks = tasks or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    priced = df.withColumns({f"_cost_{name}": F.coalesce(c, F.lit(0)).cast("bigint") for name, c in costs.items()})
    sliced = saved(priced.repartitionByRange(tasks, *order).withColumn("_slice", F.spark_partition_id()), "slices")
    totals = sliced.groupBy("_slice").agg(*[F.sum(f"_cost_{n}").alias(n) for n in costs]).orderBy("_slice").collect()
    before, so_far = [], dict.fromkeys(costs, 0)
    for r in totals:
        before.append((r["_slice"], *so_far.values()))
        so_far = {n: so_far[n] + r[n] for n in costs}
    offsets = spark.createDataFrame(before, "_slice int, " + ", ".join(f"_before_{n} bigint" for n in costs))
    w = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = sliced.join(F.broadcast(offsets), "_slice")  # a row for each slice
    sums = {n: F.col(f"_before_{n}") + F.coalesce(F.sum(f"_cost_{n}").over(w), F.lit(0)) for n in costs}
    return out.withColumns(sums).drop("_slice", *[f"_cost_{n}" for n in costs], *[f"_before_{n}" for n in costs])


def within_budgets(df: DataFrame, order: list[str], requests: Column, titles_budget: int, requests_budget: int) -> DataFrame:
    """df with `spent`: done, exhausted (the requests ran out on the way) or not_attempted.

    In order, each row takes one title and its requests; a row begins while something is left of both budgets.
    """
    costs = {"_titles": F.lit(1), "_requests": requests}
    out = running_sums(df, order, costs)
    begins = (F.col("_titles") < titles_budget) & (F.col("_requests") < requests_budget)
    ends = F.col("_requests") + F.coalesce(requests, F.lit(0)) <= requests_budget
    return out.withColumn("spent", F.when(~begins, "not_attempted").when(ends, "done").otherwise("exhausted")).drop("_titles", "_requests")
