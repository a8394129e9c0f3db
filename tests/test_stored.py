"""The store as files: touched buckets only, and nothing lost when a run fails."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators import guide, store, stored

SCHEMA = "imdb_id string, title string, ord bigint"


def files(path):
    return {str(p.relative_to(path)) for p in Path(path).rglob("*.parquet")}


def rows(spark, path, schema):
    return sorted(tuple(r) for r in stored.read(spark, path, schema).collect())


def test_a_merge_rewrites_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "titles")
    held = spark.createDataFrame([(f"tt{k}", f"T{k}", k) for k in range(200)], SCHEMA)
    stored.create(held, path, ["imdb_id"], 16)
    before = files(path)
    new = spark.createDataFrame([("tt7", "", 1000), ("tt8", "New", 1001), ("tt999", "More", 1002)], SCHEMA)
    merge = lambda old, more: store.merge_nonempty(old, more, ["imdb_id"], "ord")
    touched = stored.rewrite(path, new, held.schema, ["imdb_id"], merge, 16)
    after = files(path)
    assert 1 <= len(touched) <= 3 and {f.split("/")[0] for f in before - after} == {f"bucket={b}" for b in touched} - ({f.split("/")[0] for f in after} - {f.split("/")[0] for f in before})
    assert all(f in after for f in before if int(f.split("/")[0].split("=")[1]) not in touched)
    want = {f"tt{k}": (f"T{k}", k) for k in range(200)} | {"tt7": ("T7", 1000), "tt8": ("New", 1001), "tt999": ("More", 1002)}
    assert rows(spark, path, held.schema) == sorted((k, *v) for k, v in want.items())
    assert stored.rewrite(path, new.limit(0), held.schema, ["imdb_id"], merge, 16) == [] and files(path) == after


def test_failed_and_refused_runs_leave_the_table(spark, tmp_path):
    path = str(tmp_path / "titles")
    held = spark.createDataFrame([(f"tt{k}", f"T{k}", k) for k in range(50)], SCHEMA)
    stored.create(held, path, ["imdb_id"], 4)
    before, was = files(path), rows(spark, path, held.schema)
    broken = lambda old, more: old.withColumn("title", F.when(F.col("ord") > 40, F.raise_error(F.lit("broken")).cast("string")).otherwise(F.col("title")))
    with pytest.raises(Exception, match="broken"):
        stored.rewrite(path, held, held.schema, ["imdb_id"], broken, 4)
    assert files(path) == before and rows(spark, path, held.schema) == was
    gate = lambda a, b: guide.gate_drop(a, b, 10, 0.5, "titles")
    with pytest.raises(guide.GateClosed, match="titles"):
        stored.remove(path, held.where("ord < 45"), held.schema, ["imdb_id"], 4, gate)
    assert files(path) == before and rows(spark, path, held.schema) == was


def test_remove_also_the_last_row_of_a_bucket(spark, tmp_path):
    path = str(tmp_path / "titles")
    held = spark.createDataFrame([(f"tt{k}", f"T{k}", k) for k in range(10)], SCHEMA)
    stored.create(held, path, ["imdb_id"], 64)
    stored.remove(path, held.where("ord % 2 = 0"), held.schema, ["imdb_id"], 64)
    assert rows(spark, path, held.schema) == [(f"tt{k}", f"T{k}", k) for k in range(1, 10, 2)]
    stored.rewrite(path, held.where("ord = 4"), held.schema, ["imdb_id"], lambda old, more: old.unionByName(more), 64)
    assert [r[2] for r in rows(spark, path, held.schema)] == [1, 3, 4, 5, 7, 9]


def test_a_customer_of_both_new_tables_has_the_later_name(spark, tmp_path):
    import duckdb

    from tidemark.plans import report_queries

    both = range(5050, 50_000, 5100)  # odd fifties that also leave 1 over 51: one ordinal, two names
    held = spark.createDataFrame([(k, f"Customer#{k}", "M") for k in [*range(1, 60), *both]], "c_custkey long, c_name string, c_mktsegment string")
    held.write.parquet(f"{tmp_path}/customer.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    got = sorted(tuple(r) for r in report_queries.stored_merge(spark, str(tmp_path)).collect())
    assert got == sorted(duck.execute(report_queries.ORACLES["stored_merge"]).fetchall())
    assert (5050, "Customer#5050", 1_005_050) in got
