import pytest


def test_stages(spark, tmp_path):
    import corpus_pipeline as cp

    say = lambda k, n=60: " ".join(f"w{(k * 37 + j * (k + 3)) % 5003}" for j in range(n))
    item = say(777, 25)
    rows = [(k, say(k), f"s{k % 3}") for k in range(120)] + [(500, say(3), "s0"), (501, f"{say(901)} {item} {say(902)}", "s1")]
    toxic = [(600 + k, f"{say(600 + k)} idiot scum moron idiot", "s2") for k in range(40)]
    docs = spark.createDataFrame(rows + toxic, "doc_id bigint, text string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(r[0], int(r[0] >= 600)) for r in rows + toxic], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert 4 <= len(cp.STAGES) <= 5
    left = [None]
    for k, (name, stage) in enumerate(cp.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        if k + 1 < len(cp.STAGES):
            assert docs.columns == ["doc_id", "text", "source"], name
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        left.append({r.doc_id for r in docs.collect()})
    _, no_toxic, single, clean, mixed, sharded = left
    assert not {i for i, *_ in toxic} & no_toxic and {i for i, *_ in rows} <= no_toxic
    assert 500 not in single and 3 in single
    assert clean == single - {501}
    assert mixed == sharded <= clean
    assert cp.run(spark, str(tmp_path)).count() == docs.count()


def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


@pytest.mark.parametrize("name", ["op2_decontaminate"])
def test_sql(spark, name):
    import os

    import duckdb
    import pandas as pd

    from tidemark.llm.queries import ORACLES, QUERIES

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no driver tables")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    a, b = QUERIES[name](spark, sf).toPandas(), con.execute(ORACLES[name]).df()
    columns = sorted(a.columns)
    pd.testing.assert_frame_equal(a[columns].sort_values("doc_id").reset_index(drop=True), b[columns].sort_values("doc_id").reset_index(drop=True), check_dtype=False)
