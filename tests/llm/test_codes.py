"""op12: the trie, rounds and codes against brute force."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import codes, queries


def rounds_by_hand(vectors, entries=256, rounds=4, parts=4):
    """vectors: id, integers; by plain loops over whole numbers."""
    order = sorted(vectors, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(order[0][1])
    places = codes.cuts(width, parts)
    books = [[v[a:b] for _, v in order[:entries]] for a, b in places]
    off = lambda x, e: sum((p - q) ** 2 for p, q in zip(x, e, strict=True))

    def assign():
        return [[min((off(v[a:b], e), n) for n, e in enumerate(books[k])) for k, (a, b) in enumerate(places)] for _, v in vectors]

    for _ in range(rounds):
        found = assign()
        for k, (a, b) in enumerate(places):
            for n in range(len(books[k])):
                mine = [v[a:b] for (_, v), f in zip(vectors, found, strict=True) if f[k][1] == n]
                if mine:
                    books[k][n] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    found = assign()
    return [("".join(f"{n:02x}" for _, n in f), sum(d for d, _ in f)) for f in found], ",".join(str(x) for b in books for e in b for x in e)


@pytest.mark.parametrize(("width", "high", "n"), [(16, 300, 900), (3, 4, 900), (1, 3, 50), (8, 1 << 20, 400), (5, 2, 700), (6, 1 << 25, 300)])
def test_trie(width, high, n):
    rng = np.random.default_rng(width)
    x = rng.integers(-high, high, (n, width))
    entries = x[:200].copy()
    leaves, times, back = codes.distinct(x)
    assert (leaves[back] == x).all() and times.sum() == n and [tuple(r) for r in leaves] == sorted({tuple(r) for r in x})
    code, error = codes.nearest(leaves, entries)
    full = ((leaves[:, None].astype(object) - entries[None].astype(object)) ** 2).sum(2)
    assert (code == full.astype(float).argmin(1)).all() and (error == full.min(1)).all()


def test_whole_numbers_round_down():
    assert codes.whole(np.array([[-0.0001, 0.9999 / 1024, 1.0, -1.5]])).tolist() == [[-1, 0, 1024, -1536]]
    assert codes.cuts(10, 4) == [(0, 3), (3, 6), (6, 8), (8, 10)]


def embeddings(n=330, width=8):
    rng = np.random.default_rng(3)
    rows = [(int(k), rng.normal(0, 0.2, width).astype(np.float32).tolist(), None if k % 7 == 0 else int(k % 3)) for k in rng.permutation(n)]
    rows += [(5000 + k, rows[k][1], 9) for k in range(20)] + [rows[0], (None, [0.5] * width, None)]
    odd = [(-1, None, 1), (-2, [0.1] * (width - 1) + [None], 1), (-3, [math.nan] * width, 1), (-4, [0.1, math.inf] * (width // 2), 2), (-5, [0.1, -math.inf] * (width // 2), 2), (-6, [], 1), (7777, [0.1, 0.2], 1)]
    return rows, odd


def test_query_against_brute_force(spark, tmp_path):
    rows, odd = embeddings()
    table = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>, label int").withColumn("code", F.lit("x")).repartition(3)
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op12_vector_codes(spark, str(tmp_path))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    whole = [(i, codes.whole(np.array([v])).tolist()[0]) for i, v, _ in rows]
    want, text = rounds_by_hand(whole)
    sums = {}
    for (_, _, label), (_, error) in zip(rows, want, strict=True):
        sums[label] = sums.get(label, 0) + error
    digest = hashlib.sha256(text.encode()).hexdigest()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(((i, c, e, sums[label], digest) for (i, _, label), (c, e) in zip(rows, want, strict=True)), key=key)


def test_fewer_vectors_than_entries_and_none(spark, tmp_path):
    few = [(3, [1.0, 2.0, 3.0, 4.0], 1), (1, [0.0, 0.0, 0.0, 0.0], 1)]
    spark.createDataFrame(few, "vec_id bigint, embedding array<float>, label int").write.parquet(f"{tmp_path}/few/embeddings.parquet")
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in queries.op12_vector_codes(spark, f"{tmp_path}/few").collect()) == [(1, "00000000", 0, 0), (3, "01010101", 0, 0)]
    spark.createDataFrame([(1, None, 1)], "vec_id bigint, embedding array<float>, label int").write.parquet(f"{tmp_path}/none/embeddings.parquet")
    assert queries.op12_vector_codes(spark, f"{tmp_path}/none").collect() == []


def test_decode_gives_the_entries(spark):
    rows, _ = embeddings(300)
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    usable, first = codes.usable(table, "embedding", "vec_id", 16)
    books = codes.learn(usable, first, "embedding", rounds=1)
    coded = codes.encode(usable, books, "embedding", {"code": F.col("vec_id"), "v": F.col("embedding")})
    plain = coded.toDF("id", "v", "code", "error").withColumn("back", codes.decode(F.col("code"), books)).collect()
    for r in plain:
        assert sum((a - b) ** 2 for a, b in zip(codes.whole(np.array([r.v])).tolist()[0], r.back, strict=True)) == r.error
