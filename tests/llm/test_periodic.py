"""op11: runs, their collapse and digests against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import periodic, queries


def by_hand(words, shortest=periodic.SHORTEST):
    """(start, length, period) of all runs, from the definition, period by period."""
    n, found = len(words), {}
    for p in range(1, n // 3 + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(shortest, 3 * p):
                found.setdefault((i, j - i + p), p)
            i = j + 1
    return sorted(((s, length, p) for (s, length), p in found.items()), key=lambda r: (r[0], r[2]))


def repetitive(rng, n, kinds):
    words = [f"w{rng.randrange(kinds)}" for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        a = rng.randrange(max(1, n))
        p = rng.randint(1, max(1, (n - a) // 3))
        for k in range(a + p, rng.randint(a, n)):
            words[k] = words[k - p]
    return words


def test_cover():
    differences = {(a - b) % periodic.CYCLE for a in periodic.COVER for b in periodic.COVER}
    assert differences == set(range(periodic.CYCLE))


@pytest.mark.parametrize("shortest", [3, 24])
def test_runs(shortest):
    rng = random.Random(shortest)
    for _ in range(250):
        words = repetitive(rng, rng.randint(0, 260), rng.choice([1, 2, 3, 6, 60]))
        numbers = {w: k + 1 for k, w in enumerate(words)}
        got = periodic.runs_of(np.array([numbers[w] for w in words], np.int64), shortest)
        assert list(zip(got.start.tolist(), got.length.tolist(), got.period.tolist(), strict=True)) == by_hand(words, shortest)


def test_extension():
    rng = random.Random(5)
    for kinds in (1, 2, 40):
        text = [int(w[1:]) + 1 for w in repetitive(rng, 700, kinds)]
        text[350:] = text[:350]
        ext = periodic.Extension(np.array(text, np.int64))
        pairs = [(a, b) for a, b in ((rng.randrange(699), rng.randrange(1, 701)) for _ in range(800)) if a < b] + [(0, 350), (17, 367), (699, 700)]
        got = ext.at(np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]))
        for (a, b), found in zip(pairs, got.tolist(), strict=True):
            want = 0
            while b + want < len(text) and text[a + want] == text[b + want]:
                want += 1
            assert found == want


def test_many_word_kinds_and_long_runs():
    """More than 2^16 kinds of words; one word for ever; slices of the grid."""
    many = np.concatenate([np.arange(1, 70_001), np.tile(np.arange(1, 101), 40)])
    got = periodic.runs_of(many)
    assert (got.start.tolist(), got.length.tolist(), got.period.tolist()) == ([70_000], [4000], [100])
    got = periodic.runs_of(np.ones(30_000, np.int64))
    assert (got.start.tolist(), got.length.tolist(), got.period.tolist()) == ([0], [30_000], [1])


def contract(doc_id, text):
    words = [] if text is None else text.encode().split()
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = by_hand(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    drop = {k for s, length, p in runs for k in range(s + p, s + length)}
    digest = lambda raw: hashlib.sha256(raw).hexdigest()
    left = b" ".join(w for k, w in enumerate(words) if k not in drop)
    facts = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *facts, digest("".join(f"{s},{x},{p}\n" for s, x, p in runs).encode()), digest(left))


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(11)
    rows = [(None, None), (1, ""), (2, " \t\n"), (3, "a " * 23), (4, "a " * 24), (5, "é ü " * 30), (5, "é ü " * 30), (6, "\x1c x\x85y z " * 12), (7, None)]
    rows += [(k, " \n"[k % 2].join(repetitive(rng, rng.randint(1, 300), rng.choice([2, 5, 200])))) for k in range(10, 170)]
    rows.append((900, " ".join(f"w{k % 997}" for k in range(12_000))))
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    key = lambda r: tuple(str(x) for x in r)
    assert sum(zlib.crc32(str(k).encode()) % 10 == 0 for k, _ in rows) > 8
    assert sorted(map(tuple, got.collect()), key=key) == sorted((contract(*r) for r in rows), key=key)


def test_clashing_columns_and_empty_table(docs):
    df = docs([(1, "a b c " * 9), (2, None)]).withColumnsRenamed({"shard": "runs", "score": "collapsed", "source": "_0"})
    got = periodic.find_runs(df, {"runs": F.col("runs"), "_text": F.col("_0"), "doc_id": F.col("doc_id")})
    assert got.columns == ["runs", "_text", "doc_id", "runs", "collapsed"]
    rows = sorted((r[2], r[0], [tuple(x) for x in r[3]], r[4]) for r in got.collect())
    assert rows == [(1, "extra", [(0, 27, 3)], "a b c"), (2, "extra", [], "")]
    assert periodic.find_runs(df.limit(0), {"doc_id": F.col("doc_id")}).collect() == []
