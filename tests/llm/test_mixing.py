"""op1: quotas, disjoint blocks and targets against brute force."""

import collections
import math

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing

AWKWARD = [(1, None), (2, ""), (3, " \n\t"), (4, "a b c"), (4, "a b c"), (None, "a b c"), (5, " ".join(f"w{k % 97}" for k in range(30_000))), (6, "é # ü"), (7, "x")]


def test_hypergeometric(spark):
    total, good, draws = 10, 4, 5
    rows = spark.range(20_000).select(mixing.hypergeometric(F.xxhash64("id"), F.lit(total), F.lit(good), F.lit(draws)).alias("k")).groupBy("k").count().collect()
    got = {r.k: r["count"] / 20_000 for r in rows}
    for k in range(5):
        assert got[k] == pytest.approx(math.comb(good, k) * math.comb(total - good, draws - k) / math.comb(total, draws), abs=0.015)
    wide = spark.range(4000).select(mixing.hypergeometric(F.xxhash64("id"), F.lit(1000), F.lit(300), F.lit(200)).alias("k")).agg(F.avg("k"), F.variance("k"), F.min("k"), F.max("k")).first()
    assert abs(wide[0] - 60) < 0.5 and abs(wide[1] - 33.6) < 4 and wide[2] >= 0 and wide[3] <= 200
    for n, g, d, want in [(10, 10, 3, 3), (10, 0, 3, 0), (10, 4, 10, 4), (10, 4, 0, 0), (1, 1, 1, 1)]:
        assert spark.range(1).select(mixing.hypergeometric(F.lit(7), F.lit(n), F.lit(g), F.lit(d))).first()[0] == want


def test_the_tree_uses_up_every_quota(spark):
    quotas = {k: q for k, q in enumerate([1, 0, 500, 37, 4000])}
    df = spark.createDataFrame(list(quotas.items()), "idx int, blocks bigint")
    for n_shards in (1, 5, 8):
        got = {r.idx: list(r.bounds) for r in mixing._split_tree(df, n_shards, 3).collect()}
        assert {k: b[-1] for k, b in got.items()} == quotas and all(b == sorted(b) and len(b) == n_shards for b in got.values())
        per = [sum(b[s] - (b[s - 1] if s else 0) for b in got.values()) for s in range(n_shards)]
        assert sum(per) == sum(quotas.values()) and max(per) - min(per) <= n_shards.bit_length() + 1
    # the draws follow the sources' shares without being proportional throughout
    assert any(abs((b[2] - b[1]) - b[-1] / 8) > 1 for b in got.values())


def targets_by_hand(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    out, left, free = {}, sum(sizes.values()), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] >= most * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in free}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        free -= over
    return out


def test_draws(docs):
    rows = [(k, "a " * (k % 40), ["big", "b", "c", None, "é"][min(k % 7, 4)]) for k in range(300)] + [(900, "tiny", "tiny"), (901, None, "void"), (902, "", "void")]
    out = mixing.plan(docs(rows), blocks=8, n_shards=5).select("_row.doc_id", "_row.source", "_mix.*").collect()
    sizes = collections.defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = targets_by_hand(sizes)
    assert len(out) == len(rows)
    taken, per_shard, drawn = collections.defaultdict(int), collections.defaultdict(set), collections.defaultdict(dict)
    for r in out:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert sum(d.words for d in r.draws) <= 3 * r.size and len({d["pass"] for d in r.draws}) == len(r.draws)
        taken[r.source] += sum(d.words for d in r.draws)
        for d in r.draws:
            # a block of a pass is drawn once, by one shard, under one number
            assert drawn[r.source].setdefault((d["pass"], d.block), (d.number, d.shard)) == (d.number, d.shard)
            per_shard[d.shard].add((r.source, d.number))
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    for s, found in drawn.items():
        numbers = sorted(n for n, _ in found.values())
        assert numbers == list(range(len(numbers))), s
        assert [shard for _, shard in sorted(found.values())] == sorted(shard for _, shard in found.values())
        # another pass is another permutation
        n_blocks = len({b for _, b in found})
        orders = [[b for (p, b), _ in sorted(found.items(), key=lambda x: x[1]) if p == q] for q in range(3)]
        assert n_blocks < 5 or len({tuple(o) for o in orders if len(o) == n_blocks}) == sum(len(o) == n_blocks for o in orders)
    counts = [len(x) for x in per_shard.values()]
    assert len(counts) == 5 and max(counts) - min(counts) <= 4
    assert [len(r.draws) for r in out if r.source == "void"] == [1, 1]


def test_mixture(docs):
    rows = [(k, "a " * 50, "x" if k % 3 else "y") for k in range(400)]
    d = docs(rows)
    out = mixing.mix(d, n_shards=4, whole=True, part_words=1000)
    assert out.columns == [*d.columns, "mix_shard", "mix_part", "mix_pass", "mix_words"]
    got = out.collect()
    words = collections.Counter()
    for r in got:
        words[r.source] += r.mix_words
    want = targets_by_hand({"x": 266 * 50, "y": 134 * 50})
    assert all(abs(words[s] - want[s]) <= 50 for s in want) and len({r.mix_part for r in got}) > 1
    ids = [r.doc_id for r in got if r.mix_shard == 0 and r.mix_part == 0]
    assert ids != sorted(ids)
    again = mixing.mix(d.repartition(7), n_shards=4, whole=True, part_words=1000).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_awkward_rows(docs):
    d = docs([(*r, ["s", None][k % 2]) for k, r in enumerate(AWKWARD)])
    one, two = (sorted(map(str, mixing.mix(x, whole=True).select("doc_id", "mix_shard", "mix_pass", "mix_words").collect())) for x in (d, d.repartition(7)))
    assert one == two
    assert mixing.mix(docs([])).count() == 0 and mixing.plan(docs([])).count() == 0
    clash = d.withColumn("mix_shard", F.lit("mine")).withColumns({c: F.lit(1) for c in ("_mix", "target", "block", "draws")})
    assert mixing.mix(clash).columns == [*d.columns, "_mix", "target", "block", "draws", "mix_shard", "mix_part", "mix_pass", "mix_words"]
