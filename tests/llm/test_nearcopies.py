"""The pipeline's near-duplicate stage: near copies by exact Jaccard similarity of five-word shingles."""

import random

import pyarrow as pa
import pytest

from tidemark.llm import nearcopies


def prose(seed, n):
    r = random.Random(seed)
    return [f"t{r.randrange(3000)}" for _ in range(n)]


def grams(text):
    w = (text or "").lower().split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def jaccard(a, b):
    a, b = grams(a), grams(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def changed(w, at):
    return [f"new{k}" if k in at else x for k, x in enumerate(w)]


def test_stage_drops_near_copies(spark, docs):
    import corpus_pipeline as cp

    rows = []
    for k in range(60):
        n = (60, 100, 400)[k % 3]
        w = prose(k, n)
        rows += [(10 * k, " ".join(w)), (10 * k + 1, " ".join(changed(w, {n // 2} if n < 400 else set(range(30, 390, 60)))))]
        # under the line: half of the words are another text's
        rows.append((10 * k + 2, " ".join(w[: n // 2] + prose(1000 + k, n // 2))))
    # a chain and a large group of near copies
    base = prose(77, 200)
    rows += [(5000 + k, " ".join(changed(base, {(7 * k) % 200}))) for k in range(80)]
    rows += [(7001, None), (7002, ""), (7003, " \n"), (7004, "A b c"), (None, "a b c"), (7005, "a b c d"), (None, " ".join(base)), (7006, "a b c d"), (7006, "a b c d")]
    assert all(jaccard(rows[3 * k][1], rows[3 * k + 1][1]) >= 0.8 > jaccard(rows[3 * k][1], rows[3 * k + 2][1]) for k in range(60))
    left = cp.drop_near_duplicates(spark, docs(rows), "").collect()
    assert sorted(r.doc_id for r in left) == sorted([*[10 * k for k in range(60)], *[10 * k + 2 for k in range(60)], 5000, 7001, 7004, 7005])
    stay = [r.text for r in left]
    assert all(jaccard(a, b) < 0.8 for i, a in enumerate(stay) for b in stay[:i])
    assert cp.drop_near_duplicates(spark, docs([]), "").count() == 0
    assert left[0].__fields__ == docs([]).columns


def test_buckets_of_unlike_texts_are_searched_to_the_end(docs, monkeypatch):
    """All texts in one bucket: near copies among its last members are found too."""
    monkeypatch.setattr(nearcopies, "_in_pairs", lambda rows, whole=nearcopies._in_pairs: whole(rows.withColumn("band", nearcopies.F.lit(1).cast("bigint")).distinct()))
    rows = [(k, " ".join(prose(k, 40))) for k in range(90)] + [(200 + k, " ".join(changed(prose(k, 40), {39}))) for k in (0, 50, 89)]
    assert sorted(r.doc_id for r in nearcopies.keep_one(docs(rows)).collect()) == list(range(90))


def test_similarities():
    a, b = ["a b c d e f", None, "x y", "A b c d e", ""], ["a b c d e g", " ", "x z", "a b c d e", "q"]
    assert nearcopies.similarities(pa.array(a), pa.array(b)).tolist() == pytest.approx([1 / 3, 1, 0, 1, 0])


def test_texts_that_share_a_passage(spark, docs):
    """A passage of two thirds of each text links them all; near copies among them are found, and parts by rare shingles stay small."""
    passage = prose(5, 80)
    rows = [(k, " ".join(passage + prose(100 + k, 40))) for k in range(60)]
    rows += [(100 + k, " ".join(passage + changed(prose(100 + k, 40), {(3 * k) % 40}))) for k in range(0, 60, 4)] + [(200, None), (201, " ")]
    alike = {(a, b) for i, (b, y) in enumerate(rows) for a, x in rows[:i] if jaccard(x, y) >= 0.8}
    assert len(alike) == 16
    full = docs(rows)
    node = nearcopies.F.struct(nearcopies.F.struct(nearcopies.F.lit(False).alias("no_id"), "doc_id").alias("id"), nearcopies.F.xxhash64("text").alias("key")).alias("node")
    bands = {}
    for r in nearcopies.by_rare_shingles(full, full.select(node)).collect():
        bands.setdefault(r.band, set()).add(r.node.id.doc_id)
    assert all(any({a, b} <= x for x in bands.values()) for a, b in alike)
    assert max(map(len, bands.values())) <= 20
    assert sorted(r.doc_id for r in nearcopies.keep_one(full).collect()) == sorted({k for k, _ in rows} - {b for _, b in alike})


def test_pairs_that_cannot_reach_the_threshold_are_not_made(docs):
    """A hundred texts share most of their shingles, but too few: no pair is made. Of texts near the line every near copy meets."""
    F = nearcopies.F
    passage = prose(5, 104)
    far = [(k, " ".join(passage[: 92 - k % 8] + prose(100 + k, 12 + k % 8))) for k in range(100)]
    r, close = random.Random(3), []
    for k in range(90):
        n = r.choice([60, 104, 104, 110])
        w = prose(7 + k % 2, 130)[r.choice([0, 0, 3]) :][:n]
        cut = r.randrange(0, 14)
        close.append((1000 + k, " ".join(changed(w[: n - cut], {r.randrange(n) for _ in range(r.choice([0, 0, 1, 2]))}) + prose(900 + k, cut))))

    def met(rows):
        full = docs(rows)
        nodes = full.select(F.struct(F.struct(F.lit(False).alias("no_id"), "doc_id").alias("id"), F.xxhash64("text").alias("key")).alias("node"))
        ids = {x.key: x.doc_id for x in full.select("doc_id", F.xxhash64("text").alias("key")).collect()}
        found = nearcopies.by_rare_shingles(full, nodes)
        return {(ids[x.a], ids[x.b]) for x in nearcopies.possible_pairs(found, found).collect()}

    assert not met(far)
    alike = {(a, b) for i, (b, y) in enumerate(close) for a, x in close[:i] if jaccard(x, y) >= 0.8}
    assert len(alike) > 100 and alike <= met(close)


def test_links_of_a_group_do_not_add_up_over_the_tables(docs, monkeypatch):
    """A group of near copies meets in every table; its members get about a link each, and the groups are those that all pairs join."""
    base = prose(77, 300)
    rows = [(k, " ".join(changed(base, {k % 300, (7 * k) % 300}))) for k in range(300)] + [(1000 + k, " ".join(prose(k, 100))) for k in range(100)]
    rows += [(2000 + k, " ".join(changed(prose(k, 100), {50}))) for k in range(0, 100, 3)]
    F = nearcopies.F
    nodes = nearcopies.sketches(docs(rows)).select("key", "f0", "f1").persist()
    found = []
    monkeypatch.setattr(nearcopies, "components", lambda edges, whole=nearcopies.components: found.append(edges) or whole(edges))
    got = {r.key: r.band for r in nearcopies.loose_groups(nodes).collect()}
    assert len(nearcopies.tables_for(len(rows))) > 10
    assert found[0].count() < 1.5 * len(got)
    left, right = nodes.select(F.struct("*").alias("x")), nodes.select(F.struct("*").alias("y"))
    far = sum((F.bit_count(F.col(f"x.{f}").bitwiseXOR(F.col(f"y.{f}"))) for f in ("f0", "f1")), F.lit(0))
    near = left.crossJoin(right).where((F.col("x.key") < F.col("y.key")) & (far <= nearcopies.RADIUS)).select("x.key", "y.key").collect()
    root = {x: x for pair in near for x in pair}
    for _ in range(20):
        for a, b in near:
            root[a] = root[b] = min(root[a], root[b])
    assert got == root
