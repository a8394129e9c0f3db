"""Decontamination, SimHash, language, quality, toxicity, language model: brute force, held-out accuracy, awkward rows."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import bytewords, decontam, langid, quality, simhash, toxicity

WORD = r"[^\x20\x09-\x0D]+"
LOWER = {c: c + 32 for c in range(65, 91)}
LONG = " ".join(f"w{k % 97}" for k in range(30_000))
AWKWARD = [(1, None), (2, ""), (3, " \n\t"), (4, "A b c"), (4, "A b c"), (None, "a b c"), (5, LONG), (6, "é # Ü"), (7, "x")]


def words(text):
    return [w.translate(LOWER) for w in re.findall(WORD, text or "")]


def prose(seed, n, kinds=300):
    r = random.Random(seed)
    return " ".join(f"t{r.randrange(kinds)}" for _ in range(n))


def test_words_of_a_batch():
    column = pa.array(["Ab  c\n", None, "", "é", "Ab", "x" * 50])
    texts = bytewords.texts_of(column)
    found = bytewords.words_of(texts)
    assert found.counts.tolist() == [2, 0, 0, 1, 1, 1]
    assert found.hash[0] == found.hash[3] and len(set(found.hash.tolist())) == 4
    part = bytewords.words_of(bytewords.texts_of(column.slice(3, 2)))
    assert part.hash.tolist() == found.hash[2:4].tolist()
    batch = pa.RecordBatch.from_arrays([column], names=["t"])
    assert [b.num_rows for b in bytewords.pieces([batch], 0, 6)] == [3, 2, 1]


def fingerprint(text):
    w = words(text)
    if not w:
        return 0
    grams = [" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_components(fps):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    distinct = sorted(set(fps))
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    return {f: find(f) for f in distinct}


def test_simhash(docs):
    base = prose(1, 400)
    near = [(50 + k, base + f" tail{k}") for k in range(30)]
    rows = [*AWKWARD, *near, *[(200 + k, prose(k + 2, 60)) for k in range(60)], *[(300 + k, base) for k in range(5)]]
    got = simhash.near_duplicates(docs(rows)).collect()
    assert len(got) == len(rows)
    fps = collections.defaultdict(set)
    for i, t in rows:
        fps[i].add(fingerprint(t))
    assert all(r.fp % 2**64 in fps[r.doc_id] for r in got)
    roots = brute_components([r.fp % 2**64 for r in got])
    least = {}
    for r in got:
        if r.doc_id is not None:
            k = roots[r.fp % 2**64]
            least[k] = min(least.get(k, r.doc_id), r.doc_id)
    assert all(r.component_id == least.get(roots[r.fp % 2**64]) for r in got)
    assert simhash.near_duplicates(docs([])).count() == 0


@pytest.mark.parametrize("blocks", [5, 6, 7])
@pytest.mark.parametrize("tile", [7, 4096])
def test_links_are_whole(spark, blocks, tile):
    r = random.Random(blocks)
    seeds = [r.getrandbits(64) for _ in range(40)]
    fps = {s ^ sum(1 << b for b in r.sample(range(64), r.randrange(6))) for s in seeds for _ in range(6)} | {0, 2**64 - 1}
    df = spark.createDataFrame([(f - 2**64 if f >> 63 else f,) for f in fps], "fp bigint")
    links = simhash.links(df, blocks=blocks, tile=tile)
    got = {c.node % 2**64: c.root % 2**64 for c in simhash.components(links).collect()}
    want = brute_components(list(fps))
    groups = lambda m: sorted(sorted(k for k in fps if m.get(k, k) == x) for x in {m.get(k, k) for k in fps})
    assert groups(got) == groups(want)
    assert links.count() <= 3 * math.comb(blocks, 4) * len(fps)


def test_near_lanes():
    rng = np.random.default_rng(0)
    fps = np.concatenate([rng.integers(0, 2**63, 100).astype(np.uint64), np.uint64(5) ^ (np.uint64(1) << np.arange(30, dtype=np.uint64))])
    near = simhash.near_lanes(simhash.bit_planes(fps[:, None]), fps[:, None], 4)
    bits = np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")[:, : len(fps)]
    assert (bits == (np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4)).all()


@pytest.mark.parametrize("radius", [0, 7, 8, 33])
def test_near_lanes_of_wide_fingerprints(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**63, (3, 2)).astype(np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 25), replace=False)) for _ in range(400)], np.uint64).reshape(200, 2)
    fps = np.concatenate([base, base[rng.integers(0, 3, 200)] ^ flips])
    near = simhash.near_lanes(simhash.bit_planes(fps), fps, radius)
    bits = np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")[:, : len(fps)]
    assert (bits == (np.bitwise_count(fps[:, None] ^ fps[None, :]).sum(axis=2) <= radius)).all()


def shingles(text):
    w = [x.lower() for x in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").encode())]
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_decontamination(spark, docs):
    items = [(k, prose(900 + k, 12 + k)) for k in range(30)] + [(50, "a b c"), (51, None), (52, ""), (53, "one two"), (None, "x y z")]
    rows = list(AWKWARD)
    for k, (_, t) in enumerate(items[:30]):
        w = t.split()
        cut = [x if j % (5 + k) else "changed" for j, x in enumerate(w)]
        rows += [(100 + k, f"{prose(k, 300)} {t.upper()}! {prose(k + 7, 2000)}"), (200 + k, f"{prose(k, 30)} {' '.join(w[: len(w) * 4 // 5 + 1])}"), (300 + k, " ".join(cut))]
    it = spark.createDataFrame(items, "item_id bigint, text string")
    want = {(i, t): sorted(j for j, u in items if j is not None and shingles(u) and len(shingles(u) & shingles(t)) >= 0.8 * len(shingles(u))) for i, t in rows}
    for size in (decontam.INDEX_BYTES, 2048):
        found = decontam.search(docs(rows), it, ["doc_id", "text", "score"], index_bytes=size).collect()
        assert len(found) == len(rows)
        assert all([h.item_id for h in r.held] == want[r.doc_id, r.text] for r in found)
    clean = decontam.clean(docs(rows), it)
    assert clean.columns == docs(rows).columns and clean.count() == sum(not want[r] for r in rows)
    assert decontam.contaminated(docs([]), it).count() == 0
    assert decontam.contaminated(docs(rows), it.limit(0)).where("contaminated").count() == 0


def ppm_bits(grams, alphabet, text, order=3):
    """Code length by walking down the contexts."""
    total = 0.0
    for k in range(1, len(text)):
        for n in range(min(order, order), -1, -1):
            ctx = tuple(([0] * order + text[:k])[len([0] * order + text[:k]) - n :]) if n else ()
            seen = grams.get(ctx)
            if seen:
                t, u = sum(seen.values()), len(seen)
                if text[k] in seen:
                    total -= math.log2(seen[text[k]] / (t + u))
                    break
                total -= math.log2(u / (t + u))
        else:
            total += math.log2(alphabet)
    return total


def test_ppm_tables_are_exact():
    train = {"a": ["banana bandana", "ban"], "b": ["kiwi kiwi koala"]}
    langs, grams, n = [], [], []
    trees = {}
    for name, texts in train.items():
        symbols, text = langid.stream(pa.array(texts))
        keys, count = np.unique(langid.grams(np.where(True, symbols, 0), 3)[np.concatenate([[False], text[1:] == text[:-1]])], return_counts=True)
        trees[name] = collections.defaultdict(collections.Counter)
        for g, c in zip(keys.tolist(), count.tolist(), strict=True):
            b = [g >> 24 & 255, g >> 16 & 255, g >> 8 & 255, g & 255]
            for k in range(4):
                trees[name][tuple(b[3 - k : 3])][b[3]] += c
        langs += [name] * len(keys)
        grams += keys.tolist()
        n += count.tolist()
    tables = langid.fold_tables(np.array(langs, object), np.array(grams), np.array(n))
    for sample in ("banana", "kiwi ban", "koala kiwi bandana", "zzz"):
        bits, _ = langid.code_lengths(tables, pa.array(["ab", sample]))
        symbols = langid.stream(pa.array([sample]))[0].tolist()
        known = [s if tables.number[s] < tables.size - 1 else -1 for s in symbols]
        for j, name in enumerate(tables.langs):
            assert bits[1, j] == pytest.approx(ppm_bits(trees[name], tables.size, known), rel=1e-5)


def test_language(spark):
    r = random.Random(3)
    parts = {"xx": ["ba", "do", "ke"], "yy": ["sch", "ung", "ei"], "zz": ["ña", "ció", "que"]}
    rows = [(k, " ".join("".join(r.choice(parts[s]) for _ in range(3)) for _ in range(12)), s) for k in range(300) for s in [["xx", "yy", "zz"][k % 3]]]
    odd = [(900, None, "xx"), (901, "", None), (902, "12 !", "yy"), (903, "ñ", None), (None, "ba do", None), (904, rows[0][1] * 400, None)]
    df = spark.createDataFrame(rows + odd, "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in langid.identify(df).collect()}
    assert all(got[i].lang_pred == s for i, _, s in rows if zlib.crc32(str(i).encode()) % 5 == 0)
    assert [got[k].lang_pred for k in (900, 901, 902)] == ["und"] * 3 and got[903].lang_pred != "und" and got[904].lang_pred == "xx"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in langid.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.identify(df.limit(0)).count() == 0


def labels_of(spark, pairs, label):
    return spark.createDataFrame([*pairs, (pairs[0][0], None)], f"doc_id bigint, {label} int")


def test_toxicity(spark, docs):
    rows, labels = [], []
    for k in range(500):
        bad = k % 5 == 0
        w = prose(k, 60, 2000).split()
        if bad:
            for at in (10, 11, 40):
                w[at] = random.Random(k + at).choice(["idiot", "scum", "moron", "loseröst"])
        rows.append((k, " ".join(w)))
        labels.append((k, int(bad)))
    d, lab = docs([*rows, *[(i if i is None else i + 9000, t) for i, t in AWKWARD]]), labels_of(spark, labels, "toxic")
    got = {r.doc_id: r._tox_score for r in toxicity.score(d, lab, {"doc_id": F.col("doc_id")}).collect()}
    held = [k for k in range(500) if zlib.crc32(str(k).encode()) % 5 == 0]
    right = sum((got[k] >= toxicity.TOXIC) == (k % 5 == 0) for k in held)
    assert right >= 0.95 * len(held) and all(0 <= s <= 1 for s in got.values()) and got[9001] == got[9002] == 0
    lexicon, law = toxicity.train(d, lab)
    found = toxicity.passages(d, lexicon, law).where("doc_id = 0").collect()
    assert any(r.first_word <= 11 and r.last_word >= 10 for r in found)
    kept = toxicity.remove(d, lab)
    assert kept.columns == d.columns and kept.count() <= len(rows) + len(AWKWARD) - 80
    assert toxicity.score(docs([]), lab, {"doc_id": F.col("doc_id")}).count() == 0
    assert toxicity.remove(docs(rows), lab.limit(0)).count() == len(rows)


def split(net, a, b):
    """The best segment of net[a:b], then those left and right of it."""
    best = max(((net[i:j].sum(), i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, a, b))
    return [] if best[0] <= 0 else [*split(net, a, best[1]), best[1:], *split(net, best[2], b)]


def test_segments_are_those_of_the_definition():
    rng = random.Random(6)
    for _ in range(150):
        net = np.array([rng.choice([-1.0, -0.3, -2.0, rng.uniform(0.5, 4)]) for _ in range(rng.randrange(1, 25))])
        found = toxicity.segments(net)
        assert [(a, b + 1) for a, b, _ in found] == split(net, 0, len(net))
        assert all(s == pytest.approx(net[a : b + 1].sum()) for a, b, s in found)


def test_segments_of_a_long_text_take_linear_time():
    # every word a passage of its own, each lower than all before it
    assert len(toxicity.segments(np.tile([0.5, -1.0, -1.0, -1.0], 200_000))) == 200_000
    # each a little higher than the last: all are one passage
    assert len(toxicity.segments(np.tile([4.0, -1.0, -1.0, -1.0], 200_000))) == 1


def test_toxicity_score_by_hand():
    """The least tail over the r best segments, each with its factor of two."""
    law = toxicity.Law(0.5, 1.0, 0.8, 0.01)
    scores, words = {0: [6.0], 1: [2.5, 2.4, 2.6, 2.2], 2: [], 3: [1.0, 7.0]}, np.array([50, 400, 9, 80])
    found = toxicity.Segments(*[np.array(x) for x in ([k for k, v in scores.items() for _ in v], [0] * 7, [0] * 7)], np.array([s for v in scores.values() for s in v], float), words)
    got = law.score(found)
    for k, v in scores.items():
        z = sorted(((s - 0.5 * math.log(words[k]) - 1.0) / 0.8 for s in v), reverse=True)
        tails = []
        for r in range(1, len(z) + 1):
            t = sum(z[:r])
            p = 1 - math.exp(-math.exp(-z[0])) if r == 1 else math.exp(-t) * t ** (r - 1) / math.factorial(r) / math.factorial(r - 1) if t > r else 1.0
            tails.append(p * 2**r)
        assert got[k] == pytest.approx(0.01 / (0.01 + min(1.0, *tails)) if tails else 0.0)


def test_several_weak_passages_count(spark, docs):
    lexicon = toxicity.Lexicon(*[x[np.argsort(y)] for y in [bytewords.words_of(bytewords.texts_of(pa.array(["bad"]))).hash] for x in (y, np.array([3.0]))])
    law = toxicity.Law(0.0, 0.5, 0.5, 0.005)
    one, four = (toxicity.segments_of(pa.array([" ".join(["bad", *["fine"] * 20] * n)]), lexicon) for n in (1, 4))
    assert len(four.text) == 4 and law.score(four)[0] > law.score(one)[0] and law.score(one)[0] < 0.5 < law.score(four)[0]


def test_log_odds_by_hand(spark):
    counts = spark.createDataFrame([(1, 0, 1, 8), (1, 1, 9, 2), (2, 0, 3, 3), (3, 1, 1, 1)], "token bigint, toxic bigint, n bigint, docs bigint")
    got = toxicity.lexicon_of(counts, (30, 10))
    share = {0: 0.75, 1: 0.25}
    for token, clean, toxic in ((1, 8, 2), (2, 3, 0), (3, 0, 1)):
        want = math.log((toxic + toxicity.PRIOR * share[1]) / share[1]) - math.log((clean + toxicity.PRIOR * share[0]) / share[0])
        assert got.of(np.array([token], np.uint64))[0] == pytest.approx(want)
    assert got.of(np.array([9], np.uint64))[0] == 0


def test_quality(spark, docs):
    rows, labels = [], []
    for k in range(500):
        bad = k % 4 == 0
        rows.append((k, "spam " * 90 if bad and k % 8 else prose(k, 90).replace(" ", "*** ") if bad else ". ".join(prose(k + j, 15) for j in range(6))))
        labels.append((k, int(not bad)))
    lab, d = labels_of(spark, labels, "quality"), docs([*rows, *[(i if i is None else i + 9000, t) for i, t in AWKWARD]])
    got = {r.doc_id: r._q_score for r in quality.score(d, lab, {"doc_id": F.col("doc_id")}).collect()}
    held = [k for k in range(500) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert sum((got[k] >= 0.3) == (k % 4 != 0) for k in held) >= 0.95 * len(held) and all(0 <= s <= 1 for s in got.values())
    assert quality.score(docs([]), lab, {"doc_id": F.col("doc_id")}).count() == 0
    assert {r._q_score for r in quality.score(d, lab.limit(0), {"doc_id": F.col("doc_id")}).collect()} == {0.5}


def test_normal_equations(spark):
    rng = np.random.default_rng(1)
    stats, y = rng.normal(size=(60, quality.STATS)), rng.integers(0, 2, 60)
    model = quality.Model(np.zeros(quality.STATS), np.ones(quality.STATS))
    df = spark.createDataFrame([(s.tolist(), int(v)) for s, v in zip(stats, y, strict=True)], "stats array<double>, label int").repartition(5)
    gram, right = quality.normal_equations(df, model)
    z = model.features(stats)
    assert np.allclose(gram, z.T @ z) and np.allclose(right, z.T @ y)


def test_isotonic():
    fit = quality.isotonic(np.array([3.0, 1, 2, 4]), np.array([0.2, 0.1, 0.6, 0.9]), np.ones(4))
    assert fit.tolist() == pytest.approx([0.4, 0.1, 0.4, 0.9])
