"""op13: ids against the tokenizer, and the packing against best fit decreasing, piece by piece."""

import random
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import packing, queries

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " \n\t", "don't  STOP we'll", "a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|>", "a|b | || c", "Café café ÀÉ x y　z", "e ́f", "ΑΣ Σ İI ŉ ß", "1234 5.6", "\x1c\x1d a\x85b   c", "안녕 ᄒ ᅡ ᆫ", "  |  "]


@pytest.fixture(scope="module")
def ids():
    return packing.Ids(TOKENIZER)


def best_fit_decreasing(lengths, capacity):
    gaps, n = [], 0
    for length in sorted(lengths, reverse=True):
        k = bisect_left(gaps, length)
        gap = capacity if k == len(gaps) else gaps.pop(k)
        n += gap == capacity
        if gap > length:
            insort(gaps, gap - length)
    return n


def test_rounds_pack_like_best_fit_decreasing():
    rng = random.Random(13)
    for _ in range(300):
        capacity, mean = rng.choice([5, 16, 64]), rng.choice([1, 3, 10, 30])
        lengths = [min(capacity, max(1, int(rng.expovariate(1 / mean)))) for _ in range(rng.randint(0, 300))]
        counts, held = Counter(lengths), defaultdict(list)
        spans = packing.rounds(counts, capacity)
        for length, n in counts.items():
            mine = sorted(s for s in spans if s[0] == length)
            for rank in range(n):
                _, first, at, each, offset = [s for s in mine if s[1] <= rank][-1]
                held[at + (rank - first) // each].append((offset + (rank - first) % each * length, length))
        for places in held.values():
            end = 0
            for offset, length in sorted(places):
                assert offset == end
                end += length
            assert end <= capacity
        assert len(held) == best_fit_decreasing(lengths, capacity)


def test_rounds_follow_lengths_not_pieces():
    few = packing.rounds({k: 1000 // k + 1 for k in range(1, 4097)}, 4096)
    many = packing.rounds({k: 10**12 // k + 1 for k in range(1, 4097)}, 4096)
    assert len(many) < 4 * 4096 and len(few) < 4 * 4096


def test_ids_are_the_tokenizers(ids, monkeypatch):
    rng = random.Random(1)
    letters = "abcXYZéÜßñ.,'|&*19中"
    texts = [t or "" for t in ODD] + ["".join(rng.choice(letters + "  \n") for _ in range(rng.randint(1, 400))) for _ in range(60)]
    plain = lambda t: ids.tokenizer.encode(t, add_special_tokens=False).ids
    for _ in range(2):  # new words, then known ones
        for text, found in zip(texts, ids.texts([t.encode() for t in texts]), strict=True):
            assert found.tolist() == plain(text), text
    monkeypatch.setattr(packing, "SLICE", 50)
    monkeypatch.setattr(packing, "KNOWN", 20)
    whole = " ".join(texts)
    assert ids.long_text(whole.encode()).tolist() == plain(whole)
    assert ids.long_text(b"").tolist() == []


def test_what_a_worker_holds_is_bounded(monkeypatch):
    """The tokenizer gets few words at once, and beyond KNOWN words only the first ones stay, with their ids."""
    monkeypatch.setattr(packing, "KNOWN", 200)
    monkeypatch.setattr(packing, "CALL", 30)
    ids, sizes = packing.Ids(TOKENIZER), []
    encoded = ids._encoded
    ids._encoded = lambda texts: sizes.append(sum(len(t.split()) for t in texts)) or encoded(texts)
    for k in range(20):
        words = [b"alpha", b"a|b", *(b"w%d" % (50 * k + j) for j in range(50)), b"beta"]
        flat, each = ids.of(words)
        assert flat.tolist() == [x for w in words for x in ids.tokenizer.encode(w.decode(), add_special_tokens=False).ids]
        assert len(each) == len(words) and len(ids.numbers) <= 200 + len(words)
    assert max(sizes) <= 2 * 30 and {b"alpha", b"a|b"} <= set(ids.numbers)


def check(got, rows, ids, capacity):
    """got: (doc_id, piece, start, length, crc, sequence, offset)."""
    want = Counter()
    for doc_id, text in rows:
        full = np.array([*ids.tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END], "<u4")
        for a in range(0, len(full), capacity):
            want[doc_id, a // capacity, a, len(full[a : a + capacity]), zlib.crc32(full[a : a + capacity].tobytes())] += 1
    assert Counter(tuple(r[:5]) for r in got) == want
    held = defaultdict(list)
    for r in got:
        held[r[5]].append((r[6], r[3]))
    for places in held.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    assert len(held) == best_fit_decreasing([r[3] for r in got], capacity)


def test_query(spark, ids, tmp_path):
    rng = random.Random(2)
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "a b"), (None, "a b"), (3, "long " * 9000), (4, "y" * 5000)]
    rows += [(100 + k, " ".join(rng.choice(["alpha", "beta,", "Gamma", "x1"]) for _ in range(int(rng.expovariate(1 / 700))))) for k in range(150)] + [(7, "same words here")] * 60
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_best_fit_pack(spark, str(tmp_path))
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    check([tuple(r) for r in got.collect()], rows, ids, packing.CAPACITY)


def test_small_sequences_clashing_columns_empty_table(docs, ids):
    rows = [(k % 40, "word " * (k % 23)) for k in range(400)]
    df = docs(rows).withColumnRenamed("shard", "length")
    got = packing.pack(df, TOKENIZER, {"doc_id": F.col("doc_id"), "_task": F.col("length"), "text": F.col("score")}, capacity=16)
    assert got.columns == ["doc_id", "_task", "text", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    found = [tuple(r) for r in got.collect()]
    assert {r[1:3] for r in found} == {("extra", 7)}
    check([(r[0], *r[3:]) for r in found], rows, ids, 16)
    assert packing.pack(df.limit(0), TOKENIZER, {"doc_id": F.col("doc_id")}).collect() == []
