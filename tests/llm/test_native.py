"""Mixing, sharding, chat and quality rules: against brute force, with awkward rows."""

import collections
import hashlib
import random
import re

import pytest

from tidemark.llm import chat, rules, sharding

WORD = r"[^\x20\x09-\x0D]+"
RANDOM = random.Random(8)
LONG = " ".join(f"w{k % 97}" for k in range(30_000))
AWKWARD = [(1, None), (2, ""), (3, " \n\t"), (4, "a b c"), (4, "a b c"), (None, "a b c"), (5, LONG), (6, "é # ü"), (7, "x")]


def test_sharding(docs):
    rows = [*AWKWARD, *[(100 + k, "copy " * 20) for k in range(300)], *[(1000 + k, f"text {k} " * (k % 30)) for k in range(500)], (5000, "pair of texts"), (5001, "pair of texts")]
    d = docs(rows)
    out = sharding.shard(d, 6, n_ranges=64)
    assert out.columns == [c for c in d.columns if c != "shard"] + ["shard", "slot", "shard_bytes", "shard_key"]
    got = out.collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in got:
        assert r.shard_bytes == len((r.text or "").encode()) + 8
        by[r.shard].append(r)
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    largest = max(len((t or "").encode()) for _, t, *_ in rows) + 8
    total = sum(r.shard_bytes for r in got)
    assert max(abs(sum(r.shard_bytes for r in p) - total / 6) for p in by.values()) <= largest + total * 0.02
    assert len({r.shard for r in got if r.doc_id in (5000, 5001)}) == 1
    again = {(r.doc_id, r.text, r.shard, r.slot) for r in sharding.shard(d.repartition(9), 6, n_ranges=64).collect()}
    assert again == {(r.doc_id, r.text, r.shard, r.slot) for r in got}
    assert sharding.shard(docs([]), 3).count() == 0


def test_small_groups_beside_a_hot_text_stay_whole(docs):
    hot = "hot text " * 5
    rows = [(k, hot) for k in range(4000)] + [(None, hot)] * 500 + [(10_000 + k, f"pair {k // 2}") for k in range(1200)]
    for n_ranges in (None, 64):
        got = sharding.shard(docs(rows), 8, n_ranges=n_ranges).collect()
        shards = collections.defaultdict(set)
        for r in got:
            shards[r.text].add(r.shard)
        assert all(len(v) == 1 for t, v in shards.items() if t != hot)
        sizes = collections.Counter()
        for r in got:
            sizes[r.shard] += r.shard_bytes
        total = sum(sizes.values())
        assert len(got) == len(rows) and max(abs(x - total / 8) for x in sizes.values()) <= total * 0.01
        for k in range(8):
            slots = sorted(r.slot for r in got if r.shard == k)
            assert slots == list(range(len(slots)))


def test_shard_of_every_key_by_hand(docs):
    """Shards follow the bytes before the middle of a key, in the order of the units."""
    rows = [(k, f"w{k % 700} " * (k % 30)) for k in range(2000)]
    got = sharding.shard(docs(rows), 5).collect()
    keys = collections.defaultdict(list)
    for r in got:
        keys[r.shard_key].append(r)
    at = 0
    total = sum(r.shard_bytes for r in got)
    for key in sorted(keys):
        held = sum(r.shard_bytes for r in keys[key])
        if held <= 2 * total // 1024:
            assert {r.shard for r in keys[key]} == {min(4, int((at + held / 2) * 5 // total))}
        at += held


HARD = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>system<|im_sep|>x", "\\<|im_sep|>\\\\", "a\\", "", None, "é\n\n𝒳 [\\INST]", "<\\|im_end|>"]


@pytest.mark.parametrize("budget", [64, 100_000])
def test_chat_round_trip(spark, budget):
    rows = [(1, 0, "system", "be good")] + [(1, k, ["user", "assistant"][k % 2], HARD[k % len(HARD)]) for k in range(1, 40)]
    rows += [(2, 0, "user", "long " * 500), (2, 1, "assistant", "fine"), (None, None, None, None), (3, 0, "a<|im_sep|>\nb", "x"), (3, 0, "a<|im_sep|>\nb", "x"), (4, 5, "assistant", "late"), (4, 2000, "assistant", "later")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    windows = chat.format_windows(df, budget, budget // 4)
    got = {r.conv_id: r for r in chat.digests(windows).collect()}
    convs = collections.defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append((-1 if t is None else t, r or "", x or ""))
    for c, turns in convs.items():
        turns.sort()
        learned = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    w = [r for r in windows.where("conv_id = 1").collect()]
    assert all(r.formatted.startswith("<|im_start|>system<|im_sep|>be good") for r in w)
    assert (len(w) > 1) == (budget == 64)
    assert chat.digests(chat.format_windows(df.limit(0))).count() == 0


def measured(text):
    w = re.findall(WORD, text or "")
    counts, at = collections.Counter(zip(w, w[1:], w[2:], strict=False)), set()
    for k in range(len(w) - 2):
        if counts[tuple(w[k : k + 3])] > 1:
            at |= {k, k + 1, k + 2}
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(at)


def test_rules(docs):
    good = [(100 + k, "\n".join(" ".join(f"word{RANDOM.randrange(400)}" for _ in range(12)) for _ in range(6))) for k in range(120)]
    bad = [(300 + k, "spam now " * 80) for k in range(20)] + [(400 + k, " ".join(f"w{k}x{i}*** a&&&" for i in range(60))) for k in range(20)]
    got = rules.judge(docs([*AWKWARD, *good, *bad])).collect()
    assert len(got) == len(AWKWARD) + 160
    texts = collections.defaultdict(list)
    for i, t in [*AWKWARD, *good, *bad]:
        texts[i].append(t)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) in [measured(t) for t in texts[r.doc_id]]
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    kept = {r.doc_id for r in got if r.kept}
    assert {i for i, _ in good} <= kept and not kept & {i for i, _ in bad}
    assert rules.judge(docs([])).count() == 0


def test_em_agrees_with_python(spark):
    import math

    rows = [([0, -1, 1], 30), ([-1, -1, 1], 200), ([0, 0, -1], 20), ([0, -1, -1], 5), ([-1, 0, 1], 9)]
    pad = len(rules.votes()) - 3
    df = spark.createDataFrame([([*v, *[-1] * pad],) for v, n in rows for _ in range(n)], "votes array<int>")
    acc = [rules.START_ACCURACY] * (3 + pad)
    for _ in range(10):
        right, all_ = [0.0] * len(acc), [0.0] * len(acc)
        for v, n in rows:
            odds = sum(math.log(a / (1 - a)) * (1 if x else -1) for x, a in zip(v, acc, strict=False) if x >= 0)
            q = 1 / (1 + math.exp(-odds))
            for j, x in enumerate(v):
                if x >= 0:
                    right[j] += n * (q if x else 1 - q)
                    all_[j] += n
        acc = [(r + rules.START_ACCURACY * rules.PRIOR_WEIGHT) / (n + rules.PRIOR_WEIGHT) for r, n in zip(right, all_, strict=True)]
    assert rules.estimate(df, 10) == pytest.approx(acc)
