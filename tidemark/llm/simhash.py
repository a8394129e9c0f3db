"""SimHash near-duplicates, compared bit-sliced.

A text's fingerprint has the bits that more than half of the XXH64 hashes of its 4-word shingles have. Fingerprints that
differ in at most RADIUS bits are linked; a component is what links reach.

Copies share a fingerprint, so only distinct fingerprints are compared. If the 64 bits are cut into `blocks` parts, two
fingerprints within the radius agree in all but RADIUS of them, so they meet in one of the buckets named by a choice of
blocks - RADIUS parts and their values. More blocks make more and smaller buckets; the number is chosen by the number of
fingerprints, and every choice finds all links. Tasks hold their buckets' fingerprints as bit planes: 64 words of one bit
for each of 64 members. A member is compared with 64 others by one XOR for each plane, and the distances are counted by
carry-save adders in bit-sliced form; after 3, 4, 5 and 6 eighths of the planes a block whose members all exceed the radius is left. A
bucket with more than TILE members is dealt to pairs of tiles, so no task holds more than two tiles of it. Of each
comparison's links only stars are kept, which join what they join, so a group of near copies gives as many links as members.

Components come from rounds of large-star and small-star over the links; each round is a written table.

Cases: null or empty text, or no word: fingerprint zero, linked like any other. Fewer than 4 words: the whole sequence is
the one shingle. Null doc_id: gets its component's smallest id (null if there is none). Repeated rows: a row each. Empty
table: empty result.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytewords import _LOWER, pieces, texts_of, words_of
from tidemark.llm.scale import materialize, on_workers

SEED, SHINGLE, RADIUS = 42, 4, 4
#: Members of a bucket that one comparison takes at most (of each of two tiles), and queries compared at a time.
TILE, STRIP = 4096, 256


def fingerprints_of(column: pa.Array) -> np.ndarray:
    """Fingerprints of a batch of texts."""
    texts = texts_of(column)
    words = words_of(texts, hashed=False)
    out = np.zeros(texts.n, np.uint64)
    if not len(words.start):
        return out
    # the words of a text, lower-cased and joined by one space: shingles are slices of it
    lengths = words.end - words.start
    place = np.cumsum(lengths + 1) - (lengths + 1)
    line = np.full(int(place[-1] + lengths[-1] + 1), 32, np.uint8)
    within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    line[within + np.repeat(place, lengths)] = _LOWER[texts.data[within + np.repeat(words.start, lengths)]]
    line = line.tobytes()
    n = words.counts
    runs = np.where(n >= SHINGLE, n - SHINGLE + 1, (n > 0).astype(np.int64))
    before = np.cumsum(runs) - runs
    head = np.arange(int(runs.sum())) - np.repeat(before, runs) + np.repeat(words.first[:-1], runs)
    tail = np.minimum(head + SHINGLE, np.repeat(words.first[1:], runs)) - 1
    begin, end = place[head].tolist(), (place[tail] + lengths[tail]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[b:e], SEED) for b, e in zip(begin, end, strict=True)), np.uint64, len(begin))
    some = np.flatnonzero(runs)
    for k in range(64):
        ones = np.add.reduceat((hashes >> np.uint64(k)) & np.uint64(1), before[some])
        out[some] |= (2 * ones > runs[some]).astype(np.uint64) << np.uint64(k)
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (a 64-bit hash of the text), fp (the fingerprint as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fingerprints_of(batch.column(2)).view(np.int64))], names=["doc_id", "text_key", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return on_workers(docs).select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(run, f"doc_id {kind}, text_key bigint, fp bigint")


def blocks_for(n: int, radius: int = RADIUS) -> int:
    """The number of blocks with the least expected work for n spread fingerprints: rows made, and pairs compared at a hundredth of a row's cost."""

    def work(blocks: int) -> float:
        tables = math.comb(blocks, radius)
        return tables * n * (1 + n / 2 ** (64 * (blocks - radius) / blocks) / 200)

    return min(range(radius + 1, radius + 9), key=work)


def buckets(distinct: DataFrame, blocks: int, radius: int = RADIUS) -> DataFrame:
    """fp -> bucket (number of the choice of blocks), value (their bits), fp."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    masks = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(blocks)]
    chosen = [sum(masks[k] for k in keep) for keep in itertools.combinations(range(blocks), blocks - radius)]
    signed = [m - (1 << 64) if m >> 63 else m for m in chosen]
    each = F.array(*[F.struct(F.lit(k).alias("bucket"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("value")) for k, m in enumerate(signed)])
    return distinct.select("fp", F.explode(each).alias("b")).select("b.bucket", "b.value", "fp")


def near_lanes(planes: np.ndarray, queries: np.ndarray, radius: int) -> np.ndarray:
    """For each query, bits of the members within the radius. planes: bits x words, queries: fingerprints (n x bits / 64).

    A block is one query and 64 members. Counters and `over` hold every lane's distance so far, bit by bit; `over` is set
    beyond what the counters hold. Blocks without a lane within the radius are left after 3, 4, 5 and 6 eighths of the planes.
    """
    n_words, bits = planes.shape[1], len(planes)
    out = np.zeros(len(queries) * n_words, np.uint64)
    query, word = np.divmod(np.arange(len(out)), n_words)
    counters = [np.zeros(len(out), np.uint64) for _ in range(max(3, radius.bit_length()))]
    over, zero = np.zeros(len(out), np.uint64), np.uint64(0)
    leave = {bits * k // 8 - 2 for k in (3, 4, 5, 6)}
    for k in range(0, bits, 2):
        a, b = (planes[j][word] ^ (zero - ((queries[:, j >> 6] >> np.uint64(j & 63)) & np.uint64(1)))[query] for j in (k, k + 1))
        half = a ^ b
        carry = (a & b) | (half & counters[0])
        counters[0] ^= half
        for c in counters[1:]:
            up = c & carry
            c ^= carry
            carry = up
        over |= carry
        if k in leave:
            stay = np.flatnonzero(~(over | _beyond(counters, radius)))
            if not len(stay):
                return out.reshape(len(queries), n_words)
            query, word, over, *counters = (x[stay] for x in (query, word, over, *counters))
    out[query * n_words + word] = ~(over | _beyond(counters, radius))
    return out.reshape(len(queries), n_words)


def _beyond(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count in the counters (the lowest bit first) is above the radius."""
    above, equal = np.zeros_like(counters[0]), np.full_like(counters[0], 0xFFFFFFFFFFFFFFFF)
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            above |= equal & counters[k]
            equal &= ~counters[k]
    return above


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """bits x words: bit i of word w of plane k is bit k of fingerprint 64 w + i; lanes beyond the last one repeat it."""
    words = -(-len(fps) // 64)
    padded = np.concatenate([fps, np.repeat(fps[-1:], words * 64 - len(fps), axis=0)])
    bits = np.unpackbits(np.ascontiguousarray(padded).view(np.uint8).reshape(len(padded), -1), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def forest(fps: np.ndarray, groups: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """(first, member): each other member that links within the radius reach from the first one of its tree, inside a group; numbers of members."""
    n = len(fps)
    if n < 2:
        return []
    planes, links = bit_planes(fps), []
    near = np.concatenate([near_lanes(planes, fps[k : k + STRIP], radius) for k in range(0, n, STRIP)])
    valid = np.zeros(planes.shape[1] * 64, bool)
    valid[:n] = True
    left = np.packbits(valid, bitorder="little").view(np.uint64).copy()
    busy = np.flatnonzero(np.bitwise_count(near & left).sum(axis=1) > 1)
    lanes = lambda bits: np.flatnonzero(np.unpackbits(bits.view(np.uint8), bitorder="little"))
    for first in busy.tolist():
        if not left[first >> 6] >> np.uint64(first & 63) & np.uint64(1):
            continue
        left[first >> 6] &= ~(np.uint64(1) << np.uint64(first & 63))
        todo = [first]
        while todo:
            at = todo.pop()
            found = lanes(near[at] & left)
            found = found[groups[found] == groups[at]]
            for x in found.tolist():
                left[x >> 6] &= ~(np.uint64(1) << np.uint64(x & 63))
                links.append((first, x))
            todo += found.tolist()
    return links


def compared(rows: DataFrame, prints: list[str], name: str, radius: int, tile: int = TILE) -> DataFrame:
    """a, b (names): what the links within each bucket of rows (bucket, value, the fingerprint's 64-bit parts, name) join, as stars around the smallest name a."""
    columns = list(dict.fromkeys([*prints, name]))
    large = materialize(rows.groupBy("bucket", "value").agg(F.count("*").alias("n")).where(F.col("n") > tile).withColumn("tiles", F.ceil(F.col("n") / tile).cast("int")).drop("n"), "simhash-large")
    rows = rows.join(large, ["bucket", "value"], "left")
    own = F.pmod(F.xxhash64(name), F.col("tiles")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(F.least(t, own).alias("i"), F.greatest(t, own).alias("j")))
    single = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    rows = rows.select("bucket", "value", F.explode(F.when(F.col("tiles").isNull(), single).otherwise(others)).alias("t"), *columns).select("bucket", "value", "t.i", "t.j", *columns)
    rows = rows.repartition("bucket", "value", "i", "j").sortWithinPartitions("bucket", "value", "i", "j", name)

    def compare(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("bucket", "value", "i", "j", *columns)
        rest = [np.zeros(0, np.int64)] * len(names)
        for batch in itertools.chain(part, [None]):
            if batch is not None:
                rest = [np.concatenate([x, batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64)]) for k, x in enumerate(rest)]
            n = len(rest[0])
            if not n:
                continue
            changes = np.zeros(n, bool)
            for x in rest[:4]:
                changes[1:] |= x[1:] != x[:-1]
            group = np.cumsum(changes)
            starts = np.concatenate([[0], np.flatnonzero(changes), [n]])
            # groups in one comparison as long as they have few members together; the last may go on in the next batch
            upto = n if batch is None else int(starts[-2])
            cut = [0]
            for k in range(1, len(starts)):
                if starts[k] > upto:
                    break
                if starts[k] - cut[-1] > 512 and starts[k - 1] > cut[-1]:
                    cut.append(int(starts[k - 1]))
            cut.append(upto)
            fps = np.stack([rest[names.index(c)].view(np.uint64) for c in prints], axis=1)
            called = rest[names.index(name)]
            found = []
            for a, b in itertools.pairwise(cut):
                if b - a > 1:
                    found += [(x + a, y + a) for x, y in forest(fps[a:b], group[a:b], radius)]
            if found:
                pairs = np.array(found)
                yield pa.RecordBatch.from_arrays([pa.array(called[pairs[:, 0]]), pa.array(called[pairs[:, 1]])], names=["a", "b"])
            rest = [x[upto:].copy() for x in rest]

    return on_workers(rows).mapInArrow(compare, "a bigint, b bigint")


def links(distinct: DataFrame, radius: int = RADIUS, blocks: int | None = None, tile: int = TILE) -> DataFrame:
    """a, b: links that join exactly what all pairs of fingerprints within the radius join."""
    distinct = distinct.select("fp")
    blocks = blocks or blocks_for(distinct.count(), radius)
    return compared(buckets(distinct, blocks, radius), ["fp"], "fp", radius, tile)


def joined_stars(stars: DataFrame) -> DataFrame:
    """a, b: links that join exactly what the stars (a, b: b's smallest name in a comparison is a) of all buckets join, about one for each b.

    Each b goes to its smallest a, and so do its other a's. These are first members of comparisons, few in a group whose members
    meet in many buckets, so the group's links don't add up over the buckets. A b has as many a's as comparisons.
    """
    each = stars.groupBy("b").agg(F.min("a").alias("least"), F.collect_set("a").alias("firsts"))
    return each.select(F.col("least").alias("a"), F.explode(F.array_append("firsts", F.col("b"))).alias("b")).where("a != b").distinct()


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """node, root (the smallest node of its component) for all nodes that have a link.

    Large-star points each node's larger neighbours to its smallest one, small-star the smaller ones; when nothing changes,
    every component is a star around its smallest node.
    """
    both = lambda e: e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialize(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "simhash-edges")
    state = None
    for _ in range(most_rounds):
        wide = both(edges)
        least = wide.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = wide.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = small.union(least.select("a", F.col("m").alias("b"))).where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        edges = materialize(stars, "simhash-edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count_distinct("a")).first()
        if tuple(now) == state and now[0] == now[2]:
            break
        state = tuple(now)
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, text_key, fp, root (fingerprint that names the component), component_id (its smallest doc_id)."""
    marked = materialize(fingerprints(docs), "simhash-fingerprints")
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = components(links(distinct, radius))
    named = distinct.join(rooted, distinct["fp"] == rooted["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = materialize(named, "simhash-roots")
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(named.select("fp", "root").join(ids, "root"), "fp").select("doc_id", "text_key", "fp", "root", "component_id")
