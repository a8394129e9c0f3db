"""The near-duplicate stage: SimHash search at a wide radius, verified by exact Jaccard similarity.

Two texts are near copies if the sets of their lower-cased shingles of SHINGLE words have a Jaccard similarity of at least
THRESHOLD. A text goes if it is a near copy of one with a smaller doc_id; of equal texts the smallest doc_id stays. So each
text that goes has a chain of near copies down to one that stays.

Fingerprints have BITS bits, of the distinct shingles. At similarity s two of them differ in a share acos(2s / (1 + s)) / pi of
their bits: 19 of 128 at 0.8, with a standard deviation of 4, while unlike texts differ in 64. So the search takes RADIUS
bits. Fingerprints meet in buckets named by the values of sampled bits, in as many tables as leave less than MISSED of the
pairs at the threshold unmet; the number of sampled bits follows the number of texts, so buckets stay of one size. In each
bucket fingerprints are compared bit-sliced, and only stars of links are kept; a text's stars of all tables become one link.

The links' components hold all near copies that met. In each component the smallest texts are compared with all others by
exact similarity, and near copies leave, so a group of near copies takes about as many comparisons as it has members. Texts
that share a passage can make a component large without being near copies. So what is left after one round is parted by its
rarest shingles: near copies share one of the first 1 - THRESHOLD of their shingles, rarest first, and the one with fewer
shingles has it among about the first ninth of its own (prefix filtering; exact); a passage that many texts share comes last.
Rounds go on in these parts, first with one text of each against the others, then HEADS times as many, until none has a pair
left. Pairs whose numbers of shingles, or places of the common one, leave no room for the threshold aren't made (exact too),
and those that never meet so aren't either. The pairs of a text that has many are dealt over several tasks.

Cases: texts without a word (null, empty, blank) are alike. Fewer than SHINGLE words: the whole sequence is the one shingle.
Null doc_id: after all others. Repeated rows: one stays. Empty table: empty result. Further columns are kept.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bytewords import mixed, pair_counts, pieces, shingles_of, texts_of, words_of
from tidemark.llm.scale import materialize, on_workers
from tidemark.llm.simhash import compared, components, joined_stars

SHINGLE, THRESHOLD = 5, 0.8
BITS, RADIUS, MISSED = 128, 34, 1e-4
#: Texts of a bucket, if fingerprints are spread.
BUCKET = 256
#: Pairs of one text that a task compares together.
PAIRS = 512
#: How many more texts of a part are compared with all others in each round.
HEADS = 8


def wide_fingerprints(column: pa.Array) -> np.ndarray:
    """texts x 2 (64 bits each): of the distinct shingles; a bit is 1 if more than half of their hashes have it."""
    texts = texts_of(column)
    names, text = shingles_of(words_of(texts), SHINGLE)
    order = np.argsort(text, kind="stable")
    text, names, _ = pair_counts(text[order], names[order])
    some, first = np.unique(text, return_index=True)
    out = np.zeros((texts.n, BITS // 64), np.uint64)
    if not len(some):
        return out
    sizes = np.diff(np.append(first, len(text)))
    for part in range(BITS // 64):
        hashes = mixed(names + np.uint64(part))
        for k in range(64):
            ones = np.add.reduceat((hashes >> np.uint64(k)) & np.uint64(1), first)
            out[some, part] |= (2 * ones > sizes).astype(np.uint64) << np.uint64(k)
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, key (a 64-bit hash of the text), f0, f1 (its fingerprint), for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            fps = wide_fingerprints(batch.column(2)).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps[:, 0]), pa.array(fps[:, 1])], names=["doc_id", "key", "f0", "f1"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return on_workers(docs).select("doc_id", F.xxhash64("text").alias("key"), "text").mapInArrow(run, f"doc_id {kind}, key bigint, f0 bigint, f1 bigint")


def tables_for(n: int, threshold: float = THRESHOLD) -> list[list[int]]:
    """The sampled bits of each table for n texts."""
    bits = max(6, math.ceil(math.log2(max(1, n) / BUCKET)))
    agree = (1 - math.acos(2 * threshold / (1 + threshold)) / math.pi) ** bits
    many, draw, tables = math.ceil(math.log(MISSED) / math.log(1 - agree)), random.Random(5), []
    while len(tables) < many:
        # disjoint samples of one permutation: differing bits that spoil one of them are missing from the others
        order = draw.sample(range(BITS), BITS)
        tables += [order[k : k + bits] for k in range(0, BITS - bits + 1, bits)]
    return tables[:many]


def loose_groups(nodes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """key, band (names a component) of the texts that have a link within RADIUS bits. nodes: key, f0, f1."""
    each = []
    for k, bits in enumerate(tables_for(nodes.count(), threshold)):
        masks = [sum(1 << (b & 63) for b in bits if b >> 6 == part) for part in (0, 1)]
        f0, f1 = (F.col(c).bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m).cast("long")) for c, m in zip(("f0", "f1"), masks, strict=True))
        each.append(F.struct(F.lit(k).alias("bucket"), F.xxhash64(f0, f1).alias("value")))
    rows = nodes.select("key", "f0", "f1", F.explode(F.array(*each)).alias("t")).select("t.bucket", "t.value", "f0", "f1", "key")
    return components(joined_stars(compared(rows, ["f0", "f1"], "key", RADIUS))).select(F.col("node").alias("key"), F.col("root").alias("band"))


def similarities(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Exact Jaccard similarity of the shingles of each pair of texts; 1 if neither has any."""
    n = len(left)
    sides = []
    for column in (left, right):
        names, text = shingles_of(words_of(texts_of(column)), SHINGLE)
        sides.append(pair_counts(text, names)[:2])
    text, _, times = pair_counts(*(np.concatenate(x) for x in zip(*sides, strict=True)))
    union, shared = np.bincount(text, minlength=n), np.bincount(text[times == 2], minlength=n)
    return np.where(union > 0, shared / np.maximum(union, 1), 1.0)


def texts_of_keys(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """key, text: each text of docs whose key is among keys, once."""
    return docs.select(F.xxhash64("text").alias("key"), "text").join(keys, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))


def by_rare_shingles(docs: DataFrame, rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """node, band (a shingle), n, place, early for the nodes of rows: texts at the threshold or above have a band in common.

    Bands are the first n - ceil(threshold * n) + 1 of a text's n distinct shingles, in order of how few of the texts have
    them; place counts from 1. early: the text can be the one with fewer shingles of a pair whose first common shingle this
    is, which leaves the first n - ceil(2 * threshold / (1 + threshold) * n) + 1. Texts without a word share one band.
    """
    nodes = rows.select("node").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            names, text = shingles_of(words_of(texts_of(batch.column(1))), SHINGLE)
            text, names, _ = pair_counts(text, names)
            none = np.setdiff1d(np.arange(batch.num_rows), text)
            text, names = np.concatenate([text, none]).astype(np.int64), np.concatenate([names, np.zeros(len(none), np.uint64)])
            for k in range(0, len(text), 1 << 16):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(text[k : k + (1 << 16)])), pa.array(names[k : k + (1 << 16)].view(np.int64))], names=["key", "shingle"])

    texts = texts_of_keys(docs, nodes.select("node.key")).select("key", "text")
    each = materialize(on_workers(texts).mapInArrow(run, "key bigint, shingle bigint"), "near-shingles")
    common = each.groupBy("shingle").agg(F.count("*").alias("texts"))
    own = Window.partitionBy("key")
    ranked = each.join(common, "shingle").withColumns({"place": F.row_number().over(own.orderBy("texts", "shingle")), "n": F.count("*").over(own)})
    first = lambda share: F.col("place") <= F.col("n") - F.ceil(F.col("n") * share - 1e-9) + 1
    some = ranked.where(first(threshold) & (F.col("texts") > 1))
    some = some.select("key", F.col("shingle").alias("band"), "n", "place", first(2 * threshold / (1 + threshold)).alias("early"))
    return nodes.join(some, nodes["node.key"] == some["key"]).select("node", "band", "n", "place", "early")


def possible_pairs(rows: DataFrame, first: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """a, b (keys): pairs of a row of first and a later row of its band that can be near copies; columns of by_rare_shingles.

    Of the first common shingle of near copies the text with fewer shingles has an early row; from there on both have room for
    the shingles that a pair at the threshold shares. A row that isn't early meets early ones only.
    """
    heads = first.select("band", F.col("node").alias("head"), F.col("n").alias("n_head"), F.col("place").alias("place_head"), F.col("early").alias("early_head"), F.explode(F.when(F.col("early"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))).alias("early"))
    fewer = ((F.col("n_head") <= F.col("n")) & F.col("early_head")) | ((F.col("n") <= F.col("n_head")) & F.col("early"))
    room = 1 + F.least(F.col("n_head") - F.col("place_head"), F.col("n") - F.col("place")) >= threshold / (1 + threshold) * (F.col("n_head") + F.col("n")) - 1e-9
    return rows.join(heads, ["band", "early"]).where((F.col("head") < F.col("node")) & fewer & room).select(F.col("head.key").alias("a"), F.col("node.key").alias("b"))


def verified(docs: DataFrame, pairs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """a, b: the pairs (keys of texts) that are near copies."""
    ids = pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))).distinct()
    texts = materialize(texts_of_keys(docs, ids), "near-texts")
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PAIRS).cast("int").alias("parts"))
    left = texts.join(parts, texts["key"] == parts["a"]).select("a", F.col("text").alias("left"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    dealt = pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    right = dealt.join(texts, dealt["b"] == texts["key"]).select("a", "b", "part", F.col("text").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(pieces(batches, 2), 3):
            yield batch.select(["a", "b"]).filter(pa.array(similarities(batch.column(2), batch.column(3)) >= threshold - 1e-12))

    return on_workers(right.join(left, ["a", "part"])).select("a", "b", "left", "right").mapInArrow(run, "a bigint, b bigint")


def _in_pairs(rows: DataFrame) -> DataFrame:
    """Rows of the buckets that have several."""
    return rows.join(rows.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band"), "band", "left_semi")


def _with_early(rows: DataFrame) -> DataFrame:
    """Rows of the buckets in which a pair can begin: one of its two rows is early."""
    return rows.join(rows.where("early").select("band").distinct(), "band", "left_semi")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs without near copies of texts with a smaller doc_id; of equal texts one row stays."""
    marked = materialize(sketches(docs), "near-sketches")
    nodes = marked.groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id")).alias("id"), F.first("f0").alias("f0"), F.first("f1").alias("f1"))
    nodes = materialize(nodes, "near-nodes")
    place = F.struct("id", "key")
    rows = materialize(nodes.join(loose_groups(nodes, threshold), "key").select(place.alias("node"), "band"), "near-groups")
    tested, gone, heads = None, None, 0
    while not rows.isEmpty():
        if heads:
            ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("band").orderBy("node")))
            pairs = possible_pairs(rows, ranked.where(F.col("rank") <= heads).drop("rank"), threshold).distinct()
            rest = ranked.where(F.col("rank") > heads).drop("rank")
        else:
            joined = rows.join(rows.groupBy("band").agg(F.min("node").alias("head")), "band").where("head < node")
            pairs = joined.select(F.col("head.key").alias("a"), F.col("node.key").alias("b"))
            rest = joined.select("band", "node")
        pairs = materialize(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "near-pairs")
        copies = materialize(verified(docs, pairs, threshold).select("b").distinct(), "near-copies")
        tested = pairs if tested is None else tested.union(pairs)
        gone = copies if gone is None else gone.union(copies)
        rest = _in_pairs(rest.join(copies, rest["node.key"] == copies["b"], "left_anti"))
        if heads:
            rows = materialize(_with_early(rest), "near-buckets")
        else:
            rows = materialize(rest, "near-buckets")
            rows = materialize(_with_early(_in_pairs(by_rare_shingles(docs, rows, threshold))), "near-buckets")
        heads = max(1, heads * HEADS)
    kept = nodes.select(F.col("id.doc_id").alias("_near_id"), F.col("key").alias("_near_key"))
    if gone is not None:
        kept = kept.join(gone, kept["_near_key"] == gone["b"], "left_anti")
    texts = docs.withColumn("_near_text", F.xxhash64("text"))
    out = texts.join(kept, texts["doc_id"].eqNullSafe(kept["_near_id"]) & (texts["_near_text"] == kept["_near_key"]), "left_semi")
    return out.dropDuplicates(["doc_id", "_near_text"]).drop("_near_text").select(*docs.columns)
