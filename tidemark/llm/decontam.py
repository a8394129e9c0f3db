"""Benchmark decontamination: which documents hold a test item.

Words are runs of letters and digits, in lower case, so punctuation and case don't hide an item; shingles are five words.
A document holds an item if at least THRESHOLD of the item's distinct shingles occur in it.

Items are partitioned by size (powers of two of their number of shingles). An item's MinHash signature is the k smallest
hashes of its shingles under a permutation, with k one more than the number of shingles that may be missing: a document
that holds the item holds at least one of them, so no leak is lost, and k follows the partition. The signatures' hashes
with their items are the index. Documents stream past it, whole and without a shuffle: a short item in a document a
thousand times its size has a Jaccard similarity near 0, so a sketch of the document would miss it, but its shingles meet
the signature. Only signatures are probed. (document, item) pairs that meet are candidates, and each is verified by exact
containment: the item's shingles are looked up among the document's. Shingles are compared by 64-bit hashes of their words.

The index is broadcast if its size is at most INDEX_BYTES, and else the items are searched in blocks of that size, one pass
over the documents for each; the documents' side never moves.

Cases: null or empty text, or no word: holds nothing, and as an item is held by nothing. Fewer than five words: the whole
sequence is the one shingle; such an item is held only by texts of the same words. Repeated documents: each counts.
An item is an item_id (null too) with a text: different texts under one id are sought apart, and repeated items once. Empty
tables: no pairs. Further columns: `clean` keeps those of docs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bytewords import pieces, shingles_of, texts_of, words_of
from tidemark.llm.scale import materialize, on_workers

SHINGLE, THRESHOLD = 5, 0.8
INDEX_BYTES = 128 << 20
#: The permutation under which signatures are smallest.
PERMUTE = 0x5851F42D4C957F2D


def shingle_rows(items: DataFrame) -> DataFrame:
    """item (a 64-bit hash of item_id and text), item_id, shingle: distinct shingles of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            names, text = shingles_of(words_of(texts_of(batch.column(2)), punctuation=False), SHINGLE)
            yield pa.RecordBatch.from_arrays([*[batch.column(k).take(pa.array(text)) for k in (0, 1)], pa.array(names.view(np.int64))], names=["item", "item_id", "shingle"])

    kind = items.schema["item_id"].dataType.simpleString()
    return on_workers(items).select(F.xxhash64(F.col("item_id").isNull(), "item_id", "text").alias("item"), "item_id", "text").mapInArrow(run, f"item bigint, item_id {kind}, shingle bigint").distinct()


def signatures(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """item, item_id, size, shingle, in_signature: the index, one row for each distinct shingle."""
    sized = shingle_rows(items).withColumn("size", F.count("*").over(Window.partitionBy("item")))
    # by size: as many as may be missing from the largest item of the partition, and one more
    upper = F.pow(F.lit(2), F.ceil(F.log2("size")))
    k = F.least(F.col("size"), F.floor(upper * (1 - threshold) + 1e-9) + 1)
    order = F.xxhash64(F.lit(PERMUTE), F.col("shingle"))
    return sized.withColumn("in_signature", F.row_number().over(Window.partitionBy("item").orderBy(order, "shingle")) <= k)


class Index:
    """A block of items: the hashes of their signatures, in order, with their items; and each item's shingles in a row."""

    def __init__(self, shingle: np.ndarray, item: np.ndarray, signs: np.ndarray, ids: pa.Array, sizes: np.ndarray) -> None:
        self.ids, self.sizes = ids, sizes
        order = np.argsort(item, kind="stable")
        self.shingle = shingle[order]
        self.begin = np.concatenate([[0], np.cumsum(sizes)])
        sign, of = shingle[signs], item[signs]
        order = np.argsort(sign, kind="stable")
        self.item = of[order]
        self.keys, self.first = np.unique(sign[order], return_index=True)
        self.first = np.append(self.first, len(sign))
        # a Bloom-like table of one bit for 2^20 slots turns away most shingles before the search
        self.slots = np.zeros(1 << 20, bool)
        self.slots[self.keys & np.uint64((1 << 20) - 1)] = True

    def candidates(self, names: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, item) pairs of which the text has a hash of the item's signature."""
        maybe = self.slots[names & np.uint64((1 << 20) - 1)]
        names, text = names[maybe], text[maybe]
        at = np.searchsorted(self.keys, names)
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == names if len(self.keys) else np.zeros(0, bool)
        text, at = text[hit], at[hit]
        many = self.first[at + 1] - self.first[at]
        place = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.first[at], many)
        pairs = np.unique(np.repeat(text, many) * len(self.ids) + self.item[place])
        return np.divmod(pairs, max(1, len(self.ids)))

    def held(self, texts_column: pa.Array, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Texts, items and how many distinct shingles of the item the text has, for all that reach the threshold; and how many candidates each text had."""
        names, text = shingles_of(words_of(texts_of(texts_column), punctuation=False), SHINGLE)
        of, item = self.candidates(names, text)
        n_candidates = np.bincount(of, minlength=len(texts_column))
        # only texts with a candidate are looked at again
        some = n_candidates[text] > 0
        names, text = names[some], text[some]
        order = np.lexsort((names, text))
        names, text = names[order], text[order]
        shared = np.zeros(len(of), np.int64)
        bounds = np.searchsorted(text, np.arange(len(texts_column) + 1))
        for k, (t, i) in enumerate(zip(of.tolist(), item.tolist(), strict=True)):
            own, sought = names[bounds[t] : bounds[t + 1]], self.shingle[self.begin[i] : self.begin[i + 1]]
            at = np.searchsorted(own, sought)
            at[at == len(own)] = 0
            shared[k] = np.count_nonzero(own[at] == sought)
        good = shared >= threshold * self.sizes[item] - 1e-9
        return of[good], item[good], shared[good], n_candidates


def search(docs: DataFrame, items: DataFrame, carry: list[str], threshold: float = THRESHOLD, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The columns of docs named in carry, and `held`: array<struct<item_id, item_shingles, shared>>, by item, and `candidates`: how many items met it. No shuffle of docs."""
    index = materialize(signatures(items, threshold), "decontam-index")
    # a row of the index takes at most 40 bytes in a task
    blocks = max(1, -(-index.count() * 40 // index_bytes))
    by_block = index.withColumn("block", F.pmod(F.col("item"), F.lit(blocks)).cast("int"))
    kind = items.schema["item_id"].dataType.simpleString()
    d = on_workers(docs).select(*[F.col(c) for c in carry], F.col("text").alias("_dc_text"))
    for block in range(blocks):
        rows = by_block.where(F.col("block") == block).select("item", "item_id", "size", "shingle", "in_signature").toArrow()
        named, first, item = np.unique(rows.column("item").to_numpy(), return_index=True, return_inverse=True)
        ids = rows.column("item_id").combine_chunks().take(pa.array(first))
        sizes = np.zeros(len(named), np.int64)
        sizes[item] = rows.column("size").to_numpy()
        held = docs.sparkSession.sparkContext.broadcast(Index(rows.column("shingle").to_numpy().view(np.uint64), item, rows.column("in_signature").to_numpy(), ids, sizes))
        place = len(carry)

        def run(batches: Iterator[pa.RecordBatch], held=held, place=place, name=f"_dc_held{block}") -> Iterator[pa.RecordBatch]:
            index = held.value
            for batch in pieces(batches, place):
                text, item, shared, n_candidates = index.held(batch.column(place), threshold)
                offsets = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
                found = pa.StructArray.from_arrays([index.ids.take(pa.array(item)), pa.array(index.sizes[item]), pa.array(shared.astype(np.int64))], names=["item_id", "item_shingles", "shared"])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(offsets), found), pa.array(n_candidates)], names=[*batch.schema.names, name, f"{name}_met"])

        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields)
        d = d.mapInArrow(run, f"{fields}, _dc_held{block} array<struct<item_id:{kind},item_shingles:bigint,shared:bigint>>, _dc_held{block}_met bigint")
    met = sum((F.col(f"_dc_held{b}_met") for b in range(1, blocks)), F.col("_dc_held0_met"))
    return d.select(*carry, F.array_sort(F.concat(*[F.col(f"_dc_held{b}") for b in range(blocks)])).alias("held"), met.alias("candidates"))


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, item_shingles, shared, containment: every pair at or over the threshold."""
    found = search(docs, items, ["doc_id"], threshold).select("doc_id", F.explode("held").alias("x")).select("doc_id", "x.*")
    return found.withColumn("containment", F.col("shared") / F.col("item_shingles"))


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, contaminated, n_items (different ids), items (ids), containment (the highest; 0 for none), one row for each row of docs."""
    best = F.array_max(F.transform("held", lambda x: x["shared"] / x["item_shingles"]))
    items_held = F.array_distinct(F.transform("held", lambda x: x["item_id"]))
    found = search(docs, items, ["doc_id"], threshold)
    return found.select("doc_id", (F.size("held") > 0).alias("contaminated"), F.size(items_held).cast("long").alias("n_items"), items_held.alias("items"), F.coalesce(best, F.lit(0.0)).alias("containment"))


def funnel(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row: documents, items, pairs of them, candidates that signatures leave of these, and leaks that verification leaves."""
    n_items = items.where(F.col("text").isNotNull()).dropDuplicates(["item_id", "text"]).count()
    found = search(docs, items, ["doc_id"], threshold).agg(F.count("*").alias("documents"), F.coalesce(F.sum("candidates"), F.lit(0)).alias("candidates"), F.coalesce(F.sum(F.size("held")), F.lit(0)).cast("long").alias("leaks"))
    return found.select("documents", F.lit(n_items).cast("long").alias("items"), (F.col("documents") * n_items).alias("pairs"), "candidates", "leaks")


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the documents that hold an item."""
    return search(docs, items, docs.columns, threshold).where(F.size("held") == 0).select(*docs.columns)
