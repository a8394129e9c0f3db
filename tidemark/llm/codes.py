"""Vector code compression: product codes, with codebooks learned by rounds of assignment and averaging.

A component x counts as floor(SCALE x), so all distances and sums are whole numbers and don't depend on the order of rows. A
vector is cut into PARTS consecutive parts; a part is coded by the number of the nearest entry of its position's codebook.

Nearest entries are found along a lexicographic trie of the distinct parts: a node carries its prefix's distances to all
entries, one number more for each dimension, which all parts with that prefix share. The trie is walked depth first, in the
order of the sorted parts, BLOCK leaves at a time: the path to the last leaf stays, the rest goes, so the memory for distances
is BLOCK + depth rows of ENTRIES numbers. At a leaf the least distance decides (ties: lower number), and the part counts as
often as it occurs. Tries hold the parts of up to BUFFER vectors of a task: sums add up, so equal parts of other tasks needn't
meet and nothing is shuffled but a row of sums for each entry and task. The codebooks are all that comes to the driver.

Cases: rows whose vector is null or empty, or holds a null or a component that isn't finite, are dropped, and so are vectors
without as many components as that of the smallest id that isn't dropped. Components count as at most 2^26 / sqrt(components)
in size, so that sums of squares stay exact. Ids: nulls last, ties by vector. Fewer vectors than entries: fewer entries.
Components that PARTS doesn't divide: the first parts are longer by one. Repeated rows: a row each. Empty table: empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scale import on_workers

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Vectors of a task whose parts share a trie, and leaves that are handled at once.
BUFFER, BLOCK = 1 << 15, 256


def whole(values: np.ndarray) -> np.ndarray:
    """vectors x components, as whole numbers."""
    most = float(1 << 26) // math.sqrt(max(1, values.shape[1]))
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -most, most).astype(np.int64)


def cuts(components: int, parts: int) -> list[tuple[int, int]]:
    """From and to of each part."""
    ends = [0]
    for k in range(parts):
        ends.append(ends[-1] + components // parts + (k < components % parts))
    return list(zip(ends, ends[1:], strict=False))


def distinct(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, how often each occurs, and for each row its number among them."""
    if not parts.shape[1]:
        return parts[:1], np.array([len(parts)]), np.zeros(len(parts), np.int64)
    key = np.ascontiguousarray((parts + (1 << 31)).astype(">u4")).view(f"S{4 * parts.shape[1]}").ravel()
    _, first, back, times = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    return parts[first], times, back


def nearest(leaves: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each of the sorted distinct parts, the nearest entry and the squared distance, by a walk over their trie."""
    n, depth = leaves.shape
    code, error = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not n or not depth:
        return code, error
    span = int(max(leaves.max(), entries.max()) - min(leaves.min(), entries.min()))
    kind = np.int32 if depth * span**2 < 1 << 31 else np.float64 if depth * span**2 < 1 << 53 else np.int64
    leaves, entries = leaves.astype(kind), np.ascontiguousarray(entries.T.astype(kind))
    leaves_from = np.zeros(n, np.int64)  # the depth at which a leaf's path parts from the one before
    leaves_from[1:] = (leaves[1:] != leaves[:-1]).argmax(1)
    path = np.zeros((depth, entries.shape[1]), kind)
    for at in range(0, n, BLOCK):
        rows, parted = leaves[at : at + BLOCK], leaves_from[at : at + BLOCK]
        above, node_above = np.zeros((1, entries.shape[1]), kind), np.zeros(len(rows), np.int64)
        for d in range(depth):
            opens = parted <= d
            new = np.flatnonzero(opens)
            step = rows[new, d][:, None] - entries[d]
            step *= step
            shared = above[node_above[new]] if len(new) < len(rows) or len(above) != len(rows) + 1 else above[1:]
            step += shared
            above, node_above = np.concatenate([path[d : d + 1], step]), np.cumsum(opens)
            path[d] = above[node_above[-1]]
        leaf = above[node_above]
        code[at : at + BLOCK] = leaf.argmin(1)
        error[at : at + BLOCK] = leaf.min(1)
    return code, error


def _buffered(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[list[pa.RecordBatch], np.ndarray]]:
    """The batches by about BUFFER vectors, with their vectors (the last column) as whole numbers."""
    held, rows = [], 0

    def out():
        flat = [np.asarray(b.column(b.num_columns - 1).flatten().to_numpy(zero_copy_only=False)) for b in held]
        return held, whole(np.concatenate(flat).reshape(-1, width))

    for batch in batches:
        for at in range(0, batch.num_rows, BUFFER):
            part = batch.slice(at, BUFFER)
            if rows and rows + part.num_rows > BUFFER:
                yield out()
                held, rows = [], 0
            held.append(part)
            rows += part.num_rows
    if rows:
        yield out()


def usable(table: DataFrame, vector: str, id_column: str, entries: int = ENTRIES) -> tuple[DataFrame, np.ndarray]:
    """The rows with a vector that counts (see Cases), and the vectors of the `entries` smallest ids, as whole numbers."""
    v = F.col(vector)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = table.where(v.isNotNull() & (F.size(v) > 0) & F.forall(v, finite))
    smallest = lambda df: [list(r[0]) for r in df.orderBy(F.col(id_column).asc_nulls_last(), v).select(v).limit(entries).collect()]
    first = smallest(rows)
    if not first:
        return rows, np.zeros((0, 0), np.int64)
    rows = rows.where(F.size(v) == len(first[0]))
    if any(len(x) != len(first[0]) for x in first):
        first = smallest(rows)
    return rows, whole(np.array(first, np.float64))


def _sum_parts(books: list[np.ndarray], width: int):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = cuts(width, len(books))
        total = [np.zeros((len(b), b.shape[1]), np.int64) for b in books]
        times = [np.zeros(len(b), np.int64) for b in books]
        for _, vectors in _buffered(batches, width):
            for k, (a, b) in enumerate(places):
                leaves, often, _ = distinct(vectors[:, a:b])
                code, _ = nearest(leaves, books[k])
                np.add.at(times[k], code, often)
                np.add.at(total[k], code, leaves * often[:, None])
        widest = max(b - a for a, b in places)
        for k, (a, b) in enumerate(places):
            used = np.flatnonzero(times[k])
            columns = [np.full(len(used), k, np.int32), used.astype(np.int32), times[k][used], *total[k][used].T, *np.zeros((widest - (b - a), len(used)), np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["part", "entry", "times", *(f"s{d}" for d in range(widest))])

    return sums


def learn(rows: DataFrame, first: np.ndarray, vector: str, parts: int = PARTS, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks (entries x components for each part) after `rounds` rounds over all rows. An entry without parts stays."""
    width = first.shape[1]
    places = cuts(width, parts)
    books = [first[:, a:b].copy() for a, b in places]
    sums = [f"s{d}" for d in range(max(b - a for a, b in places))]
    schema = ", ".join(["part int, entry int, times bigint", *(f"{s} bigint" for s in sums)])
    for _ in range(rounds):
        found = on_workers(rows.select(vector)).mapInArrow(_sum_parts(books, width), schema)
        for r in found.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ("times", *sums)]).collect():
            books[r.part][r.entry] = np.array([r[s] for s in sums[: books[r.part].shape[1]]], np.int64) // r.times
    return books


def encode(rows: DataFrame, books: list[np.ndarray], vector: str, keep: dict[str, Column]) -> DataFrame:
    """The columns of `keep`, `code` (array of entry numbers, by part) and `error` (squared distance to what the code stands for)."""
    width = sum(b.shape[1] for b in books)
    given = rows.select(*[c.alias(f"_{k}") for k, c in enumerate(keep.values())], F.col(vector).alias("_vector"))
    schema = ", ".join([*(f"`_{k}` {given.schema[k].dataType.simpleString()}" for k in range(len(keep))), "code array<int>, error bigint"])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, vectors in _buffered(batches, width):
            codes, error = np.zeros((len(vectors), len(books)), np.int32), np.zeros(len(vectors), np.int64)
            for k, (a, b) in enumerate(cuts(width, len(books))):
                leaves, _, back = distinct(vectors[:, a:b])
                code, off = nearest(leaves, books[k])
                codes[:, k] = code[back]
                error += off[back]
            at = 0
            for batch in held:
                some = slice(at, at + batch.num_rows)
                at += batch.num_rows
                lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * len(books), pa.int32()), pa.array(codes[some].ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists, pa.array(error[some])], [*batch.schema.names[:-1], "code", "error"])

    found = on_workers(given).mapInArrow(coded, schema)
    return found.select(*[F.col(f"_{k}").alias(name) for k, name in enumerate(keep)], "code", "error")


def decode(code: Column, books: list[np.ndarray]) -> Column:
    """The whole-number vector that a code stands for."""
    return F.flatten(F.array(*[F.element_at(F.lit(b.tolist()).cast("array<array<bigint>>"), code[k] + 1) for k, b in enumerate(books)]))


def books_text(books: list[np.ndarray]) -> str:
    """All entries' components by part, entry and place, comma-joined."""
    return ",".join(str(x) for b in books for x in b.ravel().tolist())
