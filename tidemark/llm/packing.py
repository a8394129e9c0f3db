"""Best-fit packing of token sequences, in bulk-synchronous rounds.

Documents become token ids and END; a document over CAPACITY is cut into pieces of CAPACITY, and the last piece may be
shorter. Pieces go into sequences of at most CAPACITY, longest first, each to the sequence with the smallest gap that fits.

Pieces are range-sorted by length over all tasks, which gives each its rank among those of its length. A round takes all
pieces of one length, longest first. Gaps are sorted by size, sequences of one gap in runs; a sweep goes to the successor of the
length among the gaps, deals that gap's sequences to the pieces by rank (as many pieces to each as fit, since what is left is a
smaller gap and so the next best fit), updates the gaps and repeats until the pieces or the gaps run out; new sequences open
for the rest. Pieces of a length are alike, so a round needs their number only: there are at most CAPACITY lengths, whatever the
number of documents. What a round decides is a few spans (length, ranks -> sequences, offset); every task then looks its
sorted pieces up in all spans at once. The packing is that of best fit decreasing, piece by piece.

Words between blanks are split apart before the tokenizer sees them, as its own splitting does, and the ids of a word are
kept, so each distinct word of a task is tokenized about once. Strings of special tokens in a text become these tokens.

Cases: null or empty text: END alone. Repeated rows: a row's pieces each. Very long text: its words are handled by slices of
SLICE bytes. Equal lengths, copies: sorted by where their row was read, so no length makes a large task. Empty table: empty
result. Further columns aren't carried along unless named in `keep`, under any name.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytewords import PIECE, pieces
from tidemark.llm.scale import materialize, on_workers

CAPACITY, END = 4096, 1
SLICE = PIECE // 4
#: Words whose ids a task keeps, new words that the tokenizer gets in one string, and in one call (what it returns is large).
KNOWN, TOGETHER, CALL = 1 << 18, 64, 1 << 13
#: Stands between new words; words that hold it, and so all strings of special tokens, go to the tokenizer alone.
BAR = "|"


class Numbers(dict):
    """Words as they come: a new one gets the next number."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


class Ids:
    """Token ids of texts; the ids of words are kept, of KNOWN / 2 to KNOWN of them and those of one call."""

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        (self.bar,) = self.tokenizer.encode(BAR, add_special_tokens=False).ids
        self.numbers = Numbers()
        self.flat, self.starts, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _forget(self, kept: int) -> None:
        """Only the ids of the first words that came are kept: frequent words come early."""
        self.numbers = Numbers(islice(self.numbers.items(), kept))
        at = np.arange(len(self.numbers))
        flat, lengths = self._of_numbers(at)
        self.flat, self.lengths, self.starts = flat, lengths, np.cumsum(lengths) - lengths

    def _of_numbers(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.lengths[at]
        before = np.cumsum(sizes) - sizes
        return self.flat[np.arange(int(sizes.sum())) + np.repeat(self.starts[at] - before, sizes)], sizes

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, fresh: list[str]) -> None:
        """Append the ids of new words, CALL words at a time."""
        found = [self._parts(fresh[k : k + CALL]) for k in range(0, len(fresh), CALL)]
        flat = [self.flat, *(x[0] for x in found)]
        before = np.cumsum([len(x) for x in flat[:-1]])
        self.starts = np.concatenate([self.starts, *(x[1] + b for x, b in zip(found, before, strict=True))])
        self.lengths = np.concatenate([self.lengths, *(x[2] for x in found)])
        self.flat = np.concatenate(flat)

    def _parts(self, fresh: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of words one after another, where each begins and how many it has."""
        alone = [k for k, w in enumerate(fresh) if BAR in w]
        others = [w for w in fresh if BAR not in w]
        groups = [others[k : k + TOGETHER] for k in range(0, len(others), TOGETHER)]
        # each group ends in a bar, so the bars are the ends of the words
        joined = np.concatenate([np.zeros(0, np.uint32), *self._encoded([f" {BAR} ".join([*g, ""]) for g in groups])])
        bars = np.flatnonzero(joined == self.bar)
        lengths, starts = np.zeros(len(fresh), np.int64), np.zeros(len(fresh), np.int64)
        among = np.ones(len(fresh), bool)
        among[alone] = False
        starts[among] = np.append(0, bars + 1)[:-1]
        lengths[among] = bars - starts[among]
        extra = self._encoded([fresh[k] for k in alone])
        lengths[alone] = [len(x) for x in extra]
        starts[alone] = len(joined) + np.cumsum(lengths[alone]) - lengths[alone]
        return np.concatenate([joined, *extra]), starts, lengths

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many each has."""
        if len(self.numbers) > KNOWN:
            self._forget(KNOWN // 2)
        at = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        if len(self.numbers) > len(self.lengths):
            self._learn([w.decode("utf-8", "replace") for w in islice(self.numbers, len(self.lengths), None)])
        return self._of_numbers(at)

    def texts(self, raw: list[bytes]) -> list[np.ndarray]:
        """The ids of each text."""
        words = [(x if b"<|" in x else x.lower()).split() for x in raw]  # letters count as small ones, but for special tokens
        ids, sizes = self.of([w for x in words for w in x])
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *map(len, words)])]
        return [ids[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def long_text(self, raw: bytes) -> np.ndarray:
        """The ids of one text, by slices that end at blanks."""
        out, at = [], 0
        while at < len(raw):
            to = min(at + SLICE, len(raw))
            while to < len(raw) and raw[to] not in b" \t\n\r\x0b\x0c":
                to += 1
            out += self.texts([raw[at:to]])
            at = to
        return np.concatenate([np.zeros(0, np.uint32), *out])


@cache
def _ids(tokenizer: str) -> Ids:
    return Ids(tokenizer)


def _cut(tokenizer: str, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, task, read = _ids(tokenizer), TaskContext.get().partitionId(), 0
        for batch in pieces(batches, size=SLICE):
            raw = [x.as_py() or b"" for x in batch.column(batch.num_columns - 1).cast(pa.binary())]
            texts = ids.texts(raw) if len(raw) > 1 else [ids.long_text(raw[0])]
            row, piece, start, length, crc = [], [], [], [], []
            for k, found in enumerate(texts):
                full = np.append(found, np.uint32(END)).astype("<u4")
                for a in range(0, len(full), capacity):
                    part = full[a : a + capacity]
                    row.append(k)
                    piece.append(a // capacity)
                    start.append(a)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
            kept = [c.take(pa.array(row, pa.int32())) for c in batch.columns[:-1]]
            place = pa.array(np.arange(read, read + len(row), dtype=np.int64))
            read += len(row)
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([task] * len(row), pa.int32()), place],
                [*batch.schema.names[:-1], "piece", "start", "length", "ids_crc32", "_task", "_read"],
            )

    return cut


def _schema(df: DataFrame, names: Iterable[str], more: str) -> str:
    return ", ".join([*(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names), more])


def rounds(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, first sequence, pieces a sequence, offset): where the pieces of each length go, from that rank on.

    counts: pieces of each length. Work and memory follow the number of lengths and gaps, not of pieces.
    """
    spans, runs, gaps, opened = [], {}, [], 0

    def add(gap: int, first: int, n: int) -> None:
        if n and gap:
            if gap not in runs:
                runs[gap] = []
                insort(gaps, gap)
            runs[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            successor = bisect_left(gaps, length)
            if successor == len(gaps):
                fresh = -(-left // (capacity // length))
                add(capacity, opened, fresh)
                opened += fresh
                continue
            gap = gaps[successor]
            first, n = runs[gap].pop()
            if not runs[gap]:
                del runs[gap], gaps[successor]
            each = gap // length
            full = min(n, left // each)
            rest = min(left - full * each, each) if full < n else 0
            spans.append((length, rank, first, each, capacity - gap))
            add(gap - each * length, first, full)
            if rest:
                add(gap - rest * length, first + full, 1)
            taken = full + (rest > 0)
            add(gap, first + taken, n - taken)
            rank += full * each + rest
            left -= full * each + rest
    return spans


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each sorted piece, the task and its rank among the task's pieces of the same length."""
    task, last, seen = TaskContext.get().partitionId(), -1, 0
    for batch in batches:
        length = np.asarray(batch.column("length"))
        if len(length):
            opens = np.ones(len(length), bool)
            opens[1:] = length[1:] != length[:-1]
            first = np.flatnonzero(opens)
            nth = np.arange(len(length)) - np.repeat(first, np.diff(np.append(first, len(length))))
            if length[0] == last:
                nth[: first[1] if len(first) > 1 else None] += seen
            last, seen = length[-1], nth[-1] + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nth), pa.array(np.full(len(nth), task, np.int32))], [*batch.schema.names, "_nth", "_slice"])


def _place(spans: np.ndarray):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (spans[:, 0] << 44) + spans[:, 1]
        for batch in batches:
            length, rank = np.asarray(batch.column("length")), np.asarray(batch.column("_rank"))
            _, first, at, each, offset = spans[np.searchsorted(key, (length << 44) + rank, "right") - 1].T
            nth = rank - first
            columns = [*(batch.column(c) for c in batch.schema.names if c != "_rank"), pa.array(at + nth // each), pa.array(offset + nth % each * length)]
            yield pa.RecordBatch.from_arrays(columns, [*(c for c in batch.schema.names if c != "_rank"), "sequence_id", "offset"])

    return place


def pack(docs: DataFrame, tokenizer: str, keep: dict[str, Column], text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece: the columns of `keep`, piece, start, length, ids_crc32, sequence_id, offset. tokenizer: a file's path on every machine."""
    own = [f"_{k}" for k in range(len(keep))]
    rows = docs.select(*[c.alias(n) for n, c in zip(own, keep.values(), strict=True)], F.col(text).alias("_text"))
    cut_schema = _schema(rows, own, "piece int, start bigint, length bigint, ids_crc32 bigint, _task int, _read bigint")
    found = materialize(on_workers(rows).mapInArrow(_cut(tokenizer, capacity), cut_schema), "pack-pieces")
    order = [F.col("length").desc(), "_task", "_read"]
    tasks = max(2, found.sparkSession.sparkContext.defaultParallelism, int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = found.repartitionByRange(tasks, *order).sortWithinPartitions(*order).drop("_task", "_read")
    ranged = materialize(ranged.mapInArrow(_number, _schema(ranged, ranged.columns, "_nth bigint, _slice int")), "pack-sorted")
    # a length's pieces stand in neighbouring slices, so there are at most as many counts as slices and lengths together
    counts = ranged.groupBy("_slice", "length").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("length").desc(), "_slice").collect()
    totals: dict[int, int] = {}
    before = []
    for r in counts:
        before.append((r["_slice"], r["length"], totals.get(r["length"], 0)))
        totals[r["length"]] = totals.get(r["length"], 0) + r["n"]
    spans = np.array(sorted(rounds(totals, capacity)), np.int64).reshape(-1, 5)
    offsets = found.sparkSession.createDataFrame(before, "_slice int, length bigint, _before bigint")
    ranked = ranged.join(offsets, ["_slice", "length"]).withColumn("_rank", F.col("_nth") + F.col("_before"))
    ranked = ranked.select(*own, "piece", "start", "length", "ids_crc32", "_rank")
    placed = ranked.mapInArrow(_place(spans), _schema(ranked, ranked.columns[:-1], "sequence_id bigint, offset bigint"))
    return placed.select(*[F.col(n).alias(name) for n, name in zip(own, keep, strict=True)], "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
