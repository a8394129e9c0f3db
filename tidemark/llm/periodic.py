"""Periodic runs of words: stretches that repeat a block of q words three times or more.

A run is a stretch of words with smallest period q, at least max(SHORTEST, 3 q) long, that no neighbouring word extends. Each
text is handled whole in one task and nothing is shuffled; long texts are worked through in slices of the grid, so memory
grows with the text only.

Harmonic grid: for each period p the words at 0, p, 2p, ... are looked at, n/1 + n/2 + n/3 + ... in all. A run of 3 p words
holds three neighbours of that grid, so only where these three words are equal the stretch is extended to both sides, by the
longest common extension (LCE) of places i and i + p. The leftmost place of a run reports it. A multiple of a run's period
finds the same stretch, so the smallest period of equal stretches stays.

LCE by a difference cover: two places are at most CYCLE - 1 words before places whose numbers modulo CYCLE both lie in COVER.
These few words are compared; where all are equal, the sampled suffixes that begin there are compared by a minimum over their
common prefixes in sorted order, looked up in a sparse table. Only sampled suffixes are sorted: by their first CYCLE words,
and then by doubling along the samples. The table is made where a comparison comes so far, which few texts need; extension
to the left uses one over the text read backwards.

Cases: null or empty text: no runs, empty collapsed text. Repeated rows: a row each. Very long text: as any. Empty table: empty
result. Equal runs can't occur. Further columns aren't carried along unless named in `keep`, under any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytewords import pieces
from tidemark.llm.scale import on_workers

SHORTEST = 24
#: Differences of the cover's members give every number modulo the cycle.
CYCLE, COVER = 57, (0, 1, 3, 13, 32, 36, 43, 52)
#: Places of the grid that are looked at in one go.
GRID = 1 << 17

_IN_COVER = np.zeros(CYCLE, bool)
_IN_COVER[list(COVER)] = True
#: _SHIFT[a, b]: words from places of residues a and b to the first pair of sampled ones.
_SHIFT = np.array([[next(d for d in range(CYCLE) if _IN_COVER[(a + d) % CYCLE] and _IN_COVER[(b + d) % CYCLE]) for b in range(CYCLE)] for a in range(CYCLE)], np.int64)


def _matching(t: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many words from places a and b on are equal, up to `most`; t ends in a word that differs from all others."""
    out, live = most.copy(), np.flatnonzero(most > 0)
    for d in range(int(most.max(initial=0))):
        differ = t[a[live] + d] != t[b[live] + d]
        out[live[differ]] = d
        live = live[~differ]
        live = live[most[live] > d + 1]
        if not len(live):
            break
    return out


class Extension:
    """Longest common extensions to the right in a text of word numbers from 1 on."""

    def __init__(self, text: np.ndarray):
        self.n = len(text)
        self.padded = np.concatenate([text, np.zeros(CYCLE + 1, text.dtype)])
        self.rank_at: np.ndarray | None = None

    def _build(self) -> None:
        # samples in the order of (residue, place): the sample CYCLE words on is the next one of its residue
        places = [np.arange(c, self.n + 1, CYCLE) for c in COVER]
        at, room = np.concatenate(places), np.concatenate([np.arange(len(x), 0, -1) for x in places])
        kind = ">u2" if self.padded.max() < 1 << 16 else ">u4"
        blocks = np.lib.stride_tricks.sliding_window_view(self.padded.astype(kind), CYCLE)[at]
        names = np.unique(np.ascontiguousarray(blocks).view(f"S{blocks.dtype.itemsize * CYCLE}").ravel(), return_inverse=True)[1]
        del blocks
        levels, step = [names.astype(np.int64)], 1
        while levels[-1].max() + 1 < len(at):
            ahead = np.where(room > step, np.append(levels[-1], np.zeros(step, np.int64))[step:] + 1, 0)
            levels.append(np.unique(levels[-1] * (len(at) + 1) + ahead, return_inverse=True)[1].astype(np.int64))
            step *= 2
        order = np.argsort(levels[-1])
        a, b, common = order[:-1].copy(), order[1:].copy(), np.zeros(len(order) - 1, np.int64)
        for k in range(len(levels) - 2, -1, -1):
            same = levels[k][a] == levels[k][b]
            a[same] += 1 << k
            b[same] += 1 << k
            common[same] += CYCLE << k
        common += _matching(self.padded, at[a], at[b], np.full(len(a), CYCLE))
        self.least = [common]
        while len(self.least[-1]) > 1 << (len(self.least) - 1):
            half = 1 << (len(self.least) - 1)
            self.least.append(np.minimum(self.least[-1][:-half], self.least[-1][half:]))
        self.rank_at = np.full(self.n + 1, -1, np.int64)
        self.rank_at[at] = levels[-1]

    def at(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words from places a and b on (a < b <= n)."""
        shift = _SHIFT[a % CYCLE, b % CYCLE]
        near = np.minimum(shift, self.n - b)
        out = _matching(self.padded, a, b, near)
        far = np.flatnonzero((out == shift) & (b + shift < self.n))
        if len(far):
            if self.rank_at is None:
                self._build()
            ends = np.stack([self.rank_at[(a + shift)[far]], self.rank_at[(b + shift)[far]]])
            low, high = ends.min(0), ends.max(0)
            level = np.frexp((high - low).astype(float))[1] - 1
            got = np.empty(len(far), np.int64)
            for k in np.unique(level):
                of = level == k
                got[of] = np.minimum(self.least[k][low[of]], self.least[k][high[of] - (1 << int(k))])
            out[far] += got
        return out


def _grid(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of the harmonic grid: places i with i + 2 p inside, for p up to n / 3; about GRID at a time."""
    periods = np.arange(1, n // 3 + 1)
    sizes = (n - 1 - 2 * periods) // periods + 1
    ends = np.cumsum(sizes)
    at = 0
    while at < len(periods):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GRID, "right")))
        part, some = periods[at:to], sizes[at:to]
        before = np.cumsum(some) - some
        yield (np.arange(int(some.sum())) - np.repeat(before, some)) * np.repeat(part, some), np.repeat(part, some)
        at = to


@dataclass
class Runs:
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def runs_of(text: np.ndarray, shortest: int = SHORTEST) -> Runs:
    """The runs of a text of word numbers (from 1 on), by start, then period."""
    n, found = len(text), []
    if n >= shortest:
        right, left = Extension(text), Extension(text[::-1])
        for i, p in _grid(n):
            word = text[i]
            thrice = np.flatnonzero(word == text[i + p])
            i, p = i[thrice], p[thrice]
            thrice = np.flatnonzero(text[i] == text[i + 2 * p])
            i, p = i[thrice], p[thrice]
            if len(i):
                ahead = right.at(i, i + p)
                wide = ahead >= p  # three places of the grid lie inside
                i, p, ahead = i[wide], p[wide], ahead[wide]
                back = left.at(n - i - p, n - i)
                good = (back < p) & (ahead + back >= 2 * p) & (ahead + back + p >= shortest)
                found.append(np.stack([i - back, ahead + back + p, p])[:, good])
    if not found:
        return Runs(*np.zeros((3, 0), np.int64))
    start, length, period = np.concatenate(found, 1)
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[first], length[first], period[first]
    order = np.lexsort((period, start))
    return Runs(start[order], length[order], period[order])


def kept_words(n: int, runs: Runs) -> np.ndarray:
    """Which of n words no run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs.start + runs.period, 1)
    np.add.at(edge, runs.start + runs.length, -1)
    return np.cumsum(edge[:-1]) == 0


_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class _Numbers(dict):
    """Numbers words from 1 on as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self) + 1
        return found


def _search(shortest: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts, ends, spans = [], [0], []
            for text in batch.column(batch.num_columns - 1).cast(pa.binary()):
                words = (text.as_py() or b"").split()
                runs = runs_of(np.fromiter(map(_Numbers().__getitem__, words), np.int64, len(words)), shortest)
                if len(runs.start):
                    spans.append(runs)
                    words = [words[k] for k in np.flatnonzero(kept_words(len(words), runs))]
                texts.append(b" ".join(words))
                ends.append(ends[-1] + len(runs.start))
            columns = [pa.array(np.concatenate([getattr(r, c) for r in spans]) if spans else [], pa.int64()) for c in ("start", "length", "period")]
            runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], runs, pa.array(texts, pa.binary()).cast(pa.string())], [*batch.schema.names[:-1], "runs", "collapsed"])

    return search


def find_runs(docs: DataFrame, keep: dict[str, Column], text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """The columns of `keep`, `runs` (array of start, length, period; words are numbered from 0), and `collapsed` (the words that
    no run holds after its first period, joined by one space)."""
    rows = docs.select(*[c.alias(f"_{k}") for k, c in enumerate(keep.values())], F.col(text).alias("_text"))
    schema = ", ".join([*(f"`_{k}` {rows.schema[k].dataType.simpleString()}" for k in range(len(keep))), f"runs {_RUNS}", "collapsed string"])
    found = on_workers(rows).mapInArrow(_search(shortest), schema)
    return found.select(*[F.col(f"_{k}").alias(name) for k, name in enumerate(keep)], "runs", "collapsed")


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period; ties: smallest start, then period. Null without runs.

    Lengths stay below 2^26, so two different fractions differ as doubles, and equal ones don't.
    """
    ranked = F.transform(runs, lambda r: F.struct((r["length"].cast("double") / r["period"]).alias("times"), (-r["start"]).alias("a"), (-r["period"]).alias("b"), r["length"].alias("length")))
    best = F.array_max(ranked)
    return F.struct((-best["a"]).alias("start"), best["length"].alias("length"), (-best["b"]).alias("period"))


def with_repeats(doc_id: Column, text: Column, word: str) -> Column:
    """The text with a planted run where the contract asks for one: of an id's CRC-32 h with h % 10 = 0, words from a on repeat the p words there."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_extract_all(text, F.lit(word), F.lit(0))

    def planted(x: Column) -> Column:
        n, g = F.size(x).cast("long"), F.floor(h / 10)
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        again = F.transform(F.sequence(F.lit(0).cast("long"), n - a - 1), lambda k: F.element_at(x, (a + k % p + 1).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(x, F.lit(1), a.cast("int")), again), " ")).otherwise(F.lit(""))

    return F.when((h % 10 == 0) & text.isNotNull(), F.element_at(F.transform(F.array(words), planted), 1)).otherwise(text)
