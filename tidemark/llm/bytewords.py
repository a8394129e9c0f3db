"""Texts of an Arrow batch as flat arrays of bytes and words, so that NumPy handles a whole batch at once.

A word is named by a 64-bit hash of its bytes. Two kinds of words are known: runs between the six ASCII blanks (as in the
contracts), and runs of ASCII letters, digits and non-ASCII bytes, which drop punctuation. A-Z count as a-z in both.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_WORDLIKE = np.zeros(256, dtype=bool)
_WORDLIKE[48:58] = _WORDLIKE[65:91] = _WORDLIKE[97:123] = _WORDLIKE[128:] = True
#: Bytes of text that NumPy handles at once.
PIECE = 2 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bytes that are hashed at once; a longer word alone.
BLOCK = 1 << 15
_VALUE = _LOWER.astype(np.uint64) + np.uint64(1)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base to the power of 0 to n - 1, modulo 2^64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


_POWERS, _INVERSE = _powers(_BASE, BLOCK), _powers(np.uint64(pow(int(_BASE), -1, 1 << 64)), BLOCK)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Texts:
    """data: all bytes; bounds: where each text starts, and the end of the last one."""

    data: np.ndarray
    bounds: np.ndarray

    @property
    def n(self) -> int:
        return len(self.bounds) - 1

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """The column's bytes, without a copy for each text; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return Texts(np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64))
    bounds = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    return Texts(np.frombuffer(data, np.uint8, int(bounds[-1] - bounds[0]), int(bounds[0])), bounds - bounds[0])


def pieces(batches: Iterator[pa.RecordBatch], column: int = -1, size: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about `size` bytes of text (a longer text is a slice of its own), so that arrays over their bytes stay small."""
    for batch in batches:
        bounds = texts_of(batch.column(column % batch.num_columns)).bounds
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


@dataclass
class Words:
    """Of each word: its hash, its text's number, first byte and end; first: where each text's words start (and the end)."""

    hash: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words_of(texts: Texts, punctuation: bool = True, hashed: bool = True) -> Words:
    """All words of the batch, in order. punctuation: words are runs between blanks; else letters and digits only."""
    data = texts.data
    inside = ~_BLANK[data] if punctuation else _WORDLIKE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    cuts = texts.bounds[:-1][texts.sizes > 0]
    opens[cuts] = inside[cuts]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    closes[cuts[1:] - 1] = inside[cuts[1:] - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    first = np.searchsorted(start, texts.bounds)
    text = np.repeat(np.arange(texts.n), np.diff(first))
    return Words(word_hashes(data, start, end) if hashed else np.zeros(0, np.uint64), text, start, end, first)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of the lower-cased bytes of each word, mixed with its length. Words are in order and don't overlap.

    A word's sum is the difference of two prefix sums over a block of bytes, divided by the power at its first byte.
    """
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        left = int(start[at])
        to = max(at + 1, int(np.searchsorted(end, left + BLOCK, "right")))
        block = data[left : int(end[to - 1])]
        powers, inverse = (_POWERS, _INVERSE) if len(block) <= BLOCK else (_powers(_BASE, len(block)), _INVERSE)  # longer: one word
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(_VALUE[block] * powers[: len(block)], out=sums[1:])
        first = start[at:to] - left
        out[at:to] = (sums[end[at:to] - left] - sums[first]) * inverse[first]
        at = to
    return mixed(out + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def prefix_hashes(data: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """Hash of the first `size` bytes, lower-cased, of words that are longer."""
    total = np.zeros(len(start), np.uint64)
    with np.errstate(over="ignore"):
        power = np.uint64(size * 2 + 1)
        for k in range(size):
            total += (_LOWER[data[start + k]].astype(np.uint64) + np.uint64(1)) * power
            power *= _BASE
        return ~mixed(total)


def shingles_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words, and the number of the text of each; a text of fewer words is one run, of none none."""
    n = words.counts
    with np.errstate(over="ignore"):
        salt = [mixed(np.array([k + 1], np.uint64))[0] | np.uint64(1) for k in range(size)]
        whole = n >= size
        runs = np.where(whole, n - size + 1, 0)
        before = np.cumsum(runs) - runs
        at = np.arange(int(runs.sum())) - np.repeat(before, runs) + np.repeat(words.first[:-1], runs)
        total = np.zeros(len(at), np.uint64)
        for k in range(size):
            total += words.hash[at + k] * salt[k]
        short = np.flatnonzero((n > 0) & ~whole)
        few = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            has = n[short] > k
            few[has] += words.hash[words.first[short[has]] + k] * salt[k]
        few += n[short].astype(np.uint64)
        return np.concatenate([mixed(total), mixed(few)]), np.concatenate([np.repeat(np.arange(len(n)), runs), short])


def pair_counts(text: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, name) pairs and how often each occurs; text must be ascending."""
    if not len(text):
        return text, name, np.zeros(0, np.int64)
    order = np.lexsort((name, text))
    text, name = text[order], name[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (name[1:] != name[:-1])
    at = np.flatnonzero(new)
    return text[at], name[at], np.diff(np.append(at, len(text)))


def sums_by_text(values: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(text, values, n)
