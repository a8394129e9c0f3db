"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of 0 to ORDER bytes, counted over its training texts and then frozen. The code
length of a byte follows PPM with escape method C: in the longest context that was seen, a byte that was seen there costs
its share of the count plus the number of different bytes; any other byte pays the escape and is looked up in the context
one byte shorter; below the empty context all symbols are alike. A text's language is the one whose tree gives it the
shortest code; the score is that language's share among the code lengths taken as probabilities, tempered by TEMPER.

The trees are folded into two tables: the number of each context of ORDER bytes, and the code length of every symbol in it
in every language. So a text costs a few array lookups for each byte. Bytes are letters: A-Z count as a-z, and all ASCII
bytes that aren't letters are one symbol, of which runs count once. Bytes of the training texts are the alphabet.

Training takes a bounded sample: about MAX_DOCS rows that are in the training fold and have a language. Each language is drawn
at its own rate, by a hash of doc_id and text: all rows of those that have few, and as many of each other one. Counts are summed in the tasks, then by key.

Cases: null text, or one without a letter: `und`, score 0. No training rows: all `und`. Ties: the first language by name.
Repeated rows: a row each. Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytewords import pieces, texts_of
from tidemark.llm.scale import crc_of_id, on_workers

ORDER, MAX_DOCS, TEMPER = 3, 20_000, 20.0
FOLDS = 5
_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[97:123] = np.arange(97, 123)
_SYMBOL[65:91] = np.arange(97, 123)
_SYMBOL[128:] = np.arange(128, 256)


def stream(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, each preceded by one 0 and with runs of 0 as one; and the number of the text of each."""
    texts = texts_of(column)
    symbols = _SYMBOL[texts.data]
    text = np.repeat(np.arange(texts.n), texts.sizes)
    keep = symbols > 0
    keep[1:] |= symbols[:-1] > 0
    cuts = texts.bounds[:-1][texts.sizes > 0]
    keep[cuts] = symbols[cuts] > 0
    symbols, text = symbols[keep], text[keep]
    first = np.searchsorted(text, np.arange(texts.n))
    return np.insert(symbols, first, 0), np.insert(text, first, np.arange(texts.n))


def grams(symbols: np.ndarray, order: int) -> np.ndarray:
    """Each symbol with the `order` symbols before it as one number (the symbol in the last byte); before the first: 0."""
    out = symbols.astype(np.uint32)
    for k in range(1, order + 1):
        out[k:] |= symbols[:-k].astype(np.uint32) << np.uint32(8 * k)
    return out


def rates_of(counts: dict[str, int], most: int) -> dict[str, float]:
    """Each class's share of rows to draw, so that about `most` are drawn: a common number of each, or all of those that have fewer."""
    level, left = 0.0, float(most)
    for k, n in enumerate(sorted(counts.values())):
        level = left / (len(counts) - k)
        if n > level:
            break
        left -= n
    else:
        return dict.fromkeys(counts, 1.0)
    return {name: min(1.0, level / n) for name, n in counts.items()}


def training_rows(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """lang, text of about max_docs rows of the training fold, dealt over the languages as evenly as their rows allow."""
    fold = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_of_id(F.col("doc_id")) % FOLDS != 0))
    rates = rates_of({r["lang"]: r["count"] for r in fold.groupBy("lang").count().collect()}, max_docs)
    if not rates:
        return fold.select("lang", "text")
    rate = F.element_at(F.create_map(*[F.lit(x) for pair in rates.items() for x in pair]), F.col("lang"))
    u = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 11).cast("double") / float(1 << 53)
    return fold.where(u < rate).select("lang", "text")


def gram_counts(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, gram, n over all rows: sums in each task, then by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            symbols, text = stream(batch.column(1))
            own = grams(symbols, order)
            coded = batch.column(0).dictionary_encode()
            lang = coded.indices.to_numpy()[text]
            # the 0 that opens a text is context, not a symbol to learn
            opens = np.ones(len(text), bool)
            opens[1:] = text[1:] != text[:-1]
            for k, name in enumerate(coded.dictionary.to_pylist()):
                keys, n = np.unique(own[(lang == k) & ~opens], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    return on_workers(rows).mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Tables:
    """contexts: number of each context seen (by its symbols' numbers), else that of the shorter one; cost: bits."""

    langs: list[str]
    number: np.ndarray
    row: np.ndarray
    cost: np.ndarray
    size: int
    order: int


def fold_tables(lang: np.ndarray, gram: np.ndarray, n: np.ndarray, order: int = ORDER) -> Tables:
    """The frozen trees as tables."""
    langs = sorted(set(lang.tolist()))
    bytes_of = [(gram >> (8 * k)) & 255 for k in range(order + 1)]
    alphabet = np.union1d(np.unique(np.concatenate(bytes_of)) if len(gram) else np.zeros(0, np.int64), [0])
    size = len(alphabet) + 1  # the last number is any other byte
    number = np.full(256, size - 1, np.int64)
    number[alphabet] = np.arange(len(alphabet))
    mapped = [number[b] for b in bytes_of]  # 0: the symbol, k: k symbols before it
    contexts = np.zeros(len(gram), np.int64)
    for k in range(order, 0, -1):
        contexts = contexts * size + mapped[k]
    seen, at = np.unique(contexts, return_inverse=True)
    row = np.full(size**order, -1, np.int32)
    row[seen] = np.arange(len(seen))
    cost = np.zeros((len(seen) + size**2 + 1, size, len(langs)), np.float32)
    for j, name in enumerate(langs):
        mine = np.array(lang == name)
        # bits of every symbol in contexts of 0, 1, ... symbols; a shorter context is the last symbols of a longer one
        shorter = np.full((1, size), np.log2(size))
        for k in range(order + 1):
            width = size**k if k < order else len(seen)
            place = sum((mapped[i] * size ** (i - 1) for i in range(1, k + 1)), np.zeros(len(gram), np.int64)) if k < order else at
            counts = np.bincount(place[mine] * size + mapped[0][mine], n[mine], width * size).reshape(width, size)
            total, kinds = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
            parent = np.arange(width) % size ** (k - 1) if 0 < k < order else seen % size ** (k - 1) if k else np.zeros(1, np.int64)
            with np.errstate(divide="ignore", invalid="ignore"):
                shared = np.log2(total + kinds)
                bits = np.where(counts > 0, shared - np.log2(counts), np.where(total > 0, shared - np.log2(kinds), 0) + shorter[parent])
            if k == order - 1:
                # contexts of full order that no language has are looked up here
                cost[len(seen) : len(seen) + width, :, j] = bits[:width]
            shorter = bits
        cost[: len(seen), :, j] = shorter
    missing = row < 0
    row[missing] = len(seen) + np.flatnonzero(missing) % size ** (order - 1)
    return Tables(langs, number.astype(np.int64), row, cost.reshape(cost.shape[0] * size, len(langs)), size, order)


def code_lengths(tables: Tables, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bits of each text in each language (texts x languages), and the number of symbols."""
    symbols, text = stream(column)
    coded = tables.number[symbols]
    context = np.zeros(len(coded), np.int64)
    for k in range(1, tables.order + 1):
        context[k:] += coded[:-k] * tables.size ** (k - 1)
    # texts open with 0; what lies before that belongs to the text before and is set to 0 too
    opens = np.ones(len(text), bool)
    opens[1:] = text[1:] != text[:-1]
    starts = np.flatnonzero(opens)
    for k in range(1, tables.order):
        # the k-th symbol after the opening 0 sees k symbols of its own text
        at = starts + k
        at = at[at < len(text)]
        at = at[text[at] == text[at - k]]
        context[at] %= tables.size**k
    place = tables.row[context].astype(np.int64) * tables.size + coded
    place, text = place[~opens], text[~opens]
    bits = np.stack([np.bincount(text, tables.cost[place, j], len(column)) for j in range(len(tables.langs))], axis=1) if tables.langs else np.zeros((len(column), 0))
    return bits, np.bincount(text, minlength=len(column))


def lettered(column: pa.Array) -> np.ndarray:
    """Which texts have a letter."""
    texts = texts_of(column)
    ascii_letter = np.zeros(256, bool)
    ascii_letter[65:91] = ascii_letter[97:123] = True
    totals = np.concatenate([[0], np.cumsum(ascii_letter[texts.data])])
    has = totals[texts.bounds[1:]] > totals[texts.bounds[:-1]]
    for k in np.flatnonzero(~has & (texts.sizes > 0)).tolist():
        has[k] = any(c.isalpha() for c in column[k].as_py())
    return has


def identify(docs: DataFrame, max_docs: int = MAX_DOCS, order: int = ORDER, keep: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, the columns of keep, lang_pred, score, bits_per_symbol, for each row of docs (doc_id, text, lang)."""
    counted = gram_counts(training_rows(docs, max_docs), order).toArrow()
    tables = fold_tables(np.array(counted.column("lang").to_pylist(), object), counted.column("gram").to_numpy(), counted.column("n").to_numpy(), order)
    model = docs.sparkSession.sparkContext.broadcast(tables)
    keep = keep or {}
    inputs = docs.select("doc_id", *[c.alias(k) for k, c in keep.items()], "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.value
        for batch in pieces(batches):
            column = batch.column(batch.num_columns - 1)
            bits, n = code_lengths(tables, column)
            known = lettered(column) & (n > 0) & bool(tables.langs)
            if tables.langs:
                best = bits.argmin(axis=1)
                share = 1 / np.exp2(-np.minimum((bits - bits.min(axis=1, keepdims=True)) / TEMPER, 1000)).sum(axis=1)
                least = bits.min(axis=1)
            else:
                best, share, least = np.zeros(len(n), int), np.zeros(len(n)), np.zeros(len(n))
            names = [tables.langs[k] if ok else "und" for k, ok in zip(best, known, strict=True)]
            added = [pa.array(names, pa.string()), pa.array(np.where(known, share, 0.0)), pa.array(np.where(known, least / np.maximum(n, 1), 0.0))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], names=[*batch.schema.names[:-1], "lang_pred", "score", "bits_per_symbol"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inputs.schema.fields[:-1])
    return on_workers(inputs).mapInArrow(run, f"{fields}, lang_pred string, score double, bits_per_symbol double")
