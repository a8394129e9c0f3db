"""Toxicity by maximum-scoring segments.

Each token (a lower-cased run of letters and digits, and its stems of 4 to 8 bytes) has the log-odds of being used by toxic
rather than clean training documents, with a Dirichlet prior: PRIOR documents that use it at the labels' own share of toxic
ones stand behind its counts, so a token that few documents use is drawn to 0. A word scores the most decisive of its own and
its stems' log-odds, for toxic or for clean, less DRIFT, so clean text drifts down. One scan of a document, linear in its
length, finds every maximal segment: all passages whose score can't be raised by growing or shrinking.

The best segment of a clean text of n words follows an extreme-value law whose location grows with log n. Its location
and scale are fitted to clean documents of a calibration fold that the log-odds haven't seen. Under this law the sum of a
text's r best normalised segments exceeds t with probability exp(-t) t^(r-1) / (r! (r-1)!). A text's evidence is the least of
these over all r, times 2^r for the choice of r; so one strong passage counts as well as several weaker ones. The score is
the odds, at the labels' own share of toxic documents, that the segments aren't from that law. A passage is significant if
it would make a text toxic by itself.

Labelled rows are a bounded sample of about MAX_LABELLED, by a hash of doc_id, so the labels can be broadcast; counts are
summed in tasks and by key, and the lexicon is bounded by the sample.

Cases: null or empty text, or no word: no segment, the lowest score. No labelled rows, or none toxic: nothing is toxic.
Labels that are null are left out; several labels of one document count each. Repeated rows: a row each. Empty table:
empty result. Further columns: `remove` keeps those of docs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytewords import PIECE, pair_counts, pieces, prefix_hashes, texts_of, words_of
from tidemark.llm.scale import crc_of_id, materialize, on_workers

FOLDS, CALIBRATION_FOLD = 5, 4
MAX_LABELLED = 20_000
PRIOR, DRIFT = 2.0, 1.0
#: Lengths in bytes of the stems of a word that count as tokens too.
STEMS = range(4, 9)
SLOTS = 1 << 20
#: Least scale of the law, and how strict it is: clean texts beyond it are at most about this share of the toxic ones.
LEAST_SCALE, PER_LABEL = 0.25, 0.005
#: A score from which a document is taken to be toxic.
TOXIC = 0.5
#: Bytes of text that a task works on at once: the arrays of tokens and segments are many times their text.
SLICE = PIECE // 2


def labelled(docs: DataFrame, labels: DataFrame, label: str, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """text, label (0 or 1), fold (1 to 4) of about max_labelled rows outside the held-out fold."""
    marked = labels.where(F.col(label).isNotNull()).select(F.col("doc_id").alias("_label_id"), F.col(label).cast("int").alias("label"))
    marked = marked.withColumn("fold", crc_of_id(F.col("_label_id")) % FOLDS).where("fold != 0")
    share = max_labelled / max(1, marked.count())
    marked = marked.where(F.shiftrightunsigned(F.xxhash64("_label_id"), 11).cast("double") / float(1 << 53) < share)
    # about max_labelled rows of three numbers, however many labels there are
    return docs.join(F.broadcast(marked), docs["doc_id"] == marked["_label_id"]).select("text", "label", "fold")


@dataclass
class Tokens:
    """Of each word its text's number; and of each kind of token which words have it (None: all), and their hashes."""

    text: np.ndarray
    kinds: list[tuple[np.ndarray | None, np.ndarray]]
    n: int


def tokens(column: pa.Array) -> Tokens:
    texts = texts_of(column)
    words = words_of(texts, punctuation=False)
    kinds: list[tuple[np.ndarray | None, np.ndarray]] = [(None, words.hash)]
    length = words.end - words.start
    for k in STEMS:
        has = np.flatnonzero(length > k)
        kinds.append((has, prefix_hashes(texts.data, words.start[has], k)))
    return Tokens(words.text, kinds, texts.n)


def values_of(found: Tokens, lexicon: Lexicon) -> np.ndarray:
    """The most decisive log-odds of each word's tokens; 0 if none is known."""
    out = lexicon.of(found.kinds[0][1])
    for has, hashes in found.kinds[1:]:
        odds = lexicon.of(hashes)
        stronger = np.abs(odds) > np.abs(out[has])
        out[has[stronger]] = odds[stronger]
    return out


def token_counts(rows: DataFrame) -> DataFrame:
    """token, toxic, docs: how many of the sample's documents of either label use each token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 0, SLICE):
            found = tokens(batch.column(0))
            text = np.concatenate([found.text if has is None else found.text[has] for has, _ in found.kinds])
            of, name, n = pair_counts(text, np.concatenate([hashes for _, hashes in found.kinds]))
            label = batch.column(1).to_numpy()[of]
            for k in (0, 1):
                keys, at = np.unique(name[label == k], return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), k)), pa.array(np.bincount(at, n[label == k], len(keys)).astype(np.int64)), pa.array(np.bincount(at, minlength=len(keys)))], names=["token", "toxic", "n", "docs"])

    out = on_workers(rows).select("text", "label").mapInArrow(run, "token bigint, toxic bigint, n bigint, docs bigint")
    return out.groupBy("token", "toxic").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


@dataclass
class Lexicon:
    """Tokens in order of their hash, and their log-odds."""

    token: np.ndarray
    odds: np.ndarray

    def __post_init__(self) -> None:
        # turns most words away before the search
        self.slots = np.zeros(SLOTS, bool)
        self.slots[self.token & np.uint64(SLOTS - 1)] = True

    def of(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes))
        maybe = np.flatnonzero(self.slots[hashes & np.uint64(SLOTS - 1)])
        if len(maybe):
            sought = hashes[maybe]
            at = np.searchsorted(self.token, sought)
            at[at == len(self.token)] = 0
            out[maybe] = np.where(self.token[at] == sought, self.odds[at], 0.0)
        return out


def lexicon_of(counts: DataFrame, n_docs: tuple[int, int]) -> Lexicon:
    """Log-odds of every token of the sample. n_docs: clean and toxic documents of the sample."""
    of = lambda k: F.coalesce(F.sum(F.when(F.col("toxic") == k, F.col("docs"))), F.lit(0)).cast("double").alias(f"docs{k}")
    if not all(n_docs):
        return Lexicon(np.zeros(0, np.uint64), np.zeros(0))
    found = counts.groupBy("token").agg(of(0), of(1)).toArrow()
    clean, toxic = (x / sum(n_docs) for x in n_docs)
    odds = np.log((found.column("docs1").to_numpy() + PRIOR * toxic) / toxic) - np.log((found.column("docs0").to_numpy() + PRIOR * clean) / clean)
    token = found.column("token").to_numpy().view(np.uint64)
    order = np.argsort(token)
    return Lexicon(token[order], odds[order])


def segments(value: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of one text, by the scores of its words: first and last word, and score.

    The linear-time scan keeps candidates with the running totals at their left and right ends, each chained to the last
    earlier one whose left total is lower. A new one is joined with that of its own if its right total is higher.
    """
    found: list[tuple[int, int, float, float, int]] = []  # first, last, left total, right total, place of the one it is chained to
    at = np.flatnonzero(value > 0)
    total = np.cumsum(value)
    for last, left, right in zip(at.tolist(), (total[at] - value[at]).tolist(), total[at].tolist(), strict=True):
        first = last
        back = len(found) - 1
        while back >= 0 and found[back][2] >= left:
            back = found[back][4]
        while back >= 0 and found[back][3] < right:
            first, _, left, _, earlier = found[back]
            del found[back:]
            back = earlier
        found.append((first, last, left, right, back))
    return [(a, b, right - left) for a, b, left, right, _ in found]


@dataclass
class Segments:
    """All maximal segments of a batch: of each its text, first and last word, and score; words: of each text."""

    text: np.ndarray
    first: np.ndarray
    last: np.ndarray
    score: np.ndarray
    words: np.ndarray


def segments_of(column: pa.Array, lexicon: Lexicon, drift: float = DRIFT) -> Segments:
    found = tokens(column)
    value = values_of(found, lexicon) - drift
    bounds = np.searchsorted(found.text, np.arange(found.n + 1))
    rows = [(k, *x) for k in np.unique(found.text[value > 0]).tolist() for x in segments(value[bounds[k] : bounds[k + 1]])]
    text, first, last, score_ = zip(*rows, strict=True) if rows else ((), (), (), ())
    return Segments(np.array(text, np.int64), np.array(first, np.int64), np.array(last, np.int64), np.array(score_, float), np.diff(bounds))


def best_of(found: Segments) -> np.ndarray:
    """Of each text: the score of its best segment (0 for none)."""
    best = np.zeros(len(found.words))
    np.maximum.at(best, found.text, found.score)
    return best


@dataclass
class Law:
    """Extreme-value law of the best segment of clean texts: location = slope * log(words) + base; and the labels' odds of toxic."""

    slope: float
    base: float
    scale: float
    odds: float

    def normal(self, score_: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Segments' scores as multiples of the scale above the location."""
        return (score_ - self.slope * np.log(np.maximum(words, 1)) - self.base) / self.scale

    def posterior(self, log_tail: np.ndarray) -> np.ndarray:
        return self.odds / (self.odds + np.exp(np.maximum(log_tail, -690.0)))

    def score(self, found: Segments) -> np.ndarray:
        """Of each text: posterior that its segments aren't a clean text's; 0 for no segment."""
        out = np.zeros(len(found.words))
        if not len(found.text):
            return out
        z = self.normal(found.score, found.words[found.text])
        order = np.lexsort((-z, found.text))
        text, z = found.text[order], z[order]
        first = np.searchsorted(text, np.arange(len(out)))
        rank = np.arange(len(text)) - first[text] + 1
        total = np.cumsum(z)
        total -= (total[first[text]] - z[first[text]])
        # one segment: the law itself; the r best: the tail of their sum, and a factor of two for each further one
        one = np.log(-np.expm1(-np.exp(-np.clip(z, -30, 690))))
        log_factorial = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, rank.max() + 1)))])
        several = -total + (rank - 1) * np.log(np.maximum(total, 1e-9)) - log_factorial[rank] - log_factorial[rank - 1]
        tail = np.where(rank == 1, one, np.where(total > rank, several, 0.0)) + rank * np.log(2.0)
        least = np.zeros(len(out))
        np.minimum.at(least, text, tail)
        has = np.zeros(len(out), bool)
        has[text] = True
        return np.where(has, self.posterior(least), 0.0)

    def significant(self, found: Segments) -> np.ndarray:
        """Which segments would make their text toxic by themselves."""
        z = self.normal(found.score, found.words[found.text])
        return self.posterior(np.log(-np.expm1(-np.exp(-np.clip(z, -30, 690)))) + np.log(2.0)) >= TOXIC


def fit_law(best: np.ndarray, words: np.ndarray, toxic: np.ndarray) -> Law:
    """Gumbel law by quantiles, on clean rows, with the location's growth by least squares."""
    clean, hurt = (toxic == 0) & (words > 0), toxic == 1
    if clean.sum() < 2 or not hurt.any():
        return Law(0.0, 1e9, 1.0, 1e-9)
    x, y = np.log(words[clean]), best[clean]
    slope = max(0.0, float(np.cov(x, y)[0, 1] / max(np.var(x), 1e-9)))
    # by quantiles, so that a few mislabelled or odd texts don't widen the law
    middle, upper = np.quantile(y - slope * x, [0.5, 0.95])
    at = lambda q: -np.log(-np.log(q))
    scale = max(LEAST_SCALE, float((upper - middle) / (at(0.95) - at(0.5))))
    return Law(slope, float(middle - scale * at(0.5)), scale, float(hurt.sum() / clean.sum()) * PER_LABEL)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_labelled: int = MAX_LABELLED) -> tuple[Lexicon, Law]:
    rows = materialize(labelled(docs, labels, label, max_labelled), "toxicity-sample")
    learned = rows.where(F.col("fold") != CALIBRATION_FOLD)
    n_docs = learned.agg(F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1)).first()
    lexicon = lexicon_of(token_counts(learned), tuple(n_docs))
    model = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 0, SLICE):
            found = segments_of(batch.column(0), model.value)
            yield pa.RecordBatch.from_arrays([pa.array(best_of(found)), pa.array(found.words), batch.column(1)], names=["best", "words", "label"])

    held = on_workers(rows).where(F.col("fold") == CALIBRATION_FOLD).select("text", "label").mapInArrow(run, "best double, words bigint, label int").toArrow()
    return lexicon, fit_law(*[held.column(k).to_numpy() for k in range(3)])


def score(docs: DataFrame, labels: DataFrame, carry: dict[str, Column], label: str = "toxic", max_labelled: int = MAX_LABELLED, with_text: bool = False) -> DataFrame:
    """The columns of carry, then _tox_score (0 to 1) and _tox_passages (how many significant ones), for each row of docs. with_text: and the text, as _tox_text."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, label, max_labelled))
    inputs = docs.select(*[c.alias(k) for k, c in carry.items()], F.col("text").alias("_tox_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, law = model.value
        kept = slice(None) if with_text else slice(-1)
        for batch in pieces(batches, size=SLICE):
            found = segments_of(batch.column(batch.num_columns - 1), lexicon)
            many = np.bincount(found.text[law.significant(found)], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[kept], pa.array(law.score(found)), pa.array(many)], names=[*batch.schema.names[kept], "_tox_score", "_tox_passages"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inputs.schema.fields[: None if with_text else -1])
    return on_workers(inputs).mapInArrow(run, f"{fields}, _tox_score double, _tox_passages bigint")


def passages(docs: DataFrame, lexicon: Lexicon, law: Law) -> DataFrame:
    """doc_id, first_word, last_word, passage_score: every significant toxic passage (words are runs of letters and digits)."""
    model = docs.sparkSession.sparkContext.broadcast((lexicon, law))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, law = model.value
        for batch in pieces(batches, size=SLICE):
            found = segments_of(batch.column(1), lexicon)
            sure = law.significant(found)
            columns = [batch.column(0).take(pa.array(found.text[sure])), *[pa.array(x[sure]) for x in (found.first, found.last, found.score)]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "first_word", "last_word", "passage_score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return on_workers(docs).select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, first_word bigint, last_word bigint, passage_score double")


def remove(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those that score as toxic."""
    found = score(docs, labels, {c: F.col(f"`{c}`") for c in docs.columns if c != "text"}, with_text=True)
    return found.where(F.col("_tox_score") < TOXIC).select(*[F.col("_tox_text").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
