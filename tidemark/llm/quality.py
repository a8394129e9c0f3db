"""Quality classifier: kernel ridge on document statistics, calibrated.

STATS numbers describe a text. Random Fourier features, cosines of fixed random projections of the standardised numbers,
approximate a Gaussian kernel over them. Tasks sum the normal equations of their rows; the sums are added by row of the
matrix, so no task and not the driver ever holds more than matrices of FEATURES x FEATURES. Ridge weights solve them, and
isotonic regression on a fold that the weights haven't seen turns the linear score into the share of label 1.

Labelled rows are a bounded sample of about MAX_LABELLED, by a hash of doc_id, so the labels can be broadcast. Scoring
computes the numbers of a whole batch of texts at once and nothing is shuffled.

Cases: null or empty text, or no word: statistics 0, scored like any text. No labelled rows: 0.5 for all; only one label:
its share. Repeated rows: a row each. Empty table: empty result. Null labels are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytewords import Texts, pair_counts, pieces, shingles_of, sums_by_text, texts_of, words_of
from tidemark.llm.scale import materialize, on_workers
from tidemark.llm.toxicity import CALIBRATION_FOLD, MAX_LABELLED, labelled

FEATURES, WIDTH, RIDGE, SEED = 256, 0.35, 1e-2, 17
#: Bins of equal calibration rows that isotonic regression works on.
BINS = 200
GOOD = 0.3
_CLASSES = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "symbol": b"#*$%&|<>", "end": b".!?", "shout": b"!", "high": range(128, 256)}
STATS = 21


def _class_shares(texts: Texts) -> np.ndarray:
    kind = np.zeros((256, len(_CLASSES)), bool)
    for k, values in enumerate(_CLASSES.values()):
        kind[list(values), k] = True
    size = np.maximum(texts.sizes, 1)
    out = np.zeros((texts.n, len(_CLASSES)))
    for k in range(len(_CLASSES)):
        total = np.concatenate([[0], np.cumsum(kind[texts.data, k], dtype=np.int64)])
        out[:, k] = (total[texts.bounds[1:]] - total[texts.bounds[:-1]]) / size
    return out


def statistics(column: pa.Array) -> np.ndarray:
    """texts x STATS."""
    texts = texts_of(column)
    words = words_of(texts)
    n = words.counts
    per_word = 1 / np.maximum(n, 1)
    length = (words.end - words.start).astype(float)
    mean = sums_by_text(length, words.text, texts.n) * per_word
    spread = np.sqrt(np.maximum(0, sums_by_text(length**2, words.text, texts.n) * per_word - mean**2))
    of, _, times = pair_counts(words.text, words.hash)
    distinct = np.bincount(of, minlength=texts.n) * per_word
    top = np.zeros(texts.n)
    np.maximum.at(top, of, times)
    grams, at = shingles_of(words, 3)
    order = np.argsort(at, kind="stable")
    gram_of, _, gram_times = pair_counts(at[order], grams[order])
    runs = np.maximum(np.bincount(at, minlength=texts.n), 1)
    fresh = np.bincount(gram_of, minlength=texts.n) / runs
    twice = np.bincount(gram_of, gram_times * (gram_times > 1), texts.n) / runs
    # lines: their hash is the sum of their words' hashes by place, so equal lines are equal
    newline = np.cumsum(texts.data == 10)
    line = newline[words.start] if len(words.start) else np.zeros(0, np.int64)
    opens = np.ones(len(line), bool)
    opens[1:] = (line[1:] != line[:-1]) | (words.text[1:] != words.text[:-1])
    first = np.flatnonzero(opens)
    lines = np.bincount(words.text[first], minlength=texts.n)
    with np.errstate(over="ignore"):
        place = (np.arange(len(line)) - np.repeat(first, np.diff(np.append(first, len(line))))).astype(np.uint64)
        line_hash = np.add.reduceat(words.hash * (2 * place + np.uint64(1)), first) if len(first) else np.zeros(0, np.uint64)
    line_of, _, _ = pair_counts(words.text[first], line_hash)
    new_lines = np.bincount(line_of, minlength=texts.n) / np.maximum(lines, 1)
    same = np.zeros(len(words.hash), bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (words.text[1:] == words.text[:-1])
    shares = _class_shares(texts)
    log_n = np.log1p(n)
    columns = [log_n, np.log1p(texts.sizes), mean, spread, distinct, distinct * log_n, top * per_word, fresh, twice, np.log1p(lines), new_lines, np.log1p(n / np.maximum(lines, 1)), sums_by_text(same, words.text, texts.n) * per_word, sums_by_text(length > 12, words.text, texts.n) * per_word]
    return np.column_stack([*columns, *shares.T])


@dataclass
class Model:
    """center and scale of the statistics, the projections, the ridge weights, and the calibration's steps."""

    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None = None
    edges: np.ndarray | None = None
    values: np.ndarray | None = None

    def features(self, stats: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        w, b = rng.normal(size=(STATS, FEATURES - 1)) * WIDTH, rng.uniform(0, 2 * np.pi, FEATURES - 1)
        x = np.clip((stats - self.center) / self.scale, -8, 8)
        return np.column_stack([np.ones(len(x)), np.sqrt(2 / (FEATURES - 1)) * np.cos(x @ w + b)])

    def linear(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.values is None:
            return np.full(len(stats), 0.5)
        return np.clip(np.interp(self.linear(stats), self.edges, self.values), 0.0, 1.0)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the non-decreasing fit to y in the order of x."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []
    for value, w in zip(y[order].tolist(), weight[order].tolist(), strict=True):
        blocks.append([value * w, w, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, w2, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + w2, blocks[-1][2] + k]
    fitted = np.concatenate([np.full(int(k), s / w) for s, w, k in blocks])
    out = np.empty(len(x))
    out[order] = fitted
    return out


def normal_equations(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y of all rows (stats array, label): summed in tasks, then by row of the matrix."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES, FEATURES + 1))
        for batch in batches:
            z = shared.value.features(batch.column(0).flatten().to_numpy().reshape(-1, STATS))
            total += z.T @ np.column_stack([z, batch.column(1).to_numpy()])
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(FEATURES), pa.int32()), pa.array(list(total))], names=["i", "x"])

    parts = on_workers(rows).select("stats", "label").mapInArrow(run, "i int, x array<double>").select("i", F.posexplode("x").alias("j", "v"))
    cells = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((FEATURES, FEATURES + 1))
    out[cells.column("i").to_numpy(), cells.column("j").to_numpy()] = cells.column("v").to_numpy()
    return out[:, :-1], out[:, -1]


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_labelled: int = MAX_LABELLED) -> Model:
    sample = labelled(docs, labels, label, max_labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 0):
            yield pa.RecordBatch.from_arrays([pa.array(list(statistics(batch.column(0))), pa.list_(pa.float64())), batch.column(1), batch.column(2)], names=["stats", "label", "fold"])

    rows = materialize(on_workers(sample).select("text", "label", F.col("fold").cast("int").alias("fold")).mapInArrow(run, "stats array<double>, label int, fold int"), "quality-sample")
    learned = rows.where(F.col("fold") != CALIBRATION_FOLD)
    moments = learned.agg(F.count("*"), *[f(F.col("stats")[k]) for f in (F.avg, F.stddev_pop) for k in range(STATS)]).first()
    if not moments[0]:
        return Model(np.zeros(STATS), np.ones(STATS))
    model = Model(np.array(moments[1 : 1 + STATS]), np.maximum(np.array(moments[1 + STATS :]), 1e-6))
    gram, right = normal_equations(learned, model)
    model.weights = np.linalg.solve(gram + RIDGE * np.eye(FEATURES), right)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def linear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(shared.value.linear(batch.column(0).flatten().to_numpy().reshape(-1, STATS))), batch.column(1)], names=["x", "y"])

    # two numbers for each row of the bounded sample's calibration fold
    held = on_workers(rows).where(F.col("fold") == CALIBRATION_FOLD).select("stats", "label").mapInArrow(linear, "x double, y int").toArrow()
    x, y = held.column("x").to_numpy(), held.column("y").to_numpy().astype(float)
    if not len(x):
        x, y = np.zeros(1), np.array([right[0] / gram[0, 0]])
    order = np.argsort(x, kind="stable")
    bins = [b for b in np.array_split(order, min(BINS, len(order))) if len(b)]
    means, sizes = np.array([x[b].mean() for b in bins]), np.array([len(b) for b in bins], float)
    model.edges, model.values = means, isotonic(means, np.array([y[b].mean() for b in bins]), sizes)
    return model


def score(docs: DataFrame, labels: DataFrame, carry: dict[str, Column], label: str = "quality", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The columns of carry, then _q_score (0 to 1), for each row of docs."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, label, max_labelled))
    inputs = docs.select(*[c.alias(k) for k, c in carry.items()], F.col("text").alias("_q_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = model.value.score(statistics(batch.column(batch.num_columns - 1)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found)], names=[*batch.schema.names[:-1], "_q_score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inputs.schema.fields[:-1])
    return on_workers(inputs).mapInArrow(run, f"{fields}, _q_score double")
