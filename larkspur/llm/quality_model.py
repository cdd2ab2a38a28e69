"""Quality classifier: ridge regression on random Fourier features of text statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.fitting import labelled_sample, partition_sums
from larkspur.llm.scan import Words, slices
from larkspur.session import materialize

#: Labelled documents that a fit reads, about, at most.
SAMPLE = 60_000
FEATURES, RIDGE, SEED = 256, 1e-3, 20
# Of 100 parts of the sample, those that calibrate instead of fitting.
CALIBRATING = 30
BINS = 500
_FIT_PARTS = 12

_CLASSES = {
    "symbol": b"#*$%&|<>", "bang": b"!", "bar": b"|", "digit": b"0123456789",
    "stop": b".,;:?", "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "line": b"\n",
}
STATISTICS = 16


def statistics(column: pa.Array) -> np.ndarray:
    """Statistics of every text, a row each. Empty texts have zeros."""
    words = Words(column)
    hashes = words.hashes()
    n = len(column)
    spans = np.maximum(np.diff(words.offsets), 0)
    counts = np.maximum(np.diff(words.first), 0)
    doc_of_word = np.repeat(np.arange(n), counts)

    def per_text(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
        upto = np.append(0, np.cumsum(flags, dtype=np.int64))
        return (upto[edges[1:]] - upto[edges[:-1]]).astype(float)

    of = {}
    for name, members in _CLASSES.items():
        table = np.zeros(256, bool)
        table[list(members)] = True
        of[name] = per_text(table[words.raw], words.offsets)
    same = np.zeros(hashes.size, bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (doc_of_word[1:] == doc_of_word[:-1])
    repeated = per_text(same, words.first)
    order = np.lexsort((hashes, doc_of_word))
    sorted_words, sorted_docs = hashes[order], doc_of_word[order]
    fresh = np.ones(hashes.size, bool)
    fresh[1:] = (sorted_words[1:] != sorted_words[:-1]) | (sorted_docs[1:] != sorted_docs[:-1])
    distinct = np.bincount(sorted_docs[fresh], minlength=n).astype(float)
    letters = np.maximum(of["upper"] + of["lower"], 1)
    size, many = np.maximum(spans, 1), np.maximum(counts, 1)
    return np.column_stack([
        np.log1p(spans), np.log1p(counts), np.log1p(spans / many), np.log1p(counts / (of["line"] + 1)),
        np.sqrt(of["symbol"] / size), np.sqrt(of["bang"] / size), np.sqrt(of["bar"] / many),
        np.sqrt(of["digit"] / size), np.sqrt(of["stop"] / many), np.sqrt(of["upper"] / letters),
        np.sqrt(distinct / many), np.sqrt(repeated / many),
        np.log1p(of["symbol"]), np.log1p(of["bang"]), np.log1p(of["bar"]), np.log1p(repeated),
    ])


@dataclass
class QualityModel:
    """A few thousand numbers; it travels inside the function that scores."""

    mean: np.ndarray
    scale: np.ndarray
    omega: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        z = np.sqrt(2 / self.phase.size) * np.cos(x @ self.omega + self.phase)
        return np.column_stack([z, np.ones(len(z))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.values), 0, 1)


def isotonic(x: np.ndarray, total: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres and means of the blocks of a least-squares rising fit to bins in order of x."""
    blocks: list[list[float]] = []
    for centre, n, p in zip(x.tolist(), total.tolist(), positive.tolist()):
        blocks.append([centre * n, n, p])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel:
    """Fit on documents joined with (doc_id, label), label 1 for good.

    Random Fourier features stand for a Gaussian kernel over the statistics. Each
    partition sums its part of the normal equations; only these sums reach the driver.
    The parts of the sample that are not fitted calibrate the scores: counts by score
    bin, again summed, and a rising step function through them, joined by lines.
    Without a labelled document every score is 0.5.
    """
    known = labelled_sample(docs, labels, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            stats = statistics(batch.column("text"))
            flat = pa.array(stats.ravel())
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").cast(pa.float64()), batch.column("part"), pa.FixedSizeListArray.from_arrays(flat, STATISTICS).cast(pa.list_(pa.float64()))],
                ["label", "part", "stats"],
            )

    rows = known.select("text", "label", "part").mapInArrow(run, "label double, part int, stats array<double>")
    rows = materialize(rows.repartition(_FIT_PARTS, "part"), "statistics")

    def read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        stats = batch.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(-1, STATISTICS)
        return batch.column("label").to_numpy(), batch.column("part").to_numpy(), stats

    def moments(batch: pa.RecordBatch) -> list[np.ndarray]:
        _, _, x = read(batch)
        return [np.array([len(x)]), x.sum(0), (x * x).sum(0)]

    count, first, second = partition_sums(rows, moments, [(1,), (STATISTICS,), (STATISTICS,)])
    n = max(count[0], 1)
    mean = first / n
    scale = np.sqrt(np.maximum(second / n - mean**2, 0))
    scale[scale < 1e-9] = 1
    random = np.random.default_rng(SEED)
    model = QualityModel(
        mean, scale,
        random.normal(0, np.sqrt(1 / STATISTICS), (STATISTICS, FEATURES)),
        random.uniform(0, 2 * np.pi, FEATURES),
        np.zeros(FEATURES + 1), np.array([0.0]), np.array([0.5]),
    )
    if not count[0]:
        return model

    def normal(batch: pa.RecordBatch) -> list[np.ndarray]:
        label, part, x = read(batch)
        fit = part >= CALIBRATING
        z = model.features(x[fit])
        return [z.T @ z, z.T @ label[fit], np.array([fit.sum()])]

    size = FEATURES + 1
    gram, moment, fitted = partition_sums(rows, normal, [(size, size), (size,), (1,)])
    model.weights = np.linalg.solve(gram + RIDGE * max(fitted[0], 1) / size * np.eye(size), moment)

    def binned(batch: pa.RecordBatch) -> list[np.ndarray]:
        label, part, x = read(batch)
        use = part < CALIBRATING
        at = np.clip(((model.raw(x[use]) + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
        return [np.bincount(at, minlength=BINS), np.bincount(at, label[use], BINS)]

    total, positive = partition_sums(rows, binned, [(BINS,), (BINS,)])
    filled = total > 0
    if filled.any():
        centres = (np.arange(BINS) + 0.5) / BINS * 2 - 0.5
        model.knots, model.values = isotonic(centres[filled], total[filled], positive[filled])
    return model


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score, predicted) for every row; only the text is looked at.

    Null and empty texts are scored by the statistics of an empty text. Repeated rows
    score alike. Very long texts are one slice of their own. Empty table: no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            score = model.score(statistics(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double, predicted int"
    )


def keep_good(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is predicted good."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(model.score(statistics(batch.column("text"))) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
