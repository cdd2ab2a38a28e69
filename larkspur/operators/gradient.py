"""Gradient descent for linear classifiers: logistic and hinge loss.

``pyspark.ml`` solves both losses with quasi-Newton methods and offers those in
:mod:`larkspur.operators.train`. This estimator keeps the step-size semantics:
weights start at 0, step ``i`` has the size ``step / sqrt(i)``, the squared L2
penalty shrinks the weights first, there is no intercept, and the descent ends
early once the weights move by less than ``tol`` relative to their length.

Rows are packed into blocks once; sparse rows stay sparse. Each step is one pass over the
blocks, with one matrix of weights for all models that are fitted together, and one
aggregation on the executors that adds up the tasks' gradients feature by feature.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol,
    HasLabelCol,
    HasMaxIter,
    HasPredictionCol,
    HasProbabilityCol,
    HasRawPredictionCol,
    HasRegParam,
    HasSeed,
    HasStepSize,
    HasTol,
)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators.splits import _HASH_RANGE
from larkspur.sources.tables import cached

LOSSES = ("logistic", "hinge")
#: Blocks that one part of a fit's rows holds at most.
PART_BLOCKS = 128

_BLOCK = "size int, rows binary, at binary, x binary, y binary, keys array<string>"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a batch: values of all rows, their features unless all are dense, and labels."""
    for batch in batches:
        if not batch.num_rows:
            continue
        dense = batch.column("dense").to_numpy(zero_copy_only=False)
        lists = batch.column("x")
        lengths = np.asarray(lists.value_lengths(), np.int64)
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        sizes = batch.column("size").to_numpy(zero_copy_only=False)
        if (sizes != sizes[0]).any():
            raise ValueError("feature vectors differ in size")
        counts, at, x = np.where(dense, lengths, lengths // 2), b"", flat
        if not dense.all():
            # A sparse row is its values and then their features; a dense one's are all in order.
            place = np.arange(flat.size) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            first = place < np.repeat(counts, lengths)
            x = flat[first]
            features = place[first]
            features[np.repeat(~dense, counts)] = flat[~first]
            at = features.astype(np.int32).tobytes()
        y = batch.column("y").to_numpy(zero_copy_only=False)
        cells = [int(sizes[0]), counts.astype(np.int32).tobytes(), at, x.tobytes(), y.tobytes()]
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        columns = [pa.array([c], k) for c, k in zip(cells, kinds)]
        keys = batch.column("keys").to_pylist() if "keys" in batch.schema.names else []
        columns.append(pa.array([[k or "" for k in keys]], pa.list_(pa.string())))
        yield pa.RecordBatch.from_arrays(columns, ["size", "rows", "at", "x", "y", "keys"])


def pack_rows(df: DataFrame, features: str, label: str, key: str | None = None) -> DataFrame:
    """Blocks of rows for the passes of a fit. Rows without label or features are left out."""
    # One list a row: null lists, as dense vectors have them, are slow to hand over.
    inner = F.unwrap_udt(features)
    dense = inner["type"] == 1
    both = F.concat(inner["values"], inner["indices"].cast("array<double>"))
    columns = {
        "dense": dense, "size": F.when(dense, F.size(inner["values"])).otherwise(inner["size"]),
        "x": F.when(dense, inner["values"]).otherwise(both), "y": F.col(label).cast("double"),
    }
    if key is not None:
        columns["keys"] = F.col(key).cast("string")
    slim = df.where(F.col(features).isNotNull() & F.col(label).isNotNull())
    return slim.select(*[c.alias(n) for n, c in columns.items()]).mapInArrow(_pack, _BLOCK)


@dataclass
class _Block:
    """Rows of one block; ``at`` and ``row`` tell feature and row of each value if not dense."""

    y: np.ndarray
    x: np.ndarray
    at: np.ndarray | None
    row: np.ndarray | None
    keys: list[str]

    @classmethod
    def of(cls, cells: dict) -> _Block:
        y, x = np.frombuffer(cells["y"]), np.frombuffer(cells["x"])
        if not cells["at"]:
            return cls(y, x.reshape(y.size, -1), None, None, cells["keys"])
        row = np.repeat(np.arange(y.size), np.frombuffer(cells["rows"], np.int32))
        return cls(y, x, np.frombuffer(cells["at"], np.int32), row, cells["keys"])

    def margins(self, weights: np.ndarray) -> np.ndarray:
        if self.at is None:
            return self.x @ weights
        parts = self.x[:, None] * weights[self.at]
        return np.stack([np.bincount(self.row, p, self.y.size) for p in parts.T], axis=1)

    def add_gradients(self, pull: np.ndarray, total: np.ndarray) -> None:
        if self.at is None:
            total += self.x.T @ pull
            return
        for k in range(pull.shape[1]):
            total[:, k] += np.bincount(self.at, self.x * pull[self.row, k], len(total))

    def drawn(self, prefix: str) -> np.ndarray:
        """Number of each row; those below a share of the range make a mini-batch of that
        share. It follows from key, seed and step alone."""
        first = b"".join([hashlib.md5(f"{prefix}{k}".encode()).digest()[:4] for k in self.keys])
        return np.frombuffer(first, ">u4").astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield _Block.of(batch.slice(i, 1).to_pylist()[0])


@contextmanager
def _kept(blocks: DataFrame) -> Iterator[DataFrame]:
    """Blocks kept for the passes of a fit, at most ``PART_BLOCKS`` a part.

    A task may hold all blocks of its part at once, so parts of large files are dealt out
    again, each block as it is."""
    with cached(blocks) as (rows,):
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
        if max(sizes, default=0) <= PART_BLOCKS:
            yield rows
            return
        with cached(rows.repartition(-(-sum(sizes) // PART_BLOCKS) * 2)) as (dealt,):
            dealt.count()
            rows.unpersist()
            yield dealt


@dataclass
class _Descent:
    """One course of weights; combinations that only differ in the number of steps share it."""

    loss: str
    step: float
    reg: float
    fraction: float
    tol: float
    seed: int
    steps: int = 0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    done: bool = False
    kept: dict[int, np.ndarray] = field(default_factory=dict)

    def move(self, step: int, gradient: np.ndarray, n: float) -> None:
        if n:
            rate = self.step / math.sqrt(step)
            previous = self.weights
            self.weights = previous * (1 - rate * self.reg) - rate * gradient / n
            moved = np.linalg.norm(self.weights - previous)
            if step > 1 and moved < self.tol * max(np.linalg.norm(self.weights), 1.0):
                self.done = True
        self.kept[step] = self.weights
        self.done |= step >= self.steps

    def after(self, steps: int) -> np.ndarray:
        return self.kept[min(steps, max(self.kept))]


def _gradients(weights, losses: Sequence[str], draws: Sequence[tuple[str, float]]):
    """(feature, one sum a model): a task's gradients, and its row counts as feature -1."""
    names = ["feature", *[f"g{k}" for k in range(len(losses))]]
    hinge = np.array([loss == "hinge" for loss in losses])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        total, n = np.zeros(w.shape), np.zeros(w.shape[1])
        for block in _blocks(batches):
            margin, y = block.margins(w), block.y[:, None]
            with np.errstate(over="ignore"):
                pull = 1 / (1 + np.exp(-margin)) - y
            if hinge.any():
                side = 2 * y - 1
                pull = np.where(hinge, np.where(side * margin < 1, -side, 0.0), pull)
            numbers: dict[str, np.ndarray] = {}
            for k, (prefix, fraction) in enumerate(draws):
                if fraction < 1.0:
                    if prefix not in numbers:
                        numbers[prefix] = block.drawn(prefix)
                    taken = numbers[prefix] < int(fraction * _HASH_RANGE)
                    pull[~taken, k] = 0.0
                    n[k] += taken.sum()
                else:
                    n[k] += y.size
            block.add_gradients(pull, total)
        at = np.flatnonzero(total.any(axis=1))
        sums = np.vstack([n, total[at]])
        columns = [pa.array(np.append(-1, at).astype(np.int32)), *[pa.array(np.ascontiguousarray(c)) for c in sums.T]]
        yield pa.RecordBatch.from_arrays(columns, names)

    return run


def descend(blocks: DataFrame, courses: Sequence[_Descent]) -> None:
    """Take all courses their steps, one pass over ``blocks`` a step."""
    spark = blocks.sparkSession
    size = blocks.agg(F.max("size")).first()[0]
    if size is None:
        raise ValueError("nothing to fit on")
    for course in courses:
        course.weights = np.zeros(size)
        course.kept[0] = course.weights
        course.done = course.steps < 1
    step = 0
    while on := [c for c in courses if not c.done]:
        step += 1
        weights = spark.sparkContext.broadcast(np.stack([c.weights for c in on], axis=1))
        run = _gradients(weights, [c.loss for c in on], [(f"{c.seed}:{step}:", c.fraction) for c in on])
        names = [f"g{k}" for k in range(len(on))]
        parts = blocks.mapInArrow(run, "feature int, " + ", ".join(f"{g} double" for g in names))
        sums = parts.groupBy("feature").agg(*[F.sum(g).alias(g) for g in names]).toArrow()
        weights.destroy()
        feature = sums.column("feature").to_numpy()
        table = np.stack([sums.column(g).to_numpy() for g in names], axis=1)
        gradient = np.zeros((size, len(on)))
        gradient[feature[feature >= 0]] = table[feature >= 0]
        rows = table[feature < 0][0]
        for k, course in enumerate(on):
            course.move(step, gradient[:, k], rows[k])


class _LinearParams(
    HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRawPredictionCol, HasProbabilityCol
):
    loss = Param(
        Params._dummy(), "loss", "logistic or hinge", typeConverter=TypeConverters.toString
    )

    def getLoss(self) -> str:
        return self.getOrDefault(self.loss)


class GradientDescentModel(Model, _LinearParams, DefaultParamsReadable, DefaultParamsWritable):
    """Linear scorer; the margin's sign is the class."""

    coefficients = Param(
        Params._dummy(),
        "coefficients",
        "weight per feature",
        typeConverter=TypeConverters.toListFloat,
    )

    def __init__(self) -> None:
        super().__init__()

    @property
    def weights(self) -> list[float]:
        return self.getOrDefault(self.coefficients)

    def weight_table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, float(w)) for i, w in enumerate(self.weights)]
        return spark.createDataFrame(rows, "feature int, weight double")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        # The weights go along as one vector; of a sparse row only what it holds is multiplied.
        product = ElementwiseProduct(
            scalingVec=Vectors.dense(self.weights), inputCol=self.getFeaturesCol(), outputCol="_product"
        )
        values = F.unwrap_udt("_product")["values"]
        total = F.aggregate(values, F.lit(0.0), lambda total, x: total + x)
        scored = product.transform(dataset).withColumn("_margin", total)
        margin = F.col("_margin")
        added = {self.getRawPredictionCol(): array_to_vector(F.array(-margin, margin))}
        if self.getLoss() == "logistic":
            chance = 1 / (1 + F.exp(-margin))
            added[self.getProbabilityCol()] = array_to_vector(F.array(1 - chance, chance))
        added[self.getPredictionCol()] = (margin > 0).cast("double")
        return scored.withColumns(added).drop("_margin", "_product")


class GradientDescentClassifier(
    Estimator,
    _LinearParams,
    HasMaxIter,
    HasStepSize,
    HasRegParam,
    HasTol,
    HasSeed,
    DefaultParamsReadable,
    DefaultParamsWritable,
):
    """Labels are 0/1. ``keyCol`` identifies rows; it is needed for mini-batches only."""

    miniBatchFraction = Param(
        Params._dummy(),
        "miniBatchFraction",
        "share of the rows each step looks at",
        typeConverter=TypeConverters.toFloat,
    )
    keyCol = Param(
        Params._dummy(), "keyCol", "row key mini-batches are drawn by",
        typeConverter=TypeConverters.toString,
    )

    @keyword_only
    def __init__(
        self,
        *,
        featuresCol: str = "features",
        labelCol: str = "label",
        loss: str = "logistic",
        maxIter: int = 100,
        stepSize: float = 1.0,
        regParam: float = 0.01,
        miniBatchFraction: float = 1.0,
        tol: float = 0.001,
        keyCol: str | None = None,
        seed: int | None = None,
    ) -> None:
        super().__init__()
        self._setDefault(
            loss="logistic", maxIter=100, stepSize=1.0, regParam=0.01,
            miniBatchFraction=1.0, tol=0.001, seed=0,
        )
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _course(self) -> _Descent:
        loss, fraction = self.getLoss(), self.getOrDefault(self.miniBatchFraction)
        if loss not in LOSSES:
            raise ValueError(f"loss must be one of {LOSSES}, not {loss!r}")
        if fraction < 1.0 and not self.isDefined(self.keyCol):
            raise ValueError("mini-batches need keyCol")
        return _Descent(loss, self.getStepSize(), self.getRegParam(), fraction, self.getTol(), self.getSeed())

    def _columns(self) -> tuple[str, str, str | None]:
        key = self.getOrDefault(self.keyCol) if self.isDefined(self.keyCol) else None
        return self.getFeaturesCol(), self.getLabelCol(), key

    def _fit_all(self, dataset: DataFrame, settings: Sequence[GradientDescentClassifier]) -> list[GradientDescentModel]:
        """Fit several settings that read the same columns, in the passes of the longest."""
        courses: dict[tuple, _Descent] = {}
        own = []
        for one in settings:
            course = one._course()
            course = courses.setdefault(
                (course.loss, course.step, course.reg, course.fraction, course.tol, course.seed), course
            )
            course.steps = max(course.steps, one.getMaxIter())
            own.append(course)
        with _kept(pack_rows(dataset, *self._columns())) as blocks:
            descend(blocks, list(courses.values()))
        models = []
        for one, course in zip(settings, own):
            model = GradientDescentModel()
            one._copyValues(model)
            models.append(model._set(coefficients=course.after(one.getMaxIter()).tolist(), loss=course.loss))
        return models

    def _fit(self, dataset: DataFrame) -> GradientDescentModel:
        return self._fit_all(dataset, [self])[0]

    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence[dict]):
        """All combinations in one pass a step, unless they read different columns."""
        settings = [self.copy(m) for m in paramMaps]
        if any(s._columns() != self._columns() for s in settings):
            return super().fitMultiple(dataset, paramMaps)
        return iter(enumerate(self._fit_all(dataset, settings)))


def hard_aucs(models: Sequence[GradientDescentModel], df: DataFrame, label: str = "label") -> list[float]:
    """ROC area of the 0/1 predictions of several models, in one pass; NaN without both classes."""
    weights = df.sparkSession.sparkContext.broadcast(np.array([m.weights for m in models]).T)
    names = ["ones", "zeros", *[f"{side}{k}" for side in "rw" for k in range(len(models))]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(names))
        for block in _blocks(batches):
            above, one = block.margins(weights.value) > 0, block.y == 1
            zero = block.y == 0
            sums += np.concatenate([[one.sum(), zero.sum()], above[one].sum(axis=0), (~above[zero]).sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in sums], names)

    blocks = pack_rows(df, models[0].getFeaturesCol(), label)
    sums = blocks.mapInArrow(run, ", ".join(f"{c} double" for c in names)).groupBy().sum().first()
    ones, zeros, *hits = [x or 0.0 for x in sums]
    n = len(models)
    return [(hits[k] / ones + hits[n + k] / zeros) / 2 if ones and zeros else math.nan for k in range(n)]


def fit_gd(
    df: DataFrame,
    loss: str = "logistic",
    iterations: int = 100,
    step: float = 1.0,
    fraction: float = 1.0,
    reg: float = 0.01,
    tol: float = 0.001,
    features: str = "features",
    label: str = "label",
    key: str | None = None,
    seed: int = 0,
) -> GradientDescentModel:
    """Fit a linear classifier by gradient descent."""
    return GradientDescentClassifier(
        featuresCol=features, labelCol=label, loss=loss, maxIter=iterations, stepSize=step,
        regParam=reg, miniBatchFraction=fraction, tol=tol, keyCol=key, seed=seed,
    ).fit(df)
