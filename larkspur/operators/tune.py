"""Parameter search.

Fits run on the cluster, several at a time if asked to. The driver holds one
metric per combination.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.param import Params
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators import train
from larkspur.operators.evaluate import HardAucEvaluator
from larkspur.operators.gradient import GradientDescentClassifier, hard_aucs
from larkspur.operators.splits import split_random
from larkspur.sources.tables import cached, spread

# Parameter values searched by default. Fixed values, one entry per kind of model.
GRIDS: dict[str, dict[str, list]] = {
    "tree": {
        "impurity": ["gini", "entropy"],
        "maxDepth": [3, 5, 10, 15, 20, 25],
        "maxBins": [3, 5, 10, 50, 100, 200],
    },
    "logistic": {
        "maxIter": [3, 5, 10, 15],
        "stepSize": [10.0, 50.0, 100.0],
        "miniBatchFraction": [0.5, 0.8, 1.0],
    },
    "svm": {
        "maxIter": [1, 3, 5, 15, 25],
        "stepSize": [10.0, 50.0, 100.0],
        "regParam": [0.01, 0.1, 1.0],
    },
    "naive_bayes": {"smoothing": [1.0, 3.0, 5.0, 15.0, 25.0, 30.0, 40.0, 45.0, 60.0]},
    "regression_tree": {
        "impurity": ["variance"],
        "maxDepth": [3, 5, 10, 15, 20, 25],
        "maxBins": [3, 5, 10, 50, 100, 200],
    },
    "pipeline_tree": {
        "impurity": ["gini", "entropy"],
        "maxDepth": [5, 10, 15],
        "maxBins": [10, 15, 20],
    },
    "forest": {
        "impurity": ["gini", "entropy"],
        "maxDepth": [5, 10, 15],
        "maxBins": [10, 15, 20],
        "numTrees": [10, 20, 30],
    },
    "gbt": {"maxDepth": [5, 10], "maxBins": [25, 40], "maxIter": [10, 50]},
}

# One-parameter sweeps: the parameter's values, and what the others are held at.
# Fixed values.
SWEEPS: dict[tuple[str, str], tuple[list, dict]] = {
    ("tree", "maxDepth"): ([3, 5, 10, 15, 20], {"impurity": "gini", "maxBins": 10}),
    ("tree", "maxBins"): ([3, 5, 10, 50, 100, 200], {"impurity": "gini", "maxDepth": 10}),
    ("tree", "impurity"): (["gini", "entropy"], {"maxDepth": 10, "maxBins": 10}),
    ("regression_tree", "maxDepth"): ([3, 5, 10, 15, 20, 25], {"maxBins": 10}),
    ("regression_tree", "maxBins"): ([3, 5, 10, 50, 100], {"maxDepth": 10}),
    ("logistic", "maxIter"): ([5, 10, 15, 20, 60, 100], {"stepSize": 10.0}),
    ("logistic", "stepSize"): ([10.0, 50.0, 100.0, 200.0], {"maxIter": 50}),
    ("logistic", "miniBatchFraction"): ([0.5, 0.8, 1.0], {"maxIter": 50, "stepSize": 500.0}),
    ("svm", "maxIter"): ([5, 10, 15, 20, 60, 100], {"stepSize": 10.0, "regParam": 1.0}),
    ("svm", "stepSize"): ([10.0, 50.0, 100.0, 200.0], {"maxIter": 50, "regParam": 1.0}),
    ("svm", "regParam"): ([0.01, 0.1, 1.0], {"maxIter": 50, "stepSize": 500.0}),
    ("naive_bayes", "smoothing"): (GRIDS["naive_bayes"]["smoothing"], {}),
}


#: Builder of each kind of model that grids and sweeps are named for.
BUILDERS: dict[str, Callable[..., Estimator]] = {
    "tree": train.tree_classifier,
    "regression_tree": train.tree_regressor,
    "pipeline_tree": train.tree_classifier,
    "forest": train.forest_classifier,
    "gbt": train.gbt_regressor,
    "naive_bayes": train.naive_bayes,
    "logistic": lambda **options: GradientDescentClassifier(loss="logistic", tol=0.0, **options),
    "svm": lambda **options: GradientDescentClassifier(loss="hinge", tol=0.0, **options),
}


@dataclass(frozen=True)
class Tuned:
    model: Model
    params: dict[str, Any]
    metric: float
    table: DataFrame
    """One row per combination, in grid order: ``trial``, its parameters, ``metric``."""
    test_metric: float | None = None
    """The chosen model's metric on rows that took no part in fits and choice."""


def param_grid(
    stage: Params,
    values: Mapping[str, Sequence],
    keep: Callable[[dict[str, Any]], bool] | None = None,
) -> list[dict]:
    """All combinations as param maps for ``stage``, the last name varying fastest.

    ``keep`` drops combinations that cannot be fitted, such as fewer bins than a
    categorical feature has levels.
    """
    unknown = [name for name in values if not stage.hasParam(name)]
    if unknown:
        raise ValueError(f"{type(stage).__name__} has no parameter {', '.join(unknown)}")
    combinations = (dict(zip(values, choice)) for choice in product(*values.values()))
    return [
        {stage.getParam(name): value for name, value in combination.items()}
        for combination in combinations
        if keep is None or keep(combination)
    ]


def _table(spark: SparkSession, grid: Sequence[dict], metrics: Sequence[float]) -> DataFrame:
    names = [param.name for param in grid[0]]
    rows = [
        (i, *[params[p] for p in params], float(m))
        for i, (params, m) in enumerate(zip(grid, metrics, strict=True))
    ]
    return spark.createDataFrame(rows, ["trial", *names, "metric"])


def _at_once(estimator: Estimator, evaluator: Evaluator) -> bool:
    """Whether all models come from one fit and are measured in one pass."""
    return isinstance(estimator, GradientDescentClassifier) and isinstance(evaluator, HardAucEvaluator)


def _trials(
    estimator: Estimator, grid: Sequence[dict], rows: DataFrame, valid: DataFrame, evaluator: Evaluator, parallelism: int
) -> tuple[list[float], int, Model]:
    """Metric of every combination, and the best one's index and model."""
    sign = 1 if evaluator.isLargerBetter() else -1
    metrics: dict[int, float] = {}
    best: tuple[int, Model] | None = None

    def note(index: int, model: Model, metric: float) -> None:
        nonlocal best
        metrics[index] = metric
        # Only the best model so far is kept; one without a metric is none.
        if not math.isnan(metric) and (
            best is None or (sign * metric, -index) > (sign * metrics[best[0]], -best[0])
        ):
            best = (index, model)

    fits = estimator.fitMultiple(rows, list(grid))
    if _at_once(estimator, evaluator):
        # All models are there at once and are measured in one pass.
        models = [model for _, model in sorted(fits, key=lambda pair: pair[0])]
        for index, metric in enumerate(hard_aucs(models, valid, evaluator.label)):
            note(index, models[index], metric)
    else:

        def trial(_: int) -> tuple[int, Model, float]:
            index, model = next(fits)
            return index, model, evaluator.evaluate(model.transform(valid))

        with ThreadPool(parallelism) as pool:
            for found in pool.imap_unordered(trial, range(len(grid))):
                note(*found)
    if best is None:
        raise ValueError("no combination has a metric")
    return [metrics[i] for i in range(len(grid))], *best


def tune_grid(
    estimator: Estimator,
    grid: Sequence[dict],
    train: DataFrame,
    valid: DataFrame,
    evaluator: Evaluator,
    parallelism: int = 1,
    test: DataFrame | None = None,
    partitions: int | None = None,
) -> Tuned:
    """Fit every combination on ``train``, measure on ``valid``, keep the best.

    Whether larger is better follows from the evaluator. The first of equally
    good combinations wins. Where ``test`` is given, the winner alone is measured
    on it. Linear models by gradient descent are fitted together, one pass a step.
    """
    if not grid:
        raise ValueError("no combinations to try")
    if _at_once(estimator, evaluator):
        # Both sides are read once: the fit keeps its rows itself.
        sides = [spread(rows, partitions) for rows in (train, valid)]
        metrics, index, model = _trials(estimator, grid, *sides, evaluator, parallelism)
    else:
        with cached(train, valid, partitions=partitions) as sides:
            metrics, index, model = _trials(estimator, grid, *sides, evaluator, parallelism)
    return Tuned(
        model=model,
        params={param.name: value for param, value in grid[index].items()},
        metric=metrics[index],
        table=_table(train.sparkSession, grid, metrics),
        test_metric=None if test is None else evaluator.evaluate(model.transform(test)),
    )


def tune_sweep(
    estimator: Estimator,
    stage: Params,
    param: str,
    values: Sequence,
    train: DataFrame,
    valid: DataFrame,
    evaluator: Evaluator,
    parallelism: int = 1,
    partitions: int | None = None,
) -> Tuned:
    """Vary one parameter, hold the others at what ``stage`` is set to."""
    grid = param_grid(stage, {param: values})
    return tune_grid(estimator, grid, train, valid, evaluator, parallelism, partitions=partitions)


def named_sweep(
    kind: str,
    param: str,
    train: DataFrame,
    valid: DataFrame,
    evaluator: Evaluator,
    parallelism: int = 1,
    partitions: int | None = None,
    **options,
) -> Tuned:
    """One of ``SWEEPS``: its values, with the other parameters held as it says.

    ``options`` are passed to the kind's builder, such as the key mini-batches are drawn by.
    """
    if (kind, param) not in SWEEPS:
        raise ValueError(f"there is no sweep of {param} for {kind}")
    values, held = SWEEPS[kind, param]
    stage = BUILDERS[kind](**options)
    stage = stage.copy({stage.getParam(name): value for name, value in held.items()})
    return tune_sweep(stage, stage, param, values, train, valid, evaluator, parallelism, partitions)


#: Evaluators to which a row with a weight of n counts like n equal rows.
_WEIGHTED = (MulticlassClassificationEvaluator, RegressionEvaluator)


@contextmanager
def _laid_out(
    rows: DataFrame, estimator: Estimator, evaluator: Evaluator, side: str, partitions: int | None
) -> Iterator[tuple[DataFrame, Estimator, Evaluator]]:
    """The rows of a search, kept, and what to fit and measure them with.

    Where fit and measure take weights, equal rows of a side are one row with their number
    as its weight, so that the passes of all combinations read each different row once.
    """
    if train.takes_counts(estimator) and isinstance(evaluator, _WEIGHTED) and not evaluator.isDefined(evaluator.weightCol):
        columns = dict.fromkeys([estimator.getFeaturesCol(), estimator.getLabelCol(), evaluator.getLabelCol(), side])
        with cached(train.counted(rows, *columns)) as (few,), cached(few, partitions=partitions) as (kept,):
            yield kept, train.with_weight(estimator), train.with_weight(evaluator)
    else:
        with cached(rows, partitions=partitions) as (kept,):
            yield kept, estimator, evaluator


class KeySplitSearch(Estimator):
    """Search with a single split, as an estimator to be fitted or put in a pipeline.

    A row's side follows from the hash of its key, so the search gives the same on any
    layout. Rows are kept once; both sides are filters of them. The best combination is
    fitted again on all rows.
    """

    def __init__(
        self, estimator: Estimator, grid: Sequence[dict], evaluator: Evaluator, key: str,
        ratio: float = 0.8, seed: int | None = None, parallelism: int = 1, partitions: int | None = None,
    ) -> None:
        super().__init__()
        self.estimator, self.grid, self.evaluator, self.key = estimator, list(grid), evaluator, key
        self.ratio, self.seed, self.parallelism, self.partitions = ratio, seed, parallelism, partitions

    def _fit(self, dataset: DataFrame) -> KeySplitSearchModel:
        sides = {"train": self.ratio, "valid": 1 - self.ratio}
        labelled = split_random(dataset, self.key, sides, self.seed, "_side")
        with _laid_out(labelled, self.estimator, self.evaluator, "_side", self.partitions) as (rows, estimator, evaluator):
            parts = [rows.where(F.col("_side") == side).drop("_side") for side in sides]
            metrics, index, _ = _trials(estimator, self.grid, *parts, evaluator, self.parallelism)
            best = estimator.fit(rows.drop("_side"), self.grid[index])
        return KeySplitSearchModel(best, metrics, index)


class KeySplitSearchModel(Model):
    def __init__(self, bestModel: Model, validationMetrics: Sequence[float], bestIndex: int) -> None:
        super().__init__()
        self.bestModel, self.validationMetrics, self.bestIndex = bestModel, list(validationMetrics), bestIndex

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.bestModel.transform(dataset)


def tune_split(
    estimator: Estimator,
    grid: Sequence[dict],
    evaluator: Evaluator,
    key: str,
    ratio: float = 0.8,
    seed: int | None = None,
    parallelism: int = 1,
    partitions: int | None = None,
) -> KeySplitSearch:
    """Search with a single split by key hash."""
    return KeySplitSearch(estimator, grid, evaluator, key, ratio, seed, parallelism, partitions)


def tune_folds(
    estimator: Estimator,
    grid: Sequence[dict],
    evaluator: Evaluator,
    folds: int = 3,
    fold_col: str = "",
    seed: int = 0,
    parallelism: int = 1,
) -> CrossValidator:
    """Search with cross-validation. ``fold_col`` names an integer column with the
    fold of each row, which makes the folds reproducible."""
    return CrossValidator(
        estimator=estimator, estimatorParamMaps=list(grid), evaluator=evaluator,
        numFolds=folds, foldCol=fold_col, seed=seed, parallelism=parallelism,
    )


def run_search(search: Estimator, rows: DataFrame, partitions: int | None = None) -> Model:
    """Fit a search. Cross-validation keeps its folds itself; its rows are laid out only,
    or, with a column of folds, read once for all equal rows of a fold where that fits."""
    fold = search.getFoldCol() if isinstance(search, CrossValidator) else ""
    estimator, evaluator = (search.getEstimator(), search.getEvaluator()) if fold else (None, None)
    if not fold or not train.takes_counts(estimator) or not isinstance(evaluator, _WEIGHTED):
        return search.fit(spread(rows, partitions))
    with _laid_out(rows, estimator, evaluator, fold, partitions) as (kept, weighted, measure):
        return search.copy().setEstimator(weighted).setEvaluator(measure).fit(kept)


def validation_table(spark: SparkSession, searched: Model, grid: Sequence[dict]) -> DataFrame:
    """Metric per combination of a fitted split or cross-validation search."""
    metrics = getattr(searched, "validationMetrics", None) or searched.avgMetrics
    return _table(spark, grid, metrics)
