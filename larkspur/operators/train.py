"""Supervised models. ``fit_*`` returns a fitted ``pyspark.ml`` model; the
estimator builders beside them serve pipelines and tuning."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    LinearSVC,
    LinearSVCModel,
    LogisticRegression,
    LogisticRegressionModel,
    NaiveBayes,
    NaiveBayesModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    DecisionTreeRegressor,
    GBTRegressionModel,
    GBTRegressor,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators.splits import key_hash
from larkspur.sources.tables import cached


def tree_classifier(
    impurity: str = "gini",
    depth: int = 5,
    bins: int = 32,
    features: str = "features",
    label: str = "label",
) -> DecisionTreeClassifier:
    """Two or more classes, labels 0..C-1. Depth is at most 30."""
    return DecisionTreeClassifier(
        impurity=impurity, maxDepth=depth, maxBins=bins, featuresCol=features, labelCol=label, seed=0
    )


def tree_regressor(
    depth: int = 5, bins: int = 32, features: str = "features", label: str = "label"
) -> DecisionTreeRegressor:
    """Variance-reducing tree. Bins must cover the largest categorical feature."""
    return DecisionTreeRegressor(
        impurity="variance", maxDepth=depth, maxBins=bins, featuresCol=features, labelCol=label, seed=0
    )


def forest_classifier(
    trees: int = 10,
    impurity: str = "gini",
    depth: int = 5,
    bins: int = 32,
    features: str = "features",
    label: str = "label",
    seed: int = 0,
) -> RandomForestClassifier:
    return RandomForestClassifier(
        numTrees=trees, impurity=impurity, maxDepth=depth, maxBins=bins,
        featuresCol=features, labelCol=label, seed=seed,
    )


def gbt_regressor(
    depth: int = 5,
    bins: int = 32,
    iterations: int = 20,
    features: str = "features",
    label: str = "label",
    seed: int = 0,
) -> GBTRegressor:
    return GBTRegressor(
        maxDepth=depth, maxBins=bins, maxIter=iterations,
        featuresCol=features, labelCol=label, seed=seed,
    )


def naive_bayes(
    smoothing: float = 1.0, features: str = "features", label: str = "label"
) -> NaiveBayes:
    """Multinomial, additive smoothing; features must not be negative."""
    return NaiveBayes(
        smoothing=smoothing, modelType="multinomial", featuresCol=features, labelCol=label
    )


class _HashForestParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed):
    numTrees = Param(Params._dummy(), "numTrees", "number of trees", typeConverter=TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of each tree", typeConverter=TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", typeConverter=TypeConverters.toInt)
    impurity = Param(Params._dummy(), "impurity", "gini or entropy", typeConverter=TypeConverters.toString)
    keyCol = Param(
        Params._dummy(), "keyCol", "row key that samples are drawn by", typeConverter=TypeConverters.toString
    )


class HashForestModel(Model, _HashForestParams):
    """Class shares averaged over the trees; the largest one is the prediction."""

    def __init__(self, trees: Sequence[DecisionTreeClassificationModel]) -> None:
        super().__init__()
        self.trees = list(trees)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scored, shares = dataset, []
        for i, tree in enumerate(self.trees):
            one = tree.copy().setProbabilityCol(f"_p{i}").setRawPredictionCol("").setPredictionCol("")
            scored = one.transform(scored)
            shares.append(vector_to_array(f"_p{i}"))
        total = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), shares)
        mean = F.transform(total, lambda x: x / len(shares))
        scored = scored.withColumn("_mean", mean)
        added = {
            self.getProbabilityCol(): array_to_vector("_mean"),
            self.getPredictionCol(): (F.array_position("_mean", F.array_max("_mean")) - 1).cast("double"),
        }
        return scored.withColumns(added).drop("_mean", *[f"_p{i}" for i in range(len(shares))])


class HashForestClassifier(Estimator, _HashForestParams):
    """Bagged trees whose samples follow from the rows' keys.

    How often a row counts in a tree's bootstrap sample is a Poisson number with mean 1,
    read off a hash of (seed, tree, key). It goes into the fit as the row's weight, so
    nothing is drawn by partition, and the same rows give the same samples on any layout
    and any number of cores. Every split looks at all features. Rows with one key count
    alike.
    """

    @keyword_only
    def __init__(
        self, *, keyCol: str, numTrees: int = 10, maxDepth: int = 5, maxBins: int = 32, impurity: str = "gini",
        featuresCol: str = "features", labelCol: str = "label", seed: int = 0,
        parallelism: int = 4, partitions: int | None = None,
    ) -> None:
        super().__init__()
        self.parallelism, self.partitions = parallelism, partitions
        given = dict(self._input_kwargs)
        self._set(**{k: v for k, v in given.items() if k not in ("parallelism", "partitions")})
        self._setDefault(numTrees=10, maxDepth=5, maxBins=32, impurity="gini", seed=0)

    def weights(self) -> Column:
        """How often a row counts in each tree's sample: Poisson numbers with mean 1."""
        edges = F.lit(poisson_edges())
        drawn = [key_hash(self.getOrDefault(self.keyCol), f"{self.getSeed()}:{t}:") for t in range(self.getOrDefault(self.numTrees))]
        return F.transform(F.array(*drawn), lambda at: F.size(F.filter(edges, lambda e: e <= at)).cast("double"))

    def _fit(self, dataset: DataFrame) -> HashForestModel:
        stage = DecisionTreeClassifier(
            impurity=self.getOrDefault(self.impurity), maxDepth=self.getOrDefault(self.maxDepth),
            maxBins=self.getOrDefault(self.maxBins), featuresCol=self.getFeaturesCol(),
            labelCol=self.getLabelCol(), weightCol="_weight", seed=0,
        )
        # Equal rows are one to a tree, with the sum of their weights.
        columns, numbers = [self.getFeaturesCol(), self.getLabelCol()], range(self.getOrDefault(self.numTrees))
        drawn = dataset.select(*columns, self.weights().alias("_weights"))
        few = drawn.groupBy(*columns).agg(*[F.sum(F.col("_weights")[t]).alias(f"_weight{t}") for t in numbers])
        with cached(few) as (few,), cached(few, partitions=self.partitions) as (rows,), ThreadPool(self.parallelism) as pool:

            def grow(tree: int) -> DecisionTreeClassificationModel:
                return stage.fit(rows.withColumn("_weight", F.col(f"_weight{tree}")).where("_weight > 0"))

            trees = pool.map(grow, numbers)
        return self._copyValues(HashForestModel(trees))


def poisson_edges(top: int = 1 << 32) -> list[int]:
    """Where a uniform number below ``top`` passes on to the next Poisson count, mean 1."""
    edges, chance, reached = [], math.exp(-1), 0.0
    while (reached := reached + chance) < 1 and int(reached * top) < top - 1:
        edges.append(int(reached * top))
        chance /= len(edges)
    return edges


def takes_counts(estimator: Estimator) -> bool:
    """Whether a row with a weight of n counts for the fit like n equal rows.

    True of trees, of boosted trees that look at all rows in each round, and of
    multinomial naive Bayes, if they are given no weights already. Spark's forest draws rows.
    """
    if isinstance(estimator, GBTRegressor):
        fits = estimator.getSubsamplingRate() == 1.0 and not estimator.isDefined(estimator.validationIndicatorCol)
    elif isinstance(estimator, NaiveBayes):
        fits = estimator.getModelType() == "multinomial"
    else:
        fits = isinstance(estimator, (DecisionTreeClassifier, DecisionTreeRegressor))
    return fits and not estimator.isDefined(estimator.weightCol)


def counted(df: DataFrame, *columns: str, name: str = "_weight") -> DataFrame:
    """Equal rows once, with their number as a weight. They are added up before they are
    shuffled; where no two rows are equal, all rows remain."""
    return df.groupBy(*columns).agg(F.count("*").cast("double").alias(name))


def with_weight(stage: Params, name: str = "_weight") -> Params:
    return stage.copy({stage.getParam("weightCol"): name})


def _fit(estimator: Estimator, df: DataFrame, partitions: int | None = None) -> Model:
    """Fit on the two columns needed, kept for the several passes these fits make.

    Naive Bayes makes a single pass and goes without. ``partitions`` lays the rows out,
    which frames of a few files or row groups need to occupy many cores. Trees read equal
    rows once, weighted.
    """
    columns = [estimator.getFeaturesCol(), estimator.getLabelCol()]
    if not takes_counts(estimator):
        with cached(df.select(*columns), partitions=partitions) as (rows,):
            return estimator.fit(rows)
    with cached(counted(df, *columns)) as (few,), cached(few, partitions=partitions) as (rows,):
        return with_weight(estimator).fit(rows)


def fit_tree(df: DataFrame, partitions: int | None = None, **options) -> DecisionTreeClassificationModel:
    return _fit(tree_classifier(**options), df, partitions)


def fit_tree_regressor(df: DataFrame, partitions: int | None = None, **options) -> DecisionTreeRegressionModel:
    return _fit(tree_regressor(**options), df, partitions)


def fit_forest(df: DataFrame, partitions: int | None = None, **options) -> RandomForestClassificationModel:
    """Spark's forest: samples are drawn by partition, so the layout counts."""
    return _fit(forest_classifier(**options), df, partitions)


def fit_hash_forest(
    df: DataFrame, key: str, trees: int = 10, impurity: str = "gini", depth: int = 5, bins: int = 32,
    features: str = "features", label: str = "label", seed: int = 0, partitions: int | None = None,
) -> HashForestModel:
    """Forest whose samples follow from the rows' keys: the same on any layout."""
    return HashForestClassifier(
        keyCol=key, numTrees=trees, impurity=impurity, maxDepth=depth, maxBins=bins,
        featuresCol=features, labelCol=label, seed=seed, partitions=partitions,
    ).fit(df)


def fit_gbt(df: DataFrame, partitions: int | None = None, **options) -> GBTRegressionModel:
    return _fit(gbt_regressor(**options), df, partitions)


def fit_naive_bayes(df: DataFrame, **options) -> NaiveBayesModel:
    return naive_bayes(**options).fit(df)


def fit_logistic(
    df: DataFrame, reg: float = 0.0, iterations: int = 100,
    features: str = "features", label: str = "label",
) -> LogisticRegressionModel:
    """Logistic regression solved to convergence; the default choice for new work."""
    estimator = LogisticRegression(
        regParam=reg, maxIter=iterations, featuresCol=features, labelCol=label
    )
    return _fit(estimator, df)


def fit_linear_svm(
    df: DataFrame, reg: float = 0.0, iterations: int = 100,
    features: str = "features", label: str = "label",
) -> LinearSVCModel:
    """Linear support vector machine solved to convergence."""
    estimator = LinearSVC(
        regParam=reg, maxIter=iterations, featuresCol=features, labelCol=label
    )
    return _fit(estimator, df)
