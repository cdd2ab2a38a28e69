"""Feature stages. Each ``fit``-like function learns from the frame it is given
and returns the fitted stage, so that train and later data share it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import (
    OneHotEncoder,
    OneHotEncoderModel,
    StandardScaler,
    StandardScalerModel,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
    VectorIndexer,
    VectorIndexerModel,
)
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators.ordering import with_position
from larkspur.session import scratch_path

#: The most frequent categories, which a join looks up without moving their rows.
HOT_CATEGORIES = 1_000


class _IndexParams(HasInputCol, HasOutputCol):
    tablePath = Param(
        Params._dummy(), "tablePath", "folder the table of categories is written to",
        typeConverter=TypeConverters.toString,
    )


class FrequencyIndexModel(Model, _IndexParams, DefaultParamsReadable, DefaultParamsWritable):
    """Numbers of categories, kept as a table."""

    size = Param(Params._dummy(), "size", "number of categories", typeConverter=TypeConverters.toInt)

    def __init__(self) -> None:
        super().__init__()

    def index(self, spark: SparkSession) -> DataFrame:
        """(category, index, n), one row a category."""
        schema = "category string, index bigint, n bigint"
        return spark.read.schema(schema).parquet(self.getOrDefault(self.tablePath))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """``dataset`` with the number of each category; unseen and null ones get one of
        their own after the last.

        Rows of the most frequent categories are numbered in place, from a table of bounded
        size. Only the others meet the whole index; none of those owns many rows.
        """
        table = self.index(dataset.sparkSession).select("category", "index")
        names, value = dataset.columns, F.col("row").getField(self.getInputCol()).cast("string")
        rows = dataset.select(F.struct("*").alias("row")).withColumn("category", value)
        first = F.broadcast(table.where(F.col("index") < HOT_CATEGORIES).withColumnRenamed("index", "hot"))
        looked = rows.join(first, "category", "left")
        known = F.col("hot").isNotNull() | F.col("category").isNull()
        rest = table.where(F.col("index") >= HOT_CATEGORIES)
        done = looked.where(known).withColumnRenamed("hot", "index")
        more = looked.where(~known).drop("hot").join(rest, "category", "left")
        number = F.coalesce(F.col("index"), F.lit(self.getOrDefault(self.size))).cast("double")
        both = done.select("row", "index").unionByName(more.select("row", "index"))
        own = [F.col("row").getField(c).alias(c) for c in names if c != self.getOutputCol()]
        return both.select(*own, number.alias(self.getOutputCol()))


class FrequencyIndexer(Estimator, _IndexParams, DefaultParamsReadable, DefaultParamsWritable):
    """Number categories by falling frequency, ties by text, however many there are.

    Categories are counted and ordered on the cluster, by position in a range sort, and the
    index stays a table; the driver only learns how many there are. Null is no category.
    The table is written to ``tablePath`` or, by default, to the scratch folder, whose
    owner lets it expire: name a folder for a model that is to be kept.
    """

    @keyword_only
    def __init__(self, *, inputCol: str, outputCol: str, tablePath: str | None = None) -> None:
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> FrequencyIndexModel:
        spark = dataset.sparkSession
        category = F.col(self.getInputCol()).cast("string").alias("category")
        counts = dataset.select(category).where("category is not null").groupBy("category").agg(F.count("*").alias("n"))
        placed = with_position(counts, [F.desc("n"), F.col("category")], "index")
        path = self.getOrDefault(self.tablePath) if self.isDefined(self.tablePath) else scratch_path(spark, "categories")
        placed.select("category", "index", "n").write.parquet(path)
        model = self._copyValues(FrequencyIndexModel())
        return model._set(tablePath=path, size=model._set(tablePath=path).index(spark).count())


def frequency_indexer(column: str, output: str | None = None, path: str | None = None) -> FrequencyIndexer:
    """Most frequent category gets 0, ties by text; unseen categories one extra index."""
    return FrequencyIndexer(inputCol=column, outputCol=output or f"{column}_index", tablePath=path)


def string_indexer(column: str, output: str | None = None) -> StringIndexer:
    """The same numbers, with all categories on the driver and their names in the column's
    metadata, which encoders read. For columns of a few thousand categories at most."""
    return StringIndexer(
        inputCol=column,
        outputCol=output or f"{column}_index",
        stringOrderType="frequencyDesc",
        handleInvalid="keep",
    )


def one_hot_encoder(column: str, output: str | None = None) -> OneHotEncoder:
    """One indicator per index, none dropped."""
    return OneHotEncoder(inputCol=column, outputCol=output or f"{column}_vec", dropLast=False)


def assembler(
    columns: Sequence[str], output: str = "features", invalid: str = "error"
) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=invalid)


def vector_indexer(
    column: str = "features", output: str = "indexed", max_categories: int = 24
) -> VectorIndexer:
    """Features with few distinct values become categorical, the others stay."""
    return VectorIndexer(
        inputCol=column, outputCol=output, maxCategories=max_categories, handleInvalid="keep"
    )


def scaler(
    column: str = "features",
    output: str = "scaled",
    with_mean: bool = True,
    with_std: bool = True,
) -> StandardScaler:
    """Subtract the mean and divide by the sample deviation; constants become 0.

    Without the mean, sparse vectors stay sparse.
    """
    return StandardScaler(inputCol=column, outputCol=output, withMean=with_mean, withStd=with_std)


def index_frequencies(
    train: DataFrame, column: str, output: str | None = None, path: str | None = None
) -> FrequencyIndexModel:
    return frequency_indexer(column, output, path).fit(train)


def index_strings(train: DataFrame, column: str, output: str | None = None) -> StringIndexerModel:
    return string_indexer(column, output).fit(train)


def one_hot(train: DataFrame, column: str, output: str | None = None) -> OneHotEncoderModel:
    return one_hot_encoder(column, output).fit(train)


def assemble(
    df: DataFrame, columns: Sequence[str], output: str = "features", invalid: str = "error"
) -> DataFrame:
    return assembler(columns, output, invalid).transform(df)


def index_vectors(
    train: DataFrame, column: str = "features", output: str = "indexed", max_categories: int = 24
) -> VectorIndexerModel:
    return vector_indexer(column, output, max_categories).fit(train)


def standardize(
    train: DataFrame,
    with_mean: bool = True,
    with_std: bool = True,
    column: str = "features",
    output: str = "scaled",
) -> StandardScalerModel:
    return scaler(column, output, with_mean, with_std).fit(train)


def build_pipeline(stages: Sequence) -> Pipeline:
    return Pipeline(stages=list(stages))
