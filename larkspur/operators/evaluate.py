"""Scoring and evaluation.

A scored frame keeps the label in the row, so predictions and labels never have
to be paired up by position.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml import Transformer
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.columns import abs_error, decode, match_flag
from larkspur.session import materialize


def score(model: Transformer, df: DataFrame) -> DataFrame:
    return model.transform(df)


def score_decoded(
    model: Transformer, df: DataFrame, mapping: Mapping[int, str], keep: Sequence[str]
) -> DataFrame:
    """Score rows that carry no label; emit their id, the class and its text."""
    predicted = F.col("prediction").cast("int")
    return score(model, df).select(
        *keep, predicted.alias("prediction"), decode(predicted, mapping).alias("description")
    )


def score_with_error(
    model: Transformer, df: DataFrame, label: str = "label", keep: Sequence[str] = ()
) -> DataFrame:
    """Whole-number prediction beside the actual value, match flag and distance."""
    whole = F.col("prediction").try_cast("bigint")
    return score(model, df).select(
        *keep,
        label,
        whole.alias("prediction"),
        match_flag(label, whole).alias("result"),
        abs_error(label, "prediction").alias("error"),
    )


def auc_hard(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """ROC area of 0/1 predictions: the mean of both classes' hit rates.

    One row from one aggregate; null when a class does not occur.
    """
    hit_rate = F.avg(F.when(F.col(label) == 1, F.col(prediction)))
    reject_rate = F.avg(F.when(F.col(label) == 0, 1 - F.col(prediction)))
    return df.agg(((hit_rate + reject_rate) / 2).alias("auc"))


def accuracy(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    hit = F.when(F.col(prediction) == F.col(label), 1.0).otherwise(0.0)
    return df.agg(F.avg(hit).alias("accuracy"))


def rmse(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    miss = F.col(label) - F.col(prediction)
    return df.agg(F.sqrt(F.avg(miss * miss)).alias("rmse"))


def _score_column(df: DataFrame, score: str) -> Column:
    """A score as a number; of a vector, such as a raw prediction, class 1's entry."""
    kind = df.schema[score].dataType
    return vector_to_array(score)[1] if isinstance(kind, VectorUDT) else F.col(score).cast("double")


def rank_areas(df: DataFrame, scores: Sequence[str], label: str = "label") -> DataFrame:
    """(score, auc): the exact ROC area of each of several scores, one row a score.

    The area is the share of pairs of a 1 and a 0 in which the 1 scores higher, pairs with
    equal scores counted half. Rows are counted per distinct score first, so a score that
    many rows share is one row from then on. The counts are sorted by ranges; within a
    range the zeros below are summed up, and what the ranges before hold is added. Null
    scores and labels other than 0 and 1 are left out; NaN is the highest score. A score
    that only one class has, or no row, has a null area.
    """
    names = list(scores)
    pairs = F.array(*[F.struct(F.lit(n).alias("score"), _score_column(df, n).alias("at")) for n in names])
    long = df.select(F.explode(pairs).alias("s"), F.col(label).cast("double").alias("y")).select("s.*", "y")
    counts = long.where("at is not null and y in (0, 1)").groupBy("score", "at").agg(
        F.count_if(F.col("y") == 1).alias("ones"), F.count_if(F.col("y") == 0).alias("zeros")
    )
    order = ["score", "at"]
    # Written once: sizes and running sums must come from the same ranges.
    ranged = materialize(counts.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "scores")
    sums = ranged.groupBy("score", "part").agg(F.sum("zeros").alias("zeros"))
    # One row a range and score.
    before = Window.partitionBy("score").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("score", "part", F.coalesce(F.sum("zeros").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("score", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("zeros").over(inside), F.lit(0))
    placed = ranged.withColumn("below", below).join(offsets, ["score", "part"])
    won = F.col("ones") * (F.col("offset") + F.col("below") + F.col("zeros") / 2)
    total = placed.groupBy("score").agg(F.sum(won).alias("won"), F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    known = F.explode(F.array(*[F.lit(n) for n in names])).alias("score")
    area = F.expr("try_divide(won, double(ones) * zeros)").alias("auc")
    return df.sparkSession.range(1).select(known).join(total, "score", "left").select("score", area)


def auc(df: DataFrame, score: str = "rawPrediction", label: str = "label") -> float:
    """Exact ROC area of one score; NaN where there is none."""
    area = rank_areas(df, [score], label).first()["auc"]
    return math.nan if area is None else area


class _AreaEvaluator(Evaluator):
    def __init__(self, column: str, label: str) -> None:
        super().__init__()
        self.column, self.label = column, label

    def isLargerBetter(self) -> bool:
        return True


class AucEvaluator(_AreaEvaluator):
    """Exact ROC area of a score."""

    def _evaluate(self, dataset: DataFrame) -> float:
        return auc(dataset, self.column, self.label)


class HardAucEvaluator(_AreaEvaluator):
    """ROC area of 0/1 predictions, from one aggregation."""

    def _evaluate(self, dataset: DataFrame) -> float:
        area = auc_hard(dataset, self.column, self.label).first()["auc"]
        return math.nan if area is None else area


def auc_evaluator(score: str = "rawPrediction", label: str = "label") -> AucEvaluator:
    return AucEvaluator(score, label)


def hard_auc_evaluator(prediction: str = "prediction", label: str = "label") -> HardAucEvaluator:
    """For use in tuning."""
    return HardAucEvaluator(prediction, label)


def accuracy_evaluator(label: str = "label") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")


def rmse_evaluator(label: str = "label") -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=label, metricName="rmse")
