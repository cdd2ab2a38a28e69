"""Ready-made flows for the supported datasets.

Users with zip codes, movie ratings, page classification, terrain cover and hourly
rentals. Each part is a composition of the operators; datasets of the same shape
can use them as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.ml import Estimator, Pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions import (
    COVER_NAMES,
    HOLIDAY,
    RENTAL_MAXIMA,
    SEASON,
    WEATHER,
    WEEKDAY,
    WORKINGDAY,
    clean_numeric,
    decode,
    match_flag,
    sentence,
)
from larkspur.operators import features, prep, splits
from larkspur.operators.ordering import sort_rows
from larkspur.operators.relational import split_by
from larkspur.sources import read_delimited

# File layouts. Fixed values.
USER_SCHEMA = "userid int, age int, gender string, occupation string, zipcode string"
ZIP_SCHEMA = "zipcode int, zipCodeType string, city string, state string"
RATING_SCHEMA = "user int, item int, rating float, rated_at bigint"
ITEM_SCHEMA = "item int, title string"
RENTAL_DROPPED = ["instant", "dteday", "yr", "casual", "registered"]

# -- users --------------------------------------------------------------------


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, "|", USER_SCHEMA, header=False)


def read_zipcodes(spark: SparkSession, path: str) -> DataFrame:
    """The file may have more columns; the first four are kept."""
    return read_delimited(spark, path, ",", ZIP_SCHEMA)


# -- ratings ------------------------------------------------------------------


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, "\t", RATING_SCHEMA, header=False)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, "|", ITEM_SCHEMA, header=False)


def rating_splits(
    ratings: DataFrame, order: list[str], max_test: int = 0
) -> Iterator[tuple[str, DataFrame, DataFrame]]:
    """(name, base, test): five position folds, then the first and second ten per user.

    ``order`` is the unique column order that stands for the order of the file.
    ``max_test`` above 0 caps the test rows of the last two, as the file format does.
    """
    folds = splits.split_kfold(ratings, order, 5)
    for i in range(5):
        test, base = split_by(folds, F.col("fold") == i)
        yield f"u{i + 1}", base.drop("fold"), test.drop("fold")
    for name, start in (("ua", 1), ("ub", 11)):
        labelled = splits.split_nth_per_key(ratings, "user", order, start, start + 9, max_test)
        test, base = split_by(labelled, F.col("split") == "test")
        yield name, base.drop("split"), test.drop("split")


def write_rating_splits(
    ratings: DataFrame, path: str, order: list[str], max_test: int = 0
) -> dict[str, dict[str, str]]:
    """Write all sets of :func:`rating_splits`, each side sorted by user and item.

    Gives the folder of each set and side. Folds and the two per-user splits are found
    once; every row then goes to one side of each of the seven sets, and a single range
    sort orders them all. ``ratings`` must not have columns named ``set`` or ``side``. A
    side without rows is a folder without files, or none.
    """
    clash = {"set", "side"} & set(ratings.columns)
    if clash:
        raise ValueError(f"columns named {sorted(clash)} would be lost")
    labelled = splits.split_kfold(ratings, order, 5, "_fold")
    for name, start in (("ua", 1), ("ub", 11)):
        labelled = splits.split_nth_per_key(labelled, "user", order, start, start + 9, max_test, f"_{name}")
    sides = {f"u{i + 1}": F.when(F.col("_fold") == i, "test").otherwise("base") for i in range(5)}
    sides |= {"ua": F.col("_ua"), "ub": F.col("_ub")}
    pairs = F.array(*[F.struct(F.lit(name).alias("set"), side.alias("side")) for name, side in sides.items()])
    rows = labelled.select(*ratings.columns, F.inline(pairs))
    sort_rows(rows, "set", "side", "user", "item").write.mode("overwrite").partitionBy("set", "side").parquet(path)
    return {name: {side: f"{path}/set={name}/side={side}" for side in ("base", "test")} for name in sides}


def items_sentence(title: str = "title") -> Column:
    """Say which item is recommended to a user, from columns user, rank, item, title and score."""
    what = F.coalesce(F.col(title), F.concat(F.lit("item "), F.col("item").cast("string")))
    return sentence("user ", F.col("user"), ", choice ", F.col("rank"), ": ", what, ", score ", F.round("score", 2))


def users_sentence(title: str = "title") -> Column:
    """Say to which user an item is recommended, from columns item, title, rank, user and score."""
    what = F.coalesce(F.col(title), F.lit("untitled"))
    return sentence(
        "item ", F.col("item"), " (", what, "), choice ", F.col("rank"), ": user ", F.col("user"),
        ", score ", F.round("score", 2),
    )


# -- page classification ------------------------------------------------------


def prepare_pages(raw: DataFrame, labelled: bool = True, floor: float | None = None) -> DataFrame:
    """url, category, cleaned numbers and, if there is one, the label in the last column.

    Input columns are text: url first, category fourth, numbers from the fifth on.
    ``floor`` 0 is for naive Bayes.
    """
    numbers = prep.feature_columns(raw, start=4, stop=-1 if labelled else None)
    columns = [clean_numeric(F.col(f"`{n}`"), floor=floor).alias(n) for n in numbers]
    if labelled:
        columns.append(F.col(f"`{raw.columns[-1]}`").try_cast("double").alias("label"))
    return raw.select("url", "alchemy_category", *columns)


def page_pipeline(pages: DataFrame, model: Estimator, scale: str | None = None) -> Pipeline:
    """Encode the category, assemble, optionally standardize, then fit ``model``.

    ``scale`` is "mean" for zero mean and unit deviation, or "std" for the deviation
    only. The model reads ``features``, or ``scaled`` when scaling.
    """
    numbers = [n for n in pages.columns if n not in ("url", "alchemy_category", "label")]
    stages = [
        features.string_indexer("alchemy_category"),
        features.one_hot_encoder("alchemy_category_index"),
        features.assembler(["alchemy_category_index_vec", *numbers]),
    ]
    if scale is not None:
        if scale not in ("mean", "std"):
            raise ValueError(f"scale must be 'mean' or 'std', not {scale!r}")
        stages.append(features.scaler(with_mean=scale == "mean"))
    return features.build_pipeline([*stages, model])


# -- terrain cover ------------------------------------------------------------


def prepare_cover(raw: DataFrame) -> DataFrame:
    """Text columns to numbers; the last one, counted from 1, to a label from 0."""
    numbers = prep.cast_columns(raw, raw.columns)
    last = raw.columns[-1]
    return numbers.withColumn("label", F.col(last) - 1).drop(last)


def cover_pipeline(cover: DataFrame, model: Estimator) -> Pipeline:
    columns = [c for c in cover.columns if c != "label"]
    return features.build_pipeline([features.assembler(columns), model])


def present_cover(scored: DataFrame) -> DataFrame:
    """The named measurements beside label and prediction."""
    return scored.withColumnsRenamed(COVER_NAMES).select(*COVER_NAMES.values(), "label", "prediction")


def cover_sentence() -> Column:
    """Describe a row of :func:`present_cover`: measurements, predicted and true kind."""
    measured = [part for name in COVER_NAMES.values() for part in (f"{name} ", F.col(name), ", ")]
    return sentence(
        *measured, "predicted kind ", F.col("prediction").cast("int"), ", true kind ", F.col("label").cast("int"),
        ": ", match_flag("label", "prediction"),
    )


# -- hourly rentals -----------------------------------------------------------


def prepare_rentals(raw: DataFrame) -> DataFrame:
    kept = raw.drop(*RENTAL_DROPPED)
    return prep.cast_columns(kept, kept.columns)


def rental_pipeline(rentals: DataFrame, model: Estimator, max_categories: int = 24) -> Pipeline:
    """Assemble, mark features with few values as categorical, then fit ``model`` on cnt."""
    columns = [c for c in rentals.columns if c != "cnt"]
    return features.build_pipeline(
        [
            features.assembler(columns, "raw_features"),
            features.vector_indexer("raw_features", "features", max_categories),
            model,
        ]
    )


def rental_sentence() -> Column:
    """Describe a prepared rental row in words and real units."""

    def code(name: str) -> Column:
        return F.col(name).cast("int")

    def real(name: str) -> Column:
        return F.round(F.col(name) * RENTAL_MAXIMA[name], 2)

    return sentence(
        "month ", code("mnth"), " (", decode(code("season"), SEASON), "), hour ", code("hr"),
        ", day ", decode(code("weekday"), WEEKDAY), " - ", decode(code("holiday"), HOLIDAY), " - ",
        decode(code("workingday"), WORKINGDAY), "; weather ", decode(code("weathersit"), WEATHER),
        "; degrees ", real("temp"), ", felt as ", real("atemp"), "; humidity ", real("hum"),
        "; wind ", real("windspeed"),
    )
