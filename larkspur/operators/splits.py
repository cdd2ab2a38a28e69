"""Reproducible train/test splits.

Membership depends on a row's own key or order value, never on how the input is
partitioned, so a recomputed or repartitioned input splits the same way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.operators.ordering import position_folds, row_hash, with_position

_HASH_RANGE = 1 << 32


def key_hash(key: Column | str, salt: str = "") -> Column:
    """Uniform 32-bit number from the text of a key; null counts as empty text."""
    text = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.lit(salt), text) if salt else text)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def split_random(
    df: DataFrame,
    key: Column | str,
    weights: Mapping[str, float],
    seed: int | None = None,
    name: str = "split",
) -> DataFrame:
    """Label rows with a split name in the given proportions, by key hash."""
    if len(weights) < 2:
        raise ValueError("a split needs at least two parts")
    position = key_hash(key, "" if seed is None else f"{seed}:") * sum(weights.values())
    *earlier, last = weights
    edge, label = 0, F
    for split in earlier:
        edge += weights[split]
        label = label.when(position < F.lit(edge * _HASH_RANGE), F.lit(split))
    label = label.otherwise(F.lit(last))
    return df.withColumn(name, label)


#: Parts that a key's rows are dealt out to before its first rows are chosen.
SALTS = 64


def split_nth_per_key(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    start: int,
    stop: int,
    max_test: int = 0,
    name: str = "split",
) -> DataFrame:
    """Test is the ``start``-th to ``stop``-th row of each key, base the rest.

    Rows that are equal in ``order`` go by a hash of the whole row, so each key gives the
    exact number of test rows; only exact copies of one row share a side. With ``max_test``
    above 0, only that many test rows, the first in overall order, are taken; later ones
    fall to the base.

    Finding the test rows needs the first ``stop`` rows of each key only. They are chosen
    twice: among the rows of a key and salt, which keeps a key that owns much of the data
    from being one group, and then among what the salts of a key have left. Per key they
    form one interval of the order, and the full rows are labelled by comparison with it.
    """
    tie = row_hash(df)
    at = F.struct(*order, tie.alias("_tie"))
    slim = df.select(F.col(key).alias("_key"), at.alias("_at"))
    salted = Window.partitionBy("_key", F.pmod(F.xxhash64("_at"), F.lit(SALTS))).orderBy("_at")
    few = slim.withColumn("_n", F.row_number().over(salted)).filter(F.col("_n") <= stop)
    whole = Window.partitionBy("_key").orderBy("_at")
    numbered = few.withColumn("_n", F.row_number().over(whole)).filter(F.col("_n") <= stop)
    chosen = numbered.filter(F.col("_n") >= start)
    if max_test > 0:
        chosen = with_position(chosen, ["_at"], "_rank").filter(F.col("_rank") < max_test)
    bounds = chosen.groupBy("_key").agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))
    joined = df.join(bounds, F.col(key).eqNullSafe(F.col("_key")), "left")
    inside = F.coalesce(at.between(F.col("_first"), F.col("_last")), F.lit(False))
    label = F.when(inside, F.lit("test")).otherwise(F.lit("base"))
    return joined.withColumn(name, label).drop("_key", "_first", "_last")


def split_kfold(df: DataFrame, order: Sequence[str], k: int, name: str = "fold") -> DataFrame:
    """``k`` disjoint contiguous test folds that together cover every row.

    Fold ``i`` is the test side of round ``i``; its complement is the base.
    """
    return position_folds(df, order, k, name)
