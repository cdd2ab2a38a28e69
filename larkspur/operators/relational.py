"""Grouping and joining.

No join here forces a strategy. A side is broadcast only when Spark's own size
check (``spark.sql.autoBroadcastJoinThreshold``, and AQE's measured sizes) allows
it; above that the join shuffles, and AQE splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.session import materialize


def _names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def group_count(
    df: DataFrame, keys: str | Sequence[str], order: bool = False, name: str = "count"
) -> DataFrame:
    """Rows per key combination; combined inside each input partition first."""
    keys = _names(keys)
    counts = df.groupBy(*keys).agg(F.count("*").alias(name))
    return counts.orderBy(*keys) if order else counts


def group_share(df: DataFrame, key: str, digits: int = 1) -> DataFrame:
    """Rows per key and their percentage of all rows.

    The total adds up the counts, so that the input is grouped once.
    """
    counts = group_count(df, key)
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("share", F.round(F.col("count") * 100.0 / total, digits))


def count_distinct(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Exact number of distinct values of each column, in one row."""
    return df.agg(*[F.countDistinct(c).alias(c) for c in _names(columns)])


def crosstab(df: DataFrame, a: str, b: str, values: Sequence | None = None) -> DataFrame:
    """Contingency table: one row per ``a``, one column per ``b``, 0 for empty cells.

    With ``values`` listed the plan stays lazy, and a value that is not listed is an error.
    Without, the pairs are counted in one pass over ``df`` and written; the distinct values
    and the cells come from those counts. Either way there is one column a value, so
    ``spark.sql.pivotMaxValues`` bounds how many there may be.
    """
    if values is not None:
        listed = reduce(lambda x, y: x | y, [F.col(b).eqNullSafe(F.lit(v)) for v in values], F.lit(False))
        counts = {str(v): F.count_if(F.col(b).eqNullSafe(F.lit(v))) for v in values}
        cells = df.groupBy(F.col(a).alias(f"{a}_{b}")).agg(
            F.struct(*[count.alias(name) for name, count in counts.items()]).alias("_cells"),
            F.count_if(~listed).alias("_others"),
        )
        complaint = F.raise_error(F.lit(f"{b} has values that are not listed"))
        checked = F.when(F.col("_others") == 0, F.col("_cells")).otherwise(complaint)
        return cells.withColumn("_cells", checked).select(f"{a}_{b}", "_cells.*")
    pairs = df.groupBy(F.col(a).alias("_row"), F.col(b).alias("_column")).agg(F.count(F.lit(1)).alias("_n"))
    counted = materialize(pairs, "crosstab").withColumnRenamed("_row", f"{a}_{b}")
    cells = counted.groupBy(f"{a}_{b}").pivot("_column").agg(F.sum("_n"))
    row, *counts = cells.columns
    return cells.select(row, *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(c) for c in counts])


def feature_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and sample standard deviation per column, one row per column, one pass."""
    stats = [
        F.struct(
            F.lit(c).alias("feature"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
        )
        for c in columns
    ]
    return df.agg(F.array(*stats).alias("stats")).select(F.inline("stats"))


def left_join(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], cast: str | None = None
) -> DataFrame:
    """Left outer equi join on (left column, right column) pairs.

    ``cast`` converts the left keys for the comparison only. A key that does not
    convert matches nothing and its row is kept.
    """
    terms = []
    for l_name, r_name in on:
        key = left[l_name].try_cast(cast) if cast else left[l_name]
        terms.append(key == right[r_name])
    return left.join(right, reduce(lambda x, y: x & y, terms), "left_outer")


def join_group_count(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, str],
    by: str,
    cast: str | None = None,
    name: str = "count",
) -> DataFrame:
    """``count(*)`` of a left outer join, grouped by a column of the right side.

    Counting per join key comes first. Every left row of one key meets the same
    right rows, so joining the counts and adding them up gives the same numbers,
    while a hot key reaches the join as one row per map task instead of as all of
    its rows. Unmatched rows form the null group.
    """
    l_key, r_key = on
    key = F.col(l_key).try_cast(cast) if cast else F.col(l_key)
    counts = left.groupBy(key.alias("_key")).agg(F.count("*").alias("_rows"))
    joined = counts.join(
        right.select(F.col(r_key).alias("_right"), by), F.col("_key") == F.col("_right"), "left_outer"
    )
    return joined.groupBy(by).agg(F.sum("_rows").alias(name))


def lookup(
    df: DataFrame,
    dim: DataFrame,
    key: tuple[str, str],
    value: str,
    how: str = "left",
    strict: bool = False,
) -> DataFrame:
    """Decorate ids with one column of a dimension.

    Where the dimension repeats a key the least value is taken, so no row is repeated.
    ``strict`` makes a missing key an error, as a dictionary lookup would.
    """
    fk, pk = key
    side = dim.groupBy(F.col(pk).alias("_pk")).agg(F.min(value).alias("_value"))
    side = side.withColumn("_hit", F.lit(True))
    joined = df.join(side, F.col(fk) == F.col("_pk"), how)
    text: Column = F.col("_value")
    if strict:
        complaint = F.concat(F.lit(f"no {value} for {fk} "), F.col(fk).cast("string"))
        text = F.when(F.col("_hit"), text).otherwise(F.raise_error(complaint))
    return joined.withColumn(value, text).drop("_pk", "_value", "_hit")


def split_by(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy the predicate, and the complement (unknown counts as no)."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.filter(hit), df.filter(~hit)
