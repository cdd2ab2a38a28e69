"""Positions: of a row in the whole input, and of a row within its key.

A window without partitioning, or one partitioned by a key that owns a third of
the data, sends all those rows to one task. Nothing here does that: rows are
range-partitioned, numbered inside their range, and shifted by the sizes of the
ranges before it.

Input order is not a property of a DataFrame, so the order is always given. Where
positions are to be reproducible it must be unique.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampType

from larkspur.session import materialize

Order = Column | str

# monotonically_increasing_id puts the partition number above these bits.
_ROW_BITS = 33
# A key is treated apart when it owns more rows than this, which one task orders with ease.
_GROUP_ROWS = 1_000_000


def row_hash(df: DataFrame) -> Column:
    # Maps cannot be hashed; rows that differ in those only are told apart like copies.
    parts = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind]
    return F.xxhash64(*parts) if parts else F.lit(0)


def sort_rows(df: DataFrame, *order: Order) -> DataFrame:
    """Total order over all rows.

    A plain sort sends every row of one sort value to the same task. Here ties are
    told apart by a hash of the whole row, and exact copies by the input partition
    they come from, so that a value owning much of the data is cut into ranges too.
    Both are the same again when a lost task is repeated.
    """
    tagged = df.withColumns({"_tie": row_hash(df), "_from": F.spark_partition_id()})
    return tagged.orderBy(*order, "_tie", "_from").drop("_tie", "_from")


@dataclass(frozen=True)
class By:
    """A column to order by, with its direction; nulls come first when rising, last when falling."""

    column: str
    falling: bool = False

    def order(self) -> Column:
        return F.desc(f"`{self.column}`") if self.falling else F.asc(f"`{self.column}`")


def _coarse(df: DataFrame, by: By) -> Column:
    """A number that never falls where the column rises: equal for some different values."""
    kind, column = df.schema[by.column].dataType, F.col(f"`{by.column}`")
    if isinstance(kind, NumericType):
        number = column.cast("double")
    elif isinstance(kind, (BooleanType, DateType)):
        number = (column.cast("int") if isinstance(kind, BooleanType) else F.unix_date(column)).cast("double")
    elif isinstance(kind, TimestampType):
        number = F.unix_micros(column).cast("double")
    elif isinstance(kind, StringType):
        # The first six bytes as a number; doubles hold it exactly.
        head = F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, 6)), 12, "0")
        number = F.conv(head, 16, 10).cast("double")
    else:
        number = F.lit(0.0)
    # NaN is above all numbers, null below them.
    number = F.when(F.isnan(number), F.lit(float("inf"))).otherwise(number)
    number = F.coalesce(number, F.lit(float("-inf")))
    return -number if by.falling else number


def _threshold(keys: DataFrame, k: int) -> tuple[float, int] | None:
    """A key at or above the ``k``-th, and how many rows reach it; None with at most ``k`` rows.

    The key comes from a mergeable quantile sketch, whose rank error is known. It is aimed
    past the ``k``-th row by twice that error; the rows up to it are then counted exactly,
    and only where they are still too few is it aimed once more, by ten times as much.
    """
    total = keys.count()
    if total <= k:
        return None
    for error in (k / 50, k / 5):
        accuracy = int(min(1_000_000, max(10_000, total / max(error, 1))))
        share = min(1.0, (k + 2 * max(error, total / accuracy)) / total)
        key = keys.agg(F.percentile_approx("key", F.lit(share), F.lit(accuracy)).alias("key")).first()["key"]
        reached = keys.where(F.col("key") <= F.lit(key)).count()
        if reached >= k:
            return key, reached
    return None


def top_k(df: DataFrame, k: int, *order: By | str) -> DataFrame:
    """First ``k`` rows of an ordering, in that order; ties go by a hash of the row.

    One plan for any ``k``: a quantile sketch of the first order column finds a key that at
    least ``k`` rows reach, rows beyond it are filtered out where they are, and only the
    others, about ``k`` and the ties of the key, are put in order, by ranges. No task and
    not the driver gets ``k`` rows of every other task.
    """
    by = [By(o) if isinstance(o, str) else o for o in order]
    columns = [b.order() for b in by]
    if k <= 0:
        return df.limit(0)
    key = _coarse(df, by[0])
    found = _threshold(df.select(key.alias("key")), k)
    near = df if found is None else df.where(key <= F.lit(found[0]))
    tied = near.withColumn("_tie", row_hash(df))
    placed = with_position(tied, [*columns, "_tie"], "_position").where(F.col("_position") < k)
    return placed.orderBy("_position").drop("_position", "_tie")


def with_position(df: DataFrame, order: Sequence[Order], name: str = "position") -> DataFrame:
    """0-based global position of every row, by one range shuffle.

    The sorted rows are written once, because the sizes and the shifted numbers
    must come from the same range boundaries.
    """
    row = F.col("_row")
    placed = materialize(
        sort_rows(df, *order).withColumn("_row", F.monotonically_increasing_id()), "position"
    )
    part = F.shiftright(row, _ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    # One row per range partition of the job.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    joined = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    local = row.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    numbered = joined.withColumn(name, F.col("_before") + local)
    return numbered.drop("_row", "_part", "_before")


def position_folds(df: DataFrame, order: Sequence[str], k: int, name: str = "fold") -> DataFrame:
    """Equal contiguous folds 0..k-1 by position in a unique order.

    Only the order columns are sorted. That yields the at most ``k - 1`` rows at
    which a new fold begins; comparing with those labels the full rows in place,
    without moving them.
    """
    placed = with_position(df.select(*order), order, "_position")
    total = placed.count()
    here = F.expr(f"(_position * {k}) div {max(total, 1)}")
    previous = F.expr(f"((_position - 1) * {k}) div {max(total, 1)}")
    starts = placed.filter((F.col("_position") > 0) & (here > previous)).agg(
        F.collect_list(F.struct(F.struct(*order).alias("key"), here.alias("fold"))).alias("starts")
    )
    labelled = df.withColumn("_starts", materialize(starts, "folds").scalar())
    passed = F.filter("_starts", lambda s: s["key"] <= F.struct(*order))
    fold = F.coalesce(F.array_max(F.transform(passed, lambda s: s["fold"])), F.lit(0))
    return labelled.withColumn(name, fold.cast("int")).drop("_starts")


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [left[k].eqNullSafe(right[k]) for k in keys])


def nth_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str],
    name: str = "n",
    group_rows: int = _GROUP_ROWS,
) -> DataFrame:
    """1-based running count of each row within its key.

    Keys of ordinary size take the window. Hot keys, found by a map-side combined
    count, are numbered by global position minus the position their key starts at,
    so their rows spread over as many tasks as their ranges need.
    """
    keys = [key] if isinstance(key, str) else list(key)
    running = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint")
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    hot = materialize(sizes.filter(F.col("_rows") > group_rows), "hot")
    if hot.isEmpty():
        return df.withColumn(name, running)
    cold = df.join(hot, _same_key(df, hot, keys), "left_anti")
    warm = df.join(hot, _same_key(df, hot, keys), "left_semi")
    placed = materialize(with_position(warm, [*keys, *order], "_position"), "numbered")
    # Counted from where its key starts; one row a task and key is shuffled for that.
    starts = placed.groupBy(*keys).agg(F.min("_position").alias("_start"))
    joined = placed.join(starts, _same_key(placed, starts, keys))
    for key_column in keys:
        joined = joined.drop(starts[key_column])
    numbered = joined.withColumn(name, F.col("_position") - F.col("_start") + 1)
    return cold.withColumn(name, running).unionByName(numbered.drop("_position", "_start"))


def dense_index(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Number the distinct values 0..k-1 in value order and attach the number.

    The numbering is a distributed one, so string ids with very many values work
    as well as a handful of categories. Null keeps a null index.
    """
    values = df.select(F.col(column).alias("_value")).where(F.col(column).isNotNull()).distinct()
    index = with_position(values, ["_value"], "_index")
    # Null keys would meet in one task.
    joined = df.where(F.col(column).isNotNull()).join(index, F.col(column) == F.col("_value"), "left").drop("_value")
    nulls = df.where(F.col(column).isNull()).withColumn("_index", F.lit(None).cast("bigint"))
    return joined.unionByName(nulls).withColumnRenamed("_index", name or f"{column}_index")
