"""Columnar tables, views, caching and the split sink."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from larkspur.operators.ordering import sort_rows


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder of tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def register(df: DataFrame, name: str) -> DataFrame:
    """Name ``df`` for SQL text and hand it back."""
    df.createOrReplaceTempView(name)
    return df


#: Rows that one part of a frame laid out for a fit holds at most, about.
PART_ROWS = 1_000_000


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal a frame out to ``partitions`` parts, where a number is given, or to as many as
    keep a part below ``PART_ROWS`` rows.

    Repeated passes over one row group or a few small files keep most cores idle; the
    caller knows that and names the parts. Only the number of rows adds to them and nothing
    is derived from cores, so the layout, and what depends on it, is the same on any cluster.
    """
    return df if partitions is None else df.repartition(max(partitions, -(-df.count() // PART_ROWS)))


@contextmanager
def cached(*frames: DataFrame, partitions: int | None = None) -> Iterator[tuple[DataFrame, ...]]:
    """Keep frames for the repeated passes of an iterative fit, then release them.

    They are laid out by :func:`spread` first. Blocks spill to disk, and a block lost
    with its executor is recomputed.
    """
    kept = tuple(spread(frame, partitions).persist(StorageLevel.MEMORY_AND_DISK) for frame in frames)
    try:
        yield kept
    finally:
        for frame in kept:
            frame.unpersist()


def write_split(labelled: DataFrame, path: str, by: Sequence[str], label: str = "split") -> dict[str, str]:
    """Write the rows of each split in a folder of its own, globally sorted by ``by``.

    The rows are sorted once, by split and ``by``. The sort is a range partitioning,
    so part files follow one another in key order and no task holds more than its own
    range. A split without rows is a folder without files.
    """
    sort_rows(labelled, label, *by).write.mode("overwrite").partitionBy(label).parquet(path)
    names = ("base", "test")
    return {name: f"{path}/{label}={name}" for name in names}
