"""What the classifiers share: labelled samples, and sums over partitions."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, k: int) -> Column:
    """crc32 of the id as text, modulo ``k``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % k


def labelled_sample(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """(doc_id, text, label, part) of about ``bound`` labelled documents at most.

    ``labels`` is (doc_id, label). Ids are chosen by a hash, at a rate that follows from
    their number, so the sample is broadcast: its size is bounded by the parameter and
    not by the data. ``part`` is a hash of the id in 0..99. Null labels are left out;
    an id labelled twice counts twice.
    """
    known = labels.where("doc_id is not null and label in (0, 1)").select("doc_id", "label")
    rate = min(1.0, bound / max(1, known.count()))
    hashed = F.xxhash64("doc_id")
    chosen = known.where(F.pmod(hashed, F.lit(1_000_000)) < int(rate * 1_000_000))
    chosen = chosen.withColumn("part", F.pmod(F.shiftright(hashed, 24), F.lit(100)).cast("int"))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def partition_sums(
    df: DataFrame, sums: Callable[[pa.RecordBatch], list[np.ndarray]], shapes: list[tuple[int, ...]]
) -> list[np.ndarray]:
    """Sum arrays over all batches: one row a partition reaches the driver.

    Meant for frames of a bounded number of rows and of few partitions.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(s) for s in shapes]
        for batch in batches:
            if batch.num_rows:
                for mine, more in zip(total, sums(batch)):
                    mine += more
        yield pa.RecordBatch.from_arrays(
            [pa.array([t.tobytes()], pa.binary()) for t in total], [f"s{i}" for i in range(len(shapes))]
        )

    schema = ", ".join(f"s{i} binary" for i in range(len(shapes)))
    total = [np.zeros(s) for s in shapes]
    for row in df.mapInArrow(run, schema).toLocalIterator():
        for i, shape in enumerate(shapes):
            total[i] += np.frombuffer(row[i]).reshape(shape)
    return total


def crc(text: str) -> int:
    return zlib.crc32(text.encode())
