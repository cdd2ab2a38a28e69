"""Alternating least squares in tasks of bounded memory.

``pyspark.ml``'s ALS holds, in each task of a half-step, all ratings of a block and an array
for each vector of the other side that the block needs, which at hundreds of millions of
ratings is more than an executor has. This estimator takes the same parameters, solves the
same equations and gives the same kind of model, but packs the ratings of a block into pieces
once and takes them one by one. The other side's vectors go to a file of the task, which it
maps, so a task holds one piece and the ids of those vectors.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Callable, Iterator
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.session import collect_garbage, discard, materialize, scratch_path

#: Ratings in a piece, and cells of normal equations solved at a time.
PIECE, CELLS = 131_072, 2_097_152
#: Half-steps whose vectors are sent before they are written. Then nothing refers to what was sent
#: any more, and Spark removes it once the driver collects its garbage.
KEEP = 4
_MIX, _SHIFT = 2_654_435_761, 15


def _block(ids: np.ndarray, blocks: int) -> np.ndarray:
    return ((ids.astype(np.int64) * _MIX) >> _SHIFT) % blocks


def _block_column(ids: str, blocks: int) -> Column:
    """:func:`_block` of a column of integers."""
    return F.pmod(F.shiftright(F.col(ids).cast("bigint") * F.lit(_MIX), _SHIFT), F.lit(blocks)).cast("int")


def _same(key: int) -> int:
    return key


def _id(df: DataFrame, name: str) -> Column:
    """Ids as integers; anything else is an error, as in Spark's ALS."""
    kind, ids = df.schema[name].dataType.typeName(), F.col(name)
    if kind not in ("byte", "short", "integer", "long", "float", "double", "decimal"):
        raise ValueError(f"Column {name} must be of type numeric but was actually of type {kind}.")
    whole = F.coalesce(ids.try_cast("int") == ids, F.lit(False))
    return F.when(whole, ids.try_cast("int")).otherwise(
        F.raise_error(F.concat(F.lit(f"ids in column {name} must be integers, not "), F.coalesce(ids.cast("string"), F.lit("null"))))
    ).alias(name)


def _pack(targets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pieces of the rows (block, id, other, rating) of a partition sorted by the first three.

    A piece holds whole ids of one block: its ids and how many ratings each has, the others
    they name, the place of each rating's other among those, the ratings, and for each block of
    the others the places of the ids that it needs. An id of more ratings than a piece holds
    has pieces of its own, marked as parts.
    """
    schema = pa.schema([("block", pa.int32()), ("data", pa.binary())])

    def piece(block: np.ndarray, ids: np.ndarray, others: np.ndarray, ratings: np.ndarray, part: bool) -> pa.RecordBatch:
        starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        counts = np.diff(np.append(starts, ids.size))
        named, at = np.unique(others, return_inverse=True)
        links = np.unique(_block(named, targets)[at] * starts.size + np.repeat(np.arange(starts.size), counts))
        ends = np.searchsorted(links, np.arange(targets + 1) * starts.size)
        who = (links % starts.size).astype(np.int32)
        data = (ids[starts], counts.astype(np.int32), named, at.astype(np.int32), ratings, who, ends, part)
        return pa.record_batch([pa.array(block[:1]), pa.array([pickle.dumps(data, 5)], pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, large = None, None

        def cut(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            """Rows of whole ids, the first of which may go on a large one."""
            if large is not None and rows[1].size and rows[1][0] == large:
                n = np.searchsorted(rows[1] != large, True)
                yield piece(*(x[:n] for x in rows), part=True)
                rows = [x[n:] for x in rows]
            bounds = [0, *(np.flatnonzero(rows[0][1:] != rows[0][:-1]) + 1), rows[0].size]
            for low, high in zip(bounds, bounds[1:]):
                if high > low:
                    yield piece(*(x[low:high] for x in rows), part=False)

        for batch in batches:
            new = [column.to_numpy() for column in batch.columns]
            rest = new if rest is None else [np.concatenate(pair) for pair in zip(rest, new)]
            while rest[1].size >= PIECE:
                others = np.flatnonzero(rest[1] != rest[1][-1])
                if others.size:
                    yield from cut([x[: others[-1] + 1] for x in rest])
                    large, rest = None, [x[others[-1] + 1 :] for x in rest]
                else:
                    large = rest[1][0]
                    yield piece(*rest, part=True)
                    rest = [x[:0] for x in rest]
        if rest is not None:
            yield from cut(rest)

    return run


def _start(ids: np.ndarray, rank: int, seed: int) -> np.ndarray:
    """A random direction for each id, which follows from the id and the seed alone."""

    def uniform(salt: int) -> np.ndarray:
        x = ids.astype(np.uint64)[:, None] * np.uint64(2 * rank) + np.arange(2 * rank, dtype=np.uint64)[None, salt::2]
        x = x + np.uint64(seed % 2**64) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53

    normal = np.sqrt(-2 * np.log(uniform(0))) * np.cos(2 * np.pi * uniform(1))
    return (normal / np.sqrt((normal**2).sum(1, keepdims=True))).astype(np.float32)


class _Vectors:
    """The vectors that a block needs, in a file, by ascending id."""

    def __init__(self, rank: int):
        self.rank, self.ids, self.file, self.all = rank, [], tempfile.TemporaryFile(), None

    def put(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        if self.all is not None:
            raise RuntimeError("vectors came after ratings")
        self.ids.append(ids)
        self.file.write(vectors.tobytes())

    def _mapped(self, n: int) -> np.ndarray:
        self.file.flush()
        return np.asarray(np.memmap(self.file, np.float32, "r", shape=(n, self.rank)))

    def _sort(self) -> None:
        ids = np.concatenate(self.ids)
        order, loose = np.argsort(ids), self._mapped(ids.size)
        self.ids, self.file = ids[order], tempfile.TemporaryFile()
        for low in range(0, ids.size, PIECE):
            self.file.write(loose.take(order[low : low + PIECE], axis=0).tobytes())
        self.all = self._mapped(ids.size)

    def of(self, ids: np.ndarray) -> np.ndarray:
        if self.all is None:
            self._sort()
        at = np.minimum(np.searchsorted(self.ids, ids), self.ids.size - 1)
        if (self.ids.take(at) != ids).any():
            raise RuntimeError("a block lacks vectors that its ratings name")
        return self.all.take(at, axis=0)


def _sums(v, at, ratings, counts, alpha):
    """Upper cells of the Gram matrix, right side and weight of the ridge for each id."""
    rank, starts = v.shape[1], np.cumsum(counts) - counts
    x = np.ascontiguousarray(v.take(at, axis=0).T, np.float64)
    r = ratings.astype(np.float64)
    if alpha is None:
        pulled, right, n = x, r, counts.astype(np.float64)
    else:
        strength = alpha * np.abs(r)
        pulled, right = x * strength, np.where(r > 0, 1 + strength, 0.0)
        n = np.add.reduceat((r > 0).astype(np.float64), starts)
    cells = [np.add.reduceat(pulled[i] * x[j], starts) for i in range(rank) for j in range(i, rank)]
    return np.stack(cells), np.stack([np.add.reduceat(x[i] * right, starts) for i in range(rank)]), n


def _solved(cells, right, n, reg, gram):
    rank = len(right)
    i, j = np.triu_indices(rank)
    a = np.empty((n.size, rank, rank))
    a[:, i, j] = a[:, j, i] = cells.T
    a += gram
    a[:, range(rank), range(rank)] += (reg * n)[:, None]
    return np.linalg.solve(a, right.T[:, :, None])[:, :, 0].astype(np.float32)


def _half_step(rank: int, reg: float, alpha: float | None):
    """(ids, vectors, who, ends) of the pieces of a block; ``who`` and ``ends`` as in a piece.

    The rows of a block are what :func:`_sent` sends it, then its pieces.
    """

    def run(rows):
        known, gram, large, step = _Vectors(rank), np.zeros((rank, rank)), {}, max(1, CELLS // rank**2)
        for _, row in rows:
            if isinstance(row, tuple):
                known.put(*row)
                continue
            if isinstance(row, np.ndarray):
                gram += row
                continue
            ids, counts, named, at, ratings, who, ends, part = pickle.loads(row)
            v = known.of(named)
            if part:
                sums = (*_sums(v, at, ratings, counts, alpha), np.diff(ends))
                large[ids[0]] = tuple(map(add, large[ids[0]], sums)) if ids[0] in large else sums
                continue
            found, last = [], np.append(0, np.cumsum(counts))
            for low in range(0, ids.size, step):
                high = min(low + step, ids.size)
                these = slice(last[low], last[high])
                sums = _sums(v, at[these], ratings[these], counts[low:high], alpha)
                found.append(_solved(*sums, reg, gram))
            yield ids, np.concatenate(found), who, ends
        for one, (cells, right, n, links) in large.items():
            yield _alone(one, links, _solved(cells, right, n, reg, gram))

    return run


def _first_step(rank: int, seed: int):
    """The random start of all ids of a block, as :func:`_half_step` gives what it solves."""

    def run(rows):
        large = {}
        for _, row in rows:
            ids, *_, who, ends, part = pickle.loads(row)
            if part:
                large[ids[0]] = large.get(ids[0], 0) + np.diff(ends)
            else:
                yield ids, _start(ids, rank, seed), who, ends
        for one, links in large.items():
            yield _alone(one, links, _start(np.array([one]), rank, seed))

    return run


def _alone(one: int, links: np.ndarray, vector: np.ndarray):
    needs = links > 0
    return np.array([one], np.int32), vector, np.zeros(needs.sum(), np.int32), np.append(0, np.cumsum(needs))


def _sent(blocks: int, implicit: bool):
    """The vectors of pieces, to each block that needs some; implicit ratings need all's Gram matrix too."""

    def run(pieces):
        gram = 0
        for ids, vectors, who, ends in pieces:
            for block, (low, high) in enumerate(zip(ends, ends[1:])):
                if high > low:
                    yield block, (ids[who[low:high]], vectors[who[low:high]])
            if implicit:
                wide = vectors.astype(np.float64)
                gram = gram + wide.T @ wide
        if isinstance(gram, np.ndarray):
            yield from ((block, gram) for block in range(blocks))

    return run


class PackedALS(ALS):
    """Spark's ALS, fitted piece by piece; with ``nonnegative`` by Spark itself."""

    def _fit(self, dataset: DataFrame) -> ALSModel:
        if self.getNonnegative():
            return super()._fit(dataset)
        spark, rank, reg = dataset.sparkSession, self.getRank(), self.getRegParam()
        alpha = self.getAlpha() if self.getImplicitPrefs() else None
        user, item, rating = self.getUserCol(), self.getItemCol(), F.col(self.getRatingCol()).cast("float")
        rating = F.when(rating.isNull() | F.isnan(rating), F.raise_error(F.lit("ratings must not be null or NaN"))).otherwise(rating)
        rows = dataset.select(_id(dataset, user).alias("user"), _id(dataset, item).alias("item"), rating.alias("rating"))
        collect_garbage(spark)
        users = self._pieces(rows, "user", self.getNumUserBlocks(), "item", self.getNumItemBlocks())
        items = self._pieces(rows, "item", self.getNumItemBlocks(), "user", self.getNumUserBlocks())
        vectors = users.mapPartitions(_first_step(rank, self.getSeed()))
        kept, last = {}, 2 * self.getMaxIter() - 1
        for step in range(last + 1):
            side, pieces = ("user", users) if step % 2 else ("item", items)
            blocks = pieces.getNumPartitions()
            met = vectors.mapPartitions(_sent(blocks, alpha is not None)).partitionBy(blocks, _same).union(pieces)
            if met.getNumPartitions() != blocks:
                raise RuntimeError("vectors and ratings of a block did not meet")
            vectors = met.mapPartitions(_half_step(rank, reg, alpha))
            if step % KEEP == KEEP - 1 or step >= last - 1:
                old, kept[side] = kept.get(side), self._kept(spark, vectors)
                vectors = spark.sparkContext.pickleFile(kept[side])
                if old:
                    discard(spark, old)
                del met
                collect_garbage(spark)
        if not kept:
            starts = {"user": vectors, "item": items.mapPartitions(_first_step(rank, self.getSeed()))}
            kept = {side: self._kept(spark, start) for side, start in starts.items()}
        if vectors.isEmpty():
            raise ValueError("there are no ratings")
        sides = {side: self._table(spark, path) for side, path in kept.items()}
        for path in kept.values():
            discard(spark, path)
        model = ALSModel(self._new_java_obj(
            "org.apache.spark.ml.recommendation.ALSModel", self.uid, rank, sides["user"], sides["item"]
        ))
        return self._copyValues(model)

    @staticmethod
    def _pieces(rows: DataFrame, own: str, blocks: int, other: str, targets: int) -> RDD:
        """(block, piece), a partition for each block. The shuffle that deals them keeps them."""
        sorted_ = rows.select(_block_column(own, blocks).alias("block"), own, other, "rating")
        sorted_ = sorted_.repartition(own).sortWithinPartitions("block", own, other)
        pieces = sorted_.mapInArrow(_pack(targets), "block int, data binary")
        return pieces.rdd.map(tuple).partitionBy(blocks, _same)

    @staticmethod
    def _kept(spark: SparkSession, pieces: RDD) -> str:
        path = scratch_path(spark, "factors")
        pieces.saveAsPickleFile(path, 1)
        return path

    @staticmethod
    def _table(spark: SparkSession, path: str) -> DataFrame:
        rows = spark.sparkContext.pickleFile(path).flatMap(lambda piece: zip(piece[0].tolist(), piece[1].tolist()))
        return materialize(spark.createDataFrame(rows, "id int, features array<float>", verifySchema=False), "factors")

