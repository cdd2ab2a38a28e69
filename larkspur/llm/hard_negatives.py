"""Hard negatives of anchor vectors, with score bounds from summaries of segments.

A vector is cut into segments, and each segment's mean and deviation are stored. Over one
segment of length L the inner product of two vectors lies within
``L * mean * mean' +- deviation * deviation'`` (a deviation is the length of what is left
after the mean is taken off). Summed over segments this bounds the score from both sides.
Pairs whose bounds cannot matter are left at four segments; the others are looked at with
eight and sixteen, and only what is still open is scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.session import materialize

#: Segments of a vector, from coarse to fine.
LEVELS = (4, 8, 16)
#: Vectors and anchors that meet in one group of work, at most, and the vectors a group is
#: worth its own results for: every group hands back the best it has for each anchor.
CELL_ROWS, CELL_ANCHORS, CELL_LEAST = 32_768, 8_192, 1_024
#: Vectors and anchors compared at a time inside a group.
_ROWS, _ANCHORS, _PAIRS = 2_048, 256, 1 << 18
#: Components are held within this, so that sums of products stay exact longs.
LARGEST = 1 << 27
SCALE = 256.0

_VECTOR = "vec_id bigint, label int, q binary, mean binary, dev binary"


def _summaries(width: int):
    """Integer components, and mean and deviation of their finest segments."""
    length = width // LEVELS[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            sizes = np.asarray(lists.value_lengths(), np.int64)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            q = np.zeros((batch.num_rows, width), np.int64)
            at = np.arange(values.size) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            # Clipped first: far beyond the limit a product might overflow to infinity.
            x = np.clip(values, -LARGEST, LARGEST)
            q[np.repeat(np.arange(sizes.size), sizes), at] = np.clip(np.floor(x * SCALE), -LARGEST, LARGEST)
            parts = q.reshape(len(q), LEVELS[-1], length).astype(np.float64)
            mean = parts.mean(axis=2)
            dev = np.sqrt(((parts - mean[:, :, None]) ** 2).sum(axis=2))
            rows = [pa.array([r.tobytes() for r in a], pa.binary()) for a in (q.astype(np.int32), mean, dev)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), *rows], ["vec_id", "label", "q", "mean", "dev"]
            )

    return run


def summarise(vectors: DataFrame) -> DataFrame:
    """(row, vec_id, label, q, mean, dev) of the vectors that take part.

    Rows with a null label, a null vector or any null or non-finite component take no
    part. Vectors of different length are filled up with zeros, which changes no score.
    ``row`` numbers the rows; it tells rows with one vec_id apart.
    """
    slim = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("int").alias("label"), "embedding"
    )
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    slim = slim.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    longest = slim.agg(F.max(F.size("embedding"))).first()[0] or 1
    width = -(-longest // LEVELS[-1]) * LEVELS[-1]
    made = slim.mapInArrow(_summaries(width), _VECTOR)
    return materialize(made.withColumn("row", F.monotonically_increasing_id()), "vectors")


@dataclass
class _Vectors:
    ids: np.ndarray
    no_id: np.ndarray
    row: np.ndarray
    label: np.ndarray
    q: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, table: pa.Table) -> _Vectors:
        def stacked(name: str, kind: type) -> np.ndarray:
            return np.stack([np.frombuffer(x, kind) for x in table.column(name).to_pylist()])

        ids = table.column("vec_id").combine_chunks()
        q, mean, dev = stacked("q", np.int32), stacked("mean", np.float64), stacked("dev", np.float64)
        length = q.shape[1] // LEVELS[-1]
        # Kept as mean * sqrt(length): then a segment's share of the score is one product.
        levels = [(mean * np.sqrt(length), dev)]
        while levels[0][0].shape[1] > LEVELS[0]:
            fine, spread = levels[0]
            left, right = fine[:, ::2], fine[:, 1::2]
            joint = (left + right) / np.sqrt(2)
            off = np.sqrt(spread[:, ::2] ** 2 + spread[:, 1::2] ** 2 + (left - right) ** 2 / 2)
            levels.insert(0, (joint, off))
        return cls(
            ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False),
            table.column("row").to_numpy(), table.column("label").to_numpy(), q, levels,
        )

    def part(self, pick) -> _Vectors:
        return _Vectors(
            self.ids[pick], self.no_id[pick], self.row[pick], self.label[pick], self.q[pick],
            [(m[pick], d[pick]) for m, d in self.levels],
        )


class _Best:
    """The first ``k`` (score, id) of each slot: higher scores first, then smaller ids."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.floor = np.full(slots, -np.inf)  # score of the k-th, where there is one
        self.slot, self.score, self.ids = (np.zeros(0, np.int64) for _ in range(3))
        self.no_id = np.zeros(0, bool)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        slot, score = np.append(self.slot, slot), np.append(self.score, score)
        ids, no_id = np.append(self.ids, ids), np.append(self.no_id, no_id)
        order = np.lexsort((ids, no_id, -score, slot))
        slot = slot[order]
        starts = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if slot.size else np.zeros(0, np.int64)
        rank = np.arange(slot.size) - np.repeat(starts, np.diff(np.append(starts, slot.size)))
        keep = rank < self.k
        self.slot, self.score, self.ids, self.no_id = (x[keep] for x in (slot, score[order], ids[order], no_id[order]))
        full = rank[keep] == self.k - 1
        self.floor[self.slot[full]] = self.score[full]


def _search(anchors: _Vectors, rows: _Vectors, fits, open_pairs, found) -> int:
    """Refine all pairs that ``fits``, and hand exact scores to ``found``; how many were scored.

    ``open_pairs(i, low, high)`` tells which pairs, of anchors ``i``, may still matter if
    their scores lie within low and high.
    """
    scored = 0
    exact = np.int64 if np.abs(anchors.q).max(initial=0) * float(np.abs(rows.q).max(initial=0)) * rows.q.shape[1] >= 2**53 else np.float64
    a_norm, b_norm = (np.sqrt((x.q.astype(np.float64) ** 2).sum(axis=1)) for x in (anchors, rows))
    aq, bq = anchors.q.astype(exact), rows.q.astype(exact)
    # The first rows are few: what they score closes pairs of those that follow.
    edges, width = [0], max(1, _ROWS // 8)
    while edges[-1] < len(bq):
        edges.append(min(edges[-1] + width, len(bq)))
        width = min(2 * width, _ROWS)
    for b, end in zip(edges, edges[1:]):
        there = np.arange(b, end)
        for a in range(0, len(aq), _ANCHORS):
            here = np.arange(a, min(a + _ANCHORS, len(aq)))
            # Rounding moves a bound by far less than this share of the vectors' lengths.
            slack = 1e-9 * a_norm[here][:, None] * b_norm[there] + 1e-6
            (am, ad), (bm, bd) = anchors.levels[0], rows.levels[0]
            middle = am[here] @ bm[there].T
            reach = ad[here] @ bd[there].T + slack
            wanted = fits(here, there) & open_pairs(here[:, None], middle - reach, middle + reach)
            every_i, every_j = np.nonzero(wanted)
            for at in range(0, every_i.size, _PAIRS):
                i, j = here[every_i[at : at + _PAIRS]], there[every_j[at : at + _PAIRS]]
                for (am, ad), (bm, bd) in zip(anchors.levels[1:], rows.levels[1:]):
                    middle = np.einsum("ij,ij->i", am[i], bm[j])
                    reach = np.einsum("ij,ij->i", ad[i], bd[j]) + 1e-9 * a_norm[i] * b_norm[j] + 1e-6
                    still = open_pairs(i, middle - reach, middle + reach)
                    i, j = i[still], j[still]
                scored += i.size
                found(i, j, np.einsum("ij,ij->i", aq[i], bq[j]).astype(np.int64))
    return scored


def _longest_first(rows: _Vectors) -> _Vectors:
    """Long vectors make high scores, which close most other pairs early."""
    return rows.part(np.argsort(-np.abs(rows.q.astype(np.float64)).sum(axis=1), kind="stable"))


def _positives(k: int):
    schema = pa.schema([("anchor", pa.int64()), ("positive_score", pa.int64()), ("positive_id", pa.int64())])

    def run(anchor_table: pa.Table, row_table: pa.Table) -> pa.Table:
        if not anchor_table.num_rows or not row_table.num_rows:
            return schema.empty_table()
        anchors, rows = _Vectors.of(anchor_table), _longest_first(_Vectors.of(row_table))
        best = _Best(len(anchors.q), k)

        def fits(i, j):
            same = anchors.label[i][:, None] == rows.label[j]
            return same & (anchors.row[i][:, None] != rows.row[j])

        _search(
            anchors, rows, fits, lambda i, low, high: high >= best.floor[i],
            lambda i, j, score: best.add(i, score, rows.ids[j], rows.no_id[j]),
        )
        ids = pa.array(best.ids, mask=best.no_id)
        return pa.Table.from_arrays([pa.array(anchors.row[best.slot]), pa.array(best.score), ids], schema=schema)

    return run


def _negatives(k: int, low_share: int, high_share: int):
    schema = pa.schema([("anchor", pa.int64()), ("place", pa.int32()), ("negative_score", pa.int64()), ("negative_id", pa.int64())])

    def run(anchor_table: pa.Table, row_table: pa.Table) -> pa.Table:
        if not anchor_table.num_rows or not row_table.num_rows:
            return schema.empty_table()
        anchors, rows = _Vectors.of(anchor_table), _longest_first(_Vectors.of(row_table))
        lists = [[p["positive_score"] for p in ps] for ps in anchor_table.column("positives").to_pylist()]
        places = max(map(len, lists))
        # Least and greatest score that a negative may have; none fits where there is no positive.
        least = np.full((len(lists), places), np.inf)
        most = np.full((len(lists), places), -np.inf)
        for i, scores in enumerate(lists):
            least[i, : len(scores)] = [-(-low_share * s // 100) for s in scores]
            most[i, : len(scores)] = [high_share * s // 100 for s in scores]
        best = _Best(least.size, k)

        def open_pairs(i, low, high):
            out = np.zeros(low.shape, bool)
            for p in range(places):
                floor = np.maximum(least[:, p], best.floor[p::places])
                out |= (high >= floor[i]) & (low <= most[:, p][i])
            return out

        def found(i, j, score):
            for p in range(places):
                hit = (score >= least[i, p]) & (score <= most[i, p]) & (score >= best.floor[i * places + p])
                best.add(i[hit] * places + p, score[hit], rows.ids[j[hit]], rows.no_id[j[hit]])

        _search(anchors, rows, lambda i, j: anchors.label[i][:, None] != rows.label[j], open_pairs, found)
        return pa.Table.from_arrays(
            [pa.array(anchors.row[best.slot // places]), pa.array((best.slot % places).astype(np.int32)),
             pa.array(best.score), pa.array(best.ids, mask=best.no_id)],
            schema=schema,
        )

    return run


def _ranked(found: DataFrame, owner: list[str], score: str, other: str, k: int) -> DataFrame:
    """Number 1..k the best of what all groups of work found for each owner."""
    order = Window.partitionBy(*owner).orderBy(F.desc(score), F.asc_nulls_last(other))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine_negatives(
    vectors: DataFrame,
    is_anchor: str = "vec_id % 100 = 0",
    positives: int = 5,
    negatives: int = 10,
    low_share: int = 30,
    high_share: int = 90,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` holds vec_id, label and embedding; other columns are not read. A component
    x counts as floor(256 * x), held within 2^27; a row's score is its inner product with
    the anchor. An anchor's positives are its first other rows of the same label, by
    falling score, then vec_id. For each of them the first rows of another label are
    returned whose score is within ``low_share`` and ``high_share`` per cent of the
    positive's (a positive with a negative score has none).

    Rows with a null label, a null vector, or a null or non-finite component take no part.
    A null vec_id makes no anchor and comes after all others among ties. Rows that share a
    vec_id are rows of their own: each may be an anchor and a positive of the other. An
    empty vector scores 0. Empty table, or no anchor: no rows.

    Vectors and anchors are dealt into groups by a hash of the row; every anchor group
    meets every group of vectors once, so nothing is broadcast, a group's size is bounded
    and no key of the data decides where rows go. Per anchor, a group returns no more than
    the rows asked for.
    """
    spark = vectors.sparkSession
    rows = summarise(vectors)
    chosen = rows.where(is_anchor)
    n, n_anchors = rows.count(), chosen.count()
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row_groups = max(1, -(-n // CELL_ROWS), min(wide, -(-n // CELL_LEAST)))
    anchor_groups = max(1, -(-n_anchors // CELL_ANCHORS))

    def dealt(side: DataFrame, own: str, groups: int, other: str, others: int) -> DataFrame:
        placed = side.withColumn(own, F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))).groupBy("_a", "_r")

    def all_rows():
        return dealt(rows, "_r", row_groups, "_a", anchor_groups)

    def all_anchors(side: DataFrame):
        return dealt(side, "_a", anchor_groups, "_r", row_groups)

    near = all_anchors(chosen).cogroup(all_rows()).applyInArrow(
        _positives(positives), "anchor bigint, positive_score bigint, positive_id bigint"
    )
    near = _ranked(near, ["anchor"], "positive_score", "positive_id", positives)
    lists = near.groupBy("anchor").agg(
        F.array_sort(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("positives")
    )
    asked = materialize(chosen.join(lists, F.col("row") == F.col("anchor")).drop("anchor"), "anchors")
    far = all_anchors(asked).cogroup(all_rows()).applyInArrow(
        _negatives(negatives, low_share, high_share),
        "anchor bigint, place int, negative_score bigint, negative_id bigint",
    )
    far = _ranked(far, ["anchor", "place"], "negative_score", "negative_id", negatives)
    known = asked.select(
        F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.posexplode("positives").alias("place", "p")
    )
    return far.join(known, ["anchor", "place"]).select(
        "anchor_id", F.col("p.positive_id").alias("positive_id"), "rank", "negative_id",
        F.col("p.positive_score").alias("positive_score"), "negative_score",
    )
