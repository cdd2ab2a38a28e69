"""Similarity join on word shingles, by prefixes of MinHash values in several trees.

A forest would keep each tree sorted and shorten a text's prefixes by what it has matched so
far. That choice is not free: how much a text matches depends on the very partner that is
sought. If a text may keep its full prefix in the three trees in which it meets most, a pair
at 0.8 that meets in three trees or fewer of 24 at depth 6 (one in ten) is lost unless it
agrees in all eight values of one. So all trees are cut at one depth, the longest at which
the wanted recall holds for every pair, before any text is looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.components import components
from larkspur.llm.scan import Words, mix, runs, slices, stream, within
from larkspur.session import materialize

SHINGLE = 5
#: A pair is a link when ``intersection / union >= LINK[0] / LINK[1]``.
LINK = (4, 5)
#: Similarity to its pivot from which on a text is put into the pivot's cluster. It only
#: decides which texts are compared together, not which are linked.
LOOSE = (3, 5)
#: Texts of one cluster that are compared with those of another at a time.
BLOCK = 256
TREES, FULL_DEPTH, RECALL = 24, 8, 0.999
_BITS = TREES * FULL_DEPTH
_LONGS = _BITS // 64


def prefix_depth(similarity: float, trees: int = TREES, full: int = FULL_DEPTH, recall: float = RECALL) -> int:
    """Longest prefix at which a pair of that similarity meets in some tree with ``recall``."""
    for depth in range(full, 1, -1):
        if 1 - (1 - similarity**depth) ** trees >= recall:
            return depth
    return 1


def shingles(words: Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words, text by text, and how many each text has.

    A text of fewer words has one shingle, of all its words; one without words none.
    """
    hashes = words.hashes()
    at, sizes = within(words.first, k)
    values = runs(hashes, k)[at]
    counts = np.diff(words.first)
    for m in range(1, k):
        short = np.flatnonzero(counts == m)
        if short.size:
            place = (np.cumsum(sizes) - sizes)[short]
            values = np.insert(values, place, runs(hashes, m, seed=m)[words.first[short]])
            sizes[short] = 1
    return values, sizes


def different(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values of each text, text by text, and how many each has."""
    text = np.repeat(np.arange(sizes.size), sizes)
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    new = np.ones(values.size, bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    return values[new], np.bincount(text[new], minlength=sizes.size)


def _signatures(shallow: int):
    multipliers, shifts = stream(7, _BITS) | np.uint64(1), stream(8, _BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            # Sizes of sets: repeats would make their ratio no bound on the similarity.
            values, sizes = different(*shingles(Words(batch.column("text"))))
            own = np.flatnonzero(sizes)
            if not own.size:
                continue
            starts = (np.cumsum(sizes) - sizes)[own]
            least = np.empty((own.size, _BITS), np.uint64)
            room = np.empty_like(values)
            for i in range(_BITS):
                np.multiply(values, multipliers[i], out=room)
                np.add(room, shifts[i], out=room)
                least[:, i] = np.minimum.reduceat(room, starts)
            bits = np.packbits((mix(least) >> np.uint64(63)).astype(np.uint8), axis=1)
            sketch = bits.view(">i8").astype(np.int64)
            tries = []
            for tree in range(TREES):
                key = np.full(own.size, tree + 1, np.uint64)
                for depth in range(shallow):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + least[:, tree * FULL_DEPTH + depth])
                tries.append(key)
            lists = pa.FixedSizeListArray.from_arrays(
                pa.array(np.column_stack(tries).view(np.int64).ravel()), TREES
            ).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(own)), pa.array(sizes[own].astype(np.int32)),
                 *(pa.array(np.ascontiguousarray(sketch[:, j])) for j in range(_LONGS)), lists],
                ["node", "n", *(f"s{j}" for j in range(_LONGS)), "tries"],
            )

    return run


def _agree(a: str, b: str) -> Column:
    """Bits in which two sketches agree."""
    return _BITS - sum(
        (F.bit_count(F.col(f"{a}.s{j}").bitwiseXOR(F.col(f"{b}.s{j}"))) for j in range(_LONGS)), F.lit(0)
    )


def _least_agreeing(similarity: Column | float) -> Column:
    """Agreeing bits below which a pair of that similarity falls with odds of some 1 in 10^6."""
    p = (F.lit(1.0) + similarity) / 2
    return _BITS * p - 4.7 * F.sqrt(_BITS * p * (1 - p) + 0.25)


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, both, either): sizes of intersection and union of the shingle sets of each pair."""
    first = texts.select(F.col("node").alias("a"), F.col("text").alias("text"))
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("other"))
    joined = pairs.select("a", "b").join(first, "a").join(second, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = []
            for name in ("text", "other"):
                values, sizes = shingles(Words(batch.column(name)))
                ends = np.cumsum(sizes)
                sets.append([np.unique(values[e - s : e]) for s, e in zip(sizes, ends)])
            both = np.array(
                [np.intersect1d(x, y, assume_unique=True).size for x, y in zip(*sets)], np.int64
            )
            either = np.array([x.size + y.size for x, y in zip(*sets)], np.int64) - both
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(both), pa.array(either)],
                ["a", "b", "both", "either"],
            )

    schema = "a bigint, b bigint, both bigint, either bigint"
    return joined.select("a", "b", "text", "other").mapInArrow(run, schema)


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between two blocks of texts: how many each node has, and whom it is connected to.

    A block is given by its nodes and their shingle sets. Sizes of intersections are a
    product of incidence matrices over the shingles that both blocks have, in parts.
    """
    def incidence(values: np.ndarray, row: np.ndarray, rows: int, known: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(known, values), known.size - 1)
        hit = known[at] == values
        out = np.zeros((rows, known.size), np.float32)
        out[row[hit], at[hit]] = 1
        return out

    for batch in batches:
        nodes, counts, ends = [], [], []
        for row in range(batch.num_rows):
            mine, theirs = batch.column("mine")[row].values, batch.column("theirs")[row].values
            x, y = mine.field("node").to_numpy(), theirs.field("node").to_numpy()
            lists = [side.field("shingles") for side in (mine, theirs)]
            size_a, size_b = (np.asarray(side.value_lengths(), np.int64) for side in lists)
            a, b = (side.flatten().to_numpy() for side in lists)
            row_a, row_b = np.repeat(np.arange(x.size), size_a), np.repeat(np.arange(y.size), size_b)
            known = np.intersect1d(a, b)
            both = np.zeros((x.size, y.size))
            part = max(1, (8 << 20) // (x.size + y.size))
            for at in range(0, known.size, part):
                piece = known[at : at + part]
                both += incidence(a, row_a, x.size, piece) @ incidence(b, row_b, y.size, piece).T
            either = size_a[:, None] + size_b[None, :] - both
            linked = (both * LINK[1] >= either * LINK[0]) & (x[:, None] != y[None, :]) & (both > 0)
            twice = batch.column("same")[row].as_py()  # one block with itself
            label = np.arange(x.size + (0 if twice else y.size))
            far = label.size

            def spread(links: np.ndarray, own: np.ndarray, other: np.ndarray) -> np.ndarray:
                return np.minimum(own, np.where(links, other[None, :], far).min(1, initial=far))

            while True:
                old = label
                left = spread(linked, label[: x.size], label if twice else label[x.size :])
                label = left if twice else np.append(left, spread(linked.T, label[x.size :], left))
                if (label == old).all():
                    break
            names = x if twice else np.append(x, y)
            count = linked.sum(1) if twice else np.append(linked.sum(1), linked.sum(0))
            nodes.append(names[count > 0])
            counts.append(count[count > 0])
            ends.append(names[label][count > 0])
        if nodes:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(nodes)), pa.array(np.concatenate(counts).astype(np.int64)), pa.array(np.concatenate(ends))],
                ["node", "links", "to"],
            )


def text_links(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """How many texts each is linked to, (node, links), and edges (a, b) that connect the
    classes, from (node, text).

    1. Every text enters ``TREES`` trees by a prefix of its MinHash values; a tree is a
       column of prefix hashes, its nodes are the groups of equal ones.
    2. The prefixes' length is the depth at which a pair of the sought similarity meets
       with probability ``RECALL``; it is the same in all trees.
    3. The least node of each group is its pivot, and each text is compared with one
       pivot, exactly. Texts half like one pivot form a cluster, so a group of thousands
       of near copies becomes few clusters without being paired. Clusters that meet in a
       group are joined where their sketches leave room for a link: 1 - Jaccard is a
       metric. So every link is inside a joined cluster.
    4. Joined clusters are compared with themselves in blocks. A comparison looks at whole
       shingle sets and gives a count and a class for each text, not the pairs. Their
       number is the square of the blocks of a group, not of its texts.
    """
    least = LINK[0] / LINK[1]
    shallow = prefix_depth(least)
    names = [f"s{j}" for j in range(_LONGS)]
    schema = f"node bigint, n int, {', '.join(f'{s} bigint' for s in names)}, tries array<bigint>"
    signed = materialize(texts.mapInArrow(_signatures(shallow), schema), "signatures")
    points = materialize(signed.select("node", "n", *names).dropDuplicates(["node"]), "points")

    rows = signed.select("node", F.explode("tries").alias("short"))
    shared = rows.groupBy("short").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    shared = shared.where("low != high").select("short")
    met = materialize(rows.join(shared, "short").distinct(), "met")
    wanted = met.select("node").distinct()
    bodies = materialize(texts.join(wanted, "node").dropDuplicates(["node"]), "bodies")

    groups = met.groupBy("short").agg(F.min("node").alias("pivot"), F.max("node").alias("high"))
    groups = groups.where("pivot != high").select("short", "pivot")
    near = met.join(groups, "short").where("node != pivot").select("node", "pivot").distinct()
    near = near.join(points.alias("x"), "node").join(
        points.withColumnRenamed("node", "pivot").alias("y"), "pivot"
    )
    # Sketches only choose the pivot; whether it holds is decided on the texts.
    loose = LOOSE[0] / LOOSE[1]
    fits = (_agree("x", "y") >= _BITS * (1 + loose) / 2) & (F.least("x.n", "y.n") >= F.greatest("x.n", "y.n") * loose)
    stars = near.where(fits).groupBy("node").agg(F.min("pivot").alias("b")).withColumnRenamed("node", "a")
    checked = materialize(verify(stars, bodies), "stars")
    close = checked.where(F.col("both") * LOOSE[1] >= F.col("either") * LOOSE[0])
    close = close.select(F.col("a").alias("node"), F.col("b").alias("pivot"), (1 - F.col("both") / F.col("either")).alias("far"))
    placed = wanted.join(close, "node", "left").withColumn("cluster", F.coalesce("pivot", "node"))
    members = materialize(placed.fillna(0.0, ["far"]).select("node", "cluster", "far"), "members")

    sizes = members.groupBy("cluster").agg(F.count("*").alias("size"), F.max("far").alias("radius"))
    sizes = materialize(sizes.join(points.withColumnRenamed("node", "cluster"), "cluster"), "sizes")
    at = met.join(members.select("node", "cluster"), "node").select("short", "cluster").distinct()
    several = at.groupBy("short").agg(F.min("cluster").alias("low"), F.max("cluster").alias("high"))
    at = at.join(several.where("low != high").select("short"), "short").join(sizes, "cluster")
    left, right = at.alias("x"), at.alias("y")
    room = F.greatest(F.lit(0.0), least - F.col("x.radius") - F.col("y.radius"))
    meets = left.join(
        right,
        (F.col("x.short") == F.col("y.short"))
        & (F.col("x.cluster") < F.col("y.cluster"))
        & (_agree("x", "y") >= _least_agreeing(room))
        & (F.least("x.n", "y.n") >= F.greatest("x.n", "y.n") * (room - 1e-9)),
    )
    meets = meets.select(F.col("x.cluster").alias("c"), F.col("y.cluster").alias("d")).distinct()
    joined = components(meets, "c", "d").withColumnRenamed("id", "cluster")
    placed = members.join(joined, "cluster", "left").select("node", F.coalesce("label", "cluster").alias("c"))
    placed = materialize(placed, "joined")
    split = placed.groupBy("c").agg(F.count("*").alias("size")).where("size > 1")
    split = split.select("c", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values, sizes = shingles(Words(batch.column("text")))
            ends = np.cumsum(sizes)
            lists = [np.unique(values[e - n : e].view(np.int64)) for n, e in zip(sizes, ends)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(lists, pa.list_(pa.int64()))], ["node", "shingles"]
            )

    held = placed.join(split, "c").join(bodies.mapInArrow(sets, "node bigint, shingles array<bigint>"), "node")
    held = held.groupBy("c", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("i")).agg(
        F.collect_list(F.struct("node", "shingles")).alias("mine")
    )
    held = materialize(held, "blocks")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    units = split.select("c", F.explode(every).alias("i"), "blocks").select("c", "i", F.explode(every).alias("j")).where("i <= j")
    theirs = held.select("c", F.col("i").alias("j"), F.col("mine").alias("theirs"))
    facing = units.join(held, ["c", "i"]).join(theirs, ["c", "j"])
    facing = facing.select(F.expr("i = j").alias("same"), "mine", "theirs")
    found = materialize(facing.mapInArrow(_block_links, "node bigint, links bigint, to bigint"), "links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    edges = found.select(F.col("node").alias("a"), F.col("to").alias("b"))
    return counts, edges


def join_similar(docs: DataFrame) -> DataFrame:
    """(doc_id, node, class_id, class_node, n_copies, n_links) for every row of (doc_id, text).

    Two texts are linked when the Jaccard similarity of their sets of five-word shingles
    is 0.8 or more; a class is a connected component of links, its id the least doc_id
    in it. ``n_copies`` counts the rows with the same text, ``n_links`` the different
    texts linked to it. ``node`` is a 64-bit hash that stands for the text.

    Links are found with a probability of ``RECALL`` at least each and all verified.
    Texts of under five words have one shingle, of all their words. Null counts as
    empty; texts without a word are linked to nothing, and equal ones are one class, as
    all equal texts are. Repeated rows are copies. Null ids stay null; a class with no
    other id has a null id. Empty table: no rows. Other columns are not read.
    """
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    hashed = docs.select("doc_id", body.alias("text")).withColumn("node", F.xxhash64("text"))
    counts, edges = text_links(hashed.select("node", "text"))
    labels = components(edges).select(F.col("id").alias("node"), "label")

    slim = hashed.select("doc_id", "node")
    nodes = slim.groupBy("node").agg(F.count("*").alias("n_copies"), F.min("doc_id").alias("least"))
    nodes = nodes.join(counts, "node", "left").join(labels, "node", "left")
    nodes = nodes.select(
        "node", "n_copies", "least", F.coalesce("label", "node").alias("class_node"),
        F.coalesce("links", F.lit(0).cast("long")).alias("n_links"),
    )
    nodes = materialize(nodes, "nodes")
    classes = nodes.groupBy("class_node").agg(F.min("least").alias("class_id"))
    named = nodes.join(classes, "class_node").drop("least")
    return slim.join(named, "node").select("doc_id", "node", "class_id", "class_node", "n_copies", "n_links")


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each class of :func:`join_similar`: the least doc_id, all columns as they are.

    Where the least id of a class is on several rows, the one with the least hash stays.
    """
    joined = materialize(join_similar(docs.select("doc_id", "text")), "classes")
    first = joined.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    first = first.groupBy("node", "doc_id", "class_node").agg(F.count("*").alias("_times"))
    rows = docs.select(F.struct("*").alias("_row"))
    node = F.xxhash64(F.coalesce(F.col("_row.text").cast("string"), F.lit("")))
    rows = rows.withColumn("_node", node)
    kept = rows.join(
        first, (rows["_node"] == first["node"]) & F.col("_row.doc_id").eqNullSafe(first["doc_id"])
    )
    per_class = first.groupBy("class_node").agg(F.sum("_times").alias("_rows"))
    kept = kept.join(per_class.withColumnRenamed("class_node", "_class"), F.col("class_node") == F.col("_class"))
    once = kept.where("_rows = 1").select("_row")
    # The hash is worked out here only: then both halves read the same shuffled rows.
    parts = [F.col("_row").getField(c) for c, kind in docs.dtypes if "map<" not in kind]
    again = kept.where("_rows > 1").groupBy("class_node").agg(F.min_by("_row", F.xxhash64(*parts)).alias("_row"))
    again = again.select("_row")
    return once.unionByName(again).select("_row.*")
