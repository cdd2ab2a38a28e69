"""Prefix trie of many sequences, built by halving their depth.

Depths are cut in half again and again. In a block of 2^j depths, the prefix that ends the
upper half has a name, and the lower half's prefixes are named below it: name of the cut
prefix and name inside the lower half together. All blocks of one height are worked on in
one pass, upper tries and lower forests alike, so a sequence of n elements takes log2(n)
passes and none of them walks along a sequence. Totals go the other way: what the roots of
a lower forest hold is grafted onto their ancestors in the upper trie of the block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators.ordering import nth_per_key
from larkspur.session import materialize

NOTHING = hashlib.sha256(b"").hexdigest()


def digest(*parts: Column) -> Column:
    """32 bytes that stand for a list of texts or bytes."""
    sized = [F.concat(F.octet_length(p).cast("string").cast("binary"), F.lit(b":"), p.cast("binary")) for p in parts]
    return F.unhex(F.sha2(F.concat(*sized), 256))


def number_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, name, n_bytes): turns numbered from 1, without their texts.

    Turns go by ``turn``, null first; equal ones by the digest of role and text. Null role
    or text becomes empty. Rows without a conv_id, or with one that is no whole number,
    belong to no conversation. Repeated rows are turns of their own.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    slim = conversations.select(
        F.col("conv_id").try_cast("bigint").alias("conv_id"), "turn",
        digest(role, text).alias("name"), F.octet_length(text).cast("bigint").alias("n_bytes"),
    ).where(F.col("conv_id").isNotNull())
    return nth_per_key(slim, "conv_id", ["turn", "name"], "depth").select("conv_id", "depth", "name", "n_bytes")


def name_prefixes(elements: DataFrame, tallest: int) -> DataFrame:
    """``elements`` with names that stand for the whole prefix down to each depth."""
    at, span, bits = F.col("depth") - 1, 1, 1
    named = elements
    while span < tallest:
        block = F.shiftright(at, bits).alias("block")
        lower = named.where(at.bitwiseAND(F.lit(span)) != 0).withColumn("block", block)
        cut = named.where(at.bitwiseAND(F.lit(2 * span - 1)) == span - 1)
        cut = cut.select("conv_id", block, F.col("name").alias("above"))
        below = lower.join(cut, ["conv_id", "block"]).select(
            "conv_id", "depth", F.unhex(F.sha2(F.concat("above", "name"), 256)).alias("name"), "n_bytes"
        )
        upper = named.where(at.bitwiseAND(F.lit(span)) == 0)
        named = materialize(upper.unionByName(below), "prefixes")
        span, bits = 2 * span, bits + 1
    return named


def graft_totals(totals: DataFrame, paths: DataFrame, tallest: int, sums: list[str]) -> DataFrame:
    """Sum each node's ``sums`` over its subtree; ``totals`` is (depth, node, sums).

    In blocks of growing height: the total of each root of a lower forest is added to its
    ancestors in the block's upper trie, which lie on the path of the sequence it is named by.
    """
    at, span, bits = F.col("depth") - 1, 1, 1
    added = [F.sum(c).alias(c) for c in sums]
    while span < tallest:
        block = F.shiftright(at, bits).alias("block")
        roots = totals.where(at.bitwiseAND(F.lit(2 * span - 1)) == span)
        roots = roots.select(F.col("node").alias("conv_id"), block, *sums)
        above = paths.where(at.bitwiseAND(F.lit(span)) == 0).withColumn("block", block)
        grafts = above.join(roots, ["conv_id", "block"]).groupBy("depth", "node").agg(*added)
        totals = materialize(totals.unionByName(grafts).groupBy("depth", "node").agg(*added), "totals")
        span, bits = 2 * span, bits + 1
    return totals


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one node's members, as text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        depth, node, member = (batch.column(c).to_numpy() for c in ("depth", "node", "conv_id"))
        new = np.flatnonzero((depth[1:] != depth[:-1]) | (node[1:] != node[:-1])) + 1
        first = np.append(0, new)
        texts = [",".join(map(str, m.tolist())) for m in np.split(member, new)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(depth[first]), pa.array(node[first]), pa.array(member[first]), pa.array(texts, pa.string())],
            ["depth", "node", "first", "ids"],
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of every node's joined chunks, which come in order."""
    key, state = None, None

    def out(rows: list[tuple]) -> pa.RecordBatch:
        depth, node, text = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(depth, pa.int64()), pa.array(node, pa.int64()), pa.array(text, pa.string())],
            ["depth", "node", "ends_sha256"],
        )

    for batch in batches:
        rows = []
        for depth, node, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "node", "ids"))):
            if (depth, node) == key:
                state.update(b",")
            else:
                if key is not None:
                    rows.append((*key, state.hexdigest()))
                key, state = (depth, node), hashlib.sha256()
            state.update(ids.encode())
        yield out(rows)
    if key is not None:
        yield out([(*key, state.hexdigest())])


def hash_members(ends: DataFrame) -> DataFrame:
    """(depth, node, ends_sha256) of (depth, node, conv_id).

    Ids are joined to text in ranges of (node, id). One hash over one list cannot be split,
    so a node's pieces of text then go through one task, a piece at a time.
    """
    order = ["depth", "node", "conv_id"]
    ranged = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = ranged.mapInArrow(_chunks, "depth bigint, node bigint, first bigint, ids string")
    dealt = pieces.repartition("depth", "node").sortWithinPartitions("depth", "node", "first")
    return dealt.mapInArrow(_hashed, "depth bigint, node bigint, ends_sha256 string")


def prefix_trie(elements: DataFrame, members: DataFrame) -> DataFrame:
    """One row per node of the trie: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    ``elements`` is (conv_id, depth, name, n_bytes): each sequence's elements without gaps
    from depth 1, equal elements under equal names. ``members`` is (conv_id, n_turns), one
    row per sequence, those without elements included. A node is named by its smallest
    member; the root has depth 0 and no parent. ``n_leaves`` counts the childless nodes of
    the subtree, ``saved_tokens`` sums (n_convs - 1) * n_bytes over it, ``ends_sha256`` is
    the hash of the ids of the members that end at the node. No sequence: no rows.

    A prefix that a third of all sequences share is a group that is counted before it is
    shuffled, and one row of the joins that follow.
    """
    members = materialize(members.select("conv_id", "n_turns"), "members")
    root = members.agg(F.min("conv_id").alias("r"), F.count("*").alias("n"), F.max("n_turns").alias("t")).first()
    lowest, tallest = root["r"], root["t"] or 0
    named = name_prefixes(materialize(elements, "elements"), tallest)
    groups = named.groupBy("depth", "name").agg(
        F.min("conv_id").alias("node"), F.count("*").alias("n_convs"), F.max("n_bytes").alias("n_bytes")
    )
    groups = materialize(groups, "nodes")
    paths = named.select("conv_id", "depth", "name").join(groups.select("depth", "name", "node"), ["depth", "name"])
    paths = materialize(paths.select("conv_id", "depth", "node"), "paths")

    upper = paths.select(
        F.col("conv_id").alias("node"), (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent")
    )
    spark = members.sparkSession
    top = spark.range(1).where(F.lit(lowest is not None)).select(
        F.lit(0).cast("bigint").alias("depth"), F.lit(lowest).cast("bigint").alias("node"),
        F.lit(root["n"]).cast("bigint").alias("n_convs"), F.lit(0).cast("bigint").alias("n_bytes"),
        F.lit(None).cast("bigint").alias("parent"),
    )
    below = groups.drop("name").join(upper, ["node", "depth"], "left")
    below = below.withColumn("parent", F.when(F.col("depth") == 1, F.lit(lowest)).otherwise(F.col("parent")))
    nodes = materialize(below.unionByName(top), "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("node"))
    nodes = nodes.join(children.agg(F.count("*").alias("n_children")), ["depth", "node"], "left")
    nodes = materialize(nodes.fillna(0, ["n_children"]), "nodes")

    own = nodes.select(
        "depth", "node",
        (F.col("n_children") == 0).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"),
    )
    sums = ["n_leaves", "saved_tokens"]
    totals = graft_totals(own.where("depth > 0"), paths, tallest, sums)
    whole = totals.where("depth = 1").unionByName(own.where("depth = 0"))
    whole = whole.groupBy().agg(*[F.sum(c).alias(c) for c in sums], F.lit(0).cast("bigint").alias("depth"))
    whole = whole.withColumn("node", F.lit(lowest).cast("bigint"))
    totals = totals.unionByName(whole.where(F.col("node").isNotNull()).select("depth", "node", *sums))

    last = paths.select("conv_id", F.col("depth").alias("n_turns"), "node")
    ends = members.join(last, ["conv_id", "n_turns"], "left").select(
        "conv_id", F.col("n_turns").cast("bigint").alias("depth"), F.coalesce("node", F.lit(lowest).cast("bigint")).alias("node")
    )
    found = nodes.join(totals, ["depth", "node"]).join(hash_members(ends), ["depth", "node"], "left")
    return found.select(
        F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs",
        "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )
