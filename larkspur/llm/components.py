"""Connected components by joins, for graphs far larger than the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.session import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, label) for every end of an edge; label is the least id of its component.

    Each round takes the least label among the neighbours, hands it on to the node
    that lent the present label, and replaces each label by the label of the node it
    names. Chains shorten at least by half a round; the number of rounds follows the
    logarithm of the longest one. Labels are aggregated before they are shuffled, so a
    node with very many neighbours costs one row per task. Rows with a null end or
    with equal ends add no edge; equal ends still name a node. No edges: no rows.
    """
    plain = edges.select(F.col(a).alias("id"), F.col(b).alias("to"))
    plain = plain.where(F.col("id").isNotNull() & F.col("to").isNotNull())
    both = plain.unionByName(plain.select(F.col("to").alias("id"), F.col("id").alias("to")))
    graph = materialize(both.distinct(), "edges")
    labels = materialize(
        graph.groupBy("id").agg(F.least("id", F.min("to")).alias("label")), "labels"
    )
    while True:
        near = (
            graph.join(labels.withColumnRenamed("id", "to"), "to")
            .groupBy("id")
            .agg(F.min("label").alias("near"))
        )
        seen = labels.join(near, "id").select(
            "id", F.col("label").alias("old"), F.least("label", "near").alias("new")
        )
        offers = seen.select(
            F.explode(
                F.array(
                    F.struct(F.col("id"), F.col("old"), F.col("new")),
                    F.struct(F.col("old").alias("id"), F.lit(None).alias("old"), F.col("new")),
                )
            ).alias("o")
        ).select("o.*")
        hung = offers.groupBy("id").agg(F.min("old").alias("old"), F.min("new").alias("new"))
        roots = hung.select(F.col("id").alias("new"), F.col("new").alias("root"))
        jumped = materialize(
            hung.join(roots, "new").select("id", "old", F.col("root").alias("label")), "labels"
        )
        labels = jumped.select("id", "label")
        if jumped.where(F.col("old") != F.col("label")).isEmpty():
            return labels
