"""Feature preparation and split queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators import features, splits
from larkspur.operators.relational import group_count
from larkspur.plans import sqltext
from larkspur.plans.inputs import NUMERIC
from larkspur.plans.registry import query
from larkspur.sources import table

_ROUNDED = ", ".join(
    f"round(CASE WHEN s{i} > 0 THEN ({c} - m{i}) / s{i} ELSE 0 END, 6) AS f{i}"
    for i, c in enumerate(NUMERIC)
)
_MOMENTS = ", ".join(
    f"avg({c}) AS m{i}, stddev_samp({c}) AS s{i}" for i, c in enumerate(NUMERIC)
)
_INDEXED_SOURCE = """
    indexed AS (
        SELECT source, row_number() OVER (ORDER BY count(*) DESC, source) - 1 AS i
        FROM documents GROUP BY source)
"""


def _unpacked(df: DataFrame, column: str, n: int, digits: int | None = None) -> DataFrame:
    """Line keys and the vector's slots as columns."""
    slots = [F.col("_slots")[i] for i in range(n)]
    if digits is not None:
        slots = [F.round(s, digits) for s in slots]
    keys = ("l_orderkey", "l_linenumber")
    opened = df.select(*keys, vector_to_array(column).alias("_slots"))
    return opened.select(*keys, *[s.alias(f"f{i}") for i, s in enumerate(slots)])


@query(
    "feat_string_index",
    f"WITH {_INDEXED_SOURCE} SELECT doc_id, CAST(i AS DOUBLE) AS source_index "
    "FROM documents JOIN indexed USING (source)",
)
def feat_string_index(spark: SparkSession, sf: str) -> DataFrame:
    """Categories are counted, ordered and joined on the cluster; the driver holds none."""
    documents = table(spark, sf, "documents").select("doc_id", "source")
    return features.index_frequencies(documents, "source").transform(documents).drop("source")


@query(
    "feat_one_hot",
    f"""
    WITH {_INDEXED_SOURCE}
    SELECT doc_id, CAST(slot AS INTEGER) AS slot, CAST(i = slot AS DOUBLE) AS indicator
    FROM documents JOIN indexed USING (source),
         (SELECT unnest(range((SELECT count(*) + 1 FROM indexed))) AS slot)
    """,
)
def feat_one_hot(spark: SparkSession, sf: str) -> DataFrame:
    """One slot per category and a last one for categories unseen in training."""
    documents = table(spark, sf, "documents").select("doc_id", "source")
    indexed = features.index_strings(documents, "source").transform(documents)
    encoded = features.one_hot(indexed, "source_index").transform(indexed)
    slots = F.posexplode(vector_to_array("source_index_vec")).alias("slot", "indicator")
    return encoded.select("doc_id", slots)


@query(
    "feat_assemble",
    """
    SELECT l_orderkey, l_linenumber, l_quantity AS f0, l_extendedprice AS f1, l_discount AS f2,
           l_tax AS f3
    FROM lineitem
    """,
)
def feat_assemble(spark: SparkSession, sf: str) -> DataFrame:
    assembled = features.assemble(table(spark, sf, "lineitem"), NUMERIC)
    return _unpacked(assembled, "features", 4)


@query(
    "feat_vector_index",
    """
    SELECT l_orderkey, l_linenumber, l_quantity AS f0,
           CAST(dense_rank() OVER (ORDER BY l_discount) - 1 AS DOUBLE) AS f1,
           CAST(dense_rank() OVER (ORDER BY l_tax) - 1 AS DOUBLE) AS f2
    FROM lineitem
    """,
)
def feat_vector_index(spark: SparkSession, sf: str) -> DataFrame:
    """Quantity has more than 24 values and stays; discount and tax become categories."""
    assembled = features.assemble(
        table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"]
    ).select("l_orderkey", "l_linenumber", "features")
    indexed = features.index_vectors(assembled).transform(assembled)
    return _unpacked(indexed, "indexed", 3)


@query(
    "feat_standardize",
    f"""
    WITH moments AS (
        SELECT {_MOMENTS} FROM lineitem WHERE {sqltext.below('l_orderkey', 7, 10)})
    SELECT l_orderkey, l_linenumber, {_ROUNDED} FROM lineitem, moments
    """,
)
def feat_standardize(spark: SparkSession, sf: str) -> DataFrame:
    """Moments come from the training part only and scale every row."""
    lines = splits.split_random(table(spark, sf, "lineitem"), "l_orderkey", {"train": 7, "test": 3})
    assembled = features.assemble(lines, NUMERIC)
    scaled = features.standardize(assembled.filter("split = 'train'")).transform(assembled)
    return _unpacked(scaled, "scaled", 4, 6)


@query(
    "split_random_2",
    f"""
    SELECT o_orderkey,
           CASE WHEN {sqltext.below('o_orderkey', 7, 10)} THEN 'train' ELSE 'test' END AS split
    FROM orders
    """,
)
def split_random_2(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey")
    return splits.split_random(orders, "o_orderkey", {"train": 7, "test": 3})


@query(
    "split_random_3",
    f"""
    SELECT CASE WHEN {sqltext.below('o_orderkey', 8, 10, '11:')} THEN 'train'
                WHEN {sqltext.below('o_orderkey', 9, 10, '11:')} THEN 'validation'
                ELSE 'test' END AS split, count(*) AS "count"
    FROM orders GROUP BY ALL
    """,
)
def split_random_3(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey")
    weights = {"train": 8, "validation": 1, "test": 1}
    return group_count(splits.split_random(orders, "o_orderkey", weights, seed=11), "split")


_NTH = "row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)"


@query(
    "split_nth_per_user",
    f"""
    SELECT event_id, user_id, CASE WHEN {_NTH} BETWEEN 11 AND 20 THEN 'test' ELSE 'base' END AS split
    FROM events
    """,
)
def split_nth_per_user(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return splits.split_nth_per_key(events, "user_id", ["ts", "event_id"], 11, 20).drop("ts")


@query(
    "split_nth_per_user_capped",
    f"""
    SELECT event_id, user_id,
           CASE WHEN n <= 10 AND row_number() OVER (PARTITION BY n <= 10 ORDER BY ts, event_id) <= 300
                THEN 'test' ELSE 'base' END AS split
    FROM (SELECT *, {_NTH} AS n FROM events)
    """,
)
def split_nth_per_user_capped(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    labelled = splits.split_nth_per_key(
        events, "user_id", ["ts", "event_id"], 1, 10, max_test=300
    )
    return labelled.drop("ts")


@query(
    "split_kfold_position",
    """
    SELECT event_id, CAST(((row_number() OVER (ORDER BY ts, event_id) - 1) * 5)
                          // (SELECT count(*) FROM events) AS INTEGER) AS fold
    FROM events
    """,
)
def split_kfold_position(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "ts")
    return splits.split_kfold(events, ["ts", "event_id"], 5).drop("ts")
