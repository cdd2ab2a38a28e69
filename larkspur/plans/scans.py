"""Source and sink queries. Text files are written from a whole table into a fresh
folder below the scratch folder, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators import relational, splits
from larkspur.plans import flows
from larkspur.plans.registry import query
from larkspur.session import materialize, scratch_path
from larkspur.sources import (
    apply_types,
    cached,
    drop_header_rows,
    read_delimited,
    read_wide,
    table,
    write_delimited,
    write_split,
)

_PART = ["p_partkey", "p_name", "p_brand", "p_size"]


def _export(spark: SparkSession, df: DataFrame, sep: str, header: bool) -> str:
    return write_delimited(df, scratch_path(spark, "export"), sep, header)


@query(
    "src_delimited_header",
    "SELECT event_id, event_type, value, props FROM events",
)
def src_delimited_header(spark: SparkSession, sf: str) -> DataFrame:
    """The JSON text column holds both the separator and quotes."""
    events = table(spark, sf, "events").select("event_id", "event_type", "value", "props")
    path = _export(spark, events, ",", header=True)
    schema = "event_id bigint, event_type string, value double, props string"
    return read_delimited(spark, path, ",", schema)


@query("src_delimited_raw", "SELECT p_partkey AS id, p_name AS title FROM part")
def src_delimited_raw(spark: SparkSession, sf: str) -> DataFrame:
    path = _export(spark, table(spark, sf, "part").select(*_PART), "|", header=False)
    schema = "id bigint, title string, brand string, size int"
    return read_delimited(spark, path, "|", schema, header=False).select("id", "title")


@query(
    "src_csv_all_string",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand,
           CAST(p_size AS VARCHAR) AS p_size
    FROM part
    """,
)
def src_csv_all_string(spark: SparkSession, sf: str) -> DataFrame:
    path = _export(spark, table(spark, sf, "part").select(*_PART), "\t", header=True)
    return read_delimited(spark, path, "\t")


@query(
    "src_generated_schema",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS f0, CAST(l_linenumber AS VARCHAR) AS f1,
           l_returnflag AS f2, l_linestatus AS f3
    FROM lineitem
    """,
)
def src_generated_schema(spark: SparkSession, sf: str) -> DataFrame:
    names = ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"]
    path = _export(spark, table(spark, sf, "lineitem").select(*names), ",", header=False)
    return read_wide(spark, path)


@query(
    "src_rows_to_df",
    """
    SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_totalprice,
           TRY_CAST(o_orderstatus AS INTEGER) AS o_orderstatus, o_orderpriority
    FROM orders
    """,
)
def src_rows_to_df(spark: SparkSession, sf: str) -> DataFrame:
    names = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]
    path = _export(spark, table(spark, sf, "orders").select(*names), ",", header=True)
    kinds = ["bigint", "int", "double", "int", "string"]
    return apply_types(read_delimited(spark, path), dict(zip(names, kinds)))


@query(
    "src_cache",
    """
    SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice), 4) AS mean,
           round(count(*)::DOUBLE / (SELECT count(*) FROM orders), 4) AS share
    FROM orders GROUP BY o_orderstatus
    """,
)
def src_cache(spark: SparkSession, sf: str) -> DataFrame:
    """Two passes over one kept frame; only the finished statistics outlive it."""
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_totalprice")
    with cached(orders) as (kept,):
        total = kept.count()
        stats = kept.groupBy("o_orderstatus").agg(
            F.count("*").alias("n"),
            F.round(F.avg("o_totalprice"), 4).alias("mean"),
            F.round(F.count("*") / total, 4).alias("share"),
        )
        return materialize(stats, "stats")


@query("flt_header_rows", "SELECT p_partkey, p_name, p_brand, p_size FROM part")
def flt_header_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every part file brings a header line; read as data, all of them must go."""
    path = _export(spark, table(spark, sf, "part").select(*_PART), ",", header=True)
    lines = read_delimited(spark, path, header=False).toDF(*_PART)
    kinds = ["bigint", "string", "string", "int"]
    return apply_types(drop_header_rows(lines, _PART), dict(zip(_PART, kinds)))


@query(
    "snk_split_write",
    """
    SELECT event_id, user_id,
           CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) <= 10
                THEN 'test' ELSE 'base' END AS side
    FROM events
    """,
)
def snk_split_write(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    labelled = splits.split_nth_per_key(events, "user_id", ["ts", "event_id"], 1, 10)
    paths = write_split(labelled, scratch_path(spark, "split"), ["user_id", "event_id"])
    reader = spark.read.schema(events.schema)
    sides = [reader.parquet(p).withColumn("side", F.lit(s)) for s, p in paths.items()]
    return sides[0].unionByName(sides[1]).select("event_id", "user_id", "side")


@query(
    "snk_rating_sets",
    """
    WITH e AS (
        SELECT user_id, event_id, ((row_number() OVER (ORDER BY ts, event_id) - 1) * 5) // count(*) OVER () AS fold,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
        FROM events)
    SELECT 'u' || i AS "set", CASE WHEN fold = i - 1 THEN 'test' ELSE 'base' END AS side, user_id AS "user", event_id AS item
    FROM e, range(1, 6) r(i)
    UNION ALL SELECT 'ua', CASE WHEN n <= 10 THEN 'test' ELSE 'base' END, user_id, event_id FROM e
    UNION ALL SELECT 'ub', CASE WHEN n BETWEEN 11 AND 20 THEN 'test' ELSE 'base' END, user_id, event_id FROM e
    """,
)
def snk_rating_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Five folds and two per-user splits, written as named sets and read back."""
    columns = [F.col("user_id").alias("user"), F.col("event_id").alias("item"), "ts"]
    events = table(spark, sf, "events").select(*columns)
    path = scratch_path(spark, "sets")
    flows.write_rating_splits(events, path, ["ts", "item"])
    schema = "user bigint, item bigint, ts timestamp, `set` string, side string"
    return spark.read.schema(schema).parquet(path).select("set", "side", "user", "item")
