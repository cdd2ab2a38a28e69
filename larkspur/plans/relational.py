"""Projection, filter, join, aggregation, window, sort and function queries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions import (
    COVER_NAMES,
    RENTAL_MAXIMA,
    SEASON,
    WEATHER,
    WEEKDAY,
    abs_error,
    clean_numeric,
    decode,
    match_flag,
    sentence,
    split_fields,
    strip_quotes,
)
from larkspur.operators import ordering, prep, relational, splits
from larkspur.plans import flows
from larkspur.plans.inputs import NUMERIC, RENTAL_FEATURES, RENTALS_SQL, rentals
from larkspur.plans.registry import query
from larkspur.sources import register, table

# -- projections --------------------------------------------------------------


@query("prj_select", "SELECT o_orderkey, o_orderpriority, o_orderstatus, o_custkey FROM orders")
def prj_select(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderstatus", "o_custkey"
    )


@query("prj_computed", "SELECT p_partkey, p_brand, p_type, 2016 - p_size AS birthyear FROM part")
def prj_computed(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    return prep.with_expr(part, "birthyear", F.lit(2016) - F.col("p_size")).drop("p_size")


@query(
    "prj_cast_all",
    """
    SELECT o_orderkey,
           TRY_CAST(CAST(o_custkey AS VARCHAR) AS DOUBLE) AS o_custkey,
           TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) AS o_totalprice,
           TRY_CAST(o_orderpriority AS DOUBLE) AS o_orderpriority
    FROM orders
    """,
)
def prj_cast_all(spark: SparkSession, sf: str) -> DataFrame:
    names = ["o_custkey", "o_totalprice", "o_orderpriority"]
    orders = table(spark, sf, "orders").select("o_orderkey", *names)
    text = orders.withColumns({n: F.col(n).cast("string") for n in names})
    return prep.cast_columns(text, names, "double")


@query(
    "prj_missing_to_zero",
    """
    SELECT doc_id, source,
           CASE WHEN lang = 'de' THEN 0.0 ELSE CAST(n_chars AS DOUBLE) END AS n_chars
    FROM documents
    """,
)
def prj_missing_to_zero(spark: SparkSession, sf: str) -> DataFrame:
    size = F.when(F.col("lang") == "de", "?").otherwise(F.col("n_chars").cast("string"))
    dirty = table(spark, sf, "documents").select("doc_id", "source", size.alias("n_chars"))
    return prep.clean_columns(dirty, ["n_chars"])


@query(
    "prj_clamp_nonneg",
    """
    SELECT c_custkey,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN 0.0
                ELSE greatest(c_acctbal - 5000, 0.0) END AS balance
    FROM customer
    """,
)
def prj_clamp_nonneg(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("c_mktsegment") == "MACHINERY", "?").otherwise(
        (F.col("c_acctbal") - 5000).cast("string")
    )
    dirty = table(spark, sf, "customer").select("c_custkey", text.alias("balance"))
    return prep.clean_columns(dirty, ["balance"], floor=0.0)


@query("prj_drop", "SELECT event_id, user_id, event_type, value FROM events")
def prj_drop(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").drop("ts", "props")


@query(
    "prj_label_shift",
    "SELECT l_orderkey, l_suppkey, CAST(l_linenumber - 1 AS DOUBLE) AS label FROM lineitem",
)
def prj_label_shift(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber")
    typed = prep.cast_columns(lines, ["l_linenumber"], "double")
    return prep.with_expr(typed, "label", "l_linenumber - 1").drop("l_linenumber")


@query(
    "prj_rename",
    "SELECT p_partkey AS id, p_name AS title, p_brand AS brand, p_size AS size FROM part",
)
def prj_rename(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    return part.withColumnsRenamed(
        {"p_partkey": "id", "p_name": "title", "p_brand": "brand", "p_size": "size"}
    )


@query("prj_alias", "SELECT u.c_custkey, u.c_acctbal AS balance FROM customer AS u")
def prj_alias(spark: SparkSession, sf: str) -> DataFrame:
    users = table(spark, sf, "customer").alias("u")
    return users.select("u.c_custkey", F.col("u.c_acctbal").alias("balance"))


@query(
    "prj_positional_slice",
    "SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag AS label FROM lineitem",
)
def prj_positional_slice(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").drop("l_linestatus", "l_shipdate")
    features = prep.feature_columns(lines, start=4, stop=-1)
    return lines.select(*features, F.col(lines.columns[-1]).alias("label"))


@query(
    "prj_feature_subset",
    f"WITH {RENTALS_SQL} SELECT {', '.join(RENTAL_FEATURES)}, cnt FROM rentals",
)
def prj_feature_subset(spark: SparkSession, sf: str) -> DataFrame:
    hours = rentals(spark, sf)
    return hours.select(*prep.feature_columns(hours, RENTAL_FEATURES), "cnt")


@query(
    "prj_denormalize",
    f"""
    WITH {RENTALS_SQL}
    SELECT dteday, hr, round(temp * 41, 6) AS temp, round(atemp * 50, 6) AS atemp,
           round(hum * 100, 6) AS hum, round(windspeed * 67, 6) AS windspeed
    FROM rentals
    """,
)
def prj_denormalize(spark: SparkSession, sf: str) -> DataFrame:
    real = prep.denormalize(rentals(spark, sf), RENTAL_MAXIMA)
    return real.select("dteday", "hr", *[F.round(c, 6).alias(c) for c in RENTAL_MAXIMA])


# -- filters ------------------------------------------------------------------

_PICKED_LINES = """
    SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem
    WHERE l_returnflag = 'R' AND l_linestatus = 'O' AND l_quantity = 24
"""


@query("flt_conjunction", _PICKED_LINES)
def flt_conjunction(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return lines.filter(
        (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O") & (F.col("l_quantity") == 24)
    ).select("l_orderkey", "l_partkey", "l_suppkey")


@query("flt_chained", _PICKED_LINES)
def flt_chained(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    kept = lines.filter("l_returnflag = 'R'").filter("l_linestatus = 'O'").filter("l_quantity = 24")
    return kept.select("l_orderkey", "l_partkey", "l_suppkey")


@query(
    "flt_sql_string",
    """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE (o_orderstatus = 'F' OR o_orderpriority = '1-URGENT') AND NOT o_totalprice < 100000
    """,
)
def flt_sql_string(spark: SparkSession, sf: str) -> DataFrame:
    wanted = "(o_orderstatus = 'F' OR o_orderpriority = '1-URGENT') AND NOT o_totalprice < 100000"
    return table(spark, sf, "orders").filter(wanted).select("o_orderkey", "o_totalprice")


# -- joins --------------------------------------------------------------------


_CUSTOMERS_SQL = """(SELECT * REPLACE (
        CASE WHEN c_custkey % 10 = 0 THEN -1 ELSE c_nationkey END AS c_nationkey) FROM customer)"""


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    """All customers; every tenth names a nation that there is not, so that some match none."""
    key = F.expr("CASE WHEN c_custkey % 10 = 0 THEN -1 ELSE c_nationkey END")
    return table(spark, sf, "customer").withColumn("c_nationkey", key)


@query(
    "join_left_outer",
    f"""
    SELECT c_custkey, c_mktsegment, n_name, n_regionkey FROM {_CUSTOMERS_SQL}
    LEFT JOIN nation ON c_nationkey = n_nationkey
    """,
)
def join_left_outer(spark: SparkSession, sf: str) -> DataFrame:
    joined = relational.left_join(
        _customers(spark, sf), table(spark, sf, "nation"), [("c_nationkey", "n_nationkey")]
    )
    return joined.select("c_custkey", "c_mktsegment", "n_name", "n_regionkey")


@query(
    "join_left_then_filter_right",
    """
    SELECT u.c_custkey, u.c_acctbal, z.n_name, z.n_regionkey
    FROM customer u LEFT JOIN nation z ON u.c_nationkey = z.n_nationkey
    WHERE z.n_name = 'NATION_7'
    """,
)
def join_left_then_filter_right(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        """
        SELECT u.c_custkey, u.c_acctbal, z.n_name, z.n_regionkey
        FROM {users} u LEFT JOIN {places} z ON u.c_nationkey = z.n_nationkey
        WHERE z.n_name = 'NATION_7'
        """,
        users=table(spark, sf, "customer"),
        places=table(spark, sf, "nation"),
    )


@query(
    "join_mixed_type_key",
    """
    SELECT c_custkey, zip, n_name FROM (
        SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'T8H1N'
                               ELSE lpad(CAST(c_nationkey AS VARCHAR), 5, '0') END AS zip
        FROM customer)
    LEFT JOIN nation
      ON TRY_CAST(zip AS INTEGER) = n_nationkey
    """,
)
def join_mixed_type_key(spark: SparkSession, sf: str) -> DataFrame:
    zipcode = F.when(F.col("c_mktsegment") == "MACHINERY", "T8H1N").otherwise(
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0")
    )
    users = table(spark, sf, "customer").select("c_custkey", zipcode.alias("zip"))
    places = table(spark, sf, "nation")
    joined = relational.left_join(users, places, [("zip", "n_nationkey")], cast="int")
    return joined.select("c_custkey", "zip", "n_name")


@query(
    "join_lookup",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, p_name
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
    """,
)
def join_lookup(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return relational.lookup(lines, table(spark, sf, "part"), ("l_partkey", "p_partkey"), "p_name")


def _case(column: str, mapping: dict) -> str:
    arms = " ".join(f"WHEN {code} THEN '{text}'" for code, text in mapping.items())
    return f"CASE {column} {arms} END"


@query(
    "join_code_decode",
    f"""
    WITH {RENTALS_SQL}
    SELECT dteday, hr, {_case('season', SEASON)} AS season, {_case('weekday', WEEKDAY)} AS weekday,
           {_case('weathersit', WEATHER)} AS weather
    FROM rentals
    """,
)
def join_code_decode(spark: SparkSession, sf: str) -> DataFrame:
    return rentals(spark, sf).select(
        "dteday",
        "hr",
        decode("season", SEASON).alias("season"),
        decode("weekday", WEEKDAY).alias("weekday"),
        decode("weathersit", WEATHER).alias("weather"),
    )


# -- aggregations -------------------------------------------------------------


@query("agg_count", "SELECT count(*) AS counts FROM lineitem")
def agg_count(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").agg(F.count("*").alias("counts"))


@query(
    "agg_group_count_1",
    'SELECT l_returnflag, count(*) AS "count" FROM lineitem GROUP BY l_returnflag',
)
def agg_group_count_1(spark: SparkSession, sf: str) -> DataFrame:
    return relational.group_count(table(spark, sf, "lineitem"), "l_returnflag")


@query(
    "agg_group_count_2",
    """
    SELECT o_orderstatus, o_orderpriority, count(*) AS "count" FROM orders
    GROUP BY o_orderstatus, o_orderpriority ORDER BY o_orderstatus, o_orderpriority
    """,
)
def agg_group_count_2(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return relational.group_count(orders, ["o_orderstatus", "o_orderpriority"], order=True)


@query(
    "agg_reduce_by_key",
    """
    SELECT l_suppkey, CAST(sum(1) AS BIGINT) AS n_lines, CAST(sum(l_quantity) AS BIGINT) AS quantity
    FROM lineitem GROUP BY l_suppkey
    """,
)
def agg_reduce_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey")
        .agg(
            F.sum(F.lit(1)).alias("n_lines"),
            F.sum("l_quantity").cast("bigint").alias("quantity"),
        )
    )


@query("agg_distinct", "SELECT DISTINCT event_type, user_id FROM events")
def agg_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_type", "user_id").distinct()


@query(
    "agg_count_distinct",
    """
    SELECT count(DISTINCT l_partkey) AS l_partkey, count(DISTINCT l_suppkey) AS l_suppkey
    FROM lineitem
    """,
)
def agg_count_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return relational.count_distinct(table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"])


@query(
    "agg_crosstab",
    """
    SELECT o_orderpriority AS o_orderpriority_o_orderstatus,
           count(*) FILTER (o_orderstatus = 'F') AS "F",
           count(*) FILTER (o_orderstatus = 'O') AS "O",
           count(*) FILTER (o_orderstatus = 'P') AS "P"
    FROM orders GROUP BY o_orderpriority
    """,
)
def agg_crosstab(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return relational.crosstab(orders, "o_orderpriority", "o_orderstatus")


@query(
    "agg_join_group",
    f"""
    SELECT n_name, count(*) AS "count" FROM {_CUSTOMERS_SQL}
    LEFT JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name
    """,
)
def agg_join_group(spark: SparkSession, sf: str) -> DataFrame:
    return relational.join_group_count(
        _customers(spark, sf),
        table(spark, sf, "nation"),
        ("c_nationkey", "n_nationkey"),
        "n_name",
    )


@query(
    "agg_share_of_total",
    """
    SELECT event_type, count(*) AS "count",
           round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM events), 1) AS share
    FROM events GROUP BY event_type
    """,
)
def agg_share_of_total(spark: SparkSession, sf: str) -> DataFrame:
    return relational.group_share(table(spark, sf, "events"), "event_type")


@query(
    "agg_mean_std",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std"
        " FROM lineitem"
        for c in NUMERIC
    ),
)
def agg_mean_std(spark: SparkSession, sf: str) -> DataFrame:
    stats = relational.feature_stats(table(spark, sf, "lineitem"), NUMERIC)
    return stats.select("feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


# -- positions ----------------------------------------------------------------


@query(
    "win_running_count",
    """
    SELECT event_id, user_id,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
    FROM events
    """,
)
def win_running_count(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return ordering.nth_per_key(events, "user_id", ["ts", "event_id"]).drop("ts")


@query(
    "win_dense_index",
    """
    SELECT doc_id, source, i - 1 AS source_index FROM documents JOIN (
        SELECT source, row_number() OVER (ORDER BY source) AS i
        FROM (SELECT DISTINCT source FROM documents)) USING (source)
    """,
)
def win_dense_index(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.dense_index(table(spark, sf, "documents").select("doc_id", "source"), "source")


@query(
    "win_position_fold",
    """
    SELECT o_orderkey,
           CAST(((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) * 5)
                // (SELECT count(*) FROM orders) AS INTEGER) AS fold
    FROM orders
    """,
)
def win_position_fold(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return ordering.position_folds(orders, ["o_orderdate", "o_orderkey"], 5).drop("o_orderdate")


# -- order and limits ---------------------------------------------------------

_ORDER_COLUMNS = ("o_orderkey", "o_orderstatus", "o_totalprice")
_ORDERS_SORTED = f"SELECT {', '.join(_ORDER_COLUMNS)} FROM orders ORDER BY "


@query("sort_asc", _ORDERS_SORTED + "o_totalprice")
def sort_asc(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.sort_rows(table(spark, sf, "orders").select(*_ORDER_COLUMNS), "o_totalprice")


@query("sort_desc", _ORDERS_SORTED + "o_totalprice DESC")
def sort_desc(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(*_ORDER_COLUMNS)
    return ordering.sort_rows(orders, F.desc("o_totalprice"))


@query("sort_multi", _ORDERS_SORTED + "o_orderstatus DESC, o_totalprice ASC")
def sort_multi(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(*_ORDER_COLUMNS)
    return ordering.sort_rows(orders, F.desc("o_orderstatus"), F.asc("o_totalprice"))


@query("topk", _ORDERS_SORTED + "o_totalprice DESC, o_orderkey LIMIT 10")
def topk(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(*_ORDER_COLUMNS)
    return ordering.top_k(orders, 10, ordering.By("o_totalprice", falling=True), "o_orderkey")


@query("limit", _ORDERS_SORTED + "o_orderkey LIMIT 20")
def limit(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.top_k(table(spark, sf, "orders").select(*_ORDER_COLUMNS), 20, "o_orderkey")


@query(
    "set_complement",
    """
    SELECT event_id, user_id FROM (
        SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS position FROM events)
    WHERE (position * 5) // (SELECT count(*) FROM events) <> 0
    """,
)
def set_complement(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    folds = splits.split_kfold(events, ["ts", "event_id"], 5)
    _, base = relational.split_by(folds, F.col("fold") == 0)
    return base.select("event_id", "user_id")


# -- scalar functions ---------------------------------------------------------


@query(
    "fn_split",
    """
    SELECT split_part(line, '|', 1) AS id, split_part(line, '|', 2) AS name,
           split_part(line, '|', 3) AS kind
    FROM (SELECT concat_ws('|', p_partkey, p_name, p_type) AS line FROM part)
    """,
)
def fn_split(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    lines = part.select(F.concat_ws("|", F.col("p_partkey").cast("string"), "p_name", "p_type").alias("line"))
    fields = split_fields("line", "|", 3)
    return lines.select(*[f.alias(n) for f, n in zip(fields, ("id", "name", "kind"))])


@query("fn_replace", """SELECT event_id, replace(props, '"', '') AS props FROM events""")
def fn_replace(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", strip_quotes("props").alias("props"))


@query(
    "fn_cast",
    """
    SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS as_text,
           TRY_CAST(CAST(o_custkey AS VARCHAR) AS INTEGER) AS as_int,
           TRY_CAST(o_orderpriority AS INTEGER) AS not_a_number,
           CAST(o_totalprice AS FLOAT)::DOUBLE AS as_float
    FROM orders
    """,
)
def fn_cast(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("as_text"),
        F.col("o_custkey").cast("string").try_cast("int").alias("as_int"),
        F.col("o_orderpriority").try_cast("int").alias("not_a_number"),
        F.col("o_totalprice").cast("float").cast("double").alias("as_float"),
    )


@query(
    "fn_arith",
    """
    SELECT l_orderkey, l_suppkey, round(l_extendedprice * (1 - l_discount), 4) AS net,
           l_quantity - 1 AS fewer
    FROM lineitem
    """,
)
def fn_arith(spark: SparkSession, sf: str) -> DataFrame:
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_suppkey", F.round(net, 4).alias("net"), (F.col("l_quantity") - 1).alias("fewer")
    )


@query(
    "fn_abs_error",
    """
    SELECT l_orderkey, l_suppkey, abs(l_quantity - trunc(l_extendedprice / 2000)) AS error
    FROM lineitem
    """,
)
def fn_abs_error(spark: SparkSession, sf: str) -> DataFrame:
    error = abs_error("l_quantity", F.col("l_extendedprice") / 2000)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", error.alias("error"))


@query(
    "fn_match_flag",
    """
    SELECT l_orderkey, l_suppkey,
           CASE WHEN l_quantity = trunc(l_extendedprice / 2000) THEN '正确' ELSE '错误' END AS result
    FROM lineitem
    """,
)
def fn_match_flag(spark: SparkSession, sf: str) -> DataFrame:
    guess = (F.col("l_extendedprice") / 2000).cast("int")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_suppkey", match_flag("l_quantity", guess).alias("result")
    )


@query(
    "fn_describe_row",
    f"""
    WITH {RENTALS_SQL}
    SELECT cnt || ' rides in month ' || mnth || ' (' || {_case('season', SEASON)} || '), hour ' || hr
           || ', day ' || {_case('weekday', WEEKDAY)} || '; weather ' || {_case('weathersit', WEATHER)} AS description
    FROM rentals
    """,
)
def fn_describe_row(spark: SparkSession, sf: str) -> DataFrame:
    text = sentence(
        F.col("cnt"), " rides in month ", F.col("mnth"), " (", decode("season", SEASON), "), hour ", F.col("hr"),
        ", day ", decode("weekday", WEEKDAY), "; weather ", decode("weathersit", WEATHER),
    )
    return rentals(spark, sf).select(text.alias("description"))


_COVER = ["l_partkey", "l_suppkey", "l_linenumber", "l_orderkey", "l_suppkey + l_linenumber", "l_partkey % 360"]


@query(
    "fn_describe_cover",
    f"""
    SELECT l_orderkey, l_linenumber,
           {" || ".join(f"'{name} ' || ({of}) || ', '" for name, of in zip(COVER_NAMES.values(), _COVER))}
           || 'predicted kind ' || (l_suppkey % 7) || ', true kind ' || (l_partkey % 7) || ': '
           || CASE WHEN l_partkey % 7 = l_suppkey % 7 THEN '正确' ELSE '错误' END AS description
    FROM lineitem
    """,
)
def fn_describe_cover(spark: SparkSession, sf: str) -> DataFrame:
    """Six measurements, the predicted and the true kind of each row as a sentence."""
    measured = [F.expr(of).alias(name) for name, of in zip(COVER_NAMES, _COVER)]
    kinds = [F.expr("double(l_partkey % 7)").alias("label"), F.expr("double(l_suppkey % 7)").alias("prediction")]
    scored = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *measured, *kinds)
    named = scored.withColumnsRenamed(COVER_NAMES)
    return named.select("l_orderkey", "l_linenumber", flows.cover_sentence().alias("description"))


@query(
    "udf_scalar",
    """
    SELECT doc_id, CASE WHEN lang = 'de' THEN '0' ELSE CAST(n_chars AS VARCHAR) END AS by_udf,
           CASE WHEN lang = 'de' THEN 0.0 ELSE CAST(n_chars AS DOUBLE) END AS by_expression
    FROM documents
    """,
)
def udf_scalar(spark: SparkSession, sf: str) -> DataFrame:
    """A user function over Arrow batches beside the expression it is not needed for."""

    @F.pandas_udf("string")
    def question_to_zero(text: pd.Series) -> pd.Series:
        return text.mask(text == "?", "0")

    size = F.when(F.col("lang") == "de", "?").otherwise(F.col("n_chars").cast("string"))
    dirty = table(spark, sf, "documents").select("doc_id", size.alias("size"))
    return dirty.select(
        "doc_id",
        question_to_zero("size").alias("by_udf"),
        clean_numeric("size").alias("by_expression"),
    )


@query(
    "src_temp_view",
    "SELECT event_type, count(*) AS counts FROM events GROUP BY event_type",
)
def src_temp_view(spark: SparkSession, sf: str) -> DataFrame:
    register(table(spark, sf, "events"), "user_events")
    return spark.sql(
        "SELECT event_type, count(*) AS counts FROM user_events GROUP BY event_type"
    )
