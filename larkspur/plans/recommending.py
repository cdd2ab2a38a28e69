"""Recommender queries.

Ratings are average ordered quantities per (customer, part). Factors depend on the random
start, so SQL cannot have them. The queries check them against the equations they must
solve and scores against products of factors, and SQL says for whom that must hold."""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.operators import evaluate, recommend
from larkspur.operators.relational import lookup
from larkspur.plans import flows
from larkspur.plans.registry import query
from larkspur.session import materialize, scratch_path
from larkspur.sources import load_or_fit, save_model, table

_RATING_SQL = """
    rating AS (
        SELECT CAST(o_custkey AS INTEGER) AS "user", CAST(l_partkey AS INTEGER) AS item,
               avg(l_quantity) / 10 AS rating
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)
"""


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    """(user, item, rating), the rows of a user side by side: what is written and what a fit
    and scoring shuffle of them then holds each user's id once, compressed."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("int").alias("user"))
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_partkey").cast("int").alias("item"), "l_quantity"
    )
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    rated = joined.repartition("user").groupBy("user", "item").agg((F.avg("l_quantity") / 10).alias("rating"))
    return rated.sortWithinPartitions("user", "item")


def _asked_users(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'")
    return customers.select(F.col("c_custkey").cast("int").alias("user"))


def _asked_items(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").filter("p_brand = 'Brand#7'")
    return parts.select(F.col("p_partkey").cast("int").alias("item"))


_RANKS = "(SELECT unnest(range(1, 11))::INTEGER AS rank)"
_RANKED_USERS = f"""
    (SELECT DISTINCT r."user" FROM rating r JOIN customer ON r."user" = c_custkey
     WHERE c_mktsegment = 'BUILDING'), {_RANKS}
"""
_RANKED_ITEMS = f"""
    (SELECT DISTINCT item FROM rating JOIN part ON item = p_partkey
     WHERE p_brand = 'Brand#7'), {_RANKS}
"""


def _checked(ranked: DataFrame, model: ALSModel, owner: str, other: str) -> DataFrame:
    """Owner and rank, whether the scores fall with the rank, and whether each is the
    product of the two factor vectors."""
    previous = F.lag("score").over(Window.partitionBy(owner).orderBy("rank"))
    falling = F.coalesce(F.col("score") <= previous, F.lit(True))
    sides = {"user": model.userFactors, "item": model.itemFactors}
    joined = ranked.withColumn("falling", falling)
    joined = joined.join(sides[owner].toDF(owner, "u"), owner).join(sides[other].toDF(other, "v"), other)
    near = F.abs(recommend.product("u", "v") - F.col("score")) < 1e-9 * (1 + F.abs("score"))
    return joined.select(owner, "rank", "falling", near.alias("is_product"))


#: What a user's normal equations may leave over, relative to their right side: factors are
#: solved and kept in single precision.
_LEFT_OVER = 1e-3


def _solved(model: ALSModel, residuals: DataFrame) -> DataFrame:
    users = model.userFactors.select(F.col("id").alias("user"), F.size("features").alias("n_factors"))
    return users.join(residuals, "user").select("user", "n_factors", (F.col("residual") < _LEFT_OVER).alias("solved"))


@query(
    "rec_fit_als",
    f'WITH {_RATING_SQL} SELECT DISTINCT "user", 10 AS n_factors, true AS solved FROM rating',
)
def rec_fit_als(spark: SparkSession, sf: str) -> DataFrame:
    """Every user with its factors' number, and whether they solve its normal equations."""
    rated = materialize(ratings(spark, sf), "ratings")
    model = recommend.fit_als(rated, rank=10, iterations=10, reg=0.01)
    return _solved(model, recommend.normal_residuals(model, rated, 0.01))


@query(
    "rec_fit_als_implicit",
    f'WITH {_RATING_SQL} SELECT DISTINCT "user", 5 AS n_factors, true AS solved FROM rating',
)
def rec_fit_als_implicit(spark: SparkSession, sf: str) -> DataFrame:
    rated = materialize(ratings(spark, sf), "ratings")
    model = recommend.fit_als(rated, rank=5, iterations=10, reg=0.1, implicit=True)
    return _solved(model, recommend.normal_residuals(model, rated, 0.1, implicit=True))


@query(
    "rec_items_for_users",
    f'WITH {_RATING_SQL} SELECT "user", rank, true AS falling, true AS is_product FROM {_RANKED_USERS}',
)
def rec_items_for_users(spark: SparkSession, sf: str) -> DataFrame:
    model = recommend.fit_als(materialize(ratings(spark, sf), "ratings"), rank=5, reg=0.1)
    return _checked(recommend.recommend_items(model, _asked_users(spark, sf), 10), model, "user", "item")


@query(
    "rec_users_for_items",
    f"WITH {_RATING_SQL} SELECT item, rank, true AS falling, true AS is_product FROM {_RANKED_ITEMS}",
)
def rec_users_for_items(spark: SparkSession, sf: str) -> DataFrame:
    model = recommend.fit_als(materialize(ratings(spark, sf), "ratings"), rank=5, reg=0.1)
    return _checked(recommend.recommend_users(model, _asked_items(spark, sf), 10), model, "item", "user")


@query(
    "rec_best_products",
    """
    WITH v AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings),
    s AS (
        SELECT a.vec_id AS owner, b.vec_id AS other, list_dot_product(a.q, b.q) AS score FROM v a, v b WHERE a.label = 3)
    SELECT owner, CAST(row_number() OVER (PARTITION BY owner ORDER BY score DESC, other) AS INTEGER) AS rank, other, score
    FROM s QUALIFY row_number() OVER (PARTITION BY owner ORDER BY score DESC, other) <= 10
    """,
)
def rec_best_products(spark: SparkSession, sf: str) -> DataFrame:
    """The search itself by value: factors that SQL has too, here whole numbers, so that
    products are exact. The vectors of one label against all vectors."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), whole.alias("features"), "label")
    return recommend.best_products(vectors.where("label = 3").drop("label"), vectors.drop("label"), 10)


@query(
    "rec_describe",
    """
    WITH v AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings),
    s AS (
        SELECT a.vec_id AS owner, b.vec_id AS other, list_dot_product(a.q, b.q) AS score FROM v a, v b WHERE a.label = 5),
    r AS (
        SELECT *, row_number() OVER (PARTITION BY owner ORDER BY score DESC, other) AS rank FROM s
        QUALIFY row_number() OVER (PARTITION BY owner ORDER BY score DESC, other) <= 5)
    SELECT owner, CAST(rank AS INTEGER) AS rank,
           'user ' || owner || ', choice ' || rank || ': ' || coalesce(i.p_name, 'item ' || other) || ', score '
               || CAST(score AS BIGINT) AS for_user,
           'item ' || owner || ' (' || coalesce(o.p_name, 'untitled') || '), choice ' || rank || ': user ' || other
               || ', score ' || CAST(score AS BIGINT) AS for_item
    FROM r LEFT JOIN part i ON other = i.p_partkey LEFT JOIN part o ON owner = o.p_partkey
    """,
)
def rec_describe(spark: SparkSession, sf: str) -> DataFrame:
    """The best five for each owner in words, once as items for a user and once as users for
    an item. Scores are whole numbers, as in ``rec_best_products``."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), whole.alias("features"), "label")
    best = recommend.best_products(vectors.where("label = 5").drop("label"), vectors.drop("label"), 5)
    best = best.withColumn("score", F.col("score").cast("bigint"))
    titles = table(spark, sf, "part").select("p_partkey", "p_name")
    items = lookup(best.withColumnsRenamed({"owner": "user", "other": "item"}), titles, ("item", "p_partkey"), "p_name")
    items = items.select(F.col("user").alias("owner"), "rank", flows.items_sentence("p_name").alias("for_user"))
    users = lookup(best.withColumnsRenamed({"owner": "item", "other": "user"}), titles, ("item", "p_partkey"), "p_name")
    users = users.select(F.col("item").alias("owner"), "rank", flows.users_sentence("p_name").alias("for_item"))
    return items.join(users, ["owner", "rank"])


@query(
    "rec_predict_pair",
    f'WITH {_RATING_SQL} SELECT "user", item, true AS is_product FROM rating',
)
def rec_predict_pair(spark: SparkSession, sf: str) -> DataFrame:
    """A predicted rating is the product of the two factor vectors."""
    rated = materialize(ratings(spark, sf), "ratings")
    model = recommend.fit_als(rated, rank=5, reg=0.1)
    users = model.userFactors.toDF("user", "u")
    items = model.itemFactors.toDF("item", "v")
    # Scoring joins by user, then by item, and checks ids, so it deals the rows by user again;
    # sorted by user they are small. Scored rows lie by item, where the last join finds them.
    both = evaluate.score(model, rated.join(users, "user")).join(items, "item")
    product = recommend.product("u", "v")
    near = F.abs(product - F.col("prediction")) < 1e-4 * (1 + F.abs(product))
    return both.select("user", "item", near.alias("is_product"))


@query(
    "rec_with_titles",
    f'WITH {_RATING_SQL} SELECT "user", rank, true AS titled FROM {_RANKED_USERS}',
)
def rec_with_titles(spark: SparkSession, sf: str) -> DataFrame:
    model = recommend.fit_als(materialize(ratings(spark, sf), "ratings"), rank=5, reg=0.1)
    titles = table(spark, sf, "part").select("p_partkey", "p_name")
    named = recommend.recommend_named(
        model, _asked_users(spark, sf), titles, 10, "user", "p_partkey", "p_name"
    )
    return named.select("user", "rank", F.col("p_name").isNotNull().alias("titled"))


@query(
    "rec_users_with_titles",
    f"""WITH {_RATING_SQL} SELECT item, rank, p_name FROM {_RANKED_ITEMS} JOIN part ON item = p_partkey""",
)
def rec_users_with_titles(spark: SparkSession, sf: str) -> DataFrame:
    """The users for an item, with the item's title."""
    model = recommend.fit_als(materialize(ratings(spark, sf), "ratings"), rank=5, reg=0.1)
    titles = table(spark, sf, "part").select("p_partkey", "p_name")
    named = recommend.recommend_named(
        model, _asked_items(spark, sf), titles, 10, "item", "p_partkey", "p_name"
    )
    return named.select("item", "rank", "p_name")


@query(
    "snk_model_save_load",
    f'WITH {_RATING_SQL} SELECT "user", item, true AS same FROM rating',
)
def snk_model_save_load(spark: SparkSession, sf: str) -> DataFrame:
    """A stored model scores like the one it was made from."""
    rated = materialize(ratings(spark, sf), "ratings")
    fitted = recommend.fit_als(rated, rank=5, reg=0.1)
    path = save_model(fitted, scratch_path(spark, "als"))
    loaded = load_or_fit(spark, path, ALSModel, lambda: recommend.fit_als(rated))
    # Both scorings read the ratings dealt by user, and leave them by item, where they meet.
    scored = evaluate.score(fitted, rated).unionByName(evaluate.score(loaded, rated))
    same = (F.count("*") == 2) & (F.min("prediction") == F.max("prediction"))
    return scored.groupBy("user", "item").agg(same.alias("same"))
