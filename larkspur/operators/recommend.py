"""Collaborative filtering."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.operators.als import PackedALS
from larkspur.operators.ordering import with_position
from larkspur.operators.relational import lookup
from larkspur.session import materialize

#: The least and the most blocks, and ratings that one block is meant to hold. A half-step
#: sends a vector of factors once to each block that needs it, so what is shuffled grows with
#: the number of blocks until that reaches the ratings of a user; what a task holds shrinks.
LEAST_BLOCKS, BLOCK_RATINGS, MOST_BLOCKS = 6, 36_000_000, 1_000
#: Owners and others that meet in one group of the search for best products, and the blocks
#: of others that are looked at in its first round. An owner is sent once to each block that
#: is open to it and a block once to each group, so what is shuffled falls as both grow.
OWNERS, OTHERS, FIRST_BLOCKS = 8_192, 4_096, 2
#: Owners of a group whose scores are held at a time.
SCORED = 1_024
#: No rounding of a product of so many factors moves it by more than this share.
_SLACK = 1 + 1e-9


def als(
    rank: int = 10,
    iterations: int = 10,
    reg: float = 0.01,
    implicit: bool = False,
    seed: int = 0,
    blocks: int = 10,
) -> ALS:
    """Factorization of (user, item, rating); ids are integers.

    Text ids are numbered with ``dense_index`` first. ``blocks`` partitions users and
    items. The random start depends on it, so it is never taken from the cluster;
    :func:`fit_als` takes it from the number of ratings.
    """
    return PackedALS(
        rank=rank, maxIter=iterations, regParam=reg, implicitPrefs=implicit, seed=seed,
        numUserBlocks=blocks, numItemBlocks=blocks,
        userCol="user", itemCol="item", ratingCol="rating", coldStartStrategy="drop",
    )


def fit_als(ratings: DataFrame, blocks: int | None = None, **options) -> ALSModel:
    """Fit factors, in blocks that follow from the number of ratings alone."""
    if blocks is None:
        blocks = min(MOST_BLOCKS, max(LEAST_BLOCKS, -(-ratings.count() // BLOCK_RATINGS)))
    return als(blocks=blocks, **options).fit(ratings)


def product(left: str, right: str) -> Column:
    """Inner product of two factor vectors, in double precision."""
    parts = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(parts, F.lit(0.0), lambda total, x: total + x)


def normal_residuals(
    model: ALSModel, ratings: DataFrame, reg: float, implicit: bool = False, alpha: float = 1.0
) -> DataFrame:
    """(user, residual): how far each user's factors are from solving its normal equations.

    The last half-step of a fit solves, for every user, a least squares problem over the
    items rated. With A the sum of v v' and b the sum of rating * v over those items, the
    factors u satisfy (A + reg * n) u = b. For implicit ratings A also holds v v' of all
    items, and what is summed over the rated is alpha * |r| * v v' and, for ratings above 0,
    (1 + alpha * |r|) * v; n counts those. Every rating meets v and then u, and adds v (v'u)
    and its share of b where its user's rows already are; nothing is solved again.
    ``residual`` is the length of what is left over, relative to b's.
    """
    rank = model.rank
    users = model.userFactors.select(F.col("id").alias("user"), F.col("features").alias("u"))
    items = model.itemFactors.select(F.col("id").alias("item"), F.col("features").alias("v"))
    strength, liked = F.lit(alpha) * F.abs("rating"), F.col("rating") > 0
    in_gram = strength if implicit else F.lit(1.0)
    in_right = F.when(liked, 1 + strength).otherwise(0.0) if implicit else F.col("rating")

    def at(factors: str, i: int) -> Column:
        return F.col(factors)[i].cast("double")

    # Ratings are fitted in single precision.
    rated = ratings.select("user", "item", F.col("rating").cast("float").alias("rating"))
    rated = rated.join(items, "item").select("user", "rating", "v").join(users, "user")
    rated = rated.withColumn("rating", F.col("rating").cast("double"))
    shares = rated.select(
        "user", "u", "v", (product("u", "v") * in_gram).alias("pull"), in_right.alias("right"),
        (liked if implicit else F.lit(True)).alias("counts"),
    )
    sums = [F.sum(at("v", i) * F.col("pull")).alias(f"a{i}") for i in range(rank)]
    sums += [F.sum(at("v", i) * F.col("right")).alias(f"b{i}") for i in range(rank)]
    sums += [F.count_if("counts").alias("n"), F.first("u").alias("u")]
    grams = shares.groupBy("user").agg(*sums)
    if implicit:
        # Upper triangle of the symmetric sums only.
        cells = [(i, j) for i in range(rank) for j in range(i, rank)]
        cross = [F.sum(at("v", i) * at("v", j)).alias(f"a{i}_{j}") for i, j in cells]
        grams = grams.withColumn("all", materialize(items.agg(F.struct(*cross).alias("all")), "gram").scalar())

    def of_all(i: int) -> Column:
        if not implicit:
            return F.lit(0.0)
        return sum((F.col("all")[f"a{min(i, j)}_{max(i, j)}"] * at("u", j) for j in range(rank)), F.lit(0.0))

    left = [
        F.col(f"a{i}") + of_all(i) + F.lit(reg) * F.col("n") * at("u", i) - F.col(f"b{i}") for i in range(rank)
    ]
    size = F.sqrt(sum((F.col(f"b{i}") ** 2 for i in range(rank)), F.lit(0.0)))
    gap = F.sqrt(sum((x**2 for x in left), F.lit(0.0)))
    return grams.select("user", (gap / F.greatest(size, F.lit(1e-12))).alias("residual"))


def _first(slots: np.ndarray, scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` best of each slot: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -scores, slots))
    slots = slots[order]
    starts = np.flatnonzero(np.append(True, slots[1:] != slots[:-1]))
    rank = np.arange(slots.size) - np.repeat(starts, np.diff(np.append(starts, slots.size)))
    return order[rank < n]


def _matches(n: int):
    """The best of one block of others for a group of owners that are open for it."""
    schema = pa.schema([("owner", pa.int64()), ("other", pa.int64()), ("score", pa.float64())])

    def run(owners: pa.Table, others: pa.Table) -> pa.Table:
        if not owners.num_rows or not others.num_rows:
            return schema.empty_table()
        u = np.stack(owners.column("features").to_numpy()).astype(np.float64)
        v = np.stack(others.column("features").to_numpy()).astype(np.float64)
        ids, names = others.column("other").to_numpy(), owners.column("owner").to_numpy()
        floors, found = owners.column("floor").to_numpy(), []
        for at in range(0, len(u), SCORED):
            some, floor = u[at : at + SCORED], floors[at : at + SCORED]
            scores = np.zeros((len(some), len(v)))
            # Factor by factor: the same sum for equal vectors, wherever they lie.
            for a, b in zip(some.T, v.T):
                scores += a[:, None] * b
            if len(v) > n:
                floor = np.maximum(floor, np.partition(scores, len(v) - n, axis=1)[:, len(v) - n])
            i, j = np.nonzero(scores >= floor[:, None])
            if i.size:
                best = _first(i, scores[i, j], ids[j], n)
                i, j = i[best], j[best]
                columns = [pa.array(names[at + i]), pa.array(ids[j]), pa.array(scores[i, j])]
                found.append(pa.Table.from_arrays(columns, schema=schema))
        return pa.concat_tables([schema.empty_table(), *found])

    return run


def best_products(owners: DataFrame, others: DataFrame, n: int = 10) -> DataFrame:
    """(owner, rank, other, score): the ``n`` largest inner products of each owner, exactly.

    Both sides are (id, features); an id given twice counts once, and features are not null.
    Higher scores come first, ties by smaller id. Fewer than ``n`` others: as many ranks as
    there are. No owners or no others: no rows.

    The others are put in blocks by falling length. The first round looks at the blocks of
    the longest ones. From then on every owner has an n-th best score, and by the bound of
    Cauchy and Schwarz a block can only matter to owners whose own length times that of the
    block's longest vector reaches it. Rounds double in width and end when no owner is open;
    blocks that are closed to an owner are neither sent nor scored. Owners and blocks meet in
    groups of bounded size, dealt by a hash, so nothing is broadcast.
    """
    norm = F.sqrt(product("features", "features")).alias("norm")

    def side(df: DataFrame, name: str) -> DataFrame:
        kept = df.where("features is not null").dropDuplicates(["id"])
        return kept.select(F.col("id").cast("bigint").alias(name), "features", norm)

    right = with_position(side(others, "other"), [F.desc("norm"), F.col("other")], "_at")
    right = materialize(right.withColumn("block", F.expr(f"_at div {OTHERS}")).drop("_at"), "others")
    reach = materialize(right.groupBy("block").agg(F.max("norm").alias("most")), "reach")
    left = materialize(side(owners, "owner"), "owners")
    last = reach.agg(F.max("block")).first()[0]
    last = -1 if last is None else last
    groups = max(1, -(-left.count() // OWNERS))
    state = left.withColumn("floor", F.lit(float("-inf")))
    found = state.select("owner", F.lit(0).alias("rank"), F.col("owner").alias("other"), F.col("norm").alias("score")).limit(0)
    low, width = 0, FIRST_BLOCKS
    while low <= last:
        high = min(low + width - 1, last)
        can = F.col("norm") * F.col("most") * _SLACK >= F.col("floor")
        open_ = state.withColumn("block", F.explode(F.sequence(F.lit(low), F.lit(high)).cast("array<bigint>")))
        open_ = open_.join(reach, "block").where(can).withColumn("group", F.pmod(F.xxhash64("owner"), F.lit(groups)))
        there = right.where(F.col("block").between(low, high))
        there = there.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<bigint>")))
        new = open_.select("owner", "features", "floor", "block", "group").groupBy("block", "group").cogroup(
            there.select("other", "features", "block", "group").groupBy("block", "group")
        )
        new = new.applyInArrow(_matches(n), "owner bigint, other bigint, score double")
        best = Window.partitionBy("owner").orderBy(F.desc("score"), "other")
        merged = found.select("owner", "other", "score").unionByName(new)
        merged = merged.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)
        found = materialize(merged.select("owner", "rank", "other", "score"), "best")
        low, width = high + 1, width * 2
        if low <= last:
            nth = found.where(F.col("rank") == n).select("owner", F.col("score").alias("floor"))
            state = left.join(nth, "owner", "left").fillna(float("-inf"), ["floor"])
            longest = reach.where(F.col("block") == low).first()["most"]
            state = materialize(state.where(F.col("norm") * longest * _SLACK >= F.col("floor")), "open")
            if state.isEmpty():
                break
    return found


def _named(found: DataFrame, owner: str, other: str) -> DataFrame:
    ids = [F.col("owner").cast("int").alias(owner), "rank", F.col("other").cast("int").alias(other)]
    return found.select(*ids, "score")


def recommend_items(model: ALSModel, users: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` best items for each of the given users: (user, rank, item, score).

    Users without factors have none."""
    asked = model.userFactors.join(users.select(F.col("user").alias("id")).distinct(), "id")
    return _named(best_products(asked, model.itemFactors, n), "user", "item")


def recommend_users(model: ALSModel, items: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most interested users for each of the given items."""
    asked = model.itemFactors.join(items.select(F.col("item").alias("id")).distinct(), "id")
    return _named(best_products(asked, model.userFactors, n), "item", "user")


def recommend_named(
    model: ALSModel,
    ids: DataFrame,
    titles: DataFrame,
    n: int = 10,
    kind: str = "user",
    key: str = "item",
    title: str = "title",
) -> DataFrame:
    """Ranked recommendations with item titles.

    ``kind`` "user" asks for items for the users in ``ids``, "item" for users for
    the items in ``ids``.
    """
    if kind not in ("user", "item"):
        raise ValueError(f"kind must be 'user' or 'item', not {kind!r}")
    ranked = recommend_items(model, ids, n) if kind == "user" else recommend_users(model, ids, n)
    return lookup(ranked, titles, ("item", key), title)
