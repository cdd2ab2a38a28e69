import pickle

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import functions as F

from larkspur.operators import als, evaluate, recommend
from larkspur.plans import recommending
from larkspur.sources import load_or_fit


@pytest.fixture(scope="module")
def ratings(spark):
    chance = np.random.default_rng(2)
    u, v = chance.uniform(0.5, 2, (30, 2)), chance.uniform(0.5, 2, (40, 2))
    rows = [
        (i, j, float(u[i] @ v[j])) for i in range(30) for j in range(40) if chance.random() < 0.6
    ]
    return spark.createDataFrame(rows, "user int, item int, rating double").cache()


@pytest.fixture(scope="module")
def model(ratings):
    return recommend.fit_als(ratings, rank=3, iterations=10, reg=0.01)


def factors(model):
    users = {r["id"]: np.array(r["features"]) for r in model.userFactors.collect()}
    items = {r["id"]: np.array(r["features"]) for r in model.itemFactors.collect()}
    return users, items


def test_fit_beats_the_mean(ratings, model):
    scored = evaluate.score(model, ratings)
    spread = ratings.agg(F.stddev_pop("rating")).first()[0]
    assert evaluate.rmse(scored, label="rating").first()["rmse"] < 0.2 * spread


def test_best_items_equal_brute_force(spark, model):
    users, items = factors(model)
    asked = spark.createDataFrame([(3,), (17,), (999,)], "user int")
    found = recommend.recommend_items(model, asked, 5).orderBy("user", "rank").collect()
    assert len(found) == 10
    for user in (3, 17):
        best = sorted(items, key=lambda i: -(users[user] @ items[i]))[:5]
        mine = [r for r in found if r["user"] == user]
        assert [r["item"] for r in mine] == best and [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        assert np.allclose([r["score"] for r in mine], [users[user] @ items[i] for i in best], rtol=1e-4)


def test_best_users_equal_brute_force(spark, model):
    users, items = factors(model)
    found = recommend.recommend_users(model, spark.createDataFrame([(7,)], "item int"), 4).orderBy("rank")
    best = sorted(users, key=lambda u: -(users[u] @ items[7]))[:4]
    assert [r["user"] for r in found.collect()] == best


def brute(owners, others, n):
    out = []
    for o, u in owners:
        scored = sorted((-sum(x * y for x, y in zip(u, v)), i) for i, v in others)[:n]
        out += [(o, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    return sorted(out)


VECTORS = "id bigint, features array<double>"


@pytest.mark.parametrize("owners, others, first", [(2048, 1024, 2), (7, 5, 1), (3, 16, 2)])
def test_best_products_equal_brute_force(spark, monkeypatch, owners, others, first):
    for name, value in (("OWNERS", owners), ("OTHERS", others), ("FIRST_BLOCKS", first)):
        monkeypatch.setattr(recommend, name, value)
    draw = np.random.default_rng(4)
    # Lengths that differ, many equal vectors, ties, a null vector, an id given twice.
    v = [(i, (draw.integers(-9, 10, 6) * int(draw.choice([1, 1, 5, 40]))).astype(float).tolist()) for i in range(120)]
    v += [(200 + i, [float(x) for x in (90, -80, 70, 60, 50, 40)]) for i in range(60)] + [(500, [0.0] * 6)]
    u = [(i, draw.integers(-9, 10, 6).astype(float).tolist()) for i in range(25)] + [(30, [0.0] * 6)]
    left = spark.createDataFrame([*u, u[0], (31, None)], VECTORS)
    found = recommend.best_products(left, spark.createDataFrame([*v, v[3], (600, None)], VECTORS), 7)
    assert sorted(map(tuple, found.collect())) == brute(u, v, 7)


def test_closed_blocks_are_not_scored(spark, monkeypatch):
    monkeypatch.setattr(recommend, "OTHERS", 10)
    sizes, matches = [], recommend._matches

    def counted(n):
        sizes.append(n)
        return matches(n)

    monkeypatch.setattr(recommend, "_matches", counted)
    v = [(i, [1000.0 / (1 + i), 0.0]) for i in range(400)]
    found = recommend.best_products(spark.createDataFrame([(1, [1.0, 0.0])], VECTORS), spark.createDataFrame(v, VECTORS), 5)
    assert [r["other"] for r in found.orderBy("rank").collect()] == [0, 1, 2, 3, 4]
    assert len(sizes) == 1  # of 40 blocks, one round of two


def test_best_products_without_rows(spark):
    some, none = spark.createDataFrame([(1, [1.0])], VECTORS), spark.createDataFrame([], VECTORS)
    for left, right in ((some, none), (none, some), (none, none)):
        assert recommend.best_products(left, right, 3).collect() == []


@pytest.mark.parametrize("implicit", [False, True])
def test_normal_equations(ratings, implicit):
    options = dict(rank=3, iterations=5, reg=0.1, implicit=implicit)
    fitted = recommend.fit_als(ratings, **options)
    left = recommend.normal_residuals(fitted, ratings, 0.1, implicit)
    assert left.count() == 30 and left.agg(F.max("residual")).first()[0] < 1e-4
    # A model of other ratings does not solve them.
    changed = ratings.withColumn("rating", F.when(F.col("user") == 3, F.col("rating") + 2).otherwise(F.col("rating")))
    wrong = {r["user"]: r["residual"] for r in recommend.normal_residuals(fitted, changed, 0.1, implicit).collect()}
    assert wrong[3] > 1e-2 and wrong[4] < 1e-4


def test_factors_do_not_depend_on_the_layout(spark, ratings):
    one, two = (
        {r["id"]: r["features"] for r in recommend.fit_als(ratings.repartition(k), rank=3, iterations=5).userFactors.collect()}
        for k in (1, 7)
    )
    assert one.keys() == two.keys()
    assert all(np.allclose(one[k], two[k], rtol=1e-3, atol=1e-4) for k in one)


def test_named(spark, model):
    titles = spark.createDataFrame([(i, f"title {i}") for i in range(40)], "id int, title string")
    asked = spark.createDataFrame([(3,)], "user int")
    named = recommend.recommend_named(model, asked, titles, 3, "user", "id").collect()
    assert all(r["title"] == f"title {r['item']}" for r in named) and len(named) == 3
    items = asked.withColumnRenamed("user", "item")
    by_item = recommend.recommend_named(model, items, titles, 2, "item", "id").collect()
    assert {r["title"] for r in by_item} == {"title 3"} and len(by_item) == 2
    with pytest.raises(ValueError, match="kind"):
        recommend.recommend_named(model, asked, titles, 3, "movie", "id")


def test_implicit_and_reload(spark, ratings, tmp_path):
    path = str(tmp_path / "als")
    fitted = load_or_fit(spark, path, ALSModel, lambda: recommend.fit_als(ratings, rank=2, implicit=True))
    loaded = load_or_fit(spark, path, ALSModel, lambda: pytest.fail("fitted again"))
    asked = spark.createDataFrame([(1,)], "user int")
    first, second = (recommend.recommend_items(m, asked, 5).collect() for m in (fitted, loaded))
    assert first == second and len(first) == 5


def test_unknown_pairs_are_dropped(spark, model):
    pairs = spark.createDataFrame([(3, 7), (3, 4000)], "user int, item int")
    assert evaluate.score(model, pairs).count() == 1


def test_blocks_stay_few(monkeypatch):
    """What a half-step shuffles must not grow faster than the ratings."""
    asked = []

    class Ratings:
        def __init__(self, n):
            self.count = lambda: n

    class Als:
        def fit(self, ratings):
            return None

    monkeypatch.setattr(recommend, "als", lambda blocks, **options: (asked.append(blocks), Als())[1])
    for n in (0, 3_600_000, 36_000_000, 216_000_000, 2_160_000_000):
        recommend.fit_als(Ratings(n))
    assert asked == [6, 6, 6, 6, 60]


@pytest.fixture()
def folder(spark, tmp_path):
    """Orders and lines of 12 users and 30 items, some pairs more than once."""
    orders = [(o, o % 12) for o in range(240)]
    lines = [(o, (o * 7 + 3 * k) % 30, float(1 + (o + k) % 50)) for o in range(240) for k in range(4)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint").write.parquet(f"{tmp_path}/orders.parquet")
    schema = "l_orderkey bigint, l_partkey bigint, l_quantity double"
    spark.createDataFrame(lines, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_rows_of_a_user_lie_together(spark, folder):
    rated = recommending.ratings(spark, folder).withColumn("part", F.spark_partition_id())
    rows = rated.select("part", "user", "item").collect()
    assert len(rows) == rated.select("user", "item").distinct().count()
    assert len({(r["part"], r["user"]) for r in rows}) == 12
    assert rows == sorted(rows, key=lambda r: (r["part"], r["user"], r["item"]))


@pytest.mark.parametrize("name", ["rec_predict_pair", "snk_model_save_load"])
def test_pairs_travel_once_by_user_and_once_by_item(spark, folder, name):
    """What is scored, or has met its item's factors, is not shuffled again."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = getattr(recommending, name)(spark, folder)
        plan = found._jdf.queryExecution().executedPlan().toString().splitlines()
        rows = found.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    sent = [below for line, below in zip(plan, plan[1:]) if "Exchange hashpartitioning(" in line]
    assert sent and not [s for s in sent if "user#" in s and ("UDF(" in s or " v#" in s or "prediction#" in s)]
    assert not [line for line in plan if "Exchange hashpartitioning(user" in line and ", item#" in line]
    pairs = recommending.ratings(spark, folder).select("user", "item").collect()
    assert sorted((r["user"], r["item"]) for r in rows) == sorted(map(tuple, pairs))
    assert all(r[2] is True for r in rows)


def test_scores_held_in_parts_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(recommend, "SCORED", 4)
    draw = np.random.default_rng(5)
    u, v = ([(i, draw.integers(-9, 10, 3).astype(float).tolist()) for i in range(k)] for k in (23, 60))
    found = recommend.best_products(spark.createDataFrame(u, VECTORS), spark.createDataFrame(v, VECTORS), 5)
    assert sorted(map(tuple, found.collect())) == brute(u, v, 5)


def pieces_of(ids, others, ratings):
    """Pieces of ratings of one block, in batches of seven rows, with two blocks of others."""
    order = np.lexsort((others, ids))
    names = ("block", "own", "other", "rating")
    columns = [np.zeros(ids.size, np.int32), ids[order], others[order], ratings[order]]
    rows = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
    batches = als._pack(2)(rows.slice(at, 7) for at in range(0, ids.size, 7))
    return [data for batch in batches for data in batch.column("data").to_pylist()]


@pytest.mark.parametrize("alpha", [None, 2.0])
def test_a_half_step_holds_one_piece(monkeypatch, alpha):
    monkeypatch.setattr(als, "PIECE", 20)
    draw = np.random.default_rng(6)
    # Id 3 has more ratings than a piece holds, and some pairs come twice.
    ids = np.append(draw.integers(0, 30, 300), np.full(70, 3)).astype(np.int32)
    others = draw.integers(-40, 40, ids.size).astype(np.int32)
    ratings = draw.uniform(-1, 5, ids.size).astype(np.float32)
    packed = pieces_of(ids, others, ratings)
    assert max(len(pickle.loads(p)[4]) for p in packed) <= 27 and len(packed) > 15
    named = np.unique(others)
    v = draw.normal(size=(named.size, 3)).astype(np.float32)
    gram = v.T.astype(float) @ v
    drawn = []

    def rows():
        for half in (slice(None, None, 2), slice(1, None, 2)):
            yield 0, (named[half], v[half])
        if alpha:
            yield 0, gram
        for p in packed:
            drawn.append(p)
            yield 0, p

    found, ahead = {}, []
    for own, vectors, who, ends in als._half_step(3, 0.1, alpha)(rows()):
        ahead.append(len(drawn))
        found |= {i: (x, set(np.flatnonzero([k in who[a:b] for a, b in zip(ends, ends[1:])]))) for k, (i, x) in enumerate(zip(own, vectors))}
    assert ahead[0] < 3 and ahead == sorted(ahead)
    assert sorted(found) == np.unique(ids).tolist()
    for i, (x, needs) in found.items():
        u, r = v[np.searchsorted(named, others[ids == i])].astype(float), ratings[ids == i].astype(float)
        weight, right, n = np.ones(r.size), r, r.size
        if alpha:
            weight, right, n = alpha * abs(r), np.where(r > 0, 1 + alpha * abs(r), 0), (r > 0).sum()
        a = (u.T * weight) @ u + 0.1 * n * np.eye(3) + (gram if alpha else 0)
        assert np.allclose(x, np.linalg.solve(a, u.T @ right), rtol=1e-4, atol=1e-5)
        assert needs == set(als._block(others[ids == i], 2))


@pytest.mark.parametrize("implicit", [False, True])
def test_factors_do_not_depend_on_the_pieces(spark, ratings, monkeypatch, implicit):
    fits = []
    for piece in (als.PIECE, 5):
        monkeypatch.setattr(als, "PIECE", piece)
        fits.append(recommend.fit_als(ratings, rank=3, iterations=4, reg=0.1, implicit=implicit))
    (users, items), (users2, items2) = map(factors, fits)
    assert len(users) == 30 and len(items) == 40 and users.keys() == users2.keys() and items.keys() == items2.keys()
    assert all(np.allclose(users[k], users2[k], atol=1e-5) for k in users)
    assert all(np.allclose(items[k], items2[k], atol=1e-5) for k in items)


def test_blocks_in_sql_and_in_tasks_agree(spark):
    ids = [-(2**31), -7, -1, 0, 1, 14999, 20000, 2**31 - 1]
    rows = spark.createDataFrame([(i,) for i in ids], "id int").select("id", als._block_column("id", 7).alias("block"))
    assert {r["id"]: r["block"] for r in rows.collect()} == dict(zip(ids, als._block(np.array(ids, np.int32), 7).tolist()))


@pytest.mark.parametrize(
    "row, what", [((None, 1, 1.0), "integers"), ((1.5, 1, 1.0), "integers"), ((1.0, 1, None), "null or NaN"), ((1.0, 1, float("nan")), "null or NaN")]
)
def test_rows_that_cannot_be_fitted_fail(spark, row, what):
    rows = spark.createDataFrame([row, (2.0, 2, 1.0)], "user double, item int, rating double")
    with pytest.raises(Exception, match=what):
        recommend.fit_als(rows, rank=2, iterations=1)


def test_no_ratings_is_an_error(spark):
    with pytest.raises(ValueError, match="no ratings"):
        recommend.fit_als(spark.createDataFrame([], "user int, item int, rating double"), rank=2, iterations=1)
