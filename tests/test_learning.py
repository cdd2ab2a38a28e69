import math
import warnings
from contextlib import contextmanager

import numpy as np
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import IllegalArgumentException, PySparkException
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from larkspur.functions import PAGE_KIND
from larkspur.operators import evaluate, features, gradient, train, tune
from larkspur.operators.splits import split_random
from larkspur.sources import tables


@pytest.fixture(scope="module")
def planted(spark):
    """Class depends on x0 and x1 with some noise; x2 is noise, x3 constant."""
    chance = np.random.default_rng(1)
    x = np.column_stack([chance.normal(size=(600, 3)), np.ones(600)])
    y = (x[:, 0] - 0.5 * x[:, 1] + 0.3 * chance.normal(size=600) > 0).astype(float)
    rows = [(i, *map(float, v), float(c)) for i, (v, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, x0 double, x1 double, x2 double, x3 double, label double")
    return features.assemble(df.coalesce(2), ["x0", "x1", "x2", "x3"]).cache()


# -- features -----------------------------------------------------------------


def test_string_index_order_and_unseen(spark):
    seen = spark.createDataFrame([(c,) for c in "bbccad"], "c string")
    model = features.index_strings(seen, "c")
    assert list(model.labels) == ["b", "c", "a", "d"]
    later = spark.createDataFrame([("a",), ("zz",), (None,)], "c string")
    encoded = features.one_hot(model.transform(seen), "c_index").transform(model.transform(later))
    slots = [list(r[0]) for r in encoded.select(vector_to_array("c_index_vec")).collect()]
    assert slots == [[0, 0, 1, 0, 0], [0, 0, 0, 0, 1], [0, 0, 0, 0, 1]]


@pytest.mark.parametrize("hot", [1000, 2, 0])
def test_frequency_index_is_that_of_the_indexer(spark, monkeypatch, hot):
    monkeypatch.setattr(features, "HOT_CATEGORIES", hot)
    words = [f"c{i * i % 37}" for i in range(400)] + ["b"] * 90 + ["a"] * 90
    seen = spark.createDataFrame([(c, i) for i, c in enumerate(words)] + [(None, 0)], "c string, `index` int")
    ours, theirs = features.index_frequencies(seen, "c"), features.index_strings(seen, "c")
    assert [r["category"] for r in ours.index(spark).orderBy("index").collect()] == list(theirs.labels)
    later = seen.unionByName(spark.createDataFrame([("unseen", 1), (None, 2), ("", 3)], "c string, `index` int"))
    one, two = (sorted(map(tuple, m.transform(later).collect()), key=repr) for m in (ours, theirs))
    assert one == two and len(one) == later.count()


def test_frequency_index_is_saved_with_its_table(spark, tmp_path):
    seen = spark.createDataFrame([("x",), ("y",), ("y",)], "c string")
    model = features.index_frequencies(seen, "c", path=str(tmp_path / "table"))
    model.save(str(tmp_path / "model"))
    loaded = features.FrequencyIndexModel.load(str(tmp_path / "model"))
    assert {tuple(r) for r in loaded.transform(seen).collect()} == {("x", 1.0), ("y", 0.0)}
    empty = features.index_frequencies(seen.limit(0), "c")
    assert {r["c_index"] for r in empty.transform(seen).collect()} == {0.0}


def test_rank_areas_of_several_scores(spark):
    draw = np.random.default_rng(9)
    rows = [(float(draw.random() < 0.4), float(draw.integers(0, 9)), float(draw.normal()), 1.0) for _ in range(500)]
    df = spark.createDataFrame([*rows, (1.0, None, None, None), (None, 3.0, 0.1, 1.0)], "label double, a double, b double, c double")
    found = {r["score"]: r["auc"] for r in evaluate.rank_areas(df, ["a", "b", "c"]).collect()}
    for k, name in enumerate("abc", 1):
        pairs = [(x[k], z[k]) for x in rows if x[0] == 1 for z in rows if z[0] == 0]
        assert np.isclose(found[name], sum((p > n) + 0.5 * (p == n) for p, n in pairs) / len(pairs))
    assert evaluate.rank_areas(df.where("label = 1"), ["a"]).first()["auc"] is None


def test_raw_predictions_of_a_model_are_ranked(planted):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    scored = train.fit_tree(planted, depth=3).transform(planted)
    theirs = BinaryClassificationEvaluator(numBins=0).evaluate(scored)
    assert np.isclose(evaluate.auc(scored), theirs) and np.isclose(evaluate.auc_evaluator().evaluate(scored), theirs)


def test_forest_samples_follow_from_keys(planted):
    fit = dict(trees=5, depth=4)
    one, two = (train.fit_hash_forest(d, "id", **fit).transform(planted) for d in (planted, planted.repartition(7)))
    both = one.select("id", vector_to_array("probability").alias("p"), "prediction", "label").join(
        two.select("id", vector_to_array("probability").alias("q")), "id")
    assert both.where("p = q").count() == 600
    assert evaluate.accuracy(one).first()["accuracy"] > 0.85
    weights = planted.select(train.HashForestClassifier(keyCol="id", numTrees=3).weights().alias("w")).selectExpr("explode(w) w")
    mean, spread = weights.agg(F.avg("w"), F.var_pop("w")).first()
    assert abs(mean - 1) < 0.1 and abs(spread - 1) < 0.2


def test_many_models_in_one_pass_equal_single_fits(planted):
    stage = gradient.GradientDescentClassifier(keyCol="id", tol=0.02)
    grid = tune.param_grid(stage, {"maxIter": [1, 4], "stepSize": [1.0, 10.0], "miniBatchFraction": [0.5, 1.0], "loss": ["logistic", "hinge"]})
    together = dict(stage.fitMultiple(planted, grid))
    for i in (0, 5, 10, 15):
        assert np.allclose(together[i].weights, stage.copy(grid[i]).fit(planted).weights, atol=1e-12)
    areas = gradient.hard_aucs([together[i] for i in range(16)], planted)
    assert np.isclose(areas[7], evaluate.auc_hard(together[7].transform(planted)).first()["auc"])


def test_sparse_rows_stay_sparse(spark):
    from pyspark.ml.linalg import Vectors

    draw = np.random.default_rng(3)
    size, rows = 100_000, []
    for i in range(60):
        at = sorted({0 if i % 2 else 1, *map(int, draw.integers(2, size, 5))})
        rows.append((i, Vectors.sparse(size, at, [1.0] * len(at)), float(i % 2)))
    df = spark.createDataFrame(rows, ["id", "features", "label"])
    dense = df.withColumn("features", array_to_vector(vector_to_array("features"))).limit(3)
    model = gradient.fit_gd(df.where("id >= 3").unionByName(dense), "logistic", iterations=3)
    assert model.weights[0] > 0 > model.weights[1] and len(model.weights) == size
    assert evaluate.accuracy(model.transform(df)).first()["accuracy"] == 1.0
    plan = model.transform(df)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20_000


def test_named_sweeps(planted):
    tuned = tune.named_sweep(
        "logistic", "miniBatchFraction", planted.filter("id < 400"), planted.filter("id >= 400"),
        evaluate.hard_auc_evaluator(), keyCol="id",
    )
    assert tuned.table.count() == 3 and tuned.params["miniBatchFraction"] in (0.5, 0.8, 1.0)
    # As the sweep says: 50 steps of size 500.
    alone = gradient.fit_gd(
        planted.filter("id < 400"), "logistic", iterations=50, step=500.0, tol=0.0, key="id",
        fraction=tuned.params["miniBatchFraction"],
    )
    assert np.allclose(tuned.model.weights, alone.weights, atol=1e-9)
    assert np.isclose(tuned.metric, evaluate.auc_hard(alone.transform(planted.filter("id >= 400"))).first()["auc"])
    with pytest.raises(ValueError, match="no sweep"):
        tune.named_sweep("tree", "stepSize", planted, planted, evaluate.hard_auc_evaluator())
    assert {kind for kind, _ in tune.SWEEPS} <= set(tune.BUILDERS) and set(tune.GRIDS) <= set(tune.BUILDERS)


def test_assemble_refuses_null(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises((PySparkException, Py4JJavaError)):
        features.assemble(df, ["a", "b"]).collect()
    kept = features.assemble(df, ["a", "b"], invalid="keep").first()["features"]
    assert kept[0] == 1.0 and math.isnan(kept[1])


def test_standardize_uses_training_moments(spark, planted):
    fit_on = planted.filter("id < 400")
    scaled = features.standardize(fit_on).transform(fit_on)
    columns = [vector_to_array("scaled")[i].alias(f"s{i}") for i in range(4)]
    stats = scaled.select(*columns).agg(
        *[F.avg(f"s{i}") for i in range(4)], *[F.stddev_samp(f"s{i}") for i in range(4)]
    ).first()
    assert np.allclose(stats[:4], 0) and np.allclose(stats[4:], [1, 1, 1, 0])
    unshifted = features.standardize(fit_on, with_mean=False)
    assert unshifted.transform(planted).first()["scaled"][3] == 0.0 and not unshifted.getWithMean()


def test_vector_index_boundary(spark):
    rows = [(float(i % 24), float(i % 25)) for i in range(600)]
    df = features.assemble(spark.createDataFrame(rows, "a double, b double"), ["a", "b"])
    assert set(features.index_vectors(df, max_categories=24).categoryMaps) == {0}


# -- models -------------------------------------------------------------------


@pytest.mark.parametrize(
    "fit",
    [
        lambda d: train.fit_tree(d, impurity="gini", depth=4, bins=20),
        lambda d: train.fit_tree(d, impurity="entropy", depth=4, bins=20),
        lambda d: train.fit_forest(d, trees=10, depth=4),
        lambda d: train.fit_logistic(d),
        lambda d: train.fit_linear_svm(d, iterations=20),
        lambda d: gradient.fit_gd(d, "logistic", iterations=20, step=5.0),
        lambda d: gradient.fit_gd(d, "hinge", iterations=20, step=1.0),
    ],
)
def test_classifiers_beat_the_constant(planted, fit):
    model = fit(planted.filter("id < 400"))
    scored = evaluate.score(model, planted.filter("id >= 400"))
    assert evaluate.accuracy(scored).first()["accuracy"] > 0.8
    assert evaluate.auc(scored) > 0.85


def test_naive_bayes(spark):
    rows = [(float(c), float(5 * c + i % 3), float(5 - 5 * c + i % 2)) for i in range(60) for c in (0, 1)]
    df = features.assemble(spark.createDataFrame(rows, "label double, a double, b double"), ["a", "b"])
    model = train.fit_naive_bayes(df, smoothing=3.0)
    assert evaluate.accuracy(evaluate.score(model, df)).first()["accuracy"] > 0.95
    negative = df.withColumn("features", array_to_vector(F.array(F.lit(-1.0), F.lit(1.0))))
    with pytest.raises((PySparkException, Py4JJavaError)):
        train.fit_naive_bayes(negative)


@pytest.mark.parametrize(
    "fit", [lambda d: train.fit_tree_regressor(d, depth=5), lambda d: train.fit_gbt(d, depth=3, iterations=10)]
)
def test_regressors_beat_the_mean(planted, fit):
    df = planted.withColumn("label", 3 * F.col("x0") + F.col("x1") * F.col("x1"))
    spread = df.agg(F.stddev_pop("label")).first()[0]
    scored = evaluate.score(fit(df), df)
    assert evaluate.rmse(scored).first()["rmse"] < 0.6 * spread


def test_impurity_names_are_checked(planted):
    with pytest.raises(IllegalArgumentException):
        train.fit_tree(planted, impurity="entory")


# -- gradient descent ---------------------------------------------------------


def descend(x, y, loss, steps, step, reg, tol, batches=None):
    w = np.zeros(x.shape[1])
    for i in range(1, steps + 1):
        xb, yb = (x, y) if batches is None else (x[batches(i)], y[batches(i)])
        m = xb @ w
        if loss == "logistic":
            pull = 1 / (1 + np.exp(-m)) - yb
        else:
            pull = np.where((2 * yb - 1) * m < 1, -(2 * yb - 1), 0.0)
        previous, rate = w, step / math.sqrt(i)
        w = previous * (1 - rate * reg) - rate * (xb.T @ pull) / len(yb)
        if i > 1 and np.linalg.norm(w - previous) < tol * max(np.linalg.norm(w), 1.0):
            break
    return w


def arrays(df):
    rows = df.orderBy("id").collect()
    return np.array([r["features"].toArray() for r in rows]), np.array([r["label"] for r in rows])


@pytest.mark.parametrize("loss, step, reg", [("logistic", 1.0, 0.01), ("hinge", 0.5, 0.1), ("logistic", 10.0, 0.0)])
def test_descent_follows_the_rule(planted, loss, step, reg):
    x, y = arrays(planted)
    model = gradient.fit_gd(planted, loss, iterations=12, step=step, reg=reg, tol=0.0)
    assert np.allclose(model.weights, descend(x, y, loss, 12, step, reg, 0.0), atol=1e-9)


@pytest.mark.parametrize("loss", ["logistic", "hinge"])
def test_descent_equals_the_rdd_trainers(planted, loss):
    from pyspark.mllib.classification import LogisticRegressionWithSGD, SVMWithSGD
    from pyspark.mllib.linalg import Vectors
    from pyspark.mllib.regression import LabeledPoint

    kind = {"logistic": LogisticRegressionWithSGD, "hinge": SVMWithSGD}[loss]
    points = planted.select("label", "features").rdd.map(
        lambda r: LabeledPoint(r["label"], Vectors.dense(r["features"].toArray()))
    )
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        expected = kind.train(points, iterations=15, step=1.0, regParam=0.01)
    ours = gradient.fit_gd(planted, loss, iterations=15, step=1.0, reg=0.01)
    assert np.allclose(ours.weights, expected.weights.toArray(), atol=1e-8)


def test_descent_stops_once_settled(planted):
    x, y = arrays(planted)
    model = gradient.fit_gd(planted, "logistic", iterations=40, step=1.0, reg=1.0, tol=0.05)
    assert np.allclose(model.weights, descend(x, y, "logistic", 40, 1.0, 1.0, 0.05), atol=1e-9)
    assert not np.allclose(model.weights, descend(x, y, "logistic", 40, 1.0, 1.0, 0.0), atol=1e-6)


def test_mini_batches_are_drawn_by_key(planted):
    import hashlib

    x, y = arrays(planted)

    def batch(i):
        digests = [hashlib.md5(f"4:{i}:{k}".encode()).hexdigest()[:8] for k in range(len(y))]
        return np.array([int(d, 16) < int(0.3 * 2**32) for d in digests])

    fit = dict(iterations=4, step=1.0, fraction=0.3, tol=0.0, key="id", seed=4)
    model = gradient.fit_gd(planted, "logistic", **fit)
    expected = descend(x, y, "logistic", 4, 1.0, 0.01, 0.0, batch)
    assert np.allclose(model.weights, expected, atol=1e-9)
    again = gradient.fit_gd(planted.repartition(3), "logistic", **fit)
    assert np.allclose(model.weights, again.weights, atol=1e-9)
    with pytest.raises(ValueError, match="keyCol"):
        gradient.fit_gd(planted, fraction=0.5)


def test_descent_on_one_class_and_sparse_rows(spark, planted):
    ones = planted.filter("label = 1")
    x, y = arrays(ones)
    assert np.allclose(
        gradient.fit_gd(ones, "hinge", iterations=3, tol=0.0).weights,
        descend(x, y, "hinge", 3, 1.0, 0.01, 0.0),
    )
    cats = spark.createDataFrame([("a", 1.0), ("b", 0.0), ("a", 1.0)], "c string, label double")
    indexed = features.index_strings(cats, "c").transform(cats)
    encoded = features.one_hot(indexed, "c_index", "features").transform(indexed)
    weights = gradient.fit_gd(encoded, "logistic", iterations=5).weights
    assert weights[0] > 0 > weights[1] and weights[2] == 0
    with pytest.raises(ValueError, match="loss"):
        gradient.fit_gd(planted, "squared")
    with pytest.raises(ValueError, match="nothing"):
        gradient.fit_gd(planted.limit(0))


def test_pipeline_with_descent_is_saved_and_loaded(tmp_path, planted):
    stages = [
        features.scaler(output="scaled"),
        gradient.GradientDescentClassifier(featuresCol="scaled", maxIter=5, stepSize=2.0),
    ]
    model = features.build_pipeline(stages).fit(planted.filter("id < 400"))
    model.write().overwrite().save(str(tmp_path / "p"))
    loaded = PipelineModel.load(str(tmp_path / "p"))
    rest = planted.filter("id >= 400")
    before = [tuple(r) for r in model.transform(rest).orderBy("id").select("rawPrediction", "probability", "prediction").collect()]
    after = [tuple(r) for r in loaded.transform(rest).orderBy("id").select("rawPrediction", "probability", "prediction").collect()]
    assert before == after and len(before) == 200
    assert np.isclose(sum(before[0][1].toArray()), 1.0)


# -- evaluation ---------------------------------------------------------------


def scored(spark, rows):
    return spark.createDataFrame(rows, "label double, score double, prediction double")


def test_auc_with_ties_across_classes(spark):
    rows = [(1.0, 3.0, 1.0), (0.0, 3.0, 1.0), (1.0, 1.0, 0.0), (0.0, 0.0, 0.0), (0.0, 2.0, 0.0)]
    df = scored(spark, rows)
    pairs = [(p, n) for y, p, _ in rows if y == 1 for z, n, _ in rows if z == 0]
    expected = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in pairs) / len(pairs)
    assert np.isclose(evaluate.auc(df, "score"), expected)
    assert np.isclose(evaluate.auc(df.withColumn("score", F.exp("score")), "score"), expected)
    hard = evaluate.auc_hard(df).first()["auc"]
    assert np.isclose(hard, evaluate.hard_auc_evaluator().evaluate(df))
    assert np.isclose(hard, (1 / 2 + 2 / 3) / 2)


def test_one_class_has_no_hard_auc(spark):
    df = scored(spark, [(1.0, 1.0, 1.0), (1.0, 0.0, 0.0)])
    assert evaluate.auc_hard(df).first()["auc"] is None


def test_accuracy_and_rmse_equal_the_evaluators(spark):
    df = scored(spark, [(1.0, 0.0, 1.0), (2.0, 0.0, 0.0), (0.0, 0.0, 0.0)])
    assert np.isclose(evaluate.accuracy(df).first()[0], evaluate.accuracy_evaluator().evaluate(df))
    assert np.isclose(evaluate.rmse(df).first()[0], evaluate.rmse_evaluator().evaluate(df))


def test_scoring_unlabelled_rows(planted):
    model = train.fit_tree(planted, depth=3)
    out = evaluate.score_decoded(model, planted.drop("label"), PAGE_KIND, ["id"])
    assert out.columns == ["id", "prediction", "description"] and out.count() == 600
    assert {(r[1], r[2]) for r in out.collect()} == set(PAGE_KIND.items())


def test_scoring_with_error(planted):
    model = train.fit_tree_regressor(planted.withColumn("label", F.round("x0", 1) * 10), depth=3)
    df = planted.withColumn("label", F.lit(2.0))
    for r in evaluate.score_with_error(model, df, keep=["id"]).collect():
        assert r["error"] == abs(2.0 - r["prediction"]) and (r["result"] == "正确") == (r["error"] == 0)


# -- tuning -------------------------------------------------------------------


def test_grid_sizes():
    sizes = {k: math.prod(len(v) for v in g.values()) for k, g in tune.GRIDS.items()}
    assert sizes == {
        "tree": 72, "logistic": 36, "svm": 45, "naive_bayes": 9, "regression_tree": 36,
        "pipeline_tree": 18, "forest": 54, "gbt": 8,
    }


def test_param_grid_checks_and_drops():
    stage = train.tree_regressor()
    with pytest.raises(ValueError, match="maxBin"):
        tune.param_grid(stage, {"maxBin": [3]})
    grid = tune.param_grid(
        stage, {"maxDepth": [5, 10], "maxBins": [10, 24, 32]}, keep=lambda c: c["maxBins"] >= 24
    )
    assert [tuple(m.values()) for m in grid] == [(5, 24), (5, 32), (10, 24), (10, 32)]


@pytest.mark.parametrize("parallelism", [1, 3])
def test_holdout_search_keeps_the_best_and_the_first_of_equals(planted, parallelism):
    rows = split_random(planted, "id", {"train": 8, "valid": 2})
    fit_on, held = rows.filter("split = 'train'"), rows.filter("split = 'valid'")
    stage = train.tree_classifier()
    grid = tune.param_grid(stage, {"impurity": ["gini"], "maxDepth": [0, 4], "minInfoGain": [0.0, 1e-12]})
    tuned = tune.tune_grid(stage, grid, fit_on, held, evaluate.hard_auc_evaluator(), parallelism)
    table = tuned.table.orderBy("trial").collect()
    assert [r["maxDepth"] for r in table] == [0, 0, 4, 4]
    assert table[0]["metric"] == 0.5 and table[2]["metric"] == table[3]["metric"] == tuned.metric
    assert tuned.params == {"impurity": "gini", "maxDepth": 4, "minInfoGain": 0.0}
    again = evaluate.auc_hard(evaluate.score(tuned.model, held)).first()["auc"]
    assert np.isclose(again, tuned.metric)


def test_search_minimises_errors(planted):
    df = planted.withColumn("label", F.col("x0") * 10)
    stage = train.tree_regressor()
    tuned = tune.tune_sweep(
        stage, stage, "maxDepth", [1, 5], df.filter("id < 400"), df.filter("id >= 400"), evaluate.rmse_evaluator()
    )
    metrics = [r["metric"] for r in tuned.table.orderBy("trial").collect()]
    assert tuned.params == {"maxDepth": 5} and tuned.metric == metrics[1] < metrics[0]
    with pytest.raises(ValueError, match="numIeteration"):
        tune.tune_sweep(stage, stage, "numIeteration", [1], df, df, evaluate.rmse_evaluator())


def test_searches_inside_a_pipeline(planted):
    stage = train.tree_classifier()
    grid = tune.param_grid(stage, {"maxDepth": [1, 4]})
    split = tune.tune_split(stage, grid, evaluate.accuracy_evaluator(), "id")
    fitted = features.build_pipeline([features.scaler(output="ignored"), split]).fit(planted)
    assert evaluate.accuracy(fitted.transform(planted)).first()["accuracy"] > 0.8
    assert len(fitted.stages[1].validationMetrics) == 2

    folded = planted.withColumn("fold", (F.col("id") % 3).cast("int"))
    search = tune.tune_folds(stage, grid, evaluate.accuracy_evaluator(), folds=3, fold_col="fold")
    once, again = search.fit(folded), search.fit(folded.repartition(5))
    assert once.avgMetrics == again.avgMetrics and len(once.avgMetrics) == 2


def test_categorical_hours_need_enough_bins(spark):
    rows = [(float(i % 24), float(i % 7), float((i % 24) * 3)) for i in range(500)]
    df = spark.createDataFrame(rows, "hr double, weekday double, cnt double")
    stages = [
        features.assembler(["hr", "weekday"], "raw"),
        features.vector_indexer("raw", "features"),
    ]
    few = train.tree_regressor(bins=10, label="cnt")
    with pytest.raises((PySparkException, Py4JJavaError)):
        features.build_pipeline([*stages, few]).fit(df)
    enough = train.tree_regressor(bins=24, label="cnt")
    model = features.build_pipeline([*stages, enough]).fit(df)
    assert evaluate.rmse(model.transform(df), label="cnt").first()["rmse"] < 5


@pytest.fixture(scope="module")
def repeated(spark):
    """400 rows, 40 times each, with a key of their own."""
    df = spark.range(16000).selectExpr("id", "double(id % 20) a", "double(id % 400 div 20) b", "double(id % 3) fold")
    df = df.selectExpr("id", "int(fold) fold", "a", "b", "double(a + b > 19) label", "a * b + a AS y")
    return features.assemble(df, ["a", "b"]).cache()


@pytest.mark.parametrize("fit", [train.fit_tree, train.fit_tree_regressor, train.fit_gbt])
def test_trees_read_equal_rows_once(repeated, monkeypatch, fit):
    label = "label" if fit is train.fit_tree else "y"
    read, spread = [], train.cached

    @contextmanager
    def watched(*frames, **options):
        with spread(*frames, **options) as kept:
            read.append(kept[0].count())
            yield kept

    options = {"iterations": 3} if fit is train.fit_gbt else {}
    monkeypatch.setattr(train, "cached", watched)
    model = fit(repeated, depth=4, bins=32, label=label, partitions=3, **options)
    assert read == [400, 400]
    build = {train.fit_tree: train.tree_classifier, train.fit_tree_regressor: train.tree_regressor, train.fit_gbt: train.gbt_regressor}[fit]
    plain = build(depth=4, bins=32, label=label, **options).fit(repeated)
    both = model.transform(repeated).withColumnRenamed("prediction", "mine").select("id", "mine").join(plain.transform(repeated), "id")
    assert both.where(F.abs(F.col("mine") - F.col("prediction")) > 1e-9).isEmpty()


def test_searches_read_equal_rows_once(repeated, monkeypatch):
    counts, counted = [], train.counted
    monkeypatch.setattr(train, "counted", lambda *a, **o: (found := counted(*a, **o), counts.append(found.count()))[0])
    stage = train.naive_bayes()
    grid = tune.param_grid(stage, {"smoothing": [1.0, 50.0]})
    search = tune.tune_folds(stage, grid, evaluate.accuracy_evaluator(), folds=3, fold_col="fold")
    assert tune.run_search(search, repeated, 2).avgMetrics == pytest.approx(search.fit(repeated).avgMetrics, abs=1e-12)
    tree = train.tree_classifier()
    grid = tune.param_grid(tree, {"maxDepth": [1, 3]})
    tune.tune_split(tree, grid, evaluate.accuracy_evaluator(), "id").fit(repeated)
    assert counts == [1200, 800]


def test_parts_follow_the_rows(repeated, monkeypatch):
    monkeypatch.setattr(tables, "PART_ROWS", 1000)
    assert tables.spread(repeated, 4).rdd.getNumPartitions() == 16


def test_parts_of_a_tree_of_many_classes_are_bounded(spark, monkeypatch):
    """Rows that all differ are kept in parts of a bounded size, and give the tree of Spark's own fit."""
    x = np.random.default_rng(6).uniform(size=(4000, 2))
    rows = [(*map(float, v), float(int(v[0] * 7))) for v in x]
    df = features.assemble(spark.createDataFrame(rows, "a double, b double, label double").coalesce(1), ["a", "b"])
    sizes, keep = [], train.cached

    @contextmanager
    def watched(*frames, **options):
        with keep(*frames, **options) as kept:
            sizes.append([r["count"] for r in kept[0].groupBy(F.spark_partition_id()).count().collect()])
            yield kept

    monkeypatch.setattr(tables, "PART_ROWS", 500)
    monkeypatch.setattr(train, "cached", watched)
    options = dict(impurity="entropy", depth=5, bins=64)
    model, plain = train.fit_tree(df, partitions=2, **options), train.tree_classifier(**options).fit(df)
    assert sum(sizes[-1]) == 4000 and max(sizes[-1]) <= 2 * 500
    assert model.transform(df).where("prediction != label").count() <= plain.transform(df).where("prediction != label").count() + 40


def test_parts_of_blocks_are_bounded(spark, monkeypatch):
    rows = features.assemble(spark.range(50000).selectExpr("double(id % 7) a", "double(id % 7 > 3) label").coalesce(1), ["a"])
    before = gradient.fit_gd(rows, iterations=2, tol=0.0).weights
    sizes, descend = [], gradient.descend

    def watched(blocks, courses):
        sizes.extend(r["count"] for r in blocks.groupBy(F.spark_partition_id()).count().collect())
        descend(blocks, courses)

    monkeypatch.setattr(gradient, "PART_BLOCKS", 2)
    monkeypatch.setattr(gradient, "descend", watched)
    assert np.allclose(gradient.fit_gd(rows, iterations=2, tol=0.0).weights, before)
    assert sum(sizes) == 5 and max(sizes) <= 2
