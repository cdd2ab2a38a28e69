"""Training, scoring, evaluation and tuning queries.

Labels of the given tables are mostly random, so fits learn labels computed from
the columns, or from few features, in a way SQL can follow step by step. Where a
fit draws random numbers, the SQL covers keys and shape only.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions import PAGE_KIND
from larkspur.operators import evaluate, features, gradient, splits, train, tune
from larkspur.plans import sqltext
from larkspur.plans.registry import query
from larkspur.sources import table

# -- inputs -------------------------------------------------------------------

# Line items: features with few distinct values, and labels computed from them.
LINE_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
_YIELD = "l_quantity * (1 - l_discount) - 2 * l_linenumber"
LINE_LABELS = {
    "binary": f"CASE WHEN {_YIELD} > 12 THEN 1 ELSE 0 END",
    "multi": "CASE " + " ".join(f"WHEN {_YIELD} < {6 * c + 2} THEN {c}" for c in range(6)) + " ELSE 6 END",
    "regression": f"{_YIELD} + 100 * l_tax",
    "flag": "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END",
}
CLASSES = 7
#: Parts that rows are laid out in for fits; the tables here come in one row group.
PARTS = 8
_LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


def lines(spark: SparkSession, sf: str, label: str) -> DataFrame:
    """(id, features, label) of every line item."""
    raw = table(spark, sf, "lineitem").withColumns(
        {"label": F.expr(f"double({LINE_LABELS[label]})"), "id": F.expr(_LINE_ID)}
    )
    return features.assemble(raw, LINE_FEATURES).select("id", "features", "label")


def lines_sql(label: str) -> str:
    """The same rows, numbered, because ids may repeat: n, id, the features and y."""
    names = ", ".join(LINE_FEATURES)
    return (
        f"line AS MATERIALIZED (SELECT row_number() OVER () AS n, {_LINE_ID} AS id, {names}, "
        f"({LINE_LABELS[label]}) AS y FROM lineitem)"
    )


# Line items scaled to comparable ranges, for the linear models.
_SCALED = {
    "x0": "l_quantity / 50",
    "x1": "l_discount * 10",
    "x2": "l_tax * 10",
    "x3": "l_extendedprice / 100000",
}
_SCALED_SQL = (
    "line AS (SELECT l_orderkey AS k, "
    + ", ".join(f"{e} AS {n}" for n, e in _SCALED.items())
    + f", {LINE_LABELS['binary']} AS y FROM lineitem)"
)


def scaled_lines(spark: SparkSession, sf: str) -> DataFrame:
    columns = {**_SCALED, "label": f"double({LINE_LABELS['binary']})"}
    raw = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS k", *[f"{e} AS {n}" for n, e in columns.items()]
    )
    return features.assemble(raw, list(_SCALED)).select("k", "features", "label")


# Documents: text measures and language; a part of them carries a quality label.
_COUNTS = ["n_chars", "n_words", "n_lines"]
_DOCUMENT_SQL = """
    document AS (
        SELECT doc_id, lang, n_chars::DOUBLE / 100 AS n_chars,
               length(text) - length(replace(text, ' ', '')) AS n_words,
               length(text) - length(replace(text, chr(10), '')) AS n_lines
        FROM documents)
"""


def documents(spark: SparkSession, sf: str) -> DataFrame:
    def occurrences(character: str):
        without = F.replace(F.col("text"), F.lit(character), F.lit(""))
        return (F.length("text") - F.length(without)).cast("double")

    return table(spark, sf, "documents").select(
        "doc_id",
        "lang",
        (F.col("n_chars") / 100).alias("n_chars"),
        occurrences(" ").alias("n_words"),
        occurrences("\n").alias("n_lines"),
    )


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    quality = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return documents(spark, sf).join(quality, "doc_id")


def _constant(spark: SparkSession, **values: float) -> DataFrame:
    """A driver-side result as a one-row frame."""
    schema = ", ".join(f"{name} double" for name in values)
    return spark.createDataFrame([tuple(float(v) for v in values.values())], schema)


# -- trees --------------------------------------------------------------------


def _tree_sql(label: str, impurity: str, classes: int = 0) -> str:
    return (
        f"WITH {lines_sql(label)}, "
        + sqltext.tree("line", LINE_FEATURES, 5, impurity, classes)
        + " SELECT id, round(prediction, 6) AS prediction FROM line JOIN t_pred USING (n)"
    )


def _predictions(model, rows: DataFrame) -> DataFrame:
    scored = evaluate.score(model, rows)
    return scored.select("id", F.round("prediction", 6).alias("prediction"))


@query("fit_tree_binary", _tree_sql("binary", "gini", 2))
def fit_tree_binary(spark: SparkSession, sf: str) -> DataFrame:
    rows = lines(spark, sf, "binary")
    return _predictions(train.fit_tree(rows, impurity="gini", depth=5, bins=64, partitions=PARTS), rows)


@query("fit_tree_multi", _tree_sql("multi", "entropy", CLASSES))
def fit_tree_multi(spark: SparkSession, sf: str) -> DataFrame:
    rows = lines(spark, sf, "multi")
    return _predictions(train.fit_tree(rows, impurity="entropy", depth=5, bins=64, partitions=PARTS), rows)


@query("fit_tree_regressor", _tree_sql("regression", "variance"))
def fit_tree_regressor(spark: SparkSession, sf: str) -> DataFrame:
    rows = lines(spark, sf, "regression")
    return _predictions(train.fit_tree_regressor(rows, depth=5, bins=64, partitions=PARTS), rows)


_FOREST_TREES = 4


def _forest_sql() -> str:
    """Trees on weighted rows, their class shares averaged."""
    ctes = [lines_sql("multi")]
    weights = []
    for t in range(_FOREST_TREES):
        at = sqltext.key_hash("id", f"0:{t}:")
        counts = " + ".join(f"({at} >= {edge})::INTEGER" for edge in train.poisson_edges())
        weights.append(f"{counts} AS w{t}")
    ctes.append(f"weighted AS MATERIALIZED (SELECT *, {', '.join(weights)} FROM line)")
    for t in range(_FOREST_TREES):
        ctes.append(sqltext.tree("weighted", LINE_FEATURES, 4, "gini", CLASSES, f"f{t}", f"w{t}"))
    means = ", ".join(
        "(" + " + ".join(f"f{t}_share.s{c}" for t in range(_FOREST_TREES)) + f") / {_FOREST_TREES} AS p{c}"
        for c in range(CLASSES)
    )
    joins = " ".join(f"JOIN f{t}_share USING (n)" for t in range(_FOREST_TREES))
    shares = ", ".join(f"round(p{c}, 9)" for c in range(CLASSES))
    return (
        f"WITH {', '.join(ctes)}, mean AS (SELECT id, {means} FROM line {joins}) "
        f"SELECT id, list_position([{shares}], greatest({shares}))::DOUBLE - 1 AS prediction, "
        f"round(greatest({shares}), 6) AS probability FROM mean"
    )


@query("fit_random_forest", _forest_sql())
def fit_random_forest(spark: SparkSession, sf: str) -> DataFrame:
    """Class and its share; the samples follow from the rows' keys, so SQL has them too."""
    rows = lines(spark, sf, "multi")
    model = train.fit_hash_forest(rows, "id", trees=_FOREST_TREES, depth=4, bins=64, partitions=PARTS)
    shares = F.transform(vector_to_array("probability"), lambda x: F.round(x, 9))
    scored = evaluate.score(model, rows).withColumn("shares", shares)
    top = F.array_max("shares")
    place = (F.array_position("shares", top) - 1).cast("double")
    return scored.select("id", place.alias("prediction"), F.round(top, 6).alias("probability"))


_ROUNDS, _GBT_DEPTH = 10, 3


def _gbt_sql() -> str:
    """Each round's tree fits twice what the rounds before leave over."""
    ctes, source = [lines_sql("regression")], "line"
    for r in range(_ROUNDS):
        ctes.append(sqltext.tree(source, LINE_FEATURES, _GBT_DEPTH, "variance", prefix=f"r{r}"))
        rate = "" if r == 0 else "0.1::DOUBLE * "
        total = f"{rate}r{r}_pred.prediction" + ("" if r == 0 else " + total")
        before = "" if r == 0 else f" JOIN sum{r - 1} USING (n)"
        ctes.append(f"sum{r} AS MATERIALIZED (SELECT n, {total} AS total FROM r{r}_pred{before})")
        source = f"left{r}"
        ctes.append(
            f"{source} AS MATERIALIZED (SELECT line.* REPLACE (2 * (y - total) AS y) FROM line JOIN sum{r} USING (n))"
        )
    return f"WITH {', '.join(ctes)} SELECT id, round(total, 6) AS prediction FROM line JOIN sum{_ROUNDS - 1} USING (n)"


@query("fit_gbt", _gbt_sql())
def fit_gbt(spark: SparkSession, sf: str) -> DataFrame:
    """Ten rounds; each fits the scaled residual of those before."""
    rows = lines(spark, sf, "regression")
    model = train.fit_gbt(rows, depth=_GBT_DEPTH, bins=64, iterations=_ROUNDS, partitions=PARTS)
    return _predictions(model, rows)


# -- linear models and naive Bayes --------------------------------------------


def _weights_sql(loss: str) -> str:
    fit = sqltext.gradient_descent("line", list(_SCALED), loss, 3, 1.0, 0.01)
    rows = " UNION ALL ".join(
        f"SELECT {j} AS feature, round(w{j}, 6) AS weight FROM w3" for j in range(len(_SCALED))
    )
    return f"WITH {_SCALED_SQL}, {fit} {rows}"


def _weights(spark: SparkSession, sf: str, loss: str) -> DataFrame:
    model = gradient.fit_gd(scaled_lines(spark, sf), loss, iterations=3, step=1.0, reg=0.01, tol=0.0)
    return model.weight_table(spark).withColumn("weight", F.round("weight", 6))


@query("fit_logistic_sgd", _weights_sql("logistic"))
def fit_logistic_sgd(spark: SparkSession, sf: str) -> DataFrame:
    return _weights(spark, sf, "logistic")


@query("fit_svm_sgd", _weights_sql("hinge"))
def fit_svm_sgd(spark: SparkSession, sf: str) -> DataFrame:
    return _weights(spark, sf, "hinge")


@query(
    "fit_naive_bayes",
    f"WITH {lines_sql('flag')}, {sqltext.naive_bayes('line', LINE_FEATURES, 1.0)} "
    "SELECT y AS class, f AS feature, round(pi, 6) AS pi, round(theta, 6) AS theta "
    "FROM nb_theta JOIN nb_pi USING (y)",
)
def fit_naive_bayes(spark: SparkSession, sf: str) -> DataFrame:
    model = train.fit_naive_bayes(lines(spark, sf, "flag"), smoothing=1.0)
    pi, theta = model.pi.toArray(), model.theta.toArray()
    cells = [
        (c, j, float(pi[c]), float(theta[c, j]))
        for c in range(theta.shape[0])
        for j in range(theta.shape[1])
    ]
    fitted = spark.createDataFrame(cells, "class int, feature int, pi double, theta double")
    return fitted.withColumns({n: F.round(n, 6) for n in ("pi", "theta")})


_PIPELINE_FEATURES = [f"is{j}" for j in range(5)] + _COUNTS


def _pipeline_sql(smoothing: float = 1.0) -> str:
    """Encoded documents, and naive Bayes fitted on the training part of the labels."""
    slots = ", ".join(f"coalesce(i = {j}, {j} = 4)::INTEGER AS is{j}" for j in range(5))
    return f"""
    {_DOCUMENT_SQL},
    trained AS (SELECT d.*, quality AS y FROM document d JOIN labels USING (doc_id)
                WHERE {sqltext.below('doc_id', 7, 10)}),
    codes AS (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS i
              FROM trained GROUP BY lang),
    encoded AS (SELECT d.*, {slots} FROM document d LEFT JOIN codes USING (lang)),
    sample AS (SELECT e.*, y FROM encoded e JOIN trained USING (doc_id)),
    {sqltext.naive_bayes('sample', _PIPELINE_FEATURES, smoothing)}
    """


def _pipeline_model(spark: SparkSession, sf: str, smoothing: float = 1.0) -> PipelineModel:
    sample = splits.split_random(labelled(spark, sf), "doc_id", {"train": 7, "test": 3})
    pipeline = features.build_pipeline(
        [
            features.string_indexer("lang"),
            features.one_hot_encoder("lang_index"),
            features.assembler(["lang_index_vec", *_COUNTS]),
            train.naive_bayes(smoothing),
        ]
    )
    return pipeline.fit(sample.filter("split = 'train'"))


@query(
    "pipeline_fit_transform",
    f"WITH {_pipeline_sql()}, {sqltext.naive_bayes_scores('encoded', 'doc_id', _PIPELINE_FEATURES)} "
    "SELECT doc_id, quality::DOUBLE AS label, prediction FROM nb_pred JOIN labels USING (doc_id) "
    f"WHERE NOT {sqltext.below('doc_id', 7, 10)}",
)
def pipeline_fit_transform(spark: SparkSession, sf: str) -> DataFrame:
    """Index, encode, assemble and model learnt on one part, applied to the other."""
    rest = splits.split_random(labelled(spark, sf), "doc_id", {"train": 7, "test": 3})
    scored = evaluate.score(_pipeline_model(spark, sf), rest.filter("split = 'test'"))
    return scored.select("doc_id", "label", "prediction")


# -- scoring ------------------------------------------------------------------

_FLAG_SCORES = (
    f"WITH {lines_sql('flag')}, {sqltext.naive_bayes('line', LINE_FEATURES, 1.0)}, "
    f"{sqltext.naive_bayes_scores('line', 'n', LINE_FEATURES)} "
)


@query(
    "score_batch",
    _FLAG_SCORES
    + "SELECT id, prediction, round(1 / total, 6) AS probability FROM line JOIN nb_pred USING (n) "
    "JOIN (SELECT n, sum(exp(joint - best)) AS total FROM nb_joint JOIN "
    "(SELECT n, max(joint) AS best FROM nb_joint GROUP BY n) USING (n) GROUP BY n) USING (n)",
)
def score_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Class and its probability for every row."""
    rows = lines(spark, sf, "flag")
    scored = evaluate.score(train.fit_naive_bayes(rows), rows)
    top = F.array_max(vector_to_array("probability"))
    return scored.select("id", "prediction", F.round(top, 6).alias("probability"))


@query(
    "join_score_label",
    _FLAG_SCORES
    + 'SELECT y::DOUBLE AS label, prediction, count(*) AS "count" '
    "FROM line JOIN nb_pred USING (n) GROUP BY ALL",
)
def join_score_label(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions stay beside their labels; here counted as a confusion table."""
    rows = lines(spark, sf, "flag")
    scored = evaluate.score(train.fit_naive_bayes(rows), rows)
    return scored.groupBy("label", "prediction").count()


@query(
    "score_unlabelled_decoded",
    f"WITH {_pipeline_sql()}, {sqltext.naive_bayes_scores('encoded', 'doc_id', _PIPELINE_FEATURES)} "
    "SELECT doc_id, prediction::INTEGER AS prediction, "
    f"CASE prediction WHEN 0 THEN '{PAGE_KIND[0]}' WHEN 1 THEN '{PAGE_KIND[1]}' END AS description "
    "FROM nb_pred ANTI JOIN labels USING (doc_id)",
)
def score_unlabelled_decoded(spark: SparkSession, sf: str) -> DataFrame:
    known = table(spark, sf, "labels").select("doc_id")
    rest = documents(spark, sf).join(known, "doc_id", "left_anti")
    return evaluate.score_decoded(_pipeline_model(spark, sf), rest, PAGE_KIND, ["doc_id"])


@query(
    "score_with_error",
    f"WITH {lines_sql('regression')}, "
    + sqltext.tree("line", LINE_FEATURES, 1, "variance")
    + " SELECT id, round(y, 6) AS label, trunc(prediction)::BIGINT AS prediction, "
    "CASE WHEN y = trunc(prediction) THEN '正确' ELSE '错误' END AS result, "
    "round(abs(y - trunc(prediction)), 6) AS error "
    "FROM line JOIN t_pred USING (n)",
)
def score_with_error(spark: SparkSession, sf: str) -> DataFrame:
    rows = lines(spark, sf, "regression")
    model = train.fit_tree_regressor(rows, depth=1, bins=64, partitions=PARTS)
    compared = evaluate.score_with_error(model, rows, keep=["id"])
    return compared.withColumns({n: F.round(n, 6) for n in ("label", "error")})


# -- evaluation ---------------------------------------------------------------

_GUESS_SQL = """
    guess AS (
        SELECT CASE l_returnflag WHEN 'R' THEN 1 ELSE 0 END AS y,
               l_extendedprice * (1 - l_discount) AS score,
               CASE WHEN l_extendedprice > 40000 THEN 1 ELSE 0 END AS prediction
        FROM lineitem)
"""


def _guesses(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("score"),
        F.when(F.col("l_extendedprice") > 40000, 1.0).otherwise(0.0).alias("prediction"),
    )


@query(
    "eval_auc_hard",
    f"WITH {_GUESS_SQL} SELECT round((avg(prediction) FILTER (y = 1) "
    "+ avg(1 - prediction) FILTER (y = 0)) / 2, 6) AS auc FROM guess",
)
def eval_auc_hard(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.auc_hard(_guesses(spark, sf)).select(F.round("auc", 6).alias("auc"))


@query(
    "eval_auc_score",
    f"""
    WITH {_GUESS_SQL},
    grouped AS (SELECT score, sum(y)::DOUBLE AS p, sum(1 - y)::DOUBLE AS n FROM guess GROUP BY score),
    ranked AS (SELECT *, coalesce(sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
                                               AND 1 PRECEDING), 0) AS below FROM grouped)
    SELECT round(sum(p * (below + n / 2)) / (sum(p) * sum(n)), 6) AS auc FROM ranked
    """,
)
def eval_auc_score(spark: SparkSession, sf: str) -> DataFrame:
    auc = evaluate.auc(_guesses(spark, sf), score="score")
    return _constant(spark, auc=auc).select(F.round("auc", 6).alias("auc"))


@query(
    "eval_accuracy",
    f"WITH {_GUESS_SQL} SELECT round(avg((prediction = y)::INTEGER), 6) AS accuracy FROM guess",
)
def eval_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.accuracy(_guesses(spark, sf)).select(F.round("accuracy", 6).alias("accuracy"))


@query(
    "eval_rmse",
    "SELECT round(sqrt(avg(pow(l_quantity - l_extendedprice / 2000, 2))), 6) AS rmse FROM lineitem",
)
def eval_rmse(spark: SparkSession, sf: str) -> DataFrame:
    guesses = table(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("label"), (F.col("l_extendedprice") / 2000).alias("prediction")
    )
    return evaluate.rmse(guesses).select(F.round("rmse", 6).alias("rmse"))


# -- tuning -------------------------------------------------------------------


def _gd_grid_sql() -> str:
    """All combinations: courses of weights per step size and share of rows, measured after
    each number of steps on the validation part, and the winner on the test part."""
    grid = tune.GRIDS["logistic"]
    ctes = [
        _SCALED_SQL.replace("line AS (", "line AS MATERIALIZED (", 1),
        f"fit AS MATERIALIZED (SELECT * FROM line WHERE {sqltext.below('k', 8, 10)})",
        f"held AS MATERIALIZED (SELECT * FROM line WHERE NOT {sqltext.below('k', 8, 10)} AND {sqltext.below('k', 9, 10)})",
        f"kept AS MATERIALIZED (SELECT * FROM line WHERE NOT {sqltext.below('k', 9, 10)})",
    ]
    courses = {}
    for step in grid["stepSize"]:
        for fraction in grid["miniBatchFraction"]:
            prefix = courses[step, fraction] = f"c{len(courses)}w"
            ctes.append(sqltext.gradient_descent(
                "fit", list(_SCALED), "logistic", max(grid["maxIter"]), step, 0.01, prefix, fraction
            ))
    dot = " + ".join(f"{x} * w{j}" for j, x in enumerate(_SCALED))

    def area(rows: str, weights: str) -> str:
        return (
            "(SELECT (avg((m > 0)::INTEGER) FILTER (y = 1) + avg((m <= 0)::INTEGER) FILTER (y = 0)) / 2"
            f" FROM (SELECT y, {dot} AS m FROM {rows}, {weights}))"
        )

    combinations = [
        (i, s, f) for i in grid["maxIter"] for s in grid["stepSize"] for f in grid["miniBatchFraction"]
    ]
    trials = [
        f"SELECT {t}::BIGINT AS trial, {i}::BIGINT AS \"maxIter\", {s}::DOUBLE AS \"stepSize\","
        f" {f}::DOUBLE AS \"miniBatchFraction\", {area('held', courses[s, f] + str(i))} AS metric,"
        f" {area('kept', courses[s, f] + str(i))} AS test"
        for t, (i, s, f) in enumerate(combinations)
    ]
    ctes.append("trials AS MATERIALIZED (" + " UNION ALL ".join(trials) + ")")
    return (
        "WITH " + ", ".join(ctes) + " SELECT trial, \"maxIter\", \"stepSize\", \"miniBatchFraction\","
        " round(metric, 6) AS metric, trial = best AS chosen, CASE WHEN trial = best THEN round(test, 6) END AS test_metric"
        " FROM trials, (SELECT arg_min(trial, (-metric, trial)) AS best FROM trials)"
    )


def _marked(tuned: tune.Tuned) -> DataFrame:
    """The trial table with the winner marked."""
    chosen = F.lit(True)
    for name, value in tuned.params.items():
        chosen = chosen & (F.col(name) == F.lit(value))
    return tuned.table.withColumn("chosen", chosen).withColumn("metric", F.round("metric", 6))


@query("tune_grid_holdout", _gd_grid_sql())
def tune_grid_holdout(spark: SparkSession, sf: str) -> DataFrame:
    """All 36 combinations at once, chosen on a validation part; the winner's metric on
    test rows that took no part."""
    rows = splits.split_random(scaled_lines(spark, sf), "k", {"train": 8, "validation": 1, "test": 1})
    stage = gradient.GradientDescentClassifier(tol=0.0, keyCol="k")
    part = {name: rows.filter(F.col("split") == name) for name in ("train", "validation", "test")}
    tuned = tune.tune_grid(
        stage, tune.param_grid(stage, tune.GRIDS["logistic"]), part["train"], part["validation"],
        evaluate.hard_auc_evaluator(), test=part["test"], partitions=PARTS,
    )
    test = F.when(F.col("chosen"), F.round(F.lit(tuned.test_metric), 6))
    return _marked(tuned).withColumn("test_metric", test)


def _named_sweep_sql() -> str:
    """Shrinkage of a hinge-loss classifier, from the table of named sweeps."""
    values, held = tune.SWEEPS["svm", "regParam"]
    steps, size = held["maxIter"], held["stepSize"]
    ctes = [
        _SCALED_SQL.replace("line AS (", "line AS MATERIALIZED (", 1),
        f"fit AS MATERIALIZED (SELECT * FROM line WHERE {sqltext.below('k', 8, 10)})",
        f"held AS MATERIALIZED (SELECT * FROM line WHERE NOT {sqltext.below('k', 8, 10)})",
    ]
    dot = " + ".join(f"{x} * w{j}" for j, x in enumerate(_SCALED))
    trials = []
    for t, reg in enumerate(values):
        ctes.append(sqltext.gradient_descent("fit", list(_SCALED), "hinge", steps, size, reg, f"r{t}w"))
        trials.append(
            f"SELECT {t}::BIGINT AS trial, {reg}::DOUBLE AS \"regParam\","
            " (avg((m > 0)::INTEGER) FILTER (y = 1) + avg((m <= 0)::INTEGER) FILTER (y = 0)) / 2 AS metric"
            f" FROM (SELECT y, {dot} AS m FROM held, r{t}w{steps})"
        )
    ctes.append("trials AS MATERIALIZED (" + " UNION ALL ".join(trials) + ")")
    return (
        "WITH " + ", ".join(ctes) + ' SELECT trial, "regParam", round(metric, 6) AS metric,'
        " trial = (SELECT arg_min(trial, (-metric, trial)) FROM trials) AS chosen FROM trials"
    )


@query("tune_sweep_named", _named_sweep_sql())
def tune_sweep_named(spark: SparkSession, sf: str) -> DataFrame:
    rows = splits.split_random(scaled_lines(spark, sf), "k", {"train": 8, "validation": 2})
    tuned = tune.named_sweep(
        "svm", "regParam", rows.filter("split = 'train'"), rows.filter("split = 'validation'"),
        evaluate.hard_auc_evaluator(), partitions=PARTS,
    )
    return _marked(tuned)


def _smoothing_sweep_sql() -> str:
    ctes = [
        lines_sql("flag"),
        "fit AS (SELECT * FROM line WHERE " + sqltext.below("id", 8, 10) + ")",
        "held AS (SELECT * FROM line WHERE NOT " + sqltext.below("id", 8, 10) + ")",
    ]
    trials = []
    for trial, smoothing in enumerate(tune.GRIDS["naive_bayes"]["smoothing"]):
        prefix = f"nb{trial}"
        ctes.append(sqltext.naive_bayes("fit", LINE_FEATURES, smoothing, prefix))
        ctes.append(sqltext.naive_bayes_scores("held", "n", LINE_FEATURES, prefix))
        trials.append(
            f"SELECT {trial}::BIGINT AS trial, {smoothing}::DOUBLE AS smoothing,"
            f" round(avg((prediction = y)::INTEGER), 6) AS metric"
            f" FROM held JOIN {prefix}_pred USING (n)"
        )
    return (
        "WITH " + ", ".join(ctes) + ", trials AS (" + " UNION ALL ".join(trials) + ") SELECT *,"
        " trial = (SELECT arg_min(trial, (-metric, trial)) FROM trials) AS chosen FROM trials"
    )


@query("tune_sweep", _smoothing_sweep_sql())
def tune_sweep(spark: SparkSession, sf: str) -> DataFrame:
    rows = splits.split_random(lines(spark, sf, "flag"), "id", {"train": 8, "validation": 2})
    stage = train.naive_bayes()
    tuned = tune.tune_sweep(
        stage,
        stage,
        "smoothing",
        tune.GRIDS["naive_bayes"]["smoothing"],
        rows.filter("split = 'train'"),
        rows.filter("split = 'validation'"),
        evaluate.accuracy_evaluator(),
        parallelism=4,
        partitions=PARTS,
    )
    return _marked(tuned)


# Line items with features of so few values that any of the searched numbers of bins holds them.
_FEW = {
    "quantity": "floor(l_quantity / 6)", "linenumber": "l_linenumber", "discount": "floor(l_discount * 50)",
}
_FEW_LABEL = LINE_LABELS["multi"]


def _split_search_sql() -> str:
    grid = tune.GRIDS["pipeline_tree"]
    names = ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in _FEW.items())
    ctes = [
        f"line AS MATERIALIZED (SELECT row_number() OVER () AS n, l_orderkey AS k, {names}, ({_FEW_LABEL}) AS y,"
        f" ({sqltext.below('l_orderkey', 4, 5)})::INTEGER AS fit FROM lineitem)"
    ]
    for impurity in grid["impurity"]:
        ctes.append(sqltext.tree(
            "line", list(_FEW), max(grid["maxDepth"]), impurity, CLASSES, impurity, "fit", grid["maxDepth"]
        ))
    trials = [
        f"SELECT {t}::BIGINT AS trial, '{i}' AS impurity, {d}::BIGINT AS \"maxDepth\", {b}::BIGINT AS \"maxBins\","
        f" avg((prediction = y)::INTEGER) AS metric FROM line JOIN {i}_at{d} USING (n) WHERE fit = 0"
        for t, (i, d, b) in enumerate(
            (i, d, b) for i in grid["impurity"] for d in grid["maxDepth"] for b in grid["maxBins"]
        )
    ]
    ctes.append("trials AS MATERIALIZED (" + " UNION ALL ".join(trials) + ")")
    return (
        "WITH " + ", ".join(ctes) + ' SELECT trial, impurity, "maxDepth", "maxBins", round(metric, 6) AS metric,'
        " trial = (SELECT arg_min(trial, (-metric, trial)) FROM trials) AS chosen FROM trials"
    )


@query("tune_tvs", _split_search_sql())
def tune_tvs(spark: SparkSession, sf: str) -> DataFrame:
    """All 18 trees on one split by key hash."""
    columns = {**{n: f"double({e})" for n, e in _FEW.items()}, "label": f"double({_FEW_LABEL})"}
    raw = table(spark, sf, "lineitem").selectExpr("l_orderkey AS k", *[f"{e} AS {n}" for n, e in columns.items()])
    rows = features.assemble(raw, list(_FEW)).select("k", "features", "label")
    stage = train.tree_classifier()
    grid = tune.param_grid(stage, tune.GRIDS["pipeline_tree"])
    search = tune.tune_split(stage, grid, evaluate.accuracy_evaluator(), "k", parallelism=4, partitions=PARTS)
    searched = search.fit(rows)
    chosen = F.col("trial") == searched.bestIndex
    trials = tune.validation_table(spark, searched, grid).withColumn("chosen", chosen)
    return trials.withColumn("metric", F.round("metric", 6))


def _folds_sql() -> str:
    smoothings = tune.GRIDS["naive_bayes"]["smoothing"]
    fold = sqltext.key_hash("id", "fold:") + " % 3"
    ctes = [
        lines_sql("flag"),
        f"folded AS (SELECT *, {fold} AS fold FROM line)",
    ]
    measured = []
    for k in range(3):
        ctes.append(f"fit{k} AS (SELECT * FROM folded WHERE fold <> {k})")
        ctes.append(f"held{k} AS (SELECT * FROM folded WHERE fold = {k})")
        for trial, smoothing in enumerate(smoothings):
            prefix = f"nb{k}{trial}"
            ctes.append(sqltext.naive_bayes(f"fit{k}", LINE_FEATURES, smoothing, prefix))
            ctes.append(sqltext.naive_bayes_scores(f"held{k}", "n", LINE_FEATURES, prefix))
            measured.append(
                f"SELECT {trial}::BIGINT AS trial, {smoothing}::DOUBLE AS smoothing,"
                f" avg((prediction = y)::INTEGER) AS metric FROM held{k} JOIN {prefix}_pred USING (n)"
            )
    return (
        "WITH " + ", ".join(ctes) + " SELECT trial, smoothing, round(avg(metric), 6) AS metric FROM ("
        + " UNION ALL ".join(measured)
        + ") GROUP BY trial, smoothing"
    )


@query("tune_cv", _folds_sql())
def tune_cv(spark: SparkSession, sf: str) -> DataFrame:
    fold = (splits.key_hash("id", "fold:") % 3).cast("int")
    rows = lines(spark, sf, "flag").withColumn("fold", fold)
    stage = train.naive_bayes()
    grid = tune.param_grid(stage, tune.GRIDS["naive_bayes"])
    search = tune.tune_folds(
        stage, grid, evaluate.accuracy_evaluator(), folds=3, fold_col="fold", parallelism=4
    )
    table_ = tune.validation_table(spark, tune.run_search(search, rows, PARTS), grid)
    return table_.withColumn("metric", F.round("metric", 6))
