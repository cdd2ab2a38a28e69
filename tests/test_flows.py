import numpy as np
import pytest

from larkspur.functions import COVER_NAMES, PAGE_KIND
from larkspur.operators import evaluate, gradient, relational, train, tune
from larkspur.operators.splits import split_random
from larkspur.plans import flows
from larkspur.sources import read_delimited, read_wide


def test_users_by_state(spark, tmp_path):
    (tmp_path / "users").write_text("1|24|M|writer|07102\n2|53|F|other|T8H1N\n3|30|F|writer|99999\n")
    (tmp_path / "zips").write_text(
        '"Zipcode","Type","City","State","Lat"\n"07102","STANDARD","NEWARK","NJ",40.7\n'
    )
    users = flows.read_users(spark, str(tmp_path / "users"))
    zips = flows.read_zipcodes(spark, str(tmp_path / "zips"))
    counts = relational.join_group_count(users, zips, ("zipcode", "zipcode"), "state", cast="int")
    assert {tuple(r) for r in counts.collect()} == {("NJ", 1), (None, 2)}


def test_rating_splits(spark, tmp_path):
    lines = [f"{u}\t{i}\t{(u * i) % 5 + 1}\t{880000000 + u * i}" for u in range(1, 7) for i in range(1, 26)]
    (tmp_path / "ratings").write_text("\n".join(lines))
    (tmp_path / "items").write_text("1|A Film (1995)|01-Jan-1995||http://x|0|1\n")
    items = flows.read_items(spark, str(tmp_path / "items"))
    assert [tuple(r) for r in items.collect()] == [(1, "A Film (1995)")]
    ratings = flows.read_ratings(spark, str(tmp_path / "ratings"))
    sizes = {
        name: (base.count(), test.count())
        for name, base, test in flows.rating_splits(ratings, ["rated_at", "user", "item"])
    }
    assert sizes == {**{f"u{i}": (120, 30) for i in range(1, 6)}, "ua": (90, 60), "ub": (90, 60)}


def test_written_rating_sets_are_the_splits(spark, tmp_path):
    """Uneven users, one without a name and one with few rows; a capped test side."""
    rows = [(u, i, float(i % 5), 1000 + (u or 0) * 7 + i * 13) for u in (1, 2, None) for i in range(30)] + [(4, 1, 1.0, 5)]
    ratings = spark.createDataFrame(rows, flows.RATING_SCHEMA)
    order = ["rated_at", "user", "item"]
    paths = flows.write_rating_splits(ratings, str(tmp_path / "sets"), order, 25)
    for name, base, test in flows.rating_splits(ratings, order, 25):
        for side, expected in (("base", base), ("test", test)):
            found = spark.read.parquet(paths[name][side])
            assert found.columns == ratings.columns
            assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    parts = sorted((tmp_path / "sets" / "set=u1" / "side=base").glob("part-*"))
    users = [r.user or 0 for p in parts for r in spark.read.parquet(str(p)).collect()]
    assert users == sorted(users)
    with pytest.raises(ValueError, match="side"):
        flows.write_rating_splits(ratings.withColumn("side", ratings.user), str(tmp_path / "no"), order)


def test_sentences_of_recommendations_and_covers(spark):
    ranked = spark.createDataFrame(
        [(7, 1, 3, "A Film", 4.256), (7, 2, 9, None, 4.0)], "user int, rank int, item int, title string, score double"
    )
    said = [tuple(r) for r in ranked.orderBy("rank").select(flows.items_sentence(), flows.users_sentence()).collect()]
    assert said == [
        ("user 7, choice 1: A Film, score 4.26", "item 3 (A Film), choice 1: user 7, score 4.26"),
        ("user 7, choice 2: item 9, score 4.0", "item 9 (untitled), choice 2: user 7, score 4.0"),
    ]
    names = list(COVER_NAMES.values())
    covers = spark.createDataFrame([(*range(6), 2.0, 2.0), (*range(6), 1.0, 2.0)], [*names, "label", "prediction"])
    said = [r[0] for r in covers.select(flows.cover_sentence()).collect()]
    assert said[0].startswith(f"{names[0]} 0, {names[1]} 1, ")
    assert [s.split("predicted ")[1] for s in said] == ["kind 2, true kind 2: 正确", "kind 2, true kind 1: 错误"]


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    """Evergreen pages have long texts; one category occurs in the unlabelled file only."""
    chance = np.random.default_rng(4)
    folder = tmp_path_factory.mktemp("pages")

    def line(i, labelled, category):
        label = int(chance.random() < 0.5)
        size = "?" if i % 17 == 0 else f"{50 + 400 * label + 60 * chance.normal():.2f}"
        fields = [f"http://p{i}", str(i), '{""title"":""a, b""}', category, size, f"{chance.normal():.3f}"]
        return "\t".join(f'"{f}"' for f in fields + ([str(label)] if labelled else []))

    head = ["url", "urlid", "boilerplate", "alchemy_category", "size", "links.ratio"]
    train_lines = ["\t".join(head + ["label"])] + [line(i, True, "?" if i % 3 else "sports") for i in range(300)]
    test_lines = ["\t".join(head)] + [line(i, False, "weather") for i in range(40)]
    (folder / "train").write_text("\n".join(train_lines))
    (folder / "test").write_text("\n".join(test_lines))
    return [read_delimited(spark, str(folder / side), "\t") for side in ("train", "test")]


@pytest.mark.parametrize("kind", ["tree", "descent", "bayes"])
def test_page_classification(pages, kind):
    model, scale, floor = {
        "tree": (train.tree_classifier(depth=3, bins=14), None, None),
        "descent": (
            gradient.GradientDescentClassifier(featuresCol="scaled", maxIter=15, stepSize=10.0), "mean", None
        ),
        "bayes": (train.naive_bayes(6.0, features="scaled"), "std", 0.0),
    }[kind]
    known = flows.prepare_pages(pages[0], floor=floor)
    assert known.columns == ["url", "alchemy_category", "size", "links.ratio", "label"]
    named = known.withColumnRenamed("links.ratio", "links")
    parts = split_random(named, "url", {"train": 8, "test": 2})
    pipeline = flows.page_pipeline(named, model, scale)
    fitted = pipeline.fit(parts.filter("split = 'train'"))
    scored = evaluate.score(fitted, parts.filter("split = 'test'"))
    assert evaluate.auc_hard(scored).first()["auc"] > (0.6 if kind == "bayes" else 0.8)
    fresh = flows.prepare_pages(pages[1], labelled=False, floor=floor).withColumnRenamed("links.ratio", "links")
    decoded = evaluate.score_decoded(fitted, fresh, PAGE_KIND, ["url"])
    assert decoded.count() == 40 and {r["description"] for r in decoded.collect()} <= set(PAGE_KIND.values())


def test_terrain_cover(spark, tmp_path):
    rows = [[(i * (j + 3)) % 97 for j in range(54)] + [(i * 3) % 97 // 14 + 1] for i in range(400)]
    (tmp_path / "cover").write_text("\n".join(",".join(map(str, r)) for r in rows))
    cover = flows.prepare_cover(read_wide(spark, str(tmp_path / "cover")))
    assert cover.columns == [*(f"f{i}" for i in range(54)), "label"]
    assert sorted(r[0] for r in cover.select("label").distinct().collect()) == [0, 1, 2, 3, 4, 5, 6]
    # f0 alone decides the class: deep enough for one split per class, a bin per value.
    fitted = flows.cover_pipeline(cover, train.tree_classifier(depth=10, bins=100)).fit(cover)
    scored = evaluate.score(fitted, cover)
    assert evaluate.accuracy(scored).first()["accuracy"] == 1.0
    assert flows.present_cover(scored).columns == [
        "海拔", "方位", "斜率", "垂直距离", "水平距离", "阴影", "label", "prediction"
    ]


@pytest.mark.parametrize("kind", ["tree", "gbt"])
def test_hourly_rentals(spark, tmp_path, kind):
    head = (
        "instant,dteday,season,yr,mnth,hr,holiday,weekday,workingday,weathersit,"
        "temp,atemp,hum,windspeed,casual,registered,cnt"
    )
    lines = [
        f"{i},2011-01-01,{i % 4 + 1},0,{i % 12 + 1},{i % 24},0,{i % 7},1,{i % 3 + 1},"
        f"0.5,0.25,0.81,0.1,3,{10 * (i % 24)},{10 * (i % 24) + 3}"
        for i in range(400)
    ]
    (tmp_path / "hour.csv").write_text("\n".join([head, *lines]))
    hours = flows.prepare_rentals(read_delimited(spark, str(tmp_path / "hour.csv")))
    assert len(hours.columns) == 12 and set(t for _, t in hours.dtypes) == {"double"}
    model = {
        "tree": train.tree_regressor(depth=5, bins=24, label="cnt"),
        "gbt": train.gbt_regressor(depth=5, bins=25, iterations=5, label="cnt"),
    }[kind]
    scored = evaluate.score(flows.rental_pipeline(hours, model).fit(hours), hours)
    assert evaluate.rmse(scored, label="cnt").first()["rmse"] < 15
    text = scored.orderBy("hr").select(flows.rental_sentence()).first()[0]
    assert text.startswith("month 1 (春), hour 0, day ") and "; degrees 20.5, felt as 12.5; humidity 81.0; wind " in text


def test_sweeps_name_real_parameters():
    stages = {
        "tree": train.tree_classifier(), "regression_tree": train.tree_regressor(),
        "naive_bayes": train.naive_bayes(), "logistic": gradient.GradientDescentClassifier(),
        "svm": gradient.GradientDescentClassifier(loss="hinge"),
    }
    for (kind, param), (values, held) in tune.SWEEPS.items():
        grid = tune.param_grid(stages[kind], {param: values, **{k: [v] for k, v in held.items()}})
        assert len(grid) == len(values)
