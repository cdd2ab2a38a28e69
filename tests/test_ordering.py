import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspur.operators import ordering


def test_position(events):
    placed = ordering.with_position(events, ["at", "id"]).orderBy("position").collect()
    assert [r["position"] for r in placed] == list(range(events.count()))
    keys = [(r["at"], r["id"]) for r in placed]
    assert keys == sorted(keys)


def test_position_descending(spark):
    placed = ordering.with_position(spark.range(50), [F.desc("id")])
    assert placed.filter("id + position <> 49").count() == 0


def test_position_of_nothing(spark):
    assert ordering.with_position(spark.range(0), ["id"]).count() == 0
    assert ordering.position_folds(spark.range(0), ["id"], 3).count() == 0


@pytest.mark.parametrize("k", [1, 2, 5, 7])
def test_folds_are_contiguous_and_even(events, k):
    n = events.count()
    folds = ordering.position_folds(events, ["at", "id"], k).orderBy("at", "id").collect()
    assert [r["fold"] for r in folds] == [i * k // n for i in range(n)]


def test_more_folds_than_rows(spark):
    folds = ordering.position_folds(spark.range(3), ["id"], 7).orderBy("id").collect()
    assert [r["fold"] for r in folds] == [0, 2, 4]


@pytest.mark.parametrize("group_rows", [10_000, 100, 25])
def test_running_count_with_and_without_hot_keys(events, group_rows):
    window = Window.partitionBy("user").orderBy("at", "id")
    plain = events.withColumn("n", F.row_number().over(window).cast("bigint"))
    ours = ordering.nth_per_key(events, "user", ["at", "id"], group_rows=group_rows)
    assert ours.columns == plain.columns
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0


def test_running_count_sends_hot_rows_to_many_tasks(events):
    ours = ordering.nth_per_key(events, "user", ["at", "id"], group_rows=100)
    tasks = ours.filter("user = 7").select(F.spark_partition_id().alias("p"), "n")
    plan = ours._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and tasks.count() == 260


def test_running_count_over_two_key_columns(events):
    two = events.withColumn("half", F.col("at") % 2)
    window = Window.partitionBy("user", "half").orderBy("at", "id")
    plain = two.withColumn("n", F.row_number().over(window).cast("bigint"))
    ours = ordering.nth_per_key(two, ["user", "half"], ["at", "id"], group_rows=40)
    assert ours.exceptAll(plain).count() == 0 and ours.count() == plain.count()


def test_dense_index(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",)], "x string")
    found = ordering.dense_index(df, "x").collect()
    assert sorted((str(r[0]), r[1]) for r in found) == [
        ("None", None), ("a", 0), ("b", 1), ("b", 1), ("c", 2)
    ]


def test_sort_spreads_a_hot_value(spark):
    """A third of the rows, or all of them, share one value; no range owns them all."""
    skewed = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 1000).alias("v"), "id"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for frame in (skewed, spark.range(60_000).select(F.lit(1).alias("v"))):
            done = ordering.sort_rows(frame, "v")
            sizes = done.groupBy(F.spark_partition_id()).count().collect()
            assert max(r["count"] for r in sizes) < 60_000 * 0.3
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    values = [r["v"] for r in ordering.sort_rows(skewed, "v").collect()]
    assert values == sorted(values)


def test_top_k_keeps_what_reaches_the_key(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("v"))
    found = ordering.top_k(df, 5, ordering.By("v", falling=True))
    assert [r["v"] for r in found.collect()] == [19_999, 19_998, 19_997, 19_996, 19_995]
    key, reached = ordering._threshold(df.select(F.col("v").cast("double").alias("key")), 50)
    assert 50 <= reached <= 120 and key < 120
    for k in (0, 1, 19_999, 20_000, 30_000):
        assert [r["v"] for r in ordering.top_k(df, k, "v").collect()] == list(range(min(k, 20_000)))


def test_top_k_breaks_ties_alike(spark):
    df = spark.range(600).select("id", (F.col("id") % 3).alias("v")).repartition(7)
    first = [tuple(r) for r in ordering.top_k(df, 250, "v").collect()]
    assert [tuple(r) for r in ordering.top_k(df.repartition(4), 250, "v").collect()] == first
    assert [v for _, v in first] == [0] * 200 + [1] * 50


@pytest.mark.parametrize("falling", [False, True])
@pytest.mark.parametrize(
    "kind, values",
    [
        ("string", [None, "", "a", "aaaaaaaa", "aaaaaaab", "é", "zz", "\U0001f600"]),
        ("double", [None, float("nan"), float("inf"), -1.5, 0.0, 3.25]),
        ("boolean", [None, True, False]),
        ("bigint", [None, -(2**62), 2**62, 2**62 + 1, 0]),
        ("decimal(20,3)", [None, "1.5", "-2.25", "7"]),
        ("date", [None, "2024-01-02", "1969-12-31"]),
        ("timestamp", [None, "2024-01-02 03:04:05.000001", "2024-01-02 03:04:05.000002"]),
    ],
)
def test_top_k_of_every_kind(spark, kind, values, falling):
    rows = [(i, values[i % len(values)]) for i in range(40)]
    text = kind in ("decimal(20,3)", "date", "timestamp")
    df = spark.createDataFrame(rows, f"id int, v {'string' if text else kind}").withColumn("v", F.col("v").cast(kind))
    by = ordering.By("v", falling)
    every = [r["id"] for r in df.orderBy(by.order(), "id").collect()]
    for k in (1, 6, 21):
        assert [r["id"] for r in ordering.top_k(df, k, by, "id").collect()] == every[:k]


def test_null_keys_of_a_dense_index_are_not_joined(spark):
    df = spark.range(100).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("x"))
    found = ordering.dense_index(df, "x")
    assert found.where("x is null and x_index is null").count() == 50 and found.where("x_index = x / 2").count() == 50


def test_odd_columns_pass_through(spark):
    df = spark.range(40).select(
        "id", F.lit(1).alias("links.ratio"), F.create_map(F.lit("a"), F.col("id")).alias("m")
    )
    for done in (
        ordering.sort_rows(df, "id"),
        ordering.with_position(df, ["id"]),
        ordering.position_folds(df, ["id"], 4),
        ordering.nth_per_key(df.withColumn("key", F.lit(1)), "key", ["id"], group_rows=5),
        ordering.top_k(df, 40, "id"),
    ):
        assert done.columns[:3] == ["id", "links.ratio", "m"] and done.count() == 40
