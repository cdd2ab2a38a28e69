import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from larkspur.operators import relational


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def people(spark):
    data = [
        (1, "85711", "M", "writer"), (2, "T8H1N", "F", "writer"), (3, "07102", "M", "other"),
        (4, "99999", "F", "other"), (5, None, "F", "writer"),
    ]
    return spark.createDataFrame(data, "id int, zip string, gender string, job string")


@pytest.fixture()
def places(spark):
    return spark.createDataFrame([(85711, "AZ"), (7102, "NJ"), (501, "NY")], "zipcode int, state string")


def test_mixed_key_join_keeps_every_left_row(people, places):
    joined = relational.left_join(people, places, [("zip", "zipcode")], cast="int")
    assert rows(joined.select("id", "state")) == [
        (1, "AZ"), (2, None), (3, "NJ"), (4, None), (5, None)
    ]


def test_join_group_count_equals_counting_the_join(spark):
    chance = random.Random(3)
    # Key 0 owns a third of the left side; right keys may occur twice or not at all.
    left = [(0 if i % 3 == 0 else chance.choice([None, *range(1, 9)]),) for i in range(600)]
    right = [(k, chance.choice(["a", "b", None])) for k in (0, 0, 1, 2, 2, 5, 7)]
    l_df = spark.createDataFrame(left, "k int")
    r_df = spark.createDataFrame(right, "z int, state string")
    plain = l_df.join(r_df, l_df.k == r_df.z, "left").groupBy("state").count()
    assert rows(relational.join_group_count(l_df, r_df, ("k", "z"), "state")) == rows(plain)


def test_join_group_count_with_cast(people, places):
    counts = relational.join_group_count(people, places, ("zip", "zipcode"), "state", cast="int")
    assert rows(counts) == [("AZ", 1), ("NJ", 1), (None, 3)]


def test_outer_join_with_right_filter_becomes_inner(people, places):
    joined = relational.left_join(people, places, [("zip", "zipcode")], cast="int")
    plan = joined.filter("state = 'NJ'")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "LeftOuter" not in plan


def test_lookup(spark, places):
    ids = spark.createDataFrame([(501,), (9,)], "z int")
    assert rows(relational.lookup(ids, places, ("z", "zipcode"), "state")) == [(501, "NY"), (9, None)]
    assert rows(relational.lookup(ids, places, ("z", "zipcode"), "state", how="inner")) == [(501, "NY")]
    known = relational.lookup(ids.filter("z = 501"), places, ("z", "zipcode"), "state", strict=True)
    assert rows(known) == [(501, "NY")]
    with pytest.raises(PySparkException, match="no state for z 9"):
        relational.lookup(ids, places, ("z", "zipcode"), "state", strict=True).collect()


def test_lookup_of_a_repeated_key_keeps_the_rows(spark):
    ids = spark.createDataFrame([(1,), (2,)], "z int")
    dim = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, name string")
    assert rows(relational.lookup(ids, dim, ("z", "k"), "name")) == [(1, "a"), (2, "c")]


def test_crosstab_equals_builtin(people):
    ours = relational.crosstab(people, "job", "gender")
    builtin = people.stat.crosstab("job", "gender")
    assert ours.columns == ["job_gender", "F", "M"]
    assert rows(ours) == rows(builtin.select(ours.columns)) == [("other", 1, 1), ("writer", 2, 1)]
    assert rows(relational.crosstab(people, "job", "gender", ["F", "M", "X"])) == [
        ("other", 1, 1, 0), ("writer", 2, 1, 0)
    ]
    with pytest.raises(PySparkException, match="not listed"):
        relational.crosstab(people, "job", "gender", ["F", "X"]).collect()


def test_crosstab_of_numbers_keeps_the_null_row(spark):
    df = spark.createDataFrame([(1, 0.5), (None, 0.5), (1, 1.5)], "a int, b double")
    table = relational.crosstab(df, "a", "b")
    assert table.columns == ["a_b", "0.5", "1.5"]
    assert rows(table) == [(1, 1, 1), (None, 1, 0)]


def test_counts_and_shares(people):
    assert rows(relational.group_count(people, "gender")) == [("F", 3), ("M", 2)]
    ordered = relational.group_count(people, ["gender", "job"], order=True)
    assert [tuple(r) for r in ordered.collect()] == [
        ("F", "other", 1), ("F", "writer", 2), ("M", "other", 1), ("M", "writer", 1)
    ]
    assert rows(relational.group_share(people, "gender")) == [("F", 3, 60.0), ("M", 2, 40.0)]
    assert rows(relational.count_distinct(people, ["gender", "zip"])) == [(2, 4)]


def test_feature_stats(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert rows(relational.feature_stats(df, ["a", "b"])) == [("a", 2.0, 2**0.5), ("b", 5.0, 0.0)]


def test_complement_takes_unknown_rows(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    hit, rest = relational.split_by(df, F.col("x") > 1)
    assert rows(hit) == [(2,)] and rows(rest) == [(1,), (None,)]
