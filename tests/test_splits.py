import pytest
from pyspark.sql import functions as F

from larkspur.operators import splits


def labels(df, name="split"):
    return {r["id"]: r[name] for r in df.collect()}


def test_random_split_is_complete_and_stable(events):
    weights = {"train": 8, "validation": 1, "test": 1}
    once = labels(splits.split_random(events, "id", weights, seed=5))
    again = labels(splits.split_random(events.repartition(13), "id", weights, seed=5))
    assert once == again and len(once) == events.count() and set(once.values()) == set(weights)
    assert labels(splits.split_random(events, "id", weights, seed=6)) != once


def test_random_split_proportions(spark):
    counts = splits.split_random(spark.range(20_000), "id", {"a": 0.7, "b": 0.3}).groupBy("split").count()
    found = {r["split"]: r["count"] for r in counts.collect()}
    assert abs(found["a"] / 20_000 - 0.7) < 0.02


def test_one_part_is_no_split(spark):
    with pytest.raises(ValueError):
        splits.split_random(spark.range(1), "id", {"a": 1})


def expected_nth(events, start, stop, cap=0):
    seen, taken, result = {}, 0, {}
    for r in sorted(events.collect(), key=lambda r: (r["at"], r["id"])):
        seen[r["user"]] = seen.get(r["user"], 0) + 1
        test = start <= seen[r["user"]] <= stop and (cap <= 0 or taken < cap)
        taken += test
        result[r["id"]] = "test" if test else "base"
    return result


@pytest.mark.parametrize(
    "start, stop, cap",
    [(1, 10, 0), (11, 20, 0), (15, 30, 0), (1, 10, 33), (5, 25, 1), (1, 10, 10_000), (1, 2000, 0)],
)
def test_nth_per_key(events, start, stop, cap):
    """User 1 has exactly 20 rows, fewer than some starts need."""
    split = splits.split_nth_per_key(events, "user", ["at", "id"], start, stop, cap)
    assert split.columns == [*events.columns, "split"]
    assert labels(split) == expected_nth(events, start, stop, cap)


def test_nth_rows_are_cut_down_before_the_shuffle(events):
    split = splits.split_nth_per_key(events, "user", ["at", "id"], 1, 10)
    plan = split._jdf.queryExecution().executedPlan().toString()
    # Before and after each of two shuffles: by key and salt, then by key.
    assert plan.count("WindowGroupLimit") == 4 and "_key#" in plan


def test_ties_in_the_order_give_exact_sizes(spark):
    df = spark.range(900).select("id", (F.col("id") % 3).alias("user"), F.lit(1).alias("at"))
    split = splits.split_nth_per_key(df, "user", ["at"], 4, 11)
    sizes = split.groupBy("user", "split").count().collect()
    assert sorted((r["user"], r["split"], r["count"]) for r in sizes) == [
        (u, s, n) for u in range(3) for s, n in (("base", 292), ("test", 8))
    ]
    again = splits.split_nth_per_key(df.repartition(9), "user", ["at"], 4, 11)
    assert split.exceptAll(again).count() == 0


def test_two_nth_splits_are_disjoint(events):
    a = labels(splits.split_nth_per_key(events, "user", ["at", "id"], 1, 10))
    b = labels(splits.split_nth_per_key(events, "user", ["at", "id"], 11, 20))
    assert not [i for i in a if a[i] == b[i] == "test"]
    assert sum(v == "test" for v in a.values()) == 10 * 8


def test_kfold_covers_every_row_once(events):
    folds = splits.split_kfold(events, ["at", "id"], 5)
    sizes = [r["count"] for r in folds.groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1 and sum(sizes) == events.count()
    assert labels(folds, "fold") == labels(
        splits.split_kfold(events.repartition(3), ["at", "id"], 5), "fold"
    )


def test_key_hash_matches_md5(spark):
    import hashlib

    row = spark.range(1).select(splits.key_hash(F.lit("42")).alias("h"), splits.key_hash(F.lit("42"), "s:").alias("g"))
    first = row.first()
    assert first["h"] == int(hashlib.md5(b"42").hexdigest()[:8], 16)
    assert first["g"] == int(hashlib.md5(b"s:42").hexdigest()[:8], 16)
