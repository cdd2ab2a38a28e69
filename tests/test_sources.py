import pytest
from pyspark.ml.feature import StandardScalerModel

from larkspur.operators import features
from larkspur.session import materialize, scratch_root
from larkspur.sources import (
    apply_types,
    cached,
    drop_header_rows,
    load_or_fit,
    read_delimited,
    read_wide,
    register,
    save_model,
    spread,
    wide_string_schema,
    write_delimited,
    write_split,
)


@pytest.fixture()
def users(tmp_path):
    path = tmp_path / "users.txt"
    path.write_text("1|24|M|technician|85711\n2|53|F|other|T8H1N\n3|x|M|writer|07102\n")
    return str(path)


def test_headerless_text_with_schema(spark, users):
    schema = "userid int, age int, gender string, occupation string, zipcode string"
    rows = read_delimited(spark, users, "|", schema, header=False).orderBy("userid").collect()
    assert [tuple(r) for r in rows] == [
        (1, 24, "M", "technician", "85711"),
        (2, 53, "F", "other", "T8H1N"),
        (3, None, "M", "writer", "07102"),
    ]


def test_quoted_separator_quote_and_header(spark, tmp_path):
    path = tmp_path / "zip.csv"
    path.write_text('"zip","city","state"\n"00501","Holtsville, ""old""","NY"\n"00601","?","PR"\n')
    df = read_delimited(spark, str(path))
    assert df.dtypes == [("zip", "string"), ("city", "string"), ("state", "string")]
    assert [tuple(r) for r in df.orderBy("zip").collect()] == [
        ("00501", 'Holtsville, "old"', "NY"),
        ("00601", "?", "PR"),
    ]


def test_repeated_header_lines_go_everywhere(spark, tmp_path):
    path = tmp_path / "hours.csv"
    path.write_text("hr,cnt\n1,16\nhr,cnt\n2,40\n,\nhr,cnt\n")
    df = read_delimited(spark, str(path), header=False)
    rows = drop_header_rows(df, ["hr", "cnt"]).collect()
    assert sorted((r[0] or "", r[1] or "") for r in rows) == [("", ""), ("1", "16"), ("2", "40")]


def test_wide_schema_follows_first_row(spark, tmp_path):
    path = tmp_path / "cover.data"
    path.write_text("\n".join(",".join(str(i + j) for j in range(55)) for i in range(3)))
    df = read_wide(spark, str(path))
    assert df.columns == [f"f{i}" for i in range(55)] == wide_string_schema(55).names
    assert set(t for _, t in df.dtypes) == {"string"}
    assert df.count() == 3


def test_apply_types_turns_bad_text_into_null(spark):
    df = spark.createDataFrame([("7", "1e3", "a"), ("T8H1N", "?", "b")], "i string, d string, s string")
    typed = apply_types(df, {"i": "int", "d": "double", "s": "string"})
    assert [tuple(r) for r in typed.collect()] == [(7, 1000.0, "a"), (None, None, "b")]


def test_delimited_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi"\tthere'), (2, None)], "id int, text string")
    path = write_delimited(df, str(tmp_path / "out"), "\t")
    again = read_delimited(spark, path, "\t", df.schema).orderBy("id").collect()
    assert [tuple(r) for r in again] == [(1, 'say "hi"\tthere'), (2, None)]


def test_view(spark):
    register(spark.range(5).toDF("id"), "five")
    assert spark.sql("select count(*) as n from five").first()["n"] == 5


def test_cached_releases_also_after_an_error(spark):
    df = spark.range(10)
    with pytest.raises(RuntimeError), cached(df) as (kept,):
        assert kept.is_cached and kept.count() == 10
        raise RuntimeError
    assert not kept.is_cached


def test_spread_does_nothing_unasked(spark):
    for df in (spark.range(1000, numPartitions=1), spark.range(10**12)):
        assert spread(df) is df


def test_spread_takes_a_number(spark):
    df = spark.range(1000, numPartitions=3)
    assert spread(df, 7).rdd.getNumPartitions() == 7
    with cached(df, partitions=5) as (kept,):
        assert kept.rdd.getNumPartitions() == 5


def test_split_is_written_sorted(spark, tmp_path, events):
    test, base = events.filter("id % 2 = 0"), events.filter("id % 2 = 1")
    labelled = events.selectExpr("*", "if(id % 2 = 0, 'test', 'base') as split")
    paths = write_split(labelled, str(tmp_path / "s"), ["user", "at"])
    rows = [tuple(r) for r in spark.read.parquet(paths["test"]).collect()]
    assert len(rows) == test.count() and spark.read.parquet(paths["base"]).count() == base.count()
    # Within each part file rows are in key order.
    by_file = {}
    for r in spark.read.parquet(paths["test"]).selectExpr("input_file_name() f", "user", "at").collect():
        by_file.setdefault(r["f"], []).append((r["user"] or -1, r["at"]))
    assert all(keys == sorted(keys) for keys in by_file.values())


def test_scratch_folder_is_the_configured_one(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    kept = materialize(spark.range(3).toDF("id"))
    assert kept.count() == 3 and scratch_root(spark) in kept.inputFiles()[0]


def test_load_or_fit(spark, tmp_path):
    df = features.assemble(spark.createDataFrame([(1.0,), (3.0,)], "x double"), ["x"])
    path, fits = str(tmp_path / "scaler"), []

    def fit():
        fits.append(1)
        return features.standardize(df)

    first = load_or_fit(spark, path, StandardScalerModel, fit)
    second = load_or_fit(spark, path, StandardScalerModel, fit)
    assert len(fits) == 1 and first.mean == second.mean
    # A model that is there but damaged is reported, not replaced.
    broken = str(tmp_path / "broken")
    save_model(first, broken)
    for part in (tmp_path / "broken" / "data").glob("*.parquet"):
        part.write_bytes(b"")
    with pytest.raises(Exception):
        load_or_fit(spark, broken, StandardScalerModel, fit)
    assert len(fits) == 1


def test_line_breaks_empty_text_and_null_survive(spark, tmp_path):
    values = [(1, 'one\ntwo, "three"\n'), (2, ""), (3, None), (4, "plain"), (5, " spaced ")]
    rows = spark.createDataFrame(values, "id int, text string")
    path = write_delimited(rows, str(tmp_path / "out"), null="\\N")
    back = read_delimited(spark, path, schema="id int, text string", null="\\N", multiline=True)
    assert sorted(map(tuple, back.collect())) == values
