from pyspark.sql import functions as F

from larkspur.functions import (
    PAGE_KIND,
    WEEKDAY,
    abs_error,
    clean_numeric,
    decode,
    match_flag,
    sentence,
    split_fields,
    strip_quotes,
)
from larkspur.operators import prep


def one(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_clean_numeric(spark):
    df = spark.createDataFrame([("?",), ("-1.5",), ("",), ("1e3",), (None,), ("abc",)], "x string")
    assert one(df, clean_numeric("x")) == [(0.0,), (-1.5,), (None,), (1000.0,), (None,), (None,)]
    assert one(df, clean_numeric("x", floor=0.0)) == [
        (0.0,), (0.0,), (None,), (1000.0,), (None,), (None,)
    ]
    assert one(df.limit(1), clean_numeric("x", fill=7.0)) == [(7.0,)]


def test_decode(spark):
    df = spark.createDataFrame([(0,), (6,), (9,), (None,)], "d int")
    assert one(df, decode("d", WEEKDAY)) == [("一",), ("日",), (None,), (None,)]
    assert one(df, decode("d", WEEKDAY, "?"))[2:] == [("?",), ("?",)]
    scored = spark.createDataFrame([(1.0,)], "p double")
    assert one(scored, decode(F.col("p").cast("int"), PAGE_KIND)) == [(PAGE_KIND[1],)]


def test_error_and_flag_truncate_toward_zero(spark):
    df = spark.createDataFrame([(3.0, 2.9), (3.0, 3.9), (-1.0, -1.9)], "label double, p double")
    assert one(df, abs_error("label", "p")) == [(1.0,), (0.0,), (0.0,)]
    flags = one(df, match_flag("label", F.col("p").cast("bigint"), "yes", "no"))
    assert flags == [("no",), ("yes",), ("yes",)]


def test_text(spark):
    df = spark.createDataFrame([('1|a "b"|', 3)], "line string, n int")
    a, b, c, d = split_fields("line", "|", 4)
    assert one(df, a, strip_quotes(b), c, d) == [("1", "a b", "", None)]
    tabbed = spark.createDataFrame([("x\ty",)], "line string")
    assert one(tabbed, *split_fields("line", "\t", 2)) == [("x", "y")]
    assert one(df, sentence("n is ", F.col("n"), ".")) == [("n is 3.",)]


def test_prep(spark):
    df = spark.createDataFrame([("1", "?", "0.5", "-2")], "a string, b string, temp string, d string")
    typed = prep.cast_columns(df, ["a", "b"])
    assert typed.columns == df.columns and one(typed, "a", "b") == [(1.0, None)]
    cleaned = prep.clean_columns(df, ["b", "d"], floor=0.0)
    assert one(cleaned, "b", "d") == [(0.0, 0.0)]
    assert prep.feature_columns(df, start=1, stop=-1) == ["b", "temp"]
    real = prep.denormalize(prep.cast_columns(df, ["temp"]), {"temp": 41})
    assert one(real, "temp") == [(20.5,)]
    assert one(prep.with_expr(typed, "birthyear", "2016 - a"), "birthyear") == [(2015.0,)]


def test_unknown_feature_is_an_error(spark):
    import pytest

    with pytest.raises(ValueError, match="nosuch"):
        prep.feature_columns(spark.range(1), ["id", "nosuch"])
