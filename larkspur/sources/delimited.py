"""Delimited text in and out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ",",
    schema: StructType | str | None = None,
    header: bool = True,
    null: str = "",
    multiline: bool = False,
) -> DataFrame:
    """Read quoted, delimited text.

    Without a schema every column is a string and no inference pass over the data
    is made. With one, a field that does not parse becomes null instead of failing
    the job, so dirty columns should be declared as strings and cleaned afterwards.

    ``null`` is the text that stands for null; where it is not the empty text, empty
    fields stay empty. ``multiline`` allows line breaks inside quotes; each file is
    then read whole by one task, so large exports need many files.
    """
    reader = spark.read.options(
        sep=sep, header=header, quote='"', escape='"', inferSchema=False,
        nullValue=null, emptyValue="", multiLine=multiline,
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def wide_string_schema(n: int, prefix: str = "f") -> StructType:
    """``f0 .. f{n-1}``, all nullable strings."""
    return StructType([StructField(f"{prefix}{i}", StringType(), True) for i in range(n)])


def read_wide(spark: SparkSession, path: str, sep: str = ",", prefix: str = "f") -> DataFrame:
    """Headerless text with a generated schema as wide as the first row."""
    width = len(read_delimited(spark, path, sep, header=False).columns)
    return read_delimited(spark, path, sep, wide_string_schema(width, prefix), header=False)


def drop_header_rows(df: DataFrame, header: Sequence[str]) -> DataFrame:
    """Remove every row that repeats the header line.

    The reader's own ``header`` option only skips the first line of each file;
    concatenated exports carry the header line in the middle as well.
    """
    repeated = reduce(
        lambda left, right: left & right,
        [F.col(name).eqNullSafe(F.lit(text)) for name, text in zip(df.columns, header, strict=True)],
    )
    return df.filter(~repeated)


def apply_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Keep the named columns, converted; text that does not convert becomes null."""
    return df.select([F.col(name).try_cast(kind).alias(name) for name, kind in types.items()])


def write_delimited(
    df: DataFrame, path: str, sep: str = ",", header: bool = True, null: str = ""
) -> str:
    """Write every value quoted, as the text exports the readers expect.

    Text with line breaks comes back whole only with ``multiline``, and empty text
    only with a ``null`` that no value equals; give the same one to the reader.
    """
    options = {"sep": sep, "header": header, "quoteAll": True, "escape": '"'}
    # By default the writer trims white space, line breaks included, off both ends.
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(**options, **kept, nullValue=null, emptyValue="").csv(path)
    return path
