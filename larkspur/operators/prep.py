"""Typing, cleaning and choosing columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.columns import clean_numeric


def with_expr(df: DataFrame, name: str, expr: Column | str) -> DataFrame:
    """Add a computed column, given as a Column or as SQL text."""
    return df.withColumn(name, F.expr(expr) if isinstance(expr, str) else expr)


def cast_columns(df: DataFrame, columns: Sequence[str], kind: str = "double") -> DataFrame:
    """Convert the named columns in place; what does not convert becomes null."""
    return df.withColumns({c: F.col(c).try_cast(kind) for c in columns})


def clean_columns(
    df: DataFrame, columns: Sequence[str], missing: str = "?", floor: float | None = None
) -> DataFrame:
    """:func:`clean_numeric` over several columns."""
    return df.withColumns({c: clean_numeric(c, missing, floor=floor) for c in columns})


def feature_columns(
    df: DataFrame,
    names: Sequence[str] | None = None,
    start: int | None = None,
    stop: int | None = None,
) -> list[str]:
    """Feature names, listed or as a position range of the frame's columns."""
    if names is None:
        return df.columns[start:stop]
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"no such columns: {absent}")
    return list(names)


def denormalize(df: DataFrame, maxima: Mapping[str, float]) -> DataFrame:
    """Undo a division by the column maximum."""
    return df.withColumns({c: F.col(c) * F.lit(top) for c, top in maxima.items()})
