"""Column expressions. All of them stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean_numeric(
    column: Column | str, missing: str = "?", fill: float = 0.0, floor: float | None = None
) -> Column:
    """Text to double: the missing marker becomes ``fill``, text that is no number null.

    ``floor`` lifts smaller values, which count-based models need.
    """
    column = _column(column)
    number = F.when(column == missing, F.lit(fill)).otherwise(column.try_cast("double"))
    if floor is None:
        return number
    return F.when(number < floor, F.lit(float(floor))).otherwise(number)


def decode(column: Column | str, mapping: Mapping, default: str | None = None) -> Column:
    """Replace a code by its text; an unknown code gives ``default``."""
    pairs = F.create_map(*[F.lit(item) for item in chain.from_iterable(mapping.items())])
    text = F.try_element_at(pairs, _column(column))
    return text if default is None else F.coalesce(text, F.lit(default))


def abs_error(label: Column | str, prediction: Column | str) -> Column:
    """Distance between the label and the whole-number part of the prediction."""
    return F.abs(_column(label) - _column(prediction).try_cast("bigint"))


def match_flag(
    label: Column | str, prediction: Column | str, hit: str = "正确", miss: str = "错误"
) -> Column:
    """``hit`` where label and prediction agree."""
    return F.when(_column(label) == _column(prediction), F.lit(hit)).otherwise(F.lit(miss))


def sentence(*parts: Column | str) -> Column:
    """Join literal text and column values; nulls are left out."""
    return F.concat_ws("", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def strip_quotes(column: Column | str) -> Column:
    return F.replace(_column(column), F.lit('"'), F.lit(""))


def split_fields(column: Column | str, sep: str, n: int) -> list[Column]:
    """First ``n`` fields of a delimited line; a field that is not there is null."""
    literal = "".join(f"\\{c}" if not c.isalnum() and not c.isspace() else c for c in sep)
    fields = F.split(_column(column), literal)
    return [F.get(fields, i) for i in range(n)]
