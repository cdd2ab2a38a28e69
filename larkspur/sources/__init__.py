from larkspur.sources.delimited import (
    apply_types,
    drop_header_rows,
    read_delimited,
    read_wide,
    wide_string_schema,
    write_delimited,
)
from larkspur.sources.models import load_or_fit, save_model
from larkspur.sources.tables import cached, register, spread, table, write_split

__all__ = [
    "apply_types",
    "cached",
    "drop_header_rows",
    "load_or_fit",
    "read_delimited",
    "read_wide",
    "register",
    "save_model",
    "spread",
    "table",
    "wide_string_schema",
    "write_delimited",
    "write_split",
]
