from larkspur.functions.columns import (
    abs_error,
    clean_numeric,
    decode,
    match_flag,
    sentence,
    split_fields,
    strip_quotes,
)
from larkspur.functions.dictionaries import (
    COVER_NAMES,
    HOLIDAY,
    PAGE_KIND,
    RENTAL_MAXIMA,
    SEASON,
    WEATHER,
    WEEKDAY,
    WORKINGDAY,
)

__all__ = [
    "COVER_NAMES",
    "HOLIDAY",
    "PAGE_KIND",
    "RENTAL_MAXIMA",
    "SEASON",
    "WEATHER",
    "WEEKDAY",
    "WORKINGDAY",
    "abs_error",
    "clean_numeric",
    "decode",
    "match_flag",
    "sentence",
    "split_fields",
    "strip_quotes",
]
