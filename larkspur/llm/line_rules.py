"""Quality rules that judge lines first and documents by what is left of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.scan import WORD

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
BARS = "[|»›•]"
BLANKS = " \t\n\x0b\f\r"
CLOSING_MARKS = ".!?…:;\"')]”»"
#: The same as a pattern, for SQL.
CLOSING = "[.!?…:;\"')\\]”»]" + SPACE + "*$"
#: Phrases of lines that repeat on every page of a site. Fixed values.
BOILERPLATE = [
    "all rights reserved", "licensed under", "copyright (c)", "privacy policy", "terms of use",
    "terms of service", "cookie policy", "we use cookies", "enable javascript", "lorem ipsum",
    "sign in to", "log in to", "subscribe to our",
]
MIN_WORDS, MAX_REPEATED, MAX_LOST = 50, 0.5, 0.5


def word_array(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def visible(text: Column) -> Column:
    """Characters that are no white space, as a long."""
    return (F.length(text) - F.regexp_count(text, F.lit(SPACE))).cast("long")


def _windows(hashes: Column) -> Column:
    """Hash of every 3-word window of a text, from the hashes of its words."""
    last = F.size(hashes) - 3
    return F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)),
        ),
    )


def _closed(line: Column) -> Column:
    """Whether the last character that is no white space is a closing mark."""
    return F.substring(F.rtrim(line, F.lit(BLANKS)), -1, 1).isin(*CLOSING_MARKS)


def _boiler(text: Column) -> Column:
    low = F.lower(text)
    found = F.lit(False)
    for phrase in BOILERPLATE:
        found = found | low.contains(phrase)
    return found


def line_fails(line: Column) -> Column:
    """Whether a line with words fails a rule.

    Punctuation: it does not end in a closing mark, is one fifth symbols, or holds
    three or more ``!!``. Navigation: three or more bars, or one for every four words.
    Boilerplate: it contains one of the fixed phrases.
    """
    words = F.regexp_count(line, F.lit(WORD))
    bars = F.regexp_count(line, F.lit(BARS))
    symbols = F.regexp_count(line, F.lit(SYMBOLS))
    # Counting waits for a look at whether there is anything to count.
    return (
        ~_closed(line)
        | (line.rlike(SYMBOLS) & (symbols * 5 >= visible(line)))
        | (line.contains("!!") & (F.regexp_count(line, F.lit("!!")) >= 3))
        | (line.rlike(BARS) & ((bars >= 3) | (bars * 4 >= words)))
        | _boiler(line)
    )


def clean_lines(docs: DataFrame) -> DataFrame:
    """All columns of the input, and: ``clean_text``, ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``lost_chars``, ``base_failed``
    and ``kept``.

    Lines without a word are neither judged nor kept. A document fails the base rules
    with fewer than 50 words, or where more than half of them lie in repeated 3-word
    windows. Otherwise it is rejected when its failing lines hold more than half of its
    word characters. Nothing is shuffled: every row is judged by itself, so repeated
    rows are judged alike. Null and empty texts have no words and fail. Input columns
    that bear one of the new names are replaced.
    """
    none = F.coalesce(F.col("text"), F.lit(""))
    words, lines, hashes = F.col("_words"), F.col("_lines"), F.col("_hashes")
    # Columns of the input travel in one, so that none can clash with what is worked out.
    df = docs.select(F.struct("*").alias("_row"), none.alias("_text"))
    df = df.withColumns({
        "_words": word_array(F.col("_text")),
        "_lines": F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD)),
        "n_symbols": F.regexp_count("_text", F.lit(SYMBOLS)).cast("long"),
    })
    df = df.withColumn("_each", F.transform(words, lambda w: F.xxhash64(w)))
    df = df.withColumn("_hashes", _windows(F.col("_each")))
    # Most texts repeat no window, which their number of different ones tells. Elsewhere,
    # sorted by hash, equal windows are neighbours. The positions that are left are sorted
    # again, and each covers three words or those up to the next one.
    df = df.withColumn(
        "_windows",
        F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes),
            F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    windows = F.col("_windows")
    same = F.filter(
        F.sequence(F.lit(0), F.size(windows) - 1),
        lambda j: (F.get(windows, j)["h"] == F.get(windows, j - 1)["h"]).eqNullSafe(F.lit(True))
        | (F.get(windows, j)["h"] == F.get(windows, j + 1)["h"]).eqNullSafe(F.lit(True)),
    )
    same = F.sort_array(F.transform(same, lambda j: F.get(windows, j)["i"]))
    df = df.withColumn("_same", F.when(windows.isNotNull(), same))
    same = F.col("_same")
    # There are at least two positions, or none.
    covered = F.aggregate(
        F.zip_with(
            same, F.slice(same, F.lit(2), F.size(same) - 1),
            lambda here, after: F.least(F.lit(3), F.coalesce(after - here, F.lit(3))),
        ),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    # Where a text holds nothing of what the other rules look for, its lines need but end well.
    plain = (F.col("n_symbols") == 0) & ~F.col("_text").contains("!!") & ~F.col("_text").rlike(BARS) & ~_boiler(F.col("_text"))
    df = df.withColumns({
        "_good": F.when(plain, F.filter(lines, _closed)).otherwise(F.filter(lines, lambda x: ~line_fails(x))),
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": F.when(same.isNotNull(), covered).otherwise(F.lit(0).cast("long")),
    })
    df = df.withColumns({
        "clean_text": F.concat_ws("\n", "_good"),
        "base_failed": (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > int(100 * MAX_REPEATED) * F.col("n_words")),
    })
    lost = F.col("word_chars") - visible(F.col("clean_text"))
    whole = F.size("_good") == F.size("_lines")
    df = df.withColumn("lost_chars", F.when(whole, F.lit(0).cast("long")).otherwise(lost))
    df = df.withColumn(
        "kept", ~F.col("base_failed") & (F.col("lost_chars") <= MAX_LOST * F.col("word_chars"))
    )
    made = [
        "clean_text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "lost_chars", "base_failed", "kept",
    ]
    own = [F.col("_row").getField(c).alias(c) for c in docs.columns if c not in made]
    return df.select(*own, *made)
