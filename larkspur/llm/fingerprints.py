"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A sketch is a row of cells; each digest is added to one cell in each of three tables. A
cell holds how many digests are in it, their exclusive or, and the exclusive or of their
check values. Sketches of two texts subtract cell by cell, which cancels the paragraphs
they share. What is left is peeled: a cell with a single digest names it, and taking it
out of its other two cells leaves further single ones.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.session import materialize

#: A paragraph is a line, or part of one: 24 characters at least, up to the end of a
#: sentence or 96 characters more.
PARAGRAPH = r"[^\n]{1,24}[^\n.!?]{0,96}[.!?]*\n?|\n"
#: Share of cells in use above which a difference is not peeled but sketched larger: three
#: tables that peel at all have an empty cell in eleven.
FULL = 0.9
#: Cells for each paragraph of a pair that its kept sketches do not settle; each further
#: retry has twice as many.
LARGER = 1.5
_ROUNDS, _PASSES = 6, 3
_BUCKETS_PER_PARTITION = 8


def digests(text: Column) -> Column:
    """64-bit digests of the different paragraphs of a text."""
    found = F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0))
    return F.array_distinct(F.transform(found, lambda x: F.xxhash64(x)))


def _check(digest: Column) -> Column:
    """32 bits. A false one leaves cells that do not peel, and the pair is tried again."""
    return F.xxhash64(digest, F.lit(99)).bitwiseAND(F.lit(0xFFFFFFFF))


def _third(n: Column) -> Column:
    """Cells of one table in the kept sketch of ``n`` paragraphs: a power of two."""
    return F.pow(F.lit(2), F.ceil(F.log2(F.greatest(n / 3 + 2, F.lit(4))))).cast("int")


def _cell(digest: Column, table: int, third: Column, seed: int) -> Column:
    """Cell of a digest in one of the three tables of ``third`` cells."""
    return (third * table + F.pmod(F.xxhash64(digest, F.lit(table), F.lit(seed)), third)).cast("int")


def _constant(values: list, kind: str) -> Column:
    """A list as one constant of the plan, however long."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def _bucket_of(order: Column, within: Column, bounds: list[int], pieces: int) -> Column:
    """Number of a range of (order, within), which rises with them.

    ``bounds`` may repeat: values of the order that stand there twice own a range or more.
    They get ranges of their own, one for each of ``pieces`` equal shares of ``within``, a
    hash. A range is found in about twice the root of the number of bounds steps.
    """
    hot = sorted({a for a, b in zip(bounds, bounds[1:]) if a == b})
    starts = sorted({*bounds, *(h + 1 for h in hot)})
    if not starts:
        return F.lit(0).cast("bigint")
    step = max(1, int(len(starts) ** 0.5))
    groups = [starts[i : i + step] for i in range(0, len(starts), step)]
    at = _constant([g[0] for g in groups], "array<bigint>")
    rest = _constant([g[1:] for g in groups], "array<array<bigint>>")
    whole = F.size(F.filter(at, lambda b: b <= order))
    inside = F.size(F.filter(F.get(rest, whole - 1), lambda b: b <= order))
    found = F.when(whole > 0, (whole - 1) * step + 1 + inside).otherwise(F.lit(0)).cast("bigint") * pieces
    if not hot:
        return found
    piece = F.least(F.lit(pieces - 1), F.floor((within / float(1 << 64) + 0.5) * pieces)).cast("bigint")
    return found + F.when(F.array_contains(_constant(hot, "array<bigint>"), order), piece).otherwise(F.lit(0))


def with_next(docs: DataFrame) -> DataFrame:
    """(bucket, rn, real, doc_id, text, next): each text with that of the next doc_id.

    Ids are cut into ranges of about equal size, those of an id that owns ranges (as null
    may) by a hash of the text. The first row of a range is also sent to
    the range before it (of the first range: to the last one), where it is not ``real``.
    So one shuffle brings every text together with the next, and no task orders more than
    its ranges. Ids that are no whole numbers are ordered as null ones are.
    """
    spark: SparkSession = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    rows = rows.withColumns({
        "ord": F.coalesce(F.col("doc_id").try_cast("bigint"), F.lit(-(1 << 63))), "th": F.xxhash64("text")
    })
    count = _BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = F.array(*[F.lit(i / count) for i in range(1, count)])
    bounds = rows.agg(F.percentile_approx("ord", cuts, F.lit(20 * count))).first()[0]
    rows = rows.withColumn("bucket", _bucket_of(F.col("ord"), F.col("th"), sorted(bounds or []), count))
    # One row a range: their number follows from the job's setting, not from the rows.
    firsts = rows.groupBy("bucket").agg(F.min(F.struct("ord", "th")).alias("f")).select("bucket", "f.*")
    firsts = materialize(firsts, "firsts")
    here = Window.orderBy("bucket")
    last = firsts.agg(F.max("bucket")).scalar()
    before = F.coalesce(F.lag("bucket").over(here), last)
    sent = firsts.select(F.col("ord").alias("o"), F.col("th").alias("t"), before.alias("also"))
    rows = rows.join(F.broadcast(sent), (F.col("ord") == F.col("o")) & (F.col("th") == F.col("t")), "left")
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(True).alias("real"))
    more = F.struct(F.col("also").alias("bucket"), F.lit(False).alias("real"))
    rows = rows.withColumn("to", F.explode(F.when(F.col("also").isNull(), F.array(own)).otherwise(F.array(own, more))))
    rows = rows.select("to.bucket", "to.real", "doc_id", "ord", "th", "text")
    order = Window.partitionBy("bucket").orderBy(F.desc("real"), "ord", "th")
    return rows.select(
        "bucket", F.row_number().over(order).alias("rn"), "real", "doc_id", "text",
        F.lead("text").over(order).alias("next"),
    )


def _sides(table: DataFrame, factor: float) -> DataFrame:
    """(bucket, rn, p, sign, cells, digests): what each row gives to which open pair.

    Pair 0 is a text and its edited form, pair 1 a text and the next one. A row is in the
    second pair of the row before it as well. ``open0``, ``open1`` and ``open_before`` tell
    which of a row's pairs are still to be settled.
    """
    def side(wanted: str, rn: Column, p: int, sign: int, n: Column, values: str) -> Column:
        cells = (F.ceil(n * factor / 3 + 4) * 3).cast("int")
        return F.when(F.col(wanted), F.struct(
            rn.cast("int").alias("rn"), F.lit(p).alias("p"), F.lit(sign).alias("sign"),
            cells.alias("cells"), F.col(values).alias("digests"),
        ))

    own, rn = F.size("a"), F.col("rn")
    both, following, before = own + F.size("e"), own + F.col("n_next"), F.col("n_before") + own
    given = F.array(
        side("open0", rn, 0, 1, both, "a"), side("open0", rn, 0, -1, both, "e"),
        side("open1", rn, 1, 1, following, "a"), side("open_before", rn - 1, 1, -1, before, "a"),
    )
    return table.select("bucket", F.explode(F.array_compact(given)).alias("g")).select("bucket", "g.*")


def _still_open(table: DataFrame, left: DataFrame) -> DataFrame:
    """Rows of pairs that are ``left``, with ``open0``, ``open1`` and ``open_before``."""
    own = F.struct(F.col("rn"), F.col("p").alias("w"))
    after = F.struct((F.col("rn") + 1).alias("rn"), F.lit(2).alias("w"))
    wanted = left.select("bucket", F.explode(F.when(F.col("p") == 0, F.array(own)).otherwise(F.array(own, after))).alias("t"))
    flags = wanted.groupBy("bucket", F.col("t.rn").alias("rn")).agg(
        F.bool_or(F.col("t.w") == 0).alias("open0"), F.bool_or(F.col("t.w") == 1).alias("open1"),
        F.bool_or(F.col("t.w") == 2).alias("open_before"),
    )
    return table.join(flags, ["bucket", "rn"])


def sketches(table: DataFrame) -> DataFrame:
    """(bucket, rn, side, third, edited, following, before, c, n, k, x): cells in use of the
    kept sketches of each row's text (side 0) and edited text (side 1).

    ``third``, the size of a table, follows from the number of paragraphs alone, so equal
    texts have equal sketches. ``edited``, ``following`` and ``before`` are the sizes of
    the row's pairs, the smaller one of the two texts; 0 where there is no such pair.
    """
    own, other = _third(F.size("a")), _third(F.size("e"))
    pairs = {
        "edited": F.when(F.col("real"), F.least(own, other)).otherwise(F.lit(0)),
        "following": F.when(F.col("n_next").isNotNull(), F.least(own, _third(F.col("n_next")))).otherwise(F.lit(0)),
        "before": F.when(F.col("n_before").isNotNull(), F.least(own, _third(F.col("n_before")))).otherwise(F.lit(0)),
    }
    both = F.array(
        F.struct(F.lit(0).alias("side"), own.alias("third"), F.col("a").alias("d")),
        F.struct(F.lit(1).alias("side"), other.alias("third"), F.col("e").alias("d")),
    )
    key = ["bucket", "rn", "side", "third", *pairs]
    one = table.select("bucket", "rn", *[v.alias(k) for k, v in pairs.items()], F.explode(both).alias("s"))
    one = one.select("bucket", "rn", "s.side", "s.third", *pairs, F.explode("s.d").alias("k"))
    entries = F.array(*[_cell(F.col("k"), t, F.col("third"), 0) for t in range(3)])
    placed = one.select(*key, F.explode(entries).alias("c"), "k", _check(F.col("k")).alias("x"))
    return placed.groupBy(*key, "c").agg(F.count("*").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("x").alias("x"))


def subtract(kept: DataFrame) -> DataFrame:
    """(bucket, rn, p, cells, c, n, k, x): kept sketches of the pairs, subtracted.

    The larger sketch is folded to the size of the smaller one: sizes are powers of two,
    so a cell's place is the rest of its old one. A difference too full to peel is left
    as a single cell that counts two, which nothing takes out.
    """
    third = F.col("third")
    first = F.col("side") == 0

    def target(rn: Column, p: int, sign: Column, size: Column) -> Column:
        return F.when(size > 0, F.struct(
            rn.cast("int").alias("rn"), F.lit(p).alias("p"), sign.alias("sign"), size.alias("size"),
        ))

    to = F.array_compact(F.array(
        target(F.col("rn"), 0, F.when(first, F.lit(1)).otherwise(F.lit(-1)), F.col("edited")),
        target(F.col("rn"), 1, F.lit(1), F.when(first, F.col("following"))),
        target(F.col("rn") - 1, 1, F.lit(-1), F.when(first, F.col("before"))),
    ))
    given = kept.select("bucket", "third", "c", "n", "k", "x", F.explode(to).alias("t"))
    place = F.floor(F.col("c") / third) * F.col("t.size") + F.col("c") % third % F.col("t.size")
    cells = _summed(given.select(
        "bucket", "t.rn", "t.p", (F.col("t.size") * 3).alias("cells"), place.cast("int").alias("c"),
        (F.col("t.sign") * F.col("n")).alias("n"), "k", "x",
    ))
    pair = Window.partitionBy("bucket", "rn", "p")
    over = F.count("*").over(pair) > FULL * F.col("cells")
    cells = cells.withColumns({"over": over, "low": F.min("c").over(pair)})
    cells = cells.where("not over or c = low").withColumn("n", F.when(F.col("over"), F.lit(2).cast("bigint")).otherwise(F.col("n")))
    return cells.drop("over", "low")


def _summed(rows: DataFrame) -> DataFrame:
    cells = rows.groupBy("bucket", "rn", "p", "cells", "c").agg(
        F.sum("n").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("x").alias("x")
    )
    return cells.where("n != 0 or k != 0 or x != 0")


def _alone() -> Column:
    """Whether a cell holds a single digest of the difference."""
    return (F.col("c") >= 0) & (F.abs("n") == 1) & (F.col("x") == _check(F.col("k")))


def _peel(cells: DataFrame, table: int, seed: int) -> DataFrame:
    """Take every digest that stands alone in a cell of one table out of all three.

    In one table each digest has one cell, so none is taken out twice. Cell -1 counts
    what was recovered.
    """
    n, k, x, m, c = (F.col(name) for name in ("n", "k", "x", "cells", "c"))
    third = (m / 3).cast("int")
    alone = _alone() & (c >= third * table) & (c < third * (table + 1))

    def entry(at: Column, count: Column, key: Column, check: Column) -> Column:
        return F.struct(at.cast("int").alias("c"), count.cast("bigint").alias("n"), key.alias("k"), check.alias("x"))

    zero = F.lit(0).cast("bigint")
    others = [entry(_cell(k, t, third, seed), -n, k, x) for t in range(3) if t != table]
    out = F.when(alone, F.array(*others, entry(F.lit(-1), F.lit(1), zero, zero))).otherwise(F.array(entry(c, n, k, x)))
    return _summed(cells.select("bucket", "rn", "p", "cells", F.explode(out).alias("o")).select("bucket", "rn", "p", "cells", "o.*"))


def larger(sides: DataFrame, seed: int) -> DataFrame:
    """(bucket, rn, p, cells, c, n, k, x): differences of sketches made anew for pairs."""
    one = sides.repartition("bucket").select("bucket", "rn", "p", "sign", "cells", F.explode("digests").alias("k"))
    entries = F.array(*[_cell(F.col("k"), t, (F.col("cells") / 3).cast("int"), seed) for t in range(3)])
    return _summed(one.select(
        "bucket", "rn", "p", "cells", F.explode(entries).alias("c"), F.col("sign").cast("bigint").alias("n"), "k",
        _check(F.col("k")).alias("x"),
    ))


def peel(cells: DataFrame, seed: int) -> DataFrame:
    """(bucket, rn, p, delta, left): recovered digests of each pair, and cells not peeled.

    Pairs that do not differ have no row.
    """
    for turn in range(_PASSES):
        for step in range(_ROUNDS):
            cells = _peel(cells, step % 3, seed)
        cells = materialize(cells, "cells")
        counts = cells.groupBy("bucket", "rn", "p").agg(
            F.coalesce(F.sum(F.when(F.col("c") < 0, F.col("n"))), F.lit(0)).alias("delta"),
            F.count_if(F.col("c") >= 0).alias("left"), F.count_if(_alone()).alias("alone"),
        )
        if turn == _PASSES - 1 or counts.where("alone > 0").isEmpty():
            break
        cells = cells.repartition("bucket")
    return materialize(counts.drop("alone"), "counts")


def _shown(kept: DataFrame) -> DataFrame:
    """(bucket, rn, fingerprint, edited_fingerprint): kept sketches as text.

    Base64 of all cells in order, 14 bytes each: count (2), digests (8) and checks (4).
    """
    cells = kept.groupBy("bucket", "rn", "side", "third").agg(
        F.sort_array(F.collect_list(F.struct("c", "n", "k", "x"))).alias("s")
    )
    none = "0" * 28

    def shown(cell: Column, before: Column) -> Column:
        return F.concat(
            F.repeat(F.lit(none), (cell["c"] - before - 1).cast("int")), F.lpad(F.hex(cell["n"]), 4, "0"),
            F.lpad(F.hex(cell["k"]), 16, "0"), F.lpad(F.hex(cell["x"]), 8, "0"),
        )

    places = F.transform("s", lambda cell: cell["c"])
    before = F.concat(F.array(F.lit(-1)), F.slice(places, F.lit(1), F.size(places) - 1))
    end = F.repeat(F.lit(none), (F.col("third") * 3 - 1 - F.element_at(places, -1)).cast("int"))
    text = F.concat(F.array_join(F.zip_with("s", before, shown), ""), end)
    texts = cells.select("bucket", "rn", "side", F.base64(F.unhex(text)).alias("shown"))
    return texts.groupBy("bucket", "rn").agg(
        F.max(F.when(F.col("side") == 0, F.col("shown"))).alias("fingerprint"),
        F.max(F.when(F.col("side") == 1, F.col("shown"))).alias("edited_fingerprint"),
    )


def fingerprint_versions(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next) for every row of (doc_id, text).

    The edited text has its last quarter replaced by the beginning of the next document,
    by ascending doc_id, the first one after the last. Likeness is the share of common
    paragraphs, counted from what the difference of two fingerprints peels to: 1 for equal
    texts, also empty ones, 0 for texts without a common paragraph. A fingerprint is a
    sketch with one to four cells a paragraph, twelve at least, so two of them peel where
    about half of the paragraphs are shared or more. Other pairs are sketched anew with
    cells for all their paragraphs, then with twice as many and other cells for each
    digest, until none is left, so every likeness is exact up to collisions of 64-bit
    digests.

    Null counts as empty. Rows with one doc_id are ordered by a hash of their texts; null
    ids come first. A single row is its own next. Paragraphs that repeat inside a text
    count once. Other columns are not read. Empty table: no rows.
    """
    rows = with_next(docs)
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring(F.coalesce("next", F.lit("")), F.lit(1), cut))
    rows = rows.withColumn("edited", F.when(F.col("real"), edited))
    rows = rows.select(
        "bucket", "rn", "real", "doc_id", n.cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        digests(F.col("text")).alias("a"),
        F.coalesce(digests(F.col("edited")), F.expr("cast(array() as array<bigint>)")).alias("e"),
    )
    order = Window.partitionBy("bucket").orderBy("rn")
    # The last row of a range is the first of the next one, and has no pair here.
    rows = rows.withColumns({"n_next": F.lead(F.size("a")).over(order), "n_before": F.lag(F.size("a")).over(order)})
    table = materialize(rows, "paragraphs")
    seed, factor = 0, LARGER / 2
    counted = peel(subtract(sketches(table.repartition("bucket"))), seed)
    found = counted.where("left = 0").select("bucket", "rn", "p", "delta")
    left = counted.where("left > 0")
    while not left.isEmpty():
        seed, factor = seed + 1, factor * 2
        counted = peel(larger(_sides(_still_open(table, left), factor), seed), seed)
        found = found.unionByName(counted.where("left = 0").select("bucket", "rn", "p", "delta"))
        left = counted.where("left > 0")
    deltas = found.groupBy("bucket", "rn").agg(
        F.max(F.when(F.col("p") == 0, F.col("delta"))).alias("d0"), F.max(F.when(F.col("p") == 1, F.col("delta"))).alias("d1")
    )

    def likeness(delta: str, a: Column, b: Column) -> Column:
        both, d = a + b, F.coalesce(delta, F.lit(0))
        return F.when(both == 0, F.lit(1.0)).otherwise((both - d) / (both + d))

    # Of no paragraph: twelve empty cells.
    empty = F.base64(F.unhex(F.lit("0" * 28 * 12)))
    own = table.where("real").select(
        "bucket", "rn", "doc_id", "n_chars", "edited_sha256", F.size("a").alias("na"), F.size("e").alias("ne"), "n_next"
    )
    shown = _shown(sketches(table.where("real").repartition("bucket", "rn")))
    joined = own.join(shown, ["bucket", "rn"], "left").join(deltas, ["bucket", "rn"], "left")
    return joined.select(
        "doc_id", "n_chars", "edited_sha256",
        F.coalesce("fingerprint", empty).alias("fingerprint"),
        F.coalesce("edited_fingerprint", empty).alias("edited_fingerprint"),
        likeness("d0", F.col("na"), F.col("ne")).alias("near_edited"),
        likeness("d1", F.col("na"), F.coalesce("n_next", F.lit(0))).alias("near_next"),
    )
