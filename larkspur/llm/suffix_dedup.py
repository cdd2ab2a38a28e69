"""Passages that repeat across documents, by a sparse suffix array sorted to the right and to the left."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.scan import WORD, Words, runs, slices, within
from larkspur.session import materialize

#: A passage counts from this many words on.
PASSAGE = 50
#: Words a suffix is first sorted by, and the window in which the least is retained. Every
#: passage holds a whole window, so equal passages retain a suffix at the same word.
HEAD = 12
WINDOW = PASSAGE - HEAD + 1
#: Blocks of words, (offset, length), by which suffixes with equal heads are sorted on: what
#: follows the head, to the end of a passage, and what comes before it, from there backwards.
AHEAD = [(12, 13), (25, 13), (38, 12)]
BEHIND = [(-13, 13), (-26, 13), (-38, 12)]
BITS = 21
#: By the number of blocks in common: the least words that a passage must reach back if it
#: ends before the next block ahead does, and the most it can reach back.
LEAST_BACK = [26, 13, 1, 0]
MOST_BACK = [12, 25, 37, 38]


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first least value of every ``width`` neighbours."""
    at = np.arange(values.size)
    span = 1
    while span < width:
        step = min(span, width - span)
        left, right = at[: at.size - step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        span += step
    return at


def minimisers(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Words at which a suffix is retained, and the hash of the ``HEAD`` words there."""
    heads = runs(words.hashes(), HEAD)
    at, sizes = within(words.first, PASSAGE)  # places where a whole window begins
    if not at.size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    keep = np.unique(sliding_argmin(heads, WINDOW)[at])
    return keep, heads[keep]


def packed(words: Words, keep: np.ndarray, blocks: list[tuple[int, int]]) -> np.ndarray:
    """21 bits a block of words, in one number that sorts as the blocks do in turn.

    ``blocks`` are (offset from the retained word, length). A block that leaves the text is 0.
    """
    hashes = words.hashes()
    doc = np.searchsorted(words.first, keep, "right") - 1
    out = np.zeros(keep.size, np.int64)
    for offset, length in blocks:
        codes, at = runs(hashes, length), keep + offset
        inside = (at >= words.first[doc]) & (at + length <= words.first[doc + 1])
        out <<= BITS
        out[inside] |= (codes[at[inside]] >> np.uint64(64 - BITS)).astype(np.int64)
    return out


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        words = Words(batch.column("text"))
        keep, heads = minimisers(words)
        doc = np.searchsorted(words.first, keep, "right") - 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(heads.view(np.int64)), pa.array(packed(words, keep, AHEAD)), pa.array(packed(words, keep, BEHIND)),
             batch.column("uid").take(pa.array(doc)), pa.array((keep - words.first[doc]).astype(np.int32))],
            ["head", "right", "left", "uid", "pos"],
        )


def common_blocks(head: np.ndarray, key: np.ndarray, other_head: np.ndarray, other_key: np.ndarray) -> np.ndarray:
    """How many leading blocks two suffixes have in common, 0 to 3; -1 where the heads differ."""
    differ = key ^ other_key
    blocks = 3 - (differ > 0) - (differ >> BITS > 0) - (differ >> (2 * BITS) > 0)
    return np.where(head == other_head, blocks, -1)


def _compared(key: str, names: list[str], level: str):
    """Of suffixes in the order (head, key, uid, pos): the most blocks in common with another text.

    In this order no suffix has more in common with a row than the nearest ones of another
    text, before and after it. Equal rows, of equal texts, count once. Held back are the last
    text's rows and the one before, which bounds what is held by the length of a text. The
    first and the last text of a part have unseen neighbours and count as equal to them.
    Rows whose head no other text has are left out.
    """
    others = [n for n in names if n != key]

    def rows(columns: dict[str, np.ndarray], blocks: np.ndarray, start: int, stop: int) -> pa.RecordBatch:
        pick = np.flatnonzero(blocks >= 0)
        arrays = [pa.array(columns[n][start:stop][pick]) for n in others]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(blocks[pick].astype(np.int32))], [*others, level])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        context = 0  # 1 if the first held row is the one before the last text's
        for batch in batches:
            if not batch.num_rows:
                continue
            now = {n: batch.column(n).to_numpy() for n in names}
            if held:
                now = {n: np.append(held[n], now[n]) for n in names}
            fresh = np.ones(now["uid"].size, bool)
            fresh[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in now.values()])
            now = {n: x[fresh] for n, x in now.items()}
            head, code, uid = now["head"], now[key], now["uid"]
            starts = np.append(0, np.flatnonzero(uid[1:] != uid[:-1]) + 1)
            last = int(starts[-1])
            if last > context:
                row = np.arange(context, last)
                text = np.searchsorted(starts, row, "right") - 1
                after = starts[text + 1]
                before = np.maximum(starts[text] - 1, 0)
                blocks = np.maximum(
                    common_blocks(head[row], code[row], head[after], code[after]),
                    common_blocks(head[row], code[row], head[before], code[before]),
                )
                if not context:
                    blocks[text == 0] = 3
                yield rows(now, blocks, context, last)
                now = {n: x[last - 1 :] for n, x in now.items()}
                context = 1
            held = now
        if held:
            size = held["uid"].size
            yield rows(held, np.full(size - context, 3), context, size)

    return run


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of ``PASSAGE`` words that begin in the given ranges."""
    for batch in slices(batches):
        words = Words(batch.column("text"))
        lists = batch.column("places")
        low, high = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in lists.flatten().flatten())
        doc = np.repeat(np.arange(batch.num_rows), np.asarray(lists.value_lengths()))
        at, sizes = within(words.first, PASSAGE)
        high = np.maximum(np.minimum(high, sizes[doc] - 1), low - 1)
        marks = np.zeros(len(words) + 1, np.int64)
        np.add.at(marks, words.first[doc] + low, 1)
        np.add.at(marks, words.first[doc] + high + 1, -1)
        start = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
        doc = np.searchsorted(words.first, start, "right") - 1
        h, g = runs(words.hashes(), PASSAGE), runs(words.hashes(1), PASSAGE, seed=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(h[start].view(np.int64)), pa.array((g[start] >> np.uint64(32)).astype(np.uint32).view(np.int32)),
             batch.column("ord").take(pa.array(doc)), pa.array((start - words.first[doc]).astype(np.int32))],
            ["h", "g", "ord", "start"],
        )


def _identified(docs: DataFrame) -> DataFrame:
    """(ord, uid, text): ord is the doc_id, or a large number made from the text; uid is of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    uid = F.xxhash64(text)
    stand_in = F.lit(1 << 62).bitwiseOR(F.shiftrightunsigned(uid, 3))
    return docs.select(
        F.coalesce(F.col("doc_id").try_cast("bigint"), stand_in).alias("ord"), uid.alias("uid"), text.alias("text")
    )


def _sorted(suffixes: DataFrame, key: str) -> DataFrame:
    order = ["head", key, "uid", "pos"]
    return suffixes.repartitionByRange(*order).sortWithinPartitions(*order)


def _shared(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(ord, start, first_ord): windows that different texts hold, a text under its least ord."""
    suffixes = materialize(
        docs.select("uid", "text").mapInArrow(
            _suffixes, "head bigint, right bigint, left bigint, uid bigint, pos int"
        ),
        "suffixes",
    )
    ahead = _sorted(suffixes, "right").mapInArrow(
        _compared("right", ["head", "right", "left", "uid", "pos"], "ahead"),
        "head bigint, left bigint, uid bigint, pos int, ahead int",
    )
    both = _sorted(materialize(ahead, "ahead"), "left").mapInArrow(
        _compared("left", ["head", "left", "uid", "pos", "ahead"], "behind"),
        "head bigint, uid bigint, pos int, ahead int, behind int",
    )
    least, most = (F.array(*map(F.lit, steps)) for steps in (LEAST_BACK, MOST_BACK))
    low = F.greatest(F.col("pos") - F.get(most, F.col("behind")), F.lit(0))
    high = F.col("pos") - F.get(least, F.col("ahead"))
    met = both.select("uid", low.alias("low"), high.alias("high")).where("low <= high")
    places = met.groupBy("uid").agg(F.collect_set(F.struct("low", "high")).alias("places"))
    places = materialize(places.join(ids.select("uid", "ord"), "uid"), "places")
    held = docs.select("uid", "text").join(places, "uid").dropDuplicates(["uid"])
    windows = held.select("ord", "text", "places").mapInArrow(
        _windows, "h bigint, g int, ord bigint, start int"
    )
    firsts = windows.groupBy("h", "g").agg(F.min("ord").alias("first_ord"), F.max("ord").alias("last"))
    firsts = firsts.where("first_ord != last").drop("last")
    return windows.join(firsts, ["h", "g"]).select("ord", "start", "first_ord")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, starts, repeat_starts, first_doc_ids, copy_of), a row for each row of
    (doc_id, text) that shares a run of 50 words or more with another document.

    Suffixes are retained at minimisers of 12 words and sorted by those and the words that
    follow, hashed in blocks. The nearest suffixes of other texts in that order tell how far
    a match can go to the right. Those with a match are sorted once more, by the words
    before, and compared likewise, which extends it to the left. Where both together can
    reach 50 words, the runs of 50 words in that reach are compared, which settles the match
    to the word: the text that goes furthest to the right need not be the one to the left.
    ``starts`` are the words at which a shared run begins; ``repeat_starts`` those of
    which another document, with a lower id, is the first holder; ``first_doc_ids`` lists
    these holders. Equal texts are looked at once; of them, all but the one with the least
    id are a copy of it as a whole, named in ``copy_of`` (null otherwise).

    Equal runs are recognised by 96 bits of hash. Suffixes are sorted by ranges and runs
    counted before they are shuffled, so a passage in a third of all documents is split.
    Null and empty texts, and texts of under 50 words, have no run. Rows with one doc_id
    are one document; what repeats inside one document does not count. Null ids come
    last, and stay null in ``first_doc_ids`` too; ids that are no whole numbers count as
    null. Other columns are not read. Empty table: no rows.
    """
    ids = _identified(docs)
    slim = ids.select("ord", "uid", F.regexp_count("text", F.lit(WORD)).alias("words"))
    texts = slim.groupBy("uid").agg(
        F.min("ord").alias("ord"), F.max("ord").alias("last"), F.max("words").alias("words")
    )
    texts = materialize(texts, "texts")
    shared = _shared(ids, texts)
    repeat = F.col("ord") != F.col("first_ord")
    found = shared.groupBy("ord").agg(
        F.array_sort(F.collect_set("start")).alias("starts"),
        F.array_sort(F.collect_set(F.when(repeat, F.col("start")))).alias("repeat_starts"),
        F.array_sort(F.collect_set(F.when(repeat, F.col("first_ord")))).alias("first_ords"),
    )
    named = texts.withColumnRenamed("ord", "first").join(found.withColumnRenamed("ord", "first"), "first", "left")
    named = named.where((F.col("words") >= PASSAGE) & (F.col("starts").isNotNull() | (F.col("first") != F.col("last"))))
    rows = slim.select("ord", "uid").join(named, "uid")
    copied = F.col("ord") != F.col("first")
    everything = F.sequence(F.lit(0), F.col("words") - PASSAGE)
    none, known = F.expr("cast(array() as array<int>)"), F.col("ord") < (1 << 62)
    return rows.select(
        F.when(known, F.col("ord")).alias("doc_id"),
        "uid",
        F.when(F.col("first") != F.col("last"), everything).otherwise(F.col("starts")).alias("starts"),
        F.when(copied, everything).otherwise(F.coalesce("repeat_starts", none)).alias("repeat_starts"),
        F.transform(
            F.when(copied, F.array("first")).otherwise(F.coalesce("first_ords", F.expr("cast(array() as array<bigint>)"))),
            lambda x: F.when(x < (1 << 62), x),
        ).alias("first_doc_ids"),
        F.when(copied & (F.col("first") < (1 << 62)), F.col("first")).alias("copy_of"),
    )


def merge_runs(starts: np.ndarray, length: int = PASSAGE) -> list[tuple[int, int]]:
    """Word spans [from, to) that sorted run starts cover together."""
    if not starts.size:
        return []
    new = np.flatnonzero(np.diff(starts) > length) + 1
    first, last = starts[np.append(0, new)], starts[np.append(new - 1, starts.size - 1)]
    return list(zip(first.tolist(), (last + length).tolist()))


def _cut_runs(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``raw`` without the given byte ranges, and without the lines that are left without a
    word by that. Lines that had none before stay."""
    parts, places, at, size = [], [], 0, 0
    for a, b in spans:
        parts.append(raw[at:a])
        size += a - at
        places.append(size)
        at = b
    left = b"".join([*parts, raw[at:]])
    for place in reversed(places):
        start = left.rfind(b"\n", 0, place) + 1
        end = left.find(b"\n", place)
        end = len(left) if end < 0 else end
        if not left[start:end].translate(None, b"\x20\t\n\x0b\x0c\r"):
            # With its line end, or with the one before if it is the last line.
            left = left[:start] + left[end + 1 :] if end < len(left) else left[: max(start - 1, 0)]
    return left


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with every passage removed that another document holds first.

    The first holder keeps it. The passage's words and what lies between them go, and a
    line that is left without a word by that; everything else of a text stays. ``n_chars``
    is counted anew where there is such a column. Documents that lose their last word are
    removed; all other rows and columns, of whatever name, stay as they are.
    """
    found = repeated_passages(docs.select("doc_id", "text")).where(F.size("repeat_starts") > 0)
    cuts = found.select(F.col("doc_id").alias("id"), F.col("uid").alias("of"), F.col("repeat_starts").alias("cuts"))
    # A repeated row has a repeated cut; one is enough.
    cuts = cuts.dropDuplicates(["id", "of"])
    names = docs.columns
    # Columns of the input travel in one, so that none can clash.
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.withColumn("uid", F.xxhash64(F.coalesce(F.col("row.text").cast("string"), F.lit(""))))
    same = F.col("row.doc_id").try_cast("bigint").eqNullSafe(F.col("id"))
    rows = rows.join(cuts, (F.col("uid") == F.col("of")) & same, "left").select("row", "cuts", "row.text")
    place = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            touched = np.flatnonzero(batch.column("cuts").is_valid().to_numpy(zero_copy_only=False))
            columns = batch.column("row").flatten()
            keep = np.ones(batch.num_rows, bool)
            if touched.size:
                texts = batch.column("text").to_pylist()
                words = Words(batch.column("text"))
                lists = batch.column("cuts")
                for i in touched:
                    starts = np.sort(np.array(lists[int(i)].as_py(), np.int64))
                    base, first = words.offsets[i], words.first[i]
                    spans = [
                        (int(words.start[first + a] - base), int(words.end[first + b - 1] - base))
                        for a, b in merge_runs(starts)
                    ]
                    left = _cut_runs(texts[i].encode(), spans)
                    texts[i] = left.decode()
                    keep[i] = bool(left.translate(None, b"\x20\t\n\x0b\x0c\r"))
                columns[place] = pa.array(texts, columns[place].type)
                if "n_chars" in names:
                    at = names.index("n_chars")
                    counts = columns[at].to_pylist()
                    for i in touched:
                        counts[i] = len(texts[i])
                    columns[at] = pa.array(counts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep))

    return rows.mapInArrow(run, docs.schema)
