"""Language of texts and of spans inside them.

A word is a run of letters of one script. The script leaves some of the languages as
candidates; each of them scores the word by its letter n-grams. The best sequence of
languages over a text's words, where every change of language costs a penalty, gives the
spans (Viterbi). The text's language is the one with most letters.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.scan import mix, once, slices, stream

#: Labelled documents that are learnt from, at most (about).
SAMPLE = 40_000
#: n-grams are counted by hash in so many buckets.
BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)
#: Share of a language's probability that is spread evenly over all n-grams; a share, so that
#: languages with little text are not favoured by what nobody has seen.
SMOOTHING = 0.01
#: A language writes a script when at least this share of its letters is in it.
WRITES = 0.001
#: What a change of language costs, the most that one word may tell between two languages,
#: and what a word costs a language that does not write its script.
SWITCH, MOST, FOREIGN = 8.0, 6.0, 24.0
#: Words of a text that are taken together; see :func:`best_path`.
_CHUNK = 128
_SLICE = 1 << 19
UNKNOWN = "und"


def letters() -> tuple[np.ndarray, np.ndarray]:
    """Script number of each code point (0: no letter), and its lower case.

    Unicode names letters after their script: LATIN SMALL LETTER A, CJK UNIFIED IDEOGRAPH-4E00.
    """
    script = np.zeros(sys.maxunicode + 1, np.uint8)
    lower = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    numbers: dict[str, int] = {}
    for point in range(sys.maxunicode + 1):
        char = chr(point)
        if unicodedata.category(char)[0] == "L":
            name = unicodedata.name(char, "OTHER").partition(" ")[0].partition("-")[0]
            script[point] = numbers.setdefault(name, min(len(numbers) + 1, 255))
            folded = char.lower()
            if len(folded) == 1:
                lower[point] = ord(folded)
    return script, lower


class Spelled:
    """Words of the texts of one column, as code points.

    ``first[d]:first[d + 1]`` are the words of text ``d``; ``start`` and ``end`` are offsets
    into all code points, ``offsets[d]`` is where text ``d`` begins there.
    """

    def __init__(self, column: pa.Array):
        texts = [t or "" for t in column.to_pylist()]
        self.offsets = np.cumsum([0, *map(len, texts)])
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        table, lower = once("letters", letters)
        script = table[points]
        cut = np.ones(script.size + 1, bool)
        cut[1:-1] = script[1:] != script[:-1]
        cut[self.offsets] = True
        inside = script > 0
        self.start = np.flatnonzero(inside & cut[:-1])
        self.end = np.flatnonzero(inside & cut[1:]) + 1
        self.script = script[self.start]
        self.first = np.searchsorted(self.start, self.offsets)
        self.points = lower[points]

    def __len__(self) -> int:
        return self.start.size

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """One word of each spelling, and for every word the number of its spelling."""
        if not len(self):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        sizes = self.end - self.start
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        points = self.points[at + np.repeat(self.start, sizes)]
        powers = np.cumprod(np.append(np.uint64(1), np.full(int(sizes.max()) - 1, stream(1, 1)[0] | np.uint64(1))), dtype=np.uint64)
        values = mix(points.astype(np.uint64) + np.uint64(1)) * powers[at]
        hashes = mix(np.add.reduceat(values, np.cumsum(sizes) - sizes) + sizes.astype(np.uint64))
        _, one, which = np.unique(hashes, return_index=True, return_inverse=True)
        return one, which

    def grams(self, pick: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Bucket of every n-gram of the picked words, one array an order, and where each
        word's begin. Words count with an edge on either side. Places at which no n-gram
        fits in the word hold ``BUCKETS``."""
        sizes = self.end[pick] - self.start[pick] + 2
        begins = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) - np.repeat(begins, sizes)
        left = np.repeat(sizes, sizes) - at  # places up to the end of the word
        here = np.repeat(self.start[pick] - 1, sizes) + at
        edge = (at == 0) | (left == 1)
        points = np.where(edge, np.uint32(0x20), self.points[np.clip(here, 0, max(self.points.size - 1, 0))])
        values = mix(points.astype(np.uint64) + np.uint64(1))
        out, total = [], np.zeros(at.size, np.uint64)
        for n, factor in enumerate(stream(7, max(ORDERS)), 1):
            total[: at.size - n + 1] += values[n - 1 :] * (factor | np.uint64(1))
            if n in ORDERS:
                bucket = (mix(total + np.uint64(n)) >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1)
                # A lone edge says nothing.
                none = (left < n) | (edge if n == 1 else False)
                out.append(np.where(none, BUCKETS, bucket))
        return out, begins


@dataclass
class LanguageModel:
    langs: list[str]
    #: Log-probabilities by bucket and language, one table an order; the last row is 0.
    tables: list[np.ndarray]
    #: Whether a script (by number) may be in a language.
    written: np.ndarray

    def scores(self, words: Spelled) -> np.ndarray:
        """How much less likely each word is in each language than in its best one, up to a limit."""
        one, which = words.distinct()
        buckets, begins = words.grams(one)
        total = np.zeros((one.size, len(self.langs)))
        for table, bucket in zip(self.tables, buckets):
            if one.size:
                total += np.add.reduceat(table[bucket], begins, axis=0)
        total /= len(ORDERS)
        candidates = self.written[words.script[one]]
        total[~candidates] = -np.inf
        total = np.maximum(total - total.max(axis=1, keepdims=True, initial=-np.inf), -MOST)
        total[~candidates] = -FOREIGN
        return total[which]


def _counts(langs: list[str]):
    """(lang, kind, at, n): kind 0 counts letters by script, others n-grams by bucket."""
    numbers = {lang: i for i, lang in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(ORDERS) * (BUCKETS + 1)
        grams = np.zeros((len(langs), width))
        scripts = np.zeros((len(langs), 256))
        for batch in slices(batches, _SLICE):
            lang = np.array([numbers[x] for x in batch.column("lang").to_pylist()], np.int64)
            words = Spelled(batch.column("text"))
            owner = np.repeat(lang, np.diff(words.first))
            np.add.at(scripts, (owner, words.script), words.end - words.start)
            for k in np.unique(owner):
                mine = np.flatnonzero(owner == k)
                buckets, _ = words.grams(mine)
                for order, bucket in enumerate(buckets):
                    seen = np.bincount(bucket, minlength=BUCKETS + 1)
                    grams[k, order * (BUCKETS + 1) : (order + 1) * (BUCKETS + 1)] += seen
        for kind, table in ((0, scripts), (1, grams)):
            k, at = np.nonzero(table)
            columns = [k.astype(np.int32), np.full(k.size, kind, np.int32), at.astype(np.int32), table[k, at]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["lang", "kind", "at", "n"])

    return run


def fit_languages(docs: DataFrame, may_learn: str = "true", bound: int = SAMPLE) -> LanguageModel:
    """Learn from (doc_id, text, lang) rows for which ``may_learn`` holds and lang is not null.

    About ``bound`` rows at most are read, chosen by a hash of the id. Their n-grams are
    counted in tasks and summed on the cluster; what reaches the driver is one table whose
    size depends on the number of languages alone. No such row: a model without languages.
    """
    known = docs.where(may_learn).where("lang is not null").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    # Each language gets an equal part of the bound, so that rare ones are read as a whole.
    part = max(1, bound // max(1, len(langs)))
    rates = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, part / sizes[lang]))]) if langs else F.create_map()
    drawn = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text"), F.lit(1_000_000)) / 1_000_000
    sample = known.where(drawn < rates[F.col("lang")]) if langs else known.limit(0)
    found = sample.select("text", "lang").mapInArrow(_counts(langs), "lang int, kind int, at int, n double")
    found = found.groupBy("lang", "kind", "at").agg(F.sum("n").alias("n")).toArrow()
    lang, kind, at, n = (found.column(c).to_numpy() for c in ("lang", "kind", "at", "n"))
    scripts, grams = np.zeros((256, len(langs))), np.zeros((len(ORDERS) * (BUCKETS + 1), len(langs)))
    for number, table in ((0, scripts), (1, grams)):
        pick = kind == number
        table[at[pick], lang[pick]] = n[pick]
    tables = []
    for counts in grams.reshape(len(ORDERS), BUCKETS + 1, len(langs)):
        counts = counts[:BUCKETS]
        types = (counts.sum(axis=1) > 0).sum() + 1
        chance = np.log((1 - SMOOTHING) * counts / np.maximum(counts.sum(axis=0), 1) + SMOOTHING / types)
        tables.append(np.append(chance, np.zeros((1, len(langs))), axis=0).astype(np.float32))
    written = scripts >= WRITES * np.maximum(scripts.sum(axis=0), 1)
    written |= ~written.any(axis=1, keepdims=True)  # a script nobody writes says nothing
    return LanguageModel(langs, tables, written)


def best_path(scores: np.ndarray, first: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """Language of every word: the sequence of each text with the highest sum of scores,
    where a change costs ``penalty``. Ties stay with the language before, else the first.

    Texts are cut into chunks. Chunks are worked on side by side, first for every language
    the chunk may begin after; chained, that gives what each chunk really begins with.
    A second walk then notes the choices, and they are followed back.
    """
    n_words, n_langs = scores.shape
    per_text = -(-np.diff(first) // _CHUNK)
    text = np.repeat(np.arange(per_text.size), per_text)
    rank = np.arange(text.size) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    begin = first[text] + rank * _CHUNK
    size = np.minimum(first[text + 1] - begin, _CHUNK)
    order = np.argsort(-size, kind="stable")  # at each step those still going come first
    begin, size, chunk_of = begin[order], size[order], np.argsort(order)
    going = [int(np.searchsorted(-size, -t, "left")) for t in range(_CHUNK)]

    through = np.where(np.eye(n_langs, dtype=bool), 0.0, -np.inf)[None].repeat(size.size, axis=0)
    for t, n in enumerate(going):
        if n:
            now = through[:n]
            moved = now.max(axis=2, keepdims=True) - penalty
            through[:n] = np.maximum(now, moved) + scores[begin[:n] + t][:, None, :]

    texts = np.flatnonzero(per_text)
    heads = (np.cumsum(per_text) - per_text)[texts]
    entry = np.zeros((size.size, n_langs))
    state = np.zeros((texts.size, n_langs))
    for r in range(int(per_text.max(initial=0))):
        on = per_text[texts] > r
        chunk = chunk_of[heads[on] + r]
        entry[chunk] = state[on]
        state[on] = (state[on][:, :, None] + through[chunk]).max(axis=1)

    stayed = np.zeros((_CHUNK, size.size, n_langs), bool)
    source = np.zeros((_CHUNK, size.size), np.int16)
    value = entry.copy()
    for t, n in enumerate(going):
        if n:
            now = value[:n]
            source[t, :n] = now.argmax(axis=1)
            moved = now.max(axis=1, keepdims=True) - penalty
            stayed[t, :n] = now >= moved
            value[:n] = np.maximum(now, moved) + scores[begin[:n] + t]

    # Followed back for every language a chunk may end in, then only the real one is kept.
    label = np.zeros((_CHUNK, size.size, n_langs), np.int16)
    at = np.tile(np.arange(n_langs, dtype=np.int16), (size.size, 1))
    for t in range(_CHUNK - 1, -1, -1):
        n = going[t]
        if n:
            label[t, :n] = at[:n]
            keep = np.take_along_axis(stayed[t, :n], at[:n].astype(np.int64), axis=1)
            at[:n] = np.where(keep, at[:n], source[t, :n, None])
    end = np.zeros(size.size, np.int64)
    last = value.argmax(axis=1)
    close = np.zeros(texts.size, np.int64)
    for r in range(int(per_text.max(initial=0)) - 1, -1, -1):
        on = np.flatnonzero(per_text[texts] > r)
        chunk = chunk_of[heads[on] + r]
        final = per_text[texts[on]] == r + 1
        end[chunk] = np.where(final, last[chunk], close[on])
        close[on] = at[chunk, end[chunk]]
    out = np.zeros(n_words, np.int64)
    for t, n in enumerate(going):
        if n:
            out[begin[:n] + t] = label[t, np.arange(n), end[:n]]
    return out


_FOUND = "lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"


def label_languages(docs: DataFrame, model: LanguageModel, penalty: float = SWITCH) -> DataFrame:
    """(doc_id, lang_pred, score, spans) of every row of (doc_id, text).

    ``spans`` are the stretches of one language, from the first to the last letter of their
    words, in code points. ``lang_pred`` is the language with most letters in them (ties:
    the first by code point), ``score`` its share of all letters. Texts that are null or
    have no letter, and all texts where nothing could be learnt, get "und", score 0 and no
    span. Whole texts are looked at; other columns are not read. Repeated rows and null ids
    come out as they go in.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "lang_pred", "score", "spans"]
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = pa.array([*model.langs, UNKNOWN])
        for batch in slices(batches, _SLICE):
            words = Spelled(batch.column("text"))
            rows, n = batch.num_rows, len(model.langs)
            text = np.repeat(np.arange(rows), np.diff(words.first))
            if n and len(words):
                label = best_path(model.scores(words), words.first, penalty)
            else:
                label, text = np.zeros(0, np.int64), text[:0]
            amount = np.zeros((rows, n + 1))
            np.add.at(amount, (text, label), (words.end - words.start)[: text.size])
            total = amount.sum(axis=1)
            best = np.where(total > 0, amount.argmax(axis=1), n)
            score = np.where(total > 0, amount.max(axis=1) / np.maximum(total, 1), 0.0)
            new = np.ones(text.size, bool)
            new[1:] = (text[1:] != text[:-1]) | (label[1:] != label[:-1])
            opens = np.flatnonzero(new)
            closes = np.append(opens[1:], text.size)[: opens.size] - 1
            owner = text[opens]
            base = words.offsets[owner]
            fields = [
                pa.array((words.start[opens] - base).astype(np.int32)),
                pa.array((words.end[closes] - base).astype(np.int32)), langs.take(pa.array(label[opens])),
            ]
            spans = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32)),
                pa.StructArray.from_arrays(fields, fields=list(span)),
            )
            columns = [batch.column("doc_id"), langs.take(pa.array(best)), pa.array(score), spans]
            yield pa.RecordBatch.from_arrays(columns, names)

    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, f"doc_id {kind}, {_FOUND}")
