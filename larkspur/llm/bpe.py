"""Byte-level BPE by replaying merges over all different words of a batch at once.

Encoding a word at a time repeats the same merges for every word. Here the different
words of a batch lie one behind the other in one array of tokens, linked to their
neighbours. An index from merge to the positions at which its pair stands is filled
once; merges are then applied in rank order, each at all its positions, and only the
pairs that touch a changed position are looked up again.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from hashlib import sha256
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.scan import slices
from larkspur.llm.token_counts import safe_pieces

BATCH_BYTES = 4 << 20
# Different pieces of text that a task remembers between batches.
REMEMBERED = 200_000
_NONE = np.int32(1 << 30)
_SHIFT = 24


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes and rank of every line of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}


class Merges:
    """The pairs of a vocabulary, ready for lookups of many pairs at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << _SHIFT | right] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int32)
        self.keys = np.append(self.keys, np.int64(1) << 62)
        self.values = np.append(self.values, _NONE)
        left, right = np.divmod(np.arange(1 << 16), 256)
        self.of_bytes = self.lookup(self.byte_id[left], self.byte_id[right])

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, or a large number where there is none."""
        wanted = (left.astype(np.int64) << _SHIFT) | right
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, self.values[at], _NONE)

    def one(self, word: bytes) -> list[int]:
        """Merge a single word, always the leftmost pair of least rank."""
        tokens = [bytes([b]) for b in word]
        while True:
            best = min(
                ((self.ranks.get(a + b, _NONE), i) for i, (a, b) in enumerate(zip(tokens, tokens[1:]))),
                default=(_NONE, 0),
            )
            if best[0] == _NONE:
                return [self.ranks[t] for t in tokens]
            i = best[1]
            tokens[i : i + 2] = [tokens[i] + tokens[i + 1]]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of every word; a word that is a token is that token."""
        out: list[list[int] | None] = []
        rest, where = [], []
        for i, word in enumerate(words):
            rank = self.ranks.get(word)
            out.append([] if not word else None if rank is None else [rank])
            if out[-1] is None:
                rest.append(word)
                where.append(i)
        if rest:
            tokens, counts, odd = self._replay(rest)
            ends = np.cumsum(counts).tolist()
            flat, start = tokens.tolist(), 0
            for i, end in zip(where, ends):
                out[i] = flat[start:end]
                start = end
            for j in odd:
                out[where[j]] = self.one(rest[j])
        return out

    def _replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, set[int]]:
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        n = flat.size  # position n stands for: beyond the word
        token = np.append(self.byte_id[flat], np.int32(0))
        after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        after[ends - 1] = n
        before[ends - sizes] = n
        rank = np.full(n + 1, _NONE, np.int32)
        inner = np.flatnonzero(after[:n] < n)
        rank[inner] = self.of_bytes[flat[inner] * 256 + flat[inner + 1]]
        alive = np.ones(n, bool)
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []
        odd: set[int] = set()

        def put(positions: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for r, group in zip(ranks[np.append(0, cuts)].tolist(), np.split(positions, cuts) if cuts.size else [positions]):
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(heap, r)
                waiting[r].append(group)

        inner = inner[rank[inner] < _NONE]
        if inner.size:
            put(inner, rank[inner])
        while heap:
            r = heapq.heappop(heap)
            groups = waiting.pop(r)
            p = groups[0] if len(groups) == 1 else np.concatenate(groups)
            p = p[rank[p] == r]
            if p.size > 1:
                p = np.unique(p)
            if not p.size:
                continue
            q = after[p]
            if p.size > 1:
                touches = p[1:] == q[:-1]
                if touches.any():  # aaa: every other pair of a chain, from its left end
                    here = np.arange(p.size)
                    starts = np.maximum.accumulate(np.where(np.append(False, touches), 0, here))
                    even = (here - starts) % 2 == 0
                    p, q = p[even], q[even]
            beyond = after[q]
            token[p] = r
            after[p] = beyond
            before[beyond] = p
            alive[q] = False
            rank[q] = _NONE
            left = before[p]
            changed = np.concatenate([p, left[left < n]])
            right = after[changed]
            new = np.where(right < n, self.lookup(token[changed], token[right]), _NONE)
            rank[changed] = new
            found = new < _NONE
            if found.any():
                changed, new = changed[found], new[found]
                early = changed[new < r]
                if early.size:  # its turn has passed: such a word is merged on its own
                    odd.update(np.searchsorted(ends, early, "right").tolist())
                put(changed, new)
        left_over = np.flatnonzero(alive)
        counts = np.bincount(np.searchsorted(ends, left_over, "right"), minlength=len(words))
        return token[:n][alive], counts, odd

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class _Numbers(dict):
    def __missing__(self, piece):
        number = self[piece] = len(self)
        return number


def _encoder(docs: DataFrame, path: str, pattern: str):
    """A function that gives, for a batch, the piece numbers of each text and the pieces' ids.

    The pattern must be one whose matches never reach over a space that something other
    than white space follows, as those of byte-level vocabularies do not. Texts are cut
    there, and only different pieces are matched against it.
    """
    with open(path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def start():
        import regex

        find = regex.compile(pattern).findall
        merges = Merges(parse_ranks(shared.value))
        numbers, ids = _Numbers(), []

        def encode(texts: list[str]) -> tuple[list[np.ndarray], list[list[int]]]:
            nonlocal numbers, ids
            if len(numbers) > REMEMBERED:
                numbers, ids = _Numbers(), []
            found = []
            for text in texts:
                pieces = safe_pieces(text)
                found.append(np.fromiter(map(numbers.__getitem__, pieces), np.int64, len(pieces)))
            fresh = [find(piece) for piece in islice(numbers, len(ids), None)]
            words = list(dict.fromkeys(word for own in fresh for word in own))
            known = dict(zip(words, merges.encode_words([word.encode() for word in words])))
            for own in fresh:
                if len(own) == 1:
                    ids.append(known[own[0]])
                else:
                    ids.append([i for word in own for i in known[word]])
            return found, ids

        return encode, merges

    return start


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>) for every row; null texts count as empty."""
    start = _encoder(docs, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, _ = start()
        for batch in slices(batches, BATCH_BYTES):
            found, ids = encode([t or "" for t in batch.column("text").to_pylist()])
            rows = [[i for w in own.tolist() for i in ids[w]] for own in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(rows, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, ids array<int>"
    )


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, decoded binary) from (doc_id, ids)."""
    with open(path, "rb") as f:
        shared = encoded.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = {rank: token for token, rank in parse_ranks(shared.value).items()}
        for batch in batches:
            rows = [b"".join(map(of.__getitem__, x or ())) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(rows, pa.binary())], ["doc_id", "decoded"]
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for every row of (doc_id, text).

    The ids of each document are those of :func:`encode_documents`, the bytes those of
    :func:`decode_documents`; both are digested in the task that makes them, so neither
    is shuffled or stored. A task holds one batch of texts and its different words.

    Null texts count as empty; an empty text has no ids and two digests of nothing.
    Very long texts and words are ordinary. Repeated rows and null ids are kept. Other
    columns are not read. Empty table: no rows.
    """
    start = _encoder(docs, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, merges = start()
        written: list[str] = []
        decoded: list[bytes] = []
        counts = np.zeros(0, np.int64)
        for batch in slices(batches, BATCH_BYTES):
            found, ids = encode([t or "" for t in batch.column("text").to_pylist()])
            if len(ids) < len(written):
                written, decoded = [], []
            fresh = ids[len(written) :]
            written += [",".join(map(str, x)) for x in fresh]
            decoded += [merges.decode(x) for x in fresh]
            counts = np.fromiter(map(len, ids), np.int64, len(ids))
            totals, id_digests, byte_digests = [], [], []
            for own in found:
                totals.append(int(counts[own].sum()))
                own = own.tolist()
                id_digests.append(sha256(",".join(map(written.__getitem__, own)).encode()).hexdigest())
                byte_digests.append(sha256(b"".join(map(decoded.__getitem__, own))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(id_digests, pa.string()), pa.array(byte_digests, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
