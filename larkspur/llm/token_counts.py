"""Token counts by a public tokenizer, without keeping any token."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.scan import slices

# Bytes of text that are split into pieces and encoded at a time, and pieces remembered.
BATCH_BYTES = 4 << 20
REMEMBERED = 200_000
LIMIT = 512


class _Pieces(dict):
    """Numbers pieces in order of arrival."""

    def __missing__(self, piece):
        number = self[piece] = len(self)
        return number


def safe_pieces(text: str) -> list[str]:
    """Cut a text before every space that a character other than white space follows.

    A byte-level vocabulary splits there in any case: no match of its pattern reaches
    over such a space from the left, and the white space before it is matched alike at
    the end of a text. Glued together, the pieces give the text.
    """
    head, *rest = text.split(" ")
    pieces, wait = [], head
    for part in rest:
        if part and not part[0].isspace():
            if wait:
                pieces.append(wait)
            wait = " " + part
        else:
            wait += " " + part
    if wait:
        pieces.append(wait)
    return pieces


def load_counter(name: str, content: bytes):
    """(lengths of a list of texts, strings that must not be cut or None: cut nothing)."""
    if name.endswith(".json"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(content.decode())
        tokenizer.no_truncation()
        tokenizer.no_padding()
        spec = json.loads(content)
        pre = spec.get("pre_tokenizer") or {}
        cuttable = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
            and not pre.get("add_prefix_space") and not spec.get("normalizer")
        )
        special = [t["content"] for t in spec.get("added_tokens", [])]

        def lengths(texts: list[str]) -> list[int]:
            return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        return lengths, special if cuttable else None

    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_proto=content)
    return lambda texts: [len(x) for x in processor.encode(texts, num_threads=1)], None


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of (doc_id, text).

    The vocabulary file is read once on the driver and broadcast; it is of fixed size.
    Arrow functions return lengths only. They work on batches of about equal bytes;
    texts are split at safe boundaries, and each different piece of a batch is encoded
    once. Texts that hold a special string, and all texts of vocabularies for which no
    boundary is known to be safe, are encoded whole.

    Null and empty texts have no bytes and no tokens. Repeated rows and null ids are
    counted as they are. Other columns are not read. Empty table: no rows.
    """
    with open(path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    name = os.path.basename(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, special = load_counter(name, shared.value)
        whole = re.compile("|".join(map(re.escape, special))) if special else None
        pieces, sizes = _Pieces(), []
        for batch in slices(batches, BATCH_BYTES):
            if len(pieces) > REMEMBERED:
                pieces, sizes = _Pieces(), []
            numbers, totals = [], np.zeros(batch.num_rows, np.int64)
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for text in texts:
                if special is None or (whole and whole.search(text)):
                    parts = [text] if text else []
                else:
                    parts = safe_pieces(text)
                numbers.append(np.fromiter(map(pieces.__getitem__, parts), np.int64, len(parts)))
            fresh = list(islice(pieces, len(sizes), None))
            for at in range(0, len(fresh), 4096):
                sizes += lengths(fresh[at : at + 4096])
            table = np.array(sizes, np.int64)
            for row, own in enumerate(numbers):
                totals[row] = table[own].sum() if own.size else 0
            n_bytes = np.array([len(t.encode()) for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_bytes), pa.array(totals), pa.array(totals > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
