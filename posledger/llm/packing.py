"""Packing by power-of-two decomposition: no sequence crosses documents.

A document of n token ids is cut into pieces of ``capacity`` ids and, for the rest, one piece per binary digit
of its length, largest first. Every piece is a sequence of its own whose length is a power of two, so it needs no
padding, and sequences of equal length form buckets that batch without waste. A sequence id holds, from the highest
bits, the bucket (binary logarithm of the length), the number of the task that cut it and a running number, so
buckets are contiguous in id order and no pass over all rows is needed to number them.

Ids: the tokenizer's without special tokens, then the end id. The pre-tokenizer of a word-based vocabulary never
joins characters across white space, so words are encoded once and kept in a memo of bounded size.

Defined results: a null or empty text is the end id alone. Repeated rows are packed once each. Texts are cut whole.
Extra columns are ignored; the output names are fixed. A null doc_id is carried as null.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from posledger.llm.common import text_of

CAPACITY = 4096
END_ID = 2
END = struct.pack("<I", END_ID)
MEMO = 250_000
#: Latin, Greek and Cyrillic letters, known as such to any Unicode version; the rest goes the whole way.
LAST_LETTER = "\u052f"
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SCHEMA = ("doc_id long, start long, length long, ids array<int>, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
ARROW = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.list_(pa.int32())),
    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
#: Pieces of one output batch.
OUT = 2000


class WordIds(dict):
    """Ids of white-space separated words, as little-endian bytes, encoded at first sight.

    Words of letters go straight to the vocabulary's merges, words of letters and final punctuation are put together from
    the two, all others take the tokenizer's whole way. Two generations of at most ``MEMO`` words bound the memory: a full
    one becomes the old one, and words found there move to the new one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        super().__init__()
        self.old: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = BPE(model["vocab"], merges, cache_capacity=0, end_of_word_suffix=model["end_of_word_suffix"])

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self._encoded(word)
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def _encoded(self, word: bytes) -> bytes:
        if word.isalpha() and word.islower():
            return self._letters(word)
        text = word.decode("utf-8", "replace")
        bare = text.rstrip(MARKS)
        if _is_word(bare):
            if bare != text:
                return self[bare.encode()] + self[text[len(bare):].encode()]
            normal = self.tokenizer.normalizer.normalize_str(text)
            if _is_word(normal):
                return self._letters(normal.encode())
        return _bytes_of(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _letters(self, letters: bytes) -> bytes:
        return _bytes_of([t.id for t in self.merges.tokenize("".join(map(BYTE_LETTERS.__getitem__, letters)))])

    def encode(self, text: bytes) -> bytes:
        # Lower-casing first halves the words seen; texts that may hold special tokens are left as they are.
        folded = text if b"<|" in text else text.lower()
        return b"".join(map(self.__getitem__, folded.split()))


def _is_word(text: str) -> bool:
    return text.isalpha() and max(text) <= LAST_LETTER


def _bytes_of(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else one after 255."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (chr(256 + i) for i in range(256))
    return [chr(b) if b in printable else next(others) for b in range(256)]


BYTE_LETTERS = _byte_letters()
_memos: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The memo of this Python worker, which outlives a task."""
    if path not in _memos:
        _memos[path] = WordIds(path)
    return _memos[path]


def pieces(n: int, capacity: int = CAPACITY) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of n ids; capacity is a power of two."""
    start, length = 0, capacity
    while start < n:
        while length > n - start:
            length >>= 1
        yield start, length
        start += length


def _pack(batches: Iterator[pa.RecordBatch], path: str, capacity: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    words, task, running, rows = word_ids(path), TaskContext.get().partitionId(), {}, []

    def flushed() -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(ARROW)
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ARROW)], schema=ARROW)

    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            ids = words.encode(text.as_py()) + END
            n = len(ids) // 4
            for start, length in pieces(n, capacity):
                cut = ids[4 * start:4 * (start + length)]
                bucket = length.bit_length() - 1
                nr = running[bucket] = running.get(bucket, -1) + 1
                rows.append((doc_id.as_py(), start, length, np.frombuffer(cut, "<i4") if with_ids else None,
                             zlib.crc32(cut), n, bucket << 57 | task << 33 | nr, 0))
            if len(rows) >= OUT:
                yield flushed()
    yield flushed()


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         with_ids: bool = True) -> DataFrame:
    """One row per piece. ``tokenizer`` is the path of a word-based vocabulary that every executor can read."""
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).cast("binary").alias("text"))
    return rows.mapInArrow(partial(_pack, path=tokenizer, capacity=capacity, with_ids=with_ids), SCHEMA)
