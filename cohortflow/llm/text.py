"""Small helpers shared by the text operators: byte slices of Arrow batches, words, stored intermediate tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cohortflow.plans.lineage import stored as stored

#: ASCII white space, the separators of words.
SPACES = " \t\n\x0b\f\r"
#: The same as a regular expression of Java and RE2.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, _UPPER, _LOWER)


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % modulus


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of whole rows with about ``max_bytes`` of text, to bound a task's working memory."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start, base = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, "right")))
            yield batch.slice(start, stop - start)
            start, base = stop, int(ends[stop - 1])


def as_bytes(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts as UTF-8 bytes, null as empty."""
    return batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).fill_null(b"").to_pylist()


class WordHashes(dict):
    """Word -> 64-bit hash, computed once per distinct word; emptied when it has ``limit`` words, to bound memory."""

    def __init__(self, limit: int = 400_000, seed: int = 0):
        super().__init__()
        self.limit, self.seed = limit, seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
