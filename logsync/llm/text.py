"""Words, hashes and Arrow batches, as the operators of this package share them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

# Words remembered by a worker; beyond that it starts anew.
CACHED_WORDS = 100_000
# Bytes of text that a worker handles at a time.
BLOCK_BYTES = 2 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.uint64(0xBF58476D1CE4E5B9)
_SHIFT = np.uint64(29)

# Lower-cases A-Z and turns every other ASCII sign but digits into a blank;
# bytes above 127 stay.
PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c > 127 else 32
    for c in range(256)
)


def id_hash(doc_id: Column) -> Column:
    """crc32 of the id as text; NULL for NULL."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def hash_bound(share: float) -> int:
    """The 64-bit hash up to which about this share of all hashes lies, however small it is."""
    return max(-(1 << 63), min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63)))


class WordHashes(dict):
    """64-bit hashes of words, kept for the next time."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHED_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def combined(hashes: np.ndarray, width: int, step: int = 1) -> np.ndarray:
    """One hash for each run of ``width`` hashes, ``step`` apart; none for fewer."""
    size = max(0, len(hashes) - (width - 1) * step)
    out = np.zeros(size, np.uint64)
    for i in range(width):
        out = (out ^ hashes[i * step : i * step + size]) * _MIX
        out ^= out >> _SHIFT
    out *= _FOLD
    return out ^ (out >> _SHIFT)


def text_blocks(
    batches: Iterable[pa.RecordBatch], column: str = "text"
) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Batches cut into slices of bounded size, each with its texts in UTF-8."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
        sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1])
        at = 0
        while at < len(texts):
            end, load = at, 0
            while end < len(texts) and (end == at or load + sizes[end] <= BLOCK_BYTES):
                load += sizes[end]
                end += 1
            yield batch.slice(at, end - at), texts.slice(at, end - at).to_pylist()
            at = end
