"""Substring dedup: sliding sentence spans, joined globally by hash.

A text is cut, without loss, into sentences, which end with ``. ! ?``, the like
of other scripts, or a line end; a sentence of more than ``SENTENCE_WORDS``
words is cut where its words say so, whatever stands before. Very short ones in a
row are gathered likewise, so that they make runs. Signs of scripts
that set no blanks are words each. Every run of ``SPAN`` consecutive sentences with ``SPAN_WORDS`` words or
more is hashed, by its words with A-Z in lower case and without ASCII punctuation. Where a
run occurs more than once in all documents, its first occurrence stays, by
ascending id and then by place; the sentences of every other one are removed.

Hashes have 64 bits. Counting and the first occurrence are partial aggregates,
so a passage that very many documents share shuffles a row for each task.

Defined results: null and empty texts stay as they are; texts under ``SPAN``
sentences too, as they have no span; rows that share an id are one document,
and so are all rows without id, which come last; other columns pass through
unless their names are those of the result, whatever they are called.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsync.llm.text import PLAIN, WordHashes, combined, text_blocks

SPAN = 2
SPAN_WORDS = 8
SENTENCE_WORDS = 25
# Sentences of so many words or fewer are gathered where so many follow each other.
SHORT_WORDS = 3
SHORT_BYTES = 100
SHORT_ROW = 4
# In longer sentences a cut stands out among so many words to each side.
NEAR_WORDS = 3
_TOP = np.uint64((1 << 64) - 1)
# Rows without id come after all others.
NO_ID = (1 << 63) - 1
RESULT = ("kept_text", "removed_sentences")

_SENTENCE = re.compile(rb"[^.!?\n]*[.!?\n]+[ \t\r\n]*|[^.!?\n]+")
# Sentence ends of other scripts, and scripts that set no blanks between words.
_ENDS = "|".join(map(re.escape, "\u3002\uff01\uff1f\uff0e\uff61\u2026\u061f\u06d4\u0964\u0965\u1362\u0589\u2028\u2029")).encode()
_WIDE_END = re.compile(_ENDS)
_WIDE_SENTENCE = re.compile(
    rb"(?:(?!%b)[^.!?\n])*(?:[.!?\n]|%b)+(?:[ \t\r\n]|\xe3\x80\x80)*|(?:(?!%b)[^.!?\n])+" % (_ENDS, _ENDS, _ENDS)
)
_SIGN = (
    rb"(?:[\xe3-\xe9][\x80-\xbf]{2}|\xf0[\xa0-\xb3][\x80-\xbf]{2}"
    rb"|\xe0[\xb8-\xbb][\x80-\xbf]|\xe1(?:[\x80-\x82]|[\x9e\x9f])[\x80-\xbf])"
)
_WIDE_SIGN = re.compile(_SIGN)
_WIDE_WORD = re.compile(rb"%b|(?:(?!%b)[^ ])+" % (_SIGN, _SIGN))


def _words(parts: list[bytes]) -> list[list[bytes]]:
    """Plain words of each part; each sign of a script without blanks is one."""
    plain = [p.translate(PLAIN) for p in parts]
    return [_WIDE_WORD.findall(p) for p in plain] if _has_signs(b"".join(parts)) else [p.split() for p in plain]


def _has_signs(text: bytes) -> bool:
    return not text.isascii() and _WIDE_SIGN.search(text) is not None


def _long_words(part: bytes) -> tuple[list[bytes], list[int]] | None:
    """Words of a long sentence and where they begin; nothing for others."""
    plain = part.translate(PLAIN)
    if _has_signs(part):
        found = list(_WIDE_WORD.finditer(plain))
        return ([m[0] for m in found], [m.start() for m in found]) if len(found) > SENTENCE_WORDS else None
    words = plain.split()
    if len(words) <= SENTENCE_WORDS:
        return None
    filled = np.frombuffer(b" " + plain, np.uint8) != 32
    return words, np.flatnonzero(filled[1:] & ~filled[:-1]).tolist()


def _cut_long(parts: list[bytes], doubtful: list[int]) -> list[bytes]:
    """Sentences, the long ones cut after words that have the lowest hash among their neighbours.

    The choice depends on ``NEAR_WORDS`` words to each side and the word that
    follows, so it is the same wherever a passage stands. Only stretches where
    no word stands out, as where words recur, are cut every so many. ``doubtful``
    are the places of sentences that may be long.
    """
    long = {i: found for i in doubtful if (found := _long_words(parts[i])) is not None}
    if not long:
        return parts
    out, last = [], 0
    for (i, (_, starts)), places in zip(long.items(), _cuts([words for words, _ in long.values()])):
        cuts = [0, *(starts[p] for p in places), len(parts[i])]
        out += parts[last:i]
        out += [parts[i][a:b] for a, b in zip(cuts, cuts[1:])]
        last = i + 1
    return out + parts[last:]


def _cuts(some: list[list[bytes]]) -> list[list[int]]:
    """For each list of words the places before each of which a word has the lowest hash around."""
    sizes = np.fromiter(map(len, some), np.int64, len(some))
    flat = [w for words in some for w in words]
    pairs = combined(np.fromiter(map(zlib.crc32, flat), np.uint64, len(flat)), 2)
    # A pair for each word but the last of a list; lists lie apart, the highest hash between them.
    ends = np.cumsum(sizes)
    own = np.ones(len(flat), bool)
    own[ends - 1] = False
    at = np.arange(len(flat)) + NEAR_WORDS * np.repeat(np.arange(1, len(some) + 1), sizes)
    value = np.full(len(flat) + NEAR_WORDS * (len(some) + 1), _TOP)
    value[at[own]] = pairs[own[:-1]] if len(flat) else pairs
    inner = value[NEAR_WORDS:-NEAR_WORDS]
    # Less than those before, not more than those after: two cuts lie further apart.
    lowest = inner != _TOP
    for k in range(1, NEAR_WORDS + 1):
        lowest &= inner < value[NEAR_WORDS - k : len(value) - NEAR_WORDS - k]
        lowest &= inner <= value[NEAR_WORDS + k : len(value) - NEAR_WORDS + k]
    low = np.flatnonzero(lowest[at - NEAR_WORDS])
    bounds = np.searchsorted(low, [0, *ends.tolist()]).tolist()
    places = (low - np.repeat(ends - sizes, np.diff(bounds)) + 1).tolist()
    out = []
    for size, i, j in zip(sizes.tolist(), bounds, bounds[1:]):
        found: list[int] = []
        last = 0
        for place in [*places[i:j], size]:
            if place - last > SENTENCE_WORDS:
                found += range(last + SENTENCE_WORDS, place, SENTENCE_WORDS)
            found.append(place)
            last = place
        out.append(found[:-1])
    return out


def _gathered(short: list[bytes]) -> list[bytes]:
    """Short sentences in a row, several together, parted as the words of a long one."""
    plain = [b" ".join(p.translate(PLAIN).split()) for p in short]
    worded = [k for k, p in enumerate(plain) if p]
    if len(worded) < SHORT_ROW:
        return short
    cuts = [0, *(worded[p - 1] + 1 for p in _cuts([[plain[k] for k in worded]])[0]), len(short)]
    return [b"".join(short[a:b]) for a, b in zip(cuts, cuts[1:])]


def sentences(text: bytes | None) -> list[bytes]:
    """The sentences of a text, which joined give the text again."""
    text = text or b""
    out: list[bytes] = []
    short: list[bytes] = []
    doubtful: list[int] = []
    wide = not text.isascii() and _WIDE_END.search(text)
    for found in (_WIDE_SENTENCE if wide else _SENTENCE).findall(text):
        if len(found) <= SHORT_BYTES and len(found.split() if found.isascii() else _words([found])[0]) <= SHORT_WORDS:
            short.append(found)
            continue
        if short:
            out += _gathered(short) if len(short) >= SHORT_ROW else short
            short = []
        if len(found) > 2 * SENTENCE_WORDS and (not found.isascii() or len(found.split()) > SENTENCE_WORDS):
            doubtful.append(len(out))
        out.append(found)
    out += _gathered(short) if len(short) >= SHORT_ROW else short
    return _cut_long(out, doubtful)


def spans(parts: list[bytes], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Places of the runs that count, and their hashes."""
    words = _words(parts)
    flat = hashes.of([w for own in words for w in own])
    ends = np.cumsum([0, *map(len, words)])
    size = len(parts) - SPAN + 1
    if size <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    # Sums of word hashes times powers of an odd number: a difference of two sums,
    # moved back to power 0, depends on the words of the run alone.
    powers = _powers(len(flat))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(flat * powers[0][: len(flat)], dtype=np.uint64)])
    begin, end = ends[:size], ends[SPAN:]
    runs = (sums[end] - sums[begin]) * powers[1][begin]
    mixed = combined(np.stack([runs, (end - begin).astype(np.uint64)], 1).ravel(), 2)[::2]
    places = np.flatnonzero(end - begin >= SPAN_WORDS)
    return places, mixed[places]


_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, ``n`` of them at least."""
    if len(_POWERS[0]) <= n:
        size = max(2 * len(_POWERS[0]), n + 1)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS


def sentence_spans(docs: DataFrame) -> DataFrame:
    """``span, id, place`` of every run that counts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch, texts in text_blocks(batches):
            found = [spans(sentences(t), hashes) for t in texts]
            ids = np.repeat(batch.column("id").to_numpy(zero_copy_only=False), [len(p) for p, _ in found])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([h for _, h in found]).view(np.int64)),
                    pa.array(ids, pa.int64()),
                    pa.array(np.concatenate([p for p, _ in found]).astype(np.int32)),
                ],
                names=["span", "id", "place"],
            )

    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), "text")
    return ids.mapInArrow(cut, "span long, id long, place int")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``id, marks``: for each document the places and hashes of its non-first runs."""
    found = sentence_spans(docs)
    first = (
        found.groupBy("span")
        .agg(F.min(F.struct("id", "place")).alias("low"), F.max(F.struct("id", "place")).alias("high"))
        .where("low <> high")
        .select("span", F.col("low.id").alias("first_id"), F.col("low.place").alias("first_place"))
    )
    return (
        found.join(first, "span")
        .where("id <> first_id OR place <> first_place")
        .groupBy("id")
        .agg(F.collect_set(F.struct("place", "span")).alias("marks"))
    )


def remove_repeated(docs: DataFrame) -> DataFrame:
    """``docs`` with ``kept_text`` and ``removed_sentences``."""
    rest = docs.drop(*(c for c in RESULT if c in docs.columns))
    # Other columns travel as one, so that no name of theirs meets one used here.
    own = rest.select(
        F.struct(*(F.col(quoted(c)) for c in rest.columns)).alias("row"),
        F.col("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
    )
    names = rest.columns
    joined = own.join(repeated_spans(docs), "id", "left")
    # By their places, as workers are not given names with dots in them.
    wide = joined.select(*(F.col(f"row.{quoted(c)}").alias(f"c{i}") for i, c in enumerate(names)), "marks")
    result = [T.StructField("kept_text", T.StringType()), T.StructField("removed_sentences", T.IntegerType())]
    schema = T.StructType([*rest.schema.fields, *result])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch, texts in text_blocks(batches, f"c{names.index('text')}"):
            kept, removed = [], []
            for text, found in zip(texts, batch.column(len(names)).to_pylist()):
                own, n = _without(text, found, hashes) if found else (text, 0)
                kept.append(own)
                removed.append(n)
            columns = batch.columns[: len(names)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(kept, pa.binary()).cast(pa.string()), pa.array(removed, pa.int32())],
                names=[*names, *RESULT],
            )

    return wide.mapInArrow(remove, schema)


def quoted(name: str) -> str:
    """A column's name, whatever signs it holds."""
    return "`" + name.replace("`", "``") + "`"


def _without(text: bytes | None, marks: list[dict], hashes: WordHashes) -> tuple[bytes | None, int]:
    """The text without the marked runs that it holds itself."""
    parts = sentences(text)
    places, found = spans(parts, hashes)
    own = dict(zip(places.tolist(), found.view(np.int64).tolist()))
    gone = {m["place"] + i for m in marks if own.get(m["place"]) == m["span"] for i in range(SPAN)}
    return (b"".join(p for i, p in enumerate(parts) if i not in gone), len(gone)) if gone else (text, 0)
