"""Alignment of two tokenizers' ids over the same bytes, and how often ids are linked.

Tokenizer A is byte-level BPE, read with a blank in front of the text; B is a
sentence piece model, which puts that blank there itself. Both go over whole
texts first. Where a token of A and one of B end at the same byte, and the next
token of each begins with a blank, the document may be cut; it is cut at those
of these anchors that the next id of A picks, one in ``EVERY``, so that copies of
a passage fall into the same windows. A window's alignment depends on its ids
alone, so it is worked out once and remembered by the tuple of both; a document is
the windows in a row. The bytes of either side's tokens are put
together and compared with the text, which verifies every anchor at once.

Links are counted over the corpus by pairs of ids. The pairs met in most
documents, a bounded number, are sent to all workers; a document's rarer pairs
are joined with the table of counts.

Defined results: null and empty texts, and texts whose tokens do not give back
their bytes (as with U+2581 in them), have no tokens: zeros and an empty text
for ``groups_sha256``. Strings of special tokens in a text are plain text.
Repeated rows and null ids count and are returned each for itself; a table
without rows gives none. Other columns are not carried.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsync.llm.text import text_blocks
from logsync.llm.token_files import _texts
from logsync.llm.tokens import ID, Encoder, tokenizer_path
from logsync.session import run_folder

PIECES = "piece_bpe_32k.model"
BLANK = "▁"
# Blanks and what follows them up to the next ones; so many of them are
# remembered by a worker, so many are new to the model at a time.
_WORD = re.compile(" +[^ ]*")
_REMEMBERED = 200_000
_AT_ONCE = 50_000
# Windows remembered by a worker, in each of two generations; longer ones are not.
WINDOWS = 20_000
WINDOW_IDS = 256
# One anchor in so many is a cut.
EVERY = 8
# Windows of a text that are looked up together.
CHUNK = 4_000
# So many of the most frequent pairs are sent to the workers, 16 bytes each.
SENT_PAIRS = 1 << 20
# Links that a task adds up before it hands on their counts.
COUNTED = 4 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)

DOCUMENT = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"
)
NOTHING = (0, 0, 0, 0, "", b"")


class PlainEncoder(Encoder):
    """Tokenizer A, to which the strings of special tokens are text like any other."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        signs = {sign: byte for byte, sign in self.signs.items()}
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in signs for c in token):
                self.bytes[i] = bytes(signs[c] for c in token)


class PieceEncoder:
    """Tokenizer B."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._bytes(i) for i in range(self.model.get_piece_size())]
        # The blank alone, which the model does not put before nothing.
        self.alone = _ids([self.model.piece_to_id(BLANK)])
        self.known: dict[str, bytes] = {}

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        if self.model.is_byte(i):
            return bytes([int(piece[1:-1], 16)])
        return piece.replace(BLANK, " ").encode()

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts, each with a blank in front already.

        No piece holds a blank behind another sign, so none reaches from one
        word into the next, and a word met before need not be encoded again.
        """
        words = [_WORD.findall(text) if BLANK not in text else None for text in texts]
        known = self.known
        new = list(dict.fromkeys([w for own in words if own for w in own if w not in known]))
        fresh = {}
        for at in range(0, len(new), _AT_ONCE):
            part = new[at : at + _AT_ONCE]
            # The model puts the first blank there itself.
            fresh.update(zip(part, [_ids(ids) for ids in self.model.encode([w[1:] for w in part], num_threads=1)]))
        if len(known) + len(fresh) > _REMEMBERED:
            known = {w: known[w] for own in words if own for w in own if w in known}
        known.update(fresh)
        known[" "] = self.alone
        out = []
        for text, own in zip(texts, words):
            ids = _ids(self.model.encode(text[1:])) if own is None else b"".join(map(known.__getitem__, own))
            out.append(np.frombuffer(ids, ID))
        self.known = known if len(known) <= _REMEMBERED else {}
        return out


def _ids(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class Aligner:
    """Documents as windows; one for each worker process."""

    def __init__(self, a: str, b: str) -> None:
        self.a, self.b = PlainEncoder(a), PieceEncoder(b)
        self.sizes = [np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b)]
        self.marked = [np.array([x[:1] == b" " for x in t.bytes]) for t in (self.a, self.b)]
        # Ids in decimal with what follows them: the next of the group, the other side, the next group.
        self.many = max(map(len, self.sizes))
        self.decimal = [f"{i}{sign}" for sign in ",|;" for i in range(self.many)]
        # For each window: its number of groups, the groups as text, its links as pairs.
        self.windows: dict[tuple[bytes, bytes], tuple[int, str, bytes]] = {}
        self.older: dict[tuple[bytes, bytes], tuple[int, str, bytes]] = {}

    def _cuts(self, ids: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """Where tokens that begin with a blank begin: bytes before them, and their places."""
        before = np.cumsum(self.sizes[side][ids])
        at = np.flatnonzero(self.marked[side][ids[1:]]) + 1
        return before[at - 1], at

    def _verified(self, text: bytes, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether the tokens of either side are the bytes of the text."""
        sides = zip((self.a, self.b), (a, b), self.sizes)
        return all(len(ids) and sizes[ids].all() and b"".join(map(t.bytes.__getitem__, ids.tolist())) == text for t, ids, sizes in sides)

    def document(self, a: np.ndarray, b: np.ndarray) -> Iterator[list[tuple[int, str, bytes]]]:
        """The windows of a text whose bytes are those of its tokens, some thousands at a time."""
        ends_a, at_a = self._cuts(a, 0)
        ends_b, at_b = self._cuts(b, 1)
        # Ends rise, so a search finds those that both have.
        place = np.searchsorted(ends_b, ends_a)
        picked = (a[at_a].astype(np.uint64) * _MIX >> np.uint64(40)) % np.uint64(EVERY) == 0
        if len(ends_b):
            picked &= ends_b[np.minimum(place, len(ends_b) - 1)] == ends_a
        shared = np.flatnonzero(picked) if len(ends_b) else place[:0]
        cut_a = [0, *(4 * at_a[shared]).tolist(), 4 * len(a)]
        cut_b = [0, *(4 * at_b[place[shared]]).tolist(), 4 * len(b)]
        ids_a, ids_b = a.tobytes(), b.tobytes()
        for low in range(0, len(cut_a) - 1, CHUNK):
            high = min(low + CHUNK, len(cut_a) - 1)
            own_a, own_b = cut_a[low : high + 1], cut_b[low : high + 1]
            keys = [
                (ids_a[i:j], ids_b[k:m]) for i, j, k, m in zip(own_a, own_a[1:], own_b, own_b[1:])
            ]
            found = list(map(self.windows.get, keys))
            if None in found:
                found = self._with_new(keys, found)
            yield found

    def _with_new(self, keys: list, found: list) -> list[tuple[int, str, bytes]]:
        """Windows that are not remembered yet are worked out together."""
        missing = dict.fromkeys([k for k, w in zip(keys, found) if w is None])
        fresh = {k: w for k in missing if (w := self.older.get(k)) is not None}
        new = [k for k in missing if k not in fresh]
        fresh.update(zip(new, self._aligned(new)))
        if len(self.windows) >= WINDOWS:
            self.older, self.windows = self.windows, {}
        self.windows.update((k, w) for k, w in fresh.items() if len(k[0]) + len(k[1]) <= 4 * WINDOW_IDS)
        return [fresh[k] if w is None else w for k, w in zip(keys, found)]

    def _aligned(self, keys: list[tuple[bytes, bytes]]) -> list[tuple[int, str, bytes]]:
        """Groups and links of windows, laid one behind the other."""
        if not keys:
            return []
        a, b = (np.frombuffer(b"".join([k[side] for k in keys]), ID).astype(np.int64) for side in (0, 1))
        sizes = self.sizes[0][a]
        ends_a, ends_b = np.cumsum(sizes), np.cumsum(self.sizes[1][b])
        # A token of A overlaps those of B from the first that ends beyond its start.
        first = np.searchsorted(ends_b, ends_a - sizes, "right")
        last = np.searchsorted(ends_b, ends_a, "left")
        links = last - first + 1
        upto = np.cumsum(links)
        b_at = np.arange(upto[-1]) - np.repeat(upto - links - first, links)
        pairs = (np.repeat(a, links) << 32 | b[b_at]).tobytes()
        closes_a = ends_b[last] == ends_a
        closes_b = ends_a[np.searchsorted(ends_a, ends_b)] == ends_b
        # Of each group first the tokens of A, then those of B.
        group_a, group_b = (np.cumsum(c) - c for c in (closes_a, closes_b))
        through_a, through_b = (np.flatnonzero(c) + 1 for c in (closes_a, closes_b))
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.append(0, through_b)[group_a]] = a + self.many * closes_a
        order[np.arange(len(b)) + through_a[group_b]] = b + 2 * self.many * closes_b
        tokens = list(map(self.decimal.__getitem__, order.tolist()))
        ends = [np.cumsum([len(k[side]) >> 2 for k in keys]) for side in (0, 1)]
        groups = np.cumsum(closes_a)[ends[0] - 1]
        counts = np.diff(groups, prepend=0).tolist()
        cuts = [0, *(ends[0] + ends[1]).tolist()]
        link_cuts = [0, *(8 * upto[ends[0] - 1]).tolist()]
        texts = ["".join(tokens[i:j]) for i, j in zip(cuts, cuts[1:])]
        return list(zip(counts, texts, [pairs[i:j] for i, j in zip(link_cuts, link_cuts[1:])]))

    def rows(self, texts: list[str | None]) -> list[tuple]:
        """For each text: tokens of A and of B, groups, links, hash of the groups, pairs with their numbers."""
        given = [i for i, text in enumerate(texts) if text]
        out: list[tuple] = [NOTHING] * len(texts)
        own = [f" {texts[i]}" for i in given]
        of_a = [np.frombuffer(ids, ID)[:-1] for ids in self.a(own)]
        for i, text, a, b in zip(given, own, of_a, self.b(own)):
            if not self._verified(text.encode(), a, b):
                continue
            n_groups, links, sha, last = 0, [], hashlib.sha256(), ""
            for windows in self.document(a, b):
                n_groups += sum([w[0] for w in windows])
                links += [w[2] for w in windows]
                # Each group's text ends with what parts it from the next.
                groups = last + "".join([w[1] for w in windows])
                sha.update(groups[:-1].encode())
                last = groups[-1:]
            pairs = np.frombuffer(b"".join(links), np.int64)
            out[i] = (len(a), len(b), n_groups, len(pairs), sha.hexdigest(), packed(*np.unique(pairs, return_counts=True)))
        return out


@lru_cache(maxsize=2)
def aligner(a: str, b: str) -> Aligner:
    return Aligner(a, b)


def packed(pairs: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted pairs and how often each is there, in few bytes."""
    columns = np.diff(pairs >> 32, prepend=0), pairs & 0xFFFFFFFF, times
    # Bytes of the same weight together: the upper ones are zeros.
    return zstandard.compress(b"".join([c.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for c in columns]), 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not data:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    flat = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(3, 4, -1)
    a, b, times = (np.ascontiguousarray(c.T).view("<u4").ravel().astype(np.int64) for c in flat)
    return np.cumsum(a) << 32 | b, times


def write_alignments(docs: DataFrame, path: str, a: str, b: str) -> DataFrame:
    """A row for each of ``docs(doc_id, text)``: its counts, its groups' hash, its packed links."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, row = aligner(a, b), TaskContext.get().partitionId() << 40
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        names = [field.split()[0] for field in DOCUMENT.split(", ")]
        for batch, texts in text_blocks(batches):
            columns = zip(*own.rows(_texts(texts)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + len(texts))),
                    batch.column(batch.schema.get_field_index("doc_id")),
                    *(pa.array(c, kind) for c, kind in zip(columns, kinds)),
                ],
                names=names,
            )
            row += len(texts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows.mapInArrow(align, DOCUMENT).write.mode("error").parquet(path)
    return docs.sparkSession.read.parquet(path)


def pair_counts(alignments: DataFrame) -> DataFrame:
    """``pair, n``: in how many documents ids are linked; ``pair`` holds A's id above B's, 32 bits each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size, pairs, counts = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)

        def merged() -> tuple[np.ndarray, np.ndarray]:
            every = np.concatenate([pairs, *held])
            weights = np.concatenate([counts, np.ones(len(every) - len(counts), np.int64)])
            order = np.argsort(every, kind="stable")
            every = every[order]
            first = np.flatnonzero(np.diff(every, prepend=-1))
            return every[first], np.add.reduceat(weights[order], first) if len(first) else weights[:0]

        def handed(pairs: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])

        for batch in batches:
            for data in batch.column(0).to_pylist():
                own = unpacked(data)[0]
                held.append(own)
                size += len(own)
                if size >= COUNTED:
                    pairs, counts = merged()
                    held, size = [], 0
                    if len(pairs) >= COUNTED:
                        yield handed(pairs, counts)
                        pairs, counts = pairs[:0], counts[:0]
        if held or len(pairs):
            yield handed(*merged())

    parts = alignments.where("n_links > 0").select("links").mapInArrow(count, "pair long, n long")
    return parts.groupBy("pair").agg(F.sum("n").alias("n"))


def _sent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Pairs with the highest counts, sorted, with their counts; and the count from which on all are there."""
    # Counts by their magnitude: a few hundred rows at most.
    level = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    room, least = most, None
    levels = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("pairs"), F.min("n").alias("least"))
    for row in levels.orderBy(F.desc("level")).collect():
        room -= row["pairs"]
        if room < 0:
            break
        least = row["least"]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    # At most ``most`` rows of two numbers.
    head = counts.where(F.col("n") >= least).toArrow()
    pairs, n = (head.column(c).to_numpy() for c in ("pair", "n"))
    order = np.argsort(pairs)
    return pairs[order], n[order], least


def align_documents(
    docs: DataFrame, a: str | None = None, b: str | None = None, sent_pairs: int = SENT_PAIRS
) -> DataFrame:
    """Counts of tokens, groups and links of ``docs(doc_id, text)``, and how common its links are.

    ``n_best`` counts the links that are the most common of their A id,
    ``count_sum`` adds up in how many documents each link is.
    """
    spark = docs.sparkSession
    a, b = a or tokenizer_path(), b or tokenizer_path(PIECES)
    alignments = write_alignments(docs, run_folder(spark, "alignments"), a, b)
    path = run_folder(spark, "pairs")
    pair_counts(alignments).write.parquet(path)
    counts = spark.read.parquet(path)
    # A row for each id of tokenizer A at most.
    best = counts.groupBy(F.shiftrightunsigned("pair", 32).alias("a")).agg(F.max("n").alias("best"))
    found = best.toArrow()
    most = np.zeros(int(max(found.column("a").to_pylist(), default=0)) + 1, np.int64)
    most[found.column("a").to_numpy()] = found.column("best").to_numpy()
    head_pairs, head_counts, _ = _sent(counts, sent_pairs)
    sent = spark.sparkContext.broadcast((head_pairs, head_counts, most))

    def judged(data: bytes) -> tuple[int, int, np.ndarray, np.ndarray]:
        """Best links, sum of counts, and the pairs whose counts are not here."""
        pairs, times = unpacked(data)
        known, n, best_of = sent.value
        at = np.minimum(np.searchsorted(known, pairs), max(0, len(known) - 1))
        here = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
        own, often = n[at[here]], times[here]
        is_best = own == best_of[pairs[here] >> 32]
        return int(often[is_best].sum()), int((own * often).sum()), pairs[~here], times[~here]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judged(data)[:2] for data in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1))],
                names=[*batch.schema.names[:-1], "n_best", "count_sum"],
            )

    def rarer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [judged(data)[2:] for data in batch.column(1).to_pylist()]
            rows = np.repeat(batch.column(0).to_numpy(), [len(p) for p, _ in parts])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows),
                    pa.array(np.concatenate([p for p, _ in parts]) if parts else np.zeros(0, np.int64)),
                    pa.array(np.concatenate([t for _, t in parts]) if parts else np.zeros(0, np.int64)),
                ],
                names=["row", "pair", "times"],
            )

    plain = DOCUMENT.removesuffix(", links binary")
    scored = alignments.mapInArrow(score, plain + ", n_best long, count_sum long")
    # No rare pair is in more documents than each of those sent, so none is hot.
    rest = alignments.select("row", "links").mapInArrow(rarer, "row long, pair long, times long").join(counts, "pair")
    # The best of each A id once more, a row for each at most.
    rest = rest.join(F.broadcast(best), F.shiftrightunsigned("pair", 32) == F.col("a"))
    more = rest.groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("n") * F.col("times")).alias("more_sum"),
    )
    added = lambda c, extra: (F.col(c) + F.coalesce(extra, F.lit(0))).cast("long").alias(c)
    return scored.join(more, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        added("n_best", F.col("more_best")),
        added("count_sum", F.col("more_sum")),
        "groups_sha256",
    )
