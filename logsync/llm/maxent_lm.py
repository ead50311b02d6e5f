"""Language model scores: hashed maximum entropy with a class-factored softmax.

Words are counted over all documents first. The most frequent words of the
training documents, a bounded number, stand for themselves and are dealt to
classes by rank; every other word is one of the rare classes, by its last bytes.
A token's probability is that of its class, times that of the word within its
class: for frequent words a second softmax, for the others the smoothed count
among the words of that rare class, where one more word stands for all unknown.

Both softmaxes add up weights of what stands before. For the class: single words
at a distance of one to four, which share their weights (skip features), and the
last two words together; for the word in its class: the last word, and the last
two. Features are hashed to rows of two tables, one row giving the
weights of all outcomes at once. All training documents
are trained on where they lie: each task goes over its documents in small
batches, changes its copy of the weights by their gradients, and hands on what
it changed; the changes of a row are averaged by how often each task met it.

Scoring goes over whole texts in sparse batches. Counts of words too rare to be
sent to every worker are joined afterwards; as a word counts as rare by all
documents, trained on or not, none of them is hot.

Defined results: a null or empty text is its end token alone. Documents without
an id teach nothing, and ``held_out`` is null for them. Repeated rows are each
counted and scored. Without a training document every base score is 0, and all
classes are alike. Words beyond ``LONGEST`` bytes are told apart by a 128-bit
digest. Other columns are not carried.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsync.llm.text import text_blocks
from logsync.session import run_folder

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# Words have no white space in them: the end of a text, and the digest of a long word, do.
END, DIGEST = b"\n", b"\t"
LONGEST = 32
# Words that workers know by themselves, and those of them that the model tells apart.
DICTIONARY = 1 << 18
CLASSES, WIDTH = 32, 64
HEAD = CLASSES * WIDTH
RARE, TAIL_BYTES = 32, 3
# The model tells words of up to so many bytes apart.
HEAD_BYTES = 15
OUTCOMES = CLASSES + RARE
# Rows of hashed features of the class and of the word within its class; powers of two.
CLASS_ROWS, WORD_ROWS = 1 << 15, 1 << 15
KEYS = CLASS_ROWS + WORD_ROWS + 1 + CLASSES
BEFORE = 4
BATCH = 16384
RATE, ROUNDS = 1.2, 1
# Words that a task counts before it hands them on.
COUNTED = 500_000
_NEVER = -1e9
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.uint64(0xBF58476D1CE4E5B9)
_SPREAD = 2_654_435_761
_LN10 = math.log(10)
_SPACE = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(LOWER).split()


def key_of(word: bytes) -> bytes:
    """The word, or its digest; both end alike."""
    return word if len(word) <= LONGEST else DIGEST + xxhash.xxh3_128_digest(word) + word[-TAIL_BYTES:]


def _spread(ending):
    """The rare class of an ending, as a number or as a column; in longs."""
    mixed = (ending * _SPREAD) % (1 << 32)
    if isinstance(mixed, Column):
        return F.shiftright(mixed.cast("long"), 16) % RARE
    return (mixed >> 16) % RARE


def rare_class(key: bytes) -> int:
    return _spread(int.from_bytes(key[-TAIL_BYTES:], "big"))


def word_counts(docs: DataFrame, learn: Column) -> DataFrame:
    """``word, trained, n``: how often each word is in training documents, and in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: tuple[Counter, Counter] = Counter(), Counter()

        def handed() -> pa.RecordBatch:
            trained, rest = own
            words = [*trained, *(w for w in rest if w not in trained)]
            learned = np.array([trained[w] for w in words], np.int64)
            others = np.array([rest[w] for w in words], np.int64)
            keys = pa.array([key_of(w) for w in words], pa.binary())
            trained.clear(), rest.clear()
            return pa.RecordBatch.from_arrays(
                [keys, pa.array(learned), pa.array(learned + others)], names=["word", "trained", "n"]
            )

        for batch, texts in text_blocks(batches):
            for text, taught in zip(texts, batch.column(0).to_pylist()):
                counter = own[0] if taught else own[1]
                counter.update(words_of(text))
                counter[END] += 1
            if len(own[0]) + len(own[1]) > COUNTED:
                yield handed()
        yield handed()

    rows = docs.select(F.coalesce(learn, F.lit(False)).alias("learn"), "text")
    parts = rows.mapInArrow(count, "word binary, trained long, n long")
    return parts.groupBy("word").agg(F.sum("trained").alias("trained"), F.sum("n").alias("n"))


class Vocabulary(NamedTuple):
    """What workers know of the words: those of the dictionary, the model's first, by rank."""

    words: list[bytes]
    trained: np.ndarray
    head: int
    tokens: int  # in training documents
    distinct: int
    rare_tokens: np.ndarray  # of each rare class
    rare_distinct: np.ndarray
    least: int  # words met so often in all documents are in the dictionary

    @property
    def unit(self) -> float:
        """The logarithm that a token's smoothed count is compared with."""
        return math.log10(self.tokens + 0.5 * (self.distinct + 1))

    def rare_logs(self) -> np.ndarray:
        return np.log(self.rare_tokens + 0.5 * (self.rare_distinct + 1))


def fit_vocabulary(counts: DataFrame, dictionary: int = DICTIONARY) -> Vocabulary:
    """The words met most in all documents, and what the others add up to."""
    # Counts by their magnitude: a few hundred rows at most.
    level = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    levels = counts.groupBy(level.alias("level")).agg(
        F.count(F.lit(1)).alias("words"), F.min("n").alias("least")
    )
    room, least = dictionary, 1 << 62
    for row in levels.orderBy(F.desc("level")).collect():
        room -= row["words"]
        if room < 0:
            break
        least = row["least"]
    # At most ``dictionary`` words of ``LONGEST`` bytes.
    known = counts.where(F.col("n") >= least).select("word", "trained").toArrow().to_pydict()
    ranked = sorted(zip(known["word"], known["trained"]), key=lambda p: (len(p[0]) > HEAD_BYTES, -p[1], p[0]))
    words, trained = [w for w, _ in ranked], np.array([n for _, n in ranked], np.int64)
    head = min(HEAD, sum(n > 0 and len(w) <= HEAD_BYTES for w, n in ranked))
    tokens, distinct = np.zeros(RARE, np.int64), np.zeros(RARE, np.int64)
    taught = counts.where("trained > 0")
    ending = F.conv(F.hex(F.substring("word", -TAIL_BYTES, TAIL_BYTES)), 16, 10).cast("long")
    ending = _spread(ending).alias("class")
    rest = taught.where(F.col("n") < least).groupBy(ending)
    for row in rest.agg(F.sum("trained").alias("tokens"), F.count(F.lit(1)).alias("words")).collect():
        tokens[row["class"]], distinct[row["class"]] = row["tokens"], row["words"]
    for word, n in ranked[head:]:
        if n:
            tokens[rare_class(word)] += n
            distinct[rare_class(word)] += 1
    n_tokens = int(tokens.sum() + trained[:head].sum())
    return Vocabulary(words, trained, head, n_tokens, int(distinct.sum()) + head, tokens, distinct, least)


class Indexes(dict):
    """Places of words in the dictionary; -1 where they are not in it."""

    def __missing__(self, word: bytes) -> int:
        return self.get(key_of(word), -1) if len(word) > LONGEST else -1


def _packed(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words as two numbers: size and first seven bytes, and last eight; words of ``HEAD_BYTES`` differ."""
    first = np.minimum(sizes, 255).astype(np.uint64) << np.uint64(56)
    last = np.zeros(len(starts), np.uint64)
    ends = starts + sizes
    for k in range(7):
        own = data[np.minimum(starts + k, len(data) - 1)].astype(np.uint64)
        first |= np.where(sizes > k, own, np.uint64(0)) << np.uint64(8 * k)
    for k in range(1, HEAD_BYTES - 6):
        own = data[ends - np.minimum(k, sizes)].astype(np.uint64)
        last = last << np.uint64(8) | np.where(sizes >= k, own, np.uint64(0))
    return first, last


class Reader:
    """Texts as ids of the model: frequent words, then rare classes, then what stands before a text."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.indexes = Indexes({w: i for i, w in enumerate(vocabulary.words)})
        self.end = self.indexes[END]
        self.end_id = self.end if 0 <= self.end < vocabulary.head else HEAD + rare_class(END)
        self.before = HEAD + RARE
        # The model's words in the order of a mix of their two numbers.
        words = vocabulary.words[: vocabulary.head]
        sizes = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        first, last = _packed(data, np.cumsum(sizes) - sizes, sizes)
        mixed = _hash(np.uint64(6), first, last)
        self.order = np.argsort(mixed)
        self.mixed, self.first, self.last = mixed[self.order], first[self.order], last[self.order]

    def read(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, Callable[[], list[bytes]]]:
        """Ids of all tokens, the number of tokens of each text, and in turn the words that are no ids, on demand."""
        low = [(text or b"").translate(LOWER) for text in texts]
        whole = b"\n".join([b"", *low, b""])
        data = np.frombuffer(whole, np.uint8)
        space = _SPACE[data]
        starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
        sizes = ends - starts
        first, last = _packed(data, starts, sizes)
        ids = np.empty(len(starts), np.int64)
        known = np.zeros(len(starts), bool)
        if len(self.order):
            mixed = _hash(np.uint64(6), first, last)
            place = np.minimum(np.searchsorted(self.mixed, mixed), len(self.order) - 1)
            known = (self.first[place] == first) & (self.last[place] == last) & (sizes <= HEAD_BYTES)
            ids = self.order[place]
        rare = np.flatnonzero(~known)
        # The last bytes as one number, the last of them lowest.
        ending = np.zeros(len(rare), np.int64)
        for k in range(TAIL_BYTES):
            own = data[np.maximum(ends[rare] - 1 - k, 0)].astype(np.int64)
            ending |= np.where(sizes[rare] > k, own, 0) << 8 * k
        ids[rare] = HEAD + _spread(ending)
        # After each text its end.
        bounds = np.cumsum([len(t) + 1 for t in low]) + 1 if low else np.zeros(0, np.int64)
        counts = np.diff(np.searchsorted(starts, bounds), prepend=0) + 1
        every = np.full(len(ids) + len(low), self.end_id, np.int64)
        moved = np.arange(len(ids)) + np.repeat(np.arange(len(low)), counts - 1)
        every[moved] = ids
        return every, counts, lambda: [whole[i:j] for i, j in zip(starts[rare].tolist(), ends[rare].tolist())]


class Context(NamedTuple):
    """Tokens to be predicted in a row, and hashes of what stands before each."""

    ids: np.ndarray
    stream: np.ndarray  # all ids, with those before a text
    at: np.ndarray  # places of ``ids`` in it
    hashes: np.ndarray  # of the last word, and of the last two


def context(ids: np.ndarray, sizes: np.ndarray, before: int) -> Context:
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else sizes
    # Each text is moved behind the ids that stand for its beginning.
    at = np.arange(len(ids)) + BEFORE * np.repeat(np.arange(1, len(sizes) + 1), sizes)
    stream = np.full(len(ids) + BEFORE * len(starts), before, np.int64)
    stream[at] = ids
    one, two = (stream[at - k].astype(np.uint64) for k in (1, 2))
    hashes = [
        _hash(np.uint64(1), one),
        _hash(np.uint64(2), one, two),
    ]
    return Context(ids, stream, at, np.stack(hashes))


def _hash(kind: np.uint64, *parts: np.ndarray) -> np.ndarray:
    out = np.full(len(parts[0]), kind, np.uint64)
    for part in parts:
        out = (out ^ part) * _MIX
        out ^= out >> np.uint64(29)
    out *= _FOLD
    return out ^ (out >> np.uint64(32))


class Weights:
    """Rows of both tables, and the weights that need no context."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.classes = np.zeros((CLASS_ROWS, OUTCOMES), np.float32)
        self.words = np.zeros((WORD_ROWS, WIDTH), np.float32)
        own = np.zeros(HEAD, np.int64)
        own[: vocabulary.head] = vocabulary.trained[: vocabulary.head]
        present = np.arange(HEAD) < vocabulary.head
        logs = np.where(present, np.log(own + 0.5), _NEVER)
        of_class = own.reshape(CLASSES, WIDTH).sum(axis=1)
        some = present.reshape(CLASSES, WIDTH).any(axis=1)
        # Without context, classes and words are as frequent as they were counted;
        # what words weigh within a class without context stays as it is.
        classes = np.concatenate([np.where(some, np.log(of_class + 0.5), _NEVER), np.log(vocabulary.rare_tokens + 0.5)])
        self.class_bias = (classes - classes.max()).astype(np.float32)[None]
        words = logs.reshape(CLASSES, WIDTH)
        self.word_bias = (words - words.max(axis=1, keepdims=True)).astype(np.float32)

    def tables(self) -> list[np.ndarray]:
        """In the order of the keys by which rows are handed on."""
        return [self.classes, self.words, self.class_bias, self.word_bias]


# Of what stands before a token, single words at any near distance.
_NEAR = np.uint64(4)


def _odds(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Odds of the outcomes, in place of their logits, and the sums of each row."""
    # Biases are logarithms of shares, so only weights gone astray come near this.
    np.minimum(logits, 80, out=logits)
    np.exp(logits, out=logits)
    return logits, logits @ np.ones(logits.shape[1], np.float32)


class Model:
    """Probabilities of tokens in a row, and changes of the weights by their gradients."""

    def __init__(self, weights: Weights) -> None:
        self.weights = weights

    def _class_rows(self, part: Context, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the features of tokens ``low`` to ``high``, and those of the ids around them."""
        rows = (part.hashes[1:, low:high] & np.uint64(CLASS_ROWS - 1)).astype(np.int64)
        first, last = part.at[low] - BEFORE, part.at[high - 1]
        near = _hash(_NEAR, part.stream[first:last].astype(np.uint64)) & np.uint64(CLASS_ROWS - 1)
        return rows, near.astype(np.int64)

    def class_odds(self, part: Context, low: int, high: int) -> tuple[np.ndarray, ...]:
        """Odds of the classes and their sums, and the rows that they come from."""
        table = self.weights.classes
        rows, near = self._class_rows(part, low, high)
        each = table[near]
        place = part.at[low:high] - part.at[low]
        # The token at a place has the words of the places before it.
        sums = each[: len(each) - BEFORE + 1].copy() if len(each) >= BEFORE else each[:0].copy()
        for k in range(1, BEFORE):
            sums += each[k : len(each) - BEFORE + 1 + k]
        logits = sums[place]
        logits += self.weights.class_bias
        for own in rows:
            logits += table[own]
        return *_odds(logits), rows, near

    def _word_rows(self, part: Context, low: int, chosen: np.ndarray, of_class: np.ndarray) -> np.ndarray:
        mixed = part.hashes[:, low + chosen] ^ (of_class.astype(np.uint64) + np.uint64(1)) * _FOLD
        return (mixed * _MIX >> np.uint64(20) & np.uint64(WORD_ROWS - 1)).astype(np.int64)

    def word_odds(self, rows: np.ndarray, of_class: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        logits = self.weights.word_bias[of_class]
        for own in rows:
            logits += self.weights.words[own]
        return _odds(logits)

    def logs(self, part: Context) -> np.ndarray:
        """Natural logarithm of each token's probability; of rare words, of their class."""
        out = np.zeros(len(part.ids))
        for low in range(0, len(out), BATCH):
            high = min(low + BATCH, len(out))
            ids = part.ids[low:high]
            of_class = np.where(ids < HEAD, ids // WIDTH, ids - HEAD + CLASSES)
            odds, sums, *_ = self.class_odds(part, low, high)
            shares = odds[np.arange(len(ids)), of_class] / sums
            chosen = np.flatnonzero(ids < HEAD)
            if len(chosen):
                classes = of_class[chosen]
                odds, sums = self.word_odds(self._word_rows(part, low, chosen, classes), classes)
                shares = shares.astype(np.float64)
                shares[chosen] *= odds[np.arange(len(chosen)), ids[chosen] % WIDTH] / sums
            out[low:high] = np.log(np.maximum(shares, 1e-60))
        return out


def _by_row(rows: np.ndarray, gradients: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows once each, how often they were given, and the sums of their gradients."""
    # Rows are few enough for two bytes, which sort by counting.
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    ordered = rows[order]
    first = np.flatnonzero(np.diff(ordered, prepend=-1))
    times = np.diff(first, append=len(rows))
    out = gradients[order[first]]
    # What a row has beyond its first gradient is added in pairs until one is left.
    open_rows = np.flatnonzero(times > 1)
    left = times[open_rows] - 1
    at = order[np.delete(np.arange(len(order)), first)]
    sums = gradients
    while len(open_rows):
        halves = (left + 1) >> 1
        begin = np.cumsum(left) - left
        ends = np.cumsum(halves)
        place = np.arange(ends[-1]) - np.repeat(ends - halves, halves)
        own = np.repeat(begin, halves) + 2 * place
        paired = np.flatnonzero(2 * place + 1 < np.repeat(left, halves))
        after = sums[at[own]]
        after[paired] += sums[at[own[paired] + 1]]
        done = halves == 1
        out[open_rows[done]] += after[(ends - 1)[done]]
        sums, at = after, np.flatnonzero(np.repeat(~done, halves))
        open_rows, left = open_rows[~done], halves[~done]
    return ordered[first], times, out


class Trainer(Model):
    """Steps per row that shrink with the squared gradients it has had."""

    def __init__(self, weights: Weights) -> None:
        super().__init__(weights)
        self.squares = [np.full(len(t), 1e-2, np.float32) for t in weights.tables()]
        self.met = [np.zeros(len(t), np.int64) for t in weights.tables()]

    def _change(self, table: int, rows: np.ndarray, gradients: np.ndarray) -> None:
        every, times, sums = _by_row(rows, gradients)
        self.met[table][every] += times
        self.squares[table][every] += np.einsum("ij,ij->i", sums, sums)
        sums *= (RATE / np.sqrt(self.squares[table][every]))[:, None]
        self.weights.tables()[table][every] -= sums

    def learn(self, part: Context) -> None:
        for low in range(0, len(part.ids), BATCH):
            self._learn(part, low, min(low + BATCH, len(part.ids)))

    def _learn(self, part: Context, low: int, high: int) -> None:
        ids = part.ids[low:high]
        n = len(ids)
        of_class = np.where(ids < HEAD, ids // WIDTH, ids - HEAD + CLASSES)
        gradients, sums, rows, near = self.class_odds(part, low, high)
        gradients /= sums[:, None]
        gradients[np.arange(n), of_class] -= 1
        chosen = np.flatnonzero(ids < HEAD)
        if len(chosen):
            classes = of_class[chosen]
            word_rows = self._word_rows(part, low, chosen, classes)
            own, sums = self.word_odds(word_rows, classes)
            own /= sums[:, None]
            own[np.arange(len(chosen)), ids[chosen] % WIDTH] -= 1
            for feature in word_rows:
                self._change(1, feature, own)
        for feature in rows:
            self._change(0, feature, gradients)
        # A word has its share in all tokens that it stands before.
        along = np.zeros((len(near) + BEFORE - 1, OUTCOMES), np.float32)
        along[part.at[low:high] - part.at[low] + BEFORE - 1] = gradients
        spread = along[: len(near)].copy()
        for k in range(1, BEFORE):
            spread += along[k : len(near) + k]
        self._change(0, near, spread)
        self._change(2, np.zeros(1, np.int64), gradients.sum(axis=0, keepdims=True))

    def changes(self, start: Weights) -> Iterator[pa.RecordBatch]:
        """Rows met: key, how often, and by how much they changed."""
        key = 0
        for table, old, met in zip(self.weights.tables(), start.tables(), self.met):
            every = np.flatnonzero(met)
            for low in range(0, len(every), 4096):
                own = every[low : low + 4096]
                # Differences of impossible outcomes are nothing.
                changed = (table[own] - old[own]).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((key + own).astype(np.int32)),
                        pa.array(met[own]),
                        pa.array([row.tobytes() for row in changed]),
                    ],
                    names=["key", "met", "change"],
                )
            key += len(table)


def _copied(weights: Weights) -> Weights:
    out = object.__new__(Weights)
    for name in ("classes", "words", "class_bias", "word_bias"):
        setattr(out, name, getattr(weights, name).copy())
    return out


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Changes of a row, weighted by how often it was met; tasks hold a share of the rows."""
    # Tables by the width of their rows, each with room for every key.
    sums: dict[int, np.ndarray] = {}
    met = np.zeros(KEYS, np.int64)
    for batch in batches:
        keys, times = (batch.column(i).to_numpy() for i in (0, 1))
        changes = batch.column(2).to_pylist()
        np.add.at(met, keys, times)
        sizes = np.array([len(c) for c in changes])
        for size in np.unique(sizes):
            chosen = np.flatnonzero(sizes == size)
            own = np.frombuffer(b"".join([changes[i] for i in chosen]), np.float16).reshape(len(chosen), -1)
            table = sums.setdefault(int(size), np.zeros((KEYS, own.shape[1]), np.float32))
            np.add.at(table, keys[chosen], own.astype(np.float32) * times[chosen, None].astype(np.float32))
    for table in sums.values():
        every = np.flatnonzero((met > 0) & table.any(axis=1))
        means = table[every] / met[every, None].astype(np.float32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(every.astype(np.int32)),
                pa.array(met[every]),
                pa.array([row.tobytes() for row in means], pa.binary()),
            ],
            names=["key", "met", "change"],
        )


def fit_weights(docs: DataFrame, learn: Column, vocabulary: Vocabulary, rounds: int = ROUNDS) -> Weights:
    """Weights from all training documents, changed where they lie, averaged after each round."""
    spark, weights = docs.sparkSession, Weights(vocabulary)
    taught = docs.where(learn).select("text")
    schema = "key int, met long, change binary"
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast((vocabulary, weights))

        def train(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            words, start = sent.value
            reader, trainer = Reader(words), Trainer(_copied(start))
            for _, texts in text_blocks(batches):
                ids, sizes, _ = reader.read(texts)
                trainer.learn(context(ids, sizes, reader.before))
            yield from trainer.changes(start)

        changes = taught.mapInArrow(train, schema)
        parts = spark.conf.get("spark.sql.shuffle.partitions")
        merged = changes.repartition(int(parts), "key").mapInArrow(_averaged, schema)
        weights = _copied(weights)
        firsts = np.cumsum([0, *(len(t) for t in weights.tables())])
        # At most a row for each key, whatever the corpus.
        found = merged.toArrow()
        for key, change in zip(found.column("key").to_pylist(), found.column("change").to_pylist()):
            table = int(np.searchsorted(firsts, key, "right")) - 1
            weights.tables()[table][key - firsts[table]] += np.frombuffer(change, np.float32)
    return weights


SCORED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, "
    "rare array<struct<word: binary, times: int>>"
)


def score_documents(docs: DataFrame, held_out: Column, vocabulary: Vocabulary, weights: Weights) -> DataFrame:
    """Each document by itself: what the dictionary and the model say, and the words that it does not know."""
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary, weights))
    kinds = [pa.int64()] * 2 + [pa.bool_()] + [pa.int64()] * 2 + [pa.float64()] * 2

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights = sent.value
        reader, model = Reader(vocabulary), Model(weights)
        logs = np.append(np.log10(vocabulary.trained + 0.5), 0.0)
        known = np.append(vocabulary.trained > 0, False)
        rare_logs, row = vocabulary.rare_logs(), TaskContext.get().partitionId() << 40
        for batch, texts in text_blocks(batches):
            ids, sizes, rest = reader.read(texts)
            words = rest()
            starts = np.cumsum(sizes) - sizes
            added = lambda x: np.add.reduceat(x, starts)
            natural = model.logs(context(ids, sizes, reader.before))
            is_rare = ids >= HEAD
            # Places in the dictionary: a frequent word's id, a rare one's by itself.
            is_end = np.zeros(len(ids), bool)
            is_end[starts + sizes - 1] = True
            at = ids.copy()
            at[is_end] = reader.end
            own = np.fromiter(map(reader.indexes.__getitem__, words), np.int64, len(words))
            word_at = np.flatnonzero(is_rare & ~is_end)
            at[word_at] = own
            natural[is_rare] -= rare_logs[ids[is_rare] - HEAD]
            # A rare word's smoothed count is over that of its class.
            counted = logs[at]
            decimal = natural / _LN10 + np.where(is_rare, counted, 0.0)
            # Words that the dictionary lacks, text by text.
            times = [Counter() for _ in texts]
            lacking = np.flatnonzero(own < 0)
            for text, i in zip(np.searchsorted(starts, word_at[lacking], "right") - 1, lacking.tolist()):
                times[text][key_of(words[i])] += 1
            if reader.end < 0:
                for counter in times:
                    counter[END] += 1
            ends = np.cumsum([0, *map(len, times)])
            pairs = pa.StructArray.from_arrays(
                [
                    pa.array([w for own in times for w in own], pa.binary()),
                    pa.array([n for own in times for n in own.values()], pa.int32()),
                ],
                names=["word", "times"],
            )
            columns = [
                np.arange(row, row + len(texts)),
                batch.column(batch.schema.get_field_index("doc_id")),
                batch.column(batch.schema.get_field_index("held_out")),
                sizes,
                added(known[at].astype(np.int64)),
                added(counted),
                added(decimal),
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(c, kind) if isinstance(c, np.ndarray) else c for c, kind in zip(columns, kinds)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs),
                ],
                names=[field.strip().split()[0] for field in SCORED.split(", ", 7)],
            )
            row += len(texts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    return rows.mapInArrow(score, SCORED)


def score_language_model(
    docs: DataFrame,
    held_out: Column,
    dictionary: int = DICTIONARY,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Scores of all ``docs(doc_id, text)`` by a model of those that are not held out.

    ``score`` is the model's log10 probability of the text and its end,
    ``base_score`` that of smoothed counts of single words.
    """
    spark, learn = docs.sparkSession, ~held_out
    path = run_folder(spark, "words")
    word_counts(docs, learn).write.parquet(path)
    counts = spark.read.parquet(path)
    vocabulary = fit_vocabulary(counts, dictionary)
    weights = fit_weights(docs, learn, vocabulary, rounds)
    path = run_folder(spark, "scored")
    score_documents(docs, held_out, vocabulary, weights).write.parquet(path)
    scored = spark.read.parquet(path)
    rare = scored.select("row", F.explode("rare").alias("rare")).select("row", "rare.word", "rare.times")
    # Words that were never trained on count nothing, so they need not be met here.
    rest = counts.where((F.col("n") < vocabulary.least) & (F.col("trained") > 0)).select("word", "trained")
    more = rare.join(rest, "word").groupBy("row").agg(
        F.sum("times").alias("more_known"),
        F.sum(F.col("times") * (F.log10(F.col("trained") + 0.5) - F.lit(math.log10(0.5)))).alias("more"),
    )
    # Each word that the dictionary lacks counts as never trained on, until met.
    alone = F.aggregate("rare", F.lit(0).cast("long"), lambda n, x: n + x["times"]) * F.lit(math.log10(0.5))
    extra = alone + F.coalesce("more", F.lit(0.0))
    return scored.join(more, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + extra - F.col("n_tokens") * F.lit(vocabulary.unit)).alias("base_score"),
        (F.col("score") + extra).alias("score"),
    )
