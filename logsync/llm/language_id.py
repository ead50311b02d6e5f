"""Language ID: a bidirectional gated recurrent network over bytes, in numpy.

The network reads a word byte by byte in both directions and gives, at every
byte, a probability for each language. Its state begins anew with each word, so
a word met before has its probabilities ready. A document's probabilities are
the mean over all its positions; the largest names the language. It is trained
by backpropagation through time on the words of a bounded sample of texts.

A word here is a run of letters: A-Z in lower case, ASCII punctuation, digits
and white space left out, at most ``LONGEST`` bytes a piece.

Defined results: null and empty texts, and those without a letter, are ``und``
with score 0; so is every text where no language could be learned. Texts with
null labels, or null ids, teach nothing. Repeated rows are judged alike; other
columns pass through unless their names are those of the result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsync.llm.text import hash_bound, text_blocks

# The sample: about so many texts, and so many words of them.
TRAIN_ROWS = 1_600
TRAIN_WORDS = 60_000
LONGEST = 24
HIDDEN, SYMBOLS = 16, 256
BATCH, EPOCHS, RATE = 256, 4, 0.01
CACHED = 100_000
UNKNOWN = "und"
RESULT = ("lang_pred", "score")

LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_LETTER = re.compile(r"[^\W\d_]")


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(LETTERS).split()


def has_letter(text: bytes | None) -> bool:
    return bool(text) and _LETTER.search(text.decode("utf-8", "replace")) is not None


class Network(NamedTuple):
    """Weights of both directions: input table, recurrent matrix, its bias; then the output."""

    tables: np.ndarray  # 2 x SYMBOLS x 3 HIDDEN
    recurrent: np.ndarray  # 2 x HIDDEN x 3 HIDDEN
    bias: np.ndarray  # 2 x 3 HIDDEN, inside the reset product for the candidate
    out: np.ndarray  # 2 HIDDEN x languages
    out_bias: np.ndarray


def fresh(n_languages: int, seed: int = 5) -> Network:
    draw = np.random.default_rng(seed)

    def small(*shape: int) -> np.ndarray:
        return (draw.standard_normal(shape) * 0.3 / np.sqrt(shape[-2] if shape[-2] != SYMBOLS else 1)).astype(np.float32)

    return Network(
        small(2, SYMBOLS, 3 * HIDDEN),
        small(2, HIDDEN, 3 * HIDDEN) * 3,
        np.zeros((2, 3 * HIDDEN), np.float32),
        small(2 * HIDDEN, n_languages) * 3,
        np.zeros(n_languages, np.float32),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(net: Network, d: int, symbols: np.ndarray, kept: list | None = None) -> np.ndarray:
    """Hidden states of one direction, time x rows x HIDDEN."""
    steps, rows = symbols.shape
    h = np.zeros((rows, HIDDEN), np.float32)
    out = np.empty((steps, rows, HIDDEN), np.float32)
    for t in range(steps):
        x = net.tables[d][symbols[t]]
        g = h @ net.recurrent[d] + net.bias[d]
        gates = _sigmoid(x[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        candidate = np.tanh(x[:, 2 * HIDDEN :] + r * g[:, 2 * HIDDEN :])
        if kept is not None:
            kept.append((h, z, r, candidate, g[:, 2 * HIDDEN :]))
        h = (1 - z) * candidate + z * h
        out[t] = h
    return out


def _positions(net: Network, symbols: np.ndarray, kept: tuple[list, list] | None = None):
    """Both directions' states and each position's probabilities; words of one length."""
    ahead = _run(net, 0, symbols, kept and kept[0])
    back = _run(net, 1, symbols[::-1], kept and kept[1])[::-1]
    states = np.concatenate([ahead, back], 2)
    scores = states @ net.out + net.out_bias
    scores -= scores.max(2, keepdims=True)
    odds = np.exp(scores)
    return states, odds / odds.sum(2, keepdims=True)


def _gradients(net: Network, symbols: np.ndarray, labels: np.ndarray) -> Network:
    """Backpropagation through time of the mean cross-entropy over positions."""
    kept: tuple[list, list] = ([], [])
    states, odds = _positions(net, symbols, kept)
    steps, rows = symbols.shape
    d_scores = odds.copy()
    d_scores[:, np.arange(rows), labels] -= 1
    d_scores /= steps * rows
    flat = d_scores.reshape(-1, d_scores.shape[2])
    d_out = states.reshape(-1, 2 * HIDDEN).T @ flat
    d_states = d_scores @ net.out.T
    tables, recurrent, bias = np.zeros_like(net.tables), np.zeros_like(net.recurrent), np.zeros_like(net.bias)
    for d in (0, 1):
        order = symbols if d == 0 else symbols[::-1]
        d_own = d_states[:, :, d * HIDDEN : (d + 1) * HIDDEN]
        d_own = d_own if d == 0 else d_own[::-1]
        d_h = np.zeros((rows, HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1):
            h, z, r, c, inner = kept[d][t]
            d_h = d_h + d_own[t]
            d_c = d_h * (1 - z) * (1 - c * c)
            d_z = d_h * (h - c) * z * (1 - z)
            d_r = d_c * inner * r * (1 - r)
            d_x = np.concatenate([d_z, d_r, d_c], 1)
            d_g = np.concatenate([d_z, d_r, d_c * r], 1)
            np.add.at(tables[d], order[t], d_x)
            recurrent[d] += h.T @ d_g
            bias[d] += d_g.sum(0)
            d_h = d_h * z + d_g @ net.recurrent[d].T
    return Network(tables, recurrent, bias, d_out, flat.sum(0))


def trained(examples: list[tuple[bytes, int]], n_languages: int, epochs: int = EPOCHS) -> Network:
    """Adam over batches of words of one length, in a fixed shuffled order."""
    net = fresh(n_languages)
    by_size: dict[int, list[int]] = {}
    for i, (word, _) in enumerate(examples):
        by_size.setdefault(len(word), []).append(i)
    labels = np.array([label for _, label in examples], np.int64)
    draw = np.random.default_rng(11)
    first, second, step = [np.zeros_like(w) for w in net], [np.zeros_like(w) for w in net], 0
    for _ in range(epochs):
        batches = []
        for size in sorted(by_size):
            own = draw.permutation(by_size[size])
            batches += [own[at : at + BATCH] for at in range(0, len(own), BATCH)]
        for k in draw.permutation(len(batches)):
            rows = batches[k]
            symbols = np.stack([np.frombuffer(examples[i][0], np.uint8) for i in rows], 1)
            step += 1
            rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for w, g, m, v in zip(net, _gradients(net, symbols, labels[rows]), first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return net


def pieces(word: bytes) -> list[bytes]:
    return [word[at : at + LONGEST] for at in range(0, len(word), LONGEST)]


def word_sums(net: Network, some: list[bytes]) -> np.ndarray:
    """For each piece, a row: the sum of its positions' probabilities, and their number."""
    out = np.empty((len(some), len(net.out_bias) + 1), np.float32)
    sizes = np.fromiter(map(len, some), np.int64, len(some))
    out[:, -1] = sizes
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        for at in range(0, len(own), 4096):
            part = own[at : at + 4096]
            symbols = np.frombuffer(b"".join([some[i] for i in part]), np.uint8).reshape(len(part), size).T
            out[part, :-1] = _positions(net, symbols)[1].sum(0)
    return out


class WordTable:
    """Rows of words met before, in two generations: a full one becomes the older one."""

    def __init__(self, net: Network, room: int = CACHED) -> None:
        self.net, self.room = net, room
        self.place: dict[bytes, int] = {}
        self.rows = np.empty((room, len(net.out_bias) + 1), np.float32)
        self.older_place: dict[bytes, int] = {}
        self.older_rows = self.rows[:0]

    def of(self, some: list[bytes]) -> np.ndarray:
        """The rows of words, one for each."""
        at = [self.place.get(w, -1) for w in some]
        if -1 in at:
            new = list(dict.fromkeys([w for w, i in zip(some, at) if i < 0]))
            if len(self.place) + len(new) > self.room:
                new = list(dict.fromkeys(some))
                if len(new) > self.room:
                    half = len(some) // 2
                    return np.concatenate([self.of(some[:half]), self.of(some[half:])])
                self.older_place, self.older_rows = self.place, self.rows
                self.place, self.rows = {}, np.empty_like(self.rows)
            self._add(new)
            at = [self.place[w] for w in some]
        return self.rows[at]

    def _add(self, new: list[bytes]) -> None:
        begin = len(self.place)
        self.place.update(zip(new, range(begin, begin + len(new))))
        old = np.array([self.older_place.get(w, -1) for w in new])
        self.rows[begin + np.flatnonzero(old >= 0)] = self.older_rows[old[old >= 0]]
        fresh = np.flatnonzero(old < 0)
        parts = [pieces(new[i]) for i in fresh]
        sums = word_sums(self.net, [p for own in parts for p in own])
        counts = np.array([len(own) for own in parts], np.int64)
        if len(counts):
            self.rows[begin + fresh] = np.add.reduceat(sums, np.cumsum(counts) - counts)


class Model(NamedTuple):
    languages: list[str]
    network: Network | None


def train_language_id(docs: DataFrame, allowed: Column, train_rows: int = TRAIN_ROWS) -> Model:
    """A model from the texts and ``lang`` of ``docs`` where ``allowed`` holds.

    About ``train_rows`` texts are taken, as many of each language as there are,
    by the hash of their ids, and of them up to ``TRAIN_WORDS`` words, by an even
    stride over each. Of more than ``train_rows`` languages the most frequent
    ones can be named.
    """
    usable = docs.where(allowed & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(train_rows)
    # At most ``train_rows`` rows; equal parts, of which small languages leave some to the others.
    found = [(r["lang"], r["n"]) for r in counts.collect()]
    left, parts = train_rows, {}
    for k, (lang, n) in enumerate(sorted(found, key=lambda x: x[1])):
        parts[lang] = (min(n, left // (len(found) - k)), n)
        left -= parts[lang][0]
    bounds = [(lang, hash_bound(part / n)) for lang, (part, n) in parts.items()]
    bounds = docs.sparkSession.createDataFrame(bounds, "lang string, bound long")
    sample = usable.join(F.broadcast(bounds), "lang").where(F.xxhash64("doc_id", F.lit("lang")) <= F.col("bound"))
    one = sample.select("doc_id", "text", "lang").repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "text")
    rows = one.mapInArrow(_train, "languages array<string>, weights array<binary>").collect()
    if not rows or not rows[0]["languages"]:
        return Model([], None)
    languages = list(rows[0]["languages"])
    shapes = [w.shape for w in fresh(len(languages))]
    weights = [np.frombuffer(bytes(w), np.float32).reshape(s) for w, s in zip(rows[0]["weights"], shapes)]
    return Model(languages, Network(*weights))


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts: list[tuple[list[bytes], str]] = []
    for batch, found in text_blocks(batches):
        texts += [(words(t), lang) for t, lang in zip(found, batch.column("lang").to_pylist())]
    languages = sorted({lang for own, lang in texts if own})
    number = {lang: i for i, lang in enumerate(languages)}
    most = max(1, TRAIN_WORDS // max(1, len(texts)))
    examples = []
    for own, lang in texts:
        for word in own[:: max(1, -(-len(own) // most))]:
            examples += [(p, number[lang]) for p in pieces(word)]
    weights = [w.tobytes() for w in trained(examples, len(languages))] if languages else []
    yield pa.RecordBatch.from_pydict(
        {
            "languages": pa.array([languages], pa.list_(pa.string())),
            "weights": pa.array([weights], pa.list_(pa.binary())),
        }
    )


def predict_language(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the mean probability of that language."""
    # A network of a few tens of thousands of weights.
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rest = docs.drop(*(c for c in RESULT if c in docs.columns))
    result = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, net = sent.value
        table = WordTable(net) if net else None
        for batch, texts in text_blocks(batches):
            own = [words(t) if table and has_letter(t) else [] for t in texts]
            sizes = np.array([len(some) for some in own], np.int64)
            langs, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            known = np.flatnonzero(sizes)
            if len(known):
                rows = table.of([w for some in own for w in some])
                sums = np.add.reduceat(rows, (np.cumsum(sizes) - sizes)[known], dtype=np.float64)
                best = sums[:, :-1].argmax(1)
                langs[known] = np.array(languages, object)[best]
                scores[known] = sums[np.arange(len(known)), best] / sums[:, -1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(np.clip(scores, 0, 1), pa.float64())],
                names=[*batch.schema.names, *RESULT],
            )

    return rest.mapInArrow(predict, T.StructType([*rest.schema.fields, *result]))
