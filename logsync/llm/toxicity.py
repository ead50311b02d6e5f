"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the hashes of its distinct words, of their first letters
as stems, of neighbouring word pairs and triples, and of pairs with one word
between them. Training walks over
a bounded sample of labelled rows; every coordinate has its own learning rate,
and L1 sets those without evidence to exactly zero. The few weights left are
sent to the executors, which score whole texts in Arrow batches without any
shuffle.

Defined results: null and empty texts have no features and score the bias;
without a single labelled row every score is 0; labels that are null, or belong
to a null id, are not used, and of several labels of an id the largest counts.
Labels go by id alone, so rows that share an id share its label. Repeated rows
score alike, and other columns pass through unless their names are those of the
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsync.llm.text import hash_bound, CACHED_WORDS, PLAIN, combined, text_blocks

# Labelled rows that training reads, about: a fixed bound, whatever the corpus.
TRAIN_ROWS = 8_000
BUCKETS = 1 << 20
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 15.0, 1.0
# Bytes of a word that serve as its stem.
STEMS = (4, 5, 6)
RESULT = ("score", "predicted")

_SALTS = (0, 0x51ED270B, 0x2545F491, 0x6C62272E, 0x1B873593, 0x38B34AE5, 0x7FEB352D)


class Model(NamedTuple):
    """Weights other than zero, in ascending order of their bucket."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float
    rows: int

    def dense(self) -> np.ndarray:
        out = np.zeros(BUCKETS, np.float32)
        out[self.buckets] = self.weights
        return out


class Stems(dict):
    """The hashes of words and of their stems, kept for the next time."""

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        hashes = tuple(xxhash.xxh3_64_intdigest(word[:n]) for n in (len(word), *STEMS))
        self[word] = hashes
        return hashes

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHED_WORDS:
            self.clear()
        found = np.array([*map(self.__getitem__, words)], np.uint64)
        return found.reshape(len(words), len(STEMS) + 1).T


def features(text: bytes | None, stems: Stems) -> np.ndarray:
    """Distinct buckets of a text's words, stems, pairs, triples and skip-grams."""
    words, *short = stems.of((text or b"").translate(PLAIN).split())
    grams = (words, *short, combined(words, 2), combined(words, 3), combined(words, 2, 2))
    mixed = [(g ^ np.uint64(s)) % np.uint64(BUCKETS) for g, s in zip(grams, _SALTS)]
    return np.unique(np.concatenate(mixed).astype(np.int32))


class Ftrl:
    """Follow the regularised leader, proximal form, with 0/1 features."""

    def __init__(self) -> None:
        # The last coordinate is the bias, which L1 leaves alone.
        self.z = np.zeros(BUCKETS + 1, np.float32)
        self.n = np.zeros(BUCKETS + 1, np.float32)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1 * (at < BUCKETS), 0)
        return -shrunk / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)

    def learn(self, at: np.ndarray, label: int) -> None:
        at = np.append(at, BUCKETS)
        w = self.weights(at)
        gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        step = (np.sqrt(n + gradient * gradient) - np.sqrt(n)) / ALPHA
        self.z[at] += gradient - step * w
        self.n[at] = n + gradient * gradient


def trained(examples: list[tuple[bytes | None, int]]) -> Model:
    """Walks over the examples a few times, each time in the same shuffled order."""
    stems = Stems()
    rows = [(features(text, stems), label) for text, label in examples]
    ftrl = Ftrl()
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            ftrl.learn(*rows[i])
    every = np.arange(BUCKETS)
    weights = ftrl.weights(every)
    kept = np.flatnonzero(weights)
    bias = float(ftrl.weights(np.array([BUCKETS]))[0])
    return Model(kept, weights[kept].astype(np.float32), bias, len(rows))


_MODEL = T.StructType(
    [
        T.StructField("buckets", T.ArrayType(T.LongType())),
        T.StructField("weights", T.ArrayType(T.FloatType())),
        T.StructField("bias", T.DoubleType()),
        T.StructField("rows", T.LongType()),
    ]
)


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    examples: list[tuple[bytes | None, int]] = []
    for batch, texts in text_blocks(batches):
        examples += zip(texts, batch.column("label").to_pylist())
    model = trained(examples)
    yield pa.RecordBatch.from_pydict(
        {
            "buckets": pa.array([model.buckets], pa.list_(pa.int64())),
            "weights": pa.array([model.weights], pa.list_(pa.float32())),
            "bias": pa.array([model.bias]),
            "rows": pa.array([model.rows], pa.int64()),
        }
    )


def train_toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """A model from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``.

    All labels are read; where there are more than ``train_rows``, ids whose
    hash is low enough to leave about so many are taken, with those texts only.
    """
    truth = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
    truth = truth.agg(F.max("toxic").cast("int").alias("label"))
    bound = hash_bound(train_rows / max(1, train_rows, truth.count()))
    # At most about train_rows rows of two numbers.
    chosen = F.broadcast(truth.where(F.xxhash64("doc_id") <= F.lit(bound).cast("long")))
    sample = docs.select("doc_id", "text").join(chosen, "doc_id")
    one = sample.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "text")
    rows = one.mapInArrow(_train, _MODEL).collect()
    if not rows or not rows[0]["rows"]:
        return Model(np.zeros(0, np.int64), np.zeros(0, np.float32), -np.inf, 0)
    found = rows[0]
    return Model(np.array(found["buckets"], np.int64), np.array(found["weights"], np.float32), found["bias"], found["rows"])


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    # At most BUCKETS weights, 12 bytes each; L1 leaves far fewer.
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rest = docs.drop(*(c for c in RESULT if c in docs.columns))
    schema = T.StructType([*rest.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense, bias, stems = sent.value.dense(), sent.value.bias, Stems()
        for batch, texts in text_blocks(batches):
            margins = np.array([bias + dense[features(t, stems)].sum() for t in texts], np.float64)
            scores = 1 / (1 + np.exp(-np.clip(margins, -700, 700)))
            if not sent.value.rows:
                scores = np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                names=[*batch.schema.names, "score", "predicted"],
            )

    return rest.mapInArrow(judge, schema)
