"""The language model: exact counts, a proper distribution, gradients, and what training gains."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from logsync.llm import maxent_lm as lm
from logsync.llm.queries import QUERIES

END = "END"


def held_out():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1



def brute_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), END]


def is_held_out(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 5 == 1


def brute_base(rows):
    """Each document's tokens, known ones, and sum of logarithms; and the tokens trained on."""
    counts = Counter(w for i, t in rows if is_held_out(i) is False for w in brute_words(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        words = brute_words(text)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        out.append((i, is_held_out(i), len(words), sum(counts[w] > 0 for w in words), n, base))
    return out


def check_base(found, rows):
    key = lambda r: (str(r[0]), r[2], r[3], round(r[5], 6))
    mine = sorted((tuple(r)[:6] for r in found), key=key)
    true = sorted(brute_base(rows), key=key)
    assert [m[:5] for m in mine] == [t[:5] for t in true]
    assert np.allclose([m[5] for m in mine], [t[5] for t in true], rtol=1e-9, atol=1e-9)
    assert all(r["score"] <= 1e-9 and math.isfinite(r["score"]) for r in found)


def test_the_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    out = QUERIES["op12_lm_scoring"](spark, sf_dir)
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    found = out.collect()
    check_base(found, rows)
    # What was learned helps with texts that were not learned from.
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


ODD = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "Word WORD word É é É\x00 \x1c\x1c\x85"), (4, "Word WORD word É é É\x00"),
    (None, "never learned from this"), (None, None), (5, "z" * 40 + " " + "Z" * 40 + " " + "z" * 41),
    *((i, f"one two three {i} four five six " * 5) for i in range(10, 40)),
    *((i, "seen only where held out " * 3) for i in range(40, 80) if is_held_out(i)),
]


@pytest.mark.parametrize("dictionary", [0, 3, 40, lm.DICTIONARY])
def test_odd_texts_whatever_the_dictionary_holds(spark, make_docs, dictionary):
    docs = make_docs(*ODD).withColumns({c: F.lit("x") for c in ("row", "learn", "word", "rare", "score", "n", "base")})
    check_base(lm.score_language_model(docs, held_out(), dictionary).collect(), ODD)


def test_long_texts(spark, make_docs):
    long = " ".join(f"w{i % 1999} and" for i in range(40_000))
    rows = [(6, long), (7, long), (10, "and w1"), (12, "x" * 500_000)]
    check_base(lm.score_language_model(make_docs(*rows), held_out()).collect(), rows)


def test_nothing_to_learn_from(spark, make_docs):
    held = [(i, "some words") for i in range(60) if is_held_out(i)] + [(None, "some")]
    found = lm.score_language_model(make_docs(*held), held_out()).collect()
    assert {(r["base_score"], r["train_tokens"], r["n_known"]) for r in found} == {(0.0, 0, 0)}
    assert all(r["score"] == pytest.approx(-r["n_tokens"] * math.log10(lm.RARE), rel=1e-5) for r in found)
    assert lm.score_language_model(make_docs((1, "x")).where("false"), held_out()).count() == 0


def vocabulary_of(texts, dictionary=10**6):
    counts = Counter(w for t in texts for w in [*lm.words_of(t.encode()), lm.END])
    known = sorted(counts.items(), key=lambda p: (-p[1], p[0]))
    assert all(len(w) <= lm.HEAD_BYTES for w in counts)
    head = min(lm.HEAD, len(known))
    tokens, distinct = np.zeros(lm.RARE, np.int64), np.zeros(lm.RARE, np.int64)
    for word, n in known[head:]:
        tokens[lm.rare_class(word)] += n
        distinct[lm.rare_class(word)] += 1
    n = np.array([n for _, n in known], np.int64)
    return lm.Vocabulary([w for w, _ in known], n, head, int(n.sum()), len(known), tokens, distinct, 0)


CORPUS = [" ".join(f"a{(7 * i + k * k) % 211} b{(k + 131 * i) % 5000}" for k in range(400)) for i in range(30)]


@pytest.fixture(scope="module")
def trained():
    words = vocabulary_of(CORPUS)
    reader, trainer = lm.Reader(words), lm.Trainer(lm.Weights(words))
    ids, sizes, _ = reader.read([t.encode() for t in CORPUS])
    trainer.learn(lm.context(ids, sizes, reader.before))
    return words, reader, trainer


def test_probabilities_of_all_next_words_add_up_to_one(trained):
    words, reader, trainer = trained
    model, rare = lm.Model(trainer.weights), words.rare_logs()
    for before in ([], [3], [3, 5, 1, 0], [lm.HEAD + 2, 9, lm.HEAD + 1]):
        ids = np.array([[*before, x] for x in range(lm.HEAD + lm.RARE)]).ravel()
        sizes = np.full(lm.HEAD + lm.RARE, len(before) + 1)
        logs = model.logs(lm.context(ids, sizes, reader.before))[len(before) :: len(before) + 1]
        total = np.exp(logs[: words.head]).sum()
        for k in range(lm.RARE):
            # The known words of the class, and one for all that are unknown.
            own = [n + 0.5 for w, n in zip(words.words[words.head :], words.trained[words.head :]) if lm.rare_class(w) == k]
            total += np.exp(logs[lm.HEAD + k]) * (sum(own) + 0.5) / np.exp(rare[k])
        assert total == pytest.approx(1, abs=1e-4)
    assert words.head == lm.HEAD and words.rare_distinct.sum() > 0


def test_training_raises_the_probability(trained):
    words, reader, trainer = trained
    ids, sizes, _ = reader.read([t.encode() for t in CORPUS])
    part = lm.context(ids, sizes, reader.before)
    before, after = (lm.Model(w).logs(part).sum() for w in (lm.Weights(words), trainer.weights))
    assert after > before + 0.3 * len(ids)


def test_gradients_are_those_of_the_log_probability():
    words = vocabulary_of(CORPUS[:3])
    reader = lm.Reader(words)
    ids, sizes, _ = reader.read([t.encode() for t in CORPUS[:3]])
    part = lm.context(ids[:60], np.array([25, 35]), reader.before)
    chance = np.random.default_rng(1)
    weights = lm.Weights(words)
    for name in ("classes", "words", "class_bias", "word_bias"):
        old = getattr(weights, name).astype(np.float64)
        setattr(weights, name, old + np.where(old < -1e6, 0, chance.normal(scale=0.2, size=old.shape)))
    seen: dict[tuple[int, int], np.ndarray] = {}

    class Recorder(lm.Trainer):
        def _change(self, table, rows, gradients):
            for row, own in zip(rows.tolist(), gradients):
                seen[table, row] = seen.get((table, row), 0) + own.astype(np.float64)

    Recorder(weights).learn(part)
    model = lm.Model(weights)
    for table, row in chance.permutation(list(seen))[:40]:
        own = weights.tables()[table][row]
        step = chance.normal(size=own.shape) * (own > -1e6)
        kept = own.copy()
        sums = []
        for side in (1e-4, -1e-4):
            weights.tables()[table][row] = kept + side * step
            sums.append(model.logs(part).sum())
        weights.tables()[table][row] = kept
        # Gradients are of the negative logarithm.
        assert (sums[0] - sums[1]) / 2e-4 == pytest.approx(-(seen[table, row] * step).sum(), rel=2e-3, abs=2e-3)


def test_ids_are_those_of_the_words():
    texts = ["one two  three\n", "", None, " THREE a\x00 a exactlyfifteen1 \x1c\x85 z ", "x" * 40 + " \u00c9t\u00e9 ing sing", "end"]
    known = [lm.END, b"a", b"a\x00", b"three", b"exactlyfifteen1", b"end", b"ing"]
    words = lm.Vocabulary(
        known, np.arange(9, 2, -1), len(known), 42, 7, np.zeros(lm.RARE, np.int64), np.zeros(lm.RARE, np.int64), 0
    )
    ids, sizes, rest = lm.Reader(words).read([t if t is None else t.encode() for t in texts])
    at = 0
    left = []
    for text, size in zip(texts, sizes):
        tokens = [*lm.words_of((text or "").encode()), lm.END]
        assert size == len(tokens)
        for token, i in zip(tokens, ids[at : at + size]):
            assert i == (known.index(token) if token in known else lm.HEAD + lm.rare_class(token))
            left += [token] * (token not in known)
        at += size
    assert at == len(ids) and rest() == left
    assert lm.rare_class(b"x" * 40) == lm.rare_class(lm.key_of(b"x" * 40))
    empty = lm.Reader(words).read([])
    assert len(empty[0]) == len(empty[1]) == len(empty[2]()) == 0


def test_sums_by_row():
    chance = np.random.default_rng(3)
    for n, top in ((1, 1), (50, 3), (400, 50), (300, 10_000)):
        rows, gradients = chance.integers(0, top, n), chance.normal(size=(n, 5))
        every, times, sums = lm._by_row(rows, gradients)
        assert every.tolist() == sorted(set(rows.tolist()))
        for row, k, own in zip(every, times, sums):
            assert k == (rows == row).sum() and np.allclose(own, gradients[rows == row].sum(axis=0))


def test_weights_do_not_depend_on_where_documents_lie(spark, make_docs):
    """Two tasks with the same texts change the same rows by the same amounts; their mean is either's."""
    texts = [(i, CORPUS[i % 10]) for i in range(20)]
    counts = lm.word_counts(make_docs(*texts), F.lit(True))
    words = lm.fit_vocabulary(counts)
    one = lm.fit_weights(make_docs(*texts[:10]).coalesce(1).sortWithinPartitions("doc_id"), F.lit(True), words)
    two = make_docs(*texts).repartitionByRange(2, "doc_id").sortWithinPartitions("doc_id")
    assert {r["n"] for r in two.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()} == {10}
    both = lm.fit_weights(two, F.lit(True), words)
    for x, y in zip(one.tables(), both.tables()):
        assert np.allclose(x, y, atol=1e-3)


def test_held_out_texts_change_nothing_that_is_learned(spark, make_docs):
    learned = [(i, CORPUS[i]) for i in range(20) if not is_held_out(i)]
    some = [(i, "other words " + CORPUS[i % 7]) for i in range(100, 130) if is_held_out(i)]
    vocabularies = []
    for rows in (learned, learned + some):
        counts = lm.word_counts(make_docs(*rows), ~held_out())
        vocabularies.append(lm.fit_vocabulary(counts))
    a, b = vocabularies
    assert a.words == b.words[: len(a.words)] and (a.tokens, a.distinct, a.head) == (b.tokens, b.distinct, b.head)
    assert not b.trained[len(a.words) :].any()
    assert a.rare_tokens.tolist() == b.rare_tokens.tolist()
