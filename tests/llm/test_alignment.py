"""Alignments against all pairs of byte ranges, counted over all documents."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logsync.llm import alignment as al
from logsync.llm.queries import QUERIES
from logsync.llm.tokens import tokenizer_path

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(tokenizer_path())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(al.PIECES))


def byte_signs():
    """The usual table of byte-level tokenizers: printable bytes are themselves."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def ranges(pieces):
    at, out = 0, []
    for i, data in pieces:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def brute_tokens(tokenizers, text):
    a, b = tokenizers
    signs = byte_signs()
    if not text:
        return [], []
    of_a = [
        (i, bytes(signs[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids
    ]
    of_b = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        of_b.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if not whole == b"".join(x for _, x in of_a) == b"".join(x for _, x in of_b):
        return [], []
    return ranges(of_a), ranges(of_b)


def brute(tokenizers, rows):
    tokens = [(i, *brute_tokens(tokenizers, text)) for i, text in rows]
    linked = [
        [(i, j) for i, low, high in a for j, begin, end in b if max(low, begin) < min(high, end)] for _, a, b in tokens
    ]
    counts = Counter(pair for own in linked for pair in set(own))
    best: dict[int, int] = {}
    for (i, _), n in counts.items():
        best[i] = max(n, best.get(i, 0))
    out = []
    for (doc_id, a, b), own in zip(tokens, linked):
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, begin = [], 0
        for end in ends:
            inside = [",".join(str(i) for i, low, _ in side if begin <= low < end) for side in (a, b)]
            groups.append("|".join(inside))
            begin = end
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        sums = sum(counts[i, j] == best[i] for i, j in own), sum(counts[pair] for pair in own)
        out.append((doc_id, len(a), len(b), len(groups), len(own), *sums, sha))
    return sorted(out, key=str)


def rows_of(frame):
    assert tuple(frame.columns) == tuple(sorted(COLUMNS, key=COLUMNS.index))
    return sorted((tuple(r) for r in frame.collect()), key=str)


ODD = [
    (1, None), (2, ""), (3, " "), (4, "   \n\t "), (5, "a▁b"), (6, "▁"), (7, "One two. One two."),
    (7, "One two. One two."), (None, "no id here"), (None, None), (8, "<|endoftext|> and <s> </s> <unk> <0x41> text"),
    (9, "É à ü ß 日本語 \U0001f600\U0001f468‍\U0001f469 ไทย"), (10, "tab\tand\r\nline\x00zero\x1c"),
    (11, "x" * 700), (12, "é ﬁ ½ ① 　wide"), (13, " lead and trail  "), (14, "2,000.50 don't we'll"),
]


def test_odd_texts(spark, make_docs, tokenizers):
    docs = make_docs(*ODD).withColumns({c: F.lit(5) for c in ("row", "links", "pair", "n", "a", "best", "times")})
    found = rows_of(al.align_documents(docs))
    assert found == brute(tokenizers, ODD)
    zeros = {r[0] for r in found if r[1:] == (0, 0, 0, 0, 0, 0, "")}
    assert zeros >= {1, 2, 5} and 8 not in zeros and 9 not in zeros


def test_whole_documents(spark, sf_dir, tokenizers):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    # All pairs of ranges take long, so of the documents the shorter ones, as a corpus of their own.
    short = sorted(rows, key=lambda r: len(r[1] or ""))[:120]
    docs = spark.createDataFrame(short, "doc_id long, text string")
    assert rows_of(al.align_documents(docs)) == brute(tokenizers, short)


def test_the_query_counts_over_all_documents(spark, sf_dir, tokenizers):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = {r["doc_id"]: r for r in QUERIES["op11_alignment"](spark, sf_dir).collect()}
    assert len(found) == len(rows)
    totals = 0
    for i, text in rows:
        a, b = brute_tokens(tokenizers, text)
        ends = {e for *_, e in a} & {e for *_, e in b}
        assert (found[i]["n_a"], found[i]["n_b"], found[i]["n_groups"]) == (len(a), len(b), len(ends))
        # Neighbours in two divisions of one line overlap once more than they share ends.
        assert found[i]["n_links"] == (len(a) + len(b) - len(ends) if a else 0)
        totals += found[i]["n_links"]
    assert 0 < sum(r["n_best"] for r in found.values()) <= totals
    assert all(r["count_sum"] >= r["n_links"] for r in found.values())


def test_pairs_that_are_not_sent_count_alike(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60")
    whole = rows_of(al.align_documents(docs))
    for sent in (0, 1, 50):
        assert rows_of(al.align_documents(docs.repartition(5), sent_pairs=sent)) == whole


def test_no_documents_give_no_rows(spark, make_docs):
    assert al.align_documents(make_docs((1, "x")).where("false")).count() == 0
    assert rows_of(al.align_documents(make_docs((1, None)))) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_memory_of_windows_does_not_change_results(monkeypatch):
    texts = ["".join(random.Random(i).choices("ab é日 .\n1", k=300)) for i in range(30)]
    paths = tokenizer_path(), tokenizer_path(al.PIECES)
    whole = al.Aligner(*paths).rows(texts)
    monkeypatch.setattr(al, "WINDOWS", 3)
    monkeypatch.setattr(al, "CHUNK", 2)
    assert al.Aligner(*paths).rows(texts) == whole


def test_counts_handed_on_in_parts_add_up(spark, sf_dir, monkeypatch, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 40")
    made = al.write_alignments(docs, str(tmp_path / "a"), tokenizer_path(), tokenizer_path(al.PIECES))
    expected = Counter()
    for r in made.collect():
        pairs, times = al.unpacked(r["links"])
        assert times.sum() == r["n_links"] and sorted(set(pairs.tolist())) == pairs.tolist()
        expected.update(pairs.tolist())
    monkeypatch.setattr(al, "COUNTED", 500)
    assert {r["pair"]: r["n"] for r in al.pair_counts(made).collect()} == expected
