"""The queries with SQL, and the pipeline stage by stage, on the smallest tables."""

from __future__ import annotations

import corpus_pipeline
import pytest
from check_queries import compare, connect
from pyspark.sql import functions as F
from test_joins import brute_components, brute_contaminated, brute_dedup, near_copies, roots, shingles
from test_texts import check_packing

from logsync.llm.oracles import ORACLES
from logsync.llm.queries import QUERIES
from logsync.session import run_folder


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    verdict = compare(spark, connect(sf_dir), name, QUERIES[name], ORACLES[name], sf_dir)
    assert verdict.startswith("ok"), verdict


def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def test_each_stage_works_on_what_the_last_one_kept(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before, after = docs.columns, {}, {}
    for name, stage in corpus_pipeline.STAGES:
        path = run_folder(spark, "stage-test")
        before[name] = texts(docs)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == columns
            after[name] = texts(docs)
    tops = brute_components(before["near_copies"])
    assert sorted(after["near_copies"]) == sorted(r for r in before["near_copies"] if tops[r[0]] == r[0])
    cut = {(i, t) for i, t, n in brute_dedup(before["substring_dedup"]) if n == 0 or t.strip()}
    assert set(after["substring_dedup"]) == cut
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaks = {i for i, _ in brute_contaminated(before["decontamination"], items)}
    assert sorted(after["decontamination"]) == sorted(r for r in before["decontamination"] if r[0] not in leaks)
    check_packing(docs.collect(), before["packing"], 2048)


def test_stages_take_odd_rows(spark, sf_dir, odd_docs):
    docs = odd_docs.withColumn("extra", F.lit("e"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for frame in (docs, docs.where("false")):
            out = stage(spark, frame, sf_dir)
            assert out.columns == docs.columns
            assert out.count() <= frame.count()


def brute_near_copies(rows):
    """Components of pairs that share 0.8 of their five-word shingles."""
    sets = [(i, shingles(t, 5)) for i, t in rows]
    near = lambda x, y: x and y and 100 * len(x & y) >= 80 * len(x | y)
    return roots({i for i, _ in rows}, [(i, j) for i, x in sets for j, y in sets if i < j and near(x, y)])


def test_near_copies_share_eighty_percent_of_five_words(spark, make_docs):
    rows = near_copies()
    # One word in n differs: 0.8 of five-word shingles from 49 on, 0.85 of four-word ones from 53 on.
    for n in range(46, 56):
        words = [f"n{n}x{k}" for k in range(n)]
        rows += [(5000 + 2 * n, " ".join(words)), (5001 + 2 * n, " ".join([*words[:20], "other", *words[21:]]))]
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, make_docs(*rows), "").collect()}
    assert {5001 + 2 * n for n in range(46, 56)} & kept == {5001 + 2 * n for n in (46, 47, 48)}
    tops = brute_near_copies(rows)
    assert kept == {i for i, _ in rows if tops[i] == i}


def test_contaminated_rows_go_by_their_text(spark, sf_dir, make_docs):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").first()["text"]
    rows = [(None, f"before {item} after"), (None, "a clean text without an id"), (7, item), (7, "clean, but of the same id"), (8, None)]
    kept = texts(corpus_pipeline.drop_contaminated(spark, make_docs(*rows), sf_dir))
    assert sorted(kept, key=str) == sorted([rows[1], rows[3], rows[4]], key=str)
