"""A training corpus from ``documents``: five stages, each on all that the last one kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which
``run`` writes to the shared folder and reads again for the next stage. Stages
up to the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsync.llm.decontamination import contaminated
from logsync.llm.jaccard_join import jaccard_components
from logsync.llm.packing import pack_documents
from logsync.llm.queries import table, toxicity_training
from logsync.llm.substring_dedup import remove_repeated
from logsync.llm.tokens import tokenizer_path
from logsync.llm.toxicity import score_toxicity, train_toxicity
from logsync.session import run_folder

# Near copies: so many words make a shingle, and so many percent are shared.
NEAR_WIDTH = 5
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = train_toxicity(docs, toxicity_training(table(spark, sf_dir, "labels")))
    return score_toxicity(docs, model).where("predicted = 0").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays.

    Near copies share 0.8 of their five-word shingles; op6's four words and 0.85
    bind its query only. Rows that repeat an id go as well, those without id stay.
    """
    groups = jaccard_components(docs, width=NEAR_WIDTH, percent=NEAR_PERCENT)
    others = groups.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.where("doc_id IS NOT NULL").join(others, "doc_id", "left_anti").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where("doc_id IS NULL")).select(*docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of sentences stay where they come first; texts left empty go."""
    cut = remove_repeated(docs)
    changed = F.col("removed_sentences") > 0
    left = cut.where(~changed | (F.trim("kept_text") != ""))
    return left.withColumns(
        {
            "text": F.col("kept_text"),
            "n_chars": F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")),
        }
    ).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds a benchmark item go, whatever ids they or others have."""
    # A text stands for itself, so rows that share an id, or have none, are told apart.
    texts = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    found = contaminated(texts, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("\x00text")).distinct()
    return docs.join(found, F.xxhash64(docs["text"]) == found["\x00text"], "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left as pieces in sequences of at most 2048 tokens."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Training and hashing by the stages' own methods have no counterpart in SQL;
# tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = run_folder(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.mode("error").parquet(path)
        docs = spark.read.parquet(path)
    return docs
