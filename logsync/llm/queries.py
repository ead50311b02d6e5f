"""The operators of this package over the whole test tables."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsync.llm import decontamination as dec
from logsync.llm import fingerprints as fp
from logsync.llm import whitening as wh
from logsync.llm.alignment import align_documents
from logsync.llm.jaccard_join import jaccard_components
from logsync.llm.language_id import predict_language, train_language_id
from logsync.llm.license_scan import known_licenses, scan_licenses
from logsync.llm.maxent_lm import score_language_model
from logsync.llm.packing import pack_documents
from logsync.llm.substring_dedup import remove_repeated
from logsync.llm.text import id_hash
from logsync.llm.token_files import read_token_files, write_token_files
from logsync.llm.tokens import tokenizer_path
from logsync.llm.toxicity import score_toxicity, train_toxicity
from logsync.llm.url_filter import Rule, filter_urls
from logsync.session import run_folder

URL_RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


# Texts may be long: so many make an Arrow batch.
BATCH_ROWS = 1_000


def importable(spark: SparkSession) -> None:
    """Lets the workers of a local session import what its driver has imported.

    Clusters get the package by ``--py-files`` or ``PYTHONPATH``.
    """
    if spark.sparkContext.master.startswith("local"):
        spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in documents, with the window that is most similar."""
    return dec.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(urls, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licenses(docs, known_licenses(spark)).select("doc_id", "license_digest", "license_id")


def toxicity_training(labels: DataFrame) -> DataFrame:
    """Labels that may be learned from."""
    return labels.where(F.pmod(id_hash(F.col("doc_id")), F.lit(5)) != 0)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_toxicity(docs, toxicity_training(table(spark, sf_dir, "labels")))
    return score_toxicity(docs, model).select(
        "doc_id",
        (F.pmod(id_hash(F.col("doc_id")), F.lit(5)) == 0).alias("held_out"),
        "score",
        "predicted",
    )


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_folder(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return read_token_files(spark, path, crc=True)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of the texts, of their edits and of the next texts, compared."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return edited_fingerprints(docs)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """The last quarter of each text gives way to the beginning of the next one.

    A document without id has no next one: its last quarter is cut off, and its
    likeness to the next one is 0.
    """
    own = fp.with_sketch(docs.withColumn("text", F.coalesce("text", F.lit(""))), "text", "sketch")
    near = fp.with_next(own, ["text", "sketch"])
    cut = F.floor(F.length("text") / 4).cast("int")
    following = F.coalesce("next_text", F.lit(""))
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.length("text") - cut), F.substring(following, F.lit(1), cut)
    )
    both = fp.with_sketch(near.withColumn("edited", edited), "edited", "edited_sketch")
    following_sketch = F.coalesce("next_sketch", F.array().cast("array<bigint>"))
    return both.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fp.as_text(F.col("sketch")).alias("fingerprint"),
        fp.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        fp.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        F.when(F.col("next_sketch").isNull(), F.lit(0.0))
        .otherwise(fp.resemblance(F.col("sketch"), following_sketch))
        .alias("near_next"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.pmod(id_hash(F.col("doc_id")), F.lit(4)) == 2
    model = train_language_id(docs, ~held_out)
    return predict_language(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated(docs).select("doc_id", "kept_text", "removed_sentences")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers over the same bytes, in groups, and how common their links are."""
    return align_documents(table(spark, sf_dir, "documents"))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all texts, by a model of those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.pmod(id_hash(F.col("doc_id")), F.lit(5)) == 1
    return score_language_model(docs, held_out)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector on the eight largest components, each with unit variance."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = wh.fit_whitening(vectors)
    # At most one number for each component.
    shares = F.array(*(F.lit(float(e / model.trace)) for e in model.values)).cast("array<double>")
    error = F.lit(wh.identity_error(vectors, model))
    return wh.whiten(vectors, model).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")
    ).select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("place") + 1).alias("explained"),
        error.alias("identity_error"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of ``corpus_pipeline``, one after the other."""
    # It imports this module itself.
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_url_filter": op2_url_filter,
    "op3_license_scan": op3_license_scan,
    "op4_toxicity": op4_toxicity,
    "op5_token_files": op5_token_files,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_fingerprints": op7_fingerprints,
    "op8_language_id": op8_language_id,
    "op9_packing": op9_packing,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_alignment": op11_alignment,
    "op12_lm_scoring": op12_lm_scoring,
    "op13_whitening": op13_whitening,
    "pipeline": pipeline,
}
