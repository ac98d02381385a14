"""Documents made ready for training, stage by stage.

Each stage gets the whole of what the one before kept, as a written table, and its
decisions take effect: documents in no known language go, one document of each
group of near copies stays, documents with benchmark passages go, secrets are
replaced in the text, and what is left is encoded and decoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skylag.llm import decontaminate, language, near_dups, secrets, word_bpe
from skylag.llm.common import on_workers, table
from skylag.session import scratch, work_path

TOKENIZER = "word_bpe_49k.json"
# Smaller than by default, for ids and decoded texts of a whole block are held at once.
BLOCK_CHARS = 4_000_000
# Rows sent to Python at a time, whole texts among them.
BATCH_ROWS = 1_000
# Python workers live on from stage to stage: what they free goes back to the system.
WORKER_ENV = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_MMAP_THRESHOLD_": "1000000",
    "MALLOC_TRIM_THRESHOLD_": "1000000",
}


def small_workers(spark: SparkSession) -> None:
    """Settings of this session that bound the memory of Python workers and what is sent
    to them; they stay on, for stages run when they are written."""
    on_workers(spark)
    spark.sparkContext.environment.update(WORKER_ENV)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_workers(spark)
    return language.accepted_documents(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_workers(spark)
    return near_dups.deduplicated(docs, words=5)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.without_secrets(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_workers(spark)
    keep = [c for c in docs.columns if c != "text"]
    return word_bpe.encode_documents(docs, public_tokenizers.path(TOKENIZER), keep=keep, block_chars=BLOCK_CHARS)


STAGES = [
    ("language", known_language),
    ("near_copies", no_near_copies),
    ("benchmark", no_benchmark),
    ("secrets", no_secrets),
    ("encode", encoded),
]

# Likelihoods, sketches and merges have no form in SQL; tests hold the rows against
# a brute-force run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all documents. What a stage writes on its way is
    removed once its output is stored."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"stage-{name}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
