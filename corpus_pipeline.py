"""From raw documents to packed training sequences: each stage is written and read again before the next.

Every stage works on all rows that the one before kept, and all but the last return the columns of ``documents``. Rows with
NULL or repeated values in any column, empty and very long texts, and empty tables pass as the operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolemart.llm import decontaminate, neardup, packing, quality, secrets
from rolemart.llm.common import landed, spare
from rolemart.llm.queries import tokenizer_path, training_labels
from rolemart.llm.registry import find_package, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose Bradley-Terry score reaches the learnt quantile."""
    find_package(spark)
    score = spare(docs, "score")
    return quality.with_quality(docs, training_labels(spark, sf_dir), score).where(F.col(score) >= 0.3).drop(score)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are near duplicates of each other, one row with the smallest id; a NULL id is larger than every other."""
    find_package(spark)
    return neardup.one_of_each(docs)


def keep_unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    find_package(spark)
    leak = spare(docs, "leak")
    return decontaminate.with_leaks(docs, table(spark, sf_dir, "benchmark"), leak).where(F.size(f"{leak}.spans") == 0).drop(leak)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark; n_chars follows the text where it changed."""
    find_package(spark)
    before = spare(docs, "before")
    clean = secrets.redact(docs.withColumn(before, docs["text"]))
    changed = ~F.col("text").eqNullSafe(F.col(before))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return clean.select(*(F.col(f"`{c}`") for c in docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    find_package(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality", keep_good),
    ("near-duplicates", keep_one_of_each),
    ("decontamination", keep_unleaked),
    ("secrets", without_secrets),
    ("packing", pack_sequences),
]

#: SQL can express neither the learnt scores nor the tokenizer; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
