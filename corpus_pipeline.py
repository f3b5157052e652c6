"""The corpus pipeline: toxicity, exact dedup, near-duplicate join, secret scan, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``documents``.  ``run`` writes every stage's result as Parquet to the shared
folder and reads it back as the next stage's input; the last one's result is what stays there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import exact_dedup, ngram_join, secrets, toxicity
from tarmac.llm.common import table
from tarmac.llm.queries import packed_documents, toxicity_model
from tarmac.session import remove_folder, work_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("predicted = 0").select("_row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (largest id) of each group of equal texts."""
    return exact_dedup.dedup_keep(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (smallest id) of each class of near-duplicates."""
    return ngram_join.keep_representatives(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; secrets in their texts are replaced by a mark and n_chars follows."""
    clean = secrets.redact(docs, secrets.train(docs))
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in the packed sequences."""
    return packed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]

# No SQL: the first stage is a trained model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = work_dir(spark, "pipeline")
    before = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before is not None:
            remove_folder(spark, before)
        before = f"{folder}/{name}"
    return docs
