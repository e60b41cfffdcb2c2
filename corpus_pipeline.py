"""Stages that turn documents into packed sequences; each is written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir), works on all of docs and returns a DataFrame; all but the last return the
columns of docs. Rejected documents are gone for the stages after.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from opinera.llm import decontaminate, packing, secrets, simhash, toxicity
from opinera.sources.staging import staged
from opinera.sources.tables import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _batches(spark: SparkSession) -> SparkSession:
    """Batches to Python stay small, however long the documents."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    return spark


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(_batches(spark), docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_each(_batches(spark), docs, width=5, distance=28, likeness=0.8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(spark, docs, table(spark, sf_dir, "benchmark"), remove="documents")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # a smaller memo than alone: workers have been through the other stages
    return packing.pack_documents(_batches(spark), docs, TOKENIZER, capacity=2048, separator=0, memo_units=200_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack),
]
#: The stages fit models and tokenize, which SQL can't say; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
