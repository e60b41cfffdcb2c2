"""One query an operator, over its whole table with production parameters, and SQL where it can say the same."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinera.llm import decontaminate, fingerprints, fm_dedup, oracles, packing, sa_dedup, secrets, sharding, simhash, sstable, toxicity
from opinera.sources.tables import table

#: A parameter of the token operators; the file itself is never copied.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _session(spark: SparkSession) -> SparkSession:
    """Batches to Python are bounded: a batch of very long documents must fit beside the others."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    return spark


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_session(spark), table(spark, sf_dir, "documents"), TOKENIZER, capacity=2048, separator=0)


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_report(spark, table(spark, sf_dir, "documents"))


def op3_stratified_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(spark, table(spark, sf_dir, "documents"), shards=40)


def op4_fm_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_dedup.remove_repeats(_session(spark), table(spark, sf_dir, "documents"), texts=False)


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sa_dedup.remove_repeats(_session(spark), table(spark, sf_dir, "documents"), texts=False)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_scores(_session(spark), table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(_session(spark), table(spark, sf_dir, "documents"), width=3, distance=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_documents(table(_session(spark), sf_dir, "documents"), ["doc_id"])
    return found.select("row.doc_id", *found.columns[1:])


def op10_sstable_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sstable.token_tables(_session(spark), table(spark, sf_dir, "documents"), TOKENIZER, end_id=2)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_best_fit_packing, op2_winnowing, op3_stratified_sharding, op4_fm_substring_dedup, op5_suffix_array_dedup, op6_toxicity, op7_decontamination, op8_simhash_groups, op9_secret_scan, op10_sstable_tokens)
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {op4_fm_substring_dedup.__name__: oracles.FM_DEDUP, op5_suffix_array_dedup.__name__: oracles.SA_DEDUP, op7_decontamination.__name__: oracles.DECONTAMINATION}
