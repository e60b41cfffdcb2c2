"""Parquet tables of a data folder."""

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Any path that Spark's readers open, local or remote; nothing is listed from Python."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
