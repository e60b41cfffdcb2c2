"""Intermediate tables in the folder that the cluster shares.

Written tables cut lineage and survive lost executors; unlike localCheckpoint there is no single copy on one worker.
"""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. Unset, it becomes a temporary folder on a local master, and an error on others."""
    folder = spark.conf.get(_KEY, None)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError(f"{_KEY} must name a folder that the cluster shares")
        folder = f"file://{tempfile.mkdtemp(prefix='opinera-')}"
        spark.conf.set(_KEY, folder)
    return folder.rstrip("/")


#: Folders made in a scratch() block, innermost block last.
_blocks: list[list[str]] = []


def new_folder(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _blocks:
        _blocks[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is staged inside goes at the end, so results have to be written or read before. A result's own folder is
    the caller's: one from new_folder() outside."""
    _blocks.append([])
    try:
        yield
    finally:
        for path in _blocks.pop():
            drop_folder(spark, path)


def written(spark: SparkSession, frame: DataFrame, name: str) -> tuple[DataFrame, str]:
    """frame written once as Parquet and read back, and the folder it is in."""
    path = new_folder(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path), path


def staged(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame:
    return written(spark, frame, name)[0]


def drop_folder(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
