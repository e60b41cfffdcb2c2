"""Connected components of a graph held in tables, by alternating large and small stars."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinera.sources.staging import drop_folder, written

ROUNDS = 60


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 40)).alias("h")).first()
    return row["n"], row["h"] or 0


def smallest_reachable(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """u, v of every node with a link to a smaller node: v is the smallest node that u reaches.

    Each half round links nodes to the least of their neighbours, so edges only ever become fewer or point lower. A round
    is written to the shared folder; only its row count and checksum reach the driver. Hot stars are pre-aggregated
    by min, and the join back is one that Spark splits.
    """
    now, path = written(spark, edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(now)
    for _ in range(ROUNDS):
        if not mark[0]:
            break
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large, between = written(spark, large, "edges")
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(floor, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        old = path
        now, path = written(spark, small, "edges")
        before, mark = mark, _mark(now)
        for done in (old, between):  # nothing reads them again
            drop_folder(spark, done)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return now
