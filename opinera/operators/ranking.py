"""Top-k, kept members, domain orders and pages. Every order ends in a unique key, so results are defined."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top(rows: DataFrame, order: Sequence[Column], most: int, least: int = 1, limit_at: int = 100) -> DataFrame:
    if not least <= most <= limit_at:
        raise ValueError(f"a limit must be {least} to {limit_at}")
    return rows.orderBy(*order).limit(most)


def top_keeping(rows: DataFrame, order: Sequence[Column], most: int, keep: Column) -> DataFrame:
    """The top rows, where a kept row outside them takes the last place."""
    best = rows.withColumn("_kept", F.coalesce(keep, F.lit(False)))
    others = best.where(~F.col("_kept")).orderBy(*order).limit(most)
    kept = best.where("_kept").orderBy(*order).limit(1)
    return others.unionByName(kept).orderBy(F.col("_kept").desc(), *order).limit(most).drop("_kept").orderBy(*order)


def numbered(rows: DataFrame, key: str, within: str, buckets: int = 64) -> DataFrame:
    """rows with rn, the place by key (a number or time) from 1 among the rows of `within`, and n, how many those are.

    Rows are ranked in ranges of the key, each after the sizes of those before, so no group is ranked in one task.
    """
    bounds = rows.agg(F.percentile_approx(key, [i / buckets for i in range(1, buckets)], 10000)).first()[0] or []
    bucket = F.size(F.filter(F.array(*(F.lit(b) for b in bounds)), lambda b: b < F.col(key))) if bounds else F.lit(0)
    placed = rows.withColumn("_b", bucket)
    counts = placed.groupBy(within, "_b").agg(F.count("*").alias("_n"))
    group = Window.partitionBy(within)
    sizes = counts.select(F.col(within).alias("_w"), F.col("_b").alias("_c"), F.coalesce(F.sum("_n").over(group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_n").over(group).alias("n"))
    inside = placed.withColumn("_r", F.row_number().over(Window.partitionBy(within, "_b").orderBy(key)))
    both = inside.join(sizes, F.col(within).eqNullSafe(F.col("_w")) & (F.col("_b") == F.col("_c")))
    return both.select(*rows.columns, (F.col("_before") + F.col("_r")).alias("rn"), "n")


def domain_order(value: Column, names: Sequence[str]) -> Column:
    """The place of value in names; others and null last."""
    out = F.when(value == names[0], F.lit(0))
    for i, name in enumerate(names[1:], 1):
        out = out.when(value == name, F.lit(i))
    return out.otherwise(F.lit(len(names)))


def page(rows: DataFrame, order: Sequence[Column], number: int, size: int) -> DataFrame:
    """Page `number` from 1."""
    if number < 1 or not 1 <= size <= 100:
        raise ValueError("pages count from 1 and hold 1 to 100 rows")
    return rows.orderBy(*order).offset((number - 1) * size).limit(size)
