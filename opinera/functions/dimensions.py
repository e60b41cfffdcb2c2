"""Group keys: buckets, multi-valued members, flags as rows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "UNKNOWN"


def bucketed(value: Column, edges: Sequence[float], names: Sequence[str]) -> Column:
    """The half-open bucket [edge, next edge) of value, the last one open; null for null and below the first edge."""
    out = F.when(value.isNull() | (value < edges[0]), F.lit(None).cast("string"))
    for upper, name in zip(edges[1:], names, strict=False):
        out = out.when(value < upper, F.lit(name))
    return out.otherwise(F.lit(names[-1]))


def hours_bucket(hours: Column) -> Column:
    return bucketed(hours, (0, 2, 10, 50), ("0-2h", "2-10h", "10-50h", "50h+"))


def price_bucket(is_free: Column, price: Column) -> Column:
    """A paid item without a price has no bucket of its own size: UNKNOWN, not the dearest."""
    paid = bucketed(price, (0, 200_000, 500_000, 1_000_000), ("<200K", "200K-500K", "500K-1M", "1M+"))
    return F.when(is_free, F.lit("FREE")).otherwise(F.coalesce(paid, F.lit(UNKNOWN)))


def members(values: Column) -> Column:
    """Distinct members of an array, null ones as UNKNOWN; a null or empty array is one UNKNOWN."""
    named = F.array_distinct(F.transform(values, lambda v: F.coalesce(v, F.lit(UNKNOWN))))
    return F.when(F.coalesce(F.size(values), F.lit(0)) > 0, named).otherwise(F.array(F.lit(UNKNOWN)))


def by_member(rows: DataFrame, values: Column, name: str) -> DataFrame:
    """A row for each member of a row. Distinct within the row already, so plain counts need no further shuffle."""
    return rows.withColumn(name, F.explode(members(values)))


def by_flag(rows: DataFrame, flags: dict[str, Column], name: str) -> DataFrame:
    """A row for each flag that is true; rows with none go."""
    set_ = F.array_compact(F.array(*(F.when(flag, F.lit(label)) for label, flag in flags.items())))
    return rows.withColumn(name, F.explode(set_))


def clean_tokens(values: Column) -> Column:
    """Distinct, trimmed of blanks and nulls, in order; [] for null."""
    some = F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda v: v.isNotNull() & (F.length(F.trim(v)) > 0))
    return F.array_sort(F.array_distinct(some))
