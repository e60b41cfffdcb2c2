"""Proportional stratified interleaving: every shard gets the mixture of sources that the whole table has.

Rows are put in a seeded random order within each source; a row's fractional rank there is (rank + 1/2) / rows of the
source. Sorting all rows by fractional rank interleaves the sources in proportion, and cutting that order into equal
runs gives shards that differ by one row at most. Both orders are ranked in buckets (a bucket's rows, plus the rows of
the buckets before it), so neither a hot source nor the whole table ever meets in one task.

Null sources are a source of their own. Equal rows tie and may stand in for each other. An empty table gives no rows. Of
texts only length and checksum are taken, whatever their length; columns beside id, source and text are not read.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows that one bucket of a ranking should hold.
BUCKET_ROWS = 4096
MOST_BUCKETS = 1 << 20


def _offsets(counts: DataFrame, keys: list[str], bucket: str) -> DataFrame:
    """Rows in the buckets before each. Grouped counts only: a row per key and bucket."""
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))


def interleaved_shards(rows: DataFrame, source: str, order_key: Column, ties: list[str], shards: int, seed: int, total: int) -> DataFrame:
    """rows with shard and slot. rows needs no text; total is its count."""
    buckets = min(MOST_BUCKETS, max(1, -(-total // BUCKET_ROWS)))
    # the hash is uniform over 60 bits, so its leading part deals out a source evenly
    hashed = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), order_key.cast("string"))), 1, 15), 16, 10).cast("long")
    keyed = rows.withColumn("_h", hashed).withColumn("_b", F.floor(F.col("_h") / F.lit(float(1 << 60)) * buckets).cast("long"))
    counts = keyed.groupBy(source, "_b").agg(F.count("*").alias("_n"))
    per_source = counts.groupBy(source).agg(F.sum("_n").alias("_size"))
    offsets = _offsets(counts, [source], "_b").join(per_source.withColumnRenamed(source, "_s"), F.col(source).eqNullSafe(F.col("_s"))).select(F.col(source).alias("_s"), F.col("_b").alias("_sb"), "_before", "_size")
    inside = Window.partitionBy(source, "_b").orderBy("_h", *ties)
    ranked = keyed.withColumn("_r", F.row_number().over(inside)).join(offsets, F.col(source).eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_sb")))
    fraction = (F.col("_before") + F.col("_r") - F.lit(0.5)) / F.col("_size")
    ranked = ranked.withColumn("_f", fraction).withColumn("_c", F.least(F.floor(F.col("_f") * buckets), F.lit(buckets - 1)).cast("long"))
    ranked = ranked.drop("_s", "_sb", "_before", "_size", "_r", "_b")
    cuts = _offsets(ranked.groupBy("_c").agg(F.count("*").alias("_n")), [], "_c") if buckets <= 1 << 14 else _two_level(ranked.groupBy("_c").agg(F.count("*").alias("_n")))
    across = Window.partitionBy("_c").orderBy("_f", F.col(source).asc_nulls_first(), "_h", *ties)
    placed = ranked.withColumn("_r", F.row_number().over(across)).join(cuts.select(F.col("_c").alias("_cb"), "_before"), F.col("_c") == F.col("_cb"))
    position = F.col("_before") + F.col("_r") - 1
    shard = F.floor(position * shards / F.lit(max(1, total)))
    placed = placed.withColumn("_p", position.cast("long")).withColumn("shard", F.expr(f"CAST((_p * {shards}L) DIV {max(1, total)}L AS INT)"))
    # the first position of shard s is the least p with p * shards >= s * total
    placed = placed.withColumn("slot", F.expr(f"_p - (CAST(shard AS LONG) * {total}L + {shards - 1}L) DIV {shards}L"))
    return placed.drop("_h", "_f", "_c", "_cb", "_before", "_r", "_p")


def _two_level(counts: DataFrame) -> DataFrame:
    """_offsets without a window over all buckets in one task: by runs of 4096 buckets, then the runs."""
    runs = counts.withColumn("_run", F.expr("_c DIV 4096"))
    inner = _offsets(runs, ["_run"], "_c")
    outer = _offsets(runs.groupBy("_run").agg(F.sum("_n").alias("_n")), [], "_run").select(F.col("_run").alias("_o"), F.col("_before").alias("_outer"))
    return inner.join(outer, F.col("_run") == F.col("_o")).withColumn("_before", F.col("_before") + F.col("_outer"))


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = 40, seed: int = 17) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document; law is rows (counts one apart at most).

    size is the UTF-8 bytes of the text (null: none) plus 16. Null ids are rows like others.
    """
    total = docs.count()
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", "source", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    dealt = interleaved_shards(rows, "source", F.coalesce(F.col("doc_id"), F.lit(-1)), ["doc_id", "text_crc32", "size"], shards, seed, total)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")
