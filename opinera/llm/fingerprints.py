"""Document fingerprints by winnowing.

Tokens are runs without white space, longer ones cut every 16 characters. A gram is 5 consecutive tokens, hashed by a
polynomial that rolls: the hash of 2, 4, then 5 tokens comes from the hashes of their halves. Of every 4 consecutive
grams the least hash is chosen, the rightmost of ties; its place is kept. So any 8 tokens in a row that two texts share
give both a common chosen gram, at known places.

A number holds a gram's hash above its place counted down, so that the plain least number of a window is the least hash
and among ties the rightmost. A text with fewer than 5 tokens is one gram; one without tokens is one gram of its white
space, or none if it is empty. Null texts are empty. DataFrame operations only, linear in the text.

Repeated ids are ordered by a hash of their text. Of rows equal in id and text, one is followed by the next document and
each other by its own copy. Null ids come last, as the least number. An empty table gives no rows; a table of one row is
its own next document. Other columns are not read.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinera.sources.staging import staged

GRAM = 5
WINDOW = 4
PRIME = (1 << 31) - 1
BASE = 1_000_003
PLACES = 1 << 31
#: Stands for a null id in keys, so that joins and groupings on keys share one partitioning.
NULL_ID = -(1 << 63)


def _zip(column: str, step: int, f) -> Column:
    """f of each entry and the one `step` after it."""
    n = F.greatest(F.size(column) - step, F.lit(0))
    return F.zip_with(F.slice(column, F.lit(1), n), F.slice(column, F.lit(1 + step), n), f)


def with_fingerprint(rows: DataFrame, text: str, name: str) -> DataFrame:
    """rows with the array `name` of chosen grams, in order: hash * 2**31 + (2**31 - 1 - place)."""
    t, h, two, four, five, c, m2, m4 = (f"_{name}_{i}" for i in range(8))
    square = BASE * BASE % PRIME
    out = rows.withColumn(t, F.regexp_extract_all(F.col(text), F.lit(r"\S{1,16}"), F.lit(0)))
    out = out.withColumn(h, F.transform(t, lambda w: F.pmod(F.xxhash64(w), F.lit(PRIME))))
    out = out.withColumn(two, _zip(h, 1, lambda a, b: (a * BASE + b) % PRIME))
    out = out.withColumn(four, _zip(two, 2, lambda a, b: (a * square + b) % PRIME))
    n = F.greatest(F.size(h) - 4, F.lit(0))
    out = out.withColumn(five, F.zip_with(F.slice(four, F.lit(1), n), F.slice(h, F.lit(GRAM), n), lambda a, b: (a * BASE + b) % PRIME))
    short = F.when(F.length(text) == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.pmod(F.xxhash64(F.concat_ws(" ", t), F.when(F.size(t) == 0, F.col(text))), F.lit(PRIME))))
    out = out.withColumn(five, F.when(F.size(t) < GRAM, short).otherwise(F.col(five)))
    out = out.withColumn(c, F.transform(five, lambda x, i: x * PLACES + (PLACES - 1 - i)))
    out = out.withColumn(m2, _zip(c, 1, lambda a, b: F.least(a, b))).withColumn(m4, _zip(m2, 2, lambda a, b: F.least(a, b)))
    least = F.when(F.size(c) == 0, F.col(c)).when(F.size(c) < WINDOW, F.array(F.array_min(c))).otherwise(F.array_distinct(m4))
    return out.withColumn(name, least).drop(t, h, two, four, five, c, m2, m4)


def hashes(chosen: str) -> Column:
    """Distinct hashes of the chosen grams, in order of first place."""
    return F.array_distinct(F.transform(chosen, lambda x: (x - x % PLACES) / PLACES).cast("array<bigint>"))


def places(chosen: str) -> Column:
    return F.transform(chosen, lambda x: F.lit(PLACES - 1) - x % PLACES)


def likeness(a: str, b: str) -> Column:
    """Jaccard of two arrays of distinct hashes; two empty ones are alike."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union == 0, F.lit(1.0)).otherwise(shared / union).cast("double")


def next_keys(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """_id, _th, n_chars, _copies, _nid, _nth: each distinct row's key, length and how often it is there, and the key of the next by falling id; the last one's next is the first.

    Holds numbers only. Ranges of ids are ordered on their own, and the first of each range is the next of the last of
    the range before, so no task sees all rows.
    """
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("_id").desc(), F.col("_th").asc()]
    keys = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("_id"), F.xxhash64("text").alias("_th"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"))
    keys = keys.groupBy("_id", "_th", "n_chars").agg(F.count("*").alias("_copies"))
    keys = staged(spark, keys.repartitionByRange(n, *order).withColumn("_p", F.spark_partition_id()), "keys")
    inside = Window.partitionBy("_p").orderBy(*order)
    after = F.lead(F.struct(F.col("_id").alias("id"), F.col("_th").alias("th"))).over(inside)
    linked = keys.withColumn("_next", after).withColumn("_first", F.row_number().over(inside) == 1)
    heads = linked.where("_first").select(F.col("_p").alias("_hp"), F.struct(F.col("_id").alias("id"), F.col("_th").alias("th")).alias("_head"))
    # a row a range: its next range's head, or the first range's
    ring = heads.withColumn("_following", F.coalesce(F.lead("_head").over(Window.orderBy("_hp")), F.first("_head").over(Window.orderBy("_hp").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    both = linked.join(F.broadcast(ring), F.col("_p") == F.col("_hp"))  # as many rows as shuffle partitions
    following = F.coalesce("_next", "_following")
    return both.select("_id", "_th", "n_chars", "_copies", following["id"].alias("_nid"), following["th"].alias("_nth"))


def edited_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited, chosen, edited_chosen, next_hashes of every document."""
    keys = staged(spark, next_keys(spark, docs), "next")
    texts = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("_tid"), F.xxhash64("text").alias("_tth"), F.coalesce("text", F.lit("")).alias("text"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    # the next document's place sends what its asker needs of it; repeated rows ask and are asked once
    given = with_fingerprint(keys.join(texts, (F.col("_nid") == F.col("_tid")) & (F.col("_nth") == F.col("_tth"))), "text", "next_chosen")
    # heads and hashes, not texts, go to the askers, once: what repeats is dropped there, where the join wants it too
    given = given.select("_id", "_th", "n_chars", "_copies", F.substring("text", F.lit(1), cut).alias("_head"), hashes("next_chosen").alias("next_hashes")).dropDuplicates(["_id", "_th"])
    both = texts.join(given, (F.col("_tid") == F.col("_id")) & (F.col("_tth") == F.col("_th")))
    # the join has brought equal rows together already; each but the last is followed by its copy
    last = (F.col("_copies") == 1) | (F.row_number().over(Window.partitionBy("_id", "_th").orderBy("_id")) == F.col("_copies"))
    both = both.withColumn("_last", last)
    head = F.when(F.col("_last"), F.col("_head")).otherwise(F.substring("text", F.lit(1), cut))
    both = both.withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - cut).cast("int")), head))
    both = with_fingerprint(with_fingerprint(both, "text", "chosen"), "edited", "edited_chosen")
    both = both.withColumn("next_hashes", F.when(F.col("_last"), F.col("next_hashes")).otherwise(hashes("chosen")))
    return both.select(F.nullif("_tid", F.lit(NULL_ID)).alias("doc_id"), "n_chars", "edited", "chosen", "edited_chosen", "next_hashes")


def fingerprint_report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The digests of edited_documents(). places: where the text's chosen grams start, in tokens, repeated hashes included."""
    rows = edited_documents(spark, docs).withColumns({"_h": hashes("chosen"), "_e": hashes("edited_chosen")})
    shown = lambda c: F.array_join(F.transform(c, lambda x: F.hex(x)), " ")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        shown("_h").alias("fingerprint"),
        shown("_e").alias("edited_fingerprint"),
        F.array_join(places("chosen"), " ").alias("places"),
        likeness("_h", "_e").alias("near_edited"),
        likeness("_h", "next_hashes").alias("near_next"),
    )
