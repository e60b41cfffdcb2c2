"""Benchmark decontamination: test n-grams as a broadcast hash set, training windows scanned against it, hits verified.

Words are runs of letters, digits and non-ASCII characters, with A-Z lower-cased and nothing else changed. A window is
13 consecutive words of an item; an item with fewer, but some, is one window. A window's hash comes from hashes of its
words, joined by doubling lengths, so a document's windows of all places cost a few passes over its words. The hash set
of the test windows is broadcast where its size in bytes, which is counted first, is within a limit; beyond it, it is
dealt out. Every place of every document is looked up, and what matches is verified word by word at once, so hash
collisions never show and only true hits move.

Null texts have no words and no hits. Repeated items count one by one; null item ids are left out of the lists. Repeated
documents get the same result each. Empty tables: no rows, or no hits. Columns of documents may have any names: they
travel as one struct. DataFrame operations only.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinera.sources.staging import staged

WINDOW = 13
#: Bytes of test windows (hashes, words, item ids), and of hits, up to which they are broadcast; beyond, the join deals them out.
BROADCAST_BYTES = 64 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Java classes of what separates words, before and after lower-casing.
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PIECE = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)"
_LEAD = r"^([\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)"


def words_of(text: Column) -> Column:
    ascii_only = F.octet_length(text) == F.length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.coalesce(F.array_remove(F.split(lowered, _BREAK), ""), F.array().cast("array<string>"))


def gram_hashes(rows: DataFrame, words: str, length: int, name: str) -> DataFrame:
    """rows with the array `name`: a 64-bit hash of each `length` consecutive words; empty for fewer words."""
    made: list[str] = []

    def joined(rows, a, b, step, name):
        n = F.greatest(F.size(b) - step, F.lit(0))
        out = rows.withColumn(name, F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1 + step), n), lambda x, y: F.xxhash64(x, y)))
        made.append(name)
        return out

    power, size, done, covered = f"{name}_1", 1, None, 0
    rows = rows.withColumn(power, F.transform(words, lambda w: F.xxhash64(w)))
    made.append(power)
    while True:
        if length & size:
            if done is None:
                done, covered = power, size
            else:
                rows, done, covered = joined(rows, done, power, covered, f"{name}_{covered + size}_all"), f"{name}_{covered + size}_all", covered + size
        if 2 * size > length:
            break
        rows, power, size = joined(rows, power, power, size, f"{name}_{2 * size}"), f"{name}_{2 * size}", 2 * size
    return rows.withColumn(name, F.col(done)).drop(*made)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """win (words), len, items (ids that have it, as strings)."""
    words = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    each = words.select("item", "w", F.explode(starts).alias("at")).select("item", F.slice("w", F.col("at"), window).alias("win"))
    one = each.groupBy("win").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return one.select("win", F.size("win").alias("len"), "items")


def hits(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """row (a struct of docs' columns), words, hits (places of hit words, ascending) and items (ids of items with a window here)."""
    windows = staged(spark, benchmark_windows(benchmark, window), "windows")
    size = F.sum(F.octet_length(F.concat_ws(" ", "win")) + F.octet_length(F.concat_ws(" ", "items")) + 8 * (F.size("win") + F.size("items")) + 64)
    lengths = {r["len"]: r["bytes"] for r in windows.groupBy("len").agg(size.alias("bytes")).collect()}  # `window` rows at most
    rows = docs.select(F.struct("*").alias("row"))
    texts = rows.select(F.col("row.doc_id").alias("id"), F.xxhash64("row.text").alias("th"), words_of(F.col("row.text")).alias("w"))
    found = None
    for length in sorted(lengths):
        # outer: the filter that Spark infers from a plain one would hash every place once more, inside the lambda
        places = gram_hashes(texts, "w", length, "h").select("id", "th", "w", F.posexplode_outer("h").alias("pos", "hash"))
        tests = gram_hashes(windows.where(F.col("len") == length), "win", length, "h").select(F.get("h", F.lit(0)).alias("hash"), "win", "items")
        tests = F.broadcast(tests) if sum(lengths.values()) <= BROADCAST_BYTES else tests
        true = F.slice("w", F.col("pos") + 1, length) == F.col("win")
        one = places.join(tests, "hash").where(true).select("id", "th", F.struct("pos", F.lit(length).alias("len")).alias("at"), "items")
        found = one if found is None else found.unionAll(one)
    if found is None:
        return rows.select("row", words_of(F.col("row.text")).alias("words"), F.array().cast("array<int>").alias("hits"), F.array().cast("array<string>").alias("items"))
    # equal rows have equal hits, so sets; a place's windows are as many as their lengths
    each = found.groupBy("id", "th").agg(F.collect_set("at").alias("at"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    spans = F.transform("at", lambda c: F.sequence(c["pos"], c["pos"] + c["len"] - 1))
    each = each.select(F.col("id").alias("hit_id"), F.col("th").alias("hit_th"), F.array_sort(F.array_distinct(F.flatten(spans))).alias("hits"), "items")
    each = staged(spark, each, "hits")
    size = each.agg(F.coalesce(F.sum(F.size("hits") * 4 + F.octet_length(F.concat_ws(" ", "items")) + 16 * F.size("items") + 64), F.lit(0))).first()[0]
    keyed = rows.withColumns({"id": F.col("row.doc_id"), "th": F.xxhash64("row.text")})
    # few documents are hit as a rule: if their hits are within the limit, the texts stay where they are
    both = keyed.join(F.broadcast(each) if size <= BROADCAST_BYTES else each, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("th") == F.col("hit_th")), "left")
    return both.select("row", words_of(F.col("row.text")).alias("words"), F.coalesce("hits", F.array().cast("array<int>")).alias("hits"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def is_contaminated(share: int = 20) -> Column:
    """Of a row of hits(): at least one word in `share` is hit."""
    return (F.size("hits") > 0) & (F.size("hits") * share >= F.size("words"))


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW) -> DataFrame:
    """docs without contaminated documents, or without the hit spans (a word and what separates it from the next)."""
    found = hits(spark, docs, benchmark, window)
    if remove == "documents":
        return found.where(~is_contaminated()).select("row.*")  # only texts with hits are cut in words for that
    text = F.col("row.text")
    pieces = F.regexp_extract_all(text, F.lit(_PIECE), F.lit(1))
    kept = F.concat(F.regexp_extract(text, _LEAD, 1), F.array_join(F.filter(pieces, lambda _, i: ~F.array_contains("hits", i)), ""))
    left = F.when(F.size("hits") > 0, kept).otherwise(text)
    return found.select(F.col("row").withField("text", left).alias("row")).select("row.*")


def report(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = hits(spark, docs.select("doc_id", "text"), benchmark)
    return found.select(
        "row.doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )
