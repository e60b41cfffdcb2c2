"""Vector best-fit packing of documents into sequences.

A piece of n tokens asks for (n tokens, 1 document, n * n attention). A bin has a capacity of each, and a piece goes to
the open bin that can take it under all three and whose weighted residual afterwards has the least norm (rule "norm"),
or whose weighted residual has the greatest dot product with the piece (rule "dot"). Pieces come in order of falling
length.

What a piece asks for follows from its length, so the plan is made over the histogram of lengths: at most `capacity`
rows reach the driver, whatever the table's size. Bins with the same history form a run of consecutive numbers; putting
n like pieces into a run moves the run, or splits it once. A move says: the pieces of length L with ranks r.. go to bins
b.., at an offset. Ranks are given in salted buckets of a length, so a length that holds a third of all rows is dealt
over many tasks, and each row finds its move by binary search.

Null texts are empty and have the separator only; texts may have any length. Empty table: no rows. Repeated ids are
documents of their own. Other columns are not read.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinera.llm.tokens import MEMO_UNITS, encoder
from opinera.sources.staging import staged

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
LEFT = ("tokens_left", "documents_left", "attention_left")
BUCKET_ROWS = 2048
MOST_BUCKETS = 1 << 20


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, separator: int, memo_units: int = MEMO_UNITS) -> DataFrame:
    """Ids of each whole text and a separator, cut into pieces of capacity; a first piece takes the remainder.

    memo_units: how much a worker keeps; it changes memory and time, not ids.
    """

    def cut(batches):
        enc, end = encoder(tokenizer_path, memo_units), separator.to_bytes(4, "little")
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = enc.encode(text.as_py()) + end
                n = len(ids) // 4
                first = n % capacity or capacity
                edges = [0, *range(first, n + 1, capacity)]
                out += [(doc_id, i, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
            if out:
                doc, piece, start, length, crc = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def plan_bins(histogram: dict[int, int], capacity: int, max_docs: int, max_attention: int, rule: str, weights: tuple[float, float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Moves as rows (length, first rank, pieces, first bin, offset), by length and rank; and what is left of the bins.

    The second has rows (first bin, tokens, documents, attention left), each up to the next row's first bin.
    """
    cap = np.array([capacity, max_docs, max_attention], np.float64)
    w = np.array(weights, np.float64)
    left, count, first = np.empty((0, 3), np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    moves: list[tuple[int, int, int, int, int]] = []
    bins = 0
    shortest = min(histogram, default=1)
    closed = []
    for length in sorted(histogram, reverse=True):
        item = np.array([length, 1, length * length], np.int64)
        if (item > cap).any():
            raise ValueError(f"a piece of {length} tokens exceeds a capacity")
        open_ = left[:, 0] >= shortest
        open_ &= (left[:, 1] >= 1) & (left[:, 2] >= shortest * shortest)
        closed.append(np.column_stack([first[~open_], left[~open_]]))
        left, count, first = left[open_], count[open_], first[open_]
        n, rank = histogram[length], 0
        fits = (left >= item).all(axis=1)
        # states change only for runs that were just used, so scores are kept between moves
        if rule == "norm":
            score = (w * ((left - item) / cap) ** 2).sum(axis=1)
        else:
            score = -(w * (left / cap) * (item / cap)).sum(axis=1)
        score = np.where(fits, score, np.inf)
        while n:
            best = int(score.argmin()) if len(score) else -1
            if best < 0 or score[best] == np.inf:
                break
            take = min(n, int(count[best]))
            moves.append((length, rank, take, int(first[best]), int(capacity - left[best, 0])))
            n, rank = n - take, rank + take
            if take < count[best]:  # the rest of the run stays as it was
                left, count, first = np.vstack([left, left[best]]), np.append(count, count[best] - take), np.append(first, first[best] + take)
                score = np.append(score, score[best])
                count[best] = take
            left[best] = left[best] - item
            score[best] = np.inf if (left[best] < item).any() else (w * ((left[best] - item) / cap) ** 2).sum() if rule == "norm" else -(w * (left[best] / cap) * (item / cap)).sum()
        if n:
            each = int(min(cap // item))
            for runs, held in ((n // each, each), (1, n % each)):
                if runs and held:
                    for k in range(held):
                        moves.append((length, rank, runs, bins, k * length))
                        rank += runs
                    left = np.vstack([left, cap.astype(np.int64) - held * item])
                    count, first = np.append(count, runs), np.append(first, bins)
                    bins += runs
    found = np.array(moves, np.int64).reshape(-1, 5)
    rest = np.concatenate([*closed, np.column_stack([first, left])])
    return found[np.lexsort((found[:, 1], found[:, 0]))], rest[np.argsort(rest[:, 0])]


def pack_pieces(spark: SparkSession, pieces: DataFrame, capacity: int = 2048, max_docs: int = 2048, max_attention: int | None = None, rule: str = "norm", weights: tuple[float, float, float] = (1.0, 0.5, 0.5)) -> DataFrame:
    """pieces (staged: they are read three times) with sequence_id, offset and what is left of the sequence in the end: tokens, documents, attention."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    total = sum(histogram.values())
    plan = plan_bins(histogram, capacity, max_docs, max_attention or capacity * capacity, rule, weights)
    buckets = min(MOST_BUCKETS, max(1, -(-total // BUCKET_ROWS)))
    salted = pieces.withColumn("_b", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = salted.groupBy("length", "_b").agg(F.count("*").alias("_n")).select("length", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_b").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("_r", F.row_number().over(inside)).join(offsets, ["length", "_b"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_before") + F.col("_r") - 1).cast("long").alias("_rank"))
    sent = spark.sparkContext.broadcast(plan)  # bounded by capacity, not by rows

    def place(batches):
        m, rest = sent.value
        keys = m[:, 0] << 44 | m[:, 1]
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            at = m[np.searchsorted(keys, length << 44 | rank, side="right") - 1]
            bins = at[:, 3] + rank - at[:, 1]
            left = rest[np.searchsorted(rest[:, 0], bins, side="right") - 1]
            arrays = [*batch.columns[:5], pa.array(bins), pa.array(at[:, 4]), *(pa.array(left[:, k]) for k in (1, 2, 3))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *LEFT])

    return ranked.mapInArrow(place, f"{PIECES}, sequence_id long, offset long, " + ", ".join(f"{n} long" for n in LEFT))


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer_path: str, capacity: int = 2048, separator: int = 0, memo_units: int = MEMO_UNITS, **options) -> DataFrame:
    return pack_pieces(spark, staged(spark, token_pieces(docs, tokenizer_path, capacity, separator, memo_units), "pieces"), capacity, **options)
