"""Toxicity by subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word's features are the word itself and its character n-grams, hashed into one table of vectors; an unseen misspelling
shares most n-grams with the word it comes from. A text's vector is the mean over all its features, and a two-class
softmax reads it. Both are trained together by stochastic gradient descent on a bounded sample of labelled rows.

Since mean and softmax are linear, a feature's share in the logit is one number, and a word's share is the sum over its
features. Scoring keeps those per word, so whole texts of any length take one lookup a word.

Null and empty texts get the score of the bias alone. Repeated ids are rows of their own; of a labelled id's texts, the
one with the least hash is learned from. Rows without a label, or with a null in one, aren't learned from; with no
labelled rows every score is 0.5. An empty table gives no rows. Columns of documents may have any names.
"""

import re
import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinera.llm.memos import claim
from opinera.llm.repeats import pack, unpack

BUCKETS = 1 << 17
DIM = 8
GRAMS = (3, 4, 5)
EPOCHS = 10
RATE = 0.5
#: The fit's bound: at most so many labelled rows, each with its whole text.
SAMPLE_ROWS = 6000
#: Words a worker keeps.
MEMO_WORDS = 100_000
#: Words told apart among those met once; if two share a bit, one is kept too early.
SEEN_BITS = 1 << 24
#: Words whose features are kept while bags are made.
BAG_WORDS = 50_000

_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[int]:
    """Places in the table of a lower-cased word and its n-grams."""
    marked = f"<{word}>"
    found = [zlib.crc32(marked.encode()) % BUCKETS]
    for n in GRAMS:
        found += [zlib.crc32(marked[i : i + n].encode()) % BUCKETS for i in range(len(marked) - n + 1) if n < len(marked)]
    return found


def feature_counts(text: str | None, memo: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the features of a whole text, ascending, and how often each is there; memo keeps those of words."""
    words = Counter(_WORD.findall((text or "").lower()))
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.uint32)
    parts = []
    for w in words:
        found = memo.get(w)
        if found is None:
            found = np.array(word_features(w), np.int32)
            if len(memo) < BAG_WORDS and len(w) <= 40:
                memo[w] = found
        parts.append(found)
    times = np.repeat(list(words.values()), [len(x) for x in parts])
    ids, at = np.unique(np.concatenate(parts), return_inverse=True)
    return ids, np.bincount(at, times).astype(np.uint32)


def bag(ids: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and shares."""
    return ids, (times / max(1, times.sum())).astype(np.float32)


class Model:
    """share: what each feature adds to the logit of toxic; bias: the logit of a text without words."""

    def __init__(self, share: np.ndarray, bias: float):
        self.share, self.bias = share, bias
        self.words: dict[str, tuple[float, int]] = {}
        self.met = bytearray(SEEN_BITS >> 3)  # a bit a word, by hash: words are kept from their second sight on

    def _word(self, word: str) -> tuple[float, int]:
        places = word_features(word)
        found = (float(self.share[places].sum()), len(places))
        if len(self.words) < MEMO_WORDS and len(word) <= 40:
            bit = hash(word) & SEEN_BITS - 1
            if self.met[bit >> 3] >> (bit & 7) & 1:
                self.words[word] = found
            else:
                self.met[bit >> 3] |= 1 << (bit & 7)
        return found

    def score(self, text: str | None) -> float:
        words = self.words
        pairs = [words.get(w) or self._word(w) for w in _WORD.findall(text.lower())] if text else []
        count = sum(n for _, n in pairs)
        logit = self.bias + (sum(s for s, _ in pairs) / count if count else 0.0)
        return 1 / (1 + float(np.exp(-min(max(logit, -60.0), 60.0))))


def _train(bags: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, seed: int) -> tuple[np.ndarray, float]:
    """Shares and bias after AdaGrad over (features, weights) bags; vectors and softmax move together."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    softmax, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    squared, soft_sq, bias_sq = np.full(BUCKETS, 1e-6, np.float32), np.full((DIM, 2), 1e-6, np.float32), np.full(2, 1e-6, np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for at in rng.permutation(len(bags)):
            ids, weight = bags[at]
            mean = weight @ vectors[ids]
            z = mean @ softmax + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[at]] -= 1
            back, grad = softmax @ p, np.outer(mean, p)
            soft_sq += grad * grad
            bias_sq += p * p
            softmax -= rate * grad / np.sqrt(soft_sq)
            bias -= rate * p / np.sqrt(bias_sq)
            squared[ids] += weight * weight * (back @ back) / DIM
            vectors[ids] -= (rate * weight / np.sqrt(squared[ids]))[:, None] * back
    return (vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float64), float(bias[1] - bias[0])


def _calibration(logits: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic curve through logits of rows that the model hasn't seen, by Newton's steps."""
    center, spread = logits.mean(), logits.std() or 1.0
    x = np.stack([(logits - center) / spread, np.ones(len(y))], axis=1)
    at = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        at += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(2), x.T @ (y - p) - 0.5 * at * [1, 0])
    scale = max(at[0], 1e-3) / spread
    return scale, at[1] - scale * center


def fit(texts: list[str | None], labels: list[int], seed: int = 11) -> Model:
    memo: dict[str, np.ndarray] = {}
    return fit_bags([bag(*feature_counts(t, memo)) for t in texts], labels, seed)


def fit_bags(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[int], seed: int = 11) -> Model:
    """Trains on all rows, and on each half to see what logits unseen rows get; those set the scale and the threshold."""
    if len(set(labels)) < 2:
        return Model(np.zeros(BUCKETS), 0.0 if not labels else (4.0 if labels[0] else -4.0))
    y = np.array(labels)
    unseen = np.zeros(len(y))
    half = np.random.default_rng(seed).permutation(len(y)) % 2
    for side in (0, 1):
        of, other = np.flatnonzero(half == side), np.flatnonzero(half != side)
        share, bias = _train([bags[i] for i in of], y[of], seed)
        unseen[other] = [bias + float(bags[i][1] @ share[bags[i][0]]) for i in other]
    share, bias = _train(bags, y, seed)
    scale, shift = _calibration(unseen, y)
    return Model(share * scale, bias * scale + shift)


def held_out(doc_id) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit_on(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fits on at most sample_rows labelled rows that aren't held out, the same ones each time (least hashed ids)."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    ids = chosen.collect()  # bounded by sample_rows
    rows = docs.select("doc_id", "text").join(F.broadcast(docs.sparkSession.createDataFrame(ids, chosen.schema)), "doc_id")
    # a text an id, before anything is collected
    rows = rows.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text"))

    def bags(batches):
        memo: dict[str, np.ndarray] = {}
        for batch in batches:
            made = [feature_counts(t.as_py(), memo) for t in batch.column(0)]
            packed = pa.array([pack([np.diff(ids, prepend=0).astype(np.uint32), times]) for ids, times in made], pa.binary())  # steps are small and compress
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], packed], ["doc_id", "toxic", "bag"])

    schema = rows.select("doc_id", "toxic").schema.add("bag", "binary")
    made = rows.select("text", "doc_id", "toxic").mapInArrow(bags, schema)
    sample = sorted(made.collect(), key=lambda r: r["doc_id"])  # a bag a sampled row, no texts
    labels_, bags_ = [int(r["toxic"]) for r in sample], []
    for r in sample:
        steps, times = unpack(r["bag"])
        bags_.append(bag(np.cumsum(steps, dtype=np.int32), times))
    del sample
    return fit_bags(bags_, labels_)


def score_documents(spark: SparkSession, docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """row (a struct of the columns in keep, so that no name can clash) and score."""
    sent = spark.sparkContext.broadcast((model.share.astype(np.float32), model.bias))  # fixed size
    mark = uuid.uuid4().hex

    rows = docs.select(F.col("text").alias("text"), F.struct(*keep).alias("row"))
    def score(batches):
        local = _local(mark, sent)
        for batch in batches:
            scores = [local.score(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(scores, pa.float64())], ["row", "score"])

    return rows.mapInArrow(score, rows.select("row").schema.add("score", "double"))


_models: dict[str, Model] = {}


def _local(name: str, sent) -> Model:
    """One model a worker and broadcast, so that its memo of words outlives a task."""
    claim("toxicity", _models.clear)
    if name not in _models:
        _models.clear()
        share, bias = sent.value
        _models[name] = Model(share, bias)
    return _models[name]


def keep_clean(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those that score 0.5 or more."""
    return score_documents(spark, docs, fit_on(docs, labels), docs.columns).where("score < 0.5").select("row.*")


def toxic_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = score_documents(spark, docs, fit_on(docs, labels), ["doc_id"]).select("row.doc_id", "score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
