"""Substring dedup by a compressed FM-index per shard.

A shard's text is its distinct word strings, by owner, each with an end mark of its own. The index is the Burrows-Wheeler
transform of that text in a wavelet matrix: a bit vector a level, packed, with counts every 64 bits. Documents' strings
are streamed against it by backward search, many places at a time: the matching statistic of a place is how far back from
it a string goes that the text has at least twice. Where it reaches the threshold, the suffix interval is reported. Strings
stream in the order of documents, so all reports of an interval but the first are repeats; neither the text nor its
suffix order is kept beside the index. opinera.llm.repeats brings strings to shards and verdicts to documents.

Null and empty texts have no words. Texts shorter than a window keep all. Rows equal in id and text are one document and
judged alike; rows of one id and unlike texts are documents in the order of a hash of their texts; null ids come first.
Empty tables give no rows. Other columns are not read.
"""

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession

from opinera.llm.repeats import Corpus

WINDOW = 20
GRAM = 4
#: Words searched at once.
AT_ONCE = 1 << 18


class WaveletMatrix:
    """Rank of symbols in a sequence, from packed bit vectors."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        now = sequence
        for level in range(self.levels - 1, -1, -1):
            ones = (now >> level & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(len(ones) // 64 + 1, "<u8")
            words.view(np.uint8)[: len(packed)] = packed
            self.bits.append(words)
            self.counts.append(np.r_[0, np.cumsum(np.bitwise_count(words), dtype=np.int64)].astype(np.uint32))
            self.zeros.append(int(len(ones) - ones.sum()))
            now = np.concatenate([now[~ones], now[ones]])
        self.begin = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for i, level in enumerate(range(self.levels - 1, -1, -1)):
            word = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[i][word].astype(np.int64) + np.bitwise_count(self.bits[i][word] & below)
            at = np.where(symbol >> level & 1, self.zeros[i] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._down(symbol, at) - self.begin[symbol]


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Of a text whose suffixes differ within a bounded depth, by ranks of doubling length."""
    _, rank = np.unique(text, return_inverse=True)
    step, n = 1, len(text)
    while True:
        key = rank.astype(np.int64) * (n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        by = key[order]
        fresh = np.empty(n, np.int64)
        fresh[order] = np.cumsum(np.r_[0, by[1:] != by[:-1]])
        rank, step = fresh, step * 2
        if n == 0 or rank[order[-1]] == n - 1 or step >= n:
            return order


class FMIndex:
    """Of a text, what backward search needs: the wavelet matrix of its transform, the words, and where each begins.

    The text and the order of its suffixes are used in building and not kept.
    """

    def __init__(self, strings: list[np.ndarray]):
        """strings of 64-bit words; each ends with an end mark."""
        self.words, inverse = np.unique(np.concatenate(strings), return_inverse=True)
        lengths = np.array([len(s) for s in strings])
        ends = np.cumsum(lengths + 1) - 1
        self.size = int(ends[-1]) + 1
        text = np.zeros(self.size, np.int64)  # 0: end mark
        inner = np.ones(self.size, bool)
        inner[ends] = False
        text[inner] = inverse + 1
        unlike = text + len(strings)
        unlike[ends] = np.arange(len(strings))  # end marks differ, so suffixes do
        self.before = np.r_[0, np.cumsum(np.bincount(text, minlength=len(self.words) + 1))]
        self.tree = WaveletMatrix(text[suffix_order(unlike) - 1], len(self.words) + 1)

    def symbols(self, words: np.ndarray) -> np.ndarray:
        """0 for a word that the text doesn't have."""
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at + 1, 0)

    def matching_statistics(self, document: np.ndarray, ends: np.ndarray, threshold: int, least: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For places of a streamed document (symbols): the longest string that ends there and that the text has `least` times, up to threshold; and its interval of suffixes."""
        length = np.zeros(len(ends), np.int64)
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), self.size, np.int64)
        live = np.arange(len(ends))
        for step in range(threshold):
            live = live[ends[live] >= step]
            symbol = document[ends[live] - step]
            live, symbol = live[symbol > 0], symbol[symbol > 0]
            a = self.before[symbol] + self.tree.rank(symbol, low[live])
            b = self.before[symbol] + self.tree.rank(symbol, high[live])
            enough = b - a >= least
            live = live[enough]
            low[live], high[live] = a[enough], b[enough]
            length[live] = step + 1
            if not len(live):
                break
        return length, low, high


def repeated_windows(strings: list[bytes], docs: np.ndarray, anchors: np.ndarray) -> list[np.ndarray]:
    """For each string, by owner: which of its windows occur at an earlier place.

    The strings are streamed against the index in the order of owners, so an interval that is reported for the first
    time has its first occurrence there, and later reports of it are repeats.
    """
    found: list[np.ndarray] = []
    streamed = [np.frombuffer(s, "<u8") for s in strings]
    index = FMIndex(streamed)
    reported = np.zeros(index.size, bool)
    at = 0
    while at < len(streamed):
        upto, size = at, 0
        while upto < len(streamed) and (not size or size + len(streamed[upto]) <= AT_ONCE):
            size += len(streamed[upto])
            upto += 1
        lengths = np.array([len(s) for s in streamed[at:upto]])
        windows = lengths - WINDOW + 1
        edge = np.cumsum(windows) - windows
        ends = np.arange(windows.sum()) + np.repeat(np.cumsum(lengths) - lengths - edge, windows) + WINDOW - 1
        length, low, _ = index.matching_statistics(index.symbols(np.concatenate(streamed[at:upto])), ends, WINDOW)
        full = np.flatnonzero(length == WINDOW)
        distinct, first = np.unique(low[full], return_index=True)
        repeats = np.zeros(len(ends), bool)
        repeats[full] = True
        repeats[full[first[~reported[distinct]]]] = False
        reported[distinct] = True
        found += np.split(repeats, edge[1:])
        at = upto
    return found


def word_tokens(data: bytes) -> tuple[np.ndarray, bytes, int]:
    """64-bit hashes of the words, for anchors and for comparing."""
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(w) for w in data.split()], "<u8")  # of bytes: ASCII white space only
    return hashes, hashes.tobytes(), 8


def remove_repeats(spark: SparkSession, docs: DataFrame, texts: bool = True, **options) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, and with texts the kept words joined by one space."""

    def finish(text, cover):
        words = text.split()
        kept = words if cover is None else [w for w, c in zip(words, cover, strict=True) if not c]
        joined = b" ".join(kept)
        out = (len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest())
        return (*out, joined.decode("utf-8", "surrogatepass")) if texts else out

    corpus = Corpus(spark, docs, WINDOW, GRAM, word_tokens, False, repeated_windows, **options)
    return corpus.covered(finish, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts)
