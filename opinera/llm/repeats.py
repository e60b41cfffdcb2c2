"""Where windows of tokens repeat across a corpus: the way of rows between an index's shards and the documents.

Every window of `window` consecutive tokens has an anchor: its gram of `gram` tokens with the least hash, leftmost of
ties. Equal windows have equal anchors, so windows need only be compared under the same anchor. Consecutive windows
mostly share theirs; such a run is one row.

1. Runs go to buckets by anchor. An anchor that occurs once (or, if asked, in one document) can't repeat; its runs end here.
2. The other runs get their tokens from their documents and go to shards by anchor. Equal token strings collapse: the
   first occurrence (least document, then place) owns the string, and the windows of the others repeat the owner's.
3. Each shard builds its index over the distinct strings and finds which windows of owners also start earlier.
4. What repeats goes back to the documents.

A string goes into its shard's index only if it shares with another distinct string what every common window of the two
covers around the anchor; else there is nothing that it could repeat.

Hot groups. An anchor that occurs often in one batch of a task is settled there: its runs go straight on, and two marks
tell its bucket that it repeats. Equal strings of a batch are settled there as well: one of them travels, the others are
known to repeat it. So a common line costs its bucket a few rows a batch, not a row for each document. Where an anchor has
more than an eighth of its bucket's runs (8 a bucket at most, so the list is bounded), its windows are dealt out once
more, by their own hash, and meet only with equal ones. Tasks hold one bucket at a time.

Between tasks, runs travel as packed arrays, a row for each bucket and batch. Ids are 64-bit; null ids come before others
and count as one id. A document is an id and a text: rows that are equal in both are judged alike, and of rows with one id
and unlike texts each has its own spans, in the order of a hash of their texts. A 64-bit hash stands for the text there.
"""

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from opinera.sources.staging import drop_folder, new_folder

NULL_ID = -(1 << 63)
#: Tokens hashed at once; longer documents are cut into overlapping parts, which changes no window.
PART = 1 << 18
#: Runs held before they are packed and sent.
HELD = 1 << 18
#: Occurrences in one batch from which an anchor is settled there.
OFTEN = 8
#: Runs of an anchor, beside an eighth of its bucket's, from which its windows are dealt out by their own hash.
HOT = 4096
_MASK = np.uint64((1 << 22) - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: kind 0: for the shard b; 1: runs or verdicts for the documents of bucket b; 2: hot anchors.
_PACKED = "b int, kind int, blob binary"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_RUNS = ["<i8", "<u8", "<u4", "<u2", "<u4"]
#: Parts into which the tokens beside an anchor are cut to see what common windows cover; see sharing().
PARTS = 4


def pack(arrays: list[np.ndarray], level: int = 1) -> bytes:
    head = b"".join(a.dtype.str.ljust(4).encode() + len(a).to_bytes(8, "little") for a in arrays)
    return zstandard.ZstdCompressor(level=level).compress(bytes([len(arrays)]) + head + b"".join(a.tobytes() for a in arrays))


def unpack(blob: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    out, at = [], 1 + 12 * data[0]
    for i in range(data[0]):
        kind, n = np.dtype(data[1 + 12 * i : 5 + 12 * i].decode().strip()), int.from_bytes(data[5 + 12 * i : 13 + 12 * i], "little")
        out.append(np.frombuffer(data, kind, n, at))
        at += n * kind.itemsize
    return out


def gathered(blobs: list[bytes], kinds: list[str]) -> list[np.ndarray]:
    parts = [unpack(b) for b in blobs]
    return [np.concatenate([p[i] for p in parts]) if parts else np.empty(0, k) for i, k in enumerate(kinds)]


def gram_hashes(x: np.ndarray, gram: int) -> np.ndarray:
    """Rolling hashes of `gram` consecutive 64-bit values, by joining hashes of doubling length."""
    base, size, powers = 0x9E3779B97F4A7C15, 1, {}
    h, done, length = x, None, 0
    while True:
        if gram & size:
            if done is None:
                done, length = h, size
            else:
                n = len(h) - length if len(h) > length else 0
                done = done[:n] * powers.setdefault(size, np.uint64(pow(base, size, 1 << 64))) + h[length : length + n]
                length += size
        size *= 2
        if size > gram:
            break
        half = size // 2
        h = h[: max(0, len(h) - half)] * np.uint64(pow(base, half, 1 << 64)) + h[half:]
    out = done.copy()
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x, span = np.minimum(x[:-span], x[span:]), span * 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if span < width else x


def anchor_runs(x: np.ndarray, ends: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, windows and anchor of each run in x, a row of documents that end at `ends`."""
    none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    if len(x) < window:
        return none
    h = gram_hashes(x, gram)
    ranked = (h & ~_MASK) | np.arange(len(h), dtype=np.uint64)
    at = (sliding_least(ranked, window - gram + 1) & _MASK).astype(np.int64)
    end_of = np.repeat(ends, np.diff(np.r_[0, ends]))[: len(at)]
    starts = np.flatnonzero(np.arange(len(at)) + window <= end_of)
    if not len(starts):
        return none
    at = at[starts]
    new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return starts[new], np.diff(np.r_[new, len(at)]), h[at[new]]


def document_runs(batch: Iterator[tuple[int, int, np.ndarray]], window: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """id, text hash, start, windows, anchor of the runs of (id, text hash, 64-bit tokens) documents."""
    held, size = [], 0

    def flush():
        ends = np.cumsum([len(h[3]) for h in held])
        start, n, anchor = anchor_runs(np.concatenate([h[3] for h in held]), ends, window, gram)
        which = np.searchsorted(ends, start, side="right")
        begin = np.r_[0, ends[:-1]]
        docs, hashes, offsets = (np.array([h[i] for h in held], k) for i, k in enumerate((np.int64, np.uint64, np.int64)))
        return docs[which], hashes[which], (start - begin[which] + offsets[which]).astype(np.uint32), n.astype(np.uint16), anchor

    for doc, th, tokens in batch:
        for offset in range(0, max(1, len(tokens) - window + 1), PART):
            part = tokens[offset : offset + PART + window - 1]
            if len(part) < window:
                continue
            if held and size + len(part) > PART:
                yield flush()
                held, size = [], 0
            held.append((doc, th, offset, part))
            size += len(part)
    if held:
        yield flush()


def bucket_of(ids: np.ndarray, buckets: int) -> np.ndarray:
    """As id_bucket() has it."""
    distinct, back = np.unique(ids, return_inverse=True)
    return np.array([zlib.crc32(b"" if i == NULL_ID else str(i).encode()) % buckets for i in distinct.tolist()], np.int64)[back]


def id_bucket(buckets: int):
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(buckets)).cast("int")


def _rows(bucket: list[int], kind: int, blobs: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array([kind] * len(blobs), pa.int32()), pa.array(blobs, pa.binary())], ["b", "kind", "blob"])


def _cuts(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and size of each run of equal values."""
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.empty(0, np.int64)
    return first, np.diff(np.r_[first, len(ordered)])


def _dealt(bucket: np.ndarray, kind: int, arrays: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """A packed row for each bucket."""
    for at in range(0, len(bucket), HELD):
        part = bucket[at : at + HELD]
        order = np.argsort(part, kind="stable")
        first, size = _cuts(part[order])
        own = [a[at : at + HELD][order] for a in arrays]
        yield _rows(part[order][first].tolist(), kind, [pack([a[i : i + n] for a in own]) for i, n in zip(first.tolist(), size.tolist(), strict=True)])


class _Outbox:
    """Rows for the documents, of many buckets, packed together."""

    def __init__(self, buckets: int):
        self.buckets, self.held, self.size = buckets, [], 0

    def add(self, arrays: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        self.held.append(arrays)
        self.size += len(arrays[0])
        if self.size >= HELD:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            arrays = [np.concatenate(c) for c in zip(*self.held, strict=True)]
            self.held, self.size = [], 0
            yield from _dealt(bucket_of(arrays[0], self.buckets), 1, arrays)


def _codes(anchor: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each anchor, and 32 other bits of it that tell the anchors of a bucket apart. Anchors that share both
    only cost work: strings are compared as such."""
    mixed = anchor * _ODD
    return ((mixed & np.uint64(0xFFFFFFFF)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64), (mixed >> np.uint64(32)).astype(np.uint32)


def sharing(strings: list[bytes], places: np.ndarray, width: int, window: int, gram: int) -> np.ndarray:
    """The strings that may have a window in common with another. places: of the anchor, in tokens.

    A common window has the anchor and window - gram tokens beside it, l of them before. Whatever l is, it lies in one of
    PARTS ranges, and the window covers the least l of the range before the anchor and window - gram less the greatest after.
    """
    beside = window - gram
    edges = [beside * k // PARTS for k in range(PARTS + 1)]
    spans = [(width * low, width * (gram + beside - high)) for low, high in zip(edges, edges[1:], strict=False)]
    seen: dict[int, int] = {}
    found = np.zeros(len(strings), bool)
    for i, (text, at) in enumerate(zip(strings, (places * width).tolist(), strict=True)):
        for k, (before, after) in enumerate(spans):
            if before <= at and at + after <= len(text):
                first = seen.setdefault(hash((k, text[at - before : at + after])), i)
                if first != i:
                    found[first] = found[i] = True
    return np.flatnonzero(found)


def _documents(ids: pa.Array, texts: pa.Array) -> Iterator[tuple[int, int, bytes]]:
    """id, hash of the text and its UTF-8 bytes; null texts are empty."""
    for i, t in zip(ids.to_pylist(), texts, strict=True):
        found = t.as_buffer() if t.is_valid else None
        data = found.to_pybytes() if found is not None else b""
        yield NULL_ID if i is None else i, xxhash.xxh64_intdigest(data), data


def _by_bucket(batches) -> Iterator[tuple[int, list[bytes], list[bytes]]]:
    """b, blobs of kind 0 and others of a partition ordered by b, one bucket at a time."""
    now, mine, others = None, [], []
    for batch in batches:
        for b, kind, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if b != now and now is not None:
                yield now, mine, others
                mine, others = [], []
            now = b
            (others if kind else mine).append(blob)
    if now is not None:
        yield now, mine, others


def _anchors(grams: np.ndarray, start: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the windows that start there, from the hashes of a document's grams; and its place in the window."""
    place = np.empty(len(start), np.int64)
    for i in range(0, len(start), 1 << 14):
        place[i : i + (1 << 14)] = np.argmin(grams[start[i : i + (1 << 14), None] + np.arange(span)] & ~_MASK, axis=1)
    return grams[start + place], place


def _owned(doc, th, start, runs: np.ndarray, owners: np.ndarray, across: bool) -> np.ndarray:
    """Which runs don't repeat the owner of their string: across, those of its id; else the owner and rows equal to its row."""
    same = doc[runs] == doc[owners]
    return same if across else same & (th[runs] == th[owners]) & (start[runs] == start[owners])


class Corpus:
    """The steps for one kind of token.

    tokens: UTF-8 bytes -> (64-bit values for hashing, the tokens' bytes as they are compared, bytes a token).
    across: only repeats from a smaller id count, not those from the same one.
    index: (distinct strings, id of each, anchor of each), by owner, of those that may have a window in common -> for each a mask of windows that repeat.
    """

    def __init__(self, spark: SparkSession, docs: DataFrame, window: int, gram: int, tokens: Callable, across: bool, index: Callable, hot: int = HOT):
        self.spark, self.docs, self.window, self.gram = spark, docs.select("doc_id", "text"), window, gram
        self.tokens, self.across, self.index, self.hot = tokens, across, index, hot
        self.tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.buckets = 4 * self.tasks

    def _kept(self, frame: DataFrame, name: str) -> tuple[DataFrame, str]:
        """frame as a written table. Its shuffle files go with the end of the write: nothing reads them again."""
        path, before = new_folder(self.spark, name), self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            frame.write.parquet(path)
        finally:
            self.spark.conf.set(_CLEANUP, before) if before is not None else self.spark.conf.unset(_CLEANUP)
        return self.spark.read.schema(frame.schema).parquet(path), path

    def _dealt_out(self, packed: DataFrame) -> DataFrame:
        return packed.repartition(self.tasks, "b").sortWithinPartitions("b")

    def _runs(self) -> DataFrame:
        tokens, window, gram, buckets, across = self.tokens, self.window, self.gram, self.buckets, self.across

        def settled(parts):
            doc, th, start, n, anchor = (np.concatenate(c) for c in zip(*parts, strict=True))
            bucket, anchor = _codes(anchor, buckets)
            whole = bucket << 32 | anchor
            order = np.argsort(whole, kind="stable")
            first, size = _cuts(whole[order])
            often = size >= OFTEN
            if not often.any():
                yield from _dealt(bucket, 0, [doc, th, start, n, anchor])
                return
            own = doc[order]
            least, most = np.minimum.reduceat(own, first), np.maximum.reduceat(own, first)
            often &= (least != most) | (not across)
            at = np.flatnonzero(often)
            known = np.repeat(often, size)
            here = order[known]
            yield from _dealt(bucket_of(doc[here], buckets), 1, [doc[here], th[here], start[here], n[here]])
            rest, marked, zero = order[~known], order[first[at]], np.zeros(2 * len(at), np.uint64)
            # marks have no windows; the first of the two says how many runs it stands for
            rows = [np.r_[doc[rest], least[at], most[at]], np.r_[th[rest], zero], np.r_[start[rest], size[at].astype(np.uint32), zero[: len(at)].astype(np.uint32)], np.r_[n[rest], zero.astype(np.uint16)], np.r_[anchor[rest], anchor[marked], anchor[marked]]]
            yield from _dealt(np.r_[bucket[rest], bucket[marked], bucket[marked]], 0, rows)

        def find(batches):
            def documents():
                for batch in batches:
                    for doc, th, data in _documents(batch.column(0), batch.column(1)):
                        yield doc, th, tokens(data)[0]

            held, size = [], 0
            for part in document_runs(documents(), window, gram):
                held.append(part)
                size += len(part[0])
                if size >= HELD:
                    yield from settled(held)
                    held, size = [], 0
            if size:
                yield from settled(held)

        return self.docs.mapInArrow(find, _PACKED)

    def _repeated(self, runs: DataFrame) -> DataFrame:
        """Kind 1: the runs whose anchor occurs elsewhere, by bucket of document. Kind 2: hot anchors and their runs."""
        buckets, across, hot = self.buckets, self.across, self.hot

        def keep(batches):
            outbox = _Outbox(buckets)
            for b, mine, others in _by_bucket(batches):
                if others:
                    yield _rows([b] * len(others), 1, others)
                doc, th, start, n, anchor = gathered(mine, _RUNS)
                if not len(doc):
                    continue
                order = np.argsort(anchor, kind="stable")
                first, size = _cuts(anchor[order])
                if across:
                    own = doc[order]
                    many = np.minimum.reduceat(own, first) != np.maximum.reduceat(own, first)
                else:
                    many = size > 1
                kept = order[np.repeat(many, size)]
                kept = kept[n[kept] > 0]
                yield from outbox.add([doc[kept], th[kept], start[kept], n[kept]])
                runs = np.add.reduceat(np.where(n > 0, 1, start.astype(np.int64))[order], first)
                large = np.flatnonzero((runs >= hot) & (runs * 8 > runs.sum()))
                if len(large):
                    yield _rows([b], 2, [pack([b << 32 | anchor[order][first[large]].astype(np.int64), runs[large]])])
            yield from outbox.rest()

        return self._dealt_out(runs).mapInArrow(keep, _PACKED)

    def _with_documents(self, packed: DataFrame) -> DataFrame:
        """Packed rows of a bucket of documents, then its documents, bucket by bucket."""
        docs = self.docs.select(id_bucket(self.buckets).alias("b"), F.lit(1).alias("k"), F.lit(None).cast("binary").alias("blob"), "doc_id", "text")
        rows = packed.where("kind = 1").select("b", F.lit(0).alias("k"), "blob", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"))
        return rows.unionAll(docs).repartition(self.tasks, "b").sortWithinPartitions("b", "k")

    def _strings(self, repeated: DataFrame) -> DataFrame:
        """Kind 0: token strings of runs, by bucket of anchor. Kind 1: runs that repeat another of their batch, by bucket of document."""
        tokens, window, gram, buckets, across, hot = self.tokens, self.window, self.gram, self.buckets, self.across, self.hot
        listed = [unpack(r["blob"]) for r in repeated.where("kind = 2").select("blob").collect()]  # 8 anchors a bucket at most
        hot_anchor, hot_runs = (np.concatenate([x[i] for x in listed]) if listed else np.empty(0, k) for i, k in enumerate((np.int64, np.int64)))
        ordered = np.argsort(hot_anchor)
        hot_anchor, salts = hot_anchor[ordered], (hot_runs[ordered] * 8 // hot + 1).astype(np.uint64)

        def single(hashed, whole, start, n, place):
            """Each window of the runs of hot anchors, under an anchor of its own."""
            salt = salts[np.searchsorted(hot_anchor, whole)]
            at = np.repeat(start - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            own = gram_hashes(hashed, window)[at] % np.repeat(salt, n)
            bucket, code = _codes(np.repeat(whole, n).astype(np.uint64) ^ (own + np.uint64(1)) * _ODD, buckets)
            return bucket << 32 | code, at, np.ones(len(at), np.int64), np.repeat(start + place, n) - at

        def cut(batches):
            held, strings = [], []
            for doc, th, found, data in per_document(batches):
                if found is None:
                    continue
                hashed, raw, width = tokens(data)
                start, n = (a.astype(np.int64) for a in found[2:])
                anchor, place = _anchors(gram_hashes(hashed, gram), start, window - gram + 1)
                bucket, code = _codes(anchor, buckets)
                whole = bucket << 32 | code
                if len(hot_anchor):
                    warm = hot_anchor[np.minimum(np.searchsorted(hot_anchor, whole), len(hot_anchor) - 1)] == whole
                    if warm.any():
                        more = single(hashed, whole[warm], start[warm], n[warm], place[warm])
                        whole, start, n, place = (np.r_[a[~warm], b] for a, b in zip((whole, start, n, place), more, strict=True))
                held.append((np.full(len(start), doc, np.int64), np.full(len(start), th, np.uint64), start, n, whole, place))
                strings += [raw[width * s : width * (s + k + window - 1)] for s, k in zip(start.tolist(), n.tolist(), strict=True)]
                if len(strings) >= HELD // 4:
                    yield from send(held, strings)
                    held, strings = [], []
            if strings:
                yield from send(held, strings)

        def send(held, strings):
            doc, th, start, n, whole, place = (np.concatenate(c) for c in zip(*held, strict=True))
            known: dict[bytes, int] = {}
            which = np.array([known.setdefault(t, len(known)) for t in strings], np.int64)
            order = np.lexsort((start, th, doc, which))
            first, size = _cuts(which[order])
            copy = ~_owned(doc, th, start, order, np.repeat(order[first], size), across)
            gone = order[copy]
            yield from _dealt(bucket_of(doc[gone], buckets), 1, [doc[gone], th[gone], start[gone].astype(np.uint32), n[gone].astype(np.uint32)])
            left = np.sort(order[~copy])
            bucket = whole[left] >> 32
            by = np.argsort(bucket, kind="stable")
            begin, size = _cuts(bucket[by])
            for i, k in zip(begin.tolist(), size.tolist(), strict=True):
                rows = left[by[i : i + k]]
                distinct, local = np.unique(which[rows], return_inverse=True)
                of = rows[np.unique(local, return_index=True)[1]]
                texts = [strings[j] for j in of.tolist()]
                arrays = [doc[rows], th[rows], start[rows].astype(np.uint32), n[rows].astype(np.uint16), local.astype(np.uint32), (whole[of] & 0xFFFFFFFF).astype(np.uint32), place[of].astype(np.uint16)]
                arrays += [np.array([len(t) for t in texts], np.uint32), np.frombuffer(b"".join(texts), np.uint8)]
                yield _rows([int(bucket[by[i]])], 0, [pack(arrays, 3)])

        return self._with_documents(repeated).mapInArrow(cut, _PACKED)

    def _verdicts(self, strings: DataFrame) -> DataFrame:
        """id, text hash, first window and number of windows of what repeats, by bucket of document."""
        buckets, across, index, window, gram, width = self.buckets, self.across, self.index, self.window, self.gram, self.tokens(b"")[2]

        def judged(blobs):
            known: dict[bytes, int] = {}
            anchors, places, parts = [], [], []
            for blob in blobs:
                doc, th, start, n, which, anchor, at, lengths, flat = unpack(blob)
                edges, data = np.r_[0, np.cumsum(lengths, dtype=np.int64)].tolist(), flat.tobytes()
                local = np.array([known.setdefault(data[a:b], len(known)) for a, b in zip(edges, edges[1:], strict=False)], np.int64)
                fresh = np.unique(local, return_index=True)
                new = fresh[1][fresh[0] >= len(anchors)]
                anchors += anchor[new].tolist()
                places += at[new].tolist()
                parts.append((doc, th, start.astype(np.int64), n.astype(np.int64), local[which]))
            doc, th, start, n, which = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.lexsort((start, th, doc, which))
            first, size = _cuts(which[order])
            owner = order[first]  # the owner's run of each string
            place = np.lexsort((start[owner], th[owner], doc[owner]))
            keys = list(known)
            some = sharing(keys, np.array(places, np.int64), width, window, gram)
            some = place[np.isin(place, some)]
            masks = index([keys[i] for i in some], doc[owner][some], np.array(anchors, np.uint64)[some]) if len(some) else []
            own = np.empty(len(doc), bool)
            own[order] = _owned(doc, th, start, order, np.repeat(owner, size), across)
            out = [(doc[~own], th[~own], start[~own], n[~own])]
            mask_of = {i: m for i, m in zip(some.tolist(), masks, strict=True) if m.any()}
            for i in np.flatnonzero(own & np.isin(which, list(mask_of))).tolist():
                mask = mask_of.get(int(which[i]))
                if mask is not None:
                    edge = np.flatnonzero(np.diff(np.r_[0, mask.astype(np.int8), 0]))
                    out.append((np.full(len(edge) // 2, doc[i]), np.full(len(edge) // 2, th[i]), start[i] + edge[::2], edge[1::2] - edge[::2]))
            return [np.concatenate(c) for c in zip(*out, strict=True)]

        def judge(batches):
            outbox = _Outbox(buckets)
            for b, mine, others in _by_bucket(batches):
                if others:
                    yield _rows([b] * len(others), 1, others)
                if mine:
                    doc, th, start, n = judged(mine)
                    yield from outbox.add([doc, th, start.astype(np.uint32), n.astype(np.uint32)])
            yield from outbox.rest()

        return self._dealt_out(strings).mapInArrow(judge, _PACKED)

    def covered(self, finish: Callable, schema: str) -> DataFrame:
        """finish(bytes of the text, mask of covered tokens or None) -> a row of schema after the id, for every document."""
        tokens, window = self.tokens, self.window
        repeated, path = self._kept(self._repeated(self._runs()), "runs")
        strings, more = self._kept(self._strings(repeated), "strings")
        drop_folder(self.spark, path)
        verdicts, _ = self._kept(self._verdicts(strings), "verdicts")
        drop_folder(self.spark, more)
        names = [f.split()[0] for f in schema.split(", ")]

        def close(batches):
            out = []
            for doc, _, found, data in per_document(batches):
                cover = None
                if found is not None:
                    _, raw, width = tokens(data)
                    steps = np.zeros(len(raw) // width + 1, np.int32)
                    start, n = (a.astype(np.int64) for a in found[2:])
                    np.add.at(steps, start, 1)
                    np.add.at(steps, start + n + window - 1, -1)
                    cover = np.cumsum(steps[:-1]) > 0
                out.append((None if doc == NULL_ID else doc, *finish(data, cover)))
                if len(out) == 2000:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=kinds)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=kinds)

        kinds = to_arrow_schema(self.spark.createDataFrame([], schema).schema)
        return self._with_documents(verdicts).mapInArrow(close, schema)


def per_document(batches) -> Iterator[tuple[int, int, list[np.ndarray] | None, bytes]]:
    """id, text hash, its packed rows (id, text hash, start, windows) or None, and text of the documents of a partition.

    Rows come bucket by bucket, the packed ones of a bucket first.
    """
    now, blobs, arrays, begins = None, [], None, {}
    for batch in batches:
        b, kind, packed = (batch.column(i).to_pylist() for i in range(3))
        documents = _documents(batch.column(3), batch.column(4))
        for bucket, k, blob, (doc, th, data) in zip(b, kind, packed, documents, strict=True):
            if bucket != now:
                now, blobs, arrays, begins = bucket, [], None, {}
            if k == 0:
                blobs.append(blob)
                continue
            if arrays is None:
                arrays = gathered(blobs, ["<i8", "<u8", "<u4", "<u4"])
                order = np.lexsort((arrays[1], arrays[0]))
                arrays, blobs = [a[order] for a in arrays], []
                first = np.flatnonzero(np.r_[True, (arrays[0][1:] != arrays[0][:-1]) | (arrays[1][1:] != arrays[1][:-1])]) if len(order) else order
                ends = np.append(first[1:], len(order))[: len(first)]
                begins = dict(zip(zip(arrays[0][first].tolist(), arrays[1][first].tolist(), strict=True), zip(first.tolist(), ends.tolist(), strict=True), strict=True))
            at = begins.get((doc, th))
            yield doc, th, None if at is None else [a[at[0] : at[1]] for a in arrays], data
