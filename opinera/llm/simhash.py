"""SimHash near-duplicates through a Gray-order hierarchical index.

A fingerprint bit is the majority of that bit over the 64-bit hashes of all word shingles, repeats included. Fingerprints
that differ in few bits are linked, exactly, in two steps. Routing: with k bits allowed to differ, two of k + 2 blocks of
bits are the same in both, so distinct fingerprints go to one place per pair of blocks; for k = 2 a key has 32 bits, so
few distinct fingerprints share one. There, a hierarchical index: fingerprints
sorted by Gray rank (neighbours in that order differ in few bits), and the leading 8, 16, ... bits that a run shares are
factored into one node. The index is joined with itself from the root: a pair of nodes carries the differences counted
so far and is dropped with everything below it once they exceed k. What leaves a task is a spanning forest of its links,
never all pairs of a group.

Texts without words have fingerprint zero and link like others; null texts have no words. Equal texts share a
fingerprint and cost one row after the first grouping. Rows with a null id get their group's class; a group with null
ids only has a null class. An empty table gives no rows. Texts are hashed in parts, so any length will do. Columns beside
id and text are not read; keep_one_each() returns them as they are, whatever their names.
"""

from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from opinera.llm.components import smallest_reachable
from opinera.sources.staging import staged

SEED = 42
BITS = 64
#: Ways in which fingerprints far apart are brought together, and minima that estimate a likeness; see sketch().
BANDS = 10
SKETCH = 128
_MULTIPLIERS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(SKETCH)], np.uint64)
#: Node pairs that a task expands at once.
PAIRS_AT_ONCE = 1 << 18
#: Texts of loose components up to which their keys (40 bytes each) are broadcast; beyond, the texts are dealt out.
BROADCAST_KEYS = 1_000_000


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes: A-Z only, and ASCII white space only
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        found = [digest(b" ".join(words), SEED)] if words else []
    else:
        found = [digest(b" ".join(s), SEED) for s in zip(*(islice(words, i, None) for i in range(width)), strict=False)]
    return np.array(found, "<u8")


def fingerprint(hashes: np.ndarray) -> int:
    """As a signed 64-bit number."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def sketch(hashes: np.ndarray) -> tuple[list[int], bytes]:
    """Keys of the bands, and a byte of each of SKETCH minima under orders that odd multipliers give.

    Two sets agree in a minimum with the probability of their likeness s (Jaccard), so they share one of the keys, each
    of two minima, with 1 - (1 - s * s) ** BANDS, and the share of equal bytes estimates s.
    """
    if not len(hashes):
        return [0] * BANDS, bytes(SKETCH)
    least = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 2048):
        least = np.minimum(least, (hashes[at : at + 2048, None] * _MULTIPLIERS).min(axis=0))
    first = least[: 2 * BANDS].tolist()
    keys = [(a * 31 + b) % (1 << 62) for a, b in zip(first[::2], first[1::2], strict=True)]
    return keys, (least >> np.uint64(24)).astype(np.uint8).tobytes()


def alike(sketches: np.ndarray, a: np.ndarray, b: np.ndarray, likeness: float) -> np.ndarray:
    """Which pairs of rows agree in enough bytes; by chance 1 in 256 does."""
    out = np.empty(len(a), bool)
    for at in range(0, len(a), 1 << 16):
        part = slice(at, at + (1 << 16))
        out[part] = (sketches[a[part]] == sketches[b[part]]).mean(axis=1) >= likeness + (1 - likeness) / 256
    return out


def fingerprints(docs: DataFrame, id_col: str, width: int) -> DataFrame:
    """id and fp."""

    def take(batches):
        for batch in batches:
            fps = [fingerprint(shingle_hashes(t.as_py(), width)) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(fps, pa.int64())], [id_col, "fp"])

    return docs.select(F.col("text").alias("_text"), id_col).mapInArrow(take, docs.select(id_col).schema.add("fp", "long"))


def shingle_set(text: str | None, width: int) -> tuple[np.ndarray, int]:
    """Sorted distinct hashes, and a signed 64-bit number that stands for them."""
    hashes = np.unique(shingle_hashes(text, width))
    return hashes, int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).astype(np.int64))


def sketched(docs: DataFrame, id_col: str, width: int) -> DataFrame:
    """id, th (hash of the text), node (number of its set of shingles), fp, keys and sketch. Each distinct shingle counts once."""

    def take(batches):
        for batch in batches:
            nodes, fps, keys, sketches = [], [], [], []
            for t in batch.column(0):
                hashes, node = shingle_set(t.as_py(), width)
                key, least = sketch(hashes)
                nodes.append(node), fps.append(fingerprint(hashes)), keys.append(key), sketches.append(least)
            arrays = [pa.array(nodes, pa.int64()), pa.array(fps, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *arrays], [id_col, "th", "node", "fp", "keys", "sketch"])

    schema = docs.select(id_col).schema.add("th", "long").add("node", "long").add("fp", "long").add("keys", ArrayType(LongType())).add("sketch", "binary")
    return docs.select(F.col("text").alias("_text"), id_col, F.xxhash64("text").alias("th")).mapInArrow(take, schema)


def block_masks(distance: int) -> list[int]:
    """Each two of distance + 2 blocks that share out the 64 bits: of distance differing bits, two blocks at least have none."""
    edges = [BITS * i // (distance + 2) for i in range(distance + 3)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [a | b for a, b in combinations(blocks, 2)]


def _gray_rank(x: np.ndarray) -> np.ndarray:
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def _merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least labels after a and b are linked."""
    while True:
        x, y = label[a], label[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        if (low == high).all():
            return label
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]


class GrayIndex:
    """Groups of fingerprints, each sorted by Gray rank and factored into nodes of 8 more leading bits a level."""

    def __init__(self, group: np.ndarray, fps: np.ndarray):
        order = np.lexsort((_gray_rank(fps), group))
        self.order, self.fps, group = order, fps[order], group[order]
        new = np.r_[True, group[1:] != group[:-1]] if len(group) else np.zeros(0, bool)
        self.starts = [np.flatnonzero(new)]
        for bits in range(8, BITS + 1, 8):
            lead = self.fps >> np.uint64(BITS - bits)
            new = new.copy()
            new[1:] |= lead[1:] != lead[:-1]
            self.starts.append(np.flatnonzero(new))
        # rows of one fingerprint are leaves of their own, at most 256 of them or of their runs a node
        at = np.arange(len(fps)) - self.starts[-1][np.cumsum(new) - 1]
        for size in (1 << 16, 1 << 8, 1):
            if (at >= size).any():
                self.starts.append(np.flatnonzero(at % size == 0))

    def _children(self, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = np.append(self.starts[level], len(self.fps))
        first = np.searchsorted(self.starts[level + 1], ends[node])
        return first, np.searchsorted(self.starts[level + 1], ends[node + 1]) - first

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """Places (in the order given) of each row and of the one before it in its group."""
        later = np.setdiff1d(np.arange(len(self.fps)), self.starts[0])
        return self.order[later - 1], self.order[later]

    def links(self, distance: int, label: np.ndarray | None = None):
        """Pairs of places (in the order given) of rows of a group whose fingerprints are within distance, in chunks.

        With label, pairs of nodes whose rows all have one label are left out: they are linked already.
        """
        one = None
        if label is not None:
            at = label[self.order]
            one = [np.where(np.minimum.reduceat(at, s) == np.maximum.reduceat(at, s), at[s], -1 - np.arange(len(s))) if len(s) else s for s in self.starts]
        roots = np.arange(len(self.starts[0]))
        work = [(0, roots, roots, np.zeros(len(roots), np.int64))]
        while work:
            level, a, b, diff = work.pop()
            if level == len(self.starts) - 1:
                apart = a != b
                yield self.order[self.starts[level][a[apart]]], self.order[self.starts[level][b[apart]]]
                continue
            (fa, na), (fb, nb) = self._children(level, a), self._children(level, b)
            sizes = na * nb
            if len(a) > 1 and sizes.sum() > PAIRS_AT_ONCE:
                half = len(a) // 2
                work += [(level, a[half:], b[half:], diff[half:]), (level, a[:half], b[:half], diff[:half])]
                continue
            pair = np.repeat(np.arange(len(a)), sizes)
            k = np.arange(len(pair)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            x, y = fa[pair] + k // nb[pair], fb[pair] + k % nb[pair]
            now = diff[pair]
            if level < BITS // 8:
                shift = np.uint64(BITS - 8 * (level + 1))
                left = (self.fps[self.starts[level + 1][x]] ^ self.fps[self.starts[level + 1][y]]) >> shift & np.uint64(255)
                now = now + np.bitwise_count(left)
            keep = (now <= distance) & ((a[pair] != b[pair]) | (x <= y))
            if one is not None:
                keep &= one[level + 1][x] != one[level + 1][y]
                keep |= (x == y) & (one[level + 1][x] < 0)
            if keep.any():
                work.append((level + 1, x[keep], y[keep], now[keep]))


def by_blocks(rows: DataFrame, distance: int) -> DataFrame:
    """node and fp (the same), block, key, sketch (none): fingerprints within distance share a row's block and key for certain."""
    masks = [m if m < 1 << 63 else m - (1 << 64) for m in block_masks(distance)]
    places = F.array(*(F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)))
    return rows.select("fp").distinct().select("fp", F.explode(places).alias("p")).select(F.col("fp").alias("node"), "fp", "p.block", "p.key", F.lit(None).cast("binary").alias("sketch"))


def by_bands(rows: DataFrame) -> DataFrame:
    return rows.select("node", "fp", "keys", "sketch").distinct().select("node", "fp", F.posexplode("keys").alias("block", "key"), "sketch")


def fingerprint_links(placed: DataFrame, distance: int, likeness: float | None = None) -> DataFrame:
    """u, v (nodes) that join all rows of a block and key linked at distance, as a forest a task.

    With likeness, sketches have to agree to that share too.
    """
    dealt = placed.select("node", "fp", "block", "key", "sketch").repartition("block", "key")

    def link(batches):
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not len(table):
            return
        nodes, fps, block, key = (table.column(i).to_numpy() for i in range(4))
        order = np.lexsort((key, block))
        nodes, fps, block, key = nodes[order], fps[order], block[order], key[order]
        new = np.r_[True, (block[1:] != block[:-1]) | (key[1:] != key[:-1])]
        group = np.cumsum(new) - 1
        many = np.bincount(group)[group] > 1  # alone in a block: nothing to link there
        nodes, fps, group = nodes[many], fps[many], group[many]
        if likeness is not None:
            kept = table.column(4).take(pa.array(order[many])).to_pylist()
            sketches = np.frombuffer(b"".join(kept), np.uint8).reshape(len(kept), SKETCH)
        label, index = np.arange(len(fps)), GrayIndex(group, fps.view(np.uint64))

        def linked(a, b):
            apart = label[a] != label[b]
            a, b = a[apart], b[apart]
            if likeness is not None:
                near = alike(sketches, a, b, likeness)
                a, b = a[near], b[near]
            return _merged(label, a, b)

        # neighbours first: what they link, as in a tight group of copies, is not compared pair by pair
        a, b = index.neighbours()
        close = np.bitwise_count(fps.view(np.uint64)[a] ^ fps.view(np.uint64)[b]) <= distance
        label = linked(a[close], b[close])
        for a, b in index.links(distance, label):
            label = linked(a, b)
        moved = np.flatnonzero(label != np.arange(len(fps)))
        if len(moved):
            yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[label[moved]])], ["u", "v"])

    return dealt.mapInArrow(link, "u long, v long")


def _least_ids(spark: SparkSession, rows: DataFrame, roots: DataFrame, node: str, id_col: str) -> DataFrame:
    """node and component_id: the least id of the rows whose nodes have one root (u, v in roots; a node without is its own)."""
    distinct = rows.groupBy(node).agg(F.min(id_col).alias("least"))
    classes = distinct.join(roots.withColumnRenamed("u", node), node, "left").select(node, "least", F.coalesce("v", node).alias("root"))
    classes = staged(spark, classes, "classes")
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    return classes.join(least, "root").select(node, "component_id")


def near_groups(spark: SparkSession, docs: DataFrame, width: int = 3, distance: int = 2, id_col: str = "doc_id") -> DataFrame:
    """id, fp and component_id (the least id reachable) of every row of docs; every pair within distance is linked."""
    rows = staged(spark, fingerprints(docs, id_col, width), "fingerprints")
    roots = smallest_reachable(spark, fingerprint_links(by_blocks(rows, distance), distance))
    return rows.join(_least_ids(spark, rows, roots, "fp", id_col), "fp").select(id_col, "fp", "component_id")


def _classes(sets: list[np.ndarray], sketches: np.ndarray, likeness: float, loose: float) -> np.ndarray:
    """A label a set: the least place that it reaches by exact likenesses (Jaccard) of at least likeness.

    Pairs that are linked already, whose sizes rule the likeness out or whose sketches don't agree to loose aren't counted out.
    """
    n = len(sets)
    sizes, label = np.array([len(x) for x in sets]), np.arange(n)
    for i in range(n - 1):
        left = i + 1 + np.flatnonzero(label[i + 1 :] != label[i])
        left = left[np.minimum(sizes[left], sizes[i]) >= likeness * np.maximum(sizes[left], sizes[i])]
        left = left[alike(sketches, np.full(len(left), i), left, loose)]
        while len(left):
            one, left = left[:64], left[64:]
            flat = np.concatenate([sets[j] for j in one])
            place = np.minimum(np.searchsorted(sets[i], flat), sizes[i] - 1)
            shared = np.add.reduceat((sets[i][place] == flat).astype(np.int64), np.cumsum(sizes[one]) - sizes[one])
            for j in one[shared >= likeness * (sizes[one] + sizes[i] - shared) - 1e-9]:
                low, high = sorted((label[i], label[j]))
                label[label == high] = low
            left = left[label[left] != label[i]]
    return label


def confirmed(docs: DataFrame, rows: DataFrame, loosely: DataFrame, width: int, id_col: str, likeness: float, loose: float) -> DataFrame:
    """u, v (nodes): v is the least of the nodes that u reaches by exact likenesses, inside its loose component (u, v in loosely).

    Sets of shingles are made once for a text of each node in a component, and each travels once, to its component's place.
    """
    members = loosely.unionAll(loosely.select(F.col("v").alias("u"), "v")).distinct().withColumnsRenamed({"u": "node", "v": "root"})
    # summed before the join, so that a node with many rows moves one row a task
    one = rows.groupBy("node").agg(F.max(F.struct(F.col(id_col).alias("id"), "th")).alias("r")).join(members, "node")
    one = one.select("root", F.col("r.id").alias("_id"), F.col("r.th").alias("_th"), F.col("node").alias("_node"))
    one = staged(docs.sparkSession, one, "members")
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64("text").alias("th"), "text")
    few = one.count() <= BROADCAST_KEYS
    found = texts.join(F.broadcast(one) if few else one, F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))).select("text", "root", "_node")

    def take(batches):
        for batch in batches:
            nodes, sketches, sets = [], [], []
            for t in batch.column(0):
                hashes, node = shingle_set(t.as_py(), width)
                nodes.append(node), sketches.append(sketch(hashes)[1]), sets.append(hashes.tobytes())
            made = pa.RecordBatch.from_arrays([batch.column(1), pa.array(nodes, pa.int64()), pa.array(sketches, pa.binary()), pa.array(sets, pa.binary())], ["root", "node", "sketch", "set"])
            yield made.filter(pa.array(np.array(nodes) == batch.column(2).to_numpy(), pa.bool_()))  # of unlike texts with one hash

    def close(held):
        nodes = sorted(held)
        sketches = np.frombuffer(b"".join(held[k][0] for k in nodes), np.uint8).reshape(len(nodes), SKETCH)
        label = _classes([np.frombuffer(held[k][1], "<u8") for k in nodes], sketches, likeness, loose)
        moved = np.flatnonzero(label != np.arange(len(nodes)))
        ids = np.array(nodes, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[label[moved]])], ["u", "v"])

    def confirm(batches):
        root, held = None, {}
        for batch in batches:
            for r, node, least, hashes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r != root:
                    if len(held) > 1:
                        yield close(held)
                    root, held = r, {}
                held[node] = least, hashes
        if len(held) > 1:
            yield close(held)

    sets = found.mapInArrow(take, "root long, node long, sketch binary, set binary")
    return sets.repartition("root").sortWithinPartitions("root").mapInArrow(confirm, "u long, v long")


def alike_groups(spark: SparkSession, docs: DataFrame, width: int, distance: int, likeness: float, loose: float, id_col: str = "doc_id") -> DataFrame:
    """id and component_id (the least id reachable) of every row of docs; texts are linked whose sets of shingles have that likeness.

    Candidates share a band key, have fingerprints within distance and sketches that agree to loose; in the components that
    these make, exact likenesses decide.
    """
    rows = staged(spark, sketched(docs, id_col, width), "sketches")
    loosely = smallest_reachable(spark, fingerprint_links(by_bands(rows), distance, loose))
    roots = staged(spark, confirmed(docs, rows, loosely, width, id_col, likeness, loose), "roots")
    return rows.select(id_col, "node").join(_least_ids(spark, rows, roots, "node", id_col), "node").select(id_col, "component_id")


def keep_one_each(spark: SparkSession, docs: DataFrame, width: int = 5, distance: int = 28, likeness: float = 0.8, loose: float = 0.6) -> DataFrame:
    """docs without those that a document with a smaller id is near to, directly or through others.

    Near are sets of five-word shingles of a Jaccard of 0.8 and more, counted out exactly. Rows with a null id stay.
    """
    groups = alike_groups(spark, docs, width, distance, likeness, loose)
    gone = staged(spark, groups.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
