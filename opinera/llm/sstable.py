"""Sorted-string-table shards of token ids.

Documents are range-partitioned by identifier; each task sorts its range, encodes it and writes one file. A file is

    blocks | bloom | index | footer (64 bytes)

A block holds entries sorted by key. An entry is varint(shared) varint(rest) varint(ids) key-rest, then the ids as
little-endian unsigned 16- or 32-bit numbers: the key is prefix-compressed against the entry before. Every 16th entry
starts afresh. Each block is a zlib frame. The sparse index has one entry a block: first key, place, length, entries.
The Bloom filter answers most lookups of missing keys without a block. The footer has the places of both and the totals.

Keys are 9 bytes: 0 for null or 1, then the id in big-endian order with the sign bit turned, so bytes sort as ids do.
Repeated ids stay, ordered by text. Null texts have no ids but the end id; texts may have any length, and an entry is as
long as its document. An empty table gives no file and no rows. Other columns are not read.
Files are written under a name of the task's attempt and then renamed: a task that runs again puts the same bytes there.
"""

import bisect
import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinera.llm.tokens import encoder
from opinera.sources.staging import new_folder

MAGIC = 0x4F50535354424C31
RESTART = 16
BLOCK_BYTES = 64 * 1024
BLOOM_BITS = 10
BLOOM_HASHES = 7
#: Documents of a shard, about, so that what its writer holds doesn't grow with the corpus.
SHARD_ROWS = 50_000


def key_bytes(doc_id: int | None) -> bytes:
    return bytes(9) if doc_id is None else b"\x01" + struct.pack(">Q", doc_id + (1 << 63))


def key_id(key: bytes) -> int | None:
    return struct.unpack(">Q", key[1:])[0] - (1 << 63) if key[0] else None


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _bloom_places(key: bytes, bits: int) -> list[int]:
    a, b = zlib.crc32(key), zlib.crc32(key, 0x9E3779B9) | 1
    return [(a + i * b) % bits for i in range(BLOOM_HASHES)]


class TableWriter:
    """Streams sorted (key, ids) to a file; holds one block, the sparse index and the keys' hashes."""

    def __init__(self, out, width: int):
        self.out, self.width, self.at = out, width, 0
        self.block, self.entries, self.last, self.first = io.BytesIO(), 0, b"", b""
        self.index: list[tuple[bytes, int, int, int]] = []
        self.keys: list[bytes] = []
        self.docs = self.ids = 0

    def add(self, key: bytes, ids: np.ndarray) -> None:
        if self.last and key < self.last and self.keys:
            raise ValueError("keys must ascend")
        shared = 0
        if self.entries % RESTART:
            while shared < 9 and key[shared] == self.last[shared]:
                shared += 1
        if not self.entries:
            self.first = key
        self.block.write(_varint(shared) + _varint(9 - shared) + _varint(len(ids)) + key[shared:])
        self.block.write(ids.astype(f"<u{self.width}").tobytes())
        self.entries, self.last = self.entries + 1, key
        if not self.keys or self.keys[-1] != key:
            self.keys.append(key)
        self.docs, self.ids = self.docs + 1, self.ids + len(ids)
        if self.block.tell() >= BLOCK_BYTES:
            self._flush()

    def _write(self, data: bytes) -> tuple[int, int]:
        place = (self.at, len(data))
        self.out.write(data)
        self.at += len(data)
        return place

    def _flush(self) -> None:
        if self.entries:
            self.index.append((self.first, *self._write(zlib.compress(self.block.getvalue(), 1)), self.entries))
            self.block, self.entries = io.BytesIO(), 0

    def close(self) -> None:
        self._flush()
        bits = max(64, len(self.keys) * BLOOM_BITS)
        bloom = bytearray(-(-bits // 8))
        for key in self.keys:
            for p in _bloom_places(key, bits):
                bloom[p >> 3] |= 128 >> (p & 7)
        bloom_at = self._write(bytes(bloom))
        index_at = self._write(b"".join(key + struct.pack("<QQQ", *rest) for key, *rest in self.index))
        self._write(struct.pack("<8Q", *bloom_at, bits, *index_at, self.docs, self.ids << 8 | self.width, MAGIC))


class TableReader:
    """Reads one file; lookups take the Bloom filter, a binary search of the index, then one block."""

    def __init__(self, source):
        self.source = source
        source.seek(source.size() - 64)
        bloom_at, bloom_n, self.bits, index_at, index_n, self.docs, ids, magic = struct.unpack("<8Q", source.read(64))
        if magic != MAGIC:
            raise ValueError("not a table file")
        self.ids, self.width = ids >> 8, ids & 255
        self.bloom = self._part(bloom_at, bloom_n)
        raw = self._part(index_at, index_n)
        self.index = [(raw[i : i + 9], *struct.unpack("<QQQ", raw[i + 9 : i + 33])) for i in range(0, len(raw), 33)]

    def _part(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def _entries(self, block: int) -> Iterator[tuple[bytes, np.ndarray]]:
        _, at, n, entries = self.index[block]
        data, place, key = zlib.decompress(self._part(at, n)), 0, b""
        for _ in range(entries):
            shared, place = _read_varint(data, place)
            rest, place = _read_varint(data, place)
            count, place = _read_varint(data, place)
            key = key[:shared] + data[place : place + rest]
            place += rest
            yield key, np.frombuffer(data, f"<u{self.width}", count, place)
            place += count * self.width

    def __iter__(self) -> Iterator[tuple[bytes, np.ndarray]]:
        for block in range(len(self.index)):
            yield from self._entries(block)

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of every document of that identifier."""
        key = key_bytes(doc_id)
        if any(not self.bloom[p >> 3] >> (7 - (p & 7)) & 1 for p in _bloom_places(key, self.bits)):
            return []
        block = max(0, bisect.bisect_left(self.index, (key,)) - 1)
        found = []
        while block < len(self.index) and self.index[block][0] <= key:
            found += [ids for k, ids in self._entries(block) if k == key]
            block += 1
        return found


def _store(uri: str):
    return pyarrow.fs.FileSystem.from_uri(uri)


def open_table(uri: str) -> TableReader:
    fs, path = _store(uri)
    return TableReader(fs.open_input_file(path))


def write_tables(spark: SparkSession, docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, partitions: int | None = None) -> DataFrame:
    """One file a range of doc_id in folder. Rows: shard, path, docs, ids, first and last (keys) of each file, in key order by shard."""
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // SHARD_ROWS))
    ordered = docs.select("doc_id", "text").repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())

    def write(batches):
        enc, writer, shard = encoder(tokenizer_path), None, TaskContext.get().partitionId()
        width = 2 if len(enc.id_bytes) <= 1 << 16 else 4
        end = np.array([end_id], "<u4")
        path = f"{folder}/shard-{shard:06d}.sst"
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if writer is None:
                    fs, place = _store(folder)
                    fs.create_dir(place, recursive=True)
                    at = f"{place}/.{shard}-{uuid.uuid4().hex}"
                    out = fs.open_output_stream(at)
                    writer = TableWriter(out, width)
                writer.add(key_bytes(doc_id), np.concatenate([np.frombuffer(enc.encode(text.as_py()), "<u4"), end]))
        if writer is not None:
            writer.close()
            out.close()
            fs.move(at, f"{place}/shard-{shard:06d}.sst")
            yield pa.RecordBatch.from_pylist([{"shard": shard, "path": path, "docs": writer.docs, "ids": writer.ids, "first": writer.index[0][0], "last": writer.last}])

    return ordered.mapInArrow(write, "shard long, path string, docs long, ids long, first binary, last binary")


def read_tables(tables: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files. tables: shard, path, start (ids before the file)."""

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                start, out = row["start"], []
                for key, ids in open_table(row["path"]):
                    out.append((key_id(key), start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                    if len(out) == 10_000:
                        yield _batch(out)
                        out = []
                if out:
                    yield _batch(out)

    def _batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tables.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


#: Files that a task of find_documents() holds open.
OPEN_FILES = 8


def find_documents(spark: SparkSession, files: list, ids: DataFrame) -> DataFrame:
    """doc_id and tokens of each document of the files that has one of the ids (a column doc_id), by lookups.

    files: rows of write_tables(), one a file. An id finds its files by binary search of their first keys, then the Bloom
    filter and the block index of each answer; ids come in ranges, so a task opens few files. Ids that no file has give no
    row; those of repeated documents give one each.
    """
    ranges = spark.sparkContext.broadcast(sorted((bytes(f["first"]), bytes(f["last"]), f["path"]) for f in files))  # a row a file
    n = max(1, min(len(files), int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def look(batches):
        firsts, held = [r[0] for r in ranges.value], {}
        for batch in batches:
            found = []
            for doc_id in batch.column(0).to_pylist():
                key = key_bytes(doc_id)
                at = bisect.bisect_right(firsts, key) - 1
                while at >= 0 and ranges.value[at][1] >= key:  # a repeated id may go on into the next file
                    path = ranges.value[at][2]
                    if path not in held:
                        if len(held) == OPEN_FILES:
                            held.pop(next(iter(held)))
                        held[path] = open_table(path)
                    found += [(doc_id, tokens.astype(np.int64)) for tokens in held[path].get(doc_id)]
                    at -= 1
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), pa.array([t for _, t in found], pa.list_(pa.int64()))], ["doc_id", "tokens"])

    asked = ids.select("doc_id").distinct().repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    return asked.mapInArrow(look, "doc_id long, tokens array<long>")


def token_tables(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Writes docs as table files in the shared folder and returns what the files say of each document.

    What reaches the driver is one row a file.
    """
    folder = new_folder(spark, "sstable")
    files = write_tables(spark, docs, folder, tokenizer_path, end_id).collect()
    rows, start = [], 0
    for f in sorted(files, key=lambda f: f["shard"]):
        rows.append((f["shard"], f["path"], start))
        start += f["ids"]
    tables = spark.createDataFrame(rows, "shard long, path string, start long")
    return read_tables(tables.repartition(max(1, len(rows)), "shard") if rows else tables)
