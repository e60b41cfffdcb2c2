"""Suffix-array dedup: byte strings that also start in a document with a smaller id are removed.

The suffix array comes from a linear grouping construction. First part: suffixes are grouped by their Lyndon prefix, the
longest prefix that is a Lyndon word. Groups, at first one a symbol, are processed from the greatest down. Each suffix of
a group finds the next smaller suffix before it by following previous-smaller pointers over what is processed already;
that suffix's prefix grows by the group's, once for each suffix that points to it, and it moves to a new group just above
its old one. Second part: suffixes are emitted in ascending order; an emitted suffix lets those whose Lyndon prefix ends
where it starts take the next place of their group. No ranks are renamed and nothing recurses.

Windows that start the same 50 bytes are neighbours in that order. opinera.llm.repeats brings strings to shards and
verdicts to documents: every window of a string that may have one in common with another distinct string is sorted, and
the order alone decides. Texts are UTF-8; null texts are empty; texts shorter than a window keep all. Rows of one id never
remove each other's bytes, since neither id is smaller; null ids come first. Empty tables give no rows. Other columns
are not read.
"""

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from opinera.llm.repeats import Corpus

WINDOW = 50
GRAM = 16
#: Bytes of one suffix array; strings under one anchor stay together.
TEXT_BYTES = 1 << 14

#: A 64-bit number for each byte, from a rule (splitmix).
_x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_x = (_x ^ (_x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
BYTE_HASH = (_x ^ (_x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)


def suffix_array(text: list[int]) -> list[int]:
    """Places of the suffixes of a row of numbers, ascending; a shorter suffix comes before those it begins."""
    n = len(text)
    if not n:
        return []
    symbols = sorted(set(text))
    node = {c: i for i, c in enumerate(symbols)}
    # places count from 1 here; 0 is before the first
    group = [-1, *map(node.__getitem__, text)]
    members: list[list[int]] = [[] for _ in symbols]
    for i in range(1, n + 1):
        members[group[i]].append(i)
    size = [len(m) for m in members]
    below, above = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
    seen = bytearray(n + 1)
    smaller = [0] * (n + 1)
    g = len(symbols) - 1
    while g >= 0:
        own = members[g]
        if len(own) == 1:
            i = own[0]
            seen[i] = 1
            j = i - 1
            while seen[j]:
                j = smaller[j]
            smaller[i] = j
            moves = [(group[j], [j])] if j else ()
        else:
            own = sorted([i for i in own if group[i] == g])
            members[g] = own
            for i in own:
                seen[i] = 1
            points: dict[int, int] = {}
            for i in own:
                j = i - 1
                while seen[j]:
                    j = smaller[j]
                smaller[i] = j
                if j:
                    points[j] = points.get(j, 0) + 1
            together: dict[tuple[int, int], list[int]] = {}
            for j, times in points.items():
                together.setdefault((-times, group[j]), []).append(j)
            moves = [(key[1], together[key]) for key in sorted(together)]  # more repeats first, so they end up higher
        for old, moved in moves:
            if size[old] == len(moved):  # the whole group: it may stay where it is
                members[old] = moved
                continue
            size[old] -= len(moved)
            fresh = len(members)
            members.append(moved)
            size.append(len(moved))
            for j in moved:
                group[j] = fresh
            up = above[old]
            below.append(old)
            above.append(up)
            above[old] = fresh
            if up >= 0:
                below[up] = fresh
        g = below[g]
    free = [0] * len(members)
    at, g = 0, 0  # node 0 stays the lowest
    while g >= 0:
        free[g] = at
        at += size[g]
        g = above[g]
    order = [0] * n
    j = n
    while j:
        g = group[j]
        order[free[g]] = j
        free[g] += 1
        j = smaller[j]
    for i in order:  # filled ahead of where it is read
        j, stop = i - 1, smaller[i]
        while j != stop:
            g = group[j]
            order[free[g]] = j
            free[g] += 1
            j = smaller[j]
    return [i - 1 for i in order]


def repeated_windows(strings: list[bytes], docs: np.ndarray, anchors: np.ndarray) -> list[np.ndarray]:
    """For each string: which of its windows also start in a document with a smaller id."""
    found: list[np.ndarray] = [np.empty(0, bool)] * len(strings)
    held: list[int] = []
    size = 0
    for i in np.argsort(anchors, kind="stable").tolist():
        if size > TEXT_BYTES and anchors[i] != anchors[held[-1]]:
            _judge(strings, docs, held, found)
            held, size = [], 0
        held.append(i)
        size += len(strings[i]) + 1
    if held:
        _judge(strings, docs, held, found)
    return found


def _judge(strings: list[bytes], docs: np.ndarray, held: list[int], found: list[np.ndarray]) -> None:
    parts = [strings[i] for i in held]
    lengths = np.array([len(p) for p in parts])
    begin = np.r_[0, np.cumsum(lengths + 1)[:-1]]
    text = np.zeros(int(lengths.sum()) + len(held), np.uint16)  # 0 ends a string, bytes count from 1
    inner = np.ones(len(text), bool)
    inner[begin + lengths] = False
    text[inner] = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint16) + 1
    order = np.array(suffix_array(text.tolist()), np.int64)
    which = np.repeat(np.arange(len(held)), lengths + 1)
    order = order[order + WINDOW <= (begin + lengths)[which[order]]]  # the places where a whole window starts
    rows = np.lib.stride_tricks.sliding_window_view(text, WINDOW)
    new = np.ones(len(order), bool)
    for at in range(1, len(order), 1 << 14):
        part = order[at - 1 : at + (1 << 14)]
        new[at : at + len(part) - 1] = (rows[part[1:]] != rows[part[:-1]]).any(axis=1)
    first = np.flatnonzero(new)
    own = docs[held][which[order]]
    least = np.repeat(np.minimum.reduceat(own, first), np.diff(np.r_[first, len(order)]))
    repeats = np.zeros(len(text), bool)
    repeats[order] = least < own
    for i, at, n in zip(held, begin.tolist(), lengths.tolist(), strict=True):
        found[i] = repeats[at : at + n - WINDOW + 1]


def byte_tokens(data: bytes) -> tuple[np.ndarray, bytes, int]:
    return BYTE_HASH[np.frombuffer(data, np.uint8)], data, 1


def remove_repeats(spark: SparkSession, docs: DataFrame, texts: bool = True, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with texts the remaining bytes."""

    def finish(text, cover):
        data = np.frombuffer(text, np.uint8)
        kept = data if cover is None else data[~cover]
        spans = 0 if cover is None else int((np.diff(np.r_[0, cover.astype(np.int8)]) == 1).sum())
        out = (len(data), len(data) - len(kept), spans, hashlib.sha256(kept.tobytes()).hexdigest())
        return (*out, kept.tobytes()) if texts else out

    corpus = Corpus(spark, docs, WINDOW, GRAM, byte_tokens, True, repeated_windows, **options)
    return corpus.covered(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts)
