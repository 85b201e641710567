"""Exact substring duplicates over fixed-block anchors.

A passage of WINDOW words that occurs twice holds, wherever it starts, one whole aligned block of half as many words
in either place. So the non-overlapping blocks of every document are the index, and every rolling window of that many
words is a probe. Probes that meet an anchor of another document are hits; hits are extended to all enclosing windows
of WINDOW words, each of which finds the least document that holds it; runs of covered words are the maximal repeats.

Documents are dealt into groups of about GROUP_BYTES by a hash of their ids and texts, so rows of one id, or of none,
needn't meet in one group. A group sends each of its probes once, as sorted numbers, and each window that encloses a
hit once, with the group's least document. So a passage that n documents share costs as many rows as there are groups
that hold it; pairs of documents are never formed.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm._common import whole_text, words

WINDOW = 13
#: Bytes of text of a group, and probes of a bucket, about. Both grow with the corpus, as a 4096th of it, up to 16 and 8
#: times as much, so that what a group sends to a bucket stays worth a row of its own.
GROUP_BYTES = 8 << 20
BUCKET_PROBES = 2_000_000
SHARES = 4096
#: Groups and buckets of a task, about, and the most partitions of a shuffle.
GROUPS, BUCKETS, MOST_PARTS = 4, 4, 1 << 16
_NONE = np.iinfo(np.int64).min
# Odd multipliers of the rolling polynomials.
_P, _Q, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX
    return x ^ (x >> np.uint64(29))


def _rolling(x: np.ndarray, size: int, by: np.uint64) -> np.ndarray:
    """A hash of each run of `size` neighbours."""
    n = len(x) - size + 1
    out = np.zeros(max(0, n), np.uint64)
    for k in range(size if n > 0 else 0):
        out = out * by + x[k : k + n]
    return _mixed(out)


class _Group:
    """The words of a group's documents, one after the other, as hashes."""

    def __init__(self, table: pa.Table):
        self.ids = np.array([_NONE if i is None else i for i in table.column("doc_id").to_pylist()], np.int64)
        self.texts = table.column("text")
        hashes, get, sizes = [], _WordHash().__getitem__, []
        for t in self.texts:
            ws = words(t.as_py())
            sizes.append(len(ws))
            hashes.append(np.fromiter(map(get, ws), np.uint64, len(ws)))
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.sizes = np.array(sizes, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.doc = np.repeat(np.arange(len(sizes)), self.sizes)

    def within(self, size: int) -> np.ndarray:
        """Whether the run of `size` words from each place is in one document."""
        n = max(0, len(self.doc) - size + 1)
        return self.doc[:n] == self.doc[size - 1 : size - 1 + n]


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where a new value begins in a sorted array."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)


def _pair_runs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where a new pair begins in two arrays that are sorted together."""
    return np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, np.int64)


def _pair_order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The order of pairs, by one sort unless pairs that differ are equal in their first half."""
    order = np.argsort(a, kind="stable")
    x, y = a[order], b[order]
    return np.lexsort((b, a)) if ((x[1:] == x[:-1]) & (y[1:] != y[:-1])).any() else order


def _pack(sorted_: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as the bytes of their differences, like bytes together."""
    gaps = np.diff(sorted_.astype(np.uint32), prepend=np.uint32(0)).astype("<u4")
    return gaps.view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    gaps = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()
    return np.cumsum(gaps, dtype=np.uint64)


def _probe_keys(group: _Group, block: int, shift: int) -> np.ndarray:
    """The key of the block-sized run from each place: its bucket in the upper 32 bits, a hash in the lower. Keys that meet
    by chance only give more windows to compare."""
    h = _rolling(group.hashes, block, _P)
    return ((h >> np.uint64(32)) >> np.uint64(shift)) << np.uint64(32) | (h & np.uint64(0xFFFFFFFF))


def _window_names(group: _Group, window: int, places: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of 64 bits for each window, by polynomials of their own: together its name."""
    both = [_rolling(group.hashes, window, by) for by in (_P, _Q)]
    return tuple(x if places is None else x[places] for x in both)


def _named(name: np.ndarray, side: np.ndarray) -> bytes:
    """Names as they are sent, within a bucket: 64 bits and the lower 32 of the side, whose upper end is the bucket. Over
    10^13 windows any two unequal ones have an equal name with a chance of less than one in a thousand."""
    return name.tobytes() + side.astype(np.uint32).tobytes()


def _names(sent) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(how many each holds, all names, all sides) of sent names."""
    raw = [x.as_py() for x in sent]
    sizes = [len(r) // 12 for r in raw]
    each = lambda kind, at, n, r: np.frombuffer(r, kind, n, at)
    return sizes, np.concatenate([each(np.uint64, 0, n, r) for n, r in zip(sizes, raw, strict=True)]), np.concatenate([each(np.uint32, 8 * n, n, r) for n, r in zip(sizes, raw, strict=True)])


def _known(name: np.ndarray, side: np.ndarray, known_name: np.ndarray, known_side: np.ndarray) -> np.ndarray:
    """Which names are among the known ones."""
    order = np.argsort(known_name, kind="stable")
    known, sides = known_name[order], known_side[order]
    at, hit = np.searchsorted(known, name), np.zeros(len(name), bool)
    open_ = np.arange(len(name))
    while True:  # once more for each further known name that is equal in its first half
        inside = at[open_] < len(known)
        open_ = open_[inside]
        open_ = open_[known[at[open_]] == name[open_]]
        if not len(open_):
            return hit
        hit[open_] |= sides[at[open_]] == side[open_]
        open_ = open_[~hit[open_]]
        at[open_] += 1


def remove_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, spans) for each row of docs, and kept_text if asked.

    A word goes if a window of `window` words of its document covers it whose word sequence also starts in a
    document of a smaller id. spans: the maximal runs of words that go, as start and end (exclusive). Null and empty
    texts have no words; rows of one id never remove each other's words; null ids count as smaller than all others.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    block = (window + 1) // 2
    n_bytes = docs.agg(F.sum(F.octet_length(whole_text("text")) + 64)).first()[0] or 1
    groups = -(-n_bytes // min(16 * GROUP_BYTES, max(GROUP_BYTES, n_bytes // SHARES)))
    probes = min(8 * BUCKET_PROBES, max(BUCKET_PROBES, n_bytes // 6 // SHARES))
    bits = min(24, max(0, (n_bytes // 6 // probes).bit_length()))
    shift = 32 - bits
    # partitions by the data: a task has a few groups, or buckets
    group_parts, bucket_parts = min(MOST_PARTS, -(-groups // GROUPS)), min(MOST_PARTS, max(1, (1 << bits) // BUCKETS))
    docs = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).alias("grp"), "doc_id", "text").repartition(group_parts, "grp")

    def announce(table: pa.Table) -> pa.Table:
        """A group's probes: each once, and whether it is an anchor and whether two of the group's documents have it."""
        g = _Group(table)
        inside = g.within(block)
        place = np.flatnonzero(inside)
        key = _probe_keys(g, block, shift)[inside]
        doc = g.doc[place]
        anchor = (place - g.starts[doc]) % block == 0
        order = np.argsort(key, kind="stable")
        key, doc, anchor = key[order], doc[order], anchor[order]
        at = _runs(key)
        if not len(at):
            return pa.table({"bucket": pa.array([], pa.int64()), "grp": pa.array([], pa.int64()), "keys": pa.array([], pa.binary()), "anchors": pa.array([], pa.binary()), "shared": pa.array([], pa.binary())})
        ids = g.ids[doc]
        shared = np.minimum.reduceat(ids, at) != np.maximum.reduceat(ids, at)
        anchor, key = np.logical_or.reduceat(anchor, at), key[at]
        bucket = (key >> np.uint64(32)).astype(np.int64)
        cut = [*_runs(bucket).tolist(), len(bucket)]
        parts = list(zip(cut, cut[1:], strict=False))
        return pa.table({
            "bucket": pa.array([int(bucket[a]) for a, _ in parts], pa.int64()), "grp": pa.array([table.column("grp")[0].as_py()] * len(parts), pa.int64()),
            "keys": pa.array([_pack(key[a:b] & np.uint64(0xFFFFFFFF)) for a, b in parts], pa.binary()),
            "anchors": pa.array([np.packbits(anchor[a:b]).tobytes() for a, b in parts], pa.binary()), "shared": pa.array([np.packbits(shared[a:b]).tobytes() for a, b in parts], pa.binary()),
        })

    def meet(table: pa.Table) -> pa.Table:
        """A bucket's hits, back to the groups: keys that are an anchor somewhere and that two documents have."""
        keys = [_unpack(k.as_py()) for k in table.column("keys")]
        sizes = np.array([len(k) for k in keys])
        bits_of = lambda c: np.concatenate([np.unpackbits(np.frombuffer(b.as_py(), np.uint8), count=n) for b, n in zip(table.column(c), sizes, strict=True)]).astype(bool)
        key, anchor, shared = np.concatenate(keys), bits_of("anchors"), bits_of("shared")
        order = np.argsort(key, kind="stable")
        at = _runs(key[order])
        n = np.diff(at, append=len(key))
        hit = np.logical_or.reduceat(anchor[order], at) & ((n > 1) | np.logical_or.reduceat(shared[order], at))
        mine = np.zeros(len(key), bool)
        mine[order] = np.repeat(hit, n)
        cuts = np.cumsum(sizes)[:-1]
        found = [(g, b, _pack(k[m])) for g, b, k, m in zip(table.column("grp").to_pylist(), table.column("bucket").to_pylist(), keys, np.split(mine, cuts), strict=True) if m.any()]
        return pa.table({"grp": pa.array([f[0] for f in found], pa.int64()), "bucket": pa.array([f[1] for f in found], pa.int64()), "keys": pa.array([f[2] for f in found], pa.binary())})

    def extend(table: pa.Table, hits: pa.Table) -> pa.Table:
        """The windows that enclose a hit: each once, with the least of the group's documents that has it."""
        empty = pa.table({"bucket": pa.array([], pa.int64()), "grp": pa.array([], pa.int64()), "names": pa.array([], pa.binary()), "least": pa.array([], pa.binary())})
        if not hits.num_rows or not table.num_rows:
            return empty
        g = _Group(table)
        known = np.sort(np.concatenate([_unpack(k.as_py()) | np.uint64(b.as_py() << 32) for k, b in zip(hits.column("keys"), hits.column("bucket"), strict=True)]))
        key = _probe_keys(g, block, shift)
        at = np.minimum(np.searchsorted(known, key), len(known) - 1)
        hit = (known[at] == key) & g.within(block)
        inside = g.within(window)
        if not len(inside):
            return empty
        seen = np.concatenate([[0], np.cumsum(hit)])
        reach = window - block + 1
        place = np.flatnonzero((seen[reach : reach + len(inside)] > seen[: len(inside)]) & inside)
        if not len(place):
            return empty
        name, side = _window_names(g, window, place)
        ids = g.ids[g.doc[place]]
        order = _pair_order(side, name)  # the bucket is the upper end of the side
        name, side, ids = name[order], side[order], ids[order]
        at = _pair_runs(name, side)
        name, side, ids = name[at], side[at], np.minimum.reduceat(ids, at)
        bucket = ((side >> np.uint64(32)) >> np.uint64(shift)).astype(np.int64)
        cut = [*_runs(bucket).tolist(), len(bucket)]
        parts = list(zip(cut, cut[1:], strict=False))
        return pa.table({
            "bucket": pa.array([int(bucket[a]) for a, _ in parts], pa.int64()), "grp": pa.array([table.column("grp")[0].as_py()] * len(parts), pa.int64()),
            "names": pa.array([_named(name[a:b], side[a:b]) for a, b in parts], pa.binary()), "least": pa.array([ids[a:b].view(np.uint8).reshape(-1, 8).T.tobytes() for a, b in parts], pa.binary()),
        })

    def settle(table: pa.Table) -> pa.Table:
        """The windows of each group that a document smaller than all of the group's own has."""
        sizes, name, side = _names(table.column("names"))
        least = np.concatenate([np.ascontiguousarray(np.frombuffer(x.as_py(), np.uint8).reshape(8, -1).T).view(np.int64).ravel() for x in table.column("least")])
        order = _pair_order(name, side)
        at = _pair_runs(name[order], side[order])
        lowest = np.empty(len(name), np.int64)
        lowest[order] = np.repeat(np.minimum.reduceat(least[order], at), np.diff(at, append=len(name)))
        cuts = np.cumsum(sizes)[:-1]
        parts = zip(table.column("grp").to_pylist(), np.split(name, cuts), np.split(side, cuts), np.split(lowest < least, cuts), strict=True)
        found = [(g, _named(x[m], y[m])) for g, x, y, m in parts if m.any()]
        return pa.table({"grp": pa.array([f[0] for f in found], pa.int64()), "names": pa.array([f[1] for f in found], pa.binary())})

    def remove(table: pa.Table, replies: pa.Table) -> pa.Table:
        g = _Group(table)
        name, side = _window_names(g, window)
        inside = g.within(window)
        covered = np.zeros(len(g.hashes), bool)
        if inside.any():
            place = np.flatnonzero(inside)
            order = place[_pair_order(name[place], side[place])]
            at = _pair_runs(name[order], side[order])
            ids = g.ids[g.doc[order]]
            gone = np.zeros(len(name), bool)
            gone[order] = np.repeat(np.minimum.reduceat(ids, at), np.diff(at, append=len(order))) < ids
            if replies.num_rows:
                gone |= inside & _known(name, side.astype(np.uint32), *_names(replies.column("names"))[1:])
            edge = np.zeros(len(g.hashes) + 1, np.int64)
            edge[: len(gone)] += gone
            edge[window : window + len(gone)] -= gone
            covered = np.cumsum(edge[:-1]) > 0
        n_removed, sums, kept_texts, spans = [], [], [], []
        for t, a, n in zip(g.texts, g.starts.tolist(), g.sizes.tolist(), strict=True):
            ws, c = words(t.as_py()), covered[a : a + n]
            edges = np.flatnonzero(np.diff(np.concatenate([[0], c.view(np.int8), [0]])))
            if len(edges):
                ws = list(compress(ws, (~c).tolist()))
            n_removed.append(n - len(ws))
            line = b" ".join(ws)
            sums.append(hashlib.sha256(line).hexdigest())
            spans.append([{"start": int(s), "end": int(e)} for s, e in edges.reshape(-1, 2)])
            if with_text:
                kept_texts.append(line.decode("utf-8", "surrogatepass"))
        out = {"doc_id": table.column("doc_id"), "n_words": pa.array(g.sizes), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(sums, pa.string()), "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))}
        return pa.table(out | ({"kept_text": pa.array(kept_texts, pa.string())} if with_text else {}))

    by_group = docs.groupBy("grp")
    probes = by_group.applyInArrow(announce, "bucket long, grp long, keys binary, anchors binary, shared binary")
    hits = probes.repartition(bucket_parts, "bucket").groupBy("bucket").applyInArrow(meet, "grp long, bucket long, keys binary")
    windows = by_group.cogroup(hits.repartition(group_parts, "grp").groupBy("grp")).applyInArrow(extend, "bucket long, grp long, names binary, least binary")
    replies = windows.repartition(bucket_parts, "bucket").groupBy("bucket").applyInArrow(settle, "grp long, names binary")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:long,end:long>>" + ", kept_text string" * with_text
    return by_group.cogroup(replies.repartition(group_parts, "grp").groupBy("grp")).applyInArrow(remove, schema)
