"""SimHash near-duplicates over a hierarchical index in Gray order.

Fingerprints are sorted by Gray rank, so neighbours share many bits. Upper nodes hold the bit patterns, under a mask,
that all fingerprints below share, each bit at the highest node where it is common. A search adds up, level by level,
the differences on the bits a node fixes, and drops the whole group when they exceed the limit.

There are two such indexes, one over the fingerprints and one over their halves swapped: of two fingerprints within
the limit, one half differs in at most half as many bits, so each index drops what differs more in its upper half.

The top of an index is a table of prefixes of the upper half, fine enough that each holds about NODE fingerprints; it
has at most MOST_NODES rows and goes to all executors. Each fingerprint is sent to the prefixes that it can reach,
from its own in Gray order onwards (about one for each bit of a prefix), and each prefix is searched through a tree of
its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm._common import fresh, lower_words, stored
from marlstone.llm.components import components

SHINGLE = 3
BITS = 2
SEED = 42
#: Fingerprints below a prefix, about, and the most prefixes there may be.
NODE = 2048
MOST_NODES = 1 << 18
#: Children of a tree node.
FAN = 8
#: Queries that are searched at a time.
CHUNK = 1024

#: For likeness below what a few bits tell: PRINTS fingerprints of a set of shingles, under seeds of their own, each cut
#: into sections of SECTION bits. Sets are candidates if in one section at most SLACK bits differ, in that fingerprint at
#: most REACH, and in all of them together at most FAR. Two sets at a likeness of 0.8 differ in each bit with a chance
#: of 0.15, so they fulfil one section with one of 0.28, and miss all sixteen with one of 0.005.
PRINTS, SECTION, SLACK, REACH, FAR = 4, 16, 1, 24, 64
#: Fingerprints that are dealt at a time, and members of a node that are joined by a common neighbour before the search.
DEAL, DENSE = 1 << 16, 512
_GOLDEN, _M1, _M2 = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def shingle_hashes(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> list[int]:
    ws = lower_words(text)
    if len(ws) <= shingle:
        return [xxhash.xxh64_intdigest(b" ".join(ws), seed)] if ws else []
    line = b" ".join(ws)
    ends, at = [], -1
    for w in ws:
        at += 1 + len(w)
        ends.append(at)
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :], strict=False)]


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64 bits; a bit is 1 if it is set in over half of the shingles' hashes; zero without a word."""
    hashes = shingle_hashes(text, shingle, seed)
    if not hashes:
        return 0
    return _ones(np.array(hashes, np.uint64))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) for each row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = np.array([fingerprint(t, shingle) for t in part.column(1).to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], ["doc_id", "fp"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for k in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(k)
    return rank


class GrayIndex:
    """Masked patterns, given in Gray order, under levels of nodes that hold what their children share."""

    def __init__(self, patterns: np.ndarray, masks: np.ndarray):
        levels = [(patterns & masks, masks)]
        while len(levels[-1][0]) > 1:
            p, m = levels[-1]
            at = np.arange(0, len(p), FAN)
            low, high = np.bitwise_and.reduceat(p, at), np.bitwise_or.reduceat(p, at)
            shared = np.bitwise_and.reduceat(m, at) & ~(low ^ high)
            levels.append((low & shared, shared))
        self.levels = []
        for k, (p, m) in enumerate(levels):
            above = levels[k + 1][1][np.arange(len(p)) // FAN] if k + 1 < len(levels) else np.zeros_like(m)
            self.levels.append((p, m & ~above))
        self.levels.reverse()

    def search(self, queries: np.ndarray, bits: int, upper: int, top: int = 32) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places in queries, places in patterns) of all pairs that differ in at most `bits` of the masked bits, and in
        at most `upper` of those among the `top` uppermost bits, the upper half."""
        below = np.uint64(64 - top)
        for at in range(0, len(queries), CHUNK):
            part = queries[at : at + CHUNK]
            q, node = np.arange(len(part)), np.zeros(len(part), np.int64)
            far, high = np.zeros(len(part), np.uint8), np.zeros(len(part), np.uint8)
            for k, (pattern, mask) in enumerate(self.levels):
                if k:
                    n = len(q)
                    q, far, high = np.repeat(q, FAN), np.repeat(far, FAN), np.repeat(high, FAN)
                    node = (np.repeat(node * FAN, FAN).reshape(n, FAN) + np.arange(FAN)).ravel()
                    if len(pattern) % FAN:
                        there = node < len(pattern)
                        q, far, high, node = q[there], far[there], high[there], node[there]
                apart = (part[q] ^ pattern[node]) & mask[node]
                far, high = far + np.bitwise_count(apart), high + np.bitwise_count(apart >> below)
                near = (far <= bits) & (high <= upper)
                q, node, far, high = q[near], node[near], far[near], high[near]
            yield q + at, node


def prefixes(prints: DataFrame, count: int, node: int = NODE) -> tuple[np.ndarray, np.ndarray]:
    """(patterns, masks) of the index's top, in Gray order; together they cover each of the prints just once.

    A prefix that holds over four times its share is split further, down to the upper half's 32 bits, so clustered
    prints don't meet in one node.
    """
    node = max(node, -(-4 * count // MOST_NODES))
    depth = min(18, max(1, math.ceil(math.log2(max(2, count / node)))))
    leaves: list[tuple[int, int]] = []
    rest = prints
    while True:
        top = F.shiftrightunsigned("fp", 64 - depth)
        found = [(r["top"], r["count"]) for r in rest.groupBy(top.alias("top")).count().collect()]  # at most 16 for each heavy one
        heavy = [t for t, n in found if n > 4 * node and depth < 32]
        leaves += [(t % (1 << 64), depth) for t, n in found if n <= 4 * node or depth == 32]
        if not heavy:
            break
        marked = prints.sparkSession.createDataFrame([(t,) for t in heavy], "top long")
        rest = rest.withColumn("top", top).join(F.broadcast(marked), "top").select("fp")
        depth = min(32, depth + 4)
    patterns = np.array([t << (64 - d) for t, d in leaves], np.uint64)
    masks = np.array([((1 << d) - 1) << (64 - d) for _, d in leaves], np.uint64)
    order = np.argsort(gray_rank(patterns), kind="stable")
    return patterns[order], masks[order]


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least reachable place for each of n places, over links a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root[root] != root).any():
            root = root[root]
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root


def links(prints: DataFrame, count: int, bits: int = BITS, node: int = NODE) -> DataFrame:
    """(a, b): distinct prints, linked so that the same are reachable as over all pairs within `bits` differing bits.

    prints has one row for each distinct fp. Within each prefix the pairs are contracted to one link for each print
    before they leave the task.
    """
    swapped = lambda c: F.shiftleft(c, 32).bitwiseOR(F.shiftrightunsigned(c, 32))
    found = _half_links(prints, count, bits, node)
    turned = _half_links(prints.select(swapped("fp").alias("fp")), count, bits, node)
    return found.unionByName(turned.select(swapped("a").alias("a"), swapped("b").alias("b")))


def _half_links(prints: DataFrame, count: int, bits: int, node: int) -> DataFrame:
    """The links whose upper half differs in at most half the bits."""
    upper = bits // 2
    patterns, masks = prefixes(prints, count, node)
    tables = prints.sparkSession.sparkContext.broadcast((patterns, masks))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = GrayIndex(*tables.value)
        for batch in batches:
            codes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            found = [(q.copy(), n.copy(), ((codes[q] ^ tables.value[0][n]) & tables.value[1][n]) == 0) for q, n in index.search(codes, upper, upper)]
            q, n, own = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*found, strict=True))
            home = np.zeros(len(codes), np.int64)
            home[q[own]] = n[own]
            keep = n >= home[q]
            for at in range(0, int(keep.sum()), 50_000):
                k = np.flatnonzero(keep)[at : at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(n[k]), pa.array(codes[q[k]].view(np.int64)), pa.array(own[k])], ["node", "fp", "own"])

    def search(table: pa.Table) -> pa.Table:
        codes = table.column("fp").to_numpy().view(np.uint64)
        own = table.column("own").to_numpy()
        members = codes[own]
        members = members[np.argsort(gray_rank(members), kind="stable")]
        others = codes[~own]
        both = np.concatenate([members, others])
        index = GrayIndex(members, np.full(len(members), ~np.uint64(0)))
        root, a, b, size = np.arange(len(both)), [], [], 0
        for q, m in index.search(both, bits, upper):
            far = q != m
            a.append(q[far])
            b.append(m[far])
            size += int(far.sum())
            if size > 2_000_000:  # contract what has been found
                root = _roots(np.concatenate([*a, np.arange(len(both))]), np.concatenate([*b, root]), len(both))
                a, b, size = [], [], 0
        root = _roots(np.concatenate([*a, np.arange(len(both))]), np.concatenate([*b, root]), len(both))
        moved = np.flatnonzero(root != np.arange(len(both)))
        return pa.table({"a": both[moved].view(np.int64), "b": both[root[moved]].view(np.int64)})

    dealt = prints.select("fp").mapInArrow(deal, "node long, fp long, own boolean")
    return dealt.groupBy("node").applyInArrow(search, "a long, b long")


def _ones(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes."""
    raw = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(raw), 8192):
        ones += np.unpackbits(raw[at : at + 8192], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def set_prints(hashes: np.ndarray) -> np.ndarray:
    """PRINTS fingerprints of a set of 64-bit hashes; zeros for the empty set."""
    out = np.zeros(PRINTS, np.uint64)
    for s in range(PRINTS if len(hashes) else 0):
        x = hashes + np.uint64(s * _GOLDEN % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        out[s] = _ones(x ^ (x >> np.uint64(31)))
    return out


def _turned(codes: np.ndarray, by: int) -> np.ndarray:
    return (codes << np.uint64(by)) | (codes >> np.uint64(64 - by)) if by else codes


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = np.arange(len(root))
    return _roots(np.concatenate([a, n]), np.concatenate([b, root]), len(root))


def node_roots(codes: np.ndarray, words: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The least reachable place for each place of a node, over candidates of which one at least is the node's own.

    What is near a common neighbour is joined first, where that is much of the node; inside such a group nothing is
    searched, and between two groups only until they meet. So a large group of near copies doesn't cost all its pairs.
    """
    root, group = np.arange(len(codes)), np.zeros(len(codes), np.int64)
    apart = lambda a, b: np.bitwise_count(words[a] ^ words[b]).sum(-1, dtype=np.int64)
    left = np.arange(len(codes))
    while len(left) >= DENSE:
        tried = [apart(left, k) <= FAR for k in left[:: max(1, len(left) // 8)]]
        best = max(tried, key=np.count_nonzero)
        if np.count_nonzero(best) < DENSE:
            break
        group[left[best]] = group.max() + 1
        root[left[best]] = left[best].min()
        left = left[~best]

    def pairs(members: np.ndarray, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if len(members) and len(queries):
            members = members[np.argsort(gray_rank(codes[members]), kind="stable")]
            index = GrayIndex(codes[members], np.full(len(members), ~np.uint64(0)))
            for q, m in index.search(codes[queries], REACH, SLACK, SECTION):
                a, b = queries[q], members[m]
                near = a != b
                near[near] = apart(a[near], b[near]) <= FAR
                yield a[near], b[near]

    mine = [np.flatnonzero(own & (group == g)) for g in range(group.max() + 1)]
    everyone = [np.flatnonzero(group == g) for g in range(len(mine))]
    for members, queries in [(np.flatnonzero(own), everyone[0]), *((mine[0], q) for q in everyone[1:])]:
        for a, b in pairs(members, queries):
            root = _joined(root, a, b)
    for g in range(1, len(mine)):
        for h in range(1, len(mine)):
            if g != h and root[everyone[g][0]] != root[everyone[h][0]]:
                for a, b in pairs(mine[g], everyone[h]):
                    if len(a):
                        root = _joined(root, a[:1], b[:1])
                        break
    return root


def candidate_links(prints: DataFrame, count: int, node: int = NODE) -> DataFrame:
    """(a, b) row numbers, linked so that the same are reachable as over all candidates.

    prints: (row_no, prints), the bytes of set_prints. Each section has an index of its own, whose top are the prefixes
    of a depth that leaves about `node` in each; a print goes to its own prefix and to those after it that differ in
    SLACK bit, all prints of a batch for one prefix in one row. Each prefix is searched through a tree of its own.
    """
    depth = min(SECTION, max(1, math.ceil(math.log2(max(2, count / node)))))
    flips = np.array([0, *(1 << k for k in range(depth))])
    sections = [(s, by) for s in range(PRINTS) for by in range(0, 64, SECTION)]

    def packed(rows: np.ndarray, words: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k, (s, by) in enumerate(sections):
            home = (_turned(words[:, s], by) >> np.uint64(64 - depth)).astype(np.int64)
            reached = home[:, None] ^ flips
            who, flip = np.nonzero(reached >= home[:, None])
            at = reached[who, flip]
            order = np.argsort(at, kind="stable")
            who, own, at = who[order], flip[order] == 0, at[order]
            cut = np.flatnonzero(np.diff(at, prepend=-1, append=-1)).tolist()
            data = [rows[who[a:b]].tobytes() + words[who[a:b]].tobytes() + own[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array([(k << SECTION) + int(at[a]) for a in cut[:-1]], pa.int64()), pa.array(data, pa.binary())], ["node", "data"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, words, held = [], [], 0
        for batch in batches:
            rows.append(batch.column(0).to_numpy(zero_copy_only=False))
            words.append(np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u8").reshape(-1, PRINTS))
            held += batch.num_rows
            if held >= DEAL:
                yield from packed(np.concatenate(rows), np.concatenate(words))
                rows, words, held = [], [], 0
        if held:
            yield from packed(np.concatenate(rows), np.concatenate(words))

    def search(table: pa.Table) -> pa.Table:
        s, by = sections[table.column("node")[0].as_py() >> SECTION]
        rows, words, own = [], [], []
        for x in table.column("data"):
            raw = x.as_py()
            n = len(raw) // (8 + 8 * PRINTS + 1)
            rows.append(np.frombuffer(raw, np.int64, n))
            words.append(np.frombuffer(raw, np.uint64, n * PRINTS, 8 * n).reshape(n, PRINTS))
            own.append(np.frombuffer(raw, bool, n, 8 * n * (1 + PRINTS)))
        rows, words = np.concatenate(rows), np.concatenate(words)
        root = node_roots(_turned(words[:, s], by), words, np.concatenate(own))
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": rows[moved], "b": rows[root[moved]]})

    dealt = prints.select("row_no", "prints").mapInArrow(deal, "node long, data binary")
    return dealt.groupBy("node").applyInArrow(search, "a long, b long")


def near_components(prints: DataFrame, bits: int = BITS, node: int = NODE) -> DataFrame:
    """(doc_id, fp) to (fp, component_id): for each distinct fp, the least doc_id of its component; null if it has none.

    Equal fingerprints are one class from the start; searches, links and components run over classes only.
    """
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    count = classes.count()
    if not count:
        return classes.select("fp", F.col("least").alias("component_id"))
    found = components(links(classes.select("fp"), count, bits, node))
    rooted = stored(classes.join(found.withColumnRenamed("node", "fp"), "fp", "left"), "rooted")
    linked = rooted.filter("root IS NOT NULL")
    # written first, so that both sides of the join are shuffled for it and a large component can be split
    best = stored(linked.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    alone = rooted.filter("root IS NULL").select("fp", F.col("least").alias("component_id"))
    return linked.join(best, "root").select("fp", "component_id").unionByName(alone)


def near_duplicates(docs: DataFrame, bits: int = BITS, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text", node: int = NODE) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of docs.

    Null and empty texts have fingerprint zero and link like any other. Rows without an id get their component's
    least id, or null if nobody in it has one. Repeated rows stay repeated.
    """
    prints = stored(fingerprints(docs, shingle, doc_id, text), "prints")
    found = near_components(prints, bits, node)
    return prints.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, bits: int = BITS, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay: of each component the one of the least id, nulls last, with the columns of docs.

    Of rows that share it, one stays.
    """
    row, inner = fresh("row_no", docs.columns), fresh("gone__", docs.columns)
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    prints = stored(fingerprints(rows, shingle, row, text), "prints")
    found = prints.join(near_components(prints, bits), "fp").select(F.col("doc_id").alias("node"), F.col("component_id").alias("root"))
    ids = rows.select(F.col(row).alias("node"), F.col(doc_id).cast("long").alias("id"))
    placed = stored(found.join(ids, "node").select("root", F.struct(F.col("id").isNull().alias("none"), "id", "node").alias("at")), "placed")
    best = stored(placed.groupBy("root").agg(F.min("at").alias("best")), "best")
    gone = placed.join(best, "root").filter("at.node <> best.node").select(F.col("at.node").alias(inner))
    return rows.join(gone, rows[row] == gone[inner], "left_anti").select(*docs.columns)
