"""Best-fit packing of documents into bins of a fixed size, under conflicts.

No two documents of one source or of one cluster of duplicates share a bin. Open bins are kept in the order of what is
left in them, each with a bitmap of its sources and one of its clusters; a document goes to the first bin, from its
own size upwards, whose bitmaps it doesn't meet, which is the tightest bin that can take it. Documents longer than a
bin fill whole bins first; their last piece is packed.

Documents are dealt by a hash of what the packing knows of them into shards of about SHARD documents, each packed on its own from the
largest document down, so the work grows in proportion to the input and no source or cluster meets in one task. Rows that are
equal in all of this are counted first and dealt by the chunk, so neither does an id or a row that repeats.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm._common import n_words, stored, whole_text

#: Words of a bin, and documents of a shard.
CAPACITY = 2048
SHARD = 6000
#: Equal rows that are dealt together.
CHUNK = 500
PLAN = "doc_id long, source string, piece int, start long, n_words long, bin long, at long"


class Bins:
    """The open bins of a shard by what is left in them."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.left: list[tuple[int, int]] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def new(self, size: int, source: int = 0, cluster: int = 0) -> tuple[int, int]:
        b = len(self.sources)
        self.sources.append(source)
        self.clusters.append(cluster)
        if size < self.capacity:
            insort(self.left, (self.capacity - size, b))
        return b, 0

    def put(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, place in it): the bin with least left that fits and holds neither bit; the older of equal ones."""
        left, sources, clusters = self.left, self.sources, self.clusters
        for k in range(bisect_left(left, (size, -1)), len(left)):
            room, b = left[k]
            if not (sources[b] & source or clusters[b] & cluster):
                del left[k]
                sources[b] |= source
                clusters[b] |= cluster
                if room > size:
                    insort(left, (room - size, b))
                return b, self.capacity - room
        return self.new(size, source, cluster)


def pack_shard(items: list[tuple[int | None, str | None, int, int]], capacity: int) -> list[tuple]:
    """(doc_id, source, size, cluster) to (item's place, piece, start, n_words, bin, at), largest items first."""
    order = sorted(range(len(items)), key=lambda k: (-(items[k][2] % capacity), items[k][0] is not None, items[k][0] or 0, items[k][3], items[k][2]))
    met: dict[int, int] = {}
    for _, _, size, cluster in items:
        met[cluster] = met.get(cluster, 0) + 1
    source_bit: dict[str | None, int] = {}
    cluster_bit: dict[int, int] = {}
    bins, out = Bins(capacity), []
    for k in order:
        _, source, size, cluster = items[k]
        whole, rest = divmod(size, capacity)
        for piece in range(whole):
            out.append((k, piece, piece * capacity, capacity, *bins.new(capacity)))
        if rest or not whole:
            s = source_bit.setdefault(source, 1 << len(source_bit))
            c = cluster_bit.setdefault(cluster, 1 << len(cluster_bit)) if met[cluster] > 1 else 0
            out.append((k, whole, whole * capacity, rest, *bins.put(rest, s, c)))
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, shard: int = SHARD, size: Column | None = None, cluster: Column | None = None, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """A row for each piece of each row of docs: which words of the document lie in which bin, and from where.

    Null and empty texts are one piece without words. Null sources are one source. Equal texts are one cluster,
    unless another is given (a collision of its 64 bits would only keep two documents apart). Repeated rows are
    packed each, and never into one bin. Rows without an id are packed like others. Empty tables give none.
    """
    size = n_words(text) if size is None else size
    cluster = F.xxhash64(whole_text(text)) if cluster is None else cluster
    known = ["doc_id", "source", "size", "cluster"]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), size.cast("long").alias("size"), cluster.cast("long").alias("cluster"))
    items = stored(rows.groupBy(*known).agg(F.count(F.lit(1)).alias("copies")), "items")
    shards = max(1, -(-(items.agg(F.sum("copies")).first()[0] or 0) // shard))
    chunks = items.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / CHUNK))))
    chunks = chunks.withColumn("copies", F.least(F.lit(CHUNK), F.col("copies") - F.col("chunk") * CHUNK))
    dealt = chunks.withColumn("shard", F.pmod(F.pmod(F.xxhash64(*known), F.lit(shards)) + F.col("chunk"), F.lit(shards)))

    def run(table: pa.Table) -> pa.Table:
        base = table.column("shard")[0].as_py() << 32
        rows = [row for *row, copies in zip(*(table.column(c).to_pylist() for c in (*known, "copies")), strict=True) for _ in range(copies)]
        placed = pack_shard(rows, capacity)
        k, piece, start, n, b, at = zip(*placed, strict=True)
        return pa.table({
            "doc_id": pa.array([rows[i][0] for i in k], pa.int64()), "source": pa.array([rows[i][1] for i in k], pa.string()), "piece": pa.array(piece, pa.int32()),
            "start": pa.array(start, pa.int64()), "n_words": pa.array(n, pa.int64()), "bin": pa.array([base + x for x in b], pa.int64()), "at": pa.array(at, pa.int64()),
        })

    return dealt.groupBy("shard").applyInArrow(run, PLAN)
