"""Near copies by SimHash, checked: links only where two sets of shingles overlap enough.

Candidates come from the Gray-order index over several fingerprints of each set of shingles (simhash.candidate_links),
and what they reach of each other is a cluster. In a cluster all pairs are compared by their fingerprints first, the
nearest first, and what isn't linked already is then checked on the whole sets.

Texts of equal sets are one class from the start, of which one goes on. In a cluster larger than a block all rows are first
compared with a few representatives, which links most of what is alike; then only rows outside of its largest component are
compared with all others, in pairs of blocks. Links within a component are not looked for: they join nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from marlstone.llm._common import fresh, stored
from marlstone.llm.components import components
from marlstone.llm.simhash import FAR, PRINTS, candidate_links, set_prints, shingle_hashes

SHINGLE = 5
#: Likeness (shared shingles by all shingles of both) from which two texts are linked: 4 / 5.
NUM, DEN = 4, 5
#: Texts and shingles of a block, about.
BLOCK, BLOCK_SHINGLES = 1000, 500_000
#: Representatives of a large cluster.
REPRESENTATIVES = 16
_OWN = ("row_no", "set_id", "n_shingles", "prints")


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of a text, sorted, each as a hash of 64 bits."""
    return np.unique(np.array(shingle_hashes(text, shingle), np.uint64))


def sketches(docs: DataFrame, shingle: int = SHINGLE, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """docs with a number for each row and what its text's shingles come to, written once; and the new columns' names."""
    names = {n: fresh(n, docs.columns) for n in _OWN}
    kinds = (T.LongType(), T.BinaryType(), T.LongType(), T.BinaryType())
    arrow = (pa.int64(), pa.binary(), pa.int64(), pa.binary())
    given = docs.withColumn(fresh("text__", docs.columns), F.col(text))
    schema = T.StructType(given.schema.fields[:-1] + [T.StructField(names[n], k) for n, k in zip(_OWN, kinds, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                out = []
                for t in batch.column(batch.num_columns - 1).to_pylist():
                    hashes = shingle_set(t, shingle)
                    out.append((row, hashlib.sha256(hashes.astype("<u8").tobytes()).digest(), len(hashes), set_prints(hashes).astype("<u8").tobytes()))
                    row += 1
                arrays = [pa.array(v, t) for v, t in zip(zip(*out, strict=True), arrow, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], names=[*batch.schema.names[:-1], *names.values()])

    return stored(given.mapInArrow(run, schema), "sketches"), names


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return shared * (NUM + DEN) >= NUM * len(both)


def linked(rows: list[int], parts: list[int], prints: list[bytes], sets: list[bytes], comps: list[int], across: bool) -> list[tuple[int, int]]:
    """Links between rows whose sets are alike, enough to reach all that all such links and the components (comps) that rows are in
    already reach; across: only between parts."""
    if len(rows) < 2:
        return []
    whole = [np.frombuffer(s, "<u8") for s in sets]
    sizes, part = np.array([len(s) for s in whole]), np.array(parts)
    words = np.frombuffer(b"".join(prints), "<u8").reshape(len(rows), PRINTS)
    firsts, seconds, apart = [], [], []
    for k in range(len(rows) - 1):
        far = np.bitwise_count(words[k + 1 :] ^ words[k]).sum(1, dtype=np.int16)
        small, large = np.minimum(sizes[k + 1 :], sizes[k]), np.maximum(sizes[k + 1 :], sizes[k])
        near = (far <= FAR) & (small * DEN >= large * NUM)
        if across:
            near &= part[k + 1 :] != part[k]
        at = np.flatnonzero(near)
        firsts.append(np.full(len(at), k, np.int32))
        seconds.append((at + k + 1).astype(np.int32))
        apart.append(far[at])
    a, b = np.concatenate(firsts), np.concatenate(seconds)
    order = np.argsort(np.concatenate(apart), kind="stable")
    a, b = a[order], b[order]
    root, out = np.unique(np.array(comps), return_inverse=True)[1], []
    for at in range(0, len(a), 1024):
        x, y = a[at : at + 1024], b[at : at + 1024]
        apart = root[x] != root[y]
        for p, q in zip(x[apart].tolist(), y[apart].tolist(), strict=True):
            if root[p] != root[q] and alike(whole[p], whole[q]):
                root[root == root[q]] = root[p]
                out.append((rows[p], rows[q]))
    return out


def _with_sets(members: DataFrame, shingle: int) -> DataFrame:
    """members with their texts' sets of shingles in place of the texts."""
    schema = T.StructType([*(f for f in members.schema.fields if f.name != "text"), T.StructField("shingles", T.BinaryType())])
    rest = [n for n in schema.names if n != "shingles"]

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                found = [shingle_set(t, shingle).astype("<u8").tobytes() for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(found, pa.binary())], names=schema.names)

    return members.mapInArrow(sets, schema)


def _dealt(hashed: DataFrame) -> DataFrame:
    """Rows (root, part, meets, ...) to the groups (root, i, j) of pairs of parts: each row meets parts 0 to meets - 1, and its own."""
    dealt = hashed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("meets") - 1)))
    return dealt.select("root", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "row_no", "part", "prints", "shingles", "comp")


def _checked(hashed: DataFrame) -> DataFrame:
    """(a, b) row numbers of alike texts, from (root, part, meets, row_no, prints, shingles, comp)."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last, out = ([], [], [], [], []), None, []

        def close() -> None:
            if last:
                out.extend(linked(*held, across=last[1] != last[2]))
            for h in held:
                h.clear()

        def batch_of() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])
            out.clear()
            return made

        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                keys = zip(*(batch.column(c).to_pylist() for c in ("root", "i", "j")), strict=True)
                for key, *values in zip(keys, *(batch.column(c).to_pylist() for c in ("row_no", "part", "prints", "shingles", "comp")), strict=True):
                    if key != last:
                        close()
                        last = key
                    for h, v in zip(held, values, strict=True):
                        h.append(v)
            yield batch_of()
        close()
        yield batch_of()

    return _dealt(hashed).repartition("root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(check, "a long, b long")


def _represented(rows: DataFrame) -> DataFrame:
    """(root, row_no, reps): for each row of a large cluster (root, blocks, row_no, prints, shingles) the representatives of it that
    it is alike with, a representative being alike with itself.

    Rows are dealt by cluster and block, each once, and its cluster's representatives come to each block first.
    """
    nth = F.row_number().over(Window.partitionBy("root").orderBy(F.xxhash64("row_no"), "row_no"))
    names = rows.select("root", "row_no").withColumn("nth", nth).filter(F.col("nth") <= REPRESENTATIVES).select("row_no")
    salt = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    chosen = rows.join(names, "row_no").select("root", salt.alias("salt"), F.lit(False).alias("own"), "row_no", "prints", "shingles")
    own = rows.select("root", F.pmod(F.xxhash64("row_no"), F.col("blocks")).alias("salt"), F.lit(True).alias("own"), "row_no", "prints", "shingles")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, []
        for whole in batches:
            out = []
            for at in range(0, whole.num_rows, 64):
                for root, salt_, own_, row, p, s in zip(*(whole.column(c).slice(at, 64).to_pylist() for c in ("root", "salt", "own", "row_no", "prints", "shingles")), strict=True):
                    if (root, salt_) != last:
                        last, known = (root, salt_), []
                    prints, shingles = np.frombuffer(p, "<u8"), np.frombuffer(s, "<u8")
                    if not own_:
                        known.append((row, prints, shingles))
                        continue
                    n = len(shingles)
                    close = [(rep, other) for rep, q, other in known if int(np.bitwise_count(prints ^ q).sum()) <= FAR and min(n, len(other)) * DEN >= max(n, len(other)) * NUM]
                    out.append((root, row, [rep for rep, other in close if alike(shingles, other)]))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.list_(pa.int64())))], names=["root", "row_no", "reps"])

    met = chosen.unionByName(own).repartition("root", "salt").sortWithinPartitions("root", "salt", "own")
    return stored(met.mapInArrow(check, "root long, row_no long, reps array<long>"), "represented")


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(root, sets of representatives that one row is alike with) to (root, rep, comp): the least representative that each reaches."""
    for batch in batches:
        out = []
        for root, groups in zip(batch.column("root").to_pylist(), batch.column("groups").to_pylist(), strict=True):
            comp: dict[int, int] = {}
            for group in groups:
                met = {comp.get(r, r) for r in group}
                low = min(met)
                comp |= {r: low for r in group}
                comp = {r: low if c in met else c for r, c in comp.items()}
            out += [(root, r, c) for r, c in comp.items()]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(3)], names=["root", "rep", "comp"])


def _large_links(rows: DataFrame) -> DataFrame:
    """(a, b) of alike texts in large clusters, from (root, blocks, row_no, prints, shingles)."""
    met = _represented(rows)
    links = met.select(F.col("row_no").alias("a"), F.explode("reps").alias("b")).filter("a <> b")
    # pairs of neighbours in the lists say as much as the lists, and are no more than representatives can make
    pairs = F.when(F.size("reps") < 2, F.array("reps")).otherwise(F.transform(F.sequence(F.lit(1), F.size("reps") - 1), lambda k: F.slice("reps", k, 2)))
    groups = met.filter(F.size("reps") > 0).select("root", F.explode(pairs).alias("pair")).groupBy("root").agg(F.collect_set("pair").alias("groups"))
    comps = groups.mapInArrow(_merged, "root long, rep long, comp long")
    placed = met.select("root", "row_no", F.get("reps", F.lit(0)).alias("rep")).join(comps, ["root", "rep"], "left")
    placed = stored(placed.select("root", "row_no", F.coalesce("comp", "row_no").alias("comp")), "placed")
    sizes = placed.groupBy("root", "comp").agg(F.count(F.lit(1)).alias("n"))
    giants = sizes.groupBy("root").agg(F.max_by("comp", F.struct("n", "comp")).alias("giant"), F.count(F.lit(1)).alias("comps")).filter("comps > 1")
    open_ = stored(placed.join(giants, "root").select("row_no", "comp", (F.col("comp") == F.col("giant")).alias("inside")), "open")
    if open_.isEmpty():
        return links
    # rows outside of the largest component meet all others; those within it meet them
    mine = rows.drop("blocks").join(open_, "row_no")
    blocks = mine.groupBy("root", "inside").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum(F.octet_length("shingles") / 8) / BLOCK_SHINGLES)).cast("long").alias("n"))
    blocks = blocks.groupBy("root").agg(F.sum(F.when(~F.col("inside"), F.col("n"))).alias("out"), F.coalesce(F.sum(F.when(F.col("inside"), F.col("n"))), F.lit(0)).alias("inn"))
    part = F.when(F.col("inside"), F.col("out") + F.pmod(F.xxhash64("row_no"), F.greatest("inn", F.lit(1)))).otherwise(F.pmod(F.xxhash64("row_no"), F.col("out")))
    meets = F.when(F.col("inside"), F.col("out")).otherwise(F.col("out") + F.col("inn"))
    return links.unionByName(_checked(mine.join(blocks, "root").withColumns({"part": part, "meets": meets})))


def near_links(rows: DataFrame, names: dict[str, str], shingle: int = SHINGLE, text: str = "text") -> DataFrame:
    """(a, b) row numbers of the rows of sketches() that are alike, reaching what all such pairs reach."""
    given = rows.select(*(F.col(names[n]).alias(n) for n in _OWN), F.col(text).alias("text"))
    classes = stored(given.groupBy("set_id").agg(F.min("row_no").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "classes")
    equal = stored(given.select("set_id", F.col("row_no").alias("a")).join(classes, "set_id").filter("a <> b").select("a", "b"), "equal")
    alone = stored(given.select("row_no", "prints").join(equal, F.col("row_no") == F.col("a"), "left_anti").select("row_no", "prints"), "prints")
    clusters = stored(components(candidate_links(alone, alone.count())), "clusters")
    found = given.select("row_no", "n_shingles", "prints", "text").join(clusters.withColumnRenamed("node", "row_no"), "row_no")
    found = stored(found, "members")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("long")
    sizes = stored(found.groupBy("root").agg(blocks.alias("blocks")).filter("blocks > 1"), "large")
    one = F.lit(1).cast("long")
    if sizes.isEmpty():
        rows = _with_sets(found.select("root", "row_no", "prints", "text"), shingle)
        return stored(_checked(_alone(rows)), "alike").unionByName(equal)
    # a row of each cluster of more than one block: joined as its size allows
    both = stored(_with_sets(found.join(sizes, "root", "left").select("root", F.coalesce("blocks", one).alias("blocks"), "row_no", "prints", "text"), shingle), "sets")
    links = stored(_checked(_alone(both.filter("blocks = 1").drop("blocks"))), "alike")
    return links.unionByName(stored(_large_links(both.filter("blocks > 1")), "alike")).unionByName(equal)


def _alone(rows: DataFrame) -> DataFrame:
    """Rows of clusters of one block."""
    return rows.select("*", F.lit(0).cast("long").alias("part"), F.lit(1).cast("long").alias("meets"), F.col("row_no").alias("comp"))


def drop_near_texts(docs: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay: of each component of alike texts the one of the least id, nulls last.

    Of rows that share it, one stays. Texts without a word are alike.
    """
    rows, names = sketches(docs, shingle, text)
    found = stored(components(near_links(rows, names, shingle, text)), "components")
    ids = rows.select(F.col(names["row_no"]).alias("node"), F.col(doc_id).cast("long").alias("id"))
    placed = stored(found.join(ids, "node").select("root", F.struct(F.col("id").isNull().alias("none"), "id", "node").alias("at")), "placed")
    best = stored(placed.groupBy("root").agg(F.min("at").alias("best")), "best")
    inner = fresh("gone__", rows.columns)
    gone = placed.join(best, "root").filter("at.node <> best.node").select(F.col("at.node").alias(inner))
    return rows.join(gone, rows[names["row_no"]] == gone[inner], "left_anti").select(*docs.columns)
