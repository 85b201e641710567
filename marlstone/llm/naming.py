"""Exact duplicates by deterministic block naming.

Each text is cut into blocks of a fixed size. All distinct blocks are sorted and numbered in that order; then
adjacent names are paired and the distinct pairs sorted and numbered, and so on, until each document has one name.
Two documents of the same number of blocks bear the same last name if and only if their texts are identical: names
stand for contents by sorting, not by hashing, so nothing can collide.

Copies within one task's run of documents form a class at once, by comparing their block numbers; only one member of
each class goes on. So however many copies a text has, each run sends it once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm._common import fresh, stored, utf8

#: Bytes of a block.
BLOCK = 4096
#: Bytes of text, each document counting as 256 at least, after which a task starts a new run.
RUN_BYTES = 48 << 20
SLICE = 256
#: The columns of a catalogue besides those of the documents.
_OWN = ("row_no", "class_no", "first", "n_blocks", "fresh_at", "sha256")


def catalogue(docs: DataFrame, text: str = "text", block: int = BLOCK) -> tuple[DataFrame, dict[str, str]]:
    """docs with a number for each row, its class in its run, and which of its blocks the run had not seen; written once.

    Also returns the names that the new columns got, for docs may have columns of the same names.
    """
    names = {n: fresh(n, docs.columns) for n in _OWN}
    kinds = {"row_no": T.LongType(), "class_no": T.LongType(), "first": T.BooleanType(), "n_blocks": T.IntegerType(), "fresh_at": T.ArrayType(T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("block", T.LongType()), T.StructField("new", T.BooleanType())])), "sha256": T.StringType()}
    inner = fresh("text__", docs.columns)
    given = docs.withColumn(inner, F.col(text))
    schema = T.StructType(given.schema.fields[:-1] + [T.StructField(names[n], kinds[n]) for n in _OWN])
    place = pa.list_(pa.struct([("pos", pa.int32()), ("block", pa.int64()), ("new", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        rows = n_classes = n_blocks = 0
        blocks: dict[bytes, int] = {}
        classes: dict[tuple, int] = {}
        held = 0
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                out: list[list] = [[] for _ in _OWN]
                for t in batch.column(batch.num_columns - 1).to_pylist():
                    if held > RUN_BYTES:
                        blocks, classes, held = {}, {}, 0
                    raw = utf8(t)
                    held += max(256, len(raw))
                    mine = []
                    for i in range(0, max(1, len(raw)), block):
                        b = raw[i : i + block]
                        if new := b not in blocks:
                            blocks[b] = n_blocks
                            n_blocks += 1
                        mine.append((i // block, base + blocks[b], new))
                    key = (len(mine), *(m[1] for m in mine))
                    if first := key not in classes:
                        classes[key] = n_classes
                        n_classes += 1
                    values = (base + rows, base + classes[key], first, len(mine), [dict(zip(("pos", "block", "new"), m, strict=True)) for m in mine] if first else [], hashlib.sha256(raw).hexdigest())
                    rows += 1
                    for column, v in zip(out, values, strict=True):
                        column.append(v)
                arrays = [pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int64(), pa.bool_(), pa.int32(), place, pa.string()), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], names=[*batch.schema.names[:-1], *names.values()])

    return stored(given.mapInArrow(run, schema), "catalogue"), names


def numbered(rows: DataFrame, key: list[str], carry: list[str]) -> DataFrame:
    """The carried columns with `name`, an integer for each distinct key, by a distributed sort on the key.

    A key's rows meet in one partition; partitions are sorted and numbered from the partition's number on, so a
    repeated task gives the same names. Dealing by a hash needs no sample of the keys, whole blocks, on the driver.
    """
    schema = T.StructType([rows.schema[c] for c in carry] + [T.StructField("name", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, last = (TaskContext.get().partitionId() << 33) - 1, None
        for batch in batches:
            out = []
            for k in zip(*(batch.column(c).to_pylist() for c in key), strict=True):
                if k != last:
                    name, last = name + 1, k
                out.append(name)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carry), pa.array(out, pa.int64())], names=[*carry, "name"])

    return rows.select(*dict.fromkeys([*key, *carry])).repartition(*map(F.col, key)).sortWithinPartitions(*key).mapInArrow(run, schema)


def _new_blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """(block, content) of the blocks that their run had not seen, a few MB at a time; a long text is walked once."""
    numbers, contents, held = [], [], 0

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(contents, pa.binary())], ["block", "content"])

    for whole in batches:
        for at in range(0, whole.num_rows, SLICE):
            part = whole.slice(at, SLICE)
            for t, places in zip(part.column(0), part.column(1).to_pylist(), strict=True):
                raw = utf8(t.as_py()) if places else b""
                for m in places or []:
                    if m["new"]:
                        b = raw[m["pos"] * block : (m["pos"] + 1) * block]
                        numbers.append(m["block"])
                        contents.append(b)
                        held += len(b) + 64
                        if held > 4 << 20:
                            yield made()
                            numbers, contents, held = [], [], 0
    yield made()


def identities(cat: DataFrame, names: dict[str, str], text: str = "text", block: int = BLOCK) -> DataFrame:
    """(class_no, level, name): equal (level, name) means equal texts."""
    c = {k: F.col(v) for k, v in names.items()}
    first = cat.filter(c["first"])
    fresh_blocks = first.select(F.col(text), c["fresh_at"]).mapInArrow(lambda batches: _new_blocks(batches, block), "block long, content binary")
    named = numbered(fresh_blocks, ["content"], ["block"])
    where = first.select(c["class_no"].alias("class_no"), c["n_blocks"].alias("n"), F.explode(c["fresh_at"]).alias("b")).select("class_no", "n", F.col("b.pos").alias("pos"), F.col("b.block").alias("block"))
    level = stored(where.join(named, "block").select("class_no", "n", "pos", "name"), "names")
    done, depth = [], 0
    most = cat.agg(F.max(c["n_blocks"])).first()[0] or 0
    while most >= 1:
        done.append(level.filter("n = 1").select("class_no", F.lit(depth).alias("level"), "name"))
        if most == 1:
            break
        half = F.floor(F.col("pos") / 2).cast("int")
        side = lambda k: F.max(F.when(F.col("pos") % 2 == k, F.col("name")))
        pairs = level.filter("n > 1").groupBy("class_no", half.alias("half")).agg(F.max("n").alias("n"), side(0).alias("a"), F.coalesce(side(1), F.lit(-1)).alias("b"))
        pairs = stored(pairs, "pairs")
        named = numbered(pairs.select("a", "b").distinct(), ["a", "b"], ["a", "b"])
        level = stored(pairs.join(named, ["a", "b"]).select("class_no", F.ceil(F.col("n") / 2).cast("int").alias("n"), F.col("half").alias("pos"), "name"), "names")
        most, depth = -(-most // 2), depth + 1
    out = done[0] if done else level.select("class_no", F.lit(0).alias("level"), "name")
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> tuple[DataFrame, dict[str, str]]:
    """Every row of docs with keep_id, group_size and kept, besides the catalogue's columns; and the new columns' names.

    Texts are equal when identical; null counts as empty. The row of the largest doc_id stays, null ids counting as
    the smallest; of rows that share it, one stays. Empty tables give empty tables.
    """
    cat, names = catalogue(docs, text, block)
    names = names | {n: fresh(n, cat.columns) for n in ("keep_id", "group_size", "kept")}
    ids = identities(cat, names, text, block)
    row = F.struct(F.col(doc_id).alias("id"), F.col(names["row_no"]).alias("row"))
    classes = cat.groupBy(F.col(names["class_no"]).alias("class_no")).agg(F.max(row).alias("top"), F.count(F.lit(1)).alias("size"))
    classes = classes.join(ids, "class_no")
    groups = classes.groupBy("level", "name").agg(F.max("top").alias("best"), F.sum("size").alias("all"))
    inner = [fresh(n, [*cat.columns, *names.values()]) for n in ("class__", "row__")]
    verdict = classes.select("class_no", "level", "name").join(groups, ["level", "name"]).select(F.col("class_no").alias(inner[0]), F.col("best.id").alias(names["keep_id"]), F.col("best.row").alias(inner[1]), F.col("all").alias(names["group_size"]))
    out = cat.join(verdict, F.col(names["class_no"]) == F.col(inner[0])).withColumn(names["kept"], F.col(names["row_no"]) == F.col(inner[1]))
    return out.drop(*inner), names


def drop_exact_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row of each group of equal texts, with the columns of docs."""
    out, names = exact_duplicates(docs, **options)
    return out.filter(F.col(names["kept"])).select(*docs.columns)
