"""Mixing sources to target weights, in DataFrame operations only.

Sizes are summed by source (pre-aggregated in each task, so a hot source costs no more than others), targets come
from weights with a cap on repetition, and every document is emitted floor(rate) times plus once more when a number
hashed from seed and id falls below the fraction of the rate. The same rows give the same copies on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.llm._common import fresh, n_words, stored

#: Weights of the sources in the order of their names, again and again.
WEIGHTS = (5, 2, 1)
#: No source is repeated more often than this.
MAX_REPEATS = 3
#: Source tables up to this many rows are broadcast; larger ones are joined by a shuffle.
BROADCAST_SOURCES = 50_000
#: Sources of a range that are counted off in one task.
SOURCES = 1_000_000
SEED = "mix-1"


def unit_hash(seed: str, key: Column) -> Column:
    """A number in [0, 1) from 52 bits of an MD5; any engine with MD5 gives the same."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def weighed(sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """One row for each source, with its weight w by its place in the order of names.

    Sources are dealt into ranges of about SOURCES and counted off in each; only the ranges' sizes, one row for each,
    meet in one task. So sources may be as many as hosts or pages.
    """
    sizes = stored(sizes, "sizes")
    ranges = sizes.count() // SOURCES + 1
    ranged = stored(sizes.repartitionByRange(ranges, F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    nth = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    placed = ranged.withColumn("nth", nth).join(starts, "part")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("start") + F.col("nth") - 1, F.lit(len(weights))) + 1).cast("int"))
    return stored(placed.select("source", "source_size", weight.alias("w")), "weights")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    A target is min(cap * source_size, level * weight). The level rises from that without caps: sources whose most it
    passes are capped, what they leave goes to the others, until no more are capped. Each step is one aggregation to
    two numbers; the steps are as many as there are waves of capped sources, no more than a few.
    """
    s = weighed(sizes, weights).withColumn("most", F.lit(cap) * F.col("source_size"))
    total, open_ = s.agg(F.sum("source_size"), F.sum("w")).first()
    level, n_capped = (total / open_ if open_ else 0.0), -1
    capped = lambda: F.col("most") / F.col("w") <= F.lit(level)
    while open_:
        n, full, open_ = s.agg(F.count_if(capped()), F.coalesce(F.sum(F.when(capped(), F.col("most"))), F.lit(0)), F.sum(F.when(~capped(), F.col("w")))).first()
        if n == n_capped or not open_:
            break
        level, n_capped = (total - full) / open_, n
    return s.select("source", "source_size", F.when(capped(), F.col("most").cast("double")).otherwise(F.lit(level) * F.col("w")).alias("target"))


def mix_plan(docs: DataFrame, size: Column | None = None, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_REPEATS, seed: str = SEED, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Every row of docs with mix_size, mix_source_size, mix_target (its source's) and mix_copies.

    Null sources are one source, ordered last; null texts have size 0. A source without words has target and copies 0.
    Equal rows draw the same number. An empty table gives an empty table. Columns of docs that bear one of the new
    names are kept: the new ones get leading underscores then.
    """
    size = n_words(text) if size is None else size
    names = {x: fresh(x, docs.columns) for x in ("mix_size", "mix_source_size", "mix_target", "mix_copies")}
    sizes = docs.select(F.col(source).alias("source"), size.alias("size")).groupBy("source").agg(F.sum("size").alias("source_size"))
    key = fresh("source__", [*docs.columns, *names.values()])
    plan = stored(source_targets(sizes, weights, cap), "sources").select(F.col("source").alias(key), F.col("source_size").alias(names["mix_source_size"]), F.col("target").alias(names["mix_target"]))
    if plan.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)  # beyond the bound: a sort-merge join, whose hot keys adaptive execution splits
    joined = docs.withColumn(names["mix_size"], size).join(plan, F.col(source).eqNullSafe(F.col(key)), "left")
    rate = F.when(F.col(names["mix_source_size"]) > 0, F.least(F.col(names["mix_target"]) / F.col(names["mix_source_size"]), F.lit(float(cap)))).otherwise(0.0)
    copies = F.floor(rate) + (unit_hash(seed, F.col(doc_id)) < rate - F.floor(rate)).cast("long")
    return joined.withColumn(names["mix_copies"], copies).drop(key)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each row of docs as often as the plan says, with the columns of docs."""
    plan = mix_plan(docs, **options)
    copies = plan.columns[-1]
    each = fresh("copy", plan.columns)
    return plan.withColumn(each, F.explode(F.array_repeat(F.lit(1), F.col(copies).cast("int")))).select(*docs.columns)
