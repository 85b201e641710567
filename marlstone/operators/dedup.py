"""Duplicates of events: first by key, within a horizon, and against bounded memories of accepted ids."""

from __future__ import annotations

import functools
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from marlstone.config import SETTINGS
from marlstone.functions.cast import fresh
from marlstone.streaming import scratch

#: Accepted ids that a collector remembers.
CAPACITY = SETTINGS.capacity
#: Lanes among which the rows of one key are dealt.
LANES = 256
#: Stretches into which a bounded memory's sequence is cut at most: they are also the most rounds that it can take, but one.
STRETCHES = 16


def mark_repeats(df: DataFrame, keys: list[str], order: list[str], out: str = "is_duplicate", lanes: int = LANES, where: Column | None = None) -> DataFrame:
    """Every row with whether another of its key comes before it; of rows equal in order, too, just one is the first.

    Rows are ranked in lanes of their key, by a hash of the order, then the first rows of a key's lanes, at most one for
    each lane, among themselves. So the input is read once, and a hot key is dealt to many tasks; a key of few rows
    costs nothing more for it. Null keys are keys like any other. Rows without `where` repeat nothing and are no repeats.
    """
    lane, ok, nth = (fresh(n, df.columns) for n in ("lane", "counts", "nth"))
    counts = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    wide = df.withColumn(lane, F.pmod(F.xxhash64(*order), F.lit(lanes))).withColumn(ok, counts)
    by = [F.col(k) if where is None else F.when(F.col(ok), F.col(k)) for k in keys]
    wide = wide.withColumn(nth, F.row_number().over(Window.partitionBy(*by, ok, lane).orderBy(*order)))
    front = F.when(F.col(nth) == 1, F.lit(-1).cast("long")).otherwise(F.col(lane))
    among = F.row_number().over(Window.partitionBy(*by, ok, front).orderBy(*order))
    return wide.withColumn(out, among > 1).withColumn(out, F.col(ok) & ((F.col(nth) > 1) | F.col(out))).drop(lane, ok, nth)


def first_of_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; all columns travel in one partial aggregate."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return best.select(*keys, "__row.*").select(*df.columns)


def _folded(df: DataFrame, by: list[str], order: list[str], values: list[Column], fold, out: str, one_partition: bool = False, where: Column | None = None) -> DataFrame:
    """df with a boolean column that `fold()`, a fresh function for each key, gives for the values, row after row.

    Partitions are sorted by key and order and streamed; a task holds one key's state at a time. Rows without `where` get
    false; they are dealt by their order, whatever their key.
    """
    given: list[Column] = [F.col(k) for k in by]
    if where is not None:
        counts = F.coalesce(where, F.lit(False))
        given = [F.when(counts, F.lit(-1).cast("long")).otherwise(F.pmod(F.xxhash64(*order), F.lit(LANES))), *(F.when(counts, k) for k in given)]
    names: list[str] = []
    for _ in range(len(values) + len(given)):
        names.append(fresh("v", [*df.columns, *names]))
    wide = df.withColumns(dict(zip(names, [*given, *values], strict=True)))
    keys, inputs = names[: len(given)], names[len(given) :]
    dealt = wide.coalesce(1) if one_partition else wide.repartition(*keys)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.BooleanType(), False)])
    columns, flagged = df.columns, where is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, step = None, fold()
        for batch in batches:
            ks = zip(*(batch.column(k).to_pylist() for k in keys), strict=True) if keys else [()] * batch.num_rows
            found = []
            for key, value in zip(ks, zip(*(batch.column(c).to_pylist() for c in inputs), strict=True), strict=True):
                if key != last:
                    last, step = key, fold()
                found.append(step(*value) if not flagged or key[0] == -1 else False)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(found, pa.bool_())], names=[*columns, out])

    return dealt.sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def accept_by_horizon(df: DataFrame, keys: list[str], ts: str, seconds: int, order: list[str] | None = None, out: str = "accepted") -> DataFrame:
    """Whether each row is accepted: no row of its key was in the `seconds` before it.

    A suppressed row does not prolong the horizon; exactly at its end rows are accepted again. Null times are never
    accepted.
    """
    span = seconds * 1_000_000

    def fold():
        last = None

        def step(us):
            nonlocal last
            if us is None or last is not None and us < last + span:
                return False
            last = us
            return True

        return step

    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    return _folded(df, keys, [ts, *(order or [])], [micros], fold, out)


def accept_by_session(df: DataFrame, keys: list[str], ts: str, seconds: int, order: list[str] | None = None, out: str = "accepted") -> DataFrame:
    """Whether each row opens a session: its key had no row at all in the `seconds` before it."""
    before = F.lag(ts).over(Window.partitionBy(*keys).orderBy(ts, *(order or [])))
    gap = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(before.cast("timestamp"))
    return df.withColumn(out, F.coalesce(gap >= seconds * 1_000_000, F.col(ts).isNotNull()))


def accept_by_memory(df: DataFrame, ids: list[str], order: list[str], scope: list[str] | None = None, capacity: int = CAPACITY, out: str = "accepted", where: Column | None = None) -> DataFrame:
    """Whether each row is accepted against a memory of the last `capacity` accepted values of each id column.

    Rows without `where` are not accepted and leave no trace.

    A row is a duplicate if any of its ids is remembered, and then leaves no trace; an accepted row enters all its
    ids and pushes out the oldest. The outcome depends on the order of all rows of a scope: without a scope this is
    one sequence and runs in one task, which is exact and doesn't scale; with one, each scope is a sequence.
    """

    def fold():
        seen = [set() for _ in ids]
        line = [deque() for _ in ids]

        def step(*values):
            if any(v in s for v, s in zip(values, seen, strict=True)):
                return False
            for v, s, q in zip(values, seen, line, strict=True):
                q.append(v)
                s.add(v)
                if len(q) > capacity:
                    s.discard(q.popleft())
            return True

        return step

    return _folded(df, scope or [], order, [F.col(c) for c in ids], fold, out, one_partition=not scope, where=where)



def bounded_memory(df: DataFrame, ids: list[str], order: list[str], capacity: int = CAPACITY, out: str = "accepted", where: Column | None = None, stretch: int | None = None) -> tuple[DataFrame, int]:
    """What accept_by_memory gives without a scope, in parallel; and the rounds that it took.

    A row is a duplicate if no more than `capacity` rows were accepted since, and with, the last accepted one with an id of its. The
    order is cut into stretches of `stretch` rows (4 * capacity), longer ones where these were more than STRETCHES, each of which is one
    sequence in one task, which holds no more than its memory. It starts from
    the accepted rows before it that may still be remembered; first ones are guessed (each id's first row), then those that
    the round before has accepted, until no row changes. Each round settles at least one more stretch, so the end is the one
    sequence's own outcome; as a memory mostly soon forgets what it started from, few rounds are needed. Where it never does, each round
    settles one stretch: that is why their number is bounded, whatever the rows'. Settled stretches take no part in later rounds.

    df is written once, with a number for each row. Rows whose ids come once are always accepted: they are counted up front and take
    no further part. A round shuffles and writes narrow rows of the others: number, place, hashed ids; an accepted one
    also goes to the stretches, mostly the next one, that may remember it. Rows that are equal in order are taken in the
    order of their number. Null ids are ids like any other.
    """
    spark, base = df.sparkSession, scratch.folder(df.sparkSession, "memory")

    def stored(x: DataFrame, name: str) -> DataFrame:
        x.write.parquet(f"{base}/{name}")
        return spark.read.schema(x.schema).parquet(f"{base}/{name}")

    row, ok = fresh("row", df.columns), fresh("counts", df.columns)
    counts = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    whole = stored(df.withColumn(ok, counts).withColumn(row, F.monotonically_increasing_id()), "rows")
    keys, sort = [f"id{k}" for k in range(len(ids))], [*(f"o{k}" for k in range(len(order))), "row"]
    named = [F.coalesce(F.unhex(F.md5(F.col(c).cast("string").cast("binary"))), F.lit(b"")).alias(k) for c, k in zip(ids, keys, strict=True)]
    narrow = whole.filter(ok).select(*named, *(F.col(c).alias(o) for c, o in zip(order, sort, strict=False)), F.col(row).alias("row"))
    again = F.lit(False)
    for k in keys:
        narrow = narrow.join(narrow.groupBy(k).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(k, F.lit(True).alias(f"{k}_again")), k, "left")
        again = again | F.col(f"{k}_again").isNotNull()
    placed = stored(narrow.select(*keys, *sort, again.alias("again")).repartitionByRange(*sort).withColumn("range", F.spark_partition_id()), "placed")
    # places in the order and sums before them, through the ranges, of which there are as many as partitions
    within, earlier = Window.partitionBy("range").orderBy(*sort).rowsBetween(Window.unboundedPreceding, -1), Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = {"pos": F.lit(1).cast("long"), "fixed": (~F.col("again")).cast("long")}
    before = placed.groupBy("range").agg(*(F.sum(c).alias(n) for n, c in sums.items())).select("range", *(F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}0") for n in sums))
    at = placed.select(*keys, "row", "again", "range", *(F.coalesce(F.sum(c).over(within), F.lit(0)).alias(n) for n, c in sums.items())).join(before, "range")
    length = max(stretch or max(1000, 4 * capacity), -(-placed.count() // STRETCHES))
    part = F.floor((F.col("pos") + F.col("pos0")) / length).alias("part")
    at = stored(at.select(*keys, "row", "again", (F.col("pos") + F.col("pos0")).alias("pos"), (F.col("fixed") + F.col("fixed0")).alias("fixed"), part), "at")
    bases = stored(at.groupBy("part").agg(F.min("fixed").alias("fixed0")), "bases")
    first = F.lit(True)
    for k in keys:
        first = first & (F.row_number().over(Window.partitionBy(k).orderBy("pos")) == 1)
    guess = at.filter("again").join(bases, "part").select(*keys, "row", "part", "pos", (F.col("fixed") - F.col("fixed0")).alias("gap"), first.alias("flag"), F.lit(None).cast("boolean").alias("was"))
    so_far = Window.partitionBy("part").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    open_ = stored(guess.withColumn("n", F.col("gap") + F.coalesce(F.sum(F.col("flag").cast("long")).over(so_far), F.lit(0))), "guess")
    rounds, by, settled, last = 0, Window.orderBy("part"), [], -1
    while True:
        rounds += 1
        guess = functools.reduce(DataFrame.unionByName, settled, open_)
        taken = guess.groupBy("part").agg(F.sum(F.col("flag").cast("long")).alias("taken"))
        starts = bases.join(taken, "part", "left").select("part", (F.col("fixed0") + F.coalesce(F.sum("taken").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("start"))
        starts = starts.withColumn("reach", F.max("part").over(Window.orderBy("start").rangeBetween(0, capacity)))
        starts = starts.withColumn("reach", F.lead("reach").over(by))  # the last stretch that may remember a row of this one
        lent = guess.filter("flag").join(starts.filter("reach > part"), "part").withColumn("to", F.explode(F.sequence(F.col("part") + 1, "reach"))).withColumn("n", F.col("start") + F.col("n"))
        lent = lent.drop("part", "start").join(starts.select(F.col("part").alias("to"), "start"), "to").withColumn("n", F.col("n") - F.col("start")).filter(F.col("n") >= -capacity)
        lent = lent.filter(F.col("to") > last).select(*keys, "row", F.col("to").alias("part"), "pos", "gap", F.lit(None).cast("boolean").alias("flag"), "was", "n")
        both = open_.unionByName(lent).withColumn("own", F.col("flag").isNotNull()).repartition("part").sortWithinPartitions("part", "own", "pos")
        told = stored(both.mapInArrow(_remembered(keys, capacity, open_.columns), open_.schema), f"round{rounds}")
        # what comes before the first change started from what will not change any more, and so did the stretch of that change
        first_changed = told.filter("flag <> was").agg(F.min("part")).first()[0]
        if first_changed is None:
            settled.append(told)
            break
        last = first_changed
        settled.append(told.filter(F.col("part") <= last))
        open_ = told.filter(F.col("part") > last)
    flags = functools.reduce(DataFrame.unionByName, settled).select(F.col("row").alias(row), F.col("flag").alias(out))
    got = whole.join(flags, row, "left").withColumn(out, F.col(ok) & F.coalesce(F.col(out), F.lit(True)))
    return got.select(*df.columns, out), rounds


def _remembered(keys: list[str], capacity: int, columns: list[str]):
    """Stretches, sorted, each with what is lent to it in front, to their own rows with flags decided in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch, taken, seen = None, 0, [{} for _ in keys]
        for batch in batches:
            flags, places = [], []
            for part, own, n, gap, *values in zip(*(batch.column(c).to_pylist() for c in ("part", "own", "n", "gap", *keys)), strict=True):
                if part != stretch:
                    stretch, taken, seen = part, 0, [{} for _ in keys]
                if own:
                    n = gap + taken
                    fine = all(n - s.get(v, n - capacity - 1) > capacity for v, s in zip(values, seen, strict=True))
                    taken += fine
                    flags.append(fine)
                    places.append(n)
                if not own or fine:
                    for v, s in zip(values, seen, strict=True):
                        s[v] = n
            mine = batch.filter(batch.column("own"))
            new = {"was": mine.column("flag"), "flag": pa.array(flags, pa.bool_()), "n": pa.array(places, pa.int64())}
            yield pa.RecordBatch.from_arrays([new[c] if c in new else mine.column(c) for c in columns], names=columns)

    return run
