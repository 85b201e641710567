"""Joins in time: the last row before another (as-of), and rows whose spans meet (interval join).

Neither compares ranges in the plan: times become slices or bins, which are joined or partitioned by equality, so no side is
broadcast for it, no nested loop runs, and a hot key's rows are dealt to many tasks by time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.functions.cast import fresh

#: Length of an as-of join's slices: the rows of one key and slice are sorted in one task.
SLICE_SECONDS = 3600
#: Slices among which rows without a time are dealt; they lie far before all others.
_TIMELESS, _BEFORE = 1024, 1 << 40
#: Width of the narrowest bins, how much wider each level's are than the last one's, and the number of levels (to 280 billion years).
BIN_MICROS, WIDER, LEVELS = 1_000_000, 4, 32


def micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def asof_join(left: DataFrame, right: DataFrame, by: list[str], at: str, take: list[str], right_at: str | None = None, order: list[str] | None = None, tolerance_seconds: float | None = None, exact: bool = True, forward: bool = False, prefix: str = "", slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Every row of left with columns `take` of the last row of right that has its key and is not later (exact=False: is earlier).

    forward asks for the next row in place of the last one. tolerance_seconds: rows further away don't match. Of right rows
    at one time the last by `order` counts. Rows of left without a match, a key or a time have nulls; rows of right
    without a key or a time match nothing. New columns are `take` with the prefix, which must not clash with left's.

    Both sides meet in one shuffle by (key, slice of time), where a window carries the last row of right along; the last rows of all
    slices, one small row for each, are carried from slice to slice by a second pass. A key has as many tasks as slices.
    """
    right_at, order, sign = right_at or at, order or [], -1 if forward else 1
    taken = [f"{prefix}{c}" for c in take]
    clash = {c.lower() for c in taken} & {c.lower() for c in left.columns}
    if clash:
        raise ValueError(f"left has {sorted(clash)} already; give a prefix")
    keys = [f"k{n}" for n in range(len(by))]
    span = slice_seconds * 1_000_000
    key_columns = [F.col(c).alias(k) for c, k in zip(by, keys, strict=True)]
    found = F.struct((sign * micros(right_at)).alias("us"), *(F.col(c).alias(f"o{n}") for n, c in enumerate(order)), F.struct(*(F.col(c).alias(t) for c, t in zip(take, taken, strict=True))).alias("row"))
    r = right.filter(F.col(right_at).isNotNull()).select(*key_columns, (sign * micros(right_at)).alias("us"), F.lit(0 if exact else 1).alias("side"), found.alias("found"))
    for k in keys:
        r = r.filter(F.col(k).isNotNull())
    r = r.withColumn("slice", F.floor(F.col("us") / span))
    own = F.struct(*left.columns)
    timeless = F.pmod(F.xxhash64(own), F.lit(_TIMELESS)) - _BEFORE
    l = left.select(*key_columns, (sign * micros(at)).alias("us"), F.lit(1 if exact else 0).alias("side"), own.alias("own"), timeless.alias("timeless"))
    l = l.withColumn("slice", F.coalesce(F.floor(F.col("us") / span), "timeless")).drop("timeless")
    nothing = F.lit(None)
    both = l.withColumn("found", nothing.cast(r.schema["found"].dataType)).unionByName(r.withColumn("own", nothing.cast(l.schema["own"].dataType)))
    here = Window.partitionBy(*keys, "slice").orderBy("us", "side", "found").rowsBetween(Window.unboundedPreceding, 0)
    placed = both.withColumn("last", F.last("found", ignorenulls=True).over(here)).filter(F.col("own").isNotNull())
    ends = l.select(*keys, "slice", F.lit(None).cast(r.schema["found"].dataType).alias("found")).unionByName(r.select(*keys, "slice", "found")).groupBy(*keys, "slice").agg(F.max("found").alias("end"))
    before = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*(F.col(k).alias(f"c{k}") for k in keys), F.col("slice").alias("cslice"), F.last("end", ignorenulls=True).over(before).alias("carried"))
    same = F.col("slice") == F.col("cslice")
    for k in keys:
        same = same & (F.col(k) == F.col(f"c{k}"))
    hit = F.coalesce("last", "carried")
    out = placed.join(carried, same, "left").select("own", "us", hit.alias("hit"))
    near = F.col("hit")["us"].isNotNull() & F.col("us").isNotNull()
    if tolerance_seconds is not None:
        near = near & (F.col("us") - F.col("hit")["us"] <= int(tolerance_seconds * 1_000_000))
    return out.select("own.*", *(F.when(near, F.col("hit")["row"][t]).alias(t) for t in taken))


def _level(width: Column) -> Column:
    """The first level whose bins are at least as wide."""
    return F.greatest(F.lit(0), F.least(F.lit(LEVELS - 1), F.ceil(F.log(width / BIN_MICROS) / math.log(WIDER)))).cast("int")


def _bin(us: str, level: str) -> Column:
    wide = F.array(*(F.lit(float(BIN_MICROS * WIDER**k)) for k in range(LEVELS)))
    return F.floor(F.col(us) / F.element_at(wide, F.col(level) + 1))


def overlap_join(left: DataFrame, right: DataFrame, by: list[str], left_span: tuple[str, str], right_span: tuple[str, str], prefix: str = "right_") -> DataFrame:
    """Pairs of rows of equal key whose spans [start, end) meet: left's columns, then right's other columns with the prefix.

    A span whose start is its end is a point. Spans that end before they start and rows with a null key, start or end meet nothing. Equal rows
    make as many pairs as there are of them.

    Each span has a level by its length, at which it touches no more than two bins; it also goes to the bins that it touches at each
    wider level that the other side has. Two spans are compared at the wider one of their levels, in the first bin that
    both touch, so each pair is found once. Work is that of spans which are close at their own scale, however different the lengths
    are; levels in use (at most LEVELS numbers) are asked for first.
    """
    rest = [c for c in right.columns if c not in by]
    names = [f"{prefix}{c}" for c in rest]
    clash = {c.lower() for c in names} & {c.lower() for c in left.columns}
    if clash:
        raise ValueError(f"left has {sorted(clash)} already; give another prefix")

    def side(df: DataFrame, span: tuple[str, str], x: str) -> DataFrame:
        a, b = micros(span[0]), micros(span[1])
        out = df.select(*(F.col(c).alias(f"{x}k{n}") for n, c in enumerate(by)), a.alias(f"{x}a"), F.when(a == b, b).otherwise(b - 1).alias(f"{x}b"), F.struct(*(left.columns if x == "l" else rest)).alias(f"{x}row"))
        for n in range(len(by)):
            out = out.filter(F.col(f"{x}k{n}").isNotNull())
        return out.filter(F.col(f"{x}b") >= F.col(f"{x}a")).withColumn(f"{x}level", _level(F.col(f"{x}b") - F.col(f"{x}a") + 1))

    sides = {"l": side(left, left_span, "l"), "r": side(right, right_span, "r")}
    # LEVELS numbers at most; counted, for the optimiser drops the aggregation of session windows below one that is merely distinct
    # points, whose start and end are one column, are all of the first level, so their side is not run for that
    points = {x for x, span in (("l", left_span), ("r", right_span)) if span[0] == span[1]}
    used = {x: [0] if x in points else sorted(row[0] for row in df.groupBy(f"{x}level").agg(F.count(F.lit(1))).collect()) for x, df in sides.items()}

    def dealt(x: str, other: str) -> DataFrame:
        wider = F.filter(F.array(*(F.lit(k) for k in used[other])).cast("array<int>"), lambda k: k > F.col(f"{x}level"))
        out = sides[x].withColumn(f"{x}at", F.explode(F.concat(F.array(F.col(f"{x}level")), wider)))
        out = out.withColumns({f"{x}first": _bin(f"{x}a", f"{x}at"), f"{x}last": _bin(f"{x}b", f"{x}at")})
        return out.withColumn(f"{x}bin", F.explode(F.sequence(f"{x}first", f"{x}last"))).drop(f"{x}last")

    on = (F.col("lat") == F.col("rat")) & (F.col("lbin") == F.col("rbin"))
    for n in range(len(by)):
        on = on & (F.col(f"lk{n}") == F.col(f"rk{n}"))
    once = (F.col("lat") == F.greatest("llevel", "rlevel")) & (F.col("lbin") == F.greatest("lfirst", "rfirst"))
    meet = (F.col("la") <= F.col("rb")) & (F.col("ra") <= F.col("lb"))
    met = dealt("l", "r").join(dealt("r", "l"), on).filter(once & meet)
    return met.select("lrow.*", *(F.col("rrow")[c].alias(n) for c, n in zip(rest, names, strict=True)))


def range_join(points: DataFrame, ranges: DataFrame, by: list[str], at: str, span: tuple[str, str], prefix: str = "range_") -> DataFrame:
    """Points with the ranges [start, end) of their key that hold them, as overlap_join pairs them."""
    return overlap_join(points, ranges, by, (at, at), span, prefix)
