"""Joins in time against plain versions, their plans, and hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from marlstone.operators import joins


def timed(spark, rows, names):
    df = spark.createDataFrame(rows, names)
    return df.withColumns({c: F.timestamp_seconds(c) for c in df.columns if c.endswith("at")})


def plain_asof(left, right, exact, forward, tolerance):
    out = {}
    for n, key, at in left:
        best = None
        for m, k, t in right:
            if key is None or at is None or k != key or t is None:
                continue
            gap = t - at if forward else at - t
            if gap < 0 or gap == 0 and not exact or tolerance is not None and gap > tolerance:
                continue
            if best is None or (-gap, m) > (-best[0], best[1]):
                best = gap, m
        out[n] = best and best[1]
    return out


@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("forward", [True, False])
@pytest.mark.parametrize("tolerance", [None, 90])
def test_asof_against_a_plain_version(spark, exact, forward, tolerance):
    r = random.Random(7)
    some = lambda n, span: [(k, r.choice(["a", "b", "c", None]), r.choice([r.randint(0, span)] * 9 + [None])) for k in range(n)]
    left, right = some(120, 2000), some(60, 2000)
    lf, rt = timed(spark, left, "n int, key string, at long"), timed(spark, right, "m int, key string, at long")
    got = joins.asof_join(lf, rt, ["key"], "at", ["m"], order=["m"], exact=exact, forward=forward, tolerance_seconds=tolerance, slice_seconds=50)
    assert got.columns == ["n", "key", "at", "m"]
    assert {x.n: x.m for x in got.collect()} == plain_asof(left, right, exact, forward, tolerance)


def test_asof_of_empty_sides_and_repeated_rows(spark):
    lf = timed(spark, [(1, "a", 10), (1, "a", 10), (2, None, 10)], "n int, key string, at long")
    rt = timed(spark, [(5, "a", 10), (5, "a", 10)], "m int, key string, at long")
    assert sorted((x.n, x.m) for x in joins.asof_join(lf, rt, ["key"], "at", ["m"]).collect()) == [(1, 5), (1, 5), (2, None)]
    assert [x.m for x in joins.asof_join(lf, rt.limit(0), ["key"], "at", ["m"]).collect()] == [None] * 3
    assert joins.asof_join(lf.limit(0), rt, ["key"], "at", ["m"]).count() == 0
    with pytest.raises(ValueError, match="prefix"):
        joins.asof_join(lf, lf, ["key"], "at", ["n"])


def test_asof_deals_a_hot_key_and_compares_no_ranges(spark):
    rows = spark.range(0, 20_000, 1, 4).select(F.col("id").alias("n"), F.lit("hot").alias("key"), F.timestamp_seconds(F.col("id")).alias("at"))
    quotes = rows.filter(F.col("n") % 500 == 0).select(F.col("n").alias("m"), "key", "at")
    got = joins.asof_join(rows, quotes, ["key"], "at", ["m"], slice_seconds=100)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert got.filter(F.col("m") != F.floor(F.col("n") / 500) * 500).count() == 0 and got.filter("m IS NULL").count() == 0
    sizes = [n for (n,) in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).select("n").collect()]
    dealt = rows.groupBy(F.pmod(F.hash("key", F.floor(F.unix_micros("at") / 100_000_000)), F.lit(4)).alias("p")).count().count()
    assert dealt == 4 and sum(sizes) == 20_000


def spans(r, n, span, widest):
    out = []
    for k in range(n):
        a = r.randint(0, span)
        out.append((k, r.choice(["a", "b", None]), r.choice([a] * 9 + [None]), r.choice([a, a + 1, a + int(4 ** r.uniform(0, widest)), a - 5])))
    return out


def meet(x, y):
    """Half-open spans in seconds, points being closed."""
    if x[1] is None or x[1] != y[1] or x[2] is None or y[2] is None:
        return False
    (a, b), (c, d) = x[2:], y[2:]
    if b < a or d < c:
        return False
    last = lambda s, e: s if s == e else e - 1e-6
    return a <= last(c, d) and c <= last(a, b)


@pytest.mark.parametrize("seed", range(3))
def test_overlap_against_a_plain_version(spark, seed):
    r = random.Random(seed)
    left, right = spans(r, 80, 5000, 6), spans(r, 60, 5000, 9)
    names = "n int, key string, from_at long, to_at long"
    got = joins.overlap_join(timed(spark, left, names), timed(spark, right, names), ["key"], ("from_at", "to_at"), ("from_at", "to_at"))
    assert got.columns == ["n", "key", "from_at", "to_at", "right_n", "right_from_at", "right_to_at"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    found = [(x.n, x.right_n) for x in got.collect()]
    assert len(found) == len(set(found)) and set(found) == {(x[0], y[0]) for x in left for y in right if meet(x, y)}


def test_points_in_ranges(spark):
    points = timed(spark, [(1, "a", 5), (2, "a", 10), (3, "b", 5), (1, "a", 5), (4, "a", None)], "n int, key string, at long")
    ranges = timed(spark, [("x", "a", 0, 10), ("y", "a", 5, 5), ("z", "a", 6, 1_000_000)], "name string, key string, from_at long, to_at long")
    got = joins.range_join(points, ranges, ["key"], "at", ("from_at", "to_at"))
    assert sorted((x.n, x.range_name) for x in got.collect()) == [(1, "x"), (1, "x"), (1, "y"), (1, "y"), (2, "z")]
    assert joins.range_join(points, ranges.limit(0), ["key"], "at", ("from_at", "to_at")).count() == 0


def test_sessions_as_spans(spark):
    """Aggregated session windows on both sides keep all their rows."""
    from marlstone.operators import metrics

    rows = timed(spark, [(k % 3, s) for k in range(30) for s in (k * 40_000, k * 40_000 + 30_000)], "u int, at long")
    sessions = metrics.sessions(rows, "at", ["u"], 43_200)
    pairs = joins.overlap_join(sessions, sessions, ["u"], ("session_start", "session_end"), ("session_start", "session_end"))
    each = [(x.u, x.session_start, x.session_end) for x in sessions.collect()]
    assert pairs.count() == sum(x[0] == y[0] and x[1] < y[2] and y[1] < x[2] for x in each for y in each)
