"""Books over messages, sketches by hour, sessions over micro-batches, and topics."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from marlstone.__main__ import main
from marlstone.operators import reconcile, sketches
from marlstone.sources import topics
from marlstone.streaming import sinks, stateful, tables
from test_messages import message
from test_tables import put, stream_of
from topic_transport import taken


def raw(spark, values):
    return spark.createDataFrame([(v,) for v in values], "raw string")


def test_books_balance(spark):
    came = ["a", "a", "b", "c", None, "", "hot"] + ["hot"] * 500
    lanes = {"table_": raw(spark, ["a", "b", "hot"]), "duplicate": raw(spark, ["a"] + ["hot"] * 500), "dead": raw(spark, ["c", None, ""])}
    book = reconcile.books(raw(spark, came), lanes)
    assert reconcile.misfits(book).count() == 0
    assert {r.lane: r.n for r in reconcile.totals(book).collect()} == {"came": 507, "table_": 3, "duplicate": 501, "dead": 3, "lost": 0, "surplus": 0}


def test_books_find_what_is_lost_or_too_many(spark):
    r = random.Random(2)
    came = [f"m{r.randint(0, 40)}" for _ in range(300)]
    kept = list(came)
    lost = [kept.pop(r.randrange(len(kept))) for _ in range(20)]
    extra = ["new", "m1", "m1"]
    book = reconcile.books(raw(spark, came), {"table_": raw(spark, kept[:100]), "dead": raw(spark, kept[100:] + extra)})
    want = collections.Counter(lost)
    want.subtract(extra)
    import hashlib

    got = {x.digest: x.balance for x in reconcile.misfits(book).collect()}
    assert got == {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items() if v}
    none = reconcile.totals(reconcile.books(raw(spark, []), {"table_": raw(spark, [])}))
    assert {x.lane: x.n for x in none.collect()} == {"came": 0, "table_": 0, "lost": 0, "surplus": 0}


def test_sketches_roll_up(spark):
    rows = spark.range(0, 200_000, 1, 8).select(F.lit("s").alias("stream"), (F.col("id") % 50_000).alias("who"), (F.col("id") % 1000).cast("double").alias("x"), F.timestamp_seconds(F.col("id")).alias("at"))
    hours = sketches.hourly(rows, ["stream"], "at", "who", "x")
    assert hours.count() == 56
    day = sketches.rolled(hours, ["stream"], None).select("n", sketches.distinct_count().alias("d"), sketches.quantile(0.9).alias("q"), F.length("hll").alias("bytes")).first()
    assert day.n == 200_000 and abs(day.d - 50_000) < 2500 and abs(day.q - 900) < 30 and day.bytes < 10_000
    two = sketches.rolled(sketches.rolled(hours, ["stream"], "day").withColumnRenamed("day", "hour"), ["stream"], None)
    assert abs(two.select(sketches.distinct_count()).first()[0] - 50_000) < 2500
    nothing = sketches.hourly(rows.withColumn("who", F.lit(None).cast("long")).withColumn("x", F.lit(None).cast("double")).limit(10), ["stream"], "at", "who", "x")
    assert sketches.rolled(nothing, ["stream"], "day").select("n", sketches.distinct_count()).first()[:] == (10, 0)


def test_a_story_told_again_and_again_is_one_session(spark, tmp_path):
    hour = 3600
    batches = [[(0, "a", 0), (1, "b", 1)], [(2, "a", 11)], [(3, "a", 22), (4, None, 22)], [(5, "a", 33), (6, "b", 30)], [(7, "c", 60)], [(8, "c", 61)]]
    s = stream_of(spark, tmp_path / "s", batches, "n long, story string, h long").withColumn("at", F.timestamp_seconds((F.col("h") + 100) * hour))
    out = stateful.accept_by_session(s, "story", "at", 12 * hour, "n", 0)
    t = tables.BatchTable(spark, str(tmp_path / "out"))
    q = sinks.started(out.writeStream.foreachBatch(lambda df, b: t.commit(df, "q", b) and None).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True), spark, empty_batches=True)
    assert q.awaitTermination(240)
    got = t.read(out.schema).collect()
    assert sorted(r.row.n for r in got if r.kind == "accepted") == [0, 1, 4, 6, 7]
    us = hour * 1_000_000
    assert sorted((str(r.key), r.session_start // us - 100, r.session_end // us - 100, r.n) for r in got if r.kind == "session") == [("None", 22, 34, 1), ("a", 0, 45, 4), ("b", 1, 13, 1), ("b", 30, 42, 1)]


def test_states_of_sessions_grow_with_lanes_and_not_with_keys(spark, tmp_path):
    """Many keys, some null or not a number, equal times and nulls in what is carried: the sessions of a sequence, in 16 states at most."""
    hour, us = 3600, 3_600_000_000
    nan, rows = float("nan"), []
    for n in range(3000):
        k = n * 7919 % 600
        rows.append((n, None if k == 0 else nan if k == 1 else k / 2, 1 + n // 25 + (n * 31 % 7) / 8, None if n % 3 else 2**53 + n))
    batches = [[r for r in rows if 30 * b < r[2] <= 30 * b + 30] for b in range(5)] + [[(3000, -1.0, 400.0, None)]]
    s = stream_of(spark, tmp_path / "s", batches, "n long, story double, h double, big long").withColumn("at", F.timestamp_micros((F.col("h") * us).cast("long")))
    out = stateful.accept_by_session(s, "story", "at", 12 * hour, "n", 0, lanes=16)
    t = tables.BatchTable(spark, str(tmp_path / "out"))
    q = sinks.started(out.writeStream.foreachBatch(lambda df, b: t.commit(df, "q", b) and None).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True), spark, empty_batches=True)
    assert q.awaitTermination(240)
    assert 0 < max(o["numRowsTotal"] for p in q.recentProgress for o in p["stateOperators"]) <= 64  # a state and a timer's three entries

    accepted, sessions, open_ = [], [], {}
    for n, k, h, big in sorted(rows, key=lambda r: (r[2], r[0])):
        k = str(k)
        if k in open_ and h < open_[k][1] + 12:
            open_[k] = (open_[k][0], h, open_[k][2] + 1)
            continue
        accepted.append((n, k, h, big))
        if k in open_:
            sessions.append((k, *open_[k]))
        open_[k] = (h, h, 1)
    sessions += [(k, *x) for k, x in open_.items()]
    got = t.read(out.schema).withColumn("hours", F.unix_micros("row.at") / us).collect()
    assert sorted((r.row.n, str(r.row.story), r.hours, r.row.big) for r in got if r.kind == "accepted" and r.row.n < 3000) == sorted(accepted)
    assert all(str(r.key) == str(r.row.story) for r in got if r.kind == "accepted")
    assert sorted((str(r.key), r.session_start / us, r.session_end / us - 12, r.n) for r in got if r.kind == "session") == sorted(sessions)
    assert len(sessions) > 1000


@pytest.mark.parametrize("fails", [0, 3])
def test_topic_gets_every_message_of_a_batch(spark, tmp_path, fails):
    df = spark.range(0, 250, 1, 2).select(F.col("id").cast("string").cast("binary").alias("value"))
    topics.publish(df, "tests.topic_transport:broker", path=str(tmp_path / "t"), lot="40", wait="0.01", fails=str(fails))
    got = taken(tmp_path / "t")
    assert set(got) == {str(k) for k in range(250)} and (len(got) == 250 or fails)


def test_topic_gives_up_and_a_stream_sends_again(spark, tmp_path):
    df = spark.range(0, 3, 1, 1).select(F.col("id").cast("string").cast("binary").alias("value"))
    with pytest.raises(Exception, match="planned"):
        topics.publish(df, "tests.topic_transport:broker", path=str(tmp_path / "t"), attempts="2", wait="0.01", fails="100")
    stream = stream_of(spark, tmp_path / "s", [[("a",), ("b",)], [("c",), (None,)]], "text string").select(F.col("text").cast("binary").alias("value"))
    start = lambda fails: topics.publish(stream, "tests.topic_transport:broker", str(tmp_path / "ck"), path=str(tmp_path / "u"), attempts="2", wait="0.01", fails=fails)
    with pytest.raises(Exception, match="planned"):
        start("40").awaitTermination(120)
    assert start("1").awaitTermination(120)  # the broker is back
    got = taken(tmp_path / "u")
    assert set(got) == {"a", "b", "c", ""}


def test_a_collector_sends_its_events(spark, tmp_path):
    put(tmp_path / "in", 0, [message("trades", i=1), message("trades", i=1), message("trades", p=0), message("trades", i=2)])
    line = ["trades", "--collect", "--stream", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--checkpoint", str(tmp_path / "ck"), "--topic", "tests.topic_transport:broker", "--topic-option", f"path={tmp_path / 't'}"]
    main(line, spark)
    put(tmp_path / "in", 1, [message("trades", i=2), message("trades", i=3)])
    main(line, spark)
    import json

    assert sorted(json.loads(m)["i"] for m in taken(tmp_path / "t")) == [1, 2, 3]
    with pytest.raises(SystemExit):
        main(["trades", "--collect", "--input", "x", "--output", "y", "--topic", "a:b"], spark)
