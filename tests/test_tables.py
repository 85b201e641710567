"""Tables that outlive restarts, streams joined in time, metrics kept from batch to batch, keyed memories."""

import json
import os
import random
import urllib.request
from collections import deque
from threading import Thread

import pytest
from pyspark.sql import functions as F

from marlstone.operators import dedup, exposition, metrics
from marlstone.sources import feeds, files
from marlstone.streaming import collector, joins, running, sinks, stateful, tables
from test_messages import message


def put(path, k, values):
    path.mkdir(exist_ok=True)
    (path / f"{k}.txt").write_bytes(b"\n".join(values) + b"\n")
    os.utime(path / f"{k}.txt", (1_700_000_000 + k,) * 2)


def run(spark, tmp_path, where, checkpoint):
    stream = files.messages(spark, str(tmp_path / where), stream=True, files_per_batch=1)
    return sinks.run_pipeline(stream, "trades", str(tmp_path / "main"), str(tmp_path / checkpoint), str(tmp_path / "dead"))


def ids(spark, tmp_path, table="main"):
    return sorted(r.trade_id for r in spark.read.parquet(str(tmp_path / table)).collect())


def test_two_checkpoints_keep_all_rows(spark, tmp_path):
    put(tmp_path / "one", 0, [message("trades", i=10), message("trades", i=11), b"oops"])
    put(tmp_path / "one", 1, [message("trades", i=12)])
    put(tmp_path / "two", 0, [message("trades", i=20)])
    assert run(spark, tmp_path, "one", "ck1").awaitTermination(120)
    assert run(spark, tmp_path, "two", "ck2").awaitTermination(120)
    assert ids(spark, tmp_path) == [10, 11, 12, 20]
    put(tmp_path / "one", 2, [message("trades", i=13)])
    assert run(spark, tmp_path, "one", "ck1").awaitTermination(120)
    assert ids(spark, tmp_path) == [10, 11, 12, 13, 20] and spark.read.parquet(str(tmp_path / "dead")).count() == 1


@pytest.mark.parametrize("when", ["between write and commit", "between the two tables", "after both"])
def test_a_killed_batch_counts_once(spark, tmp_path, monkeypatch, when):
    put(tmp_path / "in", 0, [message("trades", i=1), b"oops"])
    put(tmp_path / "in", 1, [message("trades", i=2), b"oops"])
    calls, publish = [], tables.BatchTable.publish

    def dying(self, staged, query, batch):
        calls.append(batch)
        n = calls.count(1)
        if batch == 1 and n == 1 and when == "between write and commit":
            raise RuntimeError("killed")
        done = publish(self, staged, query, batch)
        if batch == 1 and n == (1 if when == "between the two tables" else 2) and when != "between write and commit":
            raise RuntimeError("killed")
        return done

    monkeypatch.setattr(tables.BatchTable, "publish", dying)
    with pytest.raises(Exception, match="killed"):
        run(spark, tmp_path, "in", "ck").awaitTermination(120)
    monkeypatch.setattr(tables.BatchTable, "publish", publish)
    assert run(spark, tmp_path, "in", "ck").awaitTermination(120)
    assert ids(spark, tmp_path) == [1, 2] and spark.read.parquet(str(tmp_path / "dead")).count() == 2
    left = sum(tables.BatchTable(spark, str(tmp_path / t)).vacuum(-60) for t in ("main", "dead"))
    assert left == (when == "between write and commit") and ids(spark, tmp_path) == [1, 2]


def test_batch_table(spark, tmp_path):
    t = tables.BatchTable(spark, str(tmp_path / "t"))
    df = spark.createDataFrame([(1,), (2,)], "n int")
    assert t.read(df.schema).count() == 0 and t.read(df.schema).columns == ["n", "query", "batch"]
    with pytest.raises(ValueError, match="schema"):
        t.read()
    assert t.commit(df, "q", 0) and not t.commit(df, "q", 0) and t.commit(df, "r", 0)
    one, other = t.stage(df), t.stage(df)  # two writers of one batch
    assert t.publish(one, "q", 1) and not t.publish(other, "q", 1)
    assert sorted((r.n, r["query"], r.batch) for r in t.read(df.schema).collect()) == sorted((n, q, b) for n in (1, 2) for q, b in (("q", 0), ("q", 1), ("r", 0)))
    assert t.batch("q", 1).count() == 2 and t.vacuum(0) == 0
    with pytest.raises(ValueError, match="rename"):
        tables.BatchTable(spark, "s3a://b/t")


def memory_model(rows, capacity):
    seen, line, out = [set() for _ in rows[0]], [deque() for _ in rows[0]], []
    for values in rows:
        fine = not any(v in s for v, s in zip(values, seen, strict=True))
        out.append(fine)
        for v, s, q in zip(values, seen, line, strict=True):
            if fine:
                q.append(v)
                s.add(v)
                if len(q) > capacity:
                    s.discard(q.popleft())
    return out


@pytest.mark.parametrize("capacity, two, most", [(3, True, 6), (50, False, 70), (50_000, False, 300)])
def test_bounded_memory_is_the_sequence(spark, capacity, two, most):
    r = random.Random(capacity)
    rows = [(r.choice([None, *range(most)]), r.randint(0, most))[: 1 + two] for _ in range(1500)]
    df = spark.createDataFrame([(k, *row) for k, row in enumerate(rows)], "k int, a int" + ", b int" * two).repartition(5)
    got, rounds = dedup.bounded_memory(df, ["a", "b"][: 1 + two], ["k"], capacity, stretch=200)
    assert got.columns == [*df.columns, "accepted"]
    assert [x.accepted for x in sorted(got.collect(), key=lambda x: x.k)] == memory_model(rows, capacity)
    assert rounds <= 9  # stretches, and one that changes nothing


def test_bounded_memory_of_awkward_rows(spark):
    df = spark.createDataFrame([(k, k % 2, k % 5 != 0) for k in range(20)] + [(7, 1, True)], "n int, a int, ok boolean")
    got, _ = dedup.bounded_memory(df, ["a"], ["n"], 1, where=F.col("ok"))
    model = memory_model([(k % 2,) for k in range(20) if k % 5], 1)
    flags = {}
    for x in got.collect():
        flags.setdefault(x.n, []).append(x.accepted)
    assert [flags[k][0] for k in range(20) if k % 5 and k != 7] == [f for k, f in zip([k for k in range(20) if k % 5], model, strict=True) if k != 7]
    assert not any(flags[k][0] for k in (0, 5, 10, 15)) and sorted(flags[7]) == [False, True]
    assert dedup.bounded_memory(df.limit(0), ["a"], ["n"], 3)[0].count() == 0
    hot = spark.range(0, 9000, 1, 6).select(F.col("id").alias("n"), F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("a"))
    got, rounds = dedup.bounded_memory(hot, ["a"], ["n"], 100)
    rows = [(-1 if k % 3 == 0 else k,) for k in range(9000)]
    assert [x.accepted for x in sorted(got.collect(), key=lambda x: x.n)] == memory_model(rows, 100) and rounds <= 23
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Coalesce 1" not in plan


def stream_of(spark, path, batches, schema):
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(path))
        for f in path.glob("part-*"):
            if os.stat(f).st_mtime > 1_690_000_000 + 1000:
                os.utime(f, (1_600_000_000 + k * 60,) * 2)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(path))


def drained(spark, df, tmp_path, mode="append"):
    t = tables.BatchTable(spark, str(tmp_path / "out"))
    write = lambda rows, batch: t.commit(rows, "q", batch) and None
    q = sinks.started(df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True), spark)
    assert q.awaitTermination(180)
    return t.read(df.schema), q


def test_streams_joined_in_time(spark, tmp_path):
    schema = "n long, s string, sec long"
    timed = lambda df: df.select("n", "s", F.timestamp_seconds("sec").alias("at"))
    r = random.Random(1)
    rows = [[(100 * b + k, r.choice("ab"), 1000 * b + r.randint(0, 999)) for k in range(25)] for b in range(4)]
    other = [[(100 * b + k, r.choice("ab"), 1000 * b + r.randint(0, 999)) for k in range(25)] for b in range(4)]
    left, right = stream_of(spark, tmp_path / "l", rows, schema), stream_of(spark, tmp_path / "r", other, schema)
    got, q = drained(spark, joins.join_streams(timed(left), timed(right), ["s"], "at", "at", 60, 5, 1000), tmp_path)
    want = {(a[0], b[0]) for x in rows for a in x for y in other for b in y if a[1] == b[1] and -60 <= b[2] - a[2] <= 5}
    assert {(x.n, x.right_n) for x in got.collect()} == want and got.count() == len(want)
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert max(kept) < 200  # rows of both sides: what the watermark has passed is gone
    batch = joins.join_streams(timed(spark.read.schema(schema).json(str(tmp_path / "l"))), timed(spark.read.schema(schema).json(str(tmp_path / "r"))), ["s"], "at", "at", 60, 5, 0)
    assert {(x.n, x.right_n) for x in batch.collect()} == want


@pytest.mark.parametrize("before,after,how", [(60, 5, "inner"), (60, 5, "leftOuter"), (0, 0, "inner"), (0, 90, "leftOuter")])
def test_joined_in_bins_of_time(spark, before, after, how):
    r = random.Random(7)
    rows = [[(n, r.choice(["a", "a", None]), r.choice([None, *range(-200, 200)])) for n in range(300)] for _ in "lr"]
    timed = [spark.createDataFrame(x, "n long, s string, sec long").select("n", "s", F.timestamp_seconds("sec").alias("at")) for x in rows]
    got = joins.join_streams(*timed, ["s"], "at", "at", before, after, 0, how)
    want = [(a[0], b[0]) for a in rows[0] for b in rows[1] if None not in (*a, *b) and a[1] == b[1] and -before <= b[2] - a[2] <= after]
    if how != "inner":
        want += [(n, None) for n in {a[0] for a in rows[0]} - {a for a, _ in want}]
    assert sorted(((x.n, x.right_n) for x in got.collect()), key=str) == sorted(want, key=str) and got.columns == ["n", "s", "at", "right_n", "right_s", "right_at"]
    assert "bin" in got._jdf.queryExecution().executedPlan().toString()  # a key's rows do not all meet each other


def test_windows_under_a_watermark(spark, tmp_path):
    hour = 3600
    rows = [[(0, "valid", 10), (1, "invalid", 20)], [(2, "valid", hour + 1), (3, "duplicate", 30)], [(4, "valid", 5 * hour)], [(7, "valid", 5 * hour + 2)], [(5, "valid", 40), (6, "valid", 5 * hour + 1)]]
    status = stream_of(spark, tmp_path / "s", [[(n, "trades", st, at) for n, st, at in b] for b in rows], "arrival_seq long, stream string, status string, at long").withColumn("arrival_ts", F.timestamp_seconds("at"))
    out, q = drained(spark, joins.quality_windows(status, 600), tmp_path, "update")
    got = {r.window_start.timestamp(): (r.window_received, r.window_valid, r.window_duplicates) for r in joins.latest(out, ["stream", "window_start"]).collect()}
    assert {int(k) % (24 * hour) // hour: v for k, v in got.items()} == {0: (3, 1, 1), 1: (1, 1, 0), 5: (3, 3, 0)}
    assert joins.late_rows(q.recentProgress) == 1


def test_first_of_each_key_over_batches(spark, tmp_path):
    rows = [[(0, "a", True), (1, "a", True), (2, "b", False)], [(3, "b", True), (4, "a", True), (5, None, True)], [(6, "b", True), (7, None, True), (8, "c", True)]]
    s = stream_of(spark, tmp_path / "s", rows, "n long, k string, ok boolean")
    for ttl in (None, 3600):
        (tmp_path / str(ttl)).mkdir()
        got, _ = drained(spark, stateful.mark_first(s, "k", "n", F.col("ok"), ttl), tmp_path / str(ttl))
        assert {r.n for r in got.filter("accepted").collect()} == {0, 3, 5, 8} and got.count() == 9


def status_rows(spark, n, start):
    """Rows of three streams from a second on, more than a mean's samples in a window."""
    k = F.col("id")
    status = F.when(k % 20 == 0, "invalid").when(k % 20 == 1, "duplicate").when(k % 20 == 2, "ignored").otherwise("valid")
    df = spark.range(n).select(
        F.when(k % 7 == 0, "crypto").when(k % 7 < 4, "quotes").otherwise("trades").alias("stream"), k.cast("decimal(38,0)").alias("arrival_seq"), F.timestamp_seconds(F.lit(start) + k).alias("arrival_ts"), status.alias("status"),
        F.when(status == "valid", (k % 512) / 256.0).alias("freshness_seconds"), F.when((status == "valid") & (k % 7 < 4) & (k % 7 > 0), (k % 64) / 128.0).alias("spread"), F.when(status == "invalid", (k % 50) / 16.0).alias("detection_ms"),
    )
    return df


def test_running_metrics_equal_those_of_the_history(spark, tmp_path):
    n, start = 5000, 1_704_067_200
    df = status_rows(spark, n, start).cache()
    m = running.Running(spark, str(tmp_path))
    assert m.snapshot() == {}
    for b, (lo, hi) in enumerate(((0, 100), (100, 3500), (3500, 3500), (3500, n))):
        part = df.filter(F.col("arrival_seq").between(lo, hi - 1))
        m.update(part, "q", b)
        m.update(part, "q", b)  # a replay
        if hi > lo:
            now = start + hi - 1
            want = {r["stream"]: r.asDict() for r in metrics.snapshot(df.filter(F.col("arrival_seq") < hi), F.timestamp_seconds(F.lit(now))).collect()}
            got = m.snapshot(now)
            assert {k: {x: y for x, y in v.items() if x != "late"} for k, v in got.items()} == want
    assert all(v["late"] == 0 for v in m.snapshot().values()) and m.snapshot()["trades"]["window_received"] == 0
    assert len(m._files("q")["q"]) == running.KEPT
    m.update(df.filter("arrival_seq < 70"), "q", 9)
    assert m.snapshot(now)["trades"]["late"] > 0
    m.update(df, "other", 0)
    assert m.snapshot(now)["trades"]["total_received"] == m._row("trades", m._load(m._files("q")["q"][-1][1])["trades"], now, None)["total_received"] + want["trades"]["total_received"]


def test_endpoint_before_the_first_batch_and_after_thousands(spark, tmp_path):
    out = str(tmp_path / "out")
    asked = []

    def snapshots():
        asked.append(1)
        return collector.snapshots(spark, out)

    server = exposition.serve(snapshots, host="127.0.0.1", port=0)
    Thread(target=server.serve_forever, daemon=True).start()
    get = lambda path: urllib.request.urlopen(f"http://127.0.0.1:{server.server_port}{path}", timeout=60).read().decode()
    try:
        assert json.loads(get("/health"))["status"] == "ok" and not asked
        assert get("/metrics") == "" and json.loads(get("/metrics/json")) == {}
        m = running.Running(spark, out)
        m.update(status_rows(spark, 200, 1_704_067_200), "q", 9_999)
        (tmp_path / "out" / "status").mkdir()
        for b in range(10_000):  # a history that the endpoint has no need of
            (tmp_path / "out" / "status" / f"batch={b}").mkdir()
        assert "alpaca_collector_trades_total_received_total" in get("/metrics") and json.loads(get("/metrics/json"))["quotes"]["total_received"] > 0
        with pytest.raises(Exception, match="404"):
            get("/metrics/nothing")
    finally:
        server.shutdown()


def test_collectors_tables_outlive_a_new_checkpoint(spark, tmp_path):
    out = str(tmp_path / "out")
    for k in range(2):
        put(tmp_path / f"in{k}", 0, [message("trades", i=k), message("trades", i=k), message("trades", i=9)])
        stream = files.messages(spark, str(tmp_path / f"in{k}"), stream=True)
        assert collector.run_collector(stream, "trades", out, str(tmp_path / f"ck{k}")).awaitTermination(180)
    status = spark.read.parquet(f"{out}/status")
    assert sorted(r.status for r in status.collect()) == ["duplicate"] * 2 + ["valid"] * 4
    assert spark.read.text(f"{out}/events").count() == 4 and collector.snapshots(spark, out)["trades"]["total_received"] == 6
    assert status.schema["arrival_seq"].dataType.precision == 38


def test_arrivals_are_numbered_apart(spark):
    """The last partition of a batch comes before the first of the next, however many partitions there are."""
    batch = lambda b, partition: b * (1 << 62) + (partition << 33)
    assert batch(0, 100_000) + (1 << 33) < batch(1, 0) and batch(10**5, 100_000) < 10**38


def test_a_log_that_is_not_shared_is_an_error(spark, tmp_path):
    options = {"transport": "tests.feed_transport:counted", "file": str(tmp_path / "n"), "log": str(tmp_path / "log")}
    reader = feeds.FrameFeed(options).simpleStreamReader(None)
    _, end = reader.read(reader.initialOffset())
    elsewhere = feeds.FrameFeed(options | {"log": str(tmp_path / "other")}).simpleStreamReader(None)
    with pytest.raises(FileNotFoundError, match="share"):
        elsewhere.readBetweenOffsets({"n": 0}, end)
    assert not (tmp_path / "other").exists()


def test_news_are_polled_at_their_own_pace():
    options = {"transport": "test_streaming:played", "frames": json.dumps(['{"feed": [{"title": "T"}]}']), "seconds": "0.2"}
    slow = feeds.NewsFeed(options).simpleStreamReader(None)
    rows, end = slow.read(slow.initialOffset())
    assert len(list(rows)) == 1 and len(list(slow.read(end)[0])) == 0
    fast = feeds.NewsFeed(options | {"every": "0"}).simpleStreamReader(None)
    end = fast.read(fast.initialOffset())[1]
    assert len(list(fast.read(end)[0])) == 1


def test_bounded_memory_that_never_forgets_its_start(spark):
    df = spark.range(6000).select(F.col("id").alias("k"), (F.col("id") * F.col("id") % 71).alias("a"), ((F.col("id") * 31 + F.floor(F.col("id") / 5)) % 101).alias("b"))
    got, rounds = dedup.bounded_memory(df, ["a", "b"], ["k"], 30, stretch=100)
    want = dedup.accept_by_memory(df, ["a", "b"], ["k"], capacity=30)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and rounds <= dedup.STRETCHES + 1
