"""Deduplication against plain models, metrics, and their exposition."""

import threading
import urllib.request
from collections import deque

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marlstone.operators import dedup, exposition, metrics, schemas

SLOW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def memory_model(rows, capacity):
    sets = [deque(maxlen=capacity) for _ in rows[0]] if rows else []
    out = []
    for ids in rows:
        dup = any(i in s for i, s in zip(ids, sets, strict=True))
        out.append(not dup)
        if not dup:
            for i, s in zip(ids, sets, strict=True):
                s.append(i)
    return out


def horizon_model(rows, seconds):
    last, out = {}, set()
    for key, t, k in sorted(rows, key=lambda r: (r[1], r[2])):
        if key not in last or t >= last[key] + seconds:
            last[key] = t
            out.add(k)
    return out


@SLOW
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), min_size=1, max_size=60), st.integers(1, 5))
def test_memory(spark, rows, capacity):
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, a int, b int")
    got = [r.accepted for r in sorted(dedup.accept_by_memory(df, ["a", "b"], ["k"], capacity=capacity).collect(), key=lambda r: r.k)]
    assert got == memory_model(rows, capacity)


@SLOW
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 100)), min_size=1, max_size=60), st.integers(1, 30))
def test_horizon(spark, rows, seconds):
    data = [(k, key, t) for k, (key, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, key int, s int").withColumn("t", F.timestamp_seconds("s"))
    got = {r.k for r in dedup.accept_by_horizon(df, ["key"], "t", seconds, ["k"]).filter("accepted").collect()}
    assert got == horizon_model([(key, t, k) for k, key, t in data], seconds)
    again = df.filter(F.col("k").isin(list(got)))
    assert dedup.accept_by_horizon(again, ["key"], "t", seconds, ["k"]).filter("accepted").count() == len(got)


def test_horizon_edges(spark):
    hours = [(0, "a", 0.0), (1, "a", 11.0), (2, "a", 13.0), (3, "b", 0.0), (4, "b", 12.0), (5, None, 1.0), (6, None, 2.0)]
    df = spark.createDataFrame(hours, "k int, key string, h double").withColumn("t", F.timestamp_seconds(F.col("h") * 3600))
    assert {r.k for r in dedup.accept_by_horizon(df, ["key"], "t", 43_200).filter("accepted").collect()} == {0, 2, 3, 4, 5}
    assert {r.k for r in dedup.accept_by_session(df, ["key"], "t", 43_200).filter("accepted").collect()} == {0, 3, 4, 5}


def test_first_of_key(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, "y"), (3, "k", "z"), (0, "k", "w")], "n int, key string, v string")
    assert {(r.n, r.v) for r in dedup.first_of_key(df, ["key"], ["n"]).collect()} == {(1, "x"), (0, "w")}
    assert {r.n for r in dedup.mark_repeats(df, ["key"], ["n"]).filter("is_duplicate").collect()} == {2, 3}


def status(spark, rows):
    df = spark.createDataFrame(rows, "stream string, arrival_seq long, s double, status string, freshness_seconds double, spread double, detection_ms double")
    return df.select("stream", "arrival_seq", F.timestamp_seconds("s").alias("arrival_ts"), "status", "freshness_seconds", "spread", "detection_ms")


ROWS = [
    ("trades", 1, 10.0, "valid", 0.5, None, None), ("trades", 2, 65.0, "valid", 1.5, None, None), ("trades", 3, 70.0, "duplicate", None, None, None), ("trades", 4, 75.0, "invalid", None, None, 2.0),
    ("trades", 5, 80.0, "ignored", None, None, None), ("crypto", 6, 80.0, "ignored", None, None, None), ("crypto", 7, 85.0, "valid", 2.0, None, None), ("trades", 8, 3700.0, "valid", 4.0, None, None),
]


def test_quality(spark):
    got = {(r.stream, r.window_received): r for r in metrics.hourly_quality(status(spark, ROWS)).collect()}
    first = got["trades", 4]
    assert (first.window_valid, first.window_duplicates, first.window_invalid, first.window_dlq) == (2, 1, 1, 1)
    assert (first.schema_compliance_rate, first.duplicate_rate, first.dlq_rate) == (0.5, 0.25, 0.25)
    assert got["crypto", 2].schema_compliance_rate == 0.5
    totals = sorted((r.stream, r.total_received, r.total_valid) for r in metrics.lifetime_totals(status(spark, ROWS)).collect())
    assert totals == [("crypto", 2, 1), ("trades", 4, 2), ("trades", 5, 3)]


def test_last_samples(spark):
    rows = [("trades", k, k / 10, "valid", float(k), None, None) for k in range(20)]
    got = metrics.last_samples_mean(status(spark, rows), "freshness_seconds", "valid", 4, samples=5).first()
    assert (got.freshness_seconds_mean, got.samples) == (17.0, 5)


def test_throughput(spark):
    now = F.timestamp_seconds(F.lit(70.0))
    got = {r.stream: r.throughput_msgs_per_sec for r in metrics.throughput_now(status(spark, ROWS), now).collect()}
    assert got == {"trades": round(2 / 60, 4), "crypto": 0.0}
    df = spark.createDataFrame([(k, "x", float(t)) for k, t in enumerate([0, 30, 60, 61, 119, 121, 121, 300])], "k int, g string, s double").withColumn("t", F.timestamp_seconds("s"))
    times = [0, 30, 60, 61, 119, 121, 121, 300]
    want = [round(sum(t - 60 <= u <= t for u in times) / 60, 4) for t in times]
    assert [r.throughput_msgs_per_sec for r in sorted(metrics.rolling_throughput(df, "t", ["g"]).collect(), key=lambda r: r.k)] == want


def test_snapshot_and_text(spark):
    rows = {r.stream: r.asDict() for r in metrics.snapshot(status(spark, ROWS), F.timestamp_seconds(F.lit(90.0))).collect()}
    t = rows["trades"]
    assert (t["total_received"], t["window_received"], t["throughput_msgs_per_sec"], t["freshness_at_ingestion_seconds_mean"]) == (5, 4, round(1 / 60, 4), 1.0)
    text = exposition.render_streams(rows)
    assert "# HELP coinbase_collector_total_received_total Messages received since the start\n# TYPE coinbase_collector_total_received_total counter\ncoinbase_collector_total_received_total 2\n" in text
    assert text.count("# TYPE") == 7 + 5 + 6 + 5 and "coinbase_collector_mean_bid_ask_spread" not in text
    empty = metrics.snapshot(status(spark, ROWS), F.timestamp_seconds(F.lit(90_000.0))).filter("stream = 'crypto'").first()
    assert (empty.schema_compliance_rate, empty.duplicate_rate, empty.window_received) == (1.0, 0.0, 0)


def test_runs(spark):
    rows = [("r", "valid", 1.0, None, "Bullish"), ("r", "valid", 2.0, None, ""), ("r", "invalid", None, 3.0, "Bullish"), ("q", "invalid", None, 1.0, None)]
    df = spark.createDataFrame(rows, "run_id string, status string, freshness_seconds double, detection_ms double, overall_sentiment_label string")
    got = {r.run_id: r.asDict() for r in metrics.run_metrics(df).collect()}
    assert (got["r"]["articles_fetched"], got["r"]["articles_published"], got["q"]["articles_published"], got["r"]["schema_compliance_rate"], got["r"]["freshness_seconds_mean"]) == (3, 1, 0, 0.666667, 1.5)
    labels = {r.label: r.n for r in metrics.sentiment_distribution(df).collect()}
    assert labels == {"Bullish": 1}
    text = exposition.render_run(got["r"] | {"api_latency_seconds": 0.1, "run_duration_seconds": 1.0}, {"Somewhat-Bearish": 2})
    assert text.count("# TYPE") == 12 and "news_collector_sentiment_somewhat_bearish_count 2\n" in text
    assert "Somewhat-Bearish" in exposition.summary(got["r"], {"Somewhat-Bearish": 2})


def test_server_and_push():
    snap = {"trades": {key: 0 for _, key, _ in exposition.GAUGES} | {n: 1 for n, _ in exposition.COUNTERS}}
    server = exposition.serve(lambda: snap)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_address[1]}"
    try:
        get = lambda p: urllib.request.urlopen(base + p, timeout=5).read().decode()
        assert "alpaca_collector_trades_total_valid_total 1" in get("/metrics") and '"trades"' in get("/metrics/json") and '"total_valid": 1' in get("/metrics/trades") and '"ok"' in get("/health")
        assert not exposition.push("x 1\n", "127.0.0.1:9", "job", timeout=1)
    finally:
        server.shutdown()


def test_schemas():
    assert [len(schemas.TABLES[s].fields) for s in ("trades", "quotes", "crypto", "news")] == [15, 15, 16, 9]
