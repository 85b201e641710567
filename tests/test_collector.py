"""Collectors end to end: frames, repeats over batches, events, the news job, and feeds that are started again."""

import json
import os

import pytest
from pyspark.sql import functions as F

from marlstone.__main__ import live, main
from marlstone.operators import dedup, parse
from marlstone.plans import pipelines
from marlstone.sources import feeds, files
from marlstone.streaming import collector
from test_messages import message


def frames(spark, values):
    return spark.createDataFrame([(k, bytearray(v)) for k, v in enumerate(values)], "k int, value binary").withColumn("at", F.timestamp_seconds(F.lit(1758310870)))


def array(*parts):
    return b"[" + b",".join(parts) + b"]"


def test_frames_are_taken_apart(spark):
    given = [array(message("trades"), message("quotes"), message("trades", i=2)), message("trades", i=3), b"[]", b'{"T":"success"}', b"[1,", array(b'{"T":"t"}', b"5", message("trades", S="brk.b"))]
    got = {(r.k, r.item): r for r in pipelines.collect(frames(spark, given), "trades", ["k"], "at").collect()}
    assert {k: r.status for k, r in got.items()} == {(0, 0): "valid", (0, 2): "valid", (1, 0): "valid", (5, 0): "invalid", (5, 2): "duplicate"}
    event = json.loads(got[0, 0].event)
    sent = json.loads(message("trades"))
    assert list(event) == ["T", "S", "i", "x", "p", "s", "t", "c", "z", "ingest_timestamp", "freshness_seconds"]
    assert {k: event[k] for k in "TSixpstcz"} == {k: sent.get(k) for k in "TSixpstcz"} and event["ingest_timestamp"] == 1758310870.0 and event["freshness_seconds"] == pytest.approx(3.731659)
    assert got[5, 2].event is None and got[5, 0].event is None
    quotes = pipelines.collect(frames(spark, [*given, message("quotes", S="brk.b", bp=0)]), "quotes", ["k"], "at").collect()
    assert [(r.status, json.loads(r.event)["spread"], json.loads(r.event)["as"]) for r in sorted(quotes, key=lambda r: r.k)] == [("valid", 0.59, json.loads(message("quotes"))["as"]), ("valid", None, json.loads(message("quotes"))["as"])]
    assert json.loads(max(quotes, key=lambda r: r.k).event)["S"] == "BRK.B"
    main_lane, dead = pipelines.build(pipelines.valid_events(pipelines.collect(frames(spark, given), "trades", ["k"], "at")), "trades")
    assert main_lane.count() == 3 and dead.count() == 0


def test_empty_frames(spark):
    for stream in pipelines.STREAMS:
        none = frames(spark, [b"x"]).limit(0)
        assert pipelines.collect(none, stream, ["k"], "at").count() == 0
        assert pipelines.valid_events(pipelines.collect(none, stream, ["k"], "at")).count() == 0


def test_one_scan(spark, tmp_path):
    frames(spark, [message("trades"), message("crypto")]).write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    for stream in ("trades", "quotes", "crypto"):
        plan = pipelines.collect(df, stream, ["k"], "at")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1, plan


def test_equal_rows_have_one_first(spark):
    df = spark.createDataFrame([("a", 1, 1.0)] * 3 + [("b", 1, 2.0), (None, 1, 1.0), (None, 1, 1.0)], "key string, n int, x double")
    got = dedup.mark_repeats(df, ["key"], ["n", "x"]).groupBy("key").agg(F.count_if("is_duplicate").alias("again"), F.count(F.lit(1)).alias("n")).collect()
    assert {(r.key, r.n, r.again) for r in got} == {("a", 3, 2), ("b", 1, 0), (None, 2, 1)}


def test_hot_key_is_dealt(spark):
    df = spark.range(0, 20_000, 1, 8).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("key"), F.col("id").alias("n"), F.lit(None).cast("string").alias("lane"))
    marked = dedup.mark_repeats(df, ["key"], ["n"])
    assert marked.columns == ["key", "n", "lane", "is_duplicate"]
    assert {(r.key, r.n) for r in marked.filter("NOT is_duplicate AND key = -1").collect()} == {(-1, 0)}
    assert marked.filter("is_duplicate").count() == 6666
    only = dedup.mark_repeats(df, ["key"], ["n"], where=F.col("n") > 2).filter("NOT is_duplicate AND key = -1").collect()
    assert sorted(r.n for r in only) == [0, 3]


def test_memory_leaves_rows_out(spark):
    df = spark.createDataFrame([(k, k % 2, k % 5 != 0) for k in range(20)], "n int, a int, ok boolean")
    for scope in ([], ["a"]):
        got = dedup.accept_by_memory(df, ["a"], ["n"], scope, where=F.col("ok")).filter("accepted").collect()
        assert sorted(r.n for r in got) == [1, 2]


def test_batch_events(spark):
    df = spark.createDataFrame([("r", 2, '{"b":1}'), ("r", 1, '{"a":1}'), ("q", 1, None)], "run string, n int, event string")
    assert [(r.run, json.loads(bytes(r.value))) for r in parse.batch_events(df, "run", ["n"]).collect()] == [("r", [{"a": 1}, {"b": 1}])]


def _write(path, k, values):
    path.mkdir(exist_ok=True)
    (path / f"{k}.txt").write_bytes(b"\n".join(values) + b"\n")
    os.utime(path / f"{k}.txt", (1_700_000_000 + k,) * 2)


@pytest.mark.parametrize("stream, expected", [("trades", {"valid": 3, "duplicate": 2, "invalid": 1}), ("crypto", {"valid": 2, "duplicate": 2, "invalid": 1, "ignored": 1})])
def test_stream_remembers_over_batches(spark, tmp_path, stream, expected):
    if stream == "trades":
        batches = [[array(message(stream), message(stream, i=2)), b"oops"], [message(stream), message(stream, p=0)], [array(message(stream, i=2), message(stream, i=3))]]
    else:
        batches = [[message(stream, trade_id=1, sequence=1), message(stream, type="heartbeat")], [message(stream, trade_id=1, sequence=2), message(stream, side="x")], [message(stream, trade_id=2, sequence=1), message(stream, trade_id=3, sequence=2)]]
    for k, values in enumerate(batches):
        _write(tmp_path / "in", k, values)
    lines = []
    messages = files.messages(spark, str(tmp_path / "in"), stream=True, files_per_batch=1)
    q = collector.run_collector(messages, stream, str(tmp_path / "out"), str(tmp_path / "ck"), log=lines.append)
    assert q.awaitTermination(180)
    status = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "out/status"))
    assert {r.status: r.n for r in status.groupBy("status").agg(F.count("*").alias("n")).collect()} == expected
    assert status.filter("status = 'invalid'").first().detection_ms > 0
    events = [json.loads(r.value) for r in spark.read.option("recursiveFileLookup", "true").text(str(tmp_path / "out/events")).collect()]
    assert len(events) == expected["valid"] and all(e["freshness_seconds"] is not None for e in events)
    assert len(lines) == expected["duplicate"] + expected["invalid"] and any(f"{stream.upper()} DUPLICATE symbol=" in x for x in lines)
    row = collector.snapshots(spark, str(tmp_path / "out"))[stream]
    assert (row["total_valid"], row["total_duplicates"], row["total_dlq"]) == (expected["valid"], expected["duplicate"], 1) and row["contract_violation_detection_time_ms"] > 0


def test_news_run(spark):
    published, pushed = [], []
    reply = json.dumps([json.loads(message("news")), json.loads(message("news", title=""))]).encode()
    run = collector.run_news(spark, lambda: [reply], published.append, pushed.append)
    m = run.metrics
    assert (m["articles_fetched"], m["articles_valid"], m["articles_dlq"], m["articles_published"]) == (2, 1, 1, 1)
    assert m["run_duration_seconds"] > 0 and m["api_latency_seconds"] >= 0 and m["violation_detection_ms_mean"] > 0
    assert [a["title"] for a in json.loads(published[0])] == [json.loads(message("news"))["title"]]
    assert pushed == [run.text()] and "# TYPE news_collector_run_duration_seconds gauge" in pushed[0] and len(run.sentiments) == 1
    none = collector.run_news(spark, lambda: [], published.append, pushed.append)
    assert none.metrics["articles_fetched"] == 0 and none.metrics["schema_compliance_rate"] == 1.0 and len(published) == 1 and none.message is None


def polled(options):
    yield json.dumps({"feed": [json.loads(message("news"))]}).encode()


def test_command_lines(spark, tmp_path, capsys):
    main(["news", "--run", "--output", str(tmp_path / "news"), "--option", "transport=test_collector:polled"], spark)
    assert "articles_valid" in capsys.readouterr().out and spark.read.text(str(tmp_path / "news")).count() == 1
    _write(tmp_path / "in", 0, [message("quotes"), message("quotes"), message("quotes", bp=-1)])
    main(["quotes", "--collect", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out")], spark)
    assert sorted(r.status for r in spark.read.parquet(str(tmp_path / "out/status")).collect()) == ["duplicate", "invalid", "valid"]
    assert spark.read.parquet(str(tmp_path / "out/dead")).count() == 1 and spark.read.text(str(tmp_path / "out/events")).count() == 1
    main(["quotes", "--collect", "--stream", "--serve", "--checkpoint", str(tmp_path / "ck"), "--input", str(tmp_path / "in"), "--output", str(tmp_path / "live")], spark)
    assert spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "live/status")).count() == 3
    for wrong in (["quotes", "--output", "x"], ["quotes", "--run", "--output", "x"], ["quotes", "--live", "--output", "x"]):
        with pytest.raises(SystemExit):
            main(wrong, spark)


def test_feed_is_read_again_from_its_log(tmp_path):
    options = {"transport": "tests.feed_transport:counted", "file": str(tmp_path / "n"), "log": str(tmp_path / "log")}
    reader = feeds.FrameFeed(options).simpleStreamReader(None)
    rows, end = reader.read(reader.initialOffset())
    first = [bytes(v) for v, _ in rows]
    assert len(first) == 3 and end == {"n": 3}
    again = feeds.FrameFeed(options).simpleStreamReader(None)  # the driver was started anew before the batch was committed
    assert [bytes(v) for v, _ in again.readBetweenOffsets({"n": 0}, {"n": 3})] == first
    assert [bytes(v) for v, _ in again.readBetweenOffsets({"n": 1}, {"n": 2})] == first[1:2]
    again.commit(end)
    rows, end = again.read({"n": 3})
    assert [json.loads(bytes(v))["n"] for v, _ in rows] == [3, 4, 5] and end == {"n": 6}
    third = feeds.FrameFeed(options).simpleStreamReader(None)  # frames that were logged, but in no batch yet
    assert [json.loads(bytes(v))["n"] for v, _ in third.read({"n": 3})[0]][:3] == [3, 4, 5]


def test_query_is_started_again(spark, tmp_path):
    feeds.register(spark)
    options = {"transport": "tests.feed_transport:counted", "file": str(tmp_path / "n"), "log": str(tmp_path / "log")}
    seen, fail = [], [True]

    def take(df, batch):
        rows = sorted(json.loads(bytes(r.value))["n"] for r in df.collect())
        if fail[0]:
            fail[0] = False
            raise RuntimeError("killed between read and commit")
        seen.append(rows)

    start = lambda: spark.readStream.format("marlstone_frames").options(**options).load().writeStream.foreachBatch(take).option("checkpointLocation", str(tmp_path / "ck")).start()
    q = start()
    with pytest.raises(Exception, match="killed"):
        q.awaitTermination(60)
        q.stop()
    q = start()
    import time

    until = time.monotonic() + 60
    while len(seen) < 3 and time.monotonic() < until:
        time.sleep(0.2)
    q.stop()
    got = [n for rows in seen for n in rows]
    assert len(seen) >= 3 and got == list(range(len(got)))


def test_live_feeds_greet(spark):
    said = []

    class Socket:
        def recv(self):
            said.append("recv")

        def send(self, text):
            said.append(json.loads(text).get("action") or "sub")

    feeds.greet(Socket(), feeds.equity_greetings("k", "s", ["A"]), 1)
    assert said == ["recv", "auth", "recv", "subscribe", "recv"]
    for stream in pipelines.STREAMS:
        df = live(spark, stream, {"url": "wss://x", "key": "k", "secret": "s"})
        assert df.isStreaming and df.columns == ["value", "ingest_timestamp"]
