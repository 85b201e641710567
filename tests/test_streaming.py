"""Streams give what batches give."""

import json
import random

import pytest
from pyspark.sql import functions as F

from marlstone.plans import pipelines
from marlstone.sources import feeds, files
from marlstone.streaming import sinks, stateful
from test_messages import GONE, message


def played(options):
    """A transport for tests."""
    yield from json.loads(options["frames"])


def test_pipeline_stream_equals_batch(spark, tmp_path):
    for k in range(3):
        (tmp_path / "in").mkdir(exist_ok=True)
        lines = [message("trades", i=10 * k + j, p=GONE if j == 3 else 10.0 + j).decode() for j in range(6)] + ["oops"]
        (tmp_path / "in" / f"{k}.txt").write_text("\n".join(lines) + "\n")
    stream = files.messages(spark, str(tmp_path / "in"), stream=True, files_per_batch=1)
    q = sinks.run_pipeline(stream, "trades", str(tmp_path / "main"), str(tmp_path / "ck"), str(tmp_path / "dlq"))
    q.awaitTermination(120)
    main, dlq = pipelines.build(files.messages(spark, str(tmp_path / "in")), "trades")
    key = lambda df: sorted((r.trade_id, r.price, r.latency_ms) for r in df.collect())
    assert key(spark.read.parquet(str(tmp_path / "main"))) == key(main) and main.count() == 15
    assert sorted(r.error for r in spark.read.parquet(str(tmp_path / "dlq")).collect()) == sorted(r.error for r in dlq.collect())


def _stream(spark, path, batches, schema):
    path.mkdir()
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(path / "all"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(path / "all"))


def _drain(df, name, tmp_path):
    q = df.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / f"ck-{name}")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(180)
    return df.sparkSession.table(name).collect()


def test_horizon_in_a_stream(spark, tmp_path):
    stateful.use_rocksdb(spark)
    rows = [[(0, "a", 0), (1, "b", 1)], [(2, "a", 11)], [(3, "a", 13), (4, "b", 12)], [(5, "a", 48), (6, "c", 48)]]
    s = _stream(spark, tmp_path / "h", rows, "n int, k string, h int").withColumn("t", F.timestamp_seconds(F.col("h") * 3600))
    got = {r.n for r in _drain(stateful.accept_by_horizon(s, "k", "t", 43_200, "n"), "horizon", tmp_path)}
    assert got == {0, 1, 3, 5, 6}


@pytest.mark.parametrize("capacity", [3])
def test_memory_in_a_stream(spark, tmp_path, capacity):
    from test_dedup_metrics import memory_model

    stateful.use_rocksdb(spark)
    r = random.Random(4)
    rows = [(k, r.randint(0, 8), r.randint(0, 8)) for k in range(45)]
    s = _stream(spark, tmp_path / "m", [rows[:15], rows[15:30], rows[30:]], "n int, a int, b int")
    got = {x.n for x in _drain(stateful.accept_by_memory(s, ["a", "b"], "n", capacity=capacity), "memory_dedup", tmp_path)}
    assert got == {k for k, ok in enumerate(memory_model([x[1:] for x in rows], capacity)) if ok}


def test_feeds(spark, tmp_path):
    assert feeds.articles(b"x") == [] and feeds.articles(b'{"Note": "slow"}') == [] and feeds.articles(b'{"feed": [{"a": 1}]}') == [{"a": 1}]
    assert [g.get("action") for g in feeds.equity_greetings("k", "s", feeds.SYMBOLS)] == ["auth", "subscribe"] and len(feeds.PRODUCTS) == 10
    from datetime import datetime, timezone

    assert "time_from=20260314T2350" in feeds.news_url("http://h", "k", datetime(2026, 3, 15, 0, 5, tzinfo=timezone.utc))
    reader = feeds.NewsFeed({"transport": "test_streaming:played", "frames": json.dumps(['{"feed": [{"title": "T"}]}', "oops"])}).simpleStreamReader(None)
    rows, end = reader.read(reader.initialOffset())
    assert [json.loads(bytes(v)) for v, _ in rows] == [[{"title": "T"}]] and end == {"n": 1}
    assert list(reader.readBetweenOffsets({"n": 0}, end)) == []  # without a log a lost batch is empty, and the query goes on
    feeds.register(spark)


def test_publish(spark, tmp_path):
    df = spark.createDataFrame([(bytearray(b'{"a":1}'),)], "value binary")
    sinks.publish(df, str(tmp_path / "out"))
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ['{"a":1}']
    sinks.append(spark.createDataFrame([(1, "A")], "trade_id int, symbol string"), str(tmp_path / "t"), {"trade_id": "i", "symbol": "S"})
    assert spark.read.parquet(str(tmp_path / "t")).columns == ["i", "S"]
    with pytest.raises(ValueError):
        files.messages(spark, "x", "avro2")
