"""Collectors over streams of raw messages, and the news job, with their clocks."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marlstone.operators import dedup, exposition, metrics, parse
from marlstone.plans import pipelines
from marlstone.streaming import stateful
from marlstone.streaming.running import Running
from marlstone.streaming.sinks import started
from marlstone.streaming.tables import BatchTable, query_id

#: The tables of a collector, each a folder below its output.
STATUS, EVENTS, DEAD = "status", "events", "dead"
#: An arrival's number: its batch's, then its place in it (partition and row), too wide for a long.
ARRIVAL = "decimal(38,0)"
#: How long an id is known.
KEEP_SECONDS = 7 * 86_400


def run_collector(messages: DataFrame, stream: str, out: str, checkpoint: str, trigger: dict | None = None, value: str = "value", arrival: str | None = None, scope: list[str] | None = None, capacity: int = dedup.CAPACITY, log: Callable[[str], None] | None = None, exact: bool = False, keep_seconds: int | None = KEEP_SECONDS, send: Callable[[DataFrame], object] | None = None) -> StreamingQuery:
    """Start a collector over a streaming DataFrame of messages.

    Below `out` grow, each micro-batch once whatever restarts there are (tables.BatchTable): events, the JSON lines that are
    published; dead, the dead letters; status, the metrics' table; and the metrics themselves (running.Running). arrival:
    a column of ingest times (timestamp, or seconds); the batch's own time without one.

    Duplicates are told as pipelines.collect tells them: by default any earlier valid message of the same identity, each
    identity with a state of its own that goes after keep_seconds (None: never); with exact, or a scope, and for crypto, a
    memory of the last `capacity` accepted ones for each scope (crypto: the product), without a scope in one sequence, so in one task.

    send gets a batch's published messages (value: bytes), for a topic (sources.topics.publish), before the batch is marked as
    published by its events: each is sent at least once. A
    violation's detection time is the batch's checking time by its rows: rows can't be timed one by one. log gets the lines about a
    batch's rows that were not published.
    """
    if arrival:
        kind = messages.schema[arrival].dataType.typeName()
        at = F.timestamp_micros((F.col(arrival) * 1_000_000).cast("long")) if kind == "double" else F.col(arrival)
    else:
        at = F.current_timestamp()
    rows = pipelines.received(_numbered(messages.select(F.col(value).alias("value"), at.alias("at"))), stream, "at")
    rows = rows.withColumn("order", F.concat_ws("/", F.lpad(F.col("seq").cast("string"), 20, "0"), F.lpad(F.col("item").cast("string"), 10, "0")))
    if stream == "news":
        rows = rows.withColumn("accepted", F.col("status") == "valid")
    elif stream == "crypto" or exact or scope:
        scope = ["symbol"] if scope is None and stream == "crypto" else scope
        rows = stateful.mark_by_memory(rows, ["id", "id2"] if stream == "crypto" else ["id"], "order", F.col("status") == "valid", scope, capacity)
    else:
        rows = stateful.mark_first(rows, "id", "order", F.col("status") == "valid", keep_seconds)

    def write(df: DataFrame, batch: int) -> None:
        spark, began = df.sparkSession, time.perf_counter()
        query, running = query_id(spark, checkpoint), Running(spark, out)
        df = df.persist()
        try:
            n = df.count()
            each = (time.perf_counter() - began) * 1000 / max(1, n)
            done = pipelines.settled(df, stream, ~F.col("accepted")).withColumn("detection_ms", F.when(F.col("status") == "invalid", F.lit(each)))
            number = F.lit(batch).cast(ARRIVAL) * F.lit(1 << 62).cast("decimal(19,0)") + F.col("seq")
            status = pipelines.status_rows(done, number, "at", ARRIVAL)
            BatchTable(spark, f"{out}/{STATUS}").commit(status, query, batch)
            BatchTable(spark, f"{out}/{DEAD}").commit(parse.dead_letters(done, "contract"), query, batch)
            if stream == "news":
                lines = parse.batch_events(done.filter("status = 'valid'").withColumn("run", F.lit(batch)), "run", ["order"]).select(F.col("value").cast("string").alias("value"))
            else:
                lines = done.filter("status = 'valid'").select(F.col("event").alias("value"))
            published = BatchTable(spark, f"{out}/{EVENTS}", "text")
            if send and not published.committed(query, batch):
                send(lines.select(F.col("value").cast("binary").alias("value")))
            published.commit(lines, query, batch)
            running.update(BatchTable(spark, f"{out}/{STATUS}").batch(query, batch), query, batch)
            if log:
                for r in pipelines.log_lines(done.filter("status IN ('invalid', 'duplicate')")).limit(metrics.DEAD_LETTERS_SHOWN).collect():
                    log(r.line)
        finally:
            df.unpersist()

    return started(rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})), messages.sparkSession)


def _numbered(messages: DataFrame) -> DataFrame:
    """Messages with seq, their place in their partition, which streams have no expression for."""
    schema = T.StructType([*messages.schema.fields, T.StructField("seq", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 33
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(range(at, at + batch.num_rows), pa.int64())], names=[*batch.schema.names, "seq"])
            at += batch.num_rows

    return messages.mapInArrow(run, schema)


def snapshots(spark: SparkSession, out: str) -> dict[str, dict]:
    """The metrics of a collector's streams as they stand, for the endpoint: none before the first batch, and read from what
    the batches have kept of them, not from the history."""
    return Running(spark, out).snapshot()


@dataclass
class NewsRun:
    """What a news run came to: its metrics, its labels, and the message that it published, if any."""

    metrics: dict
    sentiments: dict[str, int] = field(default_factory=dict)
    message: bytes | None = None

    def text(self) -> str:
        return exposition.render_run(self.metrics, self.sentiments)


def run_news(spark: SparkSession, fetch: Callable[[], Iterable[bytes]], publish: Callable[[bytes], None], push: Callable[[str], object] = exposition.push) -> NewsRun:
    """One run of the news job: poll, check, publish the valid articles as one array, push the metrics.

    fetch gives the replies' arrays of articles, none on an error. A reply is one message's worth of articles, so the
    run's message and counts may reach the driver.
    """
    began = time.perf_counter()
    replies = [bytes(b) for b in fetch()]
    latency = time.perf_counter() - began
    at = F.timestamp_micros(F.lit(int(time.time() * 1_000_000)))
    raw = spark.createDataFrame([(k, bytearray(b)) for k, b in enumerate(replies)], "reply int, value binary").withColumn("at", at)
    checking = time.perf_counter()
    rows = pipelines.collect(raw, "news", ["reply"], "at").withColumn("run_id", F.lit("run")).persist()
    try:
        n = rows.count()
        each = (time.perf_counter() - checking) * 1000 / max(1, n)
        timed = rows.withColumn("detection_ms", F.when(F.col("status") == "invalid", F.lit(each)))
        found = metrics.run_metrics(timed).first()
        row = found.asDict() if found else {"run_id": "run"} | metrics.NO_ARTICLES
        label = F.get_json_object("event", "$.overall_sentiment_label").alias("overall_sentiment_label")
        sentiments = {r["label"]: r["n"] for r in metrics.sentiment_distribution(rows.select("status", label)).collect()}
        sent = parse.batch_events(rows, "run_id", ["reply", "item"]).first()
        message = bytes(sent["value"]) if sent else None
        if message:
            publish(message)
    finally:
        rows.unpersist()
    row |= {"api_latency_seconds": round(latency, 4), "run_duration_seconds": round(time.perf_counter() - began, 4)}
    run = NewsRun(row, sentiments, message)
    push(run.text())
    return run


def replies(options: dict, transport: Callable[[dict], Iterable[bytes]]) -> Iterable[bytes]:
    """The arrays of articles in what a transport of polls yields."""
    from marlstone.sources.feeds import articles

    return [json.dumps(found).encode() for body in transport(options) if (found := articles(body))]
