"""python -m marlstone STREAM --output PATH (--input PATH | --live --option K=V ...) [more]

Runs a pipeline (trades, quotes, crypto, news) over messages, from raw messages to the table, in batch or as a stream.

With --collect it runs the stream's collector instead: status, events and dead letters below --output; --serve adds the
metrics endpoint. With --run it polls the news once, publishes one message below --output and pushes the run's metrics.
Live feeds take their address and their keys as options: url, key, secret, log, transport.
"""

from __future__ import annotations

import argparse
import json
import sys
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.operators import exposition, parse
from marlstone.plans import pipelines
from marlstone.sources import feeds, files, topics
from marlstone.streaming import collector, sinks


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="marlstone", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("stream", choices=pipelines.STREAMS)
    p.add_argument("--input")
    p.add_argument("--output", required=True)
    p.add_argument("--dead", help="where a pipeline's dead letters go; without it they are dropped")
    p.add_argument("--format", default="text", choices=files.FORMATS)
    p.add_argument("--stream", dest="streaming", action="store_true", help="work off what is there in micro-batches and remember it")
    p.add_argument("--checkpoint", help="for --stream and --live")
    p.add_argument("--suppress-by", help="news: a time column by which repeats within 12 hours are left out; ingest, the default; or none")
    p.add_argument("--collect", action="store_true", help="the collector in place of the pipeline")
    p.add_argument("--live", action="store_true", help="messages come from the stream's feed, until the query is stopped")
    p.add_argument("--option", action="append", default=[], metavar="K=V", help="of the feed")
    p.add_argument("--serve", action="store_true", help="with --collect: the metrics endpoint")
    p.add_argument("--topic", metavar="MODULE:NAME", help="with --collect and a stream: the transport of the topic that valid events are sent to; --topic-option K=V for it")
    p.add_argument("--topic-option", action="append", default=[], metavar="K=V")
    p.add_argument("--run", action="store_true", help="news: one poll and what comes of it")
    return p


def live(spark: SparkSession, stream: str, options: dict[str, str]) -> DataFrame:
    """The frames of a stream's feed."""
    feeds.register(spark)
    options = dict(options)
    if "log" in options and "://" not in options["log"] and not spark.sparkContext.master.startswith("local"):
        raise ValueError("log: give the URI of a folder that driver and executors share, such as hdfs://...")
    key, secret = options.pop("key", ""), options.pop("secret", "")
    if stream == "news":
        return spark.readStream.format("marlstone_news").options(key=key, **options).load()
    if stream == "crypto":
        greetings, welcome = feeds.crypto_greetings(feeds.PRODUCTS), 0
    else:
        greetings, welcome = feeds.equity_greetings(key, secret, feeds.SYMBOLS), 1
    return spark.readStream.format("marlstone_frames").options(greetings=json.dumps(greetings), welcome=str(welcome), **options).load()


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    p = parser()
    a = p.parse_args(args)
    options = dict(o.split("=", 1) for o in a.option)
    if not (a.input or a.live or a.run):
        p.error("--input, --live or --run is needed")
    if (a.streaming or a.live) and not a.checkpoint:
        p.error("--stream and --live need --checkpoint")
    if a.suppress_by and a.stream != "news":
        p.error("--suppress-by is for news")
    if a.topic and not (a.collect and (a.streaming or a.live)):
        p.error("--topic is for --collect with --stream or --live")
    if a.run and a.stream != "news":
        p.error("--run is for news")
    spark = spark or SparkSession.builder.appName(f"marlstone {a.stream}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.run:
        transport = feeds._transport(options, "marlstone.sources.feeds:http_get")
        send = lambda message: sinks.publish(spark.createDataFrame([(bytearray(message),)], "value binary"), a.output)
        run = collector.run_news(spark, lambda: collector.replies(options, transport), send)
        print(exposition.summary(run.metrics, run.sentiments))
        return
    messages = live(spark, a.stream, options) if a.live else files.messages(spark, a.input, a.format, stream=a.streaming)
    trigger = {"processingTime": "1 second"} if a.live else None
    if a.collect:
        _collect(spark, a, messages, trigger)
        return
    suppress = None if a.suppress_by == "none" else a.suppress_by or pipelines.INGEST
    if a.streaming or a.live:
        sinks.run_pipeline(messages.select("value"), a.stream, a.output, a.checkpoint, a.dead, trigger, dedup_by=suppress).awaitTermination()
        return
    rows, dead = pipelines.build(messages, a.stream, dedup_by=suppress)
    sinks.append(rows, a.output)
    if a.dead:
        sinks.append(dead, a.dead)


def _collect(spark: SparkSession, a: argparse.Namespace, messages: DataFrame, trigger: dict | None) -> None:
    if a.streaming or a.live:
        arrival = "ingest_timestamp" if "ingest_timestamp" in messages.columns else None
        topic = dict(o.split("=", 1) for o in a.topic_option)
        send = (lambda events: topics.publish(events, a.topic, **topic)) if a.topic else None
        query = collector.run_collector(messages, a.stream, a.output, a.checkpoint, trigger, arrival=arrival, log=lambda line: print(line, file=sys.stderr), send=send)
        server = None
        if a.serve:
            server = exposition.serve(lambda: collector.snapshots(spark, a.output), lambda: query.isActive)
            threading.Thread(target=server.serve_forever, daemon=True).start()
        try:
            query.awaitTermination()
        finally:
            if server:
                server.shutdown()
        return
    numbered = messages.withColumns({"seq": F.monotonically_increasing_id(), "at": F.current_timestamp()})
    rows = pipelines.collect(numbered, a.stream, ["seq"], "at").withColumn("run", F.lit(uuid.uuid4().hex)).persist()
    try:
        sinks.append(pipelines.status_rows(rows, F.col("seq"), "at"), f"{a.output}/{collector.STATUS}")
        sinks.append(parse.dead_letters(rows, "contract"), f"{a.output}/{collector.DEAD}")
        events = parse.batch_events(rows, "run", ["seq", "item"]).select("value") if a.stream == "news" else pipelines.valid_events(rows)
        sinks.publish(events, f"{a.output}/{collector.EVENTS}")
    finally:
        rows.unpersist()


if __name__ == "__main__":
    main()
