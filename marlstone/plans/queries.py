"""Queries over the benchmark's tables, each through the operators it is named for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions import cast
from marlstone.operators import contracts, dedup, derive, exposition, joins, metrics, normalise, parse, reconcile, sketches
from marlstone.plans import cases, pipelines
from marlstone.sources import adapters as a
from marlstone.sources import files
from marlstone.streaming import collector, scratch, sinks, stateful
from marlstone.streaming import joins as stream_joins
from marlstone.streaming.tables import BatchTable, query_id

HALF_DAY = derive.NEWS_HORIZON_SECONDS
Query = Callable[[SparkSession, str], DataFrame]


def _micros(c: str) -> F.Column:
    return F.unix_micros(c).alias(c)


def trade_value(s: SparkSession, d: str) -> DataFrame:
    main, _ = pipelines.build(a.lineitem_trades(s, d), "trades")
    return main.select("trade_id", "symbol", "price", "size", "trade_value", "is_large_trade", F.size("conditions").alias("n_conditions"))


def trade_summary(s: SparkSession, d: str) -> DataFrame:
    main, _ = pipelines.build(a.lineitem_trades(s, d), "trades")
    return main.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_large_trade").alias("n_large"), F.max("trade_value").alias("max_value"), F.sum("size").alias("volume"))


def _events(s: SparkSession, d: str, stream: str) -> DataFrame:
    source = {"trades": a.event_trades, "quotes": a.event_quotes, "crypto": a.event_crypto}[stream]
    return pipelines.typed(source(s, d), stream, carry=["event_id"])


def trade_latency(s: SparkSession, d: str) -> DataFrame:
    main = normalise.main_lane(_events(s, d, "trades"))
    fresh = derive.freshness_seconds(F.col("ingest_timestamp"), F.col("exchange_ts"))
    return main.select("event_id", "latency_ms", F.round(fresh, 6).alias("freshness_seconds"), _micros("exchange_ts"))


def trade_dead_letters(s: SparkSession, d: str) -> DataFrame:
    rows = _events(s, d, "trades")
    return rows.filter(F.size("codes") > 0).select("event_id", F.concat_ws(";", "codes").alias("codes"))


def quote_spread(s: SparkSession, d: str) -> DataFrame:
    return normalise.main_lane(_events(s, d, "quotes")).select("event_id", "symbol", "bid_price", "ask_price", "ask_size", "spread")


def crypto_normalise(s: SparkSession, d: str) -> DataFrame:
    return normalise.main_lane(_events(s, d, "crypto")).select("event_id", "product_id", "price", "size", "trade_value", "is_large_trade", "latency_ms", _micros("time"))


def news_explode(s: SparkSession, d: str) -> DataFrame:
    main, _ = pipelines.build(a.conversation_batches(s, d), "news")
    return main.select("url", "title", F.char_length("summary").alias("n_chars"), F.size("topics").alias("n_topics"), _micros("time_published"))


def news_topics(s: SparkSession, d: str) -> DataFrame:
    main, _ = pipelines.build(a.document_news(s, d), "news")
    topic = main.select("title", "url", F.explode("topics").alias("t"), "overall_sentiment_score")
    return topic.select("title", "url", F.col("t.topic").alias("topic"), F.col("t.relevance_score").alias("relevance_score"), "overall_sentiment_score")


def news_dedup_key(s: SparkSession, d: str) -> DataFrame:
    return a.table(s, d, "documents").select("doc_id", derive.dedup_key(F.col("source"), F.col("text")).alias("dedup_key"))


def news_first_seen(s: SparkSession, d: str) -> DataFrame:
    keyed = a.table(s, d, "documents").select("doc_id", "source", derive.dedup_key(F.lit(None).cast("string"), F.col("text")).alias("dedup_key"))
    return dedup.first_of_key(keyed, ["dedup_key"], ["doc_id"])


def _timed(s: SparkSession, d: str) -> DataFrame:
    return a.table(s, d, "events").select("event_id", "user_id", "event_type", a.instant("ts").alias("at"))


def dedup_12h(s: SparkSession, d: str) -> DataFrame:
    return dedup.accept_by_horizon(_timed(s, d), ["user_id", "event_type"], "at", HALF_DAY, ["event_id"]).filter("accepted").select("event_id", "user_id", "event_type")


def dedup_session(s: SparkSession, d: str) -> DataFrame:
    return dedup.accept_by_session(_timed(s, d), ["user_id", "event_type"], "at", HALF_DAY, ["event_id"]).filter("accepted").select("event_id", "user_id", "event_type")


def session_12h(s: SparkSession, d: str) -> DataFrame:
    return metrics.sessions(_timed(s, d), "at", ["user_id", "event_type"], HALF_DAY).select("user_id", "event_type", _micros("session_start"), _micros("session_end"), "n")


def throughput_rolling(s: SparkSession, d: str) -> DataFrame:
    return metrics.rolling_throughput(_timed(s, d), "at", ["event_type"], 3600).select("event_id", "throughput_msgs_per_sec")


def throughput_now(s: SparkSession, d: str) -> DataFrame:
    status = a.event_status(s, d)
    end = status.agg(F.max("arrival_ts")).first()[0]
    return metrics.throughput_now(status, F.lit(end), 86_400)


def hourly_quality(s: SparkSession, d: str) -> DataFrame:
    return metrics.hourly_quality(a.event_status(s, d)).withColumn("window_start", F.unix_micros("window_start"))


def lifetime_totals(s: SparkSession, d: str) -> DataFrame:
    return metrics.lifetime_totals(a.event_status(s, d)).withColumn("window_start", F.unix_micros("window_start"))


def freshness_last(s: SparkSession, d: str) -> DataFrame:
    return metrics.freshness_mean(a.event_status(s, d)).withColumn("window_start", F.unix_micros("window_start"))


def detection_last(s: SparkSession, d: str) -> DataFrame:
    return metrics.detection_mean(a.event_status(s, d)).withColumn("window_start", F.unix_micros("window_start"))


def spread_last(s: SparkSession, d: str) -> DataFrame:
    return metrics.spread_mean(a.event_status(s, d)).withColumn("window_start", F.unix_micros("window_start"))


def stream_snapshot(s: SparkSession, d: str) -> DataFrame:
    status = a.event_status(s, d)
    return metrics.snapshot(status, F.lit(status.agg(F.max("arrival_ts")).first()[0]))


def metrics_union_streams(s: SparkSession, d: str) -> DataFrame:
    of = lambda df, name: df.agg(F.lit(name).alias("stream"), F.count(F.lit(1)).alias("n_main"))
    trades, _ = pipelines.build(a.lineitem_trades(s, d), "trades")
    quotes = normalise.main_lane(_events(s, d, "quotes"))
    crypto = normalise.main_lane(_events(s, d, "crypto"))
    return of(trades, "trades").unionByName(of(quotes, "quotes")).unionByName(of(crypto, "crypto")).select(F.col("stream").cast("string"), "n_main")


def _contract(stream: str, source: Callable, key: str) -> Query:
    def run(s: SparkSession, d: str) -> DataFrame:
        checked = contracts.check(parse.parse_messages(source(s, d)), stream)
        return checked.select(key, "status", F.concat_ws(";", F.array_sort("codes")).alias("codes"))

    return run


def contract_violation_counts(s: SparkSession, d: str) -> DataFrame:
    lanes = [contracts.check(parse.parse_messages(source(s, d)), n).select(F.lit(n).alias("stream"), F.explode("codes").alias("code")) for n, source in (("trades", a.event_trades), ("quotes", a.event_quotes), ("crypto", a.event_crypto), ("news", a.document_news))]
    return parse.union_dead_letters(*lanes).groupBy("stream", "code").agg(F.count(F.lit(1)).alias("n"))


def dlq_union(s: SparkSession, d: str) -> DataFrame:
    lanes = [parse.dead_letters(_events(s, d, n), n) for n in ("trades", "quotes", "crypto")]
    both = parse.union_dead_letters(*lanes)
    value = parse.dead_letter_bytes(both.select("error", "raw"))
    return value.select(F.get_json_object(F.col("value").cast("string"), "$.error").alias("error")).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


def _collected(frames: DataFrame, stream: str) -> tuple[DataFrame, Callable]:
    """Every message that a collector received: what became of it, and what its event says."""
    got = pipelines.collect(frames, stream, ["frame"], "at")
    said = lambda key, kind: F.get_json_object("event", f"$.{key}").cast(kind)
    out = got.select("frame", "item", "status", F.concat_ws(";", F.array_sort("codes")).alias("codes"), F.round("freshness_seconds", 6).alias("freshness_seconds"), said("S", "string").alias("symbol"), "spread", "event")
    return out, said


def collector_trades(s: SparkSession, d: str) -> DataFrame:
    """Each trade message of the frames, with arrays, other messages and repeats among them, and its event's fields."""
    out, said = _collected(a.equity_frames(a.event_trades(s, d, repeats=True)), "trades")
    ingest = F.round(said("ingest_timestamp", "double"), 6)
    return out.select("frame", "item", "status", "codes", "freshness_seconds", "symbol", said("i", "long").alias("trade_id"), said("p", "double").alias("price"), said("s", "long").alias("size"), ingest.alias("ingest_timestamp"))


def collector_quotes(s: SparkSession, d: str) -> DataFrame:
    out, said = _collected(a.equity_frames(a.event_quotes(s, d, repeats=True)), "quotes")
    return out.select("frame", "item", "status", "codes", "freshness_seconds", "symbol", "spread", said("spread", "double").alias("event_spread"), said("as", "long").alias("ask_size"), said("t", "string").alias("t"))


def collector_crypto(s: SparkSession, d: str) -> DataFrame:
    """Each match, in its product's sequence, against the memory of two ids."""
    late = F.timestamp_micros(a.epoch_micros("ts") + F.col("event_id") % 8 * 250_000)
    messages = a.event_crypto(s, d, repeats=True).select(F.col("event_id").alias("frame"), late.alias("at"), "value")
    out, said = _collected(messages, "crypto")
    return out.select("frame", "status", "codes", "freshness_seconds", said("product_id", "string").alias("product_id"), said("trade_id", "long").alias("trade_id"), said("price", "string").alias("price"), said("side", "string").alias("side"))


def collector_news(s: SparkSession, d: str) -> DataFrame:
    out, said = _collected(a.news_frames(a.document_news(s, d)), "news")
    return out.select("frame", "item", "status", "codes", "freshness_seconds", said("url", "string").alias("url"), said("overall_sentiment_score", "double").alias("score"), said("overall_sentiment_label", "string").alias("label"))


def collector_status(s: SparkSession, d: str) -> DataFrame:
    """The four collectors' rows by stream and status, as the metrics count them."""
    lanes = [
        pipelines.collect(a.equity_frames(a.event_trades(s, d, repeats=True)), "trades", ["frame"], "at"), pipelines.collect(a.equity_frames(a.event_quotes(s, d, repeats=True)), "quotes", ["frame"], "at"),
        pipelines.collect(a.event_crypto(s, d, repeats=True).select(F.col("event_id").alias("frame"), a.instant("ts").alias("at"), "value"), "crypto", ["frame"], "at"),
        pipelines.collect(a.news_frames(a.document_news(s, d)), "news", ["frame"], "at"),
    ]
    rows = parse.union_dead_letters(*(pipelines.status_rows(x, F.col("frame"), "at") for x in lanes))
    return rows.groupBy("stream", "status").agg(F.count(F.lit(1)).alias("n"), F.count("freshness_seconds").alias("n_fresh"), F.count("spread").alias("n_spreads"))


def collector_log(s: SparkSession, d: str) -> DataFrame:
    """The lines that a collector of quotes writes about its messages."""
    return pipelines.log_lines(pipelines.collect(a.equity_frames(a.event_quotes(s, d, repeats=True)), "quotes", ["frame"], "at"), "frame")


def trade_frames(s: SparkSession, d: str) -> DataFrame:
    """The trades that collectors publish, read by the pipeline: one row for each valid event."""
    events = pipelines.valid_events(pipelines.collect(a.equity_frames(a.event_trades(s, d, repeats=True)), "trades", ["frame"], "at"))
    main, _ = pipelines.build(events, "trades")
    return main.select("trade_id", "symbol", "trade_value", "latency_ms", F.round("freshness_seconds", 6).alias("freshness_seconds"))


def news_pipeline(s: SparkSession, d: str) -> DataFrame:
    """Stories told again within 12 hours of the last accepted telling are left out."""
    main, _ = pipelines.build(a.event_news(s, d), "news", dedup_by="time_published")
    return main.select(F.col("summary").cast("long").alias("event_id"), "title", "url", _micros("time_published"))


def dedup_trade_id(s: SparkSession, d: str) -> DataFrame:
    """Distinct trades by id, with how many messages each came in."""
    main, _ = pipelines.build(a.lineitem_trades(s, d), "trades")
    marked = dedup.mark_repeats(main.select("trade_id", "exchange_ts", "price", "size", "ingest_timestamp"), ["trade_id"], ["exchange_ts", "price", "size", "ingest_timestamp"])
    return marked.groupBy("trade_id").agg(F.count_if(~F.col("is_duplicate")).alias("n_first"), F.min(F.when(~F.col("is_duplicate"), F.col("price"))).alias("price"))


def dedup_quote_key(s: SparkSession, d: str) -> DataFrame:
    quotes = _events(s, d, "quotes").filter(F.size("codes") == 0).withColumn("at_minute", F.date_trunc("hour", "exchange_ts"))
    marked = dedup.mark_repeats(quotes.select("event_id", "symbol", "at_minute"), ["symbol", "at_minute"], ["event_id"])
    return marked.select("event_id", "is_duplicate")


def dedup_either(s: SparkSession, d: str) -> DataFrame:
    """Events against a memory of two ids each, some of which come again while they are remembered, some after; exact over
    stretches of the sequence."""
    k = F.col("event_id")
    e = a.table(s, d, "events").select("event_id", (k * k % 701).alias("id1"), ((k * 31 + F.floor(k / 5)) % 997).alias("id2"))
    got, _ = dedup.bounded_memory(e, ["id1", "id2"], ["event_id"], capacity=300, stretch=25_000)
    return got


def sentiment_distribution(s: SparkSession, d: str) -> DataFrame:
    checked = contracts.check(parse.parse_messages(a.document_news(s, d)), "news")
    label = cast.strict_string(cast.field(F.col("v"), "overall_sentiment_label")).alias("overall_sentiment_label")
    return metrics.sentiment_distribution(checked.select("status", label))


def sentiment_scale(s: SparkSession, d: str) -> DataFrame:
    score = (F.col("doc_id") % 21 - 10) / 20.0
    return a.table(s, d, "documents").select("doc_id", contracts.sentiment_of(score).alias("label"))


def news_run_metrics(s: SparkSession, d: str) -> DataFrame:
    checked = contracts.check(parse.parse_messages(a.document_news(s, d)), "news")
    k = F.col("doc_id")
    return metrics.run_metrics(checked.select("run_id", "status", ((k % 256) / 64.0).alias("freshness_seconds"), ((k % 32) / 8.0).alias("detection_ms")))


def news_publish(s: SparkSession, d: str) -> DataFrame:
    """One array message for each run, of its valid articles: how many it holds, and the first and last one's address."""
    events = pipelines.collect(a.news_frames(a.document_news(s, d)), "news", ["frame"], "at")
    batch = parse.batch_events(events, "run_id", ["frame", "item"])
    text = F.col("value").cast("string")
    return batch.select("run_id", F.json_array_length(text).alias("n_articles"), F.get_json_object(text, "$[0].title").alias("first_title"))


def symbol_upper_valid(s: SparkSession, d: str) -> DataFrame:
    n = a.table(s, d, "nation").select(F.col("n_name").alias("name")).unionByName(a.table(s, d, "part").select(F.col("p_name").alias("name")))
    return n.select("name", F.coalesce(F.col("name").rlike(contracts.SYMBOL), F.lit(False)).alias("valid"), F.upper("name").alias("symbol"))


def iso_truncate(s: SparkSession, d: str) -> DataFrame:
    o = a.table(s, d, "orders")
    nano = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".123456789Z"))
    ts = cast.iso_timestamp(cast.cut_nanoseconds(nano))
    return o.select("o_orderkey", F.unix_micros(ts).alias("micros"), cast.format_micros(ts).alias("text"))


def compact_ts(s: SparkSession, d: str) -> DataFrame:
    ts = cast.compact_timestamp(a.compact("ts"))
    return a.table(s, d, "events").select("event_id", F.unix_micros(ts).alias("micros"), cast.format_seconds(ts).alias("text"), cast.lookback_cutoff(ts).alias("cutoff"))


def _of_list(s: SparkSession, d: str, values: list[str]) -> DataFrame:
    """A message for each event, from a list, again and again."""
    e = a.spread(a.table(s, d, "events").select("event_id"))
    return e.select("event_id", F.element_at(F.array(*map(F.lit, values)), (F.col("event_id") % len(values) + 1).cast("int")).cast("binary").alias("value"))


def contract_faults(s: SparkSession, d: str) -> DataFrame:
    """Every rule of the four contracts, broken and kept, alone and together with others."""
    lanes = []
    for stream, given in cases.CONTRACTS.items():
        checked = contracts.check(parse.parse_messages(_of_list(s, d, [m for m, *_ in given])), stream)
        lanes.append(checked.select(F.lit(stream).alias("stream"), "event_id", "status", F.concat_ws(";", F.array_sort("codes")).alias("codes")))
    return parse.union_dead_letters(*lanes)


def shown(stream: str) -> F.Column:
    """A few of a typed row's values as text."""
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    if stream == "news":
        return F.concat_ws("|", F.array_join(F.transform("topics", lambda t: F.concat_ws("=", t["topic"], t["relevance_score"].cast("string"))), ","), number("overall_sentiment_score"))
    return F.concat_ws("|", number("ingest_timestamp"), "side" if stream == "crypto" else F.size("conditions").cast("string"))


def normalise_edges(s: SparkSession, d: str) -> DataFrame:
    """Defaults, guards, missing and null fields of the four pipelines, with the time of their ingestion."""
    lanes = []
    now = F.timestamp_micros(F.lit(1_700_000_000_000_000))
    for stream, given in cases.NORMALISED.items():
        rows = pipelines.typed(_of_list(s, d, [m for m, *_ in given]), stream, now, carry=["event_id"])
        at = F.lit(None).cast("long") if stream == "news" else F.unix_micros("pipeline_ingest_time")
        fine = F.size("codes") == 0
        lanes.append(rows.select(F.lit(stream).alias("stream"), "event_id", F.concat_ws(";", F.array_sort("codes")).alias("codes"), F.when(fine, shown(stream)).otherwise("").alias("shown"), F.when(fine, at).alias("ingested")))
    return parse.union_dead_letters(*lanes)


def contract_mixed(s: SparkSession, d: str) -> DataFrame:
    """The codes of messages whose fields are sound or odd by their rows' numbers, in the four contracts."""
    lanes = []
    for stream in a.MIXED:
        checked = contracts.check(parse.parse_messages(a.event_mixed(s, d, stream)), stream)
        lanes.append(checked.select(F.lit(stream).alias("stream"), "event_id", "status", F.concat_ws(";", F.array_sort("codes")).alias("codes")))
    return parse.union_dead_letters(*lanes)


def normalise_mixed(s: SparkSession, d: str) -> DataFrame:
    """The same messages through the four pipelines: codes, or values with defaults and guards and the time of ingestion."""
    lanes = []
    now = F.timestamp_micros(F.lit(1_700_000_000_000_000))
    for stream in a.MIXED:
        rows = pipelines.typed(a.event_mixed(s, d, stream), stream, now, carry=["event_id"])
        at = F.lit(None).cast("long") if stream == "news" else F.unix_micros("pipeline_ingest_time")
        fine = F.size("codes") == 0
        what = F.when(fine, shown(stream)).otherwise("")
        lanes.append(rows.select(F.lit(stream).alias("stream"), "event_id", F.concat_ws(";", F.array_sort("codes")).alias("codes"), what.alias("shown"), F.when(fine, at).alias("ingested")))
    return parse.union_dead_letters(*lanes)


def source_messages(s: SparkSession, d: str) -> DataFrame:
    """Messages out of files: a column as it is, and whole rows as JSON."""
    props = parse.parse_messages(files.messages(s, f"{d}/events.parquet", "parquet", column="props"))
    rows = parse.parse_messages(files.messages(s, f"{d}/customer.parquet", "parquet"))
    one = props.select(F.lit("events").alias("source"), F.size("codes").alias("n_codes"), cast.to_long(cast.field(F.col("v"), "k")).alias("k"))
    two = rows.select(F.lit("customer").alias("source"), F.size("codes").alias("n_codes"), cast.to_long(cast.field(F.col("v"), "c_custkey")).alias("k"))
    return one.unionByName(two).groupBy("source", "n_codes").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("total"))


def only_symbols(s: SparkSession, d: str) -> DataFrame:
    main = normalise.main_lane(_events(s, d, "quotes"))
    return parse.only_symbols(main, "symbol", ["view", "click"]).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


def metric_names(s: SparkSession, d: str) -> DataFrame:
    p = a.table(s, d, "part")
    return p.select("p_partkey", cast.metric_name(F.concat_ws("-", "p_name", F.lit("Somewhat Bullish"))).alias("name"))


def published_datetime(s: SparkSession, d: str) -> DataFrame:
    at = cast.published_datetime(a.compact("ts"))
    return a.table(s, d, "events").select("event_id", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("published"))


def recent_dead_letters(s: SparkSession, d: str) -> DataFrame:
    rows = _events(s, d, "trades").filter(F.size("codes") > 0).select("event_id", F.concat_ws(";", "codes").alias("codes"))
    return metrics.recent_dead_letters(rows, "event_id")


def throughput_sliding(s: SparkSession, d: str) -> DataFrame:
    status = a.event_status(s, d).filter("status = 'valid'")
    out = metrics.sliding_throughput(status, seconds=3600, every="10 minutes")
    return out.select("stream", F.unix_micros("window.start").alias("window_start"), "throughput_msgs_per_sec")


def exposition_text(s: SparkSession, d: str) -> DataFrame:
    """The text for scrapers, line by line: each metric's name, kind and value."""
    rows = {r["stream"]: r.asDict() for r in stream_snapshot(s, d).collect()}  # one row for each stream
    lines = exposition.render_streams(rows).splitlines()
    kinds = {x.split()[2]: x.split()[3] for x in lines if x.startswith("# TYPE")}
    values = [x.split() for x in lines if not x.startswith("#")]
    return s.createDataFrame([(name, kinds[name], float(v)) for name, v in values], "metric string, kind string, value double")


def run_text(s: SparkSession, d: str) -> DataFrame:
    """A news run's metrics as they are pushed; the run is that of the first source."""
    first = news_run_metrics(s, d).filter("run_id IS NOT NULL").orderBy("run_id").first().asDict()
    lines = exposition.render_run(first | {"api_latency_seconds": 0.5, "run_duration_seconds": 2.5}, {"Somewhat-Bearish": 3}).splitlines()
    return s.createDataFrame([(x.split()[0], float(x.split()[1])) for x in lines if not x.startswith("#")], "metric string, value double")


def collector_memory(s: SparkSession, d: str) -> DataFrame:
    """Trades against the exact memory of accepted ids."""
    got = pipelines.collect(a.equity_frames(a.event_trades(s, d, repeats=True)), "trades", ["frame"], "at", exact=True)
    return got.select("frame", "item", "status")


def _trades(s: SparkSession, d: str) -> DataFrame:
    return normalise.main_lane(_events(s, d, "trades")).select("event_id", "symbol", F.col("exchange_ts").alias("at"), "price")


def _quotes(s: SparkSession, d: str, which: int | None = None) -> DataFrame:
    """The quotes of all events; which: those of every third one."""
    q = normalise.main_lane(_events(s, d, "quotes"))
    q = q if which is None else q.filter(F.col("event_id") % 3 == which)
    return q.select(F.col("event_id").alias("quote_id"), "symbol", F.col("exchange_ts").alias("quoted"), "bid_price", "ask_price")


def asof_trades_quotes(s: SparkSession, d: str) -> DataFrame:
    """Each trade with the last quote of its symbol before it."""
    got = joins.asof_join(_trades(s, d), _quotes(s, d, 0), ["symbol"], "at", ["quote_id", "quoted", "bid_price", "ask_price"], "quoted", ["quote_id"], exact=False)
    return got.select("event_id", "symbol", "price", "quote_id", "bid_price", "ask_price", (F.unix_micros("at") - F.unix_micros("quoted")).alias("age_micros"))


def asof_next_quote(s: SparkSession, d: str) -> DataFrame:
    """Each trade with the next quote of its symbol, if that comes within ten minutes."""
    got = joins.asof_join(_trades(s, d), _quotes(s, d, 1), ["symbol"], "at", ["quote_id", "quoted"], "quoted", ["quote_id"], tolerance_seconds=600, forward=True, slice_seconds=900)
    return got.select("event_id", "symbol", "quote_id", (F.unix_micros("quoted") - F.unix_micros("at")).alias("wait_micros"))


def quotes_around_trades(s: SparkSession, d: str) -> DataFrame:
    """For each trade the quotes of its symbol in the window from five minutes before it, and how far they spread."""
    windows = _trades(s, d).select("event_id", "symbol", (F.col("at") - F.expr("INTERVAL 5 MINUTES")).alias("opens"), F.col("at").alias("closes"))
    met = joins.range_join(_quotes(s, d), windows, ["symbol"], "quoted", ("opens", "closes"))
    return met.groupBy(F.col("range_event_id").alias("event_id")).agg(F.count(F.lit(1)).alias("n_quotes"), F.max("bid_price").alias("best_bid"), F.min("ask_price").alias("best_ask"))


def sessions_overlap(s: SparkSession, d: str) -> DataFrame:
    """Pairs of a user's sessions of views and of errors that overlap, with the time that they share."""
    of = lambda kind: metrics.sessions(_timed(s, d).filter(F.col("event_type") == kind), "at", ["user_id", "event_type"], HALF_DAY).drop("event_type")
    met = joins.overlap_join(of("view"), of("error"), ["user_id"], ("session_start", "session_end"), ("session_start", "session_end"), "error_")
    shared = F.least(F.unix_micros("session_end"), F.unix_micros("error_session_end")) - F.greatest(F.unix_micros("session_start"), F.unix_micros("error_session_start"))
    return met.select("user_id", _micros("session_start"), F.unix_micros("error_session_start").alias("error_start"), "n", "error_n", shared.alias("shared_micros"))


def collector_short_memory(s: SparkSession, d: str) -> DataFrame:
    """Trades against a memory of two accepted ids, in which an id that comes again three trades later is known only if one of those
    between was not accepted."""
    got = pipelines.collect(a.equity_frames(a.event_trades(s, d, repeats=True)), "trades", ["frame"], "at", exact=True, capacity=2)
    return got.select("frame", "item", "status")


def _streamed(s: SparkSession, messages: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Messages as a stream of text files, some to a micro-batch, and a folder for what comes of it."""
    folder = scratch.folder(s, name)
    messages.select(F.col("value").cast("string").alias("value")).repartition(4).write.text(f"{folder}/in")
    return files.messages(s, f"{folder}/in", stream=True, files_per_batch=2), folder


def reconcile_trades(s: SparkSession, d: str) -> DataFrame:
    """Where the messages of trades with repeats went, and what is missed if a part of the table is lost."""
    messages = a.event_trades(s, d, repeats=True)
    rows = pipelines.typed(messages, "trades", carry=["event_id"])
    good = dedup.mark_repeats(rows.filter(F.size("codes") == 0), ["trade_id"], ["event_id"])
    came = messages.select(F.col("value").cast("string").alias("raw"))
    lanes = {"table_": good.filter("NOT is_duplicate"), "duplicate": good.filter("is_duplicate"), "dead": rows.filter(F.size("codes") > 0)}
    whole = reconcile.totals(reconcile.books(came, lanes))
    short = reconcile.totals(reconcile.books(came, lanes | {"table_": lanes["table_"].filter("event_id % 97 <> 0")}))
    return whole.select(F.lit("whole").alias("books"), "*").unionByName(short.select(F.lit("short").alias("books"), "*"))


def sketched_days(s: SparkSession, d: str) -> DataFrame:
    """Days out of hourly sketches, beside the exact values: users of each type, and whether the sketches are within their errors."""
    rows = a.table(s, d, "events").select("event_type", "user_id", "value", a.instant("ts").alias("at"))
    days = sketches.rolled(sketches.hourly(rows, ["event_type"], "at", "user_id", "value"), ["event_type"], "day")
    days = days.select("event_type", "day", "n", sketches.distinct_count().alias("users"), sketches.quantile(0.5).alias("median"))
    exact = rows.withColumn("day", F.date_trunc("day", "at")).join(days, ["event_type", "day"]).groupBy("event_type", "day", "n", "users", "median")
    told = exact.agg(F.count_distinct("user_id").alias("exact_users"), F.avg((F.col("value") < F.col("median")).cast("double")).alias("below"), F.avg((F.col("value") <= F.col("median")).cast("double")).alias("upto"))
    near = F.abs(F.col("users") - F.col("exact_users")) <= F.greatest(F.lit(1), F.col("exact_users") * 0.06)
    return told.select("event_type", F.unix_micros("day").alias("day"), "n", "exact_users", near.alias("users_near"), ((F.col("below") <= 0.55) & (F.col("upto") >= 0.45)).alias("median_near"))


def stream_sessions(s: SparkSession, d: str) -> DataFrame:
    """News sessions over a stream: the rows that open one, and each session that is over, once."""
    folder = scratch.folder(s, "sessions")
    rows = _timed(s, d).select(F.concat_ws("|", F.col("user_id").cast("string"), "event_type").alias("story"), "event_id", "at")
    end = rows.agg((F.max("at") + F.expr("INTERVAL 30 DAYS")).alias("at")).select(F.lit("end").alias("story"), F.lit(-1).cast("long").alias("event_id"), "at")
    stream = _in_order(s, rows.unionByName(end), "at", folder)
    out = stateful.accept_by_session(stream, "story", "at", HALF_DAY, "event_id", 0)
    _appended(s, out, folder, "sessions", f"{folder}/out", empty_batches=True).awaitTermination()
    got = BatchTable(s, f"{folder}/out").read(out.schema).filter("key <> 'end'")
    return got.groupBy("key").agg(F.count_if(F.col("kind") == "accepted").alias("n_accepted"), F.count_if(F.col("kind") == "session").alias("n_sessions"), F.sum("n").alias("n_rows"), F.min("session_start").alias("first_start"), F.max("session_end").alias("last_end"))


def _in_order(s: SparkSession, rows: DataFrame, at: str, folder: str) -> DataFrame:
    """Rows as a stream of files, each of a later stretch of time than the one before, in four micro-batches of a file for each core."""
    files_per_batch = s.sparkContext.defaultParallelism
    rows.repartitionByRange(4 * files_per_batch, at).write.parquet(f"{folder}/rows")
    fs, p = scratch.hadoop(s, f"{folder}/rows")
    for k, f in enumerate(sorted(x.getPath().toString() for x in fs.listStatus(p) if x.getPath().getName().startswith("part-"))):
        fs.setTimes(scratch.hadoop(s, f)[1], 1_600_000_000_000 + k * 60_000, -1)  # a stream of files takes the older ones first
    return s.readStream.schema(rows.schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{folder}/rows")


def _written(rows: DataFrame, path: str) -> DataFrame:
    """The rows, read back from files: a range partitioning runs what it partitions twice, first for its bounds, so messages would be parsed
    twice."""
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _appended(spark: SparkSession, rows: DataFrame, folder: str, name: str, table: str, mode: str = "append", empty_batches: bool = False, count_state: bool = True):
    """Start a query that appends a stream's batches to a table; it ends when its source is worked off."""
    checkpoint = f"{folder}/checkpoint-{name}"

    def write(df: DataFrame, batch: int) -> None:
        BatchTable(df.sparkSession, table).commit(df, query_id(df.sparkSession, checkpoint), batch)

    return sinks.started(rows.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True), spark, empty_batches, count_state)


def stream_trade_quotes(s: SparkSession, d: str) -> DataFrame:
    """Two streams, trades and quotes, joined in time: each trade with the quotes of its symbol in the minute before it."""
    folder = scratch.folder(s, "trade-quotes")
    trades, quotes = (_in_order(s, _written(rows, f"{folder}/{name}/parsed"), at, f"{folder}/{name}") for name, rows, at in (("trades", _trades(s, d), "at"), ("quotes", _quotes(s, d), "quoted")))
    joined = stream_joins.join_streams(trades, quotes, ["symbol"], "at", "quoted", 60, 0, 3600, prefix="q_")
    _appended(s, joined, folder, "join", f"{folder}/joined", count_state=False).awaitTermination()
    got = BatchTable(s, f"{folder}/joined").read(joined.schema)
    return got.select("event_id", F.col("q_quote_id").alias("quote_id"), "symbol", "price", F.col("q_bid_price").alias("bid_price"))


def stream_quality(s: SparkSession, d: str) -> DataFrame:
    """The hourly quality of a stream of status rows, kept in state under a watermark and given out as it changes."""
    folder = scratch.folder(s, "quality")
    rows = stream_joins.quality_windows(_in_order(s, a.event_status(s, d), "arrival_ts", f"{folder}/status"), 600)
    _appended(s, rows, folder, "quality", f"{folder}/windows", "update").awaitTermination()
    last = stream_joins.latest(BatchTable(s, f"{folder}/windows").read(rows.schema), ["stream", "window_start"]).drop("query", "batch")
    return last.withColumn("window_start", F.unix_micros("window_start"))


def stream_two_queries(s: SparkSession, d: str) -> DataFrame:
    """Two pipelines with checkpoints of their own that write into one table, one started again: every trade is there once."""
    folder = scratch.folder(s, "two")
    messages = a.event_trades(s, d)
    for k in (0, 1, 0):
        path = f"{folder}/in-{k}"
        fs, p = scratch.hadoop(s, path)
        if not fs.exists(p):
            messages.filter(F.col("event_id") % 2 == k).select(F.col("value").cast("string").alias("value")).repartition(2).write.text(path)
        stream = files.messages(s, path, stream=True, files_per_batch=1)
        sinks.run_pipeline(stream, "trades", f"{folder}/main", f"{folder}/checkpoint-{k}", f"{folder}/dead").awaitTermination()
    main, dead = BatchTable(s, f"{folder}/main").read(), BatchTable(s, f"{folder}/dead").read()
    count = lambda df, lane: df.groupBy("query").agg(F.lit(lane).alias("lane"), F.count(F.lit(1)).alias("n"), F.count_distinct("batch").alias("batches")).drop("query")
    return count(main, "main").unionByName(count(dead, "dead"))


def stream_trades(s: SparkSession, d: str) -> DataFrame:
    """The trades pipeline as a stream of files: its table and its dead letters."""
    messages, folder = _streamed(s, a.event_trades(s, d), "trades")
    sinks.run_pipeline(messages, "trades", f"{folder}/main", f"{folder}/checkpoint", f"{folder}/dead").awaitTermination()
    main, dead = s.read.parquet(f"{folder}/main"), s.read.parquet(f"{folder}/dead")
    good = main.select(F.lit("main").alias("lane"), F.col("trade_id").cast("string").alias("what"), "trade_value")
    return good.unionByName(dead.groupBy("error").agg(F.count(F.lit(1)).cast("double").alias("trade_value")).select(F.lit("dead").alias("lane"), F.col("error").alias("what"), "trade_value"))


def stream_news(s: SparkSession, d: str) -> DataFrame:
    """The news pipeline as a stream: each story once, however often it is told within the horizon."""
    messages, folder = _streamed(s, a.event_news(s, d), "news")
    sinks.run_pipeline(messages, "news", f"{folder}/main", f"{folder}/checkpoint", f"{folder}/dead").awaitTermination()
    main, dead = s.read.parquet(f"{folder}/main"), s.read.parquet(f"{folder}/dead")
    stories = main.groupBy(F.col("title").alias("what")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("url").alias("n_stories"))
    return stories.unionByName(dead.groupBy(F.col("error").alias("what")).agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("n_stories")))


def stream_collector(s: SparkSession, d: str) -> DataFrame:
    """A collector of quotes over a stream, with its memory over micro-batches: rows by status, and published events."""
    messages, folder = _streamed(s, a.equity_frames(a.event_quotes(s, d, repeats=True)), "quotes")
    collector.run_collector(messages, "quotes", f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    read = s.read.option("recursiveFileLookup", "true")
    status = read.parquet(f"{folder}/out/{collector.STATUS}").groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    events = read.text(f"{folder}/out/{collector.EVENTS}").agg(F.lit("published").alias("status"), F.count(F.lit(1)).alias("n"))
    return status.unionByName(events)


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        trade_value, trade_summary, trade_latency, trade_dead_letters, quote_spread, crypto_normalise, news_explode, news_topics, news_dedup_key, news_first_seen,
        dedup_12h, dedup_session, session_12h, throughput_rolling, throughput_now, hourly_quality, lifetime_totals, freshness_last, detection_last, spread_last,
        stream_snapshot, metrics_union_streams, contract_violation_counts, dlq_union, collector_trades, collector_quotes, collector_crypto, collector_news, collector_status, collector_log, trade_frames, news_pipeline, dedup_trade_id, dedup_quote_key, dedup_either,
        sentiment_distribution, sentiment_scale, news_run_metrics, news_publish, symbol_upper_valid, iso_truncate, compact_ts,
        contract_faults, normalise_edges, source_messages, only_symbols, metric_names, published_datetime, recent_dead_letters, throughput_sliding, exposition_text, run_text, collector_memory,
        stream_trades, stream_news, stream_collector, asof_trades_quotes, asof_next_quote, quotes_around_trades, sessions_overlap,
        reconcile_trades, sketched_days, stream_sessions, contract_mixed, normalise_mixed, collector_short_memory, stream_trade_quotes, stream_quality, stream_two_queries,
    )
} | {
    "contract_trades": _contract("trades", a.event_trades, "event_id"),
    "contract_quotes": _contract("quotes", a.event_quotes, "event_id"),
    "contract_crypto": _contract("crypto", a.event_crypto, "event_id"),
    "contract_news": _contract("news", a.document_news, "doc_id"),
}
