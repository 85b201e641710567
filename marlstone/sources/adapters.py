"""Raw messages made of the benchmark's tables, with faults at known rows, for queries, tests and measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_JSON = {"ignoreNullFields": "true"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df over all cores: a small file is one row group, however many partitions its bytes are split into, while a feed of
    this size would have many."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() <= 4 * n else df


def epoch_micros(ts: str) -> Column:
    """Microseconds of a timestamp without a zone, taken as UTC whatever the session's zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', CAST({ts} AS TIMESTAMP_NTZ))")


def instant(ts: str) -> Column:
    return F.timestamp_micros(epoch_micros(ts))


def iso(ts: str) -> Column:
    return F.concat(F.date_format(F.col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))


def compact(ts: str) -> Column:
    return F.date_format(F.col(ts), "yyyyMMdd'T'HHmmss")


def _object(literal: dict[str, Column], **columns: Column) -> Column:
    """A JSON object's bytes; literal fields are JSON text already, null ones are left out, columns come typed."""
    parts = [F.when(c.isNotNull(), F.concat(F.lit(f'"{k}":'), c)) for k, c in literal.items()]
    if columns:
        rest = F.to_json(F.struct(*(c.alias(k) for k, c in columns.items())), _JSON)
        parts.append(F.substr(rest, F.lit(2), F.length(rest) - 2))
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).cast("binary")


def number(c: Column) -> Column:
    return c.cast("string")


def quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), c.cast("string"), F.lit('"'))


def lineitem_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trade for each line item; the seventh line of an order has no price but text."""
    li = spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"))
    price = F.when(F.col("l_linenumber") == 7, F.lit('"n/a"')).otherwise(number(F.col("l_extendedprice")))
    body = _object(
        {
            "p": price, "S": quoted(F.concat(F.lit("SYM"), "l_returnflag", "l_linestatus")), "T": F.lit('"t"'),
            "i": number(F.col("l_orderkey") * 8 + F.col("l_linenumber")), "x": F.lit('"V"'), "s": number(F.col("l_quantity").cast("long")), "z": F.lit('"C"'), "t": quoted(iso("l_shipdate")),
            "c": F.when(F.col("l_returnflag") == "R", F.lit('["@","I"]')), "ingest_timestamp": number(epoch_micros("l_shipdate") / 1e6 + F.col("l_linenumber") / 8.0),
        }
    )
    return li.select(body.alias("value"))


def event_trades(spark: SparkSession, sf_dir: str, repeats: bool = False) -> DataFrame:
    """A trade for each event, with its id, ingested event_id % 1000 ms later; faults by event_id % 11.

    repeats: where event_id % 7 is 3, the trade has the id of the third event before.
    """
    fault, k = F.col("event_id") % 11, F.col("event_id")
    trade_id = F.when(k % 7 == 3, k - 3).otherwise(k) if repeats else k
    body = _object(
        {
            "p": F.when(fault == 1, None).when(fault == 2, F.lit('"1.5d"')).when(fault == 3, F.lit("-1.0")).otherwise(number(F.col("value"))),
            "s": F.when(fault == 4, F.lit('"10.0"')).when(fault == 5, F.lit("10.7")).otherwise(number(F.col("user_id") % 100 + 1)),
            "S": F.when(fault == 6, F.lit('"A1"')).otherwise(quoted(F.regexp_replace("event_type", "[^A-Za-z]", ""))),
            "T": F.lit('"t"'), "i": number(trade_id), "x": F.lit('"V"'), "t": quoted(F.when(fault == 7, F.lit("2025")).otherwise(iso("ts"))),
            "ingest_timestamp": number(F.when(F.col("event_id") % 10 != 0, epoch_micros("ts") / 1e6 + (F.col("event_id") % 1000) / 1000.0)),
        }
    )
    return spread(table(spark, sf_dir, "events")).select("event_id", "ts", F.when(fault == 8, F.lit("not json").cast("binary")).otherwise(body).alias("value"))


def event_quotes(spark: SparkSession, sf_dir: str, repeats: bool = False) -> DataFrame:
    """A quote for each event; every fifth has no bid, every thirteenth a negative ask size.

    repeats: quotes bear the hour of their event, even ones with a Z and odd ones with the offset spelt out.
    """
    e, k = spread(table(spark, sf_dir, "events")), F.col("event_id")
    hour = F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd'T'HH:mm:ss")
    at = F.concat(hour, F.when(k % 2 == 0, "Z").otherwise("+00:00")) if repeats else iso("ts")
    bid = F.when(k % 5 == 0, F.lit(0.0)).otherwise(F.round(F.col("value"), 2))
    body = _object(
        {
            "S": quoted(F.regexp_replace("event_type", "[^A-Za-z]", "")), "T": F.lit('"q"'), "as": F.when(k % 13 == 0, F.lit("-1")).otherwise(F.lit("3")),
            "bx": F.lit('"V"'), "bp": number(bid), "bs": number(k % 9), "ax": F.lit('"W"'), "ap": number(F.round(F.col("value"), 2) + (k % 7 - 3) / 4.0), "c": F.lit('["R"]'), "z": F.lit('"C"'), "t": quoted(at),
        }
    )
    return e.select("event_id", "ts", body.alias("value"))


def event_crypto(spark: SparkSession, sf_dir: str, repeats: bool = False) -> DataFrame:
    """A match for each event; faults by event_id % 9, every fourteenth a heartbeat.

    repeats: each four events from a multiple of four on are of one product; the second has the trade id of the first,
    the third the sequence of the second.
    """
    k = F.col("event_id")
    e = spread(table(spark, sf_dir, "events")).withColumns({"fault": k % 9, "in_four": k % 4, "letters": F.regexp_replace("event_type", "[^A-Za-z]", ""), "amount": F.round(F.col("value"), 2)})
    fault, place = F.col("fault"), F.col("in_four")
    product = F.concat(F.upper("letters"), F.lit("-USD"))
    trade_id, sequence = k + 1, k * 2
    if repeats:
        product = F.concat(F.element_at(F.array(*map(F.lit, "ABC")), (F.floor(k / 4) % 3 + 1).cast("int")), F.lit("-USD"))
        trade_id, sequence = F.when(place == 1, k).otherwise(k + 1), F.when(place == 2, k * 2 - 2).otherwise(k * 2)
    body = _object(
        {
            "price": F.when(fault == 1, number(F.col("value"))).when(fault == 2, F.lit('"0"')).otherwise(quoted(F.col("amount"))),
            "type": quoted(F.when(k % 14 == 0, F.lit("heartbeat")).when(k % 2 == 0, F.lit("match")).otherwise(F.lit("last_match"))), "trade_id": number(trade_id), "sequence": number(sequence),
            "product_id": quoted(F.when(fault == 3, F.lit("1INCH-USD")).otherwise(product)),
            "size": quoted((F.col("user_id") % 8 + 1) / 8.0), "side": quoted(F.when(fault == 4, F.lit("hold")).when(k % 3 == 0, F.lit("buy")).otherwise(F.lit("sell"))),
            "time": quoted(F.when(fault == 5, F.lit("T19:41")).otherwise(iso("ts"))), "ingest_timestamp": number(F.when(fault != 6, epoch_micros("ts") / 1e6 + 0.25)),
        }
    )
    return e.select("event_id", "ts", body.alias("value"))


def equity_frames(messages: DataFrame) -> DataFrame:
    """Messages of events as a socket's frames: frame (the first event's id), at (its last event's time) and value.

    Each three events from a multiple of three on are an array; every tenth of these starts with a message of another
    type. Where event_id % 15 is 12 or more, and where a message is no object, it is a frame by itself. Each event whose id is a
    multiple of 150 is followed by an empty array.
    """
    k, text = F.col("event_id"), F.col("value").cast("string")
    three, alone = F.floor(k / 3), (k % 15 >= 12) | ~text.startswith("{")
    said = messages.groupBy(three.alias("three"), F.when(alone, k).alias("one")).agg(
        F.min(k).alias("frame"), F.max(instant("ts")).alias("at"), F.transform(F.array_sort(F.collect_list(F.struct(k.alias("k"), text.alias("text")))), lambda x: x["text"]).alias("texts")
    )
    first = F.when(F.col("three") % 10 == 0, F.lit('{"T":"subscription"},')).otherwise(F.lit(""))
    value = F.when(F.col("one").isNotNull(), F.col("texts")[0]).otherwise(F.concat(F.lit("["), first, F.array_join("texts", ","), F.lit("]")))
    empty = messages.filter(k % 150 == 0).select(k.alias("frame"), instant("ts").alias("at"), F.lit("[]").cast("binary").alias("value"))
    return said.select("frame", "at", value.cast("binary").alias("value")).unionByName(empty)


def news_frames(messages: DataFrame) -> DataFrame:
    """Articles of documents as polls' replies: frame (the first document's id), run_id, at and value, the array of the
    articles of one source among eight documents."""
    k, text = F.col("doc_id"), F.col("value").cast("string")
    said = messages.groupBy(F.floor(k / 8).alias("eight"), "run_id").agg(F.min(k).alias("frame"), F.transform(F.array_sort(F.collect_list(F.struct(k.alias("k"), text.alias("text")))), lambda x: x["text"]).alias("texts"))
    value = F.concat(F.lit("["), F.array_join("texts", ","), F.lit("]")).cast("binary")
    return said.select("frame", "run_id", F.timestamp_micros(F.lit(1_773_600_117_000_000) + (F.col("frame") % 256) * 15_625).alias("at"), value.alias("value"))


def event_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An article for each event: one story for each user and type, published at its time, told by the event's id; every
    thirteenth has no usable time."""
    e, k = spread(table(spark, sf_dir, "events")), F.col("event_id")
    body = _object(
        {}, title=F.col("event_type"), url=F.concat(F.lit("https://e.example/"), F.col("user_id").cast("string")), time_published=F.when(k % 13 == 0, "soon").otherwise(compact("ts")),
        summary=F.lpad(k.cast("string"), 12, "0"), source=F.lit("events"),
    )
    return e.select("event_id", body.alias("value"))


def document_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An article for each document, as a message of its own; faults by doc_id % 8; its run is its source."""
    d, k = table(spark, sf_dir, "documents"), F.col("doc_id")
    fault = k % 8
    label = F.element_at(F.array(*map(F.lit, ("Bearish", "Somewhat-Bearish", "Neutral", "Somewhat_Bullish", "Bullish", ""))), (k % 6 + 1).cast("int"))
    body = _object(
        {},
        title=F.when(fault == 1, F.lit("")).otherwise(F.concat(F.lit("doc "), "lang", F.lit(" "), F.sha2("text", 256))), url=F.when(fault == 2, F.lit("ftp://x")).otherwise(F.concat(F.lit("https://x.example/"), "source")),
        time_published=F.when(fault == 3, F.lit("2026-03-15")).otherwise(F.lit("20260315T184157")), summary=F.col("text"), source=F.when(fault == 4, F.lit(None)).otherwise(F.col("source")),
        overall_sentiment_score=(k % 21 - 10) / 20.0, overall_sentiment_label=F.when(fault == 5, F.lit("Somewhat-Bullish")).when(k % 6 == 5, F.lit(None)).otherwise(label),
        topics=F.array(F.struct(F.lit("Earnings").alias("topic"), F.lit("0.75").alias("relevance_score"))),
    )
    return d.select("doc_id", F.col("source").alias("run_id"), body.alias("value"))


def conversation_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message for each conversation: the array of its turns as articles."""
    c = table(spark, sf_dir, "conversations")
    one = F.struct(
        F.col("turn"), F.col("role").alias("title"), F.concat(F.lit("https://c.example/"), F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string")).alias("url"),
        F.lit("20260315T184157").alias("time_published"), F.col("text").alias("summary"), F.lit("chat").alias("source"),
    )
    return c.groupBy("conv_id").agg(F.to_json(F.array_sort(F.collect_list(one))).cast("binary").alias("value"))


def event_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A status row for each event, of three streams."""
    e, k = table(spark, sf_dir, "events"), F.col("event_id")
    stream = F.when(F.col("user_id") % 3 == 0, "trades").when(F.col("user_id") % 3 == 1, "quotes").otherwise("crypto")
    status = F.when(k % 20 == 0, "invalid").when((k % 20).isin(1, 2), "duplicate").when(k % 20 == 3, "ignored").otherwise("valid")
    return e.select(
        stream.alias("stream"), k.alias("arrival_seq"), instant("ts").alias("arrival_ts"), status.alias("status"), F.when(status == "valid", (k % 512) / 256.0).alias("freshness_seconds"),
        F.when((status == "valid") & (stream == "quotes") & (k % 4 != 0), (k % 64) / 128.0).alias("spread"), F.when(status == "invalid", (k % 50) / 16.0).alias("detection_ms"),
    )


#: Fields of mixed messages and their kinds, in order; a kind has the six odd values of _odd(), others are sound.
MIXED: dict[str, list[tuple[str, str]]] = {
    "trades": [("T", "letter"), ("S", "symbol"), ("i", "count"), ("x", "text"), ("p", "price"), ("s", "size"), ("t", "time"), ("c", "tags"), ("z", "maybe text"), ("ingest_timestamp", "maybe number"), ("freshness_seconds", "maybe number")],
    "quotes": [
        ("T", "letter"), ("S", "symbol"), ("bx", "text"), ("bp", "amount"), ("bs", "count"), ("ax", "text"), ("ap", "amount"), ("as", "count"), ("t", "time"), ("c", "tags"), ("z", "maybe text"), ("ingest_timestamp", "maybe number"),
        ("freshness_seconds", "maybe number"), ("spread", "maybe number"),
    ],
    "crypto": [("trade_id", "size"), ("sequence", "count"), ("maker_order_id", "maybe text"), ("taker_order_id", "maybe text"), ("ingest_timestamp", "maybe number"), ("freshness_seconds", "maybe number")],
    "news": [("category_within_source", "maybe text"), ("overall_sentiment_score", "maybe number"), ("topics", "topics")],
}
#: Modes of a field; the odd values are the first six.
MODES = 16


def mode(place: int) -> Column:
    """Which value a row's field of this place takes."""
    return (F.col("event_id") * (2 * place + 1) + F.col("user_id") + 3 * place) % MODES


def _odd(kind: str, letter: str) -> tuple[list[Column | None], Column]:
    """A kind's odd values as JSON text (None: the field is left out), made of the row's own, and its sound one. n is from -2 to 2."""
    n, word = (F.col("user_id") % 5 - 2).cast("string"), F.col("event_type")
    half, null = F.concat(n, F.lit(".5")), F.lit("null")
    at = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))
    return {
        "letter": ([None, null, n, F.lit('""'), quoted(F.lit(letter.upper())), quoted(F.concat(F.lit(letter), F.lit(letter)))], quoted(F.lit(letter))),
        "symbol": ([None, null, n, F.lit('""'), quoted(F.concat(word, n)), F.lit('".-"')], quoted(word)),
        "text": ([None, null, n, F.lit('""'), F.lit("true"), quoted(word)], F.lit('"V"')),
        "maybe text": ([None, null, n, F.lit('""'), F.lit("true"), quoted(word)], F.lit('"C"')),
        "count": ([None, null, n, quoted(n), half, F.lit('"a"')], number(F.col("event_id"))),
        "size": ([None, null, n, quoted(n), half, F.lit('"a"')], number(F.col("event_id") + 1)),
        "amount": ([None, null, half, quoted(half), quoted(word), F.lit("0")], number(F.col("value"))),
        "price": ([None, null, half, quoted(half), quoted(word), F.lit("0")], number(F.col("value"))),
        "time": ([None, null, n, F.lit('"soon"'), quoted(at), quoted(F.date_format("ts", "yyyy-MM-dd"))], quoted(iso("ts"))),
        "tags": ([None, null, n, F.concat(F.lit('["a",'), n, F.lit("]")), F.lit("[null]"), F.lit("[]")], F.lit('["R"]')),
        "maybe number": ([None, null, quoted(word), quoted(half), F.lit("[5]"), n], number(F.col("event_id") % 100 + 0.25)),
        "topics": ([None, null, F.lit("[{}]"), F.concat(F.lit('[{"topic":'), quoted(word), F.lit('},{"relevance_score":'), half, F.lit("}]")), F.lit('[{"topic":"a","relevance_score":null}]'), F.lit('["a"]')], F.lit('[{"topic":"b","relevance_score":"0.75"}]')),
    }[kind]


def event_mixed(spark: SparkSession, sf_dir: str, stream: str) -> DataFrame:
    """A message for each event in which each field of MIXED is sound or odd by the row's numbers, all combinations among them."""
    sound = {
        "crypto": {"type": F.lit('"match"'), "product_id": F.lit('"BTC-USD"'), "price": F.lit('"1.5"'), "size": F.lit('"0.5"'), "side": F.lit('"buy"'), "time": quoted(iso("ts"))},
        "news": {"title": quoted(F.col("event_type")), "url": F.lit('"https://x.example/a"'), "time_published": quoted(compact("ts")), "summary": F.lit('"B"'), "source": F.lit('"C"')},
    }
    fields, modes = dict(sound.get(stream, {})), {}
    for place, (name, kind) in enumerate(MIXED[stream]):
        odd, fine = _odd(kind, stream[0])
        modes[f"m{place}"] = (mode(place) + 1).cast("int")
        values = F.array(*(F.lit(None).cast("string") if x is None else x for x in odd))
        fields[name] = F.when(F.col(f"m{place}") > len(odd), fine).otherwise(F.element_at(values, F.least(F.col(f"m{place}"), F.lit(len(odd)))))
    parts = [F.concat(F.lit(f'"{k}":'), c).alias(f"p{n}") for n, (k, c) in enumerate(fields.items())]
    e = spread(table(spark, sf_dir, "events")).withColumns(modes).select("event_id", *parts)  # fields that are left out are null
    body = F.concat_ws(",", *(f"p{n}" for n in range(len(parts))))
    return e.select("event_id", F.concat(F.lit("{"), body, F.lit("}")).cast("binary").alias("value"))
