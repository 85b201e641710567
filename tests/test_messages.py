"""Parsing, contracts and normalisers, row by row."""

import json
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from marlstone.functions import cast
from marlstone.operators import contracts, derive, normalise, parse
from marlstone.plans import pipelines

TRADE = {"T": "t", "S": "AAPL", "i": 12345, "x": "V", "p": 195.10, "s": 100, "c": ["@", "I"], "z": "C", "t": "2025-09-19T19:41:06.268341055Z", "ingest_timestamp": 1758310866.5}
QUOTE = {"T": "q", "S": "AAPL", "bx": "V", "bp": 244.96, "bs": 1, "ax": "V", "ap": 245.55, "as": 1, "c": ["R"], "z": "C", "t": "2025-09-19T19:41:06.268341055Z"}
CRYPTO = {"type": "match", "trade_id": 987, "sequence": 123456, "product_id": "BTC-USD", "price": "65432.10", "size": "0.001", "side": "buy", "time": "2026-03-15T18:41:57.123456Z", "ingest_timestamp": 1773600117.5}
NEWS = {"title": "T1", "url": "https://x.example/a", "time_published": "20260315T184157", "summary": "S", "source": "Src", "topics": [{"topic": "Earnings", "relevance_score": "0.75"}], "overall_sentiment_score": 0.21, "overall_sentiment_label": "Somewhat_Bullish"}
BASE = {"trades": TRADE, "quotes": QUOTE, "crypto": CRYPTO, "news": NEWS}
GONE = object()


def message(stream, **changes):
    out = BASE[stream] | changes
    return json.dumps({k: v for k, v in out.items() if v is not GONE}).encode()


def frame(spark, messages):
    return spark.createDataFrame([(k, bytearray(m)) for k, m in enumerate(messages)], "k int, value binary")


# (stream, changes, contract codes, normaliser codes)
CASES = [
    ("trades", {}, [], []),
    ("trades", {"foo": 1}, [], []),
    ("trades", {"T": "q"}, ["contract:T"], []),
    ("trades", {"S": "brk.b"}, [], []),
    ("trades", {"S": ".."}, ["contract:S"], []),
    ("trades", {"S": ""}, ["contract:S"], []),
    ("trades", {"S": "A1"}, ["contract:S"], []),
    ("trades", {"S": 5}, ["contract:S"], []),
    ("trades", {"i": -1}, ["contract:i"], []),
    ("trades", {"i": True}, [], []),
    ("trades", {"i": GONE}, ["contract:i"], ["missing:i"]),
    ("trades", {"x": GONE}, ["contract:x"], ["missing:x"]),
    ("trades", {"x": None}, ["contract:x"], ["null:exchange"]),
    ("trades", {"p": GONE}, ["contract:p"], ["missing:p"]),
    ("trades", {"p": None}, ["contract:p"], ["cast:p:double"]),
    ("trades", {"p": 0}, ["contract:p"], []),
    ("trades", {"p": "nan"}, ["contract:p"], []),
    ("trades", {"p": "1_0.5"}, [], []),
    ("trades", {"p": "1.5d"}, ["contract:p"], ["cast:p:double"]),
    ("trades", {"p": []}, ["contract:p"], ["cast:p:double"]),
    ("trades", {"s": "10.0"}, [], ["cast:s:long"]),
    ("trades", {"s": 10.7}, ["contract:s"], []),
    ("trades", {"s": 0}, ["contract:s"], []),
    ("trades", {"s": " 12 "}, [], []),
    ("trades", {"t": "2025"}, ["contract:t"], ["cast:t:timestamp"]),
    ("trades", {"t": 5}, ["contract:t"], ["cast:t:timestamp"]),
    ("trades", {"c": None}, [], []),
    ("trades", {"c": ["a", None]}, ["contract:c"], []),
    ("trades", {"c": "x"}, ["contract:c"], []),
    ("trades", {"z": 3}, ["contract:z"], []),
    ("trades", {"ingest_timestamp": "x"}, ["contract:ingest_timestamp"], ["cast:ingest_timestamp:double"]),
    ("trades", {"ingest_timestamp": 0}, [], []),
    ("quotes", {}, [], []),
    ("quotes", {"bp": 0}, [], []),
    ("quotes", {"ap": -1}, ["contract:ap"], []),
    ("quotes", {"as": GONE, "as_": 4}, [], []),
    ("quotes", {"as": GONE}, ["contract:as"], ["missing:as"]),
    ("quotes", {"bs": -2}, ["contract:bs"], []),
    ("crypto", {}, [], []),
    ("crypto", {"price": 65432.1}, ["contract:price"], []),
    ("crypto", {"price": "nan"}, [], []),
    ("crypto", {"price": "0"}, ["contract:price"], []),
    ("crypto", {"product_id": "1INCH-USD"}, ["contract:product_id"], []),
    ("crypto", {"side": "hold"}, ["contract:side"], []),
    ("crypto", {"trade_id": 0}, ["contract:trade_id"], []),
    ("crypto", {"ingest_timestamp": GONE}, [], ["missing:ingest_timestamp"]),
    ("crypto", {"time": "T19:41"}, ["contract:time"], ["cast:time:timestamp"]),
    ("news", {}, [], []),
    ("news", {"title": ""}, ["contract:title"], []),
    ("news", {"url": None}, ["contract:url"], []),
    ("news", {"time_published": "2026-03-15"}, ["contract:time_published"], ["cast:time_published:timestamp"]),
    ("news", {"overall_sentiment_label": "Somewhat-Bullish"}, ["contract:overall_sentiment_label"], []),
    ("news", {"overall_sentiment_score": "x"}, ["contract:overall_sentiment_score"], ["cast:overall_sentiment_score:double"]),
    ("news", {"topics": [{"topic": "a"}]}, [], []),
    ("news", {"topics": None}, [], []),
    ("news", {"topics": [{"topic": "a", "relevance_score": None}]}, [], ["cast:topics:double"]),
    ("news", {"topics": ["x"]}, [], ["cast:topics:object"]),
    ("news", {"topics": "x"}, [], ["cast:topics:array"]),
]


@pytest.mark.parametrize("stream", list(BASE))
def test_rules(spark, stream):
    cases = [c for c in CASES if c[0] == stream]
    parsed = parse.parse_messages(frame(spark, [message(stream, **c[1]) for c in cases]))
    got = {r.k: r for r in contracts.check(parsed, stream).collect()}
    typed = {r.k: r for r in normalise.normalise(parsed, stream, carry=["k"]).collect()}
    for k, (_, changes, contract, codes) in enumerate(cases):
        assert (changes, sorted(got[k].codes)) == (changes, contract)
        assert got[k].status == ("invalid" if contract else "valid")
        assert (changes, typed[k].codes) == (changes, codes)


def test_unusable_messages(spark):
    parsed = parse.parse_messages(frame(spark, [b"not json", b"\x61\xff\x62", b"5", b"[1]", b"null"]))
    rows = {r.k: r for r in normalise.normalise(parsed, "trades", carry=["k"]).collect()}
    assert [rows[k].codes for k in range(5)] == [["parse:json"], ["parse:utf8"], ["type:object"], ["type:object"], ["type:object"]]
    assert rows[1].raw == "a�b"
    dlq = parse.dead_letters(normalise.normalise(parsed, "trades"), "normalise")
    assert dlq.count() == 5 and json.loads(bytes(parse.dead_letter_bytes(dlq).first().value)).keys() == {"error", "raw"}


def test_trade_values(spark):
    rows = [message("trades"), message("trades", p=100.0, s=100), message("trades", p="nan"), message("trades", ingest_timestamp=GONE), message("trades", t="2025-09-19T19:41:06.268341+02:00"), message("trades", t="2025-09-19T19:41:06.268341", c=[])]
    got = sorted(pipelines.typed(frame(spark, rows), "trades", carry=["k"]).collect(), key=lambda r: r.k)
    assert got[0].trade_value == 19510.0 and got[0].is_large_trade and got[0].latency_ms == 231.659 and got[0].conditions == ["@", "I"]
    assert got[0].exchange_ts == datetime(2025, 9, 19, 19, 41, 6, 268341)
    assert got[1].trade_value == 10000.0 and not got[1].is_large_trade
    assert not got[2].is_large_trade
    assert got[3].ingest_timestamp is None and got[3].latency_ms == 0.0
    assert got[4].exchange_ts == datetime(2025, 9, 19, 17, 41, 6, 268341)
    assert got[5].exchange_ts == got[0].exchange_ts and got[5].conditions == []


def test_quote_spreads(spark):
    rows = [message("quotes"), message("quotes", bp=0), message("quotes", bp=246.0)]
    assert [r.spread for r in sorted(pipelines.typed(frame(spark, rows), "quotes", carry=["k"]).collect(), key=lambda r: r.k)] == [0.59, None, -0.45]


def test_news_batches(spark):
    rows = [f"[{message('news').decode()},\"x\",null,3]".encode(), message("news"), b"[]", b"oops"]
    got = pipelines.typed(frame(spark, rows), "news", carry=["k"]).collect()
    assert sorted((r.k, ",".join(r.codes)) for r in got) == [(0, ""), (0, "type:object"), (0, "type:object"), (0, "type:object"), (1, ""), (3, "parse:json")]
    main, dlq = pipelines.build(frame(spark, rows), "news")
    assert main.count() == 2 and dlq.count() == 4
    assert main.first().topics[0].asDict() == {"topic": "Earnings", "relevance_score": 0.75}
    assert pipelines.build(frame(spark, rows), "news", dedup_by="time_published")[0].count() == 1


def test_ignored_and_routed_types(spark):
    checked = contracts.check(parse.parse_messages(frame(spark, [message("crypto", type="heartbeat"), message("crypto", type="last_match")])), "crypto")
    assert {r.k: r.status for r in checked.collect()} == {0: "ignored", 1: "valid"}
    routed = parse.route(parse.parse_messages(frame(spark, [message("trades"), message("quotes"), b'{"T":"success"}', b"x"])), "T", "t")
    assert [r.k for r in routed.select("k").collect()] == [0]


def test_collectors(spark):
    rows = [(0, message("trades")), (1, message("trades", S="MSFT")), (2, message("trades", p=0)), (3, b'{"T":"success"}'), (4, message("trades", i=2))]
    df = spark.createDataFrame([(k, bytearray(m)) for k, m in rows], "k int, value binary").withColumn("at", F.timestamp_seconds(F.lit(1758310870)))
    for exact in (False, True):
        got = {r.k: r for r in pipelines.collect(df, "trades", ["k"], "at", exact=exact).collect()}
        assert {k: r.status for k, r in got.items()} == {0: "valid", 1: "duplicate", 2: "invalid", 4: "valid"}
        assert got[0].freshness_seconds == pytest.approx(3.731659) and got[1].freshness_seconds is None
    crypto = [(1, 1), (1, 2), (3, 2)]
    df = spark.createDataFrame([(k, bytearray(message("crypto", trade_id=a, sequence=b))) for k, (a, b) in enumerate(crypto)], "k int, value binary").withColumn("at", F.current_timestamp())
    got = {r.k: r.status for r in pipelines.collect(df, "crypto", ["k"], "at", scope=[]).collect()}
    assert got == {0: "valid", 1: "duplicate", 2: "valid"}


def test_expressions(spark):
    row = spark.range(1).select(
        cast.cut_nanoseconds(F.lit("2025-09-19T19:41:06.268341055Z")).alias("a"), cast.cut_nanoseconds(F.lit("2025-09-19T19:41:06.268341+02:00"), True).alias("b"),
        cast.format_micros(F.timestamp_micros(F.lit(1758310866268341))).alias("c"), cast.format_seconds(cast.compact_timestamp(F.lit("20260315T184157"))).alias("d"),
        cast.lookback_cutoff(cast.iso_timestamp(F.lit("2026-03-15T00:05:00Z"))).alias("e"), cast.metric_name(F.lit("Somewhat-Bearish x")).alias("f"),
        derive.dedup_key(F.lit(None).cast("string"), F.lit("t")).alias("g"), contracts.sentiment_of(F.lit(0.15)).alias("h"), cast.compact_timestamp(F.lit("2026315T184157")).alias("i"),
    ).first()
    import hashlib

    assert tuple(row) == ("2025-09-19T19:41:06.268341Z", "2025-09-19T19:41:06.268341Z", "2025-09-19T19:41:06.268341 UTC", "2026-03-15T18:41:57 UTC", "20260314T2350", "somewhat_bearish_x", hashlib.sha256(b"|t").hexdigest(), "Somewhat_Bullish", None)


def test_messages_out(spark):
    df = spark.createDataFrame([("r1", 1, None), ("r1", 2, "x")], "run string, as_ int, z string")
    assert [json.loads(bytes(r.value)) for r in parse.message_bytes(df.select("as_", "z"), {"as_": "as"}).collect()] == [{"as": 1, "z": None}, {"as": 2, "z": "x"}]
    out = parse.batch_message(df, "run").collect()
    assert len(out) == 1 and json.loads(bytes(out[0].value)) == [{"as_": 1, "z": None}, {"as_": 2, "z": "x"}]
    assert parse.batch_message(df.limit(0), "run").count() == 0


def test_a_price_of_zero_is_invalid_in_trades_and_crypto(spark):
    from marlstone.plans import cases

    for stream, field, zero in (("trades", "p", "0.0"), ("crypto", "price", '"0.0"'), ("crypto", "size", '"0.0"')):
        rows = spark.createDataFrame([(cases.message(stream, {field: zero}),)], "value string")
        got = contracts.check(parse.parse_messages(rows), stream).first()
        assert (got.status, got.codes) == ("invalid", [f"contract:{field}"])


def test_no_field_is_read_again_by_the_rules(spark):
    from marlstone.plans import cases

    for stream in ("trades", "quotes"):
        rows = spark.createDataFrame([(cases.message(stream, {}),)], "value string")
        plan = contracts.check(parse.parse_messages(rows), stream).select("status", "codes")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("schema_of_variant") + plan.count("schemaOfVariant") <= 2 * 16


@pytest.mark.parametrize("stream", pipelines.STREAMS)
def test_no_step_is_too_large_to_be_compiled(spark, stream):
    """HotSpot interprets methods of more than 8,000 bytes, however often they run."""
    k = F.col("id").cast("string")
    said = spark.range(3).select(F.current_timestamp().alias("at"), F.concat(F.lit('{"i":'), k, F.lit(',"T":"t","t":"2024-01-01","s":'), k, F.lit("}")).cast("binary").alias("value"))
    for df in (pipelines.typed(said, stream), contracts.check(parse.parse_messages(said), stream)):
        told = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
        assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", told)), default=0) < 8000


@pytest.mark.parametrize("stream", ["trades", "quotes", "crypto"])
def test_counting_the_main_lane_reads_few_values(spark, stream):
    """Kinds tell whether a number or a text will do; only times and what is asked for are taken out of their variants."""
    said = spark.range(3).select(F.lit("{}").cast("binary").alias("value"))
    counted = normalise.main_lane(pipelines.typed(said, stream)).groupBy().count()
    plan = spark._jvm.PythonSQLUtils.explainString(counted._jdf.queryExecution(), "simple")
    plan = plan[plan.index("Physical Plan") :]
    assert not re.findall(r"\b(?:price|symbol|exchange|product_id|side|bid_price|trade_value)#", plan)
    assert "round(" not in plan
